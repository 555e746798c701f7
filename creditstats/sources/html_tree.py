"""A tolerant HTML tree for the fixed page lookups (no general XPath).

Built with the standard library's html.parser (no HTML package is
installed). Implied end tags follow the usual HTML rules for the elements
the lookups touch: a block start closes an open <p>; <li>, <tr>, <td>,
<th> close their open siblings; an end tag closes everything opened after
its match and is ignored without one. Text nodes are kept as separate
children, split by tags and comments, as an XML tree would have them.
"""

from __future__ import annotations

from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
                  "header hr main nav ol p pre section table ul".split())


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict | None = None, parent: "Node | None" = None):
        self.tag = tag
        self.attrs = attrs or {}
        self.children: list = []  # Node, str (text node) or Comment
        self.parent = parent

    # --- navigation (document order) ---
    def elements(self, tag: str | None = None) -> list["Node"]:
        return [c for c in self.children if isinstance(c, Node) and (tag is None or c.tag == tag)]

    def descendants(self, tag: str | None = None) -> list["Node"]:
        out, stack = [], list(reversed(self.elements()))
        while stack:
            n = stack.pop()
            if tag is None or n.tag == tag:
                out.append(n)
            stack.extend(reversed(n.elements()))
        return out

    def texts(self) -> list[str]:
        """Direct text-node children (XPath ./text())."""
        return [c for c in self.children if type(c) is str]

    def string(self) -> str:
        """String value: all descendant text, in order (XPath string(.))."""
        parts, stack = [], [self]
        while stack:
            n = stack.pop()
            if type(n) is str:
                parts.append(n)
            elif isinstance(n, Node):
                stack.extend(reversed([c for c in n.children if type(c) is str or isinstance(c, Node)]))
        return "".join(parts)

    def following_siblings(self) -> list["Node"]:
        if self.parent is None:
            return []
        sibs = self.parent.elements()
        return sibs[sibs.index(self) + 1:]

    def is_first_of_type(self) -> bool:
        """XPath tag[1]: the first child of this tag name under its parent."""
        return self.parent is not None and self.parent.elements(self.tag)[0] is self


class Comment:
    __slots__ = ("value",)

    def __init__(self, value: str):
        self.value = value


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#document")
        self.stack = [self.root]

    def _close_to(self, tag: str, stop: tuple[str, ...] = ()) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            t = self.stack[i].tag
            if t == tag:
                del self.stack[i:]
                return
            if t in stop:
                return

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK or tag in ("li", "tr", "td", "th", "tbody", "thead"):
            self._close_to("p", stop=("div", "td", "th", "li", "table", "article", "section", "nav"))
        if tag == "li":
            self._close_to("li", stop=("ul", "ol"))
        elif tag == "tr":
            self._close_to("tr", stop=("table", "tbody", "thead", "tfoot"))
        elif tag in ("td", "th"):
            self._close_to("td", stop=("tr", "table"))
            self._close_to("th", stop=("tr", "table"))
        node = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.stack[-1])
        self.stack[-1].children.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack[-1].tag == tag:
            self.stack.pop()

    def handle_endtag(self, tag):
        if any(n.tag == tag for n in self.stack[1:]):
            self._close_to(tag)

    def handle_data(self, data):
        kids = self.stack[-1].children
        if kids and type(kids[-1]) is str:
            kids[-1] += data
        elif data:
            kids.append(data)

    def handle_comment(self, data):
        self.stack[-1].children.append(Comment(data))


def parse(html: str | None) -> Node:
    b = _Builder()
    if html:
        b.feed(html)
        b.close()
    return b.root


def release(root: Node) -> None:
    """Undo a tree that is not needed any more: parents and children name each
    other, so its memory would else wait for a collection of all cycles."""
    stack = [root]
    while stack:
        n = stack.pop()
        stack.extend(n.elements())
        n.children, n.parent = [], None
