"""Layout-aware text of HTML pages.

One pass over a page: a scanner finds tags, text and comments; a tree builder
keeps the stack of open elements, closes what a tag implies (paragraphs,
list items, table parts, options) and opens what is missing (rows, cells);
layout turns the resulting opens and closes into lines. There is no
recursion, so depth and length of a page cost memory only.

Layout: blocks start new lines, and paragraphs, headings, lists, tables and
quotes are set off by one blank line. List items get "- " or their number,
with nested lists indented. Table cells are padded to the width of their
column and parted by " | "; a cell over several rows leaves empty cells below. Preformatted text keeps its spaces. Line breaks
and rules are kept.

Visible is what a browser without scripts to run shows: not the head,
scripts, styles, templates, embedded media, comments, hidden inputs and
closed dialogs; not an element with the attribute hidden or the style
display:none, nor one with visibility:hidden, except for descendants made
visible again. Styles are inline or in the page's own style sheets, there by
selectors of one element (name, classes, id; not by ancestors, states or
attributes, nor in nested rules), for the screen. The cascade decides: an
important value, then an inline one, then the more specific, then the later.
Of closed details only the summary is shown. Text of noscript and map is
shown, formulas without their annotations, and of a drawing (svg) the text
elements, a line each, and embedded HTML.

Scale: one narrow pass over the pages, one page at a time, no shuffle.

Defined results: a null page gives empty text; broken markup never fails (an
unclosed tag, quote or comment ends with the page); text in a table outside
its cells stands before the table; equal pages give equal texts; page_id may
be null or repeated; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import in_arrow

# ---------------------------------------------------------------------------
# Fixed values of HTML: element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head title script style template iframe noembed noframes object audio video canvas datalist".split())
UNDRAWN = frozenset("desc metadata defs symbol clippath mask marker pattern".split())  # inside svg
ENDS_SVG = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing "
                     "menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dl table blockquote pre figure fieldset hr".split())
BLOCK = SPACED | frozenset("address article aside body center details dialog dir div dd dt figcaption footer form header "
                           "hgroup html legend li main nav optgroup option search section select summary".split())
CLOSES_P = (BLOCK - {"body", "html", "option", "optgroup", "select", "legend"}) | {"table"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# A start tag closes these open elements, unless one of the second set is between.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"optgroup", "option"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "caption": ({"caption"}, {"table"}), "colgroup": ({"colgroup", "caption"}, {"table"}),
    **dict.fromkeys(("thead", "tbody", "tfoot"), ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"})),
}
SCREEN = ("", "all", "screen", "only screen")  # media that a browser shows
MOST_ROWS = 65534  # that a cell spans
SCOPE = frozenset("table td th caption button object template html foreignobject".split())
# ---------------------------------------------------------------------------

SIMPLE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)\s*>")
TAG_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)(?:\s*(=)\s*)?")
BARE_VALUE = re.compile(r"[^\s>]*")
SPACES = re.compile(r"[ \t\n\r\f]+")
STYLE_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
STYLE_TAG = re.compile(r"<style[\s/>]", re.I)
BRACE = re.compile(r"([{}])")
SELECTOR_PART = re.compile(r"[.#]?-?[a-zA-Z_][\w-]*|\*")
SELECTOR = re.compile(rf"(?:{SELECTOR_PART.pattern})(?:[.#]-?[a-zA-Z_][\w-]*)*")
DECLARATION = re.compile(r"""(?:[^;"'(]+|"[^"]*"?|'[^']*'?|\([^)]*\)?)+""")


class Scanner:
    """Tags and texts of a page, in order: ("text", s), ("open", name,
    attributes) or ("close", name)."""

    def __init__(self, html: str):
        self.html, self.no_more = html, set()

    def __iter__(self):
        html, at, n = self.html, 0, len(self.html)
        lower, foreign = None, 0  # foreign: open svg and math, whose parts may close themselves
        while at < n:
            tag = html.find("<", at)
            if tag < 0:
                yield "text", html[at:]
                return
            if tag > at:
                yield "text", html[at:tag]
            m = SIMPLE_TAG.match(html, tag)
            if m:
                name, closing, attributes, empty, at = m[2].lower(), m[1], {}, False, m.end()
            elif m := TAG_NAME.match(html, tag):
                name, closing = m[1].lower(), html[tag + 1] == "/"
                attributes, empty, at = self._attributes(m.end())
            else:
                at = self._other(tag)
                if at == tag:
                    yield "text", "<"
                    at = tag + 1
                continue
            if closing:
                foreign = 1 if name == "foreignobject" else foreign - (foreign > 0 and name in ("svg", "math"))
                yield "close", name
                continue
            yield "open", name, attributes
            foreign = 0 if name in ENDS_SVG else foreign  # these are HTML, inside a drawing too
            if empty and name not in VOID and (foreign or name in ("svg", "math")):
                yield "close", name
                continue
            foreign += name in ("svg", "math")
            if name in RAW or name == "plaintext":
                if lower is None:
                    lower = html.lower() if len(html.lower()) == n else html
                end = n if name == "plaintext" else lower.find("</" + name, at)
                end = n if end < 0 else end
                if name == "style" and attributes.get("media", "").strip().lower() in SCREEN:
                    yield "style", html[at:end]
                if name in ("textarea", "xmp", "plaintext"):
                    yield "raw", html[at:end] if name != "textarea" else unescape(html[at:end])
                at = end

    def _find(self, what: str, at: int) -> int:
        """Like find, but a search that failed once is not made again."""
        if what in self.no_more:
            return -1
        found = self.html.find(what, at)
        if found < 0:
            self.no_more.add(what)
        return found

    def _other(self, at: int) -> int:
        """End of a comment, declaration or instruction; `at` if it is none."""
        html = self.html
        if html.startswith("<!--", at):
            if html.startswith((">", "->"), at + 4):
                return html.index(">", at) + 1
            end = self._find("-->", at + 4)
            return len(html) if end < 0 else end + 3
        if html.startswith(("<!", "<?", "</"), at):
            end = self._find(">", at)
            return len(html) if end < 0 else end + 1
        return at

    def _attributes(self, at: int) -> tuple[dict[str, str], bool, int]:
        """Attributes, whether the tag ends with a slash, and its end."""
        html, out = self.html, {}
        while m := ATTRIBUTE.match(html, at):
            at, value = m.end(), ""
            if m[2]:
                quote = html[at:at + 1]
                end = self._find(quote, at + 1) if quote in ("'", '"') and quote else -1
                if end >= 0:
                    value, at = html[at + 1:end], end + 1
                else:
                    v = BARE_VALUE.match(html, at)
                    value, at = v[0], v.end()
            out.setdefault(m[1].lower(), unescape(value))
        end = self._find(">", at)
        return out, end > at and html[end - 1] == "/", len(html) if end < 0 else end + 1


class Flow:
    """Lines of a block container."""

    def __init__(self):
        self.lines: list[str] = []
        self.piece: list[str] = []
        self.gap = 0

    def text(self, s: str, keep: bool) -> None:
        if keep:
            first, *rest = s.replace("\r\n", "\n").split("\n")
            self.piece.append(first)
            for line in rest:
                self.end_line(force=True)
                self.piece.append(line)
            return
        s = SPACES.sub(" ", s)
        if s[:1] == " " and (not self.piece or self.piece[-1][-1:] in (" ", "")):
            s = s[1:]
        if s:
            self.piece.append(s)

    def end_line(self, force: bool = False) -> None:
        line = "".join(self.piece).rstrip(" ")
        self.piece = []
        if line or force:
            self.put([line])

    def put(self, lines: list[str]) -> None:
        if self.lines and self.gap:
            self.lines.append("")
        self.gap = 0
        self.lines += lines

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def done(self) -> list[str]:
        self.end_line()
        return self.lines


class Grid:
    """Cells of a table, aligned by column."""

    def __init__(self):
        self.caption: list[str] = []
        self.rows: list[list[tuple[list[str], int, int]]] = []  # cells: lines, columns, rows
        self.parts: list[int] = []  # where a part of the table (head, body, foot) starts

    def _placed(self) -> list[list[tuple[list[str], int]]]:
        """Rows of (lines, columns), with empty cells where cells of rows
        above reach down. No cell reaches beyond its part of the table."""
        out, reach, parts = [], [], set(self.parts)  # reach: (first column, columns, last row), by column
        for k, r in enumerate(self.rows):
            if k in parts:
                reach = []
            row, after, at, above = [], [], 0, 0
            for cell, span, down in r:
                begin = at
                while above < len(reach) and reach[above][0] < at + span:
                    column, wide, last = reach[above]
                    above += 1
                    if last >= k:  # a cell too wide to stand before it stands behind it
                        after.append(reach[above - 1])
                        at = column + wide
                if at > begin:
                    row.append(([], at - begin))
                row.append((cell, span))
                if down > 1:
                    if after and after[-1][2] == k + down - 1 and sum(after[-1][:2]) == at:
                        after[-1] = (after[-1][0], after[-1][1] + span, after[-1][2])
                    else:
                        after.append((at, span, k + down - 1))
                at += span
            reach = after + reach[above:]
            out.append(row)
        return out

    def done(self) -> list[str]:
        rows = [r for r in self._placed() if any(cell for cell, _ in r)]
        width: dict[int, int] = {}
        for r in rows:
            at = 0
            for cell, span in r:
                if span == 1:
                    width[at] = max([width.get(at, 0), *map(len, cell)])
                at += span
        out = list(self.caption)
        for r in rows:
            for k in range(max(len(cell) for cell, _ in r)):
                at, line = 0, []
                for cell, span in r:
                    wide = sum(width.get(i, 0) for i in range(at, at + span)) + 3 * (span - 1) if span < 1000 else 0
                    line.append((cell[k] if k < len(cell) else "").ljust(wide))
                    at += span
                out.append(" | ".join(line).rstrip())
        return out


class Styles:
    """What a page's own style sheets say of display and visibility."""

    def __init__(self, sheets: list[str]):
        # last part of a selector -> all its parts -> property -> (important, inline, specificity, order, value)
        self.rules: dict[str, dict[frozenset, dict[str, tuple]]] = {}
        order = 0
        for sheet in sheets:
            selectors, skipped = None, 0  # skipped: open braces of an at-rule that does not hold
            pieces = BRACE.split(STYLE_COMMENT.sub("", sheet) + "}")  # an open rule ends with its sheet
            for before, brace in zip(pieces[::2], pieces[1::2]):
                if skipped:
                    skipped += 1 if brace == "{" else -1
                elif brace == "{" and selectors is not None:  # nested rules are not read
                    skipped, selectors = 2, None
                elif brace == "{":
                    selectors = before.rpartition(";")[2].strip()
                    if selectors.startswith("@"):
                        kind, _, media = selectors.lower().partition(" ")
                        skipped, selectors = int(kind != "@media" or media.strip() not in SCREEN), None
                elif selectors is not None:
                    said = _shown(before)
                    for selector in selectors.split(",") if said else ():
                        self._add(selector.strip(), order, said)
                    order, selectors = order + 1, None

    def _add(self, selector: str, order: int, said: dict) -> None:
        if not SELECTOR.fullmatch(selector):
            return
        parts = [x if x[0] in ".#" else x.lower() for x in SELECTOR_PART.findall(selector)]
        weight = (sum(x[0] == "#" for x in parts), sum(x[0] == "." for x in parts), sum(x[0] not in ".#*" for x in parts))
        best = self.rules.setdefault(parts[-1], {}).setdefault(frozenset(parts), {})
        for what, (value, first) in said.items():
            best[what] = max(best.get(what, ()), (first, False, weight, order, value))

    def of(self, name: str, attributes: dict[str, str]) -> dict[str, str]:
        """Properties of an element: its own style before the sheets, an
        important value before others, then the more specific, the later."""
        best: dict[str, tuple] = {}
        if self.rules:
            mine = {"*", name, *("." + c for c in attributes.get("class", "").split())}
            mine |= {"#" + attributes["id"]} if "id" in attributes else set()
            for key in mine & self.rules.keys():
                for parts, said in self.rules[key].items():
                    if parts <= mine:
                        for what, told in said.items():
                            best[what] = max(best.get(what, ()), told)
        for what, (value, first) in _shown(attributes["style"]).items() if "style" in attributes else ():
            best[what] = max(best.get(what, ()), (first, True, (), 0, value))
        return {what: x[-1] for what, x in best.items()}


class Page:
    """Tree builder and layout of one page."""

    def __init__(self, styles: Styles):
        self.styles = styles
        self.flow = Flow()
        # open elements: [name, flow or grid to return to, hidden before, keep before, list counter or close data]
        self.open: list[list] = []
        self.count: Counter = Counter()  # of open elements by name, so that deep pages need no search
        self.hidden, self.keep = 0, False  # hidden: 0 seen, 1 visibility only, 2 not rendered
        self.grids: list[tuple[Grid, Flow]] = []
        self.lists: list[list] = []
        self.svg: list[list] = []  # open svg, and their open text and foreignobject

    # ---- tree

    def start(self, name: str, attributes: dict[str, str]) -> None:
        if name in ENDS_SVG and self._in_svg():
            while self._in_svg():
                self._pop()
        if name == "image":
            name = "img"
        if name in CLOSES_P:
            self._close_to({"p"}, SCOPE)
        if name in IMPLIED_END:
            self._close_to(*IMPLIED_END[name])
        if name in HEADINGS and self.open and self.open[-1][0] in HEADINGS:
            self._pop()
        if name in ("td", "th") and self.grids and not self._has("tr", {"table"}):
            self._push("tr", {})
        if name in ("tr", "td", "th", "thead", "tbody", "tfoot", "caption") and not self._has("table", set()):
            return  # table parts outside a table are no elements
        if name in VOID:
            self._void(name, attributes)
        else:
            self._push(name, attributes)

    def end(self, name: str) -> None:
        if name == "br":
            return self._void("br", {})
        if name in HEADINGS:
            return self._close_to(HEADINGS, SCOPE)
        if name == "p" and not self._has("p", SCOPE):
            return self.flow.block(1) if not self.hidden else None
        self._close_to({name}, {"table"} if name in ("tr", "thead", "tbody", "tfoot") else
                       frozenset() if name in SCOPE else {"td", "th", "table"} if name not in BLOCK else SCOPE - {name})

    def _in_svg(self) -> bool:
        return bool(self.svg) and self.svg[-1][0] != "foreignobject"

    def _has(self, name: str, stop) -> bool:
        if not self.count[name]:
            return False
        for e in reversed(self.open):
            if e[0] == name:
                return True
            if e[0] in stop:
                return False
        return False

    def _close_to(self, names, stop) -> None:
        """Close down to the outermost open element of `names` this side of `stop`."""
        if not any(self.count[x] for x in names):
            return
        at = None
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in names:
                at = i
                if len(names) == 1 or names is HEADINGS:
                    break
            elif self.open[i][0] in stop:
                break
        if at is not None:
            while len(self.open) > at:
                self._pop()

    # ---- layout

    def _push(self, name: str, attributes: dict[str, str]) -> None:
        entry = [name, self.flow, self.hidden, self.keep, None]
        self.open.append(entry)
        self.count[name] += 1
        drawn = self._in_svg()
        if name == "svg" or self.svg and name in ("text", "foreignobject"):
            self.svg.append(entry)
        shown = self.styles.of(name, attributes) if self.styles.rules or "style" in attributes else {}
        if drawn:
            shown = {k: attributes[k].strip().lower() for k in ("display", "visibility") if k in attributes} | shown
        if (name in UNSEEN or drawn and name in UNDRAWN or name in ("annotation", "annotation-xml") and self.count["math"]
                or "hidden" in attributes or shown.get("display") == "none" or name == "dialog" and "open" not in attributes):
            self.hidden = 2
        elif self.hidden < 2 and "visibility" in shown:
            self.hidden = {"hidden": 1, "collapse": 1, "visible": 0, "initial": 0}.get(shown["visibility"], self.hidden)
        if name == "summary" and self.hidden == 2 and len(self.open) > 1 and self.open[-2][0] == "details":
            self.hidden = self.open[-2][2]  # seen even where its details are closed
        if self.hidden == 2:
            return
        self.flow.block(1 if name in SPACED and not (name in ("ul", "ol") and self.lists) else 0) if name in BLOCK else None
        if drawn and name == "text":
            self.flow.block(0)
        if name in ("pre", "xmp", "plaintext", "textarea"):
            self.keep = True
        if name in ("ul", "ol", "menu", "dir"):
            self.lists.append([name, _number(attributes.get("start"), 1)])
            entry[4] = "list"
        elif name == "li":
            mark = "- "
            if self.lists and self.lists[-1][0] == "ol":
                value = _number(attributes.get("value"), self.lists[-1][1])
                mark, self.lists[-1][1] = f"{value}. ", value + 1
            entry[4], self.flow = ("indent", mark, " " * len(mark)), Flow()
        elif name in ("blockquote", "dd"):
            entry[4], self.flow = ("indent", "  ", "  "), Flow()
        elif name == "table":
            self.grids.append((Grid(), self.flow))
            entry[4] = "table"
        elif name == "tr":
            self.grids[-1][0].rows.append([])
        elif name in ("thead", "tbody", "tfoot"):
            self.grids[-1][0].parts.append(len(self.grids[-1][0].rows))
        elif name in ("td", "th"):
            span, down = _number(attributes.get("colspan"), 1), _number(attributes.get("rowspan"), 1)
            # 0 rows: to the end of the part
            entry[4], self.flow = ("cell", min(1000, max(1, span)), MOST_ROWS if down == 0 else min(MOST_ROWS, max(1, down))), Flow()
        elif name == "caption":
            entry[4], self.flow = ("caption",), Flow()
        elif name == "details" and "open" not in attributes:
            self.hidden = 2
        elif name == "q":
            self.flow.text('"', False)

    def _pop(self) -> None:
        entry = self.open.pop()
        name, flow, hidden, keep, made = entry
        self.count[name] -= 1
        line = bool(self.svg) and self.svg[-1] is entry and name == "text"
        if self.svg and self.svg[-1] is entry:
            self.svg.pop()
        seen = self.hidden < 2 or made is not None or name == "details"
        inner, self.flow, self.hidden, self.keep = self.flow, flow, hidden, keep
        if not seen or hidden == 2:
            return
        if made == "list":
            self.lists.pop()
        elif made == "table":
            lines = self.grids.pop()[0].done()
            if lines:
                self.flow.block(1)
                self.flow.put(lines)
        elif made is not None:
            lines = inner.done()
            if made[0] == "cell":
                row = self.grids[-1][0].rows
                (row[-1] if row else row.append([]) or row[-1]).append((lines, made[1], made[2]))
            elif made[0] == "caption":
                self.grids[-1][0].caption += lines
            elif lines:
                self.flow.end_line()
                self.flow.put([(made[1] if k == 0 else made[2] if x else "") + x for k, x in enumerate(lines)])
        elif name == "q":
            self.flow.text('"', False)
        if line:
            self.flow.block(0)
        if name in BLOCK:
            self.flow.block(1 if name in SPACED and not (made == "list" and self.lists) else 0)

    def _void(self, name: str, attributes: dict[str, str]) -> None:
        if self.hidden:
            return
        if name == "br":
            self.flow.end_line(force=True)
        elif name == "hr":
            self.flow.block(1)
            self.flow.put(["---"])
            self.flow.block(1)
        elif name == "input" and attributes.get("type", "").lower() in ("submit", "button", "reset", "text", "search", ""):
            self.flow.text(attributes.get("value", ""), False)

    def text(self, s: str) -> None:
        if self.hidden or self.svg and self.svg[-1][0] == "svg":
            return
        if self.open and self.open[-1][0] in ("table", "thead", "tbody", "tfoot", "tr", "colgroup") and self.grids:
            if s.strip():  # text in a table outside its cells stands before the table
                self.grids[-1][1].text(s, False)
            return
        self.flow.text(s, self.keep)


def _shown(style: str) -> dict[str, tuple[str, bool]]:
    """The properties display and visibility of a style, with whether they
    are important."""
    out: dict[str, tuple[str, bool]] = {}
    low = style.lower()
    if "display" not in low and "visibility" not in low:
        return out
    for declaration in DECLARATION.findall(STYLE_COMMENT.sub("", low)):
        name, _, value = declaration.partition(":")
        name, value = name.strip(), "".join(value.split())
        first = value.endswith("!important")
        value = value.removesuffix("!important")
        known = value if name == "display" else name == "visibility" and value in (
            "hidden", "collapse", "visible", "initial", "inherit", "unset", "revert")
        if known and (first or not out.get(name, ("", False))[1]):
            out[name] = value, first
    return out


def _number(text: str | None, default: int) -> int:
    m = re.match(r"\s*(-?\d{1,9})", text or "")
    return int(m[1]) if m else default


def render(html: str) -> str:
    """Visible text of a page."""
    sheets = [rest[0] for event, *rest in Scanner(html) if event == "style"] if STYLE_TAG.search(html) else []
    page = Page(Styles(sheets))
    for event, *rest in Scanner(html):
        if event == "text":
            page.text(unescape(rest[0]) if "&" in rest[0] else rest[0])
        elif event == "raw":
            page.text(rest[0])
        elif event == "open":
            page.start(*rest)
        elif event == "close":
            page.end(rest[0])
    while page.open:
        page._pop()
    return "\n".join(page.flow.done())


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Per row: page_id, text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([render(h or "") for h in part.column(1).to_pylist()], pa.string())],
                    ["page_id", "text"])

    return in_arrow(pages.selectExpr(f"cast(`{id_col}` as bigint) as page_id", f"`{html_col}` as html"), run,
                    "page_id long, text string")
