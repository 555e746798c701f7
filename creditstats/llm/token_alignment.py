"""Alignment of two tokenizers' tokens by an associative fragment monoid.

The same bytes (a space and the text) are cut into tokens by a byte-level BPE
(A) and a sentencepiece BPE (B). Offsets where tokens of both end cut the
tokens into groups; the two tokens that end at a cut are linked.

1. A fragment covers consecutive A tokens and consecutive B tokens. What it
   knows is closed between its first and its last cut: groups there are final
   and only their digits, counts and links are kept. The tokens up to the
   first cut are its open prefix, those after the last one its open suffix; a
   fragment without a cut is open as a whole.
2. Two neighbours compose: new cuts can only lie among the left suffix and
   the right prefix, so these alone are aligned, and what they close becomes a
   seam between the two. Composition is associative.
3. A text of more than SPLIT characters is cut at about every SPLIT characters
   into chunks that lie in rows, and so in tasks, of their own. Each tokenizer
   moves a boundary to the next place that none of its tokens crosses: A where
   white space follows something else, B at a single space between others. The
   two places may differ, which leaves tokens open. Chunks of one text are
   composed by a tree of FAN neighbours a round; only open tokens travel.
   Shorter texts are composed of units: a unit runs from one single space
   between others to the next, and both tokenizers cut there, so its groups,
   digits and links are closed. Of the units of a block of texts each distinct
   one is aligned once.
4. The digits of all groups of a text are hashed in their order by a stream
   over its closed parts and seams, so no task holds a long text's groups.
5. Links are counted over the corpus by id pair. The HOT most common pairs (a
   fixed number) are sent to the tasks, which add them up by text without a
   shuffle; the others are joined by pair. So common pairs crowd no task.

Tokens of units are remembered in two bounded generations per worker, and new
units are encoded RUN at a time as one text, whose tokens must give back its
bytes and end where the units end; else each is encoded alone. Neither changes
a result.

Defined results: null and empty texts, and texts whose joined token bytes of A
or B are not space + text, have no tokens: all counts 0, digest ''; their
links count nowhere. Special tokens in a text are plain text. Repeated rows
and identifiers, null ones too, are rows of their own. An empty table gives no
rows. Other columns, whatever their names, are not read. A stretch without any
place to cut (letters without a break) is encoded in one task.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count as counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .bpe import LONGEST_KEPT, MEMORY, SPACE, byte_characters
from .common import in_arrow, staged, worker_state

SPLIT = 1 << 15        # characters of a chunk, about
FAN = 8                # neighbours composed at once
HOT = 1 << 16          # id pairs sent to all tasks
OUT_BYTES = 4 << 20
BLOCK = 1 << 21        # characters of texts aligned together, about
RUN = 128              # new units encoded as one text
B_MARK = 1 << 31       # added to packed B ids
A_CUT = re.compile(f"(?<=[^{SPACE}])(?=[{SPACE}])")
B_CUT = re.compile(r"(?<=\S) (?=\S)")
WHITE = np.array([chr(i).isspace() and i < 128 for i in range(256)])
WIDE = re.compile(b"|".join(re.escape(c.encode()) for c in map(chr, range(128, 0x3001)) if c.isspace()))  # the other white space


# ---- the monoid


@dataclass
class Tokens:
    """Ids of tokens of both sides and the byte offsets where they end."""
    a: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_end: np.ndarray

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate(x) for x in zip(self.columns(), other.columns())))

    def columns(self) -> tuple[np.ndarray, ...]:
        return self.a, self.a_end, self.b, self.b_end

    def between(self, a0: int, a1: int | None, b0: int, b1: int | None) -> Tokens:
        return Tokens(self.a[a0:a1], self.a_end[a0:a1], self.b[b0:b1], self.b_end[b0:b1])

    def cuts(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the A tokens and of the B tokens that end together."""
        if not len(self.a) or not len(self.b):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.b_end, self.a_end), len(self.b) - 1)
        same = np.flatnonzero(self.b_end[at] == self.a_end)
        return same, at[same]


NOTHING = Tokens(*(np.empty(0, np.int64),) * 4)


@dataclass
class Fragment:
    cut: bool
    prefix: Tokens   # up to the first cut; all tokens if there is none
    suffix: Tokens   # after the last cut


def split(tokens: Tokens, opened: bool) -> tuple[Tokens, Tokens, Tokens, bool]:
    """(open prefix, closed tokens, open suffix, has a cut). With `opened` the
    tokens follow a cut, so there is no prefix."""
    a, b = tokens.cuts()
    if not len(a):
        return (NOTHING, NOTHING, tokens, False) if opened else (tokens, NOTHING, NOTHING, False)
    first = (0, 0) if opened else (a[0] + 1, b[0] + 1)
    return (tokens.between(0, first[0], 0, first[1]), tokens.between(first[0], a[-1] + 1, first[1], b[-1] + 1),
            tokens.between(a[-1] + 1, None, b[-1] + 1, None), True)


def fragment(tokens: Tokens) -> tuple[Fragment, Tokens]:
    """A fragment and its closed tokens."""
    prefix, closed, suffix, cut = split(tokens, False)
    return Fragment(cut, prefix, suffix), closed


def compose(left: Fragment, right: Fragment) -> tuple[Fragment, Tokens]:
    """The fragment of both, and the tokens that the seam closes."""
    middle = (left.suffix if left.cut else left.prefix) + right.prefix
    prefix, seam, suffix, cut = split(middle, left.cut)
    if left.cut:
        prefix = left.prefix
    if right.cut:  # its prefix ends with a cut, so nothing of `middle` stays open
        suffix = right.suffix
    return Fragment(left.cut or cut, prefix, suffix), seam


# ---- digits and links of closed tokens


class Digits:
    """Decimal ids with what follows them: a comma, a bar or a semicolon."""

    def __init__(self, size: int):
        self.size = size
        self.text = pa.array([b"%d%s" % (i, end) for end in (b",", b"|", b";") for i in range(size)], pa.large_binary())

    def parts(self, closed: Tokens) -> pa.LargeBinaryArray:
        """A token each of `a1,a2|b1;a3|b2,b3;`, of tokens that end with a cut."""
        a_at, b_at = closed.cuts()
        a, b = closed.a.copy(), closed.b.copy()
        a[a_at] += self.size
        b[b_at] += 2 * self.size
        # a token's place: the tokens of its side before it and those of the other side's groups before it
        groups = len(a_at)
        a_group = np.repeat(np.arange(groups), np.diff(a_at, prepend=-1))
        b_group = np.repeat(np.arange(groups), np.diff(b_at, prepend=-1))
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + np.concatenate([[0], b_at + 1])[a_group]] = a
        out[np.arange(len(b)) + (a_at + 1)[b_group]] = b
        return self.text.take(pa.array(out))

    def of(self, closed: Tokens) -> bytes:
        """`a1,a2|b1;a3|b2,b3` of tokens that end with a cut."""
        return _content(self.parts(closed))[1][:-1].tobytes() if len(closed.a) else b""


def _content(texts: pa.LargeBinaryArray) -> tuple[np.ndarray, memoryview]:
    """Offsets and bytes of an array that was just made."""
    _, offsets, data = texts.buffers()
    return np.frombuffer(offsets, np.int64)[:len(texts) + 1], memoryview(data or b"").cast("B")


def linked(closed: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Distinct linked id pairs (B id << 32 | A id) and how often each is linked."""
    a, b = closed.cuts()
    return np.unique(closed.b[b].astype(np.int64) << 32 | closed.a[a].astype(np.int64), return_counts=True)


# ---- tokenizers


def unit_offsets(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Byte offsets where units begin, those of the texts among them, and the end."""
    byte = np.frombuffer(data, np.uint8)
    white = WHITE[byte]
    for m in WIDE.finditer(data):
        white[m.start():m.end()] = True
    at = np.flatnonzero(byte[1:-1] == 32) + 1
    begins = np.zeros(len(byte) + 1, bool)
    begins[at[~(white[at - 1] | white[at + 1])]] = True
    begins[starts] = begins[-1] = True
    return np.flatnonzero(begins)


def distinct(data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The number of each unit's text, and the texts."""
    units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = units.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


def places(size: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Where the items of lists `number` are among those of all lists, which have `size` items."""
    n = size[number]
    return np.repeat((np.cumsum(size) - size)[number] - (np.cumsum(n) - n), n) + np.arange(n.sum())


class Side:
    """One tokenizer. `encode` gives ids of a text that begins with white space; `mark` is put on them."""

    def __init__(self, encode: Callable[[str], list[int]], token_bytes: list[bytes], mark: int):
        self.encode, self.bytes, self.mark = encode, token_bytes, mark
        self.length = np.array([len(t) for t in token_bytes], np.int64)

    def ids(self, units: list[bytes]) -> list[bytes]:
        """Packed ids of units; none for a unit whose tokens do not give its bytes back."""
        return [x for at in range(0, len(units), RUN) for x in self._run(units[at:at + RUN])]

    def _run(self, units: list[bytes]) -> list[bytes]:
        """All as one text: merges never cross a place that no token crosses
        in the end, so a unit between two such places has its own tokens."""
        data = b"".join(units)
        ids = self.encode(data.decode())
        if b"".join(map(self.bytes.__getitem__, ids)) == data:
            ids = np.array(ids, np.uint32)
            ends, unit_ends = np.cumsum(self.length[ids]), np.cumsum(list(map(len, units)))
            last = np.searchsorted(ends, unit_ends)
            if (ends[last] == unit_ends).all():
                packed, to = (ids | np.uint32(self.mark)).tobytes(), (4 * (last + 1)).tolist()
                return [packed[x:y] for x, y in zip([0, *to], to)]
        return [x for u in units for x in self._run([u])] if len(units) > 1 else [b""]


@dataclass
class Aligned:
    """What is known of whole texts; `pairs` are the linked id pairs text after
    text, `times` how often each is linked in its text."""
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    sha: list[str]
    n_pairs: np.ndarray
    pairs: np.ndarray
    times: np.ndarray


class Pair:
    """Both tokenizers of a worker."""

    def __init__(self, a_spec: str, b_model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        a = Tokenizer.from_str(a_spec)
        a.encode_special_tokens = True
        a.no_truncation()
        a.no_padding()
        b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        a_size, b_size = a.get_vocab_size(), b.get_piece_size()
        a_bytes = [b""] * a_size
        for t, i in a.get_vocab().items():
            a_bytes[i] = bytes(map(byte_of.__getitem__, t)) if all(c in byte_of for c in t) else t.encode()
        b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in enumerate(map(b.id_to_piece, range(b_size)))]
        self.digits = Digits(max(a_size, b_size))
        self.a = Side(lambda text: a.encode_batch_fast([text], add_special_tokens=False)[0].ids, a_bytes, 0)
        self.b = Side(lambda text: b.encode(text[1:]), b_bytes, B_MARK)  # which adds a space
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def ids(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct units -> their A ids one after the other and how many each
        has, the same of B. A unit that a side loses bytes of has no ids there."""
        got = list(map(self.new.get, units))
        asked = [i for i, x in enumerate(got) if x is None]
        for i in asked:
            got[i] = self.old.get(units[i])
        fresh = [i for i in asked if got[i] is None]
        made = [units[i] for i in fresh]
        for i, a, b in zip(fresh, self.a.ids(made), self.b.ids(made)):
            got[i] = a + b
        if len(self.new) >= MEMORY:
            self.old, self.new = self.new, {}
        self.new |= {units[i]: got[i] for i in asked if len(units[i]) <= LONGEST_KEPT}
        ids, size = np.frombuffer(b"".join(got), np.uint32), np.array(list(map(len, got)), np.int64) // 4
        of_b = ids >= B_MARK
        n_b = np.bincount(np.repeat(np.arange(len(units)), size)[of_b], minlength=len(units))
        return ids[~of_b].astype(np.int64), size - n_b, (ids[of_b] - np.uint32(B_MARK)).astype(np.int64), n_b

    def _part(self, part: str) -> tuple[np.ndarray | None, np.ndarray | None]:
        """A ids and B ids of a part of a text; None for a side that loses bytes."""
        data = part.encode()
        number, units = distinct(data, unit_offsets(data, np.zeros(min(len(data), 1), np.int64)))
        a, n_a, b, n_b = self.ids(units)
        return tuple(ids[places(n, number)] if n.all() else None for ids, n in ((a, n_a), (b, n_b)))

    def tokens(self, a_part: str, a_from: int, b_part: str, b_from: int) -> Tokens | None:
        """Tokens of the A part and of the B part (which begins with a space),
        from their byte offsets on; None if bytes are lost."""
        a, b = self._part(a_part)
        if a_part != b_part:
            _, b = self._part(b_part)
        if a is None or b is None:
            return None
        return Tokens(a, a_from + np.cumsum(self.a.length[a]), b, b_from + np.cumsum(self.b.length[b]))

    def texts(self, texts: list[str | None]) -> Aligned:
        """Whole texts, by their units."""
        data = [(" " + t).encode() if t else b"" for t in texts]
        end = np.cumsum([len(x) for x in data])
        start = np.concatenate([[0], end[:-1]])
        data = b"".join(data)
        offsets = unit_offsets(data, start[start < end])
        number, units = distinct(data, offsets)
        first, last = np.searchsorted(offsets, start), np.searchsorted(offsets, end)

        def summed(of_unit: np.ndarray) -> np.ndarray:
            upto = np.concatenate([[0], np.cumsum(of_unit[number])])
            return upto[last] - upto[first]

        # the distinct units, as if they were one text
        a, n_a, b, n_b = self.ids(units)
        lost = (n_a == 0) | (n_b == 0)
        if lost.any():
            a, b = (ids[np.repeat(~lost, n)] for ids, n in ((a, n_a), (b, n_b)))
            n_a, n_b = np.where(lost, 0, n_a), np.where(lost, 0, n_b)
        tokens = Tokens(a, np.cumsum(self.a.length[a]), b, np.cumsum(self.b.length[b]))
        a_at, b_at = tokens.cuts()
        n_groups = np.bincount(np.repeat(np.arange(len(units)), n_a)[a_at], minlength=len(units))
        pair, of_group = np.unique(tokens.b[b_at] << 32 | tokens.a[a_at], return_inverse=True)
        good = (start < end) & (summed(lost.astype(np.int64)) == 0)

        ends, digits = _content(self.digits.parts(tokens))
        ends = ends[np.concatenate([[0], np.cumsum(n_a + n_b)])]
        ends, digits = _content(pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(units), [None, pa.py_buffer(ends), pa.py_buffer(digits)]).take(pa.array(number)))
        sha = [hashlib.sha256(digits[ends[x]:ends[y] - 1]).hexdigest() if ok else "" for x, y, ok in zip(first, last, good)]

        link = np.repeat(np.arange(len(texts)), summed(n_groups)) << 32 | of_group[places(n_groups, number)]
        link = link[good[link >> 32]]
        link.sort()
        at = np.flatnonzero(np.diff(link, prepend=-1))
        return Aligned(*(np.where(good, summed(x), 0) for x in (n_a, n_b, n_groups)), sha,
                       np.bincount(link[at] >> 32, minlength=len(texts)), pair[link[at] & 0xFFFFFFFF], np.diff(at, append=len(link)))

    def rest(self) -> None:
        """Free the old generation; what a worker keeps between tasks is the
        newer one."""
        self.old = {}


# ---- in tasks


COUNTS = "n_a long, n_b long, n_groups long"
PAIRS = "pairs array<long>, times array<long>"
TOKENS = ", ".join(f"{part}_{side} array<long>" for part in ("prefix", "suffix") for side in ("a", "a_end", "b", "b_end"))
WHOLE = f"text_no long, doc_id long, ok boolean, {COUNTS}, sha string, {PAIRS}"
CHUNKS = "text_no long, doc_id long, chunk long, part string, a0 long, a1 long, b0 long, b1 long, a_from long, b_from long"
# kind: 'fragment' (chunks first to last; open tokens) or 'seam'. Digits are in order of `place`, twice the chunk's number.
PARTS = f"text_no long, doc_id long, kind string, first long, ok boolean, {COUNTS}, place long, digits binary, {PAIRS}, cut boolean, {TOKENS}"


def _batches(rows: Iterator[tuple[tuple, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows with their sizes in batches of bounded size."""
    held, size = [], 0
    for row, n in rows:
        held.append(row)
        size += n
        if size >= OUT_BYTES or len(held) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _numbers() -> Iterator[int]:
    """Numbers that no other task gives."""
    return counter(TaskContext.get().partitionId() << 33)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), (t.as_py() for t in batch.column(1)))


def _blocks(texts: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows of about BLOCK characters."""
    held, size = [], 0
    for row in texts:
        held.append(row)
        size += len(row[1] or "")
        if size >= BLOCK or len(held) >= 4000:
            yield held
            held, size = [], 0
    if held:
        yield held


class Aligner:
    """The two tokenizers' files, sent to the tasks: their sizes do not depend on the data."""

    def __init__(self, spark, a_path: str, b_path: str):
        with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
            self.sent = spark.sparkContext.broadcast((a.read(), b.read()))
        self.schemas = {ddl: to_arrow_schema(StructType.fromDDL(ddl)) for ddl in (WHOLE, CHUNKS, PARTS)}

    def __getstate__(self):
        return {"sent": self.sent, "schemas": self.schemas}

    def loaded(self) -> Pair:
        return worker_state("token alignment", lambda: Pair(*self.sent.value))

    def whole(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """doc_id, text -> WHOLE."""
        pair, numbers, schema = self.loaded(), _numbers(), self.schemas[WHOLE]
        for rows in _blocks(_texts(batches)):
            doc_ids, texts = zip(*rows)
            made = pair.texts(texts)
            ends = np.concatenate([[0], np.cumsum(made.n_pairs)]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (made.pairs, made.times)]
            columns = [[2 * next(numbers) for _ in rows], doc_ids, [True] * len(rows), made.n_a, made.n_b, made.n_groups, made.sha]
            block = pa.RecordBatch.from_arrays([*(pa.array(c, f.type) for c, f in zip(columns, schema)),
                                                *(x.cast(f.type) for x, f in zip(lists, list(schema)[-2:]))], schema=schema)
            for at in range(0, len(rows), 250):
                yield block.slice(at, 250)
        pair.rest()

    def cut(self, batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
        """doc_id, text -> CHUNKS of about `size` characters."""
        numbers = _numbers()

        def made() -> Iterator[tuple[tuple, int]]:
            for doc_id, text in _texts(batches):
                full, number = " " + text, 2 * next(numbers) + 1
                a0 = b0 = low_bytes = chunk = 0
                for nominal in [*range(size, len(full), size), None]:
                    a1, b1 = (len(full) if nominal is None or not (m := cut.search(full, max(nominal, x))) else m.start()
                              for cut, x in ((A_CUT, a0), (B_CUT, b0)))
                    low, high = min(a0, b0), max(a1, b1)
                    if a1 > a0 or b1 > b0:
                        a_from, b_from = (low_bytes + len(full[low:x].encode()) for x in (a0, b0))
                        yield (number, doc_id, chunk, full[low:high], a0 - low, a1 - low, b0 - low, b1 - low, a_from, b_from), 4 * (high - low)
                        chunk += 1
                    a0, b0 = a1, b1
                    low_bytes += len(full[low:min(a0, b0)].encode())

        yield from _batches(made(), self.schemas[CHUNKS])

    def chunks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """CHUNKS -> PARTS."""
        pair = self.loaded()

        def made() -> Iterator[tuple[tuple, int]]:
            for batch in batches:
                for number, doc_id, chunk, part, a0, a1, b0, b1, a_from, b_from in zip(*(c.to_pylist() for c in batch.columns)):
                    tokens = pair.tokens(part[a0:a1], a_from, part[b0:b1], b_from)
                    whole, closed = fragment(tokens or NOTHING)
                    digits, (pairs, times) = pair.digits.of(closed), linked(closed)
                    yield ((number, doc_id, "fragment", chunk, tokens is not None, len((tokens or NOTHING).a), len((tokens or NOTHING).b),
                            int(times.sum()), 2 * chunk, digits, pairs, times, whole.cut, *whole.prefix.columns(), *whole.suffix.columns()),
                           len(digits) + 16 * len(pairs) + 32 * (len(whole.prefix.a) + len(whole.suffix.a)))

        yield from _batches(made(), self.schemas[PARTS])
        pair.rest()

    def composed(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Open fragments sorted by text_no, block, first -> PARTS: one
        fragment a block without digits, and the seams."""
        pair = self.loaded()

        def made() -> Iterator[tuple[tuple, int]]:
            key = now = doc_id = None
            first, ok = 0, True
            for batch in batches:
                for row in batch.to_pylist():
                    right = Fragment(row["cut"], *(Tokens(*(np.array(row[f"{p}_{s}"], np.int64) for s in ("a", "a_end", "b", "b_end")))
                                                   for p in ("prefix", "suffix")))
                    if key != (row["text_no"], row["block"]):
                        if now is not None:
                            yield _open(key[0], doc_id, first, ok, now)
                        key, doc_id, first, ok, now = (row["text_no"], row["block"]), row["doc_id"], row["first"], row["ok"], right
                        continue
                    ok = ok and row["ok"]
                    now, seam = compose(now, right)
                    if len(seam.a):
                        yield _closed(pair, key[0], doc_id, 2 * row["first"] - 1, seam)
            if now is not None:
                yield _open(key[0], doc_id, first, ok, now)

        yield from _batches(made(), self.schemas[PARTS])

    def ends(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A whole text's fragment -> its first group, as a seam before all."""
        pair = self.loaded()

        def made() -> Iterator[tuple[tuple, int]]:
            for batch in batches:
                for row in batch.to_pylist():
                    first = Tokens(*(np.array(row[f"prefix_{s}"], np.int64) for s in ("a", "a_end", "b", "b_end")))
                    if row["cut"]:
                        yield _closed(pair, row["text_no"], row["doc_id"], -1, first)

        yield from _batches(made(), self.schemas[PARTS])


def _open(number: int, doc_id: int | None, first: int, ok: bool, whole: Fragment) -> tuple[tuple, int]:
    return ((number, doc_id, "fragment", first, ok, 0, 0, 0, 2 * first, b"", [], [], whole.cut,
             *whole.prefix.columns(), *whole.suffix.columns()), 32 * (len(whole.prefix.a) + len(whole.suffix.a)) + 100)


def _closed(pair: Pair, number: int, doc_id: int | None, place: int, seam: Tokens) -> tuple[tuple, int]:
    digits, (pairs, times) = pair.digits.of(seam), linked(seam)
    return ((number, doc_id, "seam", None, None, 0, 0, int(times.sum()), place, digits, pairs, times, None, *([],) * 8),
            len(digits) + 16 * len(pairs))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digits sorted by text_no and place -> text_no, sha."""
    number, state = None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([state.hexdigest()])], ["text_no", "sha"])

    for batch in batches:
        for text_no, digits in zip(batch.column(0).to_pylist(), (d.as_py() for d in batch.column(2))):
            if text_no == number:
                state.update(b";")
            else:
                if state is not None:
                    yield out()
                number, state = text_no, hashlib.sha256()
            state.update(digits)
    if state is not None:
        yield out()


# ---- the operator


def align(docs: DataFrame, a_path: str, b_path: str, size: int = SPLIT, fan: int = FAN, hot: int = HOT,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: text_no (unique), doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256."""
    aligner = Aligner(docs.sparkSession, a_path, b_path)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    is_long = F.coalesce(F.length("text") > size, F.lit(False))
    whole = staged(in_arrow(rows.where(~is_long), aligner.whole, WHOLE), "align-whole")
    cut = staged(in_arrow(rows.where(is_long), lambda b: aligner.cut(b, size), CHUNKS), "align-chunks")
    texts, parts = _long_texts(aligner, cut, fan)
    texts = whole.select("text_no", "doc_id", "n_a", "n_b", "n_groups", "sha").unionByName(texts)
    links = whole.select("text_no", "pairs", "times").unionByName(parts)
    counted = _counted(links, hot)
    return texts.join(counted, "text_no", "left").select(
        "text_no", "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")], F.col("sha").alias("groups_sha256"))


def _long_texts(aligner: Aligner, cut: DataFrame, fan: int) -> tuple[DataFrame, DataFrame]:
    """(text_no, doc_id, counts, sha of each long text; links of its parts)."""
    parts = staged(in_arrow(cut.repartition("text_no", "chunk"), aligner.chunks, PARTS), "align-parts")
    open_, closed, n = parts, parts, (parts.agg(F.max("first")).first()[0] or 0) + 1
    step = 1
    while step < n:
        step *= fan
        block = F.floor(F.col("first") / step).alias("block")
        near = open_.where("kind = 'fragment'").select("*", block).repartition("text_no", "block").sortWithinPartitions("text_no", "block", "first")
        open_ = staged(in_arrow(near, aligner.composed, PARTS), "align-composed")
        closed = closed.unionByName(open_.where("kind = 'seam'"))
    last = open_.where("kind = 'fragment'")
    closed = staged(closed.unionByName(in_arrow(last, aligner.ends, PARTS)).select(
        "text_no", "doc_id", "place", "digits", "n_a", "n_b", "n_groups", "pairs", "times"), "align-closed")
    good = last.where("ok").select("text_no")
    digits = (closed.where(F.octet_length("digits") > 0).select("text_no", "place", "digits")
              .repartition("text_no").sortWithinPartitions("text_no", "place"))
    sha = in_arrow(digits, _hashed, "text_no long, sha string").join(good, "text_no")
    sums = closed.groupBy("text_no").agg(F.max("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups")])
    texts = sums.join(sha, "text_no", "left").select(
        "text_no", "doc_id", *[F.when(F.col("sha").isNull(), F.lit(0)).otherwise(F.col(c)).cast("long").alias(c)
                               for c in ("n_a", "n_b", "n_groups")], F.coalesce("sha", F.lit("")).alias("sha"))
    return texts, closed.join(good, "text_no").select("text_no", "pairs", "times")


def pair_counts(links: DataFrame) -> DataFrame:
    """Per id pair: pair, n (links corpus-wide), best (its B id has no pair
    with more)."""
    n = links.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n"))
    n = staged(n, "align-pairs")
    b = F.shiftright("pair", 32).alias("b")
    most = n.groupBy(b).agg(F.max("n").alias("most"))
    return n.select("pair", "n", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _counted(links: DataFrame, hot: int) -> DataFrame:
    """text_no, n_best, count_sum. The `hot` most common pairs are added up
    in the task that reads them, the others by a join."""
    known = staged(pair_counts(links), "align-counts")
    table = known.orderBy(F.desc("n"), "pair").limit(hot).toArrow()  # at most `hot` rows
    order = np.argsort(table.column("pair").to_numpy())
    sent = links.sparkSession.sparkContext.broadcast(tuple(
        table.column(c).to_numpy()[order] for c in ("pair", "n", "best")))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                number = part.column(0).to_numpy()
                of = np.repeat(np.arange(part.num_rows), part.column(1).value_lengths().to_numpy())
                asked, times = (part.column(k).flatten().to_numpy() for k in (1, 2))
                place = np.minimum(np.searchsorted(pair, asked), max(len(pair) - 1, 0))
                found = pair[place] == asked if len(pair) else np.zeros(len(asked), bool)
                sums = [np.zeros(part.num_rows, np.int64) for _ in range(2)]
                for total, each in zip(sums, (best, n)):
                    np.add.at(total, of[found], times[found] * each[place[found]])
                rest = ~found
                # a text's sum so far joins nothing: its pair is no pair of ids, and another one for each text
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (
                        (number, number[of[rest]]), (-1 - number, asked[rest]), (np.zeros(len(number), np.int64), times[rest]),
                        (sums[0], np.zeros(rest.sum(), np.int64)), (sums[1], np.zeros(rest.sum(), np.int64)))],
                    ["text_no", "pair", "times", "n_best", "count_sum"])

    rows = in_arrow(links, add, "text_no long, pair long, times long, n_best long, count_sum long")
    joined = rows.join(known, "pair", "left")
    more = F.col("times") * F.coalesce(F.col("n"), F.lit(0))
    best = F.when(F.col("best"), F.col("times")).otherwise(F.lit(0))
    return joined.groupBy("text_no").agg(F.sum(F.col("n_best") + best).alias("n_best"), F.sum(F.col("count_sum") + more).alias("count_sum"))
