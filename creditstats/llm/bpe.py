"""Byte-pair encoding by backtracking over longest matches, and decoding by
an offset table.

Encoding a piece: an Aho-Corasick automaton over the vocabulary, run once
over the reversed text, gives for every position the longest token that
starts there. A walk takes the longest token; it may stand only if it is
compatible with the token before it, that is, if merging the two's bytes by
the merge rules gives exactly these two tokens again. Otherwise the next
shorter prefix token is tried, and when none is left the walk goes back one
token and marks the position as a dead end, so each position is left at most
once: linear time, and the result is the one the merge rules give. The
compatibility of a pair is computed from the merge table and remembered.

Decoding: the token bytes lie in one buffer; a table of offsets turns ids
into byte ranges, gathered for a whole text at once.

Texts are cut before encoding where white space follows something else; the
tokenizer's own pattern never matches across such a place. Encoded chunks and
pieces are remembered in two bounded generations per worker; this changes no
result. A long piece without a break costs a few bytes of memory a character.

The vocabulary file (the JSON of a byte-level BPE without normalizer) is read
by the driver and broadcast: its size does not depend on the data.

Defined results: null text is empty and gives no ids; special tokens in a
text become their id, as the tokenizer's file says; texts of any length are
encoded whole; repeated rows give repeated results; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import in_arrow, worker_state

# The split pattern of byte-level BPE, and Unicode white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
MEMORY = 350_000  # entries of each of two generations
LONGEST_KEPT = 48
LONG_PIECE = 4096  # characters from which on a piece is worked on in arrays
BATCH_BYTES = 4 << 20
DECODE_IDS = 1 << 18


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary:
    itself if it is printable Latin-1, else the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, free = [], 256
    for b in range(256):
        out.append(chr(b if b in shown else free))
        free += b not in shown
    return out


class Memory(dict):
    """Bounded memory of `make`. When a generation is full it becomes the
    old one; what is asked for again moves to the new one."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, text: str) -> bytes:
        got = self.old.get(text)
        if got is None:
            got = self.make(text)
        if len(text) <= LONGEST_KEPT:
            if len(self) >= MEMORY:
                self.old = self.copy()
                self.clear()
            self[text] = got
        return got

    def rest(self) -> None:
        """Free the old generation; what a worker keeps between tasks is the
        newer one."""
        self.old = {}


class Pairs(dict):
    """Bounded memory of `compatible`, by left << 20 | right."""

    def __init__(self, compatible):
        super().__init__()
        self.compatible = compatible

    def __missing__(self, pair: int) -> bool:
        if len(self) >= MEMORY:
            self.clear()
        self[pair] = found = self.compatible(pair >> 20, pair & 0xFFFFF)
        return found


class Places:
    """A set of places in a long text, one byte a place."""

    def __init__(self, size: int):
        self.held = bytearray(size)

    def add(self, place: int) -> None:
        self.held[place] = 1

    def __contains__(self, place: int) -> bool:
        return self.held[place] == 1


class Tokenizer:
    def __init__(self, spec: str):
        import ahocorasick
        import regex

        data = json.loads(spec)
        model = data["model"]
        if model["type"] != "BPE" or data["normalizer"] is not None or data["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("not a byte-level BPE without normalizer")
        vocab: dict[str, int] = model["vocab"]
        self.chars = byte_characters()
        self.byte_of = {c: b for b, c in enumerate(self.chars)}
        self.table = {b: c for b, c in enumerate(self.chars)}  # str.translate over Latin-1
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        size = max([*vocab.values(), *self.special.values()]) + 1
        texts = [b""] * size
        for t, i in vocab.items():
            texts[i] = bytes(self.byte_of[c] for c in t) if t not in self.special else t.encode()
        for t, i in self.special.items():
            texts[i] = t.encode()
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.offset = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.length = [len(t) for t in texts]

        self.rank, self.halves, self.merge = [-1] * size, [None] * size, {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            t = vocab[a + b]
            if self.rank[t] >= 0:
                raise ValueError("a token with two merges")
            self.rank[t], self.halves[t], self.merge[vocab[a], vocab[b]] = r, (vocab[a], vocab[b]), r
        plain = {t: i for t, i in vocab.items() if i not in self.special.values()}
        # single bytes match everywhere, so they need no automaton
        self.single = {t: i for t, i in plain.items() if len(t) == 1}
        self.automaton = ahocorasick.Automaton()
        for t, i in plain.items():
            if len(t) > 1:
                self.automaton.add_word(t[::-1], i)
        self.automaton.make_automaton()
        self.shorter = [None] * size  # the longest proper prefix that is a token
        for t, i in plain.items():
            self.shorter[i] = next((plain[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in plain), None)

        # \s spelled out, so that no library's own idea of white space counts
        spelled = PATTERN.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")
        self.pattern = regex.compile(spelled)
        self.chunks = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
        self.known = Memory(self._chunk)
        self.pairs = Pairs(self.compatible)

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merge rules leave `left` and `right` as they are when
        they stand side by side. Their merges are undone from the latest on;
        at no time may the two parts at the seam have a merge that comes
        before the one just undone."""
        a, b, until = left, right, len(self.merge)
        while True:
            joined = self.merge.get((a, b))
            if joined is not None and joined < until:
                return False
            if self.rank[a] < 0 and self.rank[b] < 0:
                return True
            if self.rank[a] > self.rank[b]:
                until, a = self.rank[a], self.halves[a][1]
            else:  # of equal merges the left one goes first: the seam's would come before this one
                until, b = self.rank[b] + 1, self.halves[b][0]

    def _longest(self, text: str):
        """Look-up of the longest token that starts at a place, by the place
        counted from the end; no token gives None or 0. The first match that
        the automaton reports at a place is the longest."""
        if not len(self.automaton):
            return {}.get
        if len(text) <= LONG_PIECE:
            return dict([*self.automaton.iter(text[::-1])][::-1]).get
        found, last = array("I", bytes(4 * len(text))), -1
        for place, token in self.automaton.iter(text[::-1]):
            if place != last:
                found[place], last = token, place
        return found.__getitem__

    def _piece(self, piece: str) -> array | list[int]:
        """Ids of one piece of the split pattern."""
        text = (piece if piece.isascii() else piece.encode().decode("latin-1")).translate(self.table)
        n, single = len(text), self.single
        if n == 1:
            return [single[text]]
        longest = self._longest(text)
        token = longest(n - 1) or single[text[0]]
        if token is not None and self.length[token] == n:
            return [token]
        ids = array("I", [token])
        dead = set() if n <= LONG_PIECE else Places(n + 1)
        pairs, length, shorter, at = self.pairs, self.length, self.shorter, self.length[token]
        token = longest(n - 1 - at) or single[text[at]]
        while True:
            seam = ids[-1] << 20 if ids else -1
            while token is not None:
                end = at + length[token]
                if (seam < 0 or pairs[seam | token]) and end not in dead:
                    break
                token = shorter[token]
            if token is not None:
                ids.append(token)
                if end == n:
                    return ids
                at = end
                token = longest(n - 1 - at) or single[text[at]]
            elif ids:
                dead.add(at)
                token = ids.pop()
                at -= length[token]
            else:
                raise ValueError(f"no encoding of {piece!r}")

    def _chunk(self, chunk: str) -> bytes:
        """Packed ids of a chunk: white space and what follows it."""
        pieces = self.pattern.findall(chunk)
        if len(pieces) == 1:
            return array("I", self._piece(chunk)).tobytes()
        return b"".join(map(self.known.__getitem__, pieces))

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text."""
        parts: list[bytes] = []
        for k, segment in enumerate(self.special_cut.split(text) if self.special_cut else [text]):
            if k % 2:
                parts.append(array("I", [self.special[segment]]).tobytes())
            else:
                parts += map(self.known.__getitem__, self.chunks.findall(segment))
        return np.frombuffer(b"".join(parts), np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids, by the offset table."""
        return b"".join(self._bytes(ids[at:at + DECODE_IDS]) for at in range(0, len(ids), DECODE_IDS)).decode("utf-8", "replace")

    def _bytes(self, ids: np.ndarray) -> bytes:
        start = self.offset[ids]
        size = self.offset[ids.astype(np.int64) + 1] - start
        ends = np.cumsum(size)
        at = np.repeat(start - (ends - size), size) + np.arange(ends[-1])
        return self.bytes[at].tobytes()


def loaded(spec: str) -> Tokenizer:
    """The tokenizer of a worker, kept from task to task."""
    return worker_state(f"bpe {hash(spec)}", lambda: Tokenizer(spec))


def _outputs(batches: Iterator[pa.RecordBatch], work, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Apply `work` (row tuple -> row tuple) in output batches of bounded size."""
    out, held = [], 0
    for batch in batches:
        for row in zip(*batch.columns):  # a row at a time: texts may be very long
            made, size = work(tuple(x.as_py() for x in row))
            out.append(made)
            held += size
            if held > BATCH_BYTES:
                yield _batch(out, schema)
                out, held = [], 0
    if out:
        yield _batch(out, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def tokenizer_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def _encoded(t: Tokenizer, row: tuple) -> tuple[tuple, int]:
    ids = t.encode(row[1] or "").astype(np.int32)
    return (row[0], ids), ids.nbytes + 100


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ids (array of int)."""
    spec = docs.sparkSession.sparkContext.broadcast(tokenizer_spec(path))

    def run(batches):
        t = loaded(spec.value)

        yield from _outputs(batches, lambda row: _encoded(t, row), ENCODED)
        t.known.rest()

    return in_arrow(docs.selectExpr(f"cast(`{id_col}` as bigint)", f"`{text_col}`"), run, "doc_id long, ids array<int>")


def _decoded(t: Tokenizer, ids: pa.Array) -> pa.Array:
    flat, ends = ids.flatten().to_numpy(), np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy())
    return pa.array([t.decode(x) for x in np.split(flat, ends[:-1])], pa.string())


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id, ids -> doc_id, ids, text."""
    spec = tokens.sparkSession.sparkContext.broadcast(tokenizer_spec(path))

    def run(batches):
        t = loaded(spec.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), _decoded(t, part.column(1))],
                                                 ["doc_id", "ids", "text"])

    return in_arrow(tokens.select("doc_id", "ids"), run, "doc_id long, ids array<int>, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """encode, then decode in the same task: doc_id, ids, text."""
    spec = docs.sparkSession.sparkContext.broadcast(tokenizer_spec(path))

    def run(batches):
        t = loaded(spec.value)
        for made in _outputs(batches, lambda row: _encoded(t, row), ENCODED):
            yield pa.RecordBatch.from_arrays([*made.columns, _decoded(t, made.column(1))], ["doc_id", "ids", "text"])
        t.known.rest()

    return in_arrow(docs.selectExpr(f"cast(`{id_col}` as bigint)", f"`{text_col}`"), run,
                    "doc_id long, ids array<int>, text string")
