"""Removal of word passages that repeat across documents.

A word goes when some window of `window` consecutive words that covers it
also starts in a document with a smaller doc_id. Windows are judged on the
input.

1. Anchors. Let D be a difference cover modulo v: every difference modulo v
   is one between two elements of D. Shorter windows of window - v + 1 words
   are hashed only at positions p with p mod v in D. If two documents share a
   whole window, then within its first v positions there is one that is a
   cover position in both, and the anchor there lies inside the window; so
   both documents hold that anchor. With v = 31 and six elements, one
   position in five is hashed.
2. Anchors held by two or more documents mark the windows around them.
3. Extension: the marked windows, and only they, are hashed in full; the
   smallest doc_id of each hash keeps it, the others lose theirs.

Both steps move triples of a hash, a document and its part, and nothing else:
whoever gets a hash back finds its places in the text again. The part is a
32-bit hash of the text and of a salt of the row's place in its file. Hashes
come back to rows by document and part, so rows that share an identifier, or
have none, do not receive each other's; the order of documents is by
identifier alone. Two rows that agree in both would get more hashes than they
need, which are right for either: a decision holds for the identifier.

Hot passages: each task folds what it holds before the shuffle. An anchor
that two rows of one task share is known to be shared, and a window that
a smaller document of the same task holds is known to go; of each hash only
its smallest document is sent on. A passage in a third of all documents thus
sends one pair a task and hash, and no step gathers a group: sorted
partitions are read as streams. The texts are shuffled once and read by both
joins (the exchange is reused). A window that many different texts of one and
the same smallest identifier hold is sent on for each of these texts.

Word sequences are compared by 64-bit hashes of 64-bit word hashes.

Defined results: null text has no words; documents shorter than the window
lose nothing; a passage repeated inside one document only stays; rows with
equal doc_id do not remove each other's words; a null doc_id is smaller than
any other (the smallest 64-bit number stands for it); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, in_arrow, with_locator
from .words import WordHashes, batches_of, word_hashes, runs, window_hashes, words

# Perfect difference sets, period to elements.
COVERS = {1: (0,), 3: (0, 1), 7: (1, 2, 4), 13: (0, 1, 3, 9), 31: (1, 5, 11, 24, 25, 27)}
NO_ID = -(1 << 63)
HELD = 1_000_000
# Rows that are equal in identifier and text are dealt over so many parts.
SALTS = 64
# key: a hash, with the document and part sent on for it; or null, with the packed hashes settled for them
FOUND = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("part", pa.int32()), ("keys", pa.binary())])
FOUND_TYPE = "key long, doc long, part int, keys binary"


def cover_for(window: int) -> tuple[int, np.ndarray]:
    """(period, elements): the longest period that leaves anchors of at
    least a third of the window."""
    period = max(v for v in COVERS if 3 * (window - v + 1) >= window)
    inside = np.zeros(period, bool)
    inside[list(COVERS[period])] = True
    return period, inside


class Texts:
    """Word hashes of some documents, joined, with the bounds of each."""

    def __init__(self, texts: list, known: WordHashes):
        listed = [list(map(known.__getitem__, words(t))) for t in texts]
        self.size = np.array([len(x) for x in listed], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.hashes = np.array([h for x in listed for h in x], np.uint64)
        self.doc = np.repeat(np.arange(len(texts)), self.size)
        self.at = np.arange(len(self.hashes)) - self.begin[self.doc]


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _packed(key: np.ndarray, doc: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    """Settled triples as one record a document and part."""
    order = np.lexsort((part, doc))
    key, doc, part = key[order], doc[order], part[order]
    begin = np.flatnonzero(_changes(doc, part))
    ends = np.concatenate([begin, [len(doc)]]).astype(np.int32) * 8
    keys = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(key))])
    return pa.RecordBatch.from_arrays([pa.nulls(len(begin), pa.int64()), pa.array(doc[begin]), pa.array(part[begin]), keys],
                                      schema=FOUND)


def _folded(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]], shared: bool) -> Iterator[pa.RecordBatch]:
    """What a task sends on of the triples (hash, document, part) it holds.

    With `shared`, a hash of several rows is settled for all of them, and its
    first row stands for the others. Without, a hash is settled for those who
    have a smaller document, and the smallest document's rows are sent on."""
    key, doc, part = map(np.concatenate, zip(*held))
    if not len(key):
        return
    order = np.lexsort((part, doc, key))
    key, doc, part = key[order].view(np.int64), doc[order], part[order]
    new = _changes(key, doc, part)
    key, doc, part = key[new], doc[new], part[new]
    begin, run = runs(key)
    if shared:
        settled = (np.diff(np.concatenate([begin, [len(key)]])) > 1)[run]
        sent = begin
    else:
        settled = doc > doc[begin][run]
        sent = np.flatnonzero(~settled)
    if settled.any():
        yield _packed(key[settled], doc[settled], part[settled])
    yield pa.RecordBatch.from_arrays([pa.array(key[sent]), pa.array(doc[sent]), pa.array(part[sent]),
                                      pa.nulls(len(sent), pa.binary())], schema=FOUND)


def _settle(found: DataFrame, shared: bool) -> DataFrame:
    """(doc, part, keys): with `shared` every hash of a row that another row
    holds too, without it every hash that a smaller document holds."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, least, told = None, (0, 0), False  # of the run that may go on: its hash, first row, if that is out
        for batch in batches:
            ready = pc.is_null(batch.column(0))
            if pc.any(ready).as_py():
                yield batch.filter(ready)
                batch = batch.filter(pc.invert(ready))
            if not batch.num_rows:
                continue
            key, doc, part = (batch.column(i).to_numpy() for i in range(3))
            begin, run = runs(key)
            first, its_part = doc[begin].copy(), part[begin].copy()
            if key[0] == last:
                first[0], its_part[0] = least
            out = doc > first[run]
            if shared:
                out |= part != its_part[run]
            out &= _changes(key, doc, part)
            keys, docs, parts = key[out], doc[out], part[out]
            if shared:
                many = np.zeros(len(begin), bool)
                many[run[out]] = True
                say = many.copy()
                if key[0] == last:
                    say[0] &= not told
                    told = told or many[0]
                keys, docs, parts = (np.concatenate([x, y[say]]) for x, y in
                                     ((keys, key[begin]), (docs, first), (parts, its_part)))
                told = bool(many[-1]) if len(begin) > 1 or key[0] != last else told
            last, least = key[-1], (first[-1], its_part[-1])
            if len(keys):
                yield _packed(keys, docs, parts)

    spread = F.coalesce("key", F.xxhash64("doc", "part"))  # settled triples pass through the same exchange
    dealt = found.repartition(spread).sortWithinPartitions("key", "doc", "part")
    return in_arrow(dealt, judge, FOUND_TYPE).groupBy("doc", "part").agg(F.collect_set("keys").alias("keys"))


def _collect_triples(batches: Iterator[pa.RecordBatch], hashed, shared: bool) -> Iterator[pa.RecordBatch]:
    """Fold the triples that `hashed` finds in rows (doc, part, text, ...)."""
    known, held, count = word_hashes(), [], 0
    for rows in batches_of(batches, 2):
        t = Texts([r[2] for r in rows], known)
        hashes, at = hashed(t, rows)
        whose = t.doc[at]
        held.append((hashes, np.array([r[0] for r in rows], np.int64)[whose], np.array([r[1] for r in rows], np.int32)[whose]))
        count += len(at)
        if count > HELD:
            yield from _folded(held, shared)
            held, count = [], 0
    if held:
        yield from _folded(held, shared)


def _anchors_of(t: Texts, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the anchors of some texts."""
    period, inside = cover_for(window)
    size = window - period + 1
    hashes = window_hashes(t.hashes, size)
    at, doc = t.at[:len(hashes)], t.doc[:len(hashes)]
    place = np.flatnonzero(inside[at % period] & (at + size <= t.size[doc]) & (t.size[doc] >= window))
    return hashes[place], place


def _shared_anchors(rows: DataFrame, window: int) -> DataFrame:
    """(doc, part, keys): anchors that two rows or more hold."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _collect_triples(batches, lambda t, _: _anchors_of(t, window), shared=True)

    return _settle(in_arrow(rows.select("doc", "part", "text"), find, FOUND_TYPE), shared=True)


def _windows_to_remove(marked: DataFrame, window: int) -> DataFrame:
    """(doc, part, keys): windows that a smaller document holds. marked: doc,
    part, text, keys (packed anchors that it shares)."""
    period, _ = cover_for(window)

    def around(t: Texts, rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        hashes, place = _anchors_of(t, window)
        change = np.zeros(len(t.hashes) + 1, np.int64)
        bounds = np.searchsorted(place, np.concatenate([t.begin, [len(t.hashes)]]))
        for d, r in enumerate(rows):
            mine = slice(bounds[d], bounds[d + 1])
            shared = place[mine][np.isin(hashes[mine], np.frombuffer(b"".join(r[3]), np.uint64))]
            np.add.at(change, np.maximum(t.begin[d], shared - period + 1), 1)
            np.add.at(change, shared + 1, -1)
        whole = window_hashes(t.hashes, window)
        n = len(whole)
        at = np.flatnonzero((np.cumsum(change)[:n] > 0) & (t.at[:n] + window <= t.size[t.doc[:n]]))
        return whole[at], at

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _collect_triples(batches, around, shared=False)

    return _settle(in_arrow(marked.select("doc", "part", "text", "keys"), find, FOUND_TYPE), shared=False)


def dedup_substrings(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_text (kept words joined by
    one space), removed (array of struct begin, end: half-open word ranges)."""
    id_ = F.col(id_col).cast("long")
    at = free_name(docs, "_at")
    salt = F.pmod(F.xxhash64(f"{at}.file", f"{at}.row"), F.lit(SALTS))
    # both joins read the same three columns, so they share one exchange
    rows = with_locator(docs.select(id_col, text_col), at).select(
        F.coalesce(id_, F.lit(NO_ID)).alias("doc"), F.hash(F.col(text_col), salt).alias("part"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    anchors = _shared_anchors(rows, window)
    removed = _windows_to_remove(rows.join(anchors, ["doc", "part"]), window)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_hashes()
        for part in batches_of(batches, 1):
            out = []
            for doc, text, keys in part:
                listed = words(text)
                gone = np.zeros(len(listed), bool)
                if keys:
                    hashes = window_hashes(Texts([text], known).hashes, window)
                    at = np.flatnonzero(np.isin(hashes, np.frombuffer(b"".join(keys), np.uint64)))
                    change = np.zeros(len(listed) + 1, np.int64)
                    np.add.at(change, at, 1)
                    np.add.at(change, at + window, -1)
                    gone = np.cumsum(change)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                kept = b" ".join(compress(listed, (~gone).tolist()) if keys else listed)
                out.append((None if doc == NO_ID else doc, len(listed), int(gone.sum()), kept.decode(),
                            [{"begin": int(b), "end": int(e)} for b, e in edge.reshape(-1, 2)]))
            columns = list(zip(*out))
            span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), span))],
                ["doc_id", "n_words", "n_removed", "kept_text", "removed"])

    whole = rows.join(removed, ["doc", "part"], "left").select("doc", "text", "keys")
    return in_arrow(whole, cut, "doc_id long, n_words long, n_removed long, kept_text string, "
                                "removed array<struct<begin: long, end: long>>")
