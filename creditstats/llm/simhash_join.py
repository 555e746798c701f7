"""SimHash near-duplicates by the generalised pigeonhole principle.

1. A text's fingerprint has 64 bits: a bit is 1 if it is set in over half of
   the hashes of its word shingles, repeats included.
2. Only distinct fingerprints go on. The counts of all pairs of bits (a fixed
   64 x 64 table) give their correlations; correlated bits are grouped into
   the same part, so that common patterns crowd few parts instead of all.
   Fingerprints are rearranged by that grouping once; distances stay.
3. Two fingerprints within `distance` bits agree, for any thresholds t_i >= -1
   with sum(t_i + 1) = distance + 1, up to t_i bits in at least one part i (else they differ
   in sum(t_i + 1) bits or more). Each fingerprint chooses its own thresholds by dynamic programming: the cost of
   (part, threshold) is the number of its probes and the estimated number of
   candidates they meet, from histograms of 16-bit pieces (4 x 65,536 counts
   over all fingerprints, a fixed size). A part where it shares a very common
   pattern gets -1, no probe; others get more.
   Four parts of 16 bits and two parts of 32 bits are tried; the cheaper
   partition over all fingerprints is used.
4. Probes (all values of a part within its threshold) meet the parts of all
   fingerprints; distances are checked in the same task. A part value shared
   by more than CHUNK fingerprints is cut into chunks by a hash, and each of
   its probes goes to every chunk, so no task holds a whole crowd. Tasks
   return spanning links instead of all pairs.
5. Connected components of the links.

Any thresholds give all links: estimates decide about cost alone.

Defined results: null, empty and blank texts have fingerprint zero and link
like any other; texts of fewer words than a shingle are one shingle. A null
identifier is no component's smallest one, unless it has no other. Repeated
rows and identifiers are rows of their own. An empty table gives no rows. Long texts are
read in blocks. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, staged
from .components import components
from .word_blocks import LOWER, word_blocks

U = np.uint64
BITS, PIECE = 64, 16
SEED = 42
CHUNK = 4096          # fingerprints of one part value that a task meets at once
PROBE_COST = 200      # a probe's row costs as much as so many checks of a candidate
BLOCK = 1 << 21       # candidates checked at once
WIDTHS = (16, 32)


# ---- fingerprints


def fingerprint(text: str | None, shingle: int = 3, seed: int = SEED) -> int:
    from xxhash import xxh64_intdigest

    ones, total, before = np.zeros(BITS, np.int64), 0, []

    def count(hashes: list[int]) -> None:
        nonlocal ones, total
        for at in range(0, len(hashes), 1 << 16):
            bits = np.unpackbits(np.array(hashes[at:at + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)

    for new in word_blocks(text, LOWER):
        words = before + new
        if len(words) >= shingle:
            runs = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
            count([xxh64_intdigest(s, seed) for s in runs])
            words = words[len(words) - shingle + 1:]
        before = words
    if not total and before:
        count([xxh64_intdigest(b" ".join(before), seed)])
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0]) if total else 0


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, fingerprint (long, its bits those of the unsigned number)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)], U)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], ["doc_id", "fingerprint"])

    return in_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run,
                    "doc_id long, fingerprint long")


# ---- parts of correlated bits


def bit_pairs(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and of those with bits i and j both set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            bits = np.unpackbits(batch.column(0).to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += np.rint(bits.T @ bits).astype(np.int64)  # exact: a batch has far fewer rows than 2**24
            n += len(bits)
        at = np.arange(BITS * BITS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(total.ravel(), n))], ["at", "n"])

    out = np.zeros(BITS * BITS + 1, np.int64)
    for at, n in in_arrow(prints.select("fingerprint"), run, "at long, n long").groupBy("at").agg(F.sum("n")).collect():
        out[at] = n
    return int(out[-1]), out[:-1].reshape(BITS, BITS)


def grouped_bits(n: int, both: np.ndarray) -> list[int]:
    """All bits in an order in which each run of PIECE bits is a group: from
    the most correlated pair left, the bit with the highest mean correlation
    to the group is added until it is full. Groups are chained likewise."""
    p = both / max(n, 1)
    single = np.diag(p)
    spread = np.sqrt(np.maximum(single * (1 - single), 1e-12))
    related = np.abs((p - np.outer(single, single)) / np.outer(spread, spread))
    np.fill_diagonal(related, -1)  # so no bit pairs with itself
    left, order = set(range(BITS)), []
    while left:
        rest = sorted(left)
        among = related[np.ix_(rest, rest)]
        group = [rest[k] for k in np.unravel_index(np.argmax(among), among.shape)]
        while len(group) < PIECE:
            free = [b for b in rest if b not in group]
            group.append(max(free, key=lambda b: related[b, group].mean()))
        left -= set(group)
        order += group
    return order


def rearranged(prints: DataFrame, order: list[int]) -> DataFrame:
    """Adds `code`, the fingerprint with bit order[k] at place k."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f, out = batch.column(0).to_numpy().view(U), np.zeros(batch.num_rows, U)
            for k, b in enumerate(order):
                out |= ((f >> U(b)) & U(1)) << U(k)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out.view(np.int64))], ["fingerprint", "least", "code"])

    return in_arrow(prints.select("fingerprint", "least"), run, "fingerprint long, least long, code long")


# ---- thresholds


def histograms(codes: DataFrame) -> np.ndarray:
    """Counts of the values of each 16-bit piece, over all codes."""
    pieces = F.array(*[F.shiftrightunsigned("code", k * PIECE).bitwiseAND(F.lit(0xFFFF)) + (k << PIECE) for k in range(BITS // PIECE)])
    counted = codes.select(F.explode(pieces).alias("value")).groupBy("value").agg(F.count("*").alias("n"))
    out = np.zeros(BITS // PIECE << PIECE, np.int64)
    table = counted.toArrow()  # at most 4 * 65,536 rows
    out[table.column(0).to_numpy()] = table.column(1).to_numpy()
    return out.reshape(BITS // PIECE, 1 << PIECE)


def within(counts: np.ndarray, distance: int) -> np.ndarray:
    """For every value of a piece the share of codes at 0 .. distance bits."""
    at = np.arange(1 << PIECE)
    out = np.zeros((distance + 1, 1 << PIECE))
    out[0] = counts / max(counts.sum(), 1)
    for bit in range(PIECE):
        moved = out[:-1][:, at ^ (1 << bit)]
        out[1:] += moved  # of codes that differ in this bit too
    return out


def n_probes(width: int, t: int) -> int:
    return sum(comb(width, d) for d in range(t + 1))


class Costs:
    """Estimated costs of thresholds, for the codes of one partition into
    parts of `width` bits."""

    def __init__(self, counts: np.ndarray, width: int, distance: int):
        self.width, self.distance, self.n = width, distance, int(counts[0].sum())
        self.parts, self.pieces = BITS // width, width // PIECE
        self.near = [within(c, distance) for c in counts]

    def of_parts(self, codes: np.ndarray) -> np.ndarray:
        """cost[part, t + 1, code] for t from -1 to distance. Pieces of one
        part count as independent."""
        out = np.zeros((self.parts, self.distance + 2, len(codes)))
        for part in range(self.parts):
            share = None
            for piece in range(part * self.pieces, (part + 1) * self.pieces):
                value = ((codes >> U(piece * PIECE)) & U(0xFFFF)).astype(np.int64)
                own = self.near[piece][:, value]
                share = own if share is None else np.array([sum(share[a] * own[d - a] for a in range(d + 1)) for d in range(self.distance + 1)])
            met = np.cumsum(share, axis=0) * self.n
            for t in range(self.distance + 1):
                out[part, t + 1] = PROBE_COST * n_probes(self.width, t) + met[t]
        return out

    def thresholds(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least cost of each code, thresholds[part, code]): the least sum of costs with
        sum(t + 1) = distance + 1, part by part."""
        cost, states, n = self.of_parts(codes), self.distance + 2, len(codes)
        best = np.full((states, n), np.inf)
        best[0] = 0
        chosen = np.zeros((self.parts, states, n), np.int64)
        for part in range(self.parts):
            now = np.full((states, n), np.inf)
            for have in range(states):
                for more in range(states - have):
                    total = best[have] + cost[part, more]
                    better = total < now[have + more]
                    now[have + more][better] = total[better]
                    chosen[part, have + more][better] = more
            best = now
        out, state, every = np.zeros((self.parts, n), np.int64), np.full(n, states - 1), np.arange(n)
        for part in reversed(range(self.parts)):
            out[part] = chosen[part, state, every] - 1
            state = state - out[part] - 1
        return best[-1], out


def masks(width: int, t: int) -> np.ndarray:
    """All values of `width` bits with at most t ones."""
    return np.array([sum(1 << b for b in bits) for d in range(t + 1) for bits in combinations(range(width), d)], U)


# ---- probing and checking


def _estimated(codes: DataFrame, counts: np.ndarray, width: int, distance: int) -> float:
    """Summed least costs of all codes."""
    sent = codes.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs, total = Costs(sent.value, width, distance), 0.0
        for batch in batches:
            total += float(costs.thresholds(batch.column(0).to_numpy().view(U))[0].sum())
        yield pa.RecordBatch.from_arrays([pa.array([total])], ["cost"])

    return in_arrow(codes.select("code"), run, "cost double").agg(F.sum("cost")).first()[0] or 0.0


def _keyed(codes: DataFrame, counts: np.ndarray, width: int, distance: int) -> DataFrame:
    """Rows part, value, probe, code: each code's own parts, and its probes."""
    sent = codes.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = Costs(sent.value, width, distance)
        near = [masks(width, t) for t in range(distance + 1)]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                code = batch.column(0).slice(at, 512).to_numpy().view(U)
                limits = costs.thresholds(code)[1]
                for part in range(costs.parts):
                    value = (code >> U(part * width)) & U((1 << width) - 1)
                    yield _rows(part, value, False, code)
                    for t in range(distance + 1):
                        asks = limits[part] == t
                        if asks.any():
                            yield _rows(part, (value[asks][:, None] ^ near[t]).ravel(), True, np.repeat(code[asks], len(near[t])))

    return in_arrow(codes.select("code"), run, "part int, value long, probe boolean, code long")


def _rows(part: int, value: np.ndarray, probe: bool, code: np.ndarray) -> pa.RecordBatch:
    n = len(code)
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), pa.array(value.astype(np.int64)),
                                       pa.array(np.full(n, probe)), pa.array(code.view(np.int64))], ["part", "value", "probe", "code"])


def _met(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part, value, chunk, probe (indexed codes first): links
    (a, b) that span what is linked in each chunk."""
    held, key = np.empty(0, U), None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)])
        probe, code = batch.column(3).to_numpy(zero_copy_only=False), batch.column(4).to_numpy().view(U)
        new = np.ones(len(code), bool)
        new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
        new[0] = key is None or tuple(keys[:, 0]) != key
        # the codes held of a chunk that goes on from the last batch come first
        first = held if not new[0] else np.empty(0, U)
        group = np.cumsum(new) - (1 if new[0] else 0)
        listed = np.concatenate([first, code[~probe]])
        of = np.concatenate([np.zeros(len(first), np.int64), group[~probe]])
        asked, by = code[probe], group[probe]
        yield from _links(listed, asked, np.searchsorted(of, by, "left"), np.searchsorted(of, by, "right"), distance)
        held, key = listed[np.searchsorted(of, group[-1]):], tuple(keys[:, -1])


def _links(listed: np.ndarray, asked: np.ndarray, low: np.ndarray, high: np.ndarray, distance: int) -> Iterator[pa.RecordBatch]:
    """asked[k] meets listed[low[k]:high[k]], in blocks of BLOCK candidates."""
    reach, at = np.cumsum(high - low), 0
    while at < len(asked):
        before = reach[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(reach, before + BLOCK, "right")))
        count = (high - low)[at:upto]
        i = np.repeat(np.arange(at, upto), count)
        j = np.repeat(low[at:upto] - np.cumsum(count) + count, count) + np.arange(len(i))
        a, b = asked[i], listed[j]
        near = (np.bitwise_count(a ^ b) <= distance) & (b < a)
        if near.any():
            yield _spanning(a[near], b[near])
        at = upto


def _spanning(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Links of each node to the least one of its component."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[:len(a)], place[len(a):]
    least = np.arange(len(nodes))
    while True:
        low = np.minimum(least[x], least[y])
        now = least.copy()
        for side in (x, y):
            np.minimum.at(now, side, low)
            np.minimum.at(now, least[side], low)
        now = now[now]
        if (now == least).all():
            break
        least = now
    moved = least != np.arange(len(nodes))
    return pa.RecordBatch.from_arrays([pa.array(nodes[least[moved]].view(np.int64)), pa.array(nodes[moved].view(np.int64))], ["a", "b"])


def links(codes: DataFrame, distance: int = 3, width: int | None = None) -> DataFrame:
    """Links (a, b) between distinct codes of at most `distance` differing
    bits, enough to connect all that are linked."""
    counts = histograms(codes)
    if width is None:
        width = min(WIDTHS, key=lambda w: _estimated(codes, counts, w, distance))
    keyed = staged(_keyed(codes, counts, width, distance), "simhash-probes")
    by = ["part", "value"]
    crowds = (keyed.where("not probe").groupBy(*by).agg(F.count("*").alias("n")).where(F.col("n") > CHUNK)
              .select(*by, F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")))
    own = F.pmod(F.xxhash64("code"), F.col("chunks")).cast("int")
    chunk = F.when(F.col("chunks").isNull(), F.array(F.lit(0))).when(~F.col("probe"), F.array(own)).otherwise(
        F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = keyed.join(crowds, by, "left").select(*by, F.explode(chunk).alias("chunk"), "probe", "code")
    order = [*by, "chunk", "probe"]
    met = dealt.repartition(*order[:3]).sortWithinPartitions(*order)
    return in_arrow(met, lambda batches: _met(batches, distance), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, seed: int = SEED, width: int | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, fingerprint (long), component (a code that names it),
    component_id (the smallest doc_id reachable by links, itself included)."""
    rows = staged(fingerprints(docs, shingle, seed, id_col, text_col), "simhash-rows")
    prints = staged(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "simhash-prints")
    codes = staged(rearranged(prints, grouped_bits(*bit_pairs(prints))), "simhash-codes")
    named = components(links(codes, distance, width))
    known = codes.join(named, codes["code"] == named["node"], "left").select(
        "fingerprint", "least", F.coalesce("component", "code").alias("component"))
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows.join(known.join(least, "component").drop("least"), "fingerprint").select(
        "doc_id", "fingerprint", "component", "component_id")


def hex_digits(fingerprint: Column) -> Column:
    """16 lower-case hex digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
