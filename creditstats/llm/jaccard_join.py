"""Exact set similarity join on word shingles: components, links a document,
or the links themselves.

Documents are sets of `shingle`-word shingles (64-bit hashes). Two sets link
when 100 * |common| >= 100 * at_least * |either|.

1. One pass gives each document its set's hash and size, and a table of
   shingle counts of fixed size (hashed, summed over all documents). It fixes
   one order for all sets, rare shingles first; any order is right, this one
   keeps common passages out of the index.
2. The index holds a prefix of each set in that order. With k = 1 + n/20 of
   the smaller set, and c the overlap that two sets need at their sizes, two
   linked sets share at least k shingles of their first n - c + k ones each.
   Positions in a list are skipped that lie behind this, and so are all of a
   set when too few of its first shingles are in lists at all. A shared passage alone makes no candidate.
   Lists are sorted by set size; a set meets only the block of a list whose
   sizes can link. Equal sets are one set.
3. Set relations. First each set is checked against centres of its lists
   (the sets with the least of their own) and its neighbours by size and by
   that measure. What they link is a component; pairs inside one are skipped
   here, as they cannot change it. Lists
   that still hold several components get a second turn with other centres,
   and only pairs of sets from components that are different after it are
   counted in the last round; those of one set with a large component are
   counted beside the component's members, so they are not written out. A large group of near copies thus costs a few
   checks a set.
4. Pairs are checked on the full sets, which are read again from the texts of
   the sets in question only (a bit filter of fixed size).
5. Links inside components, for `similarity_counts` and `similarity_links`
   (`similarity_components` needs none of them). Two linked sets always lie in
   one component. Its centre is the set with the most answers so far, and each
   set keeps its difference D from it. |x ^ y| = |Dx| + |Dy| - 2 |Dx & Dy|, so
   a pair's answer follows from the two sizes where they alone decide, else
   from the differences' shared entries; full sets are not met again. Members
   are cut into parts, and part meets part in a task of its own. Counts are
   summed there, so pairs are written out by `similarity_links` only.

No group is gathered: index partitions are read as sorted streams, in blocks.

Defined results: null text and text without words have the empty set, link
with nothing and are their own component; fewer words than a shingle are one
shingle; repeated rows are equal sets; a null doc_id belongs to its component
but never names it, unless no member has one; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, in_arrow, staged
from .components import components
from .words import K1, U, WordHashes, batches_of, mix, runs, window_hashes, word_hashes

COUNTERS = 1 << 20
BLOCK = 1 << 14
FILTER_BITS = 24
PAIR_BLOCK = 500_000
LIST_BLOCK = 200_000
CENTRES = 4
NEVER = 1 << 30
LARGE = 64  # members from which on a component's pairs are counted beside its members
CHUNK = 2000
COUNTED = 5_000_000
PART = 1000  # members of a component's part, and bytes of their differences
PART_BYTES = 16 << 20
LISTED = ("set", "token", "n", "pos", "q", "rank", "component", "full")
SETS = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("set", pa.int64()), ("n", pa.int32()),
                  ("block", pa.int32()), ("counts", pa.binary())])
POSTINGS = pa.schema([("token", pa.int64()), ("set", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])


def shingle_sets(texts: list, size: int, known: WordHashes) -> list[np.ndarray]:
    """Per text its sorted distinct shingle hashes, A-Z lower-cased."""
    listed = [(t or "").encode().lower().split() for t in texts]
    counts = [len(x) for x in listed]
    h = np.fromiter(map(known.__getitem__, chain.from_iterable(listed)), U, sum(counts))
    windows, at, out = window_hashes(h, size), 0, []
    for n in counts:
        if n >= size:
            s = np.sort(windows[at:at + n - size + 1])
            new = s[1:] != s[:-1]
            out.append(s if new.all() else np.concatenate([s[:1], s[1:][new]]))
        elif n:
            out.append(mix(window_hashes(h[at:at + n], n), np.array([n], U)))
        else:
            out.append(h[:0])
        at += n
    return out


def set_hash(s: np.ndarray) -> int:
    """Hash of a set, its size included, as a signed number."""
    if not len(s):
        return 0
    x = mix(s, np.arange(len(s), dtype=U) * K1)
    folded = int(np.bitwise_xor.reduce(x)) * int(K1) + int(x.sum(dtype=U)) + len(s)
    return int(U(folded & 0xFFFFFFFFFFFFFFFF).view(np.int64))


def shared_least(n):
    """Shingles that two linked sets, the smaller of size n, share in the index."""
    return 1 + (F.floor(n / 20) if isinstance(n, Column) else n // 20)


def prefix_size(n: int, percent: int) -> int:
    return min(n, n - -(-percent * n // 100) + shared_least(n))


class Join:
    """One run of the operator over `docs`."""

    def __init__(self, docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str):
        self.spark: SparkSession = docs.sparkSession
        self.shingle, self.percent = shingle, percent
        id_ = F.col(id_col).cast("long")
        self.texts = docs.select(id_.alias("doc_id"), F.xxhash64(id_, F.col(text_col)).alias("row"),
                                 F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        shingle_ = shingle

        def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, counts = word_hashes(), np.zeros(COUNTERS, np.int64)
            for rows in batches_of(batches, 2):
                sets = shingle_sets([r[2] for r in rows], shingle_, known)
                every = np.concatenate(sets) & U(COUNTERS - 1)
                counts += np.bincount(every.view(np.int64), minlength=COUNTERS)
                none = [None] * len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(([r[0] for r in rows], [r[1] for r in rows],
                                                          [set_hash(s) for s in sets], [len(s) for s in sets], none, none), SETS)],
                    schema=SETS)
            for k in range(0, COUNTERS, BLOCK):
                part = counts[k:k + BLOCK]
                if part.any():
                    yield pa.RecordBatch.from_pylist([{"block": k // BLOCK, "counts": part.astype(np.int32).tobytes()}], SETS)

        made = staged(in_arrow(self.texts, survey, "doc_id long, row long, set long, n int, block int, counts binary"), "join-sets")
        self.members = made.where("block is null").select("doc_id", "row", "set", "n")
        self.rarity = self._rarity(made.where("block is not null").select("block", "counts"))

    def _rarity(self, parts: DataFrame):
        """Counters in powers of two, broadcast: COUNTERS bytes."""
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    c = np.frombuffer(c, np.int32).astype(np.int64)
                    total[k] = total[k] + c if k in total else c
            for k, c in total.items():
                yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()), "level": pa.array(
                    [np.ceil(np.log2(c + 1)).astype(np.uint8).tobytes()], pa.binary())})

        levels = np.zeros(COUNTERS, np.uint8)
        for r in in_arrow(parts.repartition("block"), add, "block int, level binary").collect():  # COUNTERS bytes in all
            levels[r.block * BLOCK:(r.block + 1) * BLOCK] = np.frombuffer(r.level, np.uint8)
        return self.spark.sparkContext.broadcast(levels)

    def lists(self) -> DataFrame:
        """Index lists with two sets or more: token, set, n, pos; rank, the
        number of the set's own list entries before this one; and q and full,
        the places by which the set has as many entries as a link needs with
        its smallest possible partner, and with one no smaller than itself."""
        shingle, percent, rarity = self.shingle, self.percent, self.rarity

        def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, levels, seen = word_hashes(), rarity.value, set()
            for rows in batches_of(batches, 2):
                out: list[tuple] = []
                for s in shingle_sets([r[2] for r in rows], shingle, known):
                    key = set_hash(s)
                    if not len(s) or key in seen:
                        continue
                    seen.add(key)
                    head = s[np.argsort(levels[s & U(COUNTERS - 1)], kind="stable")[:prefix_size(len(s), percent)]]
                    out.append((head, key, len(s)))
                if len(seen) > 500_000:
                    seen.clear()
                if out:
                    sizes = [len(h) for h, _, _ in out]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([h for h, _, _ in out]).view(np.int64)),
                         pa.array(np.repeat(np.array([k for _, k, _ in out], np.int64), sizes)),
                         pa.array(np.repeat(np.array([n for _, _, n in out], np.int32), sizes)),
                         pa.array(np.concatenate([np.arange(x, dtype=np.int32) for x in sizes]))], schema=POSTINGS)

        def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # rows come by token; of a list only its first row waits for a second set
            last, first, open_ = None, None, False
            for batch in batches:
                if not batch.num_rows:
                    continue
                token, set_ = (batch.column(i).to_numpy() for i in (0, 1))
                begin, run = runs(token)
                many = np.zeros(len(begin), bool)
                many[run[set_ != set_[begin][run]]] = True
                if first is not None and token[0] == last:
                    many[0] |= open_ or bool((set_[run == 0] != first.column(1)[0].as_py()).any())
                    if many[0] and not open_:
                        yield first
                if many.any():
                    yield batch.filter(pa.array(many[run]))
                if len(begin) > 1 or token[0] != last:
                    first = batch.slice(int(begin[-1]), 1)
                last, open_ = token[-1], bool(many[-1])

        kind = "token long, set long, n int, pos int"
        found = in_arrow(self.texts, post, kind).repartition("token").sortWithinPartitions("token")
        lists = staged(in_arrow(found, shared, kind).distinct(), "join-shared")
        fewest = shared_least(F.ceil(F.col("n") * percent / 100)).cast("int")
        # at most a prefix of one set is gathered
        places = lists.groupBy("set", "n").agg(F.sort_array(F.collect_list("pos")).alias("places"))
        full = F.coalesce(F.get("places", (shared_least(F.col("n")) - 1).cast("int")), F.lit(NEVER))
        alive = places.select("set", "places", F.get("places", fewest - 1).alias("q"), full.alias("full")).where("q is not null")
        rank = (F.array_position("places", F.col("pos")) - 1).cast("int")
        return staged(lists.join(alive, "set").select("set", "token", "n", "pos", "q", rank.alias("rank"), "full"), "join-lists")

    def named(self, lists: DataFrame, known: DataFrame | None) -> DataFrame:
        """Lists in order, with the component of each set so far."""
        of = F.col("set")
        if known is not None:
            lists, of = lists.join(known, lists["set"] == known["node"], "left"), F.coalesce("component", "set")
        columns = lists.select("set", "token", "n", "pos", "q", "rank", of.alias("component"), "full")
        return columns.repartition("token").sortWithinPartitions("token", "n", "set")

    def neighbours(self, lists: DataFrame, known: DataFrame | None = None, turn: int = 0) -> DataFrame:
        """First round: each set with centres and neighbours of its lists,
        where they meet in a good part of the lists that a link needs. Sets
        with as little of their own are ordered differently each turn."""
        percent = self.percent
        step = np.log((100 + percent) / (2 * percent))

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in map(_mixed, _whole_lists(batches, cut_long=True)):
                if not rows.num_rows:
                    continue
                set_, token, n, _, _, _, comp, full = (rows.column(i).to_numpy() for i in range(8))
                _, of_list = runs(token)
                size = np.floor(np.log(n) / step).astype(np.int64)  # ascends with n in a list
                block = np.cumsum(np.concatenate([[0], (of_list[1:] != of_list[:-1]) | (size[1:] != size[:-1])]))
                begin, _ = runs(block)
                by_own = np.lexsort((mix(set_.view(U), np.array([turn], U)), full, block))
                every = np.arange(len(n))
                after = np.minimum(block + 1, len(begin) - 1)
                pairs = [(every[:-1], every[1:])]
                for k in range(CENTRES):  # of each block of sizes, sets with the least of their own
                    centre = by_own[np.minimum(begin + k, len(n) - 1)]
                    pairs += [(centre[block], every), (every, centre[after]), (by_own[:-1 - k], by_own[1 + k:])]
                i, j = (np.concatenate(x) for x in zip(*pairs))
                apart = (of_list[i] == of_list[j]) & (comp[i] != comp[j])
                yield _pairs(rows, i[apart], j[apart], percent, 0)

        return _counted(in_arrow(self.named(lists, known), meet, "a long, b long, least int"), 4)

    def strangers(self, lists: DataFrame, known: DataFrame) -> DataFrame:
        """Last round: pairs whose components differ and that share as many
        lists as a link needs. Those with a member of a large component are
        counted where its members are, the others by a shuffle of pairs."""
        rows = lists.join(known, lists["set"] == known["node"], "left").select(
            "set", "token", "n", "pos", "q", "rank", F.coalesce("component", "set").alias("component"), "full")
        mixed = rows.groupBy("token").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 != c2")
        rows = staged(rows.join(mixed.select("token"), "token"), "join-mixed")
        large = known.groupBy("component").agg(F.count("*").alias("members")).where(F.col("members") >= LARGE)
        large = staged(large.select("component", F.ceil(F.col("members") / CHUNK).cast("int").alias("chunks")), "join-large")
        return self._few(rows.join(large, "component", "left_anti")).union(self._with_large(rows, large)).distinct()

    def _few(self, rows: DataFrame) -> DataFrame:
        """Pairs of sets whose components are both small."""
        percent = self.percent

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in map(_mixed, _whole_lists(batches)):
                token, n, comp = (rows.column(i).to_numpy() for i in (1, 2, 6))
                _, of_list = runs(token)
                # sizes ascend in a list: the block that a set can link to ends where 100 * n_i < percent * n_j
                place = (of_list << 32) + n
                end = np.searchsorted(place, (of_list << 32) + 100 * n.astype(np.int64) // percent, side="right")
                for i, j in _expanded(np.arange(1, len(n) + 1), end):
                    keep = comp[i] != comp[j]
                    yield _pairs(rows, i[keep], j[keep], percent, 3)

        ordered = rows.select(*LISTED).repartition("token").sortWithinPartitions("token", "n", "set")
        return _counted(in_arrow(ordered, meet, "a long, b long, least int"), 1)

    def _with_large(self, rows: DataFrame, large: DataFrame) -> DataFrame:
        """Pairs of a member of a large component with any other set. The
        members are cut into chunks; the entries of the others go to each
        chunk of a component that their lists name."""
        percent = self.percent
        named = rows.join(large, "component").select("token", F.col("component").alias("owner"), "chunks").distinct()
        chunk = F.pmod(F.xxhash64("set"), F.col("chunks")).cast("int")
        dealt = (rows.join(named, "token")
                 .withColumn("chunk", F.explode(F.when(F.col("component") == F.col("owner"), F.array(chunk))
                                                .otherwise(F.sequence(F.lit(0), F.col("chunks") - 1))))
                 .select(*LISTED, "owner", "chunk"))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in _groups(batches, 8, 9):
                set_, token, n, _, _, _, comp, _, owner, _ = (c.to_numpy() for c in rows.columns)
                inside = np.flatnonzero(comp == owner)
                outside = np.flatnonzero(comp != owner)
                members, m_of = np.unique(set_[inside], return_inverse=True)
                others, o_of = np.unique(set_[outside], return_inverse=True)
                for first in range(0, len(others), max(1, COUNTED // max(1, len(members)))):
                    upto = first + max(1, COUNTED // max(1, len(members)))
                    mine = np.flatnonzero((o_of >= first) & (o_of < upto))
                    shared = np.zeros((min(upto, len(others)) - first) * len(members), np.int64)
                    low, high = (np.searchsorted(token[inside], token[outside[mine]], side=x) for x in ("left", "right"))
                    for x, y in _expanded(low, high):
                        ok, _ = _allowed(rows, outside[mine[x]], inside[y], percent, 0)
                        at = (o_of[mine[x[ok]]] - first) * len(members) + m_of[y[ok]]
                        shared += np.bincount(at, minlength=len(shared))
                    met = np.flatnonzero(shared)
                    size_in, size_out = np.zeros(len(members), np.int64), np.zeros(len(others), np.int64)
                    size_in[m_of], size_out[o_of] = n[inside], n[outside]
                    o, m = met // len(members) + first, met % len(members)
                    met = shared[met] >= shared_least(np.minimum(size_out[o], size_in[m]))
                    a, b = others[o[met]], members[m[met]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        ordered = dealt.repartition("owner", "chunk").sortWithinPartitions("owner", "chunk", "token")
        return in_arrow(ordered, count, "a long, b long")

    def check(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that link, by their full sets."""
        percent = self.percent
        pairs = staged(pairs, "join-pairs")
        # a set given twice repeats a link and no more
        sets = self.full_sets(pairs.select(F.col("a").alias("set")).union(pairs.select(F.col("b").alias("set"))).distinct())

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                    x, y = np.frombuffer(x, U), np.frombuffer(y, U)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    out.append(100 * both >= percent * (len(x) + len(y) - both))
                yield batch.select(["a", "b"]).filter(pa.array(out, pa.bool_()))

        left = sets.select(F.col("set").alias("a"), F.col("members").alias("x"))
        right = sets.select(F.col("set").alias("b"), F.col("members").alias("y"))
        return staged(in_arrow(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y"), compare, "a long, b long"), "join-links")

    def full_sets(self, asked: DataFrame) -> DataFrame:
        """The sets asked for, with others, read again: set, members. Repeated
        rows may give a set twice."""
        shingle = self.shingle
        named = self.members.groupBy("set").agg(F.min("row").alias("row")).join(asked, "set")
        bit = F.col("row").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
        bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
        for r in (named.groupBy(F.shiftright(bit, 6).alias("word"))
                  .agg(F.bit_or(F.expr("shiftleft(1L, cast(row & 63 as int))")).alias("bits")).collect()):  # 2**18 rows at most
            bits[r.word] = r.bits
        bitmap = self.spark.sparkContext.broadcast(bits)

        def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = word_hashes()

            def wanted(batch: pa.RecordBatch) -> pa.RecordBatch:
                at = batch.column(1).to_numpy() & ((1 << FILTER_BITS) - 1)
                return batch.filter(pa.array((bitmap.value[at >> 6] >> (at & 63)) & 1 == 1))
            for rows in batches_of(map(wanted, batches), 2, 1 << 20):
                sets = shingle_sets([r[2] for r in rows], shingle, known)
                yield pa.RecordBatch.from_arrays([pa.array([set_hash(s) for s in sets], pa.int64()),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())], ["set", "members"])

        return staged(in_arrow(self.texts, load, "set long, members binary"), "join-members")

    def differences(self, links: DataFrame, named: DataFrame) -> DataFrame:
        """Per set with a link: set, component, n, copies (rows that have it),
        and its difference from the centre of its component."""
        answers = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("answers"))
        centres = staged(named.join(answers, "node").groupBy("component").agg(
            F.max(F.struct("answers", "node")).getField("node").alias("centre"),
            F.ceil(F.count("*") / PART).cast("int").alias("salts")), "join-centres")
        sets = staged(self.full_sets(named.select(F.col("node").alias("set"))).dropDuplicates(["set"]), "join-full")
        copies = self.members.where("n > 0").groupBy("set").agg(F.count("*").alias("copies"))
        salt = F.pmod(F.xxhash64("set"), F.col("salts")).cast("int")
        own = (named.join(centres, "component").select(F.col("node").alias("set"), "component", "centre", "salts")
               .join(sets, "set").join(copies, "set").withColumn("salt", salt))
        middle = (centres.select(F.col("centre").alias("set"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
                  .join(sets, "set").select(F.col("set").alias("centre"), "salt", F.col("members").alias("middle")))

        def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                size, out = [], []
                for x, y in zip(*(batch.column(k).to_pylist() for k in (3, 4))):
                    size.append(len(x) // 8)
                    out.append(np.setxor1d(np.frombuffer(x, U), np.frombuffer(y, U), assume_unique=True).tobytes())
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(size, pa.int64()), pa.array(out, pa.binary())],
                                                 ["set", "component", "copies", "n", "difference"])

        rows = own.join(middle, ["centre", "salt"]).select("set", "component", "copies", "members", "middle")
        return staged(in_arrow(rows, differ, "set long, component long, copies long, n long, difference binary"), "join-differences")

    def inside(self, differences: DataFrame, counts: bool) -> DataFrame:
        """The links inside components: (set, linked), rows of other sets that
        a set links with, in parts to be summed, if `counts`; else (a, b)."""
        percent = self.percent
        parts = differences.groupBy("component").agg(F.ceil(F.greatest(
            F.count("*") / PART, F.sum(F.length("difference")) / PART_BYTES)).cast("int").alias("parts"))
        dealt = (differences.join(parts, "component").withColumn("part", F.pmod(F.xxhash64("set"), F.col("parts")).cast("int"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                 .select("component", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
                         "part", "set", "copies", "n", "difference"))

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in _groups(batches, 0, 1, 2):
                i, j = (rows.column(k)[0].as_py() for k in (1, 2))
                part, set_, copies, n = (rows.column(k).to_numpy() for k in (3, 4, 5, 6))
                apart = [np.frombuffer(d, U) for d in rows.column(7).to_pylist()]
                every, y = np.flatnonzero(part == i), np.flatnonzero(part == j)
                step, linked_y = max(1, COUNTED // max(1, len(y))), np.zeros(len(y), np.int64)
                for first in range(0, len(every), step):
                    x = every[first:first + step]
                    linked = _derived(apart, n, x, y, percent) & (x[:, None] != y)
                    if counts:
                        yield pa.RecordBatch.from_arrays([pa.array(set_[x]), pa.array(linked @ copies[y])], ["set", "linked"])
                        linked_y += copies[x] @ linked
                    else:
                        a, b = np.nonzero(linked & (x[:, None] < y) if i == j else linked)
                        a, b = set_[x[a]], set_[y[b]]
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
                if counts and i != j:
                    yield pa.RecordBatch.from_arrays([pa.array(set_[y]), pa.array(linked_y)], ["set", "linked"])

        ordered = dealt.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
        return in_arrow(ordered, meet, "set long, linked long" if counts else "a long, b long")


def _derived(apart: list[np.ndarray], n: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Which sets `x` link with which sets `y`, by their sizes and their
    differences from one centre: they may differ in `most` shingles."""
    size = np.array([len(d) for d in apart], np.int64)
    most = (100 - percent) * (n[x][:, None] + n[y]) // (100 + percent)
    linked = size[x][:, None] + size[y] <= most
    asked = ~linked & (np.abs(size[x][:, None] - size[y]) <= most)
    at_x, at_y = np.flatnonzero(asked.any(axis=1)), np.flatnonzero(asked.any(axis=0))
    if not len(at_x):
        return linked
    of_x, of_y = np.repeat(np.arange(len(at_x)), size[x[at_x]]), np.repeat(np.arange(len(at_y)), size[y[at_y]])
    entries, listed = (np.concatenate([apart[k] for k in at]) for at in (x[at_x], y[at_y]))
    order = np.argsort(listed, kind="stable")
    listed, of_y = listed[order], of_y[order]
    shared = np.zeros(len(at_x) * len(at_y), np.int64)
    for i, j in _expanded(*(np.searchsorted(listed, entries, side=s) for s in ("left", "right"))):
        shared += np.bincount(of_x[i] * len(at_y) + of_y[j], minlength=len(shared))
    among = np.ix_(at_x, at_y)
    differ = (size[x[at_x]][:, None] + size[y[at_y]]) - 2 * shared.reshape(len(at_x), len(at_y))
    linked[among] |= differ <= most[among]
    return linked


def _whole_lists(batches: Iterator[pa.RecordBatch], cut_long: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows sorted by token in batches that end with a list; with `cut_long`
    a list longer than LIST_BLOCK may be cut."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        token = batch.column(1).to_numpy()
        if count >= LIST_BLOCK:
            others = np.flatnonzero(token != held[-1].column(1)[-1].as_py())
            end = 0 if cut_long else int(others[0]) if len(others) else None
            if end is not None:
                yield pa.concat_batches([*held, batch.slice(0, end)])
                held, count, batch = [], 0, batch.slice(end)
        held.append(batch)
        count += batch.num_rows
    if held:
        yield pa.concat_batches(held)


def _mixed(rows: pa.RecordBatch) -> pa.RecordBatch:
    """The lists that hold sets of several components."""
    token, comp = (rows.column(i).to_numpy() for i in (1, 6))
    begin, of_list = runs(token)
    if not len(begin):
        return rows
    mixed = np.minimum.reduceat(comp, begin) != np.maximum.reduceat(comp, begin)
    return rows.filter(pa.array(mixed[of_list]))


def _expanded(low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) for every i and every j from low[i] to high[i], in blocks."""
    count = np.maximum(high - low, 0)
    reach, at = np.cumsum(count), 0
    while at < len(low):
        before = reach[at] - count[at]
        upto = max(at + 1, int(np.searchsorted(reach, before + PAIR_BLOCK, side="right")))
        c = count[at:upto]
        i = np.repeat(np.arange(at, upto), c)
        yield i, low[i] + np.arange(len(i)) - np.repeat(np.cumsum(c) - c, c)
        at = upto


def _groups(batches: Iterator[pa.RecordBatch], *by: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by the columns `by`, one batch a group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(k).to_numpy() for k in by]
        new = np.zeros(len(keys[0]), bool)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), len(new)]
        for b, e in zip(cuts[:-1], cuts[1:]):
            if held and any(held[0].column(c)[0].as_py() != k[b] for c, k in zip(by, keys)):
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(b, e - b))
    if held:
        yield pa.concat_batches(held)


def _allowed(rows: pa.RecordBatch, i: np.ndarray, j: np.ndarray, percent: int, quarters: int) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs (i, j) of list entries sizes and positions allow, and the
    number of lists that must report them. Of the k lists that a link shares,
    those after the first k * quarters / 4 report it; in both sets they have
    at least so many entries before them."""
    set_, n, pos, q, rank, full = (rows.column(k).to_numpy().astype(np.int64) for k in (0, 2, 3, 4, 5, 7))
    small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
    need, least = -(-percent * (small + large) // (100 + percent)), shared_least(small)
    silent = least * quarters // 4
    ok = (100 * small >= percent * large) & (set_[i] != set_[j])
    for side in (i, j):
        enough = np.where(least >= shared_least(n[side]), full[side], q[side])
        ok &= (np.maximum(pos[side], enough) < n[side] - need + least) & (rank[side] >= silent)
    return ok, least - silent


def _pairs(rows: pa.RecordBatch, i: np.ndarray, j: np.ndarray, percent: int, quarters: int) -> pa.RecordBatch:
    """The allowed pairs (a, b) with the number of lists that must report them."""
    set_ = rows.column(0).to_numpy()
    ok, least = _allowed(rows, i, j, percent, quarters)
    a, b = set_[i[ok]], set_[j[ok]]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)),
                                       pa.array(least[ok].astype(np.int32))], ["a", "b", "least"])


def _counted(met: DataFrame, part: int) -> DataFrame:
    """Pairs that at least 1/part of the lists report that must."""
    return (met.groupBy("a", "b", "least").agg(F.count("*").alias("lists"))
            .where(F.col("lists") * part >= F.col("least")).select("a", "b"))


def similarity_components(docs: DataFrame, shingle: int = 5, at_least: float = 0.8, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """Per row: doc_id, row (a hash of identifier and text), n_shingles,
    component_id (the smallest doc_id reachable by links, itself included),
    component (a set's hash that names the component, whatever its doc_ids
    are; it is 0 for all empty sets)."""
    join = Join(docs, shingle, round(100 * at_least), id_col, text_col)
    return _rows(join, _connected(join)[1]).drop("set")


def similarity_counts(docs: DataFrame, shingle: int = 5, at_least: float = 0.8, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The rows of `similarity_components` with n_links, the number of other
    rows that link with the row; equal sets link, empty ones do not."""
    join = Join(docs, shingle, round(100 * at_least), id_col, text_col)
    links, named = _connected(join)
    linked = join.inside(join.differences(links, named), counts=True).groupBy("set").agg(F.sum("linked").alias("linked"))
    sets = (join.members.where("n > 0").groupBy("set").agg(F.count("*").alias("copies")).join(linked, "set", "left")
            .select("set", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")))
    return (_rows(join, named).join(sets, "set", "left")
            .withColumn("n_links", F.coalesce("n_links", F.lit(0))).drop("set"))


def similarity_links(docs: DataFrame, shingle: int = 5, at_least: float = 0.8, id_col: str = "doc_id",
                     text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members: doc_id, row, set, n; links: a < b, every two different sets
    that link, once). Rows of one set that is not empty link with each other."""
    join = Join(docs, shingle, round(100 * at_least), id_col, text_col)
    return join.members, join.inside(join.differences(*_connected(join)), counts=False)


def _connected(join: Join) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) enough to connect every component, and the component of
    each set that has one: node, component."""
    lists = join.lists()
    links = join.check(join.neighbours(lists))
    links = links.union(join.check(join.neighbours(lists, components(links), turn=1)))
    links = links.union(join.check(join.strangers(lists, components(links))))
    return links, staged(components(links), "join-components")


def _rows(join: Join, named: DataFrame) -> DataFrame:
    rows = join.members.join(named, join.members["set"] == named["node"], "left").select(
        "doc_id", "row", "set", "n", F.coalesce("component", "set").alias("component"))
    least = rows.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    return (rows.join(least, "component", "left")
            .select("doc_id", "row", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"), "component", "set"))


def keep_one(docs: DataFrame, shingle: int = 5, at_least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay: of each component the one with the
    smallest doc_id (null last). Null and repeated doc_ids join no components.
    Rows equal in identifier and text count as one document. Texts without
    words all stay."""
    name = free_name(docs, "_dropped")
    found = staged(similarity_components(docs, shingle, at_least, id_col, text_col), "join-found").where("n_shingles > 0")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    best = found.groupBy("component").agg(F.min(order).alias("best"), F.count("*").alias("members")).where("members > 1")
    dropped = (found.join(best, "component").where(F.col("row") != F.col("best.row"))
               .select(F.col("row").alias(name)).distinct())
    row = F.xxhash64(F.col(id_col).cast("long"), F.col(text_col))
    return docs.join(dropped, row == F.col(name), "left_anti")
