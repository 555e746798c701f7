"""Mixing overlapping sources to target weights through min-cost flow.

A document may belong to several sources. Documents are aggregated by their
membership pattern (the set of their sources) to a small table of sizes.
Flow runs from each pattern through its repetition arcs (first use of its
words, second, third: convex costs, so repeats are spread evenly before any
pattern is used a third time) to the quotas of its sources. The flow tells
how many words each pattern gives; documents are then chosen inside each
pattern: all of them the whole number of times that fits, and a seeded
choice once more.

Targets: the sources, by code point with null last, weigh 1, 2, 3, 1, 2, 3,
... and share all words; a target stops at `max_repeats` times its source's
size and the excess is shared again by weight until no target is above. A
document in several sources adds its size to each of them, and targets are
shares of the words there are, each counted once.

The seeded choice is distributed: documents are ordered by a seeded hash;
sums per hash bucket (at most 2**12 a pattern) find the bucket where the
quota ends, and only that bucket is ordered row by row. Documents are taken
whole; what is left of the quota after the last one that fits is offered
again to the smaller documents, in `passes` rounds, so the words taken stay
within a few words of the flow unless every document left is larger.

The driver handles patterns and sources only; more than `max_patterns`
patterns is an error, not a cut.

Defined results: null text has size 0 and is never taken; a null source is a
source of its own; a null or empty membership list gives pattern [] and is
never taken; equal rows are interchangeable; rows are chosen by identifier
and size only, so reruns agree whatever the layout of the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, free_name, staged, with_locator
from .min_cost_flow import FlowNetwork

BUCKET_BITS = 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_order(sources) -> list:
    """Code point order, null last."""
    return sorted(sources, key=lambda s: (s is None, s or ""))


def share_targets(sizes: dict, total: int, max_repeats: int = 3) -> dict:
    """Target words per source, as described above."""
    weight = {s: 1 + i % 3 for i, s in enumerate(source_order(sizes))}
    target: dict = {}
    free, rest = list(weight), float(total)
    while free:
        unit = rest / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > max_repeats * sizes[s]]
        if not over:
            return target | {s: unit * weight[s] for s in free}
        for s in over:
            target[s] = float(max_repeats * sizes[s])
            rest -= target[s]
        free = [s for s in free if s not in target]
    return target


def whole_quotas(targets: dict) -> dict:
    """Targets as whole words with the same total, largest remainders up."""
    floor = {s: int(t) for s, t in targets.items()}
    short = round(sum(targets.values())) - sum(floor.values())
    up = sorted(targets, key=lambda s: (floor[s] - targets[s], s is None, s or ""))[:max(0, short)]
    return {s: floor[s] + (s in set(up)) for s in targets}


def route(patterns: dict[tuple, int], quotas: dict, max_repeats: int = 3) -> dict[tuple, dict]:
    """Words each pattern gives to each of its sources: the cheapest flow."""
    names, sources = list(patterns), list(quotas)
    net = FlowNetwork(len(names) + len(sources) + 2)
    begin, end = len(names) + len(sources), len(names) + len(sources) + 1
    to_source = {}
    for i, p in enumerate(names):
        for r in range(max_repeats):
            net.arc(begin, i, patterns[p], r * r)
        for s in p:
            to_source[p, s] = net.arc(i, len(names) + sources.index(s), max_repeats * patterns[p], 0)
    for k, s in enumerate(sources):
        net.arc(len(names) + k, end, quotas[s], 0)
    net.send(begin, end)
    return {p: {s: net.used(to_source[p, s]) for s in p} for p in names}


def mix(docs: DataFrame, membership: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
        seed: int = 17, max_repeats: int = 3, passes: int = 6, max_patterns: int = 100_000,
        carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row of `docs`: doc_id, size, pattern (array), pattern_size,
    pattern_words (the flow), target (sum of its sources' targets), repeats,
    taken, and the columns named in `carry`. `membership` is an array column;
    by default array(source)."""
    spark = docs.sparkSession
    member = membership if membership is not None else F.array("source")
    rows = docs.select(
        *carry, F.col(id_col).alias("doc_id"), word_count(F.col(text_col)).alias("size"),
        F.array_sort(F.array_distinct(F.coalesce(member, F.array().cast("array<string>")))).alias("pattern"))
    order = F.xxhash64(F.lit(seed), "doc_id", "size")
    rows = staged(rows.withColumn("order", order), "mix-rows")
    found = rows.groupBy("pattern").agg(F.sum("size").alias("size")).limit(max_patterns + 1).collect()
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    patterns = {tuple(r.pattern): r.size for r in found}
    sizes: dict = {}
    for p, n in patterns.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + n
    targets = share_targets(sizes, sum(n for p, n in patterns.items() if p), max_repeats)
    routed = route(patterns, whole_quotas(targets), max_repeats)
    plan = []
    for p, n in patterns.items():
        words = sum(routed[p].values())
        base = min(words // n, max_repeats) if n else 0
        left = words - base * n if base < max_repeats else 0
        plan.append((list(p), n, words, float(sum(targets[s] for s in p)), base, left))
    plans = spark.createDataFrame(plan, "pattern array<string>, pattern_size long, pattern_words long, target double, base long, left long")
    chosen = _choose(rows.join(F.broadcast(plans), "pattern"), passes)  # at most max_patterns rows
    repeats = F.when(F.col("size") > 0, F.col("base") + F.col("once_more").cast("long")).otherwise(0)
    return (chosen.withColumn("repeats", repeats)
            .select(*carry, "doc_id", "size", "pattern", "pattern_size", "pattern_words", "target", "repeats",
                    (F.col("size") * F.col("repeats")).alias("taken")))


def _choose(rows: DataFrame, passes: int) -> DataFrame:
    """Mark rows to take once more, so that each pattern's marked sizes come
    near its `left` words. One pass marks a prefix of the seeded order among
    the unmarked rows that fit into what is left."""
    rows = rows.withColumn("once_more", F.lit(False)).withColumn("bucket", F.shiftrightunsigned("order", 64 - BUCKET_BITS).cast("int"))
    for _ in range(passes):
        fits = ~F.col("once_more") & (F.col("size") > 0) & (F.col("size") <= F.col("left"))
        sums = rows.where(fits).groupBy("pattern", "left", "bucket").agg(F.sum("size").alias("_sum"))
        before = F.sum("_sum").over(Window.partitionBy("pattern").orderBy("bucket")) - F.col("_sum")
        last = (sums.withColumn("_before", before).where("_before < left")
                .groupBy("pattern").agg(F.max(F.struct("bucket", "_before")).alias("_last")))
        ends = last.select("pattern", F.col("_last.bucket").alias("_bucket"), F.col("_last._before").alias("_done"))
        ends = staged(ends, "mix-ends")
        if ends.isEmpty():
            break
        marked = rows.join(F.broadcast(ends), "pattern", "left")  # one row a pattern
        inside = (F.col("bucket") == F.col("_bucket")) & fits
        running = F.sum("size").over(Window.partitionBy("pattern", "bucket").orderBy("order", "doc_id", "size")
                                     .rowsBetween(Window.unboundedPreceding, 0))
        edge = (marked.where(inside).withColumn("_upto", F.col("_done") + running)
                .withColumn("_take", F.col("_upto") <= F.col("left")))
        rest = (marked.where(~F.coalesce(inside, F.lit(False)))
                .withColumn("_take", F.coalesce((F.col("bucket") < F.col("_bucket")) & fits, F.lit(False))))
        rows_now = rest.unionByName(edge.drop("_upto")).withColumn("once_more", F.col("once_more") | F.col("_take"))
        rows_now = staged(rows_now.drop("_bucket", "_done"), "mix-chosen")
        gained = rows_now.where("_take").groupBy("pattern").agg(F.sum("size").alias("_gained"))
        rows = (rows_now.drop("_take").join(F.broadcast(gained), "pattern", "left")  # one row a pattern
                .withColumn("left", F.col("left") - F.coalesce("_gained", F.lit(0))).drop("_gained"))
    return rows


def mixed(docs: DataFrame, seed: int = 17, max_repeats: int = 3) -> DataFrame:
    """The mix itself: rows of `docs` (doc_id, text, source, ...), each as
    often as it is taken."""
    columns = [f"`{c}`" for c in docs.columns]
    name, copies = free_name(docs, "_locator"), free_name(docs, "_copies")
    located = with_locator(docs, name)
    rows = located.select("doc_id", "text", "source", F.col(name).alias("locator"))
    taken = (mix(rows, seed=seed, max_repeats=max_repeats, carry=("locator",)).where("repeats > 0")
             .select(F.col("locator").alias(name), F.sequence(F.lit(1), F.col("repeats").cast("int")).alias(copies)))
    return located.join(taken, name).withColumn(copies, F.explode(copies)).select(*columns)
