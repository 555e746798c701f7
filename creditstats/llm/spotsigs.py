"""Document fingerprints from spot signatures.

A spot is a common word (an article, a preposition, or one of the SPAREth
part of all words that stands in for them in lists); its signature is the
chain of the next `chain` content words after it. The set of a text's
signature hashes is its fingerprint; a signature's second, third, ...
occurrence is an element of its own, so repeated passages keep their weight. Two fingerprints are compared by
Jaccard likeness; sets are partitioned by length, and a pair is only counted
through when its lengths allow the likeness asked for.

DataFrame operations only.

`neighbours` compares each document with an edited text and with its
successor by identifier. The successor needs no global sort: identifiers are
cut into slices at quantiles that are themselves identifiers, each slice is
one window partition, and the row that begins a slice also appears, as a
guest, at the end of the slice before. The texts move once.

`near_pairs` finds all pairs of different fingerprints with at least a given
likeness: fingerprints are first reduced to classes (equal sets), cut into
length partitions so that partners lie in the same or the next one, and met
through their rarest signatures.

Defined results: null text is empty. A text without spots takes every
word as one; a text without words has an empty set. Two empty sets have
likeness 1, an empty and another set 0. Null identifiers come before all
others; rows with equal identifiers are ordered by a hash of their text; a
single row is its own successor; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

# The common words that are spots, in four languages.
COMMON = tuple("a an the of to in is it and for on that with as was by this be are at from "
               "le la les un une des et est que de du dans pour sur par "
               "der die das ein eine und ist von zu den im mit auf "
               "el los las una y es por con para en".split())
# One word of so many, by its hash, also counts as common, for tables and lists without articles.
SPARE = 4
COARSE = 64


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once a row: a column used inside
    a lambda would otherwise be computed again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spots_of(text: Column, chain: int = 2) -> Column:
    """The fingerprint set of a text: sorted int hashes."""
    def common(x: Column) -> Column:
        return x.isin(*COMMON) | (F.pmod(F.hash(x), F.lit(SPARE)) == 0)

    def every_word(w: Column) -> Column:
        return F.transform(w, lambda x, i: F.hash(x, F.slice(w, i + 2, chain)))

    def at_spots(w: Column, at: Column) -> Column:
        # of the i words before a spot, k are spots: its content words begin after i - k
        return _let(F.filter(w, lambda x: ~common(x)),
                    lambda c: F.transform(at, lambda i, k: F.hash(F.get(w, i), F.slice(c, i - k + 1, chain))))

    def spots(w: Column) -> Column:
        at = F.filter(F.transform(w, lambda x, i: F.when(common(x), i)), lambda i: i.isNotNull())
        return _let(at, lambda at: F.when(F.size(at) > 0, at_spots(w, at)).otherwise(every_word(w)))

    def run_starts(s: Column) -> Column:
        return F.filter(F.transform(s, lambda x, i: F.when((i == 0) | (F.get(s, i - 1) != x), i)), lambda i: i.isNotNull())

    def numbered(s: Column) -> Column:  # s is sorted: equal hashes form runs
        return _let(run_starts(s), lambda begins: F.flatten(F.transform(begins, lambda b, k: F.transform(
            F.slice(s, b + 1, F.coalesce(F.get(begins, k + 1), F.size(s)) - b),
            lambda x, n: F.when(n == 0, x).otherwise(F.hash(x, n))))))

    return F.array_sort(F.array_distinct(_let(F.array_sort(_let(words_of(text), spots)), numbered)))


def fingerprint_text(spots: Column) -> Column:
    """The set as text: hexadecimal hashes, ascending as signed numbers."""
    return F.array_join(F.transform(spots, lambda h: F.lower(F.hex(h.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))))), " ")


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard likeness of two sets; 0 where their lengths alone keep it
    under `at_least`."""
    both = F.size(F.array_intersect(a, b))
    value = both / (F.size(a) + F.size(b) - both)
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    return F.when(large == 0, 1.0).when((small == 0) | (small < at_least * large), 0.0).otherwise(value)


def _slice_of(value: Column, starts: list[int]) -> Column:
    """Number of the slice a value lies in, by two short searches."""
    coarse = starts[::COARSE]
    parts = [starts[i:i + COARSE] for i in range(0, len(starts), COARSE)]
    k = F.size(F.filter(F.array(*map(F.lit, coarse)), lambda s: s <= value)) - 1
    part = F.get(F.array(*[F.array(*map(F.lit, p)) for p in parts]), F.greatest(k, F.lit(0)))
    return F.coalesce(F.greatest(F.lit(0), k * COARSE + F.size(F.filter(part, lambda s: s <= value)) - 1), F.lit(0))


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chain: int = 2,
               slice_rows: int = 2000, max_slices: int = 4096) -> DataFrame:
    """Per row: doc_id, n_chars, text, spots, edited (the last floor(n/4)
    code points replaced by as many first ones of the successor), edited_spots,
    next_spots."""
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    seen = ids.agg(F.count("*").alias("n"), F.count("id").alias("known"), F.min("id").alias("least")).first()
    slices = max(1, min(max_slices, math.ceil(seen.n / slice_rows)))
    starts = [seen.least if seen.least is not None else 0]
    if slices > 1 and seen.known:
        cuts = ids.agg(F.percentile_approx("id", [i / slices for i in range(1, slices)], 20 * max_slices)).first()[0]
        starts = sorted({*starts, *cuts})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("spots", spots_of(F.col("text"), chain))
    own = _slice_of(F.col("doc_id"), starts)
    nulls_first = seen.known < seen.n
    begins = F.col("doc_id").isin(*starts[1:]) if len(starts) > 1 else F.lit(False)
    is_first = F.col("doc_id").isNull() if nulls_first else F.col("doc_id") == starts[0]
    home = F.struct(own.alias("slice"), F.lit(0).alias("guest"))
    away = F.when(is_first, F.struct(F.lit(len(starts) - 1).alias("slice"), F.lit(2).alias("guest"))).otherwise(
        F.struct((own - 1).alias("slice"), F.lit(1).alias("guest")))
    placed = (rows.withColumn("_place", F.explode(F.when(is_first | F.coalesce(begins, F.lit(False)), F.array(home, away))
                                                  .otherwise(F.array(home))))
              .select("doc_id", "text", "spots", "_place.slice", "_place.guest"))
    order = Window.partitionBy("slice").orderBy("guest", F.asc_nulls_first("doc_id"), F.xxhash64("text"))
    paired = (placed.withColumn("_next", F.lead("text").over(order)).withColumn("next_spots", F.lead("spots").over(order))
              .where("guest = 0").withColumn("n_chars", F.char_length("text").cast("long")))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - cut).cast("int")), F.substring("_next", F.lit(1), cut))
    done = paired.withColumn("edited", edited).withColumn("edited_spots", spots_of(F.col("edited"), chain))
    return done.select("doc_id", "n_chars", "text", "spots", "edited", "edited_spots", "next_spots")


def near_pairs(docs: DataFrame, at_least: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
               chain: int = 2) -> tuple[DataFrame, DataFrame]:
    """(members: doc_id, class_id; pairs: class_a < class_b, likeness).

    A class is a set of equal fingerprints, named by the set's own hash, as
    doc_ids may be null or repeated.
    Texts without words are in no class."""
    rows = docs.select(F.col(id_col).alias("doc_id"), spots_of(F.coalesce(F.col(text_col), F.lit("")), chain).alias("spots"))
    rows = rows.where(F.size("spots") > 0)
    keyed = staged(rows.withColumn("key", F.sha2(F.array_join("spots", ",").cast("binary"), 256)), "spots-rows")
    sets = staged(keyed.groupBy(F.col("key").alias("class_id")).agg(F.first("spots").alias("spots")), "spots-sets")
    members = keyed.select("doc_id", F.col("key").alias("class_id"))

    n = F.size("spots")
    counts = (sets.select(F.explode("spots").alias("spot")).groupBy("spot").agg(F.count("*").alias("df")).where("df > 1"))
    ranked = (sets.select("class_id", n.alias("n"), F.explode("spots").alias("spot")).join(counts, "spot", "left")
              .groupBy("class_id", "n").agg(F.array_sort(F.collect_list(
                  F.struct(F.coalesce("df", F.lit(1)).alias("df"), "spot"))).alias("by_rarity")))
    reach = (F.col("n") - F.ceil(F.lit(at_least) * F.col("n")) + 1).cast("int")
    part = F.floor(F.log(F.col("n").cast("double")) / math.log(1 / at_least)) if at_least < 1 else F.col("n")
    heads = (ranked.select("class_id", "n", part.alias("part"), F.explode(F.slice("by_rarity", F.lit(1), reach)).alias("head"))
             .where("head.df > 1").select("class_id", "n", "part", F.col("head.spot").alias("spot")))
    a = heads.select(F.col("class_id").alias("class_a"), F.col("n").alias("n_a"), "spot",
                     F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    b = heads.select(F.col("class_id").alias("class_b"), F.col("n").alias("n_b"), "spot", "part")
    met = (a.join(b, ["spot", "part"]).where((F.col("n_b") >= F.col("n_a")) & (F.col("n_a") >= at_least * F.col("n_b"))
                                             & (F.col("class_a") != F.col("class_b")))
           .select(F.least("class_a", "class_b").alias("class_a"), F.greatest("class_a", "class_b").alias("class_b")).distinct())
    left = sets.select(F.col("class_id").alias("class_a"), F.col("spots").alias("spots_a"))
    right = sets.select(F.col("class_id").alias("class_b"), F.col("spots").alias("spots_b"))
    pairs = (met.join(left, "class_a").join(right, "class_b")
             .withColumn("likeness", likeness(F.col("spots_a"), F.col("spots_b"), at_least))
             .where(F.col("likeness") >= at_least).select("class_a", "class_b", "likeness"))
    return members, pairs
