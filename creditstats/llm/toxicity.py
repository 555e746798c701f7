"""Toxicity by a weighted finite-state pattern grammar.

Words are mapped to symbols: insult (I), threat (H), target (T), negation
(N), reporting word (R), other (O), clause end (.). Four weighted
transducers read the symbols of a clause and are composed:

  target    an insult or threat next to someone addressed or named
            becomes an aimed one
  negation  one shortly after a negation becomes a denied one
  reported  one after a reporting word, to the end of the clause, becomes a
            quoted one
  score     gives what is left of it its weight

A document's features sum the weights of its matched clauses by kind; a
logistic model turns them into a score from 0 to 1. A learned insult that is
aimed at no one still weighs two thirds of an aimed one, and the share of
matched words is a feature too: a text that only mentions such words scores
higher than one without them.

The insult vocabulary, whole words and stems in any language, is learned: of
the labelled rows outside the held-out fold, at most `sample_rows` by hash of
the identifier, the document frequencies of words and of their prefixes are
counted by label, and a pattern is kept when its likelihood ratio stands out
among all patterns counted and four in five of its documents are toxic. The
multipliers of the grammar are fixed; the logistic weights are fitted on the
features of the same sample. Labels are read for rows of the training folds
only; language, source and identifier are no inputs of a score.

Scale: the fit reads a bounded sample; scoring is one pass over the
documents without shuffle, the model (at most `max_patterns` patterns) sent
with the task.

Defined results: a null or empty text has the features zero and the score the
model gives them; with no labelled rows of both kinds every score is the
labelled toxic share, 0 without any; a row without identifier is scored, not
held out, and teaches nothing; of several labels of one identifier the
largest counts; of several rows of one labelled identifier at most
ROWS_PER_ID teach, so the fit reads at most that many times `sample_rows`.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_arrow, staged, worker_state

# ---------------------------------------------------------------------------
# Closed word classes of the grammar, in four languages.
TARGETS = frozenset("you your yours he she they him them his her tu toi vous votre il elle eux du dich dir ihr euch "
                    "usted ustedes ellos ellas tú".split())
NEGATIONS = frozenset("not never no none cannot isn't aren't don't doesn't nicht kein keine nie pas jamais aucun nunca "
                      "jamás ningún".split())
REPORTING = frozenset("said says say wrote writes quoted quote quotes called reported claims claimed sagte sagt schrieb "
                      "dit écrit déclaré dijo dice escribió".split())
THREATS = frozenset("kill murder hurt beat destroy shoot stab strangle töten umbringen schlagen tuer frapper assommer "
                    "matar golpear".split())
# ---------------------------------------------------------------------------

WORDS = re.compile(r"[^\W_]+(?:'[^\W_]+)*")
CLAUSE_END = re.compile(r"[.!?;:\n]")
PREFIXES = (4, 5, 6)
HELD_OUT_FOLD, FOLDS = 0, 5
# Rows of one identifier that teach.
ROWS_PER_ID = 4


@dataclass
class Transducer:
    """Deterministic weighted transducer: (state, symbol) -> (state, symbol,
    weight). A symbol without arc keeps the state and passes with weight 1."""

    arcs: dict[tuple[int, str], tuple[int, str, float]] = field(default_factory=dict)

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        return self.arcs.get((state, symbol), (state, symbol, 1.0))


class Composed:
    """Composition of transducers: each reads what the one before it writes.
    States are tuples of states, made when first reached."""

    def __init__(self, *parts: Transducer):
        self.parts = parts
        self.made: dict[tuple[tuple[int, ...], str], tuple[tuple[int, ...], str, float]] = {}

    def run(self, symbols: str) -> list[tuple[str, float]]:
        state, out = (0,) * len(self.parts), []
        for s in symbols:
            if (state, s) not in self.made:
                now, symbol, weight = [], s, 1.0
                for part, at in zip(self.parts, state):
                    to, symbol, w = part.step(at, symbol)
                    now.append(to)
                    weight *= w
                self.made[state, s] = (tuple(now), symbol, weight)
            state, symbol, weight = self.made[state, s]
            out.append((symbol, weight))
        return out


def _scope(trigger: str, length: int, marks: dict[str, tuple[str, float]]) -> Transducer:
    """After `trigger`, the symbols in `marks` are rewritten for the next
    `length` symbols (0: to the end of the clause)."""
    last = length or 1
    arcs = {(s, trigger): (last, trigger, 1.0) for s in range(last + 1)}
    for s in range(1, last + 1):
        after = s - 1 if length else s
        for symbol in "IHTNROaAd":
            if symbol != trigger:
                mark, weight = marks.get(symbol, (symbol, 1.0))
                arcs[s, symbol] = (after, mark, weight)
    return Transducer(arcs)


# Kinds after rewriting: plain I and H, aimed a and A, denied d, quoted q.
KINDS = "IHaAdq"


def grammar() -> Composed:
    target = _scope("T", 4, {"I": ("a", 1.5), "H": ("A", 1.5)})
    negation = _scope("N", 3, {k: ("d", 0.4) for k in "IHaA"})
    reported = _scope("R", 0, {k: ("q", 0.5) for k in "IHaAd"})
    # a threat aimed at no one is a plain verb
    score = Transducer({(0, "H"): (0, "H", 0.1), (0, "A"): (0, "A", 1.0), (0, "I"): (0, "I", 1.0)})
    return Composed(target, negation, reported, score)


@dataclass
class Lexicon:
    """Learned insult patterns: whole words and stems (prefixes) to weights."""

    words: dict[str, float]
    stems: dict[str, float]

    def weight(self, word: str) -> float:
        w = self.words.get(word, 0.0)
        for n in PREFIXES:
            w = max(w, self.stems.get(word[:n], 0.0) if len(word) >= n else 0.0)
        return w


class Scorer:
    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self.lexicon, self.grammar = lexicon, grammar()
        self.finder = ahocorasick.Automaton()
        for p in {*lexicon.words, *lexicon.stems, *THREATS}:
            self.finder.add_word(p, len(p))
        if len(self.finder):
            self.finder.make_automaton()

    def features(self, text: str) -> list[float]:
        """Per document: summed clause weights of plain, aimed, denied and
        quoted matches, and the share of matched words; all logarithmic."""
        total, matches = dict.fromkeys(KINDS, 0.0), 0
        low = text.lower()
        ends: set[int] = set()
        if len(self.finder):
            for last, n in self.finder.iter(low):
                begin = last - n + 1
                if begin == 0 or not low[begin - 1].isalnum():
                    ends.add(begin)
        done = -1
        for begin in sorted(ends):
            if begin < done:  # its clause is scored already
                continue
            from_, to = _clause(low, begin)
            done = to
            words = WORDS.findall(low[from_:to])
            weights = [self.lexicon.weight(w) for w in words]
            symbols = "".join(_symbol(w, x) for w, x in zip(words, weights))
            # a target may stand on either side of what is said of it
            both = zip(self.grammar.run(symbols), reversed(self.grammar.run(symbols[::-1])))
            for ((k1, w1), (k2, w2)), x in zip(both, weights):
                if k1 in KINDS:
                    kind, w = (k2, w2) if k1 in "IH" and k2 in "aA" else (k1, w1)
                    total[kind] += w * (x or 1.0)
                    matches += 1
        words_in_all = max(1, low.count(" ") + 1)
        return [math.log1p(total["I"] + total["a"]), math.log1p(total["A"]), math.log1p(total["d"] + total["q"]),
                math.log1p(total["H"]), math.log1p(1000 * matches / words_in_all)]


FEATURES = 5


def _clause(text: str, at: int) -> tuple[int, int]:
    """Bounds of the clause around `at`; marks of its end are outside."""
    begin = max(text.rfind(c, 0, at) for c in ".!?;:\n") + 1
    end = CLAUSE_END.search(text, at)
    return begin, end.start() if end else len(text)


def _symbol(word: str, weight: float) -> str:
    if weight > 0:
        return "I"
    return ("H" if word in THREATS else "T" if word in TARGETS else "N" if word in NEGATIONS
            else "R" if word in REPORTING else "O")


# ---- learning


def fold(doc_id) -> F.Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """(text, toxic) of at most `sample_rows` labelled identifiers outside
    the held-out fold, the first by a hash of the identifier. Of rows that
    share an identifier, the first ROWS_PER_ID by a hash of the text."""
    known = (labels.where("doc_id is not null and toxic is not null").where(fold("doc_id") != HELD_OUT_FOLD)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    known = staged(known.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic")), "toxic-labels")
    # bounded by sample_rows, so safe to broadcast
    found = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_id"))
    # each task keeps its own first ones before the shuffle
    nth = F.row_number().over(Window.partitionBy("_id").orderBy(F.xxhash64("text"), "text"))
    bounded = found.withColumn("_nth", nth).where(F.col("_nth") <= ROWS_PER_ID)
    return staged(bounded.select(F.coalesce("text", F.lit("")).alias("text"), "toxic"), "toxic-sample")


def pattern_counts(rows: DataFrame) -> DataFrame:
    """Per pattern ('w' and a word, 's' and a stem): documents n, toxic ones pos."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("toxicity", dict)
        n, pos = Counter(), Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for text, toxic in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns)):
                    words = set(WORDS.findall(text.lower()))
                    seen = {"w" + w for w in words} | {"s" + w[:k] for w in words for k in PREFIXES if len(w) >= k}
                    n.update(seen)
                    if toxic:
                        pos.update(seen)
                if len(n) > 100_000:
                    yield _counts(n, pos)
                    n, pos = Counter(), Counter()
        yield _counts(n, pos)

    return in_arrow(rows, count, "pattern string, n long, pos long").groupBy("pattern").agg(
        F.sum("n").alias("n"), F.sum("pos").alias("pos"))


def _counts(n: Counter, pos: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"pattern": pa.array(list(n), pa.string()), "n": pa.array(n.values(), pa.int64()),
                                       "pos": pa.array([pos[k] for k in n], pa.int64())})


def learn_lexicon(rows: DataFrame, max_patterns: int) -> Lexicon:
    total = rows.agg(F.count("*").alias("n"), F.sum("toxic").alias("pos")).first()
    if not total.n or not total.pos or total.pos == total.n:
        return Lexicon({}, {})
    rate = total.pos / total.n
    counts = staged(pattern_counts(rows), "toxic-counts")
    share = F.least(F.col("pos") / F.col("n"), F.lit(1 - 1e-9))
    ratio = F.col("pos") * F.log(share / rate) + (F.col("n") - F.col("pos")) * F.log((1 - share) / (1 - rate))
    least = math.log(max(2, counts.count())) + 1
    found = (counts.where("pos > 0").withColumn("share", share).withColumn("ratio", ratio)
             .where((F.col("share") > 0.8) & (F.col("ratio") > least))
             .orderBy(F.desc("ratio"), "pattern").limit(max_patterns).collect())
    words, stems = {}, {}
    for r in sorted(found, key=lambda r: (len(r.pattern), r.pattern)):
        kind, text = r.pattern[0], r.pattern[1:]
        weight = math.log((r.pos + 0.5) / (r.n - r.pos + 0.5)) - math.log(rate / (1 - rate))
        if kind == "w":
            words[text] = weight
        elif not any(text.startswith(s) for s in stems):
            stems[text] = weight
    return Lexicon(words, stems)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 25) -> np.ndarray:
    """Weights (bias last) by Newton steps on bounded sample features."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w)),
                               x.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray | None
    share: float


def _featured(rows: DataFrame, lexicon: Lexicon, keep: str, kinds: list[pa.DataType], then=None) -> DataFrame:
    """Columns `keep` of `rows` (all but the first, the text), and the
    document's features, or what `then` makes of them."""
    names = [k.split()[0] for k in keep.split(", ")] if keep else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("toxicity", dict)
        scorer = Scorer(lexicon)
        for batch in batches:
            made = []
            for at in range(0, batch.num_rows, 64):
                made += [scorer.features(t or "") for t in batch.column(0).slice(at, 64).to_pylist()]
            x = np.array(made, float).reshape(-1, FEATURES)
            value = then(x) if then else pa.array(x.tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(batch.columns[1:], kinds)] + [value], [*names, "value"])

    return in_arrow(rows, run, ", ".join(filter(None, [keep, "value double" if then else "value array<double>"])))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 30_000, max_patterns: int = 5_000) -> Model:
    rows = training_rows(docs, labels, sample_rows)
    lexicon = learn_lexicon(rows, max_patterns)
    made = _featured(rows.select("text", "toxic"), lexicon, "toxic int", [pa.int32()]).collect()  # at most ROWS_PER_ID * sample_rows
    y = np.array([r.toxic for r in made], float)
    share = float(y.mean()) if len(y) else 0.0
    if not 0 < share < 1:
        return Model(lexicon, None, share)
    return Model(lexicon, fit_logistic(np.array([r.value for r in made]), y), share)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    weights, share = model.weights, model.share

    def judge(x: np.ndarray) -> pa.Array:
        if weights is None:
            return pa.array(np.full(len(x), share))
        z = np.clip(x @ weights[:-1] + weights[-1], -30, 30)
        return pa.array(1 / (1 + np.exp(-z)))

    rows = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"))
    scored = _featured(rows, model.lexicon, "doc_id long", [pa.int64()], judge)
    return scored.select(
        "doc_id", F.coalesce(fold("doc_id") == HELD_OUT_FOLD, F.lit(False)).alias("held_out"),
        F.col("value").alias("score"), (F.col("value") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` that the model does not call toxic, with their
    columns, in one pass without shuffle."""
    weights, share, lexicon, schema = model.weights, model.share, model.lexicon, docs.schema
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)
        for batch in batches:
            keep = []
            for k in range(0, batch.num_rows, 64):
                for t in batch.column(at).slice(k, 64).to_pylist():
                    z = share - 0.5 if weights is None else float(np.dot(scorer.features(t or ""), weights[:-1]) + weights[-1])
                    keep.append(z < 0)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return in_arrow(docs, run, schema)
