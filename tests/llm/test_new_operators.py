"""Token alignment, importance resampling and the SimHash join against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditstats.llm import importance_resampling, queries, simhash_join, token_alignment
from creditstats.llm.common import read

from .conftest import EDGE, collected

SF = "/root/testdata/sf0.001"


# ---- SimHash


def brute_fingerprint(text):
    from xxhash import xxh64_intdigest

    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    shingles = [" ".join(words[k:k + 3]) for k in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(codes, distance=3):
    """Least node of each code's component."""
    codes = sorted(set(codes))
    root = {c: c for c in codes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(codes):
        for b in codes[i + 1:]:
            if bin(a ^ b).count("1") <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {c: find(c) for c in codes}


def brute_simhash(rows):
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    classes = brute_classes([f for _, f in prints])
    least = {}
    for i, f in prints:
        if i is not None:
            least[classes[f]] = min(least.get(classes[f], i), i)
    return sorted(((i, f"{f:016x}", least.get(classes[f])) for i, f in prints), key=repr)


def simhash_rows(df):
    return collected(df.withColumn("fingerprint", simhash_join.hex_digits(F.col("fingerprint"))), "doc_id", "fingerprint", "component_id")


@pytest.mark.parametrize("width", [None, 16, 32])
def test_simhash_edges(edge, empty, width):
    assert simhash_rows(simhash_join.near_duplicates(edge, width=width)) == brute_simhash([(i, t) for i, t, _ in EDGE])
    assert simhash_join.near_duplicates(empty, width=width).count() == 0


def test_simhash_query(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    assert collected(queries.op13_simhash(spark, SF), "doc_id", "fingerprint", "component_id") == brute_simhash(rows)


def test_fingerprint_over_blocks(monkeypatch):
    text = " ".join(f"w{i % 31}" for i in range(400))
    monkeypatch.setattr(simhash_join, "word_blocks", lambda t, table: simhash_join_blocks(t, table, 7))
    assert simhash_join.fingerprint(text) == brute_fingerprint(text)


def simhash_join_blocks(text, table, size):
    from creditstats.llm.word_blocks import word_blocks
    return word_blocks(text, table, size)


def crowd(rng, n, flips, base):
    out = set()
    while len(out) < n:
        out.add(base ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, flips))}))
    return out


@pytest.mark.parametrize("width,chunk", [(16, 16), (32, 16), (None, 4096)])
def test_links_of_a_crowd(spark, monkeypatch, width, chunk):
    """A dense group, codes that share three pieces of four, and random ones;
    parts are cut into many chunks."""
    monkeypatch.setattr(simhash_join, "CHUNK", chunk)
    rng = random.Random(5)
    base = rng.getrandbits(64)
    codes = crowd(rng, 400, 5, base) | {base & ~0xFFFF ^ rng.getrandbits(16) for _ in range(60)} | {rng.getrandbits(64) for _ in range(200)}
    signed = [(c - (1 << 64) if c >> 63 else c,) for c in sorted(codes)]
    links = simhash_join.links(spark.createDataFrame(signed, "code long").repartition(4), width=width)
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in links.collect()]
    want = brute_classes(codes)
    assert all(want[a] == want[b] for a, b in found)
    root = {c: c for c in codes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in found:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert {c: find(c) for c in codes} == want


def test_thresholds_are_exact_and_least():
    """The chosen thresholds sum up as the principle asks and cost the least."""
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    codes[:150] = codes[:150] & np.uint64(~0xFFFF & (1 << 64) - 1) | np.uint64(7)  # a common value of part 0
    counts = np.stack([np.bincount((codes >> np.uint64(16 * k) & np.uint64(0xFFFF)).astype(np.int64), minlength=1 << 16) for k in range(4)])
    for piece in range(4):
        near = simhash_join.within(counts[piece], 2)
        value = int(codes[0] >> np.uint64(16 * piece) & np.uint64(0xFFFF))
        apart = np.bitwise_count(np.arange(1 << 16, dtype=np.uint64) ^ np.uint64(value))
        assert np.allclose([near[d][value] for d in range(3)], [counts[piece][apart == d].sum() / 300 for d in range(3)])
    costs = simhash_join.Costs(counts * 10_000, 16, 3)  # as if of three million codes
    least, limits = costs.thresholds(codes)
    assert ((limits + 1).sum(axis=0) == 4).all() and (limits[0, :150] == -1).all() and len(np.unique(limits, axis=1).T) > 1
    cost = costs.of_parts(codes)
    options = [t for t in np.ndindex(5, 5, 5, 5) if sum(t) == 4]
    assert np.allclose(least, np.min([sum(cost[p, t[p]] for p in range(4)) for t in options], axis=0))


def test_correlated_bits_share_a_group(spark):
    rng = random.Random(9)
    pairs = [(3, 40), (10, 63), (0, 22)]
    rows = []
    for _ in range(500):
        f = rng.getrandbits(64)
        for a, b in pairs:
            f = f & ~(1 << b) | (f >> a & 1) << b
        rows.append((f - (1 << 64) if f >> 63 else f,))
    order = simhash_join.grouped_bits(*simhash_join.bit_pairs(spark.createDataFrame(rows, "fingerprint long").repartition(3)))
    assert sorted(order) == list(range(64))
    place = {b: k // 16 for k, b in enumerate(order)}
    assert all(place[a] == place[b] for a, b in pairs)


# ---- resampling


def brute_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[k:k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1)]


def brute_resample(rows, targets, percent=5, min_words=20):
    count = lambda texts: Counter(zlib.crc32(f.encode()) % 10_000 for t in texts for f in brute_features(t)[1])
    source, target = count([t for _, t in rows]), count(targets)
    S, T = sum(source.values()), sum(target.values())
    gain = [math.floor(1000 * math.log((target[b] + 1) * (S + 10_000) / ((source[b] + 1) * (T + 10_000)))) for b in range(10_000)]
    out = []
    for i, t in rows:
        n, features = brute_features(t)
        weight = sum(gain[zlib.crc32(f.encode()) % 10_000] for f in features)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    enough = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    k = percent * len(enough) // 100
    ranks = Counter()
    ranks = Counter()
    listed = [(*r[:4], k_ + 1) for k_, r in enumerate(enough[:k])]
    for r in enough[:k]:
        ranks[r[:4]] += 1
    for r in out:
        if ranks[r[:4]] and r[4] >= min_words:
            ranks[r[:4]] -= 1
        else:
            listed.append((*r[:4], None))
    return sorted(listed, key=repr)


COLUMNS = ("doc_id", "n_features", "weight", "score", "rank")


@pytest.mark.parametrize("percent", [5, 40, 100])
def test_resample_edges(spark, edge, empty, percent):
    targets = ["the cat sat on the word1x1 mat", None, ""]
    target = spark.createDataFrame([(t, 1) for t in targets], "text string, score int")
    got = importance_resampling.resample(edge, target, percent)
    assert collected(got, *COLUMNS) == brute_resample([(i, t) for i, t, _ in EDGE], targets, percent)
    assert importance_resampling.resample(empty, target, percent).count() == 0
    assert importance_resampling.resample(edge, target.limit(0), percent).count() == len(EDGE)


def test_resample_query(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    targets = [r.text for r in read(spark, SF, "benchmark").collect()]
    want = brute_resample(rows, targets)
    assert collected(queries.op12_importance_resampling(spark, SF), *COLUMNS) == want
    assert sum(r[4] is not None for r in want) > 3


def test_features_over_blocks():
    from creditstats.llm.word_blocks import LETTERS, word_blocks

    text = "Ünï cödé, the 2nd-best “of” ALL words\x1c\x00 " * 50
    flat = [w for block in word_blocks(text, LETTERS, 16) for w in block]
    assert flat == [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.replace("ALL", "all"))]
    importance_blocks = importance_resampling.word_blocks
    try:
        importance_resampling.word_blocks = lambda t, table: word_blocks(t, table, 9)
        made = np.concatenate([b for _, b in importance_resampling.feature_buckets(text)])
    finally:
        importance_resampling.word_blocks = importance_blocks
    assert sorted(made.tolist()) == sorted(zlib.crc32(f.encode()) % 10_000 for f in brute_features(text)[1])


@pytest.mark.parametrize("k", [1, 2, 500, 1999, 2000])
def test_kth_key(spark, k):
    rng = random.Random(k)
    rows = [(rng.randrange(40), rng.choice([None, *range(30)]), n) for n in range(2000)]  # many ties
    got = importance_resampling.kth_key(spark.createDataFrame(rows, "score long, doc_id long, number long").repartition(3), k, pivots=4)
    assert got == sorted((-s, i is None, i or 0, n) for s, i, n in rows)[k - 1]


# ---- alignment


class Plain:
    """Whole texts by the tokenizers' libraries."""

    def __init__(self):
        import public_tokenizers as P
        import sentencepiece
        from tokenizers import Tokenizer

        self.paths = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
        self.a = Tokenizer.from_file(self.paths[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=self.paths[1])
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = [b for b in range(256) if b not in shown]
        self.byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}

    def spans(self, text):
        """(A, B) lists of (id, end), or None."""
        if not text:
            return None
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        a_bytes = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in ((i, self.b.id_to_piece(i)) for i in b)]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            return None
        out = []
        for ids, parts in ((a, a_bytes), (b, b_bytes)):
            end, listed = 0, []
            for i, x in zip(ids, parts):
                end += len(x)
                listed.append((i, end))
            out.append(listed)
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


def brute_alignment(plain, rows):
    spans = [plain.spans(t) for _, t in rows]
    links, digests = [], []
    for both in spans:
        if both is None:
            links.append([])
            digests.append("")
            continue
        a, b = both
        ends = sorted({e for _, e in a} & {e for _, e in b})
        at = {e: i for i, e in a}, {e: i for i, e in b}
        links.append([(at[0][e], at[1][e]) for e in ends])
        groups = grouped(both, ends)
        digests.append(hashlib.sha256(";".join(groups).encode()).hexdigest())
    n = Counter(p for listed in links for p in listed)
    most = {}
    for (_, b), c in n.items():
        most[b] = max(most.get(b, 0), c)
    return sorted(((i, len(s[0]) if s else 0, len(s[1]) if s else 0, len(p), len(p), sum(n[x] == most[x[1]] for x in p),
                    sum(n[x] for x in p), d) for (i, _), s, p, d in zip(rows, spans, links, digests)), key=repr)


def grouped(both, ends):
    """The groups' digits."""
    out = []
    at = [0, 0]
    for e in ends:
        parts = []
        for side in (0, 1):
            listed = []
            while at[side] < len(both[side]) and both[side][at[side]][1] <= e:
                listed.append(str(both[side][at[side]][0]))
                at[side] += 1
            parts.append(",".join(listed))
        out.append("|".join(parts))
    return out


ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
HARD = [(100, "a▁b c"), (101, "<|endoftext|> and <s> x </s> <unk>"), (102, "  lead and  double  "), (103, "tab\tnew\nline\r\n\n end "),
        (104, "漢字かな交じり文、句読点。" * 20), (105, "don't I'll we've 123456 e=mc²"), (106, "\x00\x01 \x1c x"), (107, " "), (108, "é́ ﬁ"),
        (109, "ACGT" * 300 + " tail"), (110, "x\xa0y　z    q")]


@pytest.mark.parametrize("size,fan,hot", [(1 << 15, 8, 1 << 16), (40, 2, 3), (7, 3, 0)])
def test_alignment_edges(edge, empty, make_docs, plain, size, fan, hot):
    rows = [(i, t) for i, t, _ in EDGE] + HARD
    if size < 40:
        rows = [(i, t) for i, t in rows if len(t or "") < 5000]
    docs = make_docs([(i, t, "a") for i, t in rows])
    got = token_alignment.align(docs, *plain.paths, size=size, fan=fan, hot=hot)
    assert collected(got, *ALIGNED) == brute_alignment(plain, rows)
    assert token_alignment.align(empty, *plain.paths, size=size).count() == 0


def test_alignment_query(spark, plain):
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    assert collected(queries.op11_token_alignment(spark, SF), *ALIGNED) == brute_alignment(plain, rows)


def alignment_pair(plain):
    with open(plain.paths[0], encoding="utf-8") as a, open(plain.paths[1], "rb") as b:
        return token_alignment.Pair(a.read(), b.read())


def test_alignment_encodes_new_words_together(plain, monkeypatch):
    import sentencepiece

    calls, encode = [], sentencepiece.SentencePieceProcessor.encode
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "encode", lambda *x, **k: calls.append(1) or encode(*x, **k))
    text = " " + " ".join(f"w{i}ord" for i in range(1000)) + " and" * 500
    tokens = alignment_pair(plain).tokens(text, 0, text, 0)
    assert tokens.a_end[-1] == tokens.b_end[-1] == len(text)
    assert len(calls) < 100  # not one a word


ODD = ["a", "word", "é", "don't", "12", "漢字", "Ａ", "ﬁ", "é", "…", "<unk>", "<s>", "<|endoftext|>", "▁", "x▁y", "\x1c", "\x85", "\xa0",
       "\u2003", "\u3000", "\u2028", "\n", "\t", "\r\n", "´", "\u0301", "\u200b", "🙂", "\x00", "", ".", "ACGT"]


def test_alignment_of_units(plain, monkeypatch):
    """Texts aligned together by their units against each alone as a whole."""
    monkeypatch.setattr(token_alignment, "RUN", 5)
    monkeypatch.setattr(token_alignment, "MEMORY", 40)
    rng, pair = random.Random(8), alignment_pair(plain)
    for _ in range(15):
        texts = [None, ""] + ["".join(rng.choice(ODD) + rng.choice([" ", " ", " ", " ", "  ", ""]) for _ in range(rng.randint(1, 8))) for _ in range(60)]
        made = pair.texts(texts)
        at = np.cumsum(made.n_pairs)[:-1]
        got = list(zip(made.n_a, made.n_b, made.n_groups, made.sha, *(np.split(x, at) for x in (made.pairs, made.times))))
        for text, (n_a, n_b, n_groups, sha, pairs, times) in zip(texts, got, strict=True):
            (_, *counts, digest), = brute_alignment(plain, [(0, text)])
            assert ([n_a, n_b, n_groups], sha) == (counts[:3], digest), repr(text)
            links = Counter()
            if both := plain.spans(text):
                b_at = {e: i for i, e in both[1]}
                links.update(b_at[e] << 32 | i for i, e in both[0] if e in b_at)
            assert dict(zip(pairs.tolist(), times.tolist())) == links and len(pairs) == len(links)


def test_composition_is_associative():
    """Random tokens cut at random places, composed in random order."""
    rng = random.Random(4)
    digits = token_alignment.Digits(100)
    for _ in range(200):
        n = rng.randint(2, 60)
        sides = []
        for _ in range(2):
            ends = sorted({n, *rng.sample(range(1, n + 1), rng.randint(1, max(1, n // rng.randint(1, 6))))})
            sides.append((np.array([rng.randrange(100) for _ in ends]), np.array(ends)))
        whole = token_alignment.Tokens(*sides[0], *sides[1])
        k = rng.randint(1, 8)
        cuts = [sorted([0, len(s[0]), *(rng.randint(0, len(s[0])) for _ in range(k - 1))]) for s in sides]
        parts = [(2 * j, *token_alignment.fragment(whole.between(cuts[0][j], cuts[0][j + 1], cuts[1][j], cuts[1][j + 1]))) for j in range(k)]
        closed = [(place, c) for place, _, c in parts]
        live = [(place, f) for place, f, _ in parts]
        while len(live) > 1:
            j = rng.randrange(len(live) - 1)
            made, seam = token_alignment.compose(live[j][1], live[j + 1][1])
            closed.append((live[j + 1][0] - 1, seam))
            live[j:j + 2] = [(live[j][0], made)]
        end = live[0][1]
        assert end.cut and not len(end.suffix.a) and not len(end.suffix.b)
        closed.append((-1, end.prefix))
        texts = [digits.of(c) for _, c in sorted(closed, key=lambda x: x[0])]
        assert b";".join(t for t in texts if t) == digits.of(whole)
