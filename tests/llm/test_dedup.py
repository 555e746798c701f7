"""Exact dedup, substring dedup and the Jaccard join against brute force."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from creditstats.llm import components, exact_dedup, jaccard_join, queries, substring_dedup
from creditstats.llm.common import read

from .conftest import EDGE, collected

SF = "/root/testdata/sf0.001"


# ---- exact


def brute_exact(rows):
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t, _ in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_edges(edge, empty):
    got = exact_dedup.exact_dedup(edge)
    assert collected(got, "doc_id", "keep_id", "group_size", "text_sha256") == brute_exact(EDGE)
    kept = Counter(r.text_sha256 for r in got.where("kept").collect())
    assert set(kept.values()) == {1} and len(kept) == len({t or "" for _, t, _ in EDGE})
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_weak_digest_compares_bytes(make_docs):
    rows = [(i, f"text {i % 7}", "a") for i in range(60)]
    weak = exact_dedup.exact_dedup(make_docs(rows), digest=lambda t: F.octet_length(t))
    assert collected(weak, "doc_id", "keep_id", "group_size", "text_sha256") == brute_exact(rows)


def test_exact_state_grows_over_micro_batches(make_docs):
    rows = [(i, f"text {i % 11}", "a") for i in range(200)]
    got = exact_dedup.exact_dedup(make_docs(rows), files_per_trigger=1)
    assert collected(got, "doc_id", "keep_id", "group_size", "text_sha256") == brute_exact(rows)


def test_exact_keep_one(edge):
    kept = exact_dedup.keep_one(edge)
    assert kept.columns == edge.columns
    assert Counter(r.text or "" for r in kept.collect()) == Counter({t or "" for _, t, _ in EDGE})


# ---- substrings


def brute_substring(rows, window):
    listed = [(i, (t or "").encode().split()) for i, t, _ in rows]
    order = lambda i: -1 if i is None else i
    first = {}
    for i, w in listed:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, order(i)), order(i))
    out = []
    for i, w in listed:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < order(i):
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=repr)


def test_difference_covers():
    for period, elements in substring_dedup.COVERS.items():
        assert {(a - b) % period for a in elements for b in elements} == set(range(period))


@pytest.mark.parametrize("window", [50, 12])
def test_substring_edges(edge, empty, window):
    got = substring_dedup.dedup_substrings(edge, window)
    assert collected(got, "doc_id", "n_words", "n_removed", "kept_text") == brute_substring(EDGE, window)
    assert substring_dedup.dedup_substrings(empty, window).count() == 0


def test_substring_spans(make_docs):
    passage = " ".join(f"w{i}" for i in range(10))
    got = substring_dedup.dedup_substrings(make_docs([(1, passage, "a"), (2, f"x {passage} y", "a")]), 10)
    spans = {r.doc_id: [(s.begin, s.end) for s in r.removed] for r in got.collect()}
    assert spans == {1: [], 2: [(1, 11)]}


def test_substring_random(make_docs):
    rng = random.Random(3)
    pool = [[rng.choice("abcdefgh") + str(rng.randrange(30)) for _ in range(rng.randint(5, 30))] for _ in range(12)]
    rows = [(rng.randrange(60), " ".join(w for _ in range(rng.randint(0, 6)) for w in rng.choice(pool)), "a") for _ in range(80)]
    got = substring_dedup.dedup_substrings(make_docs(rows), 8)
    assert collected(got, "doc_id", "n_words", "n_removed", "kept_text") == brute_substring(rows, 8)


def test_substring_shared_identifiers(make_docs):
    # a third of the rows has no identifier, a third the same one; a sixth is one and the same row
    rng = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(14))
    text = lambda: " ".join([passage] * rng.randint(0, 1) + [f"w{rng.randrange(40)}" for _ in range(rng.randint(0, 12))])
    rows = [(None, text(), "a") for _ in range(60)] + [(7, text(), "a") for _ in range(30)]
    rows += [(7, passage + " x y z " + passage, "a")] * 30 + [(i, text(), "a") for i in range(60)]
    got = substring_dedup.dedup_substrings(make_docs(rows), 8)
    assert collected(got, "doc_id", "n_words", "n_removed", "kept_text") == brute_substring(rows, 8)


def test_substring_rows_of_one_identifier_get_their_own_hashes(make_docs):
    # 200 different texts in pairs of copies, all under one identifier, and again under larger ones
    texts = [" ".join(f"t{k}w{j}" for j in range(12)) for k in range(200)]
    docs = make_docs([(7, t, "a") for t in texts] + [(100 + k, t, "a") for k, t in enumerate(texts)])
    rows = docs.selectExpr("doc_id as doc", "hash(text) as part", "text")
    shared = substring_dedup._shared_anchors(rows, 12).collect()
    assert {(r.doc, r.part) for r in shared} == {(r.doc, r.part) for r in rows.collect()}
    assert max(len(r["keys"]) for r in shared) <= 2 and max(len(b"".join(map(bytes, r["keys"]))) for r in shared) <= 2 * 8 * 7


def test_substring_query(spark):
    rows = [(r.doc_id, r.text, None) for r in read(spark, SF, "documents").collect()]
    want = [(i, n, m, hashlib.sha256(k.encode()).hexdigest()) for i, n, m, k in brute_substring(rows, 50)]
    got = queries.op1_substring_dedup(spark, SF)
    assert collected(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want, key=repr)


# ---- components, Jaccard


def brute_components(rows, size=5, percent=80):
    sets = []
    for _, t, _ in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w)} if 0 < len(w) < size else {tuple(w[k:k + size]) for k in range(len(w) - size + 1)})
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for x in range(len(rows)):
        for y in range(x):
            a, b = sets[x], sets[y]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(x)] = find(y)
    least = {}
    for x, (i, _, _) in enumerate(rows):
        if i is not None:
            least[find(x)] = min(least.get(find(x), i), i)
    return sorted(((i, len(sets[x]), least.get(find(x)) if sets[x] else i) for x, (i, _, _) in enumerate(rows)), key=repr)


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(80)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = components.components(spark.createDataFrame(links, "a long, b long").repartition(7))
    want = {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in links)}
    assert {r.node: r.component for r in got.collect()} == want


def test_jaccard_edges(edge, empty):
    got = jaccard_join.similarity_components(edge)
    assert collected(got, "doc_id", "n_shingles", "component_id") == brute_components(EDGE)
    assert jaccard_join.similarity_components(empty).count() == 0


@pytest.mark.parametrize("large, chunk", [(64, 2000), (2, 2)])
def test_jaccard_random(make_docs, monkeypatch, large, chunk):
    monkeypatch.setattr(jaccard_join, "LARGE", large)
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    rng = random.Random(11)
    rows = []
    for g in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(4, 120))]
        for _ in range(rng.randint(1, 14)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = f"z{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(w + ["common line of words that all of them have"] * (g % 2)), "a"))
    got = jaccard_join.similarity_components(make_docs(rows))
    assert collected(got, "doc_id", "n_shingles", "component_id") == brute_components(rows)


def test_jaccard_query(spark):
    rows = [(r.doc_id, r.text, None) for r in read(spark, SF, "documents").collect()]
    got = queries.op10_jaccard_join(spark, SF)
    assert collected(got, "doc_id", "n_shingles", "component_id") == brute_components(rows)


def test_jaccard_keep_one(edge):
    kept = jaccard_join.keep_one(edge)
    assert kept.columns == edge.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and ids[2] == 0 and ids[6] == 1 and ids[7] == 1 and ids[8] == 1


def test_jaccard_keep_one_needs_no_identifiers(make_docs):
    texts = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcdef"]
    rows = [(None, texts[0], "a"), (None, texts[1], "a"), (None, texts[1] + " tail", "a"), (7, texts[2], "a"), (7, texts[3], "a"),
            (7, texts[4], "a"), (8, texts[4] + " tail", "a"), (None, texts[4] + " end", "a"), (None, "", "a"), (None, None, "a")]
    kept = Counter((r.doc_id, r.text) for r in jaccard_join.keep_one(make_docs(rows)).collect())
    either = [(None, texts[1]), (None, texts[1] + " tail")]  # without identifiers any one of two near copies may stay
    assert sum(kept.pop(x, 0) for x in either) == 1
    assert kept == Counter([(None, texts[0]), (7, texts[2]), (7, texts[3]), (7, texts[4]), (None, ""), (None, None)])


@pytest.mark.parametrize("part, counted", [(1000, 5_000_000), (3, 4)])
def test_jaccard_links(make_docs, monkeypatch, part, counted):
    monkeypatch.setattr(jaccard_join, "PART", part)
    monkeypatch.setattr(jaccard_join, "COUNTED", counted)
    rng = random.Random(17)
    rows = list(EDGE)
    for g in range(4):
        base = [f"w{rng.randrange(400)}" for _ in range(60)]
        for k in range(10):  # chains: not all pairs of a component link
            base[rng.randrange(60)] = f"z{rng.randrange(10 ** 6)}"
            rows += [(100 * g + 20 + k, " ".join(base), "a")] * (1 + k % 2)
    words = [(t or "").encode().lower().split() for _, t, _ in rows]
    sets = [{tuple(w)} if 0 < len(w) < 5 else {tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in words]
    like = {(x, y) for x, a in enumerate(sets) for y, b in enumerate(sets) if x != y and a and b and 100 * len(a & b) >= 80 * len(a | b)}
    docs = make_docs(rows)
    got = jaccard_join.similarity_counts(docs)
    linked = Counter(x for x, _ in like)
    want = [(*row, linked[x]) for x, row in enumerate((i, len(s)) for (i, _, _), s in zip(rows, sets))]
    assert collected(got, "doc_id", "n_shingles", "n_links") == sorted(want, key=repr)
    assert collected(got, "doc_id", "n_shingles", "component_id") == brute_components(rows)
    if part == 3:
        members, links = jaccard_join.similarity_links(docs)
        pairs, of = [tuple(r) for r in links.collect()], {}
        assert all(a < b for a, b in pairs) and len(pairs) == len(set(pairs))
        for r in members.collect():
            of.setdefault(r.set, []).append(r.doc_id)
        met = Counter(repr(e) for a, b in pairs for x in of[a] for y in of[b] for e in ((x, y), (y, x)))
        assert met == Counter(repr((rows[x][0], rows[y][0])) for x, y in like if sets[x] != sets[y])
