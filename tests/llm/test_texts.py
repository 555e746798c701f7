"""BPE, HTML layout, toxicity and spot signatures."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from creditstats.llm import bpe, html_layout, queries, spotsigs, toxicity
from creditstats.llm.common import read

from .conftest import EDGE, collected

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


# ---- BPE


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_bpe_fuzz(library):
    own, rng = bpe.Tokenizer(bpe.tokenizer_spec(PATH)), random.Random(2)
    pool = [*"ab cde  \n\t'sS.!?09²½é漢🙂\x1c\x85  　_-<|>", "<|endoftext|>", "the", " the", "'ll", "aaaa",
            "    ", "\r\n", "́", "Ⅷ", "٣", "'LL", "ing"]
    for _ in range(3000):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 30)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == ids, repr(text)
        assert own.decode(np.array(ids, np.uint32)) == library.decode(ids, skip_special_tokens=False)
    long = "ab" * 40_000 + " " * 5000 + "é" * 5000
    assert own.encode(long).tolist() == library.encode(long, add_special_tokens=False).ids


def test_bpe_long_pieces(library):
    """Pieces without a break, longer than those worked on in dicts, in several languages of letters."""
    own, rng = bpe.Tokenizer(bpe.tokenizer_spec(PATH)), random.Random(3)
    for letters in ("acgt", "aeinstrhé漢🙂", "x", "0123456789", "-=*"):
        text = "".join(rng.choices(letters, k=3 * bpe.LONG_PIECE))
        ids = own.encode(text)
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert own.decode(ids) == text


def test_bpe_long_piece_memory():
    """Some bytes a character, whatever the length of the piece."""
    import tracemalloc

    own = bpe.Tokenizer(bpe.tokenizer_spec(PATH))
    text = "".join(random.Random(4).choices("acgt", k=1_000_000))
    tracemalloc.start()
    own._piece(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * len(text)


def test_bpe_memory_bound_changes_nothing(monkeypatch):
    own = bpe.Tokenizer(bpe.tokenizer_spec(PATH))
    texts = [f"some words number {i} and a few more{i % 3}" for i in range(50)]
    want = [own.encode(t).tolist() for t in texts]
    monkeypatch.setattr(bpe, "MEMORY", 3)
    own.known.clear()
    own.known.old = {}
    own.pairs.clear()
    assert [own.encode(t).tolist() for t in texts] == want


def test_bpe_tables(spark, edge, empty, library):
    made = bpe.decode(bpe.encode(edge, PATH), PATH)
    want = [(i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t, _ in EDGE]
    assert collected(made, "doc_id", "ids", "text") == sorted(want, key=repr)
    assert collected(bpe.round_trip(edge, PATH), "doc_id", "ids", "text") == sorted(want, key=repr)
    assert bpe.decode(bpe.encode(empty, PATH), PATH).count() == 0


def test_bpe_query(spark, library):
    want = []
    for r in read(spark, SF, "documents").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest()))
    got = queries.op3_bpe(spark, SF)
    assert collected(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


# ---- HTML


@pytest.mark.parametrize("html, text", [
    ("<p>a<p>b &amp; c", "a\n\nb & c"),
    ("<div>a</div><div>b</div>", "a\nb"),
    ("a  \n b<br>c", "a b\nc"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "- a\n- b\n  - c\n- d\n\ne"),
    ("<ol start=9><li>a<li value=20>b<li>c</ol>", "9. a\n20. b\n21. c"),
    ("<table><tr><td>a<td>bbb<tr><td>ccc<td>d</table>", "a   | bbb\nccc | d"),
    ("<table><td>x<tr><td colspan=2>wide</table>", "x\nwide"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a | b\n  | c\nd | e"),
    ("<table><tr><td>x<td rowspan=0>long<td>y<tr><td>1<td>2<tr><td>3<td>4</table>",
     "x | long | y\n1 |      | 2\n3 |      | 4"),
    ("<table><thead><tr><th rowspan=3>h<th>i<tbody><tr><td>1<td>2</table>", "h | i\n1 | 2"),
    ("<table><tr><td rowspan=2>a<td rowspan=2>bb<td>c<tr><td>d</table>", "a | bb | c\n       | d"),
    ("<style>.a{display:none}</style><p class='b a'>x<p class=b>y", "y"),
    ("<p class=a>x</p><p>y<style>.a{display:none}</style>", "y"),
    ("<style>p{display:none} p.k{display:block} #z{visibility:hidden}</style><p>x<p class=k>y<p class=k id=z>z<div>w", "y\n\nw"),
    ("<style>@media print{p{display:none}} @media screen{.q{display:none}} /*.w{display:none}*/ .w .v{display:none}"
     "</style><p>x<p class=q>y<p class=w>w<b class=v>v", "x\n\nwv"),
    ("<style>.a{display:none!important}</style><p class=a style='display:block'>x<p style='display:none'>y<p>z", "z"),
    ("<style media=print>p{display:none}</style><p>x", "x"),
    ("<style>@import 'x'; .a,.b{display:none</style><p class=a>x<p>y", "y"),
    ("<table>loose<tr><td>in</table>", "loose\n\nin"),
    ("<pre> a\n  b</pre>", " a\n  b"),
    ("<p hidden>x</p><p style='DISPLAY : none'>y</p>z", "z"),
    ("<span style='visibility:hidden'>x<b style='visibility:visible'>y</b></span>", "y"),
    ("<details><summary>s</summary>t</details>u<details open><summary>v</summary>w</details>", "s\nu\nv\nw"),
    ("<head><title>t</title></head><script>if (a<b) '</p>'</script><!-- c -->d", "d"),
    ("a<!-- open", "a"), ("a<script>b", "a"), ("a < b <c", "a < b"), ("", ""), ("<td>x</td>", "x"),
    ("<textarea>a<b></textarea>", "a<b>"), ("<select><option>a<option>b</select>", "a\nb"),
    ("<input type=hidden value=x><input type=submit value=Go>", "Go"),
    ("<blockquote>q<p>r</blockquote>", "  q\n\n  r"), ("<b><i>a</b>b</i>", "ab"), ("&#65;&bogus;", "A&bogus;"),
])
def test_html_layout(html, text):
    assert html_layout.render(html) == text


@pytest.mark.parametrize("html, text", [
    ("<div style='backface-visibility:hidden'>a</div>", "a"), ("<p style='-webkit-backface-visibility : hidden'>a</p>b", "a\n\nb"),
    ("<p style='visibility:hidden'>a<b style='content-visibility:auto'>b</b></p>c", "c"),
    ("<p style='-x-display:none'>a</p>", "a"), ("<p style='display:\tnone\n'>a</p>b", "b"),
    ("<p style='display:none;display:block'>a</p>", "a"), ("<p style='display:none!important;display:block'>a</p>b", "b"),
    ("<p style='visibility:hidden;visibility:visible'>a</p>", "a"), ("<p style='visibility:hidden;visibility:no'>a</p>b", "b"),
    ("<p style='visibility:hidden'>a<b style='visibility:inherit'>b</b></p>c", "c"),
    ("<p style='background:url(x;display:none)'>a</p>", "a"), ("<p style='/* display:none */color:red'>a</p>", "a"),
    ("<noscript>a <b>b</b></noscript>c", "a bc"), ("<head><noscript>a</noscript></head>c", "c"), ("<map>a<area>b</map>", "ab"),
    ("<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1 in TeX</annotation></math>.", "x=1."),
    ("a<svg><title>t</title>u<defs><text>v</text></defs><g><path d='M0'/><text>b <tspan>c</tspan></text><text>d</text></g></svg>e",
     "a\nb c\nd\ne"),
    ("<svg><desc/><title/><text display=none>a</text><text>b</text></svg>c", "b\nc"),
    ("<svg><foreignObject><div>a</div></foreignObject></svg>b", "a\nb"), ("<svg><path><p>a</p>b", "a\n\nb"), ("<svg/>a", "a"),
])
def test_html_visibility(html, text):
    assert html_layout.render(html) == text


def test_html_hostile_drawings_and_styles_are_linear():
    for part in ("<svg>", "<svg><text>", "<svg><p>", "<math>", "<svg><foreignObject>", "<svg/>"):
        html_layout.render(part * 20_000 + "x")
    for part in ("(", "/*", "'", ";", "display:"):
        html_layout.render(f'<p style="display:none;{part * 100_000}">x')


def test_html_hostile_pages_are_linear():
    for part in ("<div>", "<p", "<a b='", "<table>", "<ul><li>", "<!--", "</p>", "<td>", "<details>", "&amp", "<b><p>"):
        html_layout.render(part * 20_000 + "x")


def test_html_tables(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a"), (2, None, None), (None, "u", "<p>a"), (1, "u", "<p>a")],
                                  "page_id long, url string, html string").selectExpr("*", "'x' as text")
    assert collected(html_layout.extract(pages), "page_id", "text") == sorted([(1, "a"), (2, ""), (None, "a"), (1, "a")], key=repr)
    assert html_layout.extract(pages.where("false")).count() == 0


def test_html_query_keeps_the_words_of_pages(spark):
    """Brute force for these pages: drop script, style and title, then tags."""
    import re
    from html import unescape

    rows = {r.page_id: r.html for r in read(spark, SF, "pages").collect()}
    for r in queries.op2_html_layout(spark, SF).collect():
        plain = re.sub(r"(?s)<(script|style|title).*?</\1>|<!--.*?-->", " ", rows[r.page_id])
        want = unescape(re.sub(r"<[^>]*>", " ", plain)).split()
        got = [w for w in r.text.split() if w not in ("-", "---")]
        assert got == [w for w in want if w not in ("-", "---")]


# ---- toxicity


def test_grammar_composes():
    run = toxicity.grammar().run
    assert run("OIO")[1] == ("I", 1.0)
    assert run("TI")[1] == ("a", 1.5)
    assert run("NI")[1][0] == "d" and run("NOOOI")[4][0] == "I"
    assert run("ROOOOOI")[6][0] == "q"
    assert run("RNI")[2][0] == "q"
    assert run("OH")[1][1] < run("TH")[1][1]


def toxic_rows(n=400):
    rng = random.Random(4)
    plain = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(10, 60))]
        bad = i % 5 == 0
        for _ in range(3 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(["grumph", "blorkish", "blorken", "blorkled"]))
        rows.append((i, " ".join(words) + ".", "a"))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_held_out(spark, make_docs):
    rows, labels = toxic_rows()
    table = spark.createDataFrame(labels + [(3, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(make_docs(rows), table)
    assert "grumph" in model.lexicon.words and "blor" in model.lexicon.stems
    got = toxicity.score(make_docs(rows + EDGE), model).collect()
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(r.held_out == (r in held) for r in got) and len(got) == len(rows) + len(EDGE)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    known = [r for r in held if r.doc_id > 20]
    assert known and all(r.predicted == truth[r.doc_id] for r in known)


def test_toxicity_labels_of_the_held_out_fold_are_not_read(spark, make_docs):
    rows, labels = toxic_rows()
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    a, b = (toxicity.train(make_docs(rows), spark.createDataFrame(x, schema)) for x in (labels, flipped))
    assert a.lexicon == b.lexicon and np.array_equal(a.weights, b.weights)


def test_toxicity_without_labels(spark, edge, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(edge, none)
    assert {(r.score, r.predicted) for r in toxicity.score(edge, model).collect()} == {(0.0, 0)}
    assert toxicity.score(empty, model).count() == 0
    kept = toxicity.keep_clean(edge, model)
    assert kept.columns == edge.columns and kept.count() == len(EDGE)
    assert toxicity.train(empty, none).share == 0.0


def test_toxicity_held_out_recall_and_precision(spark):
    """A model that calls nothing toxic fails here."""
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in read(spark, sf, "labels").collect()}
    held = [r for r in queries.op4_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels]
    toxic, called = ({r.doc_id for r in held if x(r)} for x in (lambda r: labels[r.doc_id] == 1, lambda r: r.predicted))
    assert len(toxic) > 50 and len(toxic & called) / len(toxic) > 0.85 and len(toxic & called) / len(called) > 0.9


def test_toxicity_query_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in read(spark, sf, "labels").collect()}
    held = [r for r in queries.op4_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in held)
    assert len(held) > 40 and right / len(held) > 0.9


# ---- spot signatures


def test_toxicity_sample_is_bounded_by_identifier(spark, make_docs):
    rows = [(7, f"text {k}", "a") for k in range(50)] + [(7, "text 1", "a")] * 20 + [(8, "one", "a"), (None, "none", "a"), (9, None, "a")]
    labels = spark.createDataFrame([(7, 1), (8, 0), (9, 0)], "doc_id long, toxic int")
    folds = {r.doc_id: r.f for r in labels.select("doc_id", toxicity.fold("doc_id").alias("f")).collect()}
    got = [(r.text, r.toxic) for r in toxicity.training_rows(make_docs(rows), labels, 100).collect()]
    by_id = {7: [g for g in got if g[1] == 1], 8: [g for g in got if g[0] == "one"], 9: [g for g in got if g[0] == ""]}
    most = {7: toxicity.ROWS_PER_ID, 8: 1, 9: 1}
    assert all(len(by_id[i]) == (most[i] if folds[i] != toxicity.HELD_OUT_FOLD else 0) for i in most)
    assert len(got) == sum(map(len, by_id.values()))


def test_spots_neighbours(edge, make_docs):
    for rows in (EDGE, [(i * 7, f"text {i} of the kind number {i} with a few words é🙂", "a") for i in range(40)]):
        got = spotsigs.neighbours(make_docs(rows), slice_rows=3).collect()
        texts = {}
        for i, t, _ in rows:
            texts.setdefault(i, set()).add(t or "")
        order = sorted(texts, key=lambda i: (i is not None, i or 0))
        after = {i: texts[order[(k + 1) % len(order)]] | texts[i] for k, i in enumerate(order)}
        assert len(got) == len(rows)
        for r in got:
            cut = len(r.text) // 4
            assert r.n_chars == len(r.text) and r.text in texts[r.doc_id]
            assert r.edited in {r.text[:len(r.text) - cut] + n[:cut] for n in after[r.doc_id]}
        by_text = {}
        for r in got:
            assert by_text.setdefault(r.text, r.spots) == r.spots == sorted(set(r.spots))


def test_spots_of_unique_identifiers_are_exact(make_docs):
    rows = [(i * 3, f"{i} the text of number {i} " * (i % 9), "a") for i in range(50)]
    got = {r.doc_id: r.edited for r in spotsigs.neighbours(make_docs(rows), slice_rows=4).collect()}
    for k, (i, t, _) in enumerate(rows):
        n = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 4
        assert got[i] == t[:len(t) - cut] + n[:cut]


def test_spots_definition(spark):
    text = "the red fox and the red fox"
    df = spark.createDataFrame([(text,), ("",), (" ..",)], "t string")
    spots = [len(r[0]) for r in df.select(spotsigs.spots_of(df["t"])).collect()]
    assert spots[0] >= 3 and spots[1:] == [0, 0]
    pair = spark.createDataFrame([([1, 2, 3], [2, 3, 4]), ([], []), ([], [1]), ([1], [1])], "a array<int>, b array<int>")
    assert [r[0] for r in pair.select(spotsigs.likeness(pair["a"], pair["b"])).collect()] == [0.5, 1.0, 0.0, 1.0]


def test_spots_empty(empty):
    assert spotsigs.neighbours(empty).count() == 0


def test_spots_near_pairs(make_docs):
    rng = random.Random(8)
    rows = []
    for _ in range(8):
        base = [rng.choice(["the", "of", "and"]) if rng.random() < 0.3 else f"w{rng.randrange(300)}" for _ in range(80)]
        for _ in range(4):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = f"z{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(w), "a"))
    docs = make_docs(rows)
    members, pairs = spotsigs.near_pairs(docs, 0.7)
    sets = {r.doc_id: set(r.s) for r in docs.select("doc_id", spotsigs.spots_of(docs["text"]).alias("s")).collect()}
    cls = {r.doc_id: r.class_id for r in members.collect()}
    want = {(min(cls[a], cls[b]), max(cls[a], cls[b])) for a in sets for b in sets
            if cls[a] != cls[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.7}
    assert {(r.class_a, r.class_b) for r in pairs.collect()} == want and want


def test_spots_near_pairs_need_no_identifiers(make_docs):
    base = [[f"{c}{i}" for i in range(80)] for c in "abc"]
    rows = [(i, " ".join(w + tail), "a") for i, w in zip((None, 7, 7), base) for tail in ([], ["end"])]
    members, pairs = spotsigs.near_pairs(make_docs(rows), 0.7)
    assert len({r.class_id for r in members.collect()}) == 6 and pairs.count() == 3


def test_spots_query(spark):
    rows = sorted((r.doc_id, r.text) for r in read(spark, SF, "documents").collect())
    got = {r.doc_id: r for r in queries.op7_spotsigs(spark, SF).collect()}
    for k, (i, t) in enumerate(rows):
        n, cut = rows[(k + 1) % len(rows)][1], len(t) // 4
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256((t[:len(t) - cut] + n[:cut]).encode()).hexdigest()
        a, b = set(got[i].fingerprint.split()), set(got[i].edited_fingerprint.split())
        assert got[i].near_edited == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
    assert np.mean([r.near_edited for r in got.values()]) > 0.4 > np.mean([r.near_next for r in got.values()])
