import pytest

# Names that the operators use inside; none may clash with a user's column.
CLASHING = ("_metadata", "_locator", "_copies", "_dropped", "locator", "row", "set", "n", "digest", "bucket", "order",
            "pattern", "slice", "guest", "key", "score", "size", "repeats", "starts", "text_sha256", "keep_id", "value")


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tmp_path_factory.mktemp("shared").as_uri())


@pytest.fixture(scope="session")
def make_docs(spark):
    """(doc_id, text, source) rows as a documents table with clashing columns."""
    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
            f"`{c}` string" for c in CLASHING)
        full = [(i, t, None, s, None if t is None else len(t), *(["x"] * len(CLASHING))) for i, t, s in rows]
        return spark.createDataFrame(full, schema).repartition(3)
    return make


LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))

# Nulls, empty and blank texts, ties, repeated rows, repeated and missing identifiers, long texts.
EDGE = [
    (1, "the cat sat on the mat and the dog lay on the rug", "a"), (2, "the cat sat on the mat and the dog lay on the rug", "b"),
    (2, "the cat sat on the mat and the dog lay on the rug", "b"), (3, None, "a"), (4, "", None), (5, " \t\n", "b"),
    (6, LONG, "a"), (7, LONG, "c"), (7, "another text with the same number", "c"), (None, "no number here", "a"),
    (None, "no number here", "a"), (None, None, None), (8, "x " + PASSAGE + " tail of the first", "b"),
    (9, "head " + PASSAGE + " y", "a"), (10, PASSAGE, None), (11, "one", "c"), (12, "ONE", "c"),
    (13, "ünï cödé ß 漢字 🙂 é   a\x1cb", "c"), (14, "same same same same " * 40, "b"),
]


@pytest.fixture(scope="session")
def edge(make_docs):
    return make_docs(EDGE)


@pytest.fixture(scope="session")
def empty(make_docs):
    return make_docs([])


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
