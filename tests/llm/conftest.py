import pytest

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like the operators' own."""
    rows = [
        (1, "the same  text here\nand\tthere", "en", "src0", 1),
        (2, "the same text here and there", "en", "src0", 2),
        (2, "the same text here and there", "en", "src0", 2),
        (None, "the same text here and there", None, None, None),
        (3, None, "en", "src1", 0),
        (4, "", "en", None, 0),
        (5, " \t\n", None, "src1", 3),
        (6, LONG, "de", "http://host.example/path/x", len(LONG)),
        (7, LONG + " end", "de", "http://host.example/path/y", len(LONG)),
        (8, "one", "fr", "src0", 3),
        (8, "another text of the same id", "fr", "src0", 3),
        (9, "Ünïcode tèxt 日本 \U0001f600 a@b.co", "fr", "src0", 3),
        (None, None, None, None, None),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, schema)
    clashing = ["_sha", "rid", "score", "kept", "group_size", "_own", "_key", "tile", "removed", "_hash", "site", "digest"]
    for i, name in enumerate(clashing):
        df = df.withColumn(name, df["n_chars"] + i)
    return df


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
