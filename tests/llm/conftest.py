import pytest

#: Odd rows: null and empty texts, ties, repeated rows, a very long text, mixed case, odd white space, a null id's neighbours.
LONG = " ".join(f"word{i % 977} of line {i}" for i in range(30_000))
BASE = " ".join(f"alpha{i} beta{i % 7}" for i in range(60))
ROWS = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "Same TEXT", "en", "a", 0), (4, "same text", None, "b", 0), (4, "same text", None, "b", 0), (5, LONG, "en", "b", 0),
    (6, "é È x\x0b\x0cy\r\n\n z", "fr", None, 0), (7, BASE, "en", "b", 0), (8, BASE + " gamma", "en", "b", 0), (9, BASE.upper(), "en", "c", 0), (10, "12345 !!", "de", "c", 0),
    (11, "<|endoftext|>don't x@y.zz", "de", "c", 0), (12, "日本語 テキスト", "ja", "d", 0), (13, "İstanbul ﬁ \U0001f926", "tr", "d", 0),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(1) for c in ("kept", "size", "score", "word", "task", "rep", "n", "hi", "bucket", "key")})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
