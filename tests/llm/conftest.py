import pytest

ODD = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "one", None, None, None), (4, "  \n ", "de", "b", 4),
    (5, "The cat sat on the mat, and the dog did not.", "en", "a", 44), (6, "The cat sat on the mat, and the dog did not.", "en", "a", 44),
    (7, "¡Hola! ñandú 日本語 😀 12345 #!", "es", "b", 30), (8, "x" * 30_000, "en", "a", 30_000),
    (9, "word " * 4000, "de", "a", 20_000), (9, "word " * 4000, "de", "a", 20_000), (None, "no id at all", "en", "a", 12),
    (10, "<|endoftext|> and <|startoftext|>inside 'll we've it's", "en", "a", 50),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like our own."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ODD, SCHEMA)
    clash = ("fp", "rid", "kind", "word", "n", "key", "start", "stop", "p", "rate", "score", "length", "ids")
    return rows.withColumns({c: F.lit(1) for c in clash})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def rows(docs):
    return sorted(((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()))
