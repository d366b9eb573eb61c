import pytest

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names operators use inside."""
    long = "word " * 30000 + "\n" + "ß∂ " * 10
    rows = [
        (1, "the cat sat on the mat and the dog", "en", "a", 1), (1, "the cat sat on the mat and the dog", "en", "a", 1), (2, None, None, None, None), (3, "", "en", "a", 0), (None, "some text without id", "fr", None, 3),
        (4, "123 !! --", None, "b", 2), (5, long, "en", "b", len(long)), (6, "The Cat sat on the mat and the dog", "de", "", 9), (7, " \t\n ", "en", "b", 1), (8, "日本語のテキスト 🙂 é", "ja", "b", 1),
    ]
    df = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    for name in ("size", "row", "fp", "node", "rank", "words", "score", "_row", "_kept_id", "html", "copies", "class", "h", "target"):
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
