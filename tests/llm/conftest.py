import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from rows (doc_id, text, source), with a column that clashes with operators' names."""

    def make(rows, partitions=2):
        made = spark.createDataFrame(rows, "doc_id long, text string, source string") if rows else spark.createDataFrame(
            [], "doc_id long, text string, source string")
        return made.repartition(partitions).withColumns({
            "lang": F.lit("en"), "n_chars": F.length("text").cast("long"), "_text": F.lit(1), "fingerprint": F.lit("x"),
            "quality": F.lit(2), "spans": F.lit(3), "row": F.lit(4), "block": F.lit(5), "ids": F.lit(6),
        })

    return make


#: Nulls, empty texts, ties, repeated rows, a long text.
ODD_ROWS = [
    (None, None, None), (None, "", "a"), (1, None, "a"), (2, "", None), (3, "one", "a"), (3, "one", "a"), (3, "one", "b"),
    (4, "two words", "b"), (5, " \t\n ", "b"), (6, "long text " * 30_000, "c"), (7, "a\x00b é 日本 🎉", "c"), (None, "no id", None),
]


@pytest.fixture(scope="session")
def odd(frame):
    return frame(ODD_ROWS)


@pytest.fixture(scope="session")
def empty(frame):
    return frame([])
