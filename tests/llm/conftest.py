import pytest
from pyspark.sql import types as T

CLASH = ("id", "fp", "key", "row", "run", "size", "copies", "node", "label", "w", "x", "k", "y", "t", "first", "digest")


def documents(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           *(T.StructField(c, T.StringType()) for c in CLASH)])
    return spark.createDataFrame([(*r, *["?"] * len(CLASH)) for r in rows], schema)


EDGES = [
    (1, "The cat sat on the mat and looked at the dog.", "en", "a"),
    (2, "The cat  sat on\tthe mat and looked at the dog.", "en", "a"),
    (2, "The cat  sat on\tthe mat and looked at the dog.", "en", "a"),   # a repeated row
    (3, "", "en", "b"),
    (4, None, None, None),
    (5, " \n\t ", None, None),
    (6, "12345 !!! 678", "en", "b"),
    (None, "A text without an identifier, long enough to be read.", "en", None),
    (7, "wort " * 30_000, "de", "c"),
    (8, "x" * 50_000, "de", "c"),
    (9, "Ünïcödé 日本語 🙂     text", "fr", "é"),
]


@pytest.fixture(scope="session")
def edges(spark):
    return documents(spark, EDGES).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark, []).cache()
