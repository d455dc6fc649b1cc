import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use for their own results
    T.StructField("kept", T.StringType()), T.StructField("shard", T.LongType()), T.StructField("slot", T.StringType()),
    T.StructField("size", T.LongType()), T.StructField("fp", T.StringType()), T.StructField("label", T.StringType()),
    T.StructField("key", T.StringType()), T.StructField("block", T.LongType()), T.StructField("score", T.StringType()),
    T.StructField("n_tokens", T.StringType()), T.StructField("component_id", T.StringType()),
])
BASE = "the river runs under a stone bridge and the mill wheel turns all day while children watch from the bank"


def rows():
    """Nulls in any column, empty and blank texts, a very long one, ties and repeated rows."""
    extra = ("k", 9, "s", 7, "f", "l", "y", 3, "z", "t", "c")
    long = " ".join(f"w{i % 977} and{i % 13}" for i in range(60_000))
    texts = [
        (1, BASE, "en", "a.org"), (2, BASE, "en", "a.org"), (3, BASE + " again", "en", "b.org"),
        (4, None, "en", "a.org"), (5, "", None, "b.org"), (6, " \n\t ", "fr", None), (7, long, "de", "a.org"),
        (None, BASE, None, None), (None, BASE, None, None), (8, "une petite maison près de la mer", "fr", "b.org"),
        (8, "une petite maison près de la mer", "fr", "b.org"), (8, "anderer Text mit derselben Nummer", "de", "c.org"),
        (9, "x", None, "c.org"), (10, "1234 5678 !!!", "en", "c.org"), (11, "line\nline\nline two\nline two\n" + BASE, "en", None),
        (12, "Ünïcödé 漢字 ‏عربي 😀 <|endoftext|> it's we'll", "en", "c.org"),
    ]
    return [t[:4] + (None if t[0] == 3 else len(t[1] or ""),) + ((None,) * 11 if t[0] in (2, 5) else extra) for t in texts]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    data = [(i, i % 2, (i + 1) % 2) for i in range(1, 13)] + [(None, 1, 1), (3, None, None), (99, 1, 0)]
    return spark.createDataFrame(data, "doc_id long, quality int, toxic int")
