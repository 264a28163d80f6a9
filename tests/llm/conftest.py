import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with further columns whose names the operators use inside."""

    def build(rows, partitions=2):
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                               T.StructField("lang", T.StringType()), T.StructField("kept", T.StringType()),
                               T.StructField("fp", T.StringType()), T.StructField("h", T.StringType()),
                               T.StructField("_id", T.StringType()), T.StructField("m", T.StringType()), T.StructField("n_chars", T.LongType())])
        data = [(i, t, "en", "x", "x", "x", "x", "x", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(data, schema).repartition(partitions)

    return build


@pytest.fixture(scope="session")
def odd():
    """Nulls, empty, white space, a very long word, a very long text, ties and repeated rows."""
    long_text = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
    return [(1, None), (2, ""), (3, " \t\n\r\x0b\x0c "), (4, "a" * 5000), (5, long_text), (6, long_text), (7, "Ünïcode \U0001f600 téxt\nzwei"),
            (7, "Ünïcode \U0001f600 téxt\nzwei"), (None, "no id at all"), (None, None), (8, "one"), (9, "ONE"), (10, "1 2 " * 3000)]
