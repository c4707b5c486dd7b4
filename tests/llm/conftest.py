import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with the other columns NULL or filled in."""

    def make(rows, parts=2, **extra):
        full = [(i, t, None, "s", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(parts)
        from pyspark.sql import functions as F

        return df.select("*", *[F.lit(v).alias(c) for c, v in extra.items()])

    return make


ODD = [
    (7, None), (8, ""), (9, " \n\t "), (10, "a"), (11, "a\n" * 50), (None, "no id at all, but some words here"),
    (12, "Äß \u3000wide 漢字 👍🏽 text\r\n\x0b'll don't 12345 ###"), (13, "x" * 70_000), (14, "one two three four five six " * 3000),
    (15, "same same"), (15, "same same"), (15, "other text under one id"), (16, "same same"),
]

# Names that operators use themselves, or that differ in case only.
CLASHING = {"TEXT": "x", "id": 1, "salt": 2, "node": 3, "key": 4, "rest": 5, "place": 6, "kept": 7, "n_words": 8, "_id": 9}
