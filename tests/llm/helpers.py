"""Small frames that the tests of this folder share."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])

#: names that operators use inside
CLASHES = ("id", "row", "size", "hash", "n", "len", "part", "shard", "body", "sha", "salt", "key",
           "word", "token", "count", "doc", "tie", "several", "__key", "__sha", "__id", "__row")


def docs(spark, rows, clash=False):
    """rows: (doc_id, text) pairs; with ``clash``, more columns with awkward names."""
    df = spark.createDataFrame([(i, t, "en", "src", len(t) if t is not None else None) for i, t in rows], SCHEMA)
    if clash:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("x") for c in CLASHES})
    return df.repartition(3)


def collect(df):
    return [r.asDict() for r in df.collect()]
