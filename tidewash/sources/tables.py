"""The input tables (one Parquet file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Tables whose rows carry long texts, with their id column.
TEXT_TABLES = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id",
               "benchmark": "item_id"}

# Session setting: spread text tables over this many partitions before per-row
# text work.  Unset (the default) leaves the scan as it is split; set it where
# a table sits in a few large row groups, as local tests and the bench do.
TEXT_PARTITIONS = "tidewash.text.partitions"


def table(spark: SparkSession, sf_dir: str, name: str, text_work: bool = False) -> DataFrame:
    """Read ``{sf_dir}/{name}.parquet``; projections and filters applied later
    are pushed into the Parquet scan by Catalyst.

    ``text_work=True`` marks a read that feeds per-row text processing
    (regex, tokenising, hashing long texts); it is repartitioned by id if the
    session sets ``tidewash.text.partitions``.  (By hash: a round-robin
    exchange would first sort each partition by whole rows.)
    """
    if name not in TABLES:
        raise KeyError(name)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    n = spark.conf.get(TEXT_PARTITIONS, None)
    if text_work and name in TEXT_TABLES and n:
        df = df.repartition(int(n), TEXT_TABLES[name])
    return df
