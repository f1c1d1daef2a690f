"""Operator 8, sharding: contiguous shards of near equal bytes (DataFrame only).

Global prefix sums without a global window: rows are range-partitioned by id and
written once with their partition number; each partition's total gives its offset
in the whole; a row's prefix is its partition's offset plus the running sum inside
the partition.  A row goes to the shard whose equal slice of the total holds the
row's first byte, so a shard's size differs from the target by less than one row.

Only (id, size, checksum) rows move; texts never do.  The range key ends with a
row number, so rows with one id, even a third of the table, spread over partitions.

Defined cases: a null text has no bytes (size = overhead); a null id sorts first;
repeated rows are rows of their own; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewash.llm.common import written


def shard_by_bytes(docs: DataFrame, id_col: str, text_col: str, n_shards: int,
                   overhead: int = 16, partitions: int | None = None) -> DataFrame:
    """(id, size, text_crc32, shard, slot): shard in 0..n_shards-1, slots gapless from 0.

    ``overhead`` bytes are added to each row's UTF-8 length.  ``partitions`` is the
    number of ranges (default: the session's shuffle partitions).
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text).cast("long") + F.lit(overhead)).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"))
    ranged = written(
        rows.repartitionByRange(n, "id", "row").select("*", F.spark_partition_id().alias("part")),
        "shard-rows")

    # One row per partition: the window below sees at most ``n`` rows.
    totals = ranged.groupBy("part").agg(F.sum("size").alias("part_size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = totals.select(
        F.col("part"),
        F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("offset"),
        F.sum("part_size").over(everything).alias("total"))

    inside = Window.partitionBy("part").orderBy("id", "row")
    run = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select("*", (F.sum("size").over(run) - F.col("size")).alias("local"),
                          F.row_number().over(inside).alias("nth"))
    placed = local.join(F.broadcast(offsets), "part").select(  # n rows at most
        "id", "size", "text_crc32", "part", "nth",
        F.least(F.lit(n_shards - 1), F.expr(f"cast((offset + local) * {n_shards} div total as int)"))
        .alias("shard"))
    placed = written(placed, "shard-placed")

    # Slots: a (partition, shard) piece starts where the earlier pieces of its shard end.
    pieces = placed.groupBy("part", "shard").agg(F.count(F.lit(1)).alias("rows"),
                                                 F.min("nth").alias("first"))
    start = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("part", "shard", "first",
                           F.coalesce(F.sum("rows").over(start), F.lit(0)).alias("base"))
    return placed.join(F.broadcast(pieces), ["part", "shard"]).select(  # n + n_shards rows at most
        "id", "size", "text_crc32", "shard",
        (F.col("base") + F.col("nth") - F.col("first")).cast("long").alias("slot"))
