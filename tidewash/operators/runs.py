"""Run bookkeeping over an ordered outcome stream (events, work items).

Outcomes are a boolean "failed" condition; everything is expressed through
``running_aggregates`` so no key or global order is funnelled into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewash.functions.common import col_of, names_of
from tidewash.functions.records import epoch_micros
from tidewash.operators.running import ROWS_PER_BUCKET, running_aggregates
from tidewash.session import scratch_path


def consecutive_runs(df: DataFrame, order_by, failed: Column, id_col: str,
                     partition_by=None, alert_at: int = 3,
                     bucket: Column | None = None) -> DataFrame:
    """Runs of consecutive failures, reset by any success.

    Gaps-and-islands: the running count of successes is constant inside a run
    of failures, so it identifies the run.  One row per run with its first
    and last id, its length and ``alert`` (length reached ``alert_at``).
    """
    part = names_of(partition_by)
    order = names_of(order_by)
    ra = running_aggregates(df, order, {"_ok_before": ("count", ~failed)}, part, bucket)
    pos = F.struct(*[F.col(c) for c in order])
    runs = (ra.where(failed)
            .groupBy(*part, "_ok_before")
            .agg(F.count(F.lit(1)).alias("run_len"),
                 F.min(pos).alias("_first"), F.max(pos).alias("_last")))
    return runs.select(
        *part,
        F.col(f"_first.{id_col}").alias(f"first_{id_col}"),
        F.col(f"_last.{id_col}").alias(f"last_{id_col}"),
        F.col("run_len"),
        (F.col("run_len") >= F.lit(alert_at)).alias("alert"))


def running_tally(df: DataFrame, order_by, failed: Column, partition_by=None,
                  bucket: Column | None = None) -> DataFrame:
    """Cumulative ok / failed counts at every row."""
    return running_aggregates(
        df, order_by, {"n_ok": ("count", ~failed), "n_failed": ("count", failed)},
        partition_by, bucket)


def throughput_eta(df: DataFrame, order_by, ts_col: str, failed: Column,
                   target_total: int, partition_by=None,
                   bucket: Column | None = None) -> DataFrame:
    """Successes per minute since the first row, and minutes left to reach
    ``target_total`` successes at that rate (null where undefined)."""
    ra = running_aggregates(
        df, order_by,
        {"n_ok": ("count", ~failed), "_t0": ("min", epoch_micros(ts_col))},
        partition_by, bucket)
    elapsed_min = (epoch_micros(ts_col) - F.col("_t0")) / F.lit(60_000_000.0)
    rate = F.try_divide(F.col("n_ok").cast("double"), elapsed_min)
    remaining = (F.lit(int(target_total)) - F.col("n_ok")).cast("double")
    return (ra.withColumn("ok_per_min", rate)
            .withColumn("eta_min", F.try_divide(remaining, F.col("ok_per_min")))
            .withColumn("elapsed_min", elapsed_min)
            .drop("_t0"))


def every_nth_summary(df: DataFrame, order_by, failed: Column, every: int = 10,
                      partition_by=None, bucket: Column | None = None) -> DataFrame:
    """The rows at which the success count reaches a multiple of ``every``."""
    t = running_tally(df, order_by, failed, partition_by, bucket)
    return t.where((~failed) & (F.col("n_ok") % F.lit(every) == 0))


def cap_per_session(df: DataFrame, session_col, order_by, cap: int,
                    rank_col: str = "rank_in_session") -> DataFrame:
    """At most ``cap`` rows per session, earliest first.

    ``row_number() <= literal`` is planned with WindowGroupLimit, which keeps
    only the first ``cap`` rows of each session per map task before the
    shuffle, so a huge session ships at most ``cap`` rows per task.
    """
    w = Window.partitionBy(*[col_of(c) for c in names_of(session_col)]).orderBy(
        *[col_of(c) for c in names_of(order_by)])
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= F.lit(cap))


def first_crossing(df: DataFrame, order_by, metric: Column, targets: list,
                   id_col: str, partition_by=None,
                   bucket: Column | None = None) -> DataFrame:
    """For each target, the first row (in order) whose cumulative metric
    reaches it; ``null`` id when never reached.

    One pass of k conditional ``min`` aggregates (k = number of targets), so
    no join against the target list is needed.
    """
    part = names_of(partition_by)
    order = names_of(order_by)
    ra = running_aggregates(df, order, {"cum_metric": ("sum", metric)}, part, bucket)
    pos = F.struct(*[F.col(c) for c in order], F.col("cum_metric"))
    aggs = [F.min(F.when(F.col("cum_metric") >= F.lit(t), pos)).alias(f"_hit{i}")
            for i, t in enumerate(targets)]
    hits = ra.groupBy(*part).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(t).alias("target"), F.col(f"_hit{i}").alias("hit"))
                     for i, t in enumerate(targets)])
    return (hits.select(*part, F.inline(rows))
            .select(*part, "target", F.col(f"hit.{id_col}").alias(id_col),
                    *[F.col(f"hit.{c}").alias(c) for c in order if c != id_col],
                    F.col("hit.cum_metric").alias("cum_metric")))


def _next_at_least(values: DataFrame, part: list[str], found: str, in_one_task: bool) -> DataFrame:
    """For rows (part, _fc_value, _fc_kind): the least ``found`` among the rows of kind 0 whose
    value is not below the row's own, as ``_fc_first``.

    Sorted by falling value this is a running minimum.  ``in_one_task`` says that the rows of
    a key are bounded, so that a plain window will do."""
    if not in_one_task:
        d = values.withColumn("_fc_neg", -F.col("_fc_value"))
        return running_aggregates(d, ["_fc_neg", "_fc_kind", found], {"_fc_first": ("min", F.col(found))}, part).drop("_fc_neg")
    w = (Window.partitionBy(*part).orderBy(F.col("_fc_value").desc(), "_fc_kind")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return values.withColumn("_fc_first", F.min(found).over(w))


def first_crossings(df: DataFrame, order_by, metric: Column, targets: DataFrame, target_col: str,
                    id_col: str, partition_by=None, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``first_crossing`` for a table of targets: one row per distinct target (and key), with
    the first row in order whose cumulative metric reaches it; nulls where none does.

    ``order_by`` is a total order.  With ``partition_by``, ``targets`` has these columns too,
    and each key has its own targets and its own sum.  A null metric adds nothing; a null
    target is left out; null keys are keys like others.

    A search in two levels.  Rows are written once in ranges of the order, one folder a range.
    The totals of the ranges give the range in which each target is reached: targets and
    running totals are sorted together, and a running minimum finds it, so no target is
    compared with every range.  Only ranges with a hit are read again, for running sums of
    their rows.  Where the metric is negative somewhere, a range's highest running sum stands
    in for its total, which takes a running sum of every row.
    """
    part, order = names_of(partition_by), names_of(order_by)
    spark, bk = df.sparkSession, "_fc_range"
    keys = [F.coalesce(F.to_json(F.struct(*part)), F.lit("")).alias("_fc_key")] if part else [F.lit("").alias("_fc_key")]
    path = scratch_path(spark, "crossing-rows")
    narrow = df.select(*keys, *[F.col(c) for c in order], F.coalesce(metric, F.lit(0)).alias("_fc_m"))
    n_ranges = max(1, -(-df.count() // rows_per_bucket))
    (narrow.repartitionByRange(n_ranges, *order).withColumn(bk, F.spark_partition_id())
     .write.partitionBy(bk).parquet(path))
    rows = spark.read.schema(narrow.select("*", F.lit(0).alias(bk)).schema).parquet(path)

    local = (Window.partitionBy("_fc_key", bk).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if rows.where(F.col("_fc_m") < 0).isEmpty():
        totals = rows.groupBy("_fc_key", bk).agg(F.sum("_fc_m").alias("total")).withColumn("top", F.col("total"))
    else:
        totals = (rows.withColumn("sofar", F.sum("_fc_m").over(local)).groupBy("_fc_key", bk)
                  .agg(F.sum("_fc_m").alias("total"), F.max("sofar").alias("top")))
    by_key = Window.partitionBy("_fc_key").orderBy(bk)
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)
    reach = totals.withColumn("before", F.coalesce(F.sum("total").over(before), F.lit(0)))
    reach = reach.withColumn("_fc_value", F.max(F.col("before") + F.col("top")).over(by_key))

    wanted = targets.where(F.col(target_col).isNotNull()).select(*part, target_col).distinct()
    asked = wanted.select("*", *keys)
    both = (reach.select("_fc_key", "_fc_value", F.lit(0).alias("_fc_kind"), F.col(bk).alias("_fc_at"))
            .unionByName(asked.select("_fc_key", F.col(target_col).alias("_fc_value"), F.lit(1).alias("_fc_kind"),
                                      F.lit(None).cast("int").alias("_fc_at"))))
    hits = (_next_at_least(both, ["_fc_key"], "_fc_at", False)
            .where((F.col("_fc_kind") == 1) & (F.col("_fc_first") >= 0))
            .select("_fc_key", "_fc_value", F.col("_fc_first").alias(bk)))
    hit_path = scratch_path(spark, "crossing-hits")
    hits.write.parquet(hit_path)
    hits = spark.read.schema(hits.schema).parquet(hit_path)

    # a range is read only if it is in this table: it is small, so its buckets prune the folders
    open_ranges = (hits.where(F.col(bk) >= 0).select("_fc_key", bk).distinct()
                   .join(reach.select("_fc_key", bk, "before"), ["_fc_key", bk]))
    searched = (rows.join(open_ranges, ["_fc_key", bk])
                .withColumn("cum_metric", F.col("before") + F.sum("_fc_m").over(local)))
    # the order's struct is unique, so the least one that reaches a value is the crossing row
    crossing = F.struct(*order, "cum_metric")
    highest = F.max("cum_metric").over(local)
    points = (searched.select("_fc_key", bk, highest.alias("_fc_value"), F.lit(0).alias("_fc_kind"), crossing.alias("_fc_at"))
              .unionByName(hits.select("_fc_key", bk, "_fc_value", F.lit(1).alias("_fc_kind")), allowMissingColumns=True))
    found = (_next_at_least(points, ["_fc_key", bk], "_fc_at", True).where(F.col("_fc_kind") == 1)
             .select("_fc_key", F.col("_fc_value").alias("_fc_target"), F.col("_fc_first").alias("_fc_hit")))
    out = asked.join(found, (asked["_fc_key"] == found["_fc_key"]) & (asked[target_col] == found["_fc_target"]), "left")
    return out.select(*[asked[c] for c in part], asked[target_col].alias("target"), F.col(f"_fc_hit.{id_col}").alias(id_col),
                      *[F.col(f"_fc_hit.{c}").alias(c) for c in order if c != id_col],
                      F.col("_fc_hit.cum_metric").alias("cum_metric"))
