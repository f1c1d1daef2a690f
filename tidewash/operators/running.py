"""Order-dependent running aggregates that do not funnel a hot key into one task.

A plain ``sum(..) over (partition by user order by ts)`` sends every row of a
user to one task; with one user holding a third of the data that task is the
job.  A window without ``partition by`` (a global running count) is worse: all
rows go to one task.

``running_aggregates`` computes the same values in two levels:

1. rows are split by (key, bucket) where the bucket is a range of the order;
   the running value inside each bucket is an ordinary window over that small
   group;
2. per-(key, bucket) totals (one row per bucket, partial-aggregated before
   the shuffle) get an exclusive running combine over buckets, which is a
   window over a table with one row per bucket;
3. the bucket offset is joined back and combined with the local value.

All three steps are DataFrame operations; AQE decides at run time whether the
offset table is broadcast (its size is measured, not assumed).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewash.functions.common import names_of
from tidewash.session import checkpoint_root

_KINDS = ("sum", "count", "max", "min")


def _agg(kind: str, c: Column) -> Column:
    if kind in ("sum", "count"):
        return F.sum(c)
    if kind == "max":
        return F.max(c)
    if kind == "min":
        return F.min(c)
    raise ValueError(f"unknown running aggregate {kind!r}; use one of {_KINDS}")


def _combine(kind: str, offset: Column, local: Column) -> Column:
    if kind in ("sum", "count"):
        return F.coalesce(offset, F.lit(0)) + local
    if kind == "max":
        return F.greatest(offset, local)
    return F.least(offset, local)


# Target rows per (key, bucket) window partition when the width is derived
# from the data; the offset table then has about rows / this many rows.
ROWS_PER_BUCKET = 1_000_000


def sized_bucket(df: DataFrame, order_col: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> Column:
    """Bucket of equal width on the leading ordering column, with the width
    chosen so that a bucket holds about ``rows_per_bucket`` rows on average.

    One aggregate (count, min, max) sizes it, so the split adapts to the
    data: small inputs get one bucket, a 100 TB table gets ~rows/1e6 buckets.
    Works for numeric and timestamp columns (timestamps as epoch micros).
    """
    from pyspark.sql import types as T

    from tidewash.functions.records import epoch_micros

    dt = df.schema[order_col].dataType
    if isinstance(dt, T.TimestampNTZType):
        v = epoch_micros(order_col)
    elif isinstance(dt, T.TimestampType):
        v = F.unix_micros(F.col(order_col))
    elif isinstance(dt, T.DateType):
        v = F.unix_date(F.col(order_col)).cast("bigint")
    else:
        v = F.col(order_col).cast("bigint")
    n, lo, hi = df.agg(F.count(F.lit(1)), F.min(v), F.max(v)).first()
    if not n or lo is None:
        return F.lit(0)
    width = max(1, ((hi - lo) * rows_per_bucket) // n + 1)
    return F.floor((v - F.lit(lo)) / F.lit(width)).cast("bigint")


def ranged(df: DataFrame, order_names: list[str], bucket_col: str,
           rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``df`` with a bucket that rises along the order: the number of the range
    partition a row falls in.  Ranges are cut by sampled rows of the order (with
    its unique last column), so a burst in one hour is split like anything else.
    Written once, so that all later steps see the same cut."""
    n = max(1, -(-df.count() // rows_per_bucket))
    checkpoint_root(df.sparkSession)
    return df.repartitionByRange(n, *order_names).withColumn(bucket_col, F.spark_partition_id()).checkpoint(eager=True)


def running_aggregates(df: DataFrame, order_by, aggs: Mapping[str, tuple[str, Column]],
                       partition_by=None, bucket: Column | None = None) -> DataFrame:
    """Add inclusive running aggregates in the order ``order_by``.

    ``aggs`` maps an output name to ``(kind, value)``, kind in
    sum/count/max/min; for ``count`` the value is a boolean condition.
    ``order_by`` must be a total order (end it with a unique id) and
    ``bucket`` must be non-decreasing along it.  By default buckets are ranges
    of the whole order with about ``ROWS_PER_BUCKET`` rows each, however the
    rows crowd in time.  ``partition_by`` may be empty for one global order.
    """
    order_names = names_of(order_by)
    part_names = names_of(partition_by)
    bk = "_tw_bucket"
    d = ranged(df, order_names, bk) if bucket is None else df.withColumn(bk, bucket)
    for name, (kind, value) in aggs.items():
        if kind == "count":
            value = F.when(value, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
        d = d.withColumn(f"_tw_v_{name}", value)

    local_keys = part_names + [bk]
    w_local = (Window.partitionBy(*local_keys).orderBy(*order_names)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for name, (kind, _) in aggs.items():
        d = d.withColumn(f"_tw_l_{name}", _agg(kind, F.col(f"_tw_v_{name}")).over(w_local))

    totals = d.groupBy(*local_keys).agg(
        *[_agg(kind, F.col(f"_tw_v_{name}")).alias(f"_tw_t_{name}")
          for name, (kind, _) in aggs.items()])
    w_prev = (Window.partitionBy(*part_names) if part_names else Window).orderBy(bk)
    w_prev = w_prev.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *local_keys,
        *[_agg(kind, F.col(f"_tw_t_{name}")).over(w_prev).alias(f"_tw_o_{name}")
          for name, (kind, _) in aggs.items()])

    out = d.join(offsets, on=local_keys, how="left")
    for name, (kind, _) in aggs.items():
        out = out.withColumn(name, _combine(kind, F.col(f"_tw_o_{name}"), F.col(f"_tw_l_{name}")))
    drop = [bk] + [c for c in out.columns if c.startswith("_tw_")]
    return out.drop(*drop)
