"""Exact de-duplication and per-group survivorship.

Every operator here is a ``groupBy`` with partially-aggregatable functions
(``min``/``min_by``/``count``): each map task reduces a hot key to one row
before the shuffle, so a key holding a third of the data costs one row per
task, never a whole group in one task (which a ``row_number`` window would).

Whole rows are materialised late: keys and order values alone are aggregated,
the groups with more than one row are written, and the rows are joined with
that table.  Where copies are few it is small enough to be broadcast (the
planner decides by its written size) and the texts are never shuffled or
sorted; otherwise both sides of the join are plain, so AQE can split a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewash.functions.common import col_of, names_of
from tidewash.functions.records import epoch_micros
from tidewash.session import checkpoint_root


# Copies of a group's size row, among which the group's rows are dealt.
SIZE_SALTS = 16


def _repeated_keys(light: DataFrame) -> DataFrame:
    """(_tw_key, _tw_low, _tw_size, _tw_ties) of keys with several rows, from rows (_tw_key,
    _tw_order): the least order value (nulls last), and how many rows have it.  Written."""
    places = light.groupBy("_tw_key", "_tw_order").agg(F.count(F.lit(1)).alias("_tw_n"))
    keys = places.where(F.col("_tw_key").isNotNull()).groupBy("_tw_key").agg(
        F.min("_tw_order").alias("_tw_low"), F.sum("_tw_n").alias("_tw_size"),
        F.min_by("_tw_n", "_tw_order").alias("_tw_ties"))
    checkpoint_root(light.sparkSession)
    return keys.where("_tw_size > 1").withColumn("_tw_ties", F.coalesce("_tw_ties", "_tw_size")).checkpoint(eager=True)


def _first_rows(df: DataFrame, key: Column, order: Column) -> DataFrame:
    """The first row of each key, with ``_tw_size`` (null: the only one, or no key).

    ``df`` is computed twice: once for keys and order values only, once for the rows."""
    keyed = df.withColumns({"_tw_key": key, "_tw_order": order})
    repeated = _repeated_keys(keyed.select("_tw_key", "_tw_order"))
    joined = keyed.join(repeated, "_tw_key", "left")
    out = joined.where(F.col("_tw_size").isNull() | F.col("_tw_order").eqNullSafe(F.col("_tw_low")))
    if not repeated.where("_tw_ties > 1").isEmpty():  # rows that the order does not tell apart
        tied = F.coalesce(F.col("_tw_ties") > 1, F.lit(False))
        told = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        w = Window.partitionBy("_tw_key").orderBy(F.xxhash64(*[F.col(c) for c in told]))
        one = out.where(tied).withColumn("_tw_nth", F.row_number().over(w)).where("_tw_nth = 1").drop("_tw_nth")
        out = out.where(~tied).unionByName(one)
    return out.select(*df.columns, "_tw_size")


def _is_light(df: DataFrame, key) -> bool:
    """Whether all columns but the key's are numbers, times or flags."""
    heavy = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType)
    return not any(isinstance(f.dataType, heavy) for f in df.schema.fields
                   if not (isinstance(key, str) and f.name == key))


def exact_dedup(df: DataFrame, key, order_col: str, late: bool | None = None) -> DataFrame:
    """Keep the first row (smallest ``order_col``) of each key.

    ``key`` is a column name or expression, usually a content hash.  Unlike
    ``dropDuplicates`` (arbitrary survivor) the result is deterministic; of
    rows with equal key and order value one stays.  A null key is no key: its
    rows are all kept.  A null order value comes last.

    ``late``: look at keys and order values first and fetch the rows
    afterwards (see above); by default if the rows carry texts or the like.
    Otherwise whole rows go through one aggregation, which for just the key
    column and ``order_col`` is a hash aggregate of those two.
    """
    cols = df.columns
    k = col_of(key)
    if not _is_light(df, key) if late is None else late:
        return _first_rows(df, k, F.col(order_col)).drop("_tw_size")
    d = df.withColumn("_tw_key", k)
    keyed = d.where(F.col("_tw_key").isNotNull())
    if isinstance(key, str) and set(cols) == {key, order_col} and key != order_col:
        first = keyed.groupBy("_tw_key").agg(F.min(order_col).alias(order_col)).select(
            *[F.col("_tw_key").alias(key) if c == key else F.col(c) for c in cols])
    else:
        order = F.struct(F.col(order_col).isNull(), F.col(order_col))
        first = (keyed.groupBy("_tw_key")
                 .agg(F.min_by(F.struct(*[F.col(c) for c in cols]), order).alias("_tw_row"))
                 .select("_tw_row.*"))
    return first.unionByName(d.where(F.col("_tw_key").isNull()).select(cols))


def group_size(df: DataFrame, key, out: str = "group_size") -> DataFrame:
    """Attach the size of each row's key group.

    Counts are partial-aggregated, then joined back on the key.  (AQE does not
    split a skewed join whose other side is an aggregate.)  So keys with more
    than one row are repeated ``SIZE_SALTS`` times and rows are dealt among
    the copies; other rows need no match.  Rows with a null key are a group.
    """
    d = df.withColumns({"_tw_key": col_of(key), "_tw_salt": F.pmod(F.monotonically_increasing_id(), F.lit(SIZE_SALTS)).cast("int")})
    counts = (d.groupBy("_tw_key").agg(F.count(F.lit(1)).alias("_tw_n")).where("_tw_n > 1")
              .select(F.col("_tw_key").alias("_tw_k"), "_tw_n",
                      F.explode(F.sequence(F.lit(0), F.lit(SIZE_SALTS - 1))).alias("_tw_s")))
    both = d.join(counts, d["_tw_key"].eqNullSafe(counts["_tw_k"]) & (d["_tw_salt"] == counts["_tw_s"]), "left")
    return both.select(*df.columns, F.coalesce("_tw_n", F.lit(1)).alias(out))


def _rank_struct(df: DataFrame, order_by: list[tuple[str, bool]]) -> Column:
    """Struct that sorts ascending in the requested order.

    Descending numeric, date and timestamp columns are negated; other types
    may only be ascending.  Nulls come last in either direction.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    fields = []
    for i, (name, ascending) in enumerate(order_by):
        c = F.col(name)
        if not ascending:
            dt = types[name]
            if isinstance(dt, T.TimestampNTZType):
                c = -epoch_micros(c)
            elif isinstance(dt, T.TimestampType):
                c = -F.unix_micros(c)
            elif isinstance(dt, T.DateType):
                c = -F.unix_date(c)
            elif isinstance(dt, T.NumericType):
                c = -c
            else:
                raise TypeError(f"descending order on {dt} is not supported: {name}")
        fields += [F.col(name).isNull().alias(f"n{i}"), c.alias(f"k{i}")]
    return F.struct(*fields)


def best_per_group(df: DataFrame, key, order_by: list[tuple[str, bool]],
                   size_col: str = "group_size", multi_col: str = "multi_member", late: bool | None = None) -> DataFrame:
    """One survivor per key by a user ordering, with group size and a flag.

    ``order_by`` is a list of ``(column, ascending)``; the first row under
    that ordering survives.  Example: longest text, then smallest id:
    ``[("n_chars", False), ("doc_id", True)]``.  A null key is no key: each of
    its rows survives as a group of its own.  ``late`` as in ``exact_dedup``.
    """
    cols = df.columns
    order = _rank_struct(df, order_by)
    if not _is_light(df, key) if late is None else late:
        size = F.coalesce("_tw_size", F.lit(1).cast("long"))
        return _first_rows(df, col_of(key), order).select(*cols, size.alias(size_col), (size > 1).alias(multi_col))
    d = df.withColumn("_tw_key", col_of(key))
    g = (d.where(F.col("_tw_key").isNotNull()).groupBy("_tw_key")
         .agg(F.min_by(F.struct(*[F.col(c) for c in cols]), order).alias("_tw_row"),
              F.count(F.lit(1)).alias(size_col)))
    alone = d.where(F.col("_tw_key").isNull()).select(*cols, F.lit(1).cast("long").alias(size_col), F.lit(False).alias(multi_col))
    return g.select("_tw_row.*", size_col, (F.col(size_col) > 1).alias(multi_col)).unionByName(alone)


def multi_key_group_count(df: DataFrame, key, out: str = "n_multi_groups") -> DataFrame:
    """How many keys have more than one row (one-row result)."""
    counts = df.groupBy(col_of(key).alias("_tw_key")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.count_if(F.col("_n") > 1).alias(out),
                      F.count(F.lit(1)).alias("n_groups"))

