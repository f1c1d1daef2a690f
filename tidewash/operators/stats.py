"""Distributions, audits, ordering and set-combination helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewash.functions.common import col_of
from tidewash.session import checkpoint_root


def group_count_sorted(df: DataFrame, key, default=None, out: str = "n",
                       key_name: str | None = None) -> DataFrame:
    """Count per key (missing key -> ``default``), most frequent first, ties
    by key.  The aggregation is partial before the shuffle; the final sort
    is over one row per key."""
    k = col_of(key)
    if default is not None:
        k = F.coalesce(k, F.lit(default))
    name = key_name or (key if isinstance(key, str) else "key")
    return (df.groupBy(k.alias(name)).agg(F.count(F.lit(1)).alias(out))
            .orderBy(F.col(out).desc(), F.col(name).asc()))


def multi_dim_counts(df: DataFrame, dims: list[str], default: str | None = None,
                     out: str = "n") -> DataFrame:
    """Several one-field distributions in one scan (``GROUPING SETS``).

    Output: (dim, value, n) with one row per (field, value).
    """
    cols = [F.coalesce(F.col(d), F.lit(default)).alias(d) if default is not None else F.col(d)
            for d in dims]
    base = df.select(*cols)
    gs = base.groupingSets([[F.col(d)] for d in dims], *[F.col(d) for d in dims]).agg(
        F.count(F.lit(1)).alias(out), F.grouping_id().alias("_gid"))
    # grouping_id has one bit per dim, the first dim the most significant;
    # the set that groups by dim i has every bit set except bit (k-1-i).
    k = len(dims)
    full = (1 << k) - 1
    dim_name = F.lit(None).cast("string")
    value = F.lit(None).cast("string")
    for i, d in enumerate(dims):
        gid = full ^ (1 << (k - 1 - i))
        dim_name = F.when(F.col("_gid") == gid, F.lit(d)).otherwise(dim_name)
        value = F.when(F.col("_gid") == gid, F.col(d).cast("string")).otherwise(value)
    return gs.select(dim_name.alias("dim"), value.alias("value"), F.col(out))


def stage_audit(source: DataFrame, stages: list[tuple[str, DataFrame]]) -> DataFrame:
    """Rows before/after each step of a plan, and how many it removed.

    ``stages`` are the successive step outputs (each derived from the
    previous).  Each count is a partial-aggregated scalar; the result has one
    row per stage: (step, stage, rows_in, rows_out, removed).
    """
    parts = [source.agg(F.count(F.lit(1)).alias("rows_out")).select(
        F.lit(0).alias("step"), F.lit("source").alias("stage"), "rows_out")]
    for i, (name, d) in enumerate(stages, start=1):
        parts.append(d.agg(F.count(F.lit(1)).alias("rows_out")).select(
            F.lit(i).alias("step"), F.lit(name).alias("stage"), "rows_out"))
    counts = reduce(lambda a, b: a.unionByName(b), parts)
    # one row per stage: the window below runs over len(stages)+1 rows
    w = Window.orderBy("step")
    out = counts.withColumn("rows_in", F.lag("rows_out").over(w)).where(F.col("step") > 0)
    return out.select("step", "stage", "rows_in", "rows_out",
                      (F.col("rows_in") - F.col("rows_out")).alias("removed"))


def stage_audit_filters(df: DataFrame, stages: list[tuple[str, Column]]) -> DataFrame:
    """Like ``stage_audit`` for a chain of filters, counted in one scan.

    ``stages`` is an ordered list of (name, keep-condition); stage i keeps
    the rows passing conditions 1..i.
    """
    aggs = [F.count(F.lit(1)).alias("_c0")]
    acc = F.lit(True)
    for i, (_, cond) in enumerate(stages, start=1):
        acc = acc & F.coalesce(cond, F.lit(False))
        aggs.append(F.count_if(acc).alias(f"_c{i}"))
    counts = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(name).alias("stage"),
                 F.col(f"_c{i - 1}").alias("rows_in"), F.col(f"_c{i}").alias("rows_out"))
        for i, (name, _) in enumerate(stages, start=1)])
    return (counts.select(F.inline(rows))
            .withColumn("removed", F.col("rows_in") - F.col("rows_out")))


def audit_filter_and_dedup(df: DataFrame, key: str, keep: str, names: tuple[str, str]) -> DataFrame:
    """Like ``stage_audit`` for a filter and a dedup, counted in one scan.

    ``keep`` is the filter's result, the same in all rows of one ``key``."""
    groups = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max(F.coalesce(F.col(keep), F.lit(False))).alias("kept"))
    counts = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("c0"),
                        F.coalesce(F.sum(F.when(F.col("kept"), F.col("n"))), F.lit(0)).alias("c1"),
                        F.count_if("kept").alias("c2"))
    rows = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(name).alias("stage"), F.col(f"c{i}").alias("rows_in"),
                              F.col(f"c{i + 1}").alias("rows_out")) for i, name in enumerate(names)])
    return counts.select(F.inline(rows)).withColumn("removed", F.col("rows_in") - F.col("rows_out"))


def observe_stage(df: DataFrame, name: str):
    """Attach a row-count metric to a live plan (no extra job).

    Returns (df, observation); read ``observation.get`` after an action.  Put it last, right
    before a write: a shuffle above it may run its tasks again and count rows twice.
    """
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def priority_sort(df: DataFrame, c, ranks: dict, then_by=(), unknown_rank: int | None = None,
                  rank_col: str = "priority") -> DataFrame:
    """Sort ascending by a configured rank of a categorical column.

    The rank table is a literal map inside the expression (size is the
    configuration's size), so no join is planned at all.
    """
    m = F.create_map(*[x for k, v in ranks.items() for x in (F.lit(k), F.lit(v))])
    r = F.element_at(m, col_of(c))
    if unknown_rank is not None:
        r = F.coalesce(r, F.lit(unknown_rank))
    out = df.withColumn(rank_col, r)
    return out.orderBy(F.col(rank_col).asc_nulls_last(), *[col_of(x) for x in then_by])


def union_drift(frames: list[DataFrame]) -> DataFrame:
    """Concatenate frames whose columns differ; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def seeded_uniform_key(key, seed: int) -> Column:
    """A repeatable pseudo-random key per row: the first 32 bits of
    md5("<key>:<seed>") as a bigint in [0, 2^32).  It depends only on the key,
    not on partitioning or task order, and any engine with md5 reproduces it."""
    h = F.md5(F.concat(col_of(key).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


#: Up to this many sampled rows end in one top-k merge.
TOP_K_ROWS = 1_000


def _nth(values: DataFrame, n: int) -> tuple[int, int] | None:
    """The value at rank ``n`` of a column ``v`` and the number of rows below it; ``None`` if
    there are fewer rows.  ``v`` has at most 65,536 values."""
    run = values.groupBy("v").agg(F.count(F.lit(1)).alias("c")).withColumn("upto", F.sum("c").over(Window.orderBy("v")))
    hit = run.where(F.col("upto") >= n).orderBy("v").first()
    return None if hit is None else (hit["v"], hit["upto"] - hit["c"])


def sample_n(df: DataFrame, n: int, key, seed: int = 0) -> DataFrame:
    """Repeatable sample of ``n`` rows without replacement: the rows with the least seeded
    hash of their key, ties by key (nulls first).

    Up to ``TOP_K_ROWS`` rows, ``orderBy().limit()`` is a distributed top-k.  A larger sample
    is selected where its rows lie: two histograms of the hash (its upper and its lower 16
    bits) give the hash at rank ``n``, rows below it are taken by a filter, and only rows with
    just that hash are cut by key.  Among rows that share the key at the cut, any may be taken.
    """
    k = col_of(key)
    h = F.coalesce(seeded_uniform_key(key, seed), F.lit(-1))
    d = df.withColumn("_tw_h", h)
    if n <= TOP_K_ROWS:
        return d.orderBy("_tw_h", k).limit(n).drop("_tw_h")
    upper, lower = F.shiftright("_tw_h", 16), F.col("_tw_h").bitwiseAND(F.lit(0xFFFF))
    high = _nth(d.select(upper.alias("v")), n)
    if high is None:
        return df
    low = _nth(d.where(upper == high[0]).select(lower.alias("v")), n - high[1])
    edge, left = (high[0] << 16) | low[0], n - high[1] - low[1]
    # rows with the hash at the cut: keys in order, then rows of the key at the cut
    tied = d.where(F.col("_tw_h") == edge).withColumn("_tw_k", k)
    per_key = tied.groupBy("_tw_k").count()
    upto = F.sum("count").over(Window.orderBy(F.col("_tw_k").asc_nulls_first()))
    cut = per_key.withColumn("upto", upto).where(F.col("upto") >= left).orderBy("upto").first()
    left -= cut["upto"] - cut["count"]
    here, cut_key = F.col("_tw_k"), F.lit(cut["_tw_k"])
    whole = d.where(F.col("_tw_h") < edge).drop("_tw_h")
    if cut["_tw_k"] is not None:
        whole = whole.unionByName(tied.where(here.isNull() | (here < cut_key)).drop("_tw_h", "_tw_k"))
    last = tied.where(here.eqNullSafe(cut_key)).drop("_tw_h", "_tw_k")
    return whole.unionByName(last if left == cut["count"] else _first_rows(last, left))


def _first_rows(df: DataFrame, n: int) -> DataFrame:
    """``n`` rows of ``df``, written first and cut by running totals of its partitions."""
    checkpoint_root(df.sparkSession)
    d = df.checkpoint().withColumn("_tw_row", F.monotonically_increasing_id())
    d = d.withColumn("_tw_part", F.shiftright("_tw_row", 33))
    sizes = d.groupBy("_tw_part").count()
    before = F.sum("count").over(Window.orderBy("_tw_part")) - F.col("count")
    starts = sizes.select("_tw_part", before.alias("_tw_before"))
    place = F.col("_tw_before") + F.col("_tw_row").bitwiseAND(F.lit((1 << 33) - 1))
    return d.join(starts, "_tw_part").where(place < n).select(*[d[c] for c in df.columns])


def weighted_stratified_sample(df: DataFrame, c, fractions: dict, key, seed: int = 0) -> DataFrame:
    """Per-category Bernoulli sample with category weights.

    Same contract as ``sampleBy`` (each row of category k kept with
    probability fractions[k], categories not listed dropped), but the draw
    is a seeded hash of the row key instead of a per-partition random
    stream, so the sample does not change with partitioning or retries.
    """
    m = F.create_map(*[x for k, v in fractions.items() for x in (F.lit(k), F.lit(float(v)))])
    frac = F.coalesce(F.element_at(m, col_of(c)), F.lit(0.0))
    u = seeded_uniform_key(key, seed) / F.lit(float(2 ** 32))
    return df.where(u < frac)
