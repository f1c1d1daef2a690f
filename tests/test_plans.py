"""Physical-plan properties that matter at scale (checked on sf0.001)."""

import pytest

from conftest import SF001

CHEAP = ["category_filter", "code_in_set", "resume_anti_join", "exact_dedup", "cap_per_session",
         "running_tally", "consecutive_runs", "first_crossing", "group_count_sorted",
         "multi_dim_counts", "best_per_group", "group_size", "near_dup_pairs", "clean_and_count",
         "keyword_any", "union_drift", "priority_sort", "throughput_eta", "every_nth_summary"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHEAP)
def test_no_cartesian_or_nested_loop_joins(spark, name):
    import __spark_entry__ as E

    plan = _plan(E.queries()[name](spark, SF001))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    import __spark_entry__ as E

    plan = _plan(E.queries()["category_filter"](spark, SF001))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,fr)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string>" in plan
    plan = _plan(E.queries()["code_in_set"](spark, SF001))
    assert "PushedFilters: [In(user_id" in plan
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan


def test_top_n_per_key_is_map_side(spark):
    import __spark_entry__ as E

    plan = _plan(E.queries()["cap_per_session"](spark, SF001))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_dedup_aggregates_before_the_shuffle(spark):
    import __spark_entry__ as E

    plan = _plan(E.queries()["exact_dedup"](spark, SF001))
    assert "partial_min(doc_id" in plan and "SortAggregate" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    plan = _plan(E.queries()["clean_and_count"](spark, SF001))
    assert "partial_min_by" in plan and "partial_count" in plan


def test_posting_list_heads_use_group_limit(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import Window

    from tidewash.operators import similarity as S

    df = spark.createDataFrame([(i, f"a b c d{i}") for i in range(50)], "id long, text string")
    p = S.prefix_tokens(S.RankedSets(df, "id", "text").sets, 17, 20)
    heads = p.withColumn("_r", F.row_number().over(Window.partitionBy("tok").orderBy("id"))).where("_r <= 4")
    assert "WindowGroupLimit" in _plan(heads)


@pytest.mark.parametrize("what", ["token frequencies", "members"])
def test_hot_key_joins_are_split(spark, what):
    """A token or token set that most rows have: AQE splits its join."""
    from pyspark.sql import functions as F

    from tidewash.operators import similarity as S

    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
               "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
               "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k"}
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        text = F.concat(F.lit("hot x"), F.col("id")) if what == "token frequencies" else F.when(
            F.col("id") % 5 > 0, F.lit("same text")).otherwise(F.concat(F.lit("own"), F.col("id")))
        df = spark.range(0, 20_000, 1, 8).select("id", text.alias("text"))
        if what == "members":
            out = S.duplicate_members(df, "id", "text")
        else:
            reps = S.materialize(S.token_sets(df, "id", "text").select("id", "toks", "n"))
            freq = S.materialize(reps.select(F.explode("toks").alias("tok")).groupBy("tok").count())
            out = reps.select("id", "n", F.explode("toks").alias("tok")).join(freq, "tok")
        out.write.format("noop").mode("overwrite").save()
        out.collect()
        assert "skew=true" in _plan(out)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
