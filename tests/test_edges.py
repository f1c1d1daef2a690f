"""Nulls, time zones, malformed files and shared storage."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tidewash.functions import records as R
from tidewash.functions import text as X
from tidewash.operators import dedup, filters
from tidewash.plans import resume
from tidewash.session import scratch_path
from tidewash.sources import jsonl
from tidewash.streaming import ingest


@pytest.fixture
def zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield
    spark.conf.set("spark.sql.session.timeZone", before)


def test_content_hash_tells_nulls_apart(spark):
    rows = [("a", "b"), (None, "b"), ("", "b"), ("a", None), ("a", ""), (None, None), ("", ""), (None, ""), ("", None), ("ab", ""), ("a", "bc"), ("ab", "c")]
    out = [r[0] for r in spark.createDataFrame(rows, "a string, b string").select(X.content_hash("a", "b")).collect()]
    assert None not in out and len(set(out)) == len(rows)


def test_null_keys_are_never_merged(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, "y"), (3, "k", "z"), (4, "k", "w"), (None, "k", "v")], "id long, k string, t string")
    out = dedup.exact_dedup(df, "k", "id")
    assert sorted(((r.id, r.k, r.t) for r in out.collect()), key=repr) == [(1, None, "x"), (2, None, "y"), (3, "k", "z")]
    narrow = dedup.exact_dedup(df.select("id", "k"), "k", "id")
    assert sorted(((r.id, r.k) for r in narrow.collect()), key=repr) == [(1, None), (2, None), (3, "k")]


def test_group_size_and_best_per_group_with_nulls(spark):
    df = spark.createDataFrame([(1, None, 5), (2, None, None), (3, "k", None), (4, "k", 7), (5, "s", None)], "id long, k string, n int")
    assert {r.id: r.group_size for r in dedup.group_size(df, "k").collect()} == {1: 2, 2: 2, 3: 2, 4: 2, 5: 1}
    best = dedup.best_per_group(df, "k", [("n", False), ("id", True)])
    assert sorted(((r.k, r.id, r.group_size) for r in best.collect()), key=repr) == [
        ("k", 4, 2), ("s", 5, 1), (None, 1, 1), (None, 2, 1)]  # a null key is no key


def test_times_do_not_depend_on_the_session_zone(spark, zone):
    text = ["2026-03-08T02:30:00", "2026-03-08T02:30:00.000500", "2024-01-01T00:00:07.179575"]
    df = spark.createDataFrame([(t,) for t in [*text, "2024-01-01", "x", None]], "s string")
    out = df.select("s", R.iso_timestamp_string(R.parse_iso_timestamp("s")).alias("back")).collect()
    assert [r.back for r in out] == [*text, None, None, None]
    now = spark.range(1).select(R.ingest_timestamp().alias("t")).first().t
    assert abs(now - dt.datetime.now(dt.UTC).replace(tzinfo=None)) < dt.timedelta(minutes=5)


def test_rounding_ties_are_those_of_sql(spark):
    df = spark.createDataFrame([(0.125,), (2.675,), (-0.125,)], "v double").select(R.round_fixed("v", 2).alias("r"))
    assert [r.r for r in df.collect()] == [0.13, 2.68, -0.13]


def test_json_path_refuses_quotes():
    with pytest.raises(ValueError):
        R.json_field_path("c", ["it's"])


@pytest.mark.parametrize("n", [1, 5, 3000])
def test_keyword_any_is_one_search_for_any_list(spark, n):
    words = ["a.b", "(x", "Straße", "k+"][:n] + [f"word{i}" for i in range(max(0, n - 4))]
    texts = ["has a.b in", "axb", "( x", "(X)", "STRASSE", "straße", "kk", "K+", "WORD2995", "word", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.h for r in df.select(filters.keyword_any("t", words).alias("h")).collect()]
    assert got == [not t or any(w.lower() in t.lower() for w in words) for t in texts]
    plan = df.select(filters.keyword_any("t", words).alias("h"))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"lower\(", plan)) == 1 and "Python" not in plan


def test_json_arrays_that_are_cut_off_fail(spark):
    base = scratch_path(spark, "t-arrays")
    spark.createDataFrame([('["a", "b',)], "value string").coalesce(1).write.text(f"{base}/s")
    spark.createDataFrame([('[{"doc_id": 1}, {"doc_id": ',)], "value string").coalesce(1).write.text(f"{base}/o")
    from tidewash.queries import DOC_SCHEMA

    with pytest.raises(Exception, match="malformed"):
        jsonl.read_json_string_array(spark, f"{base}/s").collect()
    with pytest.raises(Exception):
        jsonl.read_json_array(spark, f"{base}/o", DOC_SCHEMA).collect()


def test_multi_file_scan_below_an_awkward_folder(spark):
    base = scratch_path(spark, "t-multi") + "/my cleaned+files é"
    spark.createDataFrame([(1,)], "doc_id long").write.json(f"{base}/raw")
    spark.createDataFrame([(2,)], "doc_id long").write.json(f"{base}/Cleaned x")
    df = jsonl.multi_file_scan(spark, base, spark.createDataFrame([], "doc_id long").schema, ["cleaned"])
    assert [(r.doc_id, r.source_file) for r in df.collect()] == [(1, "raw")]


def test_tolerant_lines_are_parsed_once(spark):
    from tidewash.queries import DOC_SCHEMA

    path = scratch_path(spark, "t-lines")
    lines = ['{"doc_id": 1, "text": "a"}', "", "  ", '{"doc_id": ', '["x"]', "null", '{"text": "b"}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    tagged = jsonl.read_jsonl_tagged(spark, path, DOC_SCHEMA)
    rows = {(r.doc_id, r.text, r[jsonl.CORRUPT_COL]) for r in tagged.collect()}
    assert rows == {(1, "a", None), (None, "b", None), (None, None, '{"doc_id": '), (None, None, '["x"]'), (None, None, "null")}
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    # once for its fields, once for where its value ends
    assert len(re.findall(r"from_json\(StructField", plan)) == 1 and len(re.findall(r"from_json\(ArrayType", plan)) == 1
    assert plan.count("FileScan") == 1


def test_failed_items_come_again(spark):
    base = scratch_path(spark, "t-resume")
    work = spark.createDataFrame([(i,) for i in range(6)], "id long")
    seen = []

    def process(odd_fails):
        def go(pending):
            seen.append(sorted(r.id for r in pending.collect()))
            return pending.where("id % 2 = 0") if odd_fails else pending
        return go

    first = resume.resume_run(work, "id", process(True), f"{base}/r", f"{base}/p")
    second = resume.resume_run(work, "id", process(False), f"{base}/r", f"{base}/p")
    assert sorted(r.id for r in first.collect()) == [0, 2, 4] and sorted(r.id for r in second.collect()) == [1, 3, 5]
    assert seen == [[0, 1, 2, 3, 4, 5], [1, 3, 5]]


def test_stream_totals_over_more_than_a_hundred_batches(spark):
    base = scratch_path(spark, "t-batches")
    spark.range(0, 1300, 1, 130).write.parquet(f"{base}/in")
    stream = ingest.file_stream(spark, f"{base}/in", spark.range(1).schema, max_files_per_trigger=1)
    stats = ingest.run_available(stream, f"{base}/ck", sink_path=f"{base}/out")
    assert (stats["batches"], stats["input_rows"]) == (130, 1300)


def test_arrivals_of_an_empty_table_and_of_rows_without_a_time(spark):
    base = scratch_path(spark, "t-arrivals")
    df = spark.createDataFrame([], "id long, ts timestamp_ntz")
    for w in ingest.write_arrivals(df, "ts", f"{base}/a", 2):
        w()
    assert spark.read.schema(df.schema).parquet(f"{base}/a").count() == 0
    df = spark.createDataFrame([(1, None), (2, dt.datetime(2024, 1, 1)), (3, dt.datetime(2024, 1, 2))], df.schema)
    for w in ingest.write_arrivals(df, "ts", f"{base}/b", 2):
        w()
    assert sorted(r.id for r in spark.read.parquet(f"{base}/b").collect()) == [1, 2, 3]


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from tidewash.session import checkpoint_root

    conf = SimpleNamespace(get=lambda k, d=None: d)
    sc = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master="yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(SimpleNamespace(sparkContext=sc, conf=conf))


def test_burst_in_one_hour_is_split(spark):
    from tidewash.operators.running import ranged

    df = spark.range(4000).select("id", F.when(F.col("id") < 3900, F.lit(7)).otherwise(F.col("id")).alias("hour"))
    out = ranged(df, ["hour", "id"], "b", rows_per_bucket=500)
    sizes = [r["count"] for r in out.groupBy("b").count().collect()]
    assert len(sizes) >= 6 and max(sizes) <= 1200
    rows = sorted((r.hour, r.id, r.b) for r in out.collect())
    assert [b for *_, b in rows] == sorted(b for *_, b in rows)
