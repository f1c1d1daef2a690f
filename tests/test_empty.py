"""Empty input: every plan returns an empty result with a stable schema."""

from pyspark.sql import functions as F

from tidewash.operators import dedup, runs, similarity, stats
from tidewash.plans import clean


def test_empty_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    out = clean.clean_and_count(docs)
    assert out.columns == ["lang", "n"] and out.count() == 0
    assert clean.cleaned_documents(docs).count() == 0
    assert similarity.near_dup_pairs(docs, "doc_id", "text").count() == 0
    assert similarity.near_dup_drop_earliest(docs, "doc_id", "text").count() == 0
    assert similarity.near_dup_drop_greedy(docs, "doc_id", "text").count() == 0
    assert clean.clean_dataset(docs, near_dup="greedy").count() == 0
    assert dedup.best_per_group(docs, "lang", [("doc_id", True)]).count() == 0
    assert dedup.multi_key_group_count(docs, "lang").first().n_groups == 0
    assert stats.multi_dim_counts(docs, ["lang", "source"]).count() == 0


def test_empty_events(spark):
    ev = spark.createDataFrame([], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
    failed = F.col("event_type") == "error"
    assert runs.running_tally(ev, ["ts", "event_id"], failed).count() == 0
    assert runs.consecutive_runs(ev, ["ts", "event_id"], failed, "event_id", partition_by="user_id").count() == 0
    fc = runs.first_crossing(ev, ["ts", "event_id"], F.col("value").cast("bigint"), [1, 2], "event_id")
    assert [r.event_id for r in fc.collect()] == [None, None]
    assert runs.cap_per_session(ev, "user_id", ["ts", "event_id"], 3).count() == 0
