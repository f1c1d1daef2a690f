"""Keys that share a state of ``run_alerts``."""

import datetime as dt
import inspect

from tidewash.session import scratch_path
from tidewash.streaming import ingest


def test_keys_of_one_bucket_keep_apart(spark):
    """All keys in one state, among them null, empty and whole numbers beyond 2**53."""
    base, t0 = scratch_path(spark, "t-bucket"), dt.datetime(2024, 1, 10)
    big = 2 ** 60
    schema = "k long, event_id long, ts timestamp_ntz, failed boolean"
    batches = [[(big, 1, 0, True), (big + 1, 2, 0, True), (None, 3, 0, True), (big, 4, 1, True), (None, 5, 1, True)],
               [(big + 1, 6, 9, False), (big, 7, 9, True), (None, 8, 9, True), (big + 1, 9, 9, True)]]
    for rows in [*batches, None]:
        if rows is None:
            ingest.end_mark(spark, base + "/in", spark.read.parquet(base + "/in").schema, "ts", "2200-01-01")
        else:
            spark.createDataFrame([(k, i, t0 + dt.timedelta(hours=h), f) for k, i, h, f in rows], schema).write.mode("append").parquet(base + "/in")
        stream = ingest.file_stream(spark, base + "/in", spark.read.parquet(base + "/in").schema)
        ingest.run_available(ingest.run_alerts(stream, "k", "ts", "event_id", "failed", 3, "2 hours", buckets=1), base + "/ck", sink_path=base + "/out")
    out = spark.read.parquet(base + "/out")
    assert dict(out.dtypes)["k"] == "bigint"
    assert {(r.k, r.event_id, r.run_len) for r in out.collect()} == {(big, 7, 3), (None, 8, 3)}


def test_states_do_not_grow_with_the_keys():
    assert inspect.signature(ingest.run_alerts).parameters["buckets"].default == 1024
