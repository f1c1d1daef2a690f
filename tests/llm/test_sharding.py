import zlib

from tests.llm.helpers import collect, docs
from tidewash.llm.sharding import shard_by_bytes


def check(rows, out, n_shards):
    assert sorted(((r["id"], r["size"], r["text_crc32"]) for r in out), key=repr) == sorted(
        ((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows), key=repr)
    total, biggest = sum(r["size"] for r in out), max((r["size"] for r in out), default=0)
    by = {}
    for r in out:
        assert 0 <= r["shard"] < n_shards
        by.setdefault(r["shard"], []).append(r)
    for s in by.values():
        assert sorted(r["slot"] for r in s) == list(range(len(s)))
        assert abs(sum(r["size"] for r in s) - total / n_shards) <= biggest + 1
    # contiguous: in the order of (shard, slot), ids never go down (null first)
    ids = [r["id"] if r["id"] is not None else -1 for r in sorted(out, key=lambda r: (r["shard"], r["slot"]))]
    assert ids == sorted(ids)


def test_balanced_contiguous_gapless(spark):
    rows = [(i, "é" * (i * 37 % 101)) for i in range(500)]
    check(rows, collect(shard_by_bytes(docs(spark, rows, clash=True), "doc_id", "text", 7)), 7)


def test_nulls_repeats_and_one_hot_id(spark):
    rows = [(None, "a"), (None, None), (3, ""), (3, "")] + [(9, "hot")] * 200 + [(i, "x" * 50) for i in range(100)]
    check(rows, collect(shard_by_bytes(docs(spark, rows), "doc_id", "text", 5)), 5)


def test_one_long_text_and_more_shards_than_rows(spark):
    out = collect(shard_by_bytes(docs(spark, [(1, "x" * 300_000), (2, "y"), (3, None)]), "doc_id", "text", 40))
    assert len(out) == 3 and all(0 <= r["shard"] < 40 for r in out)


def test_empty_table(spark):
    assert collect(shard_by_bytes(docs(spark, []), "doc_id", "text", 4)) == []


def test_query_on_whole_table(spark):
    from tidewash.llm.queries import QUERIES

    out = QUERIES["op8_sharding"](spark, "/root/testdata/sf0.001")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    check(rows, collect(out.withColumnRenamed("doc_id", "id")), 40)
    assert "Python" not in out._jdf.queryExecution().toString()
