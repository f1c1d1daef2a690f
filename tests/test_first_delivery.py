from tidewash.plans import clean
from tidewash.sources import jsonl
from tidewash.streaming import ingest

SCHEMA = "k long, j string, at long, v string"


def _batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_first_deliveries_over_batches_and_retries(spark, tmp_path):
    path = str(tmp_path / "sink")
    sink = ingest.first_delivery_sink(path, ["k", "j"], "at")
    first = _batch(spark, [(1, "a", 2, "late"), (1, "a", 1, "early"), (None, "a", 1, "n1"), (None, "a", 1, "n2"), (2, "b", 1, "x")])
    second = _batch(spark, [(1, "a", 0, "again"), (1, "b", 5, "other key"), (None, "a", 1, "n3")])
    sink(first, 0)
    sink(second, 1)
    want = sorted(["early", "n1", "n2", "x", "other key", "n3"])
    assert sorted(r.v for r in ingest.read_deliveries(spark, path, first.schema).collect()) == want
    sink(second, 1)  # a retried batch neither doubles its rows nor loses them as repeats
    assert sorted(r.v for r in ingest.read_deliveries(spark, path, first.schema).collect()) == want
    sink(_batch(spark, []), 2)
    sink(first, 3)
    got = sorted(r.v for r in ingest.read_deliveries(spark, path, first.schema).collect())
    assert got == sorted([*want, "n1", "n2"])  # rows without a whole key are never repeats


def test_no_batch_yet(spark, tmp_path):
    schema = _batch(spark, []).schema
    assert ingest.read_deliveries(spark, str(tmp_path / "none"), schema).count() == 0


def test_clean_files_with_column_roles(spark, tmp_path):
    """Length and hash look at the answer, survivors are grouped by the question, the best score stays."""
    long = "an answer with more than thirty characters in it, number "
    rows = [(1, "What is it?", long + "one two three", "en", "s", 0.2), (2, " what is IT?", long + "four five six seven", "en", "s", 0.9),
            (3, "What is it?", long + "one two three", "en", "s", 0.5), (4, "Why?", "short", "en", "s", 0.9),
            (5, "How?", long + "eight", None, "s", None), (6, "What is it?", None, "en", "s", 1.0)]
    schema = "doc_id long, question string, answer string, lang string, source string, score double"
    jsonl.write_jsonl(spark.createDataFrame(rows, schema).coalesce(1), str(tmp_path / "in"), mode="overwrite")
    docs = spark.createDataFrame([], schema).schema
    report = clean.clean_files(spark, str(tmp_path / "in"), docs, str(tmp_path / "out"), near_dup="none",
                               text_cols=("answer", "question"), key_col="question", survivor_order=(("score", False),))
    got = {(r.section, r.name): r.n for r in report.collect()}
    assert {n: got["removed", n] for n in ("min_length", "exact_dedup", "near_dup", "survivorship")} == {
        "min_length": 2, "exact_dedup": 1, "near_dup": 0, "survivorship": 1}
    assert got["file", "total"] == 6 and got["lang", "unknown"] == 1
    kept = spark.read.schema(docs).json(str(tmp_path / "out"))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 5]
