import os

import pytest
from pyspark.sql import types as T

from tidewash.session import scratch_path
from tidewash.sources import jsonl

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("domain", T.StringType())])


def _write_lines(path, lines, name="part-0.jsonl"):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_tolerant_quarantines_and_strict_fails(spark):
    base = scratch_path(spark, "t-jsonl")
    lines = ['{"id": 1, "text": "héllo", "domain": "a"}', "", "   ", '{"id": 2, "text": "x"',
             '["not", "an", "object"]', '"bare"', '{"id": 3, "text": "ok"}']
    _write_lines(base, lines)
    good, bad = jsonl.read_jsonl_tolerant(spark, base, SCHEMA)
    assert sorted((r.id, r.text, r.domain) for r in good.collect()) == [(1, "héllo", "a"), (3, "ok", None)]
    assert sorted(r._corrupt_record for r in bad.collect()) == sorted(
        ['{"id": 2, "text": "x"', '["not", "an", "object"]', '"bare"'])
    with pytest.raises(Exception):
        jsonl.read_jsonl_strict(spark, base, SCHEMA).collect()
    ok = scratch_path(spark, "t-jsonl-ok")
    _write_lines(ok, [lines[0], "", lines[-1]])
    assert jsonl.read_jsonl_strict(spark, ok, SCHEMA).count() == 2


def test_json_arrays(spark):
    base = scratch_path(spark, "t-arr")
    os.makedirs(base + "/o", exist_ok=True)
    os.makedirs(base + "/s", exist_ok=True)
    with open(base + "/o/a.json", "w") as f:
        f.write('[\n {"id": 1, "text": "a", "domain": "d"},\n {"id": 2, "text": "b"}\n]\n')
    with open(base + "/s/a.json", "w") as f:
        f.write('["one", "two",\n "three"]')
    assert jsonl.read_json_array(spark, base + "/o", SCHEMA).count() == 2
    assert sorted(r.text for r in jsonl.read_json_string_array(spark, base + "/s").collect()) == ["one", "three", "two"]


def test_multi_file_scan_and_sinks(spark):
    base = scratch_path(spark, "t-multi")
    _write_lines(base + "/raw_a", ['{"id": 1, "text": "x"}', '{"id": 2, "text": "y"}'])
    _write_lines(base + "/my_CLEANED", ['{"id": 3, "text": "z"}'])
    _write_lines(base + "/progress", ['{"id": 4, "text": "w"}'])
    df = jsonl.multi_file_scan(spark, base, SCHEMA)
    assert sorted(r.id for r in df.collect()) == [1, 2]
    counts = {r.source_file: r.n for r in jsonl.per_source_counts(df).collect()}
    assert counts == {"raw_a": 2, None: 2}
    out = scratch_path(spark, "t-sink")
    jsonl.write_jsonl(df.select("id", "text", "domain"), out, mode="append")
    jsonl.write_jsonl(df.select("id", "text", "domain"), out, mode="append")
    assert jsonl.read_jsonl_strict(spark, out, SCHEMA).count() == 4
    text = "".join(open(os.path.join(out, f)).read() for f in os.listdir(out) if f.endswith(".json"))
    assert '"domain":null' in text
    jsonl.write_jsonl(df.select("id", "text", "domain").limit(1), out, mode="overwrite")
    assert jsonl.read_jsonl_strict(spark, out, SCHEMA).count() == 1


def test_resume_run_skips_done_and_logs_progress(spark):
    from pyspark.sql import functions as F

    from tidewash.plans import resume

    base = scratch_path(spark, "t-resume")
    work = spark.createDataFrame([(i, f"t{i}") for i in range(20)], "id long, text string")
    jsonl.write_jsonl(work.where("id < 3").select("id"), base + "/progress")

    def process(p):
        return p.select("id", F.upper("text").alias("text"))

    first = resume.resume_run(work.where("id < 10"), "id", process, base + "/res", base + "/progress")
    assert sorted(r.id for r in first.collect()) == list(range(3, 10))
    second = resume.resume_run(work, "id", process, base + "/res", base + "/progress")
    assert sorted(r.id for r in second.collect()) == list(range(10, 20))
    third = resume.resume_run(work, "id", process, base + "/res", base + "/progress")
    assert third.count() == 0
    res = spark.read.json(base + "/res", schema="id long, text string")
    assert sorted(r.id for r in res.collect()) == list(range(3, 20))
    prog = spark.read.json(base + "/progress", schema="id long")
    assert sorted(r.id for r in prog.collect()) == list(range(20))


def test_multi_file_scan_glob_list(spark):
    base = scratch_path(spark, "t-glob")
    _write_lines(base + "/a", ['{"id": 1, "text": "x"}'])
    _write_lines(base + "/b", ['{"id": 2, "text": "y"}'], name="run_cleaned.jsonl")
    named = [base + "/a/*.jsonl", base + "/b/*.jsonl", base + "/none/*.jsonl"]
    df = jsonl.multi_file_scan(spark, named, SCHEMA)  # named files are taken as they are
    assert sorted((r.id, r.source_file) for r in df.collect()) == [(1, "part-0.jsonl"), (2, "run_cleaned.jsonl")]
    df = jsonl.multi_file_scan(spark, named, SCHEMA, exclude_words=("CLEANED",))
    assert [(r.id, r.source_file) for r in df.collect()] == [(1, "part-0.jsonl")]


def test_no_input_gives_an_empty_frame(spark):
    base = scratch_path(spark, "t-none")
    for missing in (base, [base + "/*.jsonl"], []):
        df = jsonl.multi_file_scan(spark, missing, SCHEMA)
        assert df.columns == ["id", "text", "domain", "source_file"] and df.count() == 0
    os.makedirs(base)
    assert jsonl.multi_file_scan(spark, base, SCHEMA).count() == 0


TORN = ['{"id": 2}{"id": 3}', '{"id": 4} trailing', '{"id": 5}, {"id": 6}', '{"id": 7}] [1', '{"id": 8}}', '{"id": 9},"x"',
        '{"id": 10} null', ',{"id": 11}', '{"id": 12}]', '{"id": 13},']
WHOLE = ['{"id": 1, "text": "}{ ] , \\" é"}', '  {"id": 20, "text": null}\t', '{"id": 21, "more": {"a": [1, {"b": "]"}]}}']


def test_a_line_is_exactly_one_value(spark):
    base = scratch_path(spark, "t-torn")
    _write_lines(base, TORN + WHOLE)
    good, bad = jsonl.read_jsonl_tolerant(spark, base, SCHEMA)
    assert sorted((r.id, r.text) for r in good.collect()) == [(1, '}{ ] , " é'), (20, None), (21, None)]
    assert sorted(r._corrupt_record for r in bad.collect()) == sorted(TORN)


@pytest.mark.parametrize("line", TORN)
def test_strict_refuses_torn_lines_even_for_a_count(spark, line):
    base = scratch_path(spark, "t-refused")
    _write_lines(base, WHOLE + [line])
    for read in (lambda: jsonl.read_jsonl_strict(spark, base, SCHEMA), lambda: jsonl.multi_file_scan(spark, base, SCHEMA)):
        with pytest.raises(Exception, match="malformed JSON line"):
            read().count()
    fine = scratch_path(spark, "t-whole")
    _write_lines(fine, WHOLE)
    assert jsonl.read_jsonl_strict(spark, fine, SCHEMA).count() == 3
