import datetime as dt

from pyspark.sql import functions as F

from tidewash.functions import records as R


def test_iso_round_trip_and_units(spark):
    rows = [(1, dt.datetime(2024, 1, 1, 0, 0, 7, 179575)), (2, dt.datetime(2024, 1, 2, 3, 4, 5))]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    out = df.select("id", "ts", R.iso_timestamp_string("ts").alias("iso"),
                    R.epoch_micros("ts").alias("us")).orderBy("id").collect()
    assert [r.iso for r in out] == [r[1].isoformat() for r in rows]
    back = df.select(R.parse_iso_timestamp(R.iso_timestamp_string("ts")).alias("b"), "ts").collect()
    assert all(r.b == r.ts for r in back)
    assert out[0].us == int((rows[0][1] - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    assert df.select(R.int_unit_convert(F.lit(1_999_999), 1_000_000).alias("x")).first().x == 1


def test_json_path_defaults_and_ids(spark):
    df = spark.createDataFrame([('{"k": 5, "meta": {"source": "a"}}',), ('{"k": "x"}',), (None,)], "p string")
    got = df.select(R.json_field_path("p", ["k"], as_type="int").alias("k"),
                    R.json_field_path("p", ["meta", "source"], default="none").alias("m")).collect()
    assert [(r.k, r.m) for r in got] == [(5, "a"), (None, "none"), (None, "none")]
    ids = spark.range(3).select(R.surrogate_id("id", width=8).alias("s")).collect()
    assert len({r.s for r in ids}) == 3 and all(len(r.s) == 8 for r in ids)
    assert spark.range(1).select(R.coalesce_default(F.lit(None).cast("string"), "general").alias("d")).first().d == "general"


def test_int_unit_convert_is_exact_floor_division(spark):
    vals = [1_700_000_000_123_456_789, 9_007_199_254_740_993, -1, -1_000_001, 999_999, 0]
    df = spark.createDataFrame([(v,) for v in vals], "x long")
    got = [r.y for r in df.select(R.int_unit_convert("x", 1_000_000).alias("y")).collect()]
    assert got == [v // 1_000_000 for v in vals]


def test_json_fields_parse_once(spark):
    df = spark.createDataFrame([('{"k": 5, "meta": {"source": "a"}}',), ('{"k": "x"}',), (None,), ("not json",)],
                               "p string")
    got = df.select(*R.json_fields("p", {"k": (["k"], "int"), "m": (["meta", "source"], "string", "none")})).collect()
    assert [(r.k, r.m) for r in got] == [(5, "a"), (None, "none"), (None, "none"), (None, "none")]
