import hashlib

import pytest
from pyspark.sql import functions as F

from tidewash.functions.records import round_fixed_binary
from tidewash.operators import stats


def _rank(key, seed):
    return -1 if key is None else int(hashlib.md5(f"{key}:{seed}".encode()).hexdigest()[:8], 16)


@pytest.mark.parametrize("n", [0, 5, 30, 59, 60, 100])
def test_large_samples_equal_the_sorted_head(spark, monkeypatch, n):
    monkeypatch.setattr(stats, "TOP_K_ROWS", 3)
    keys = [None, None, *range(40), *[7] * 18]  # a null key and a key with many rows
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i long").repartition(5)
    got = [r.k for r in stats.sample_n(df, n, "k", seed=3).collect()]
    want = sorted(keys, key=lambda k: (_rank(k, 3), k is not None, k))[:n]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_the_cut_among_equal_hashes_is_by_key(spark, monkeypatch):
    monkeypatch.setattr(stats, "TOP_K_ROWS", 0)
    monkeypatch.setattr(stats, "seeded_uniform_key", lambda key, seed: F.lit(70_000).cast("bigint"))
    df = spark.createDataFrame([(k,) for k in [None, *"ddbbbaac"]], "k string").repartition(4)
    for n in range(1, 11):
        got = [r.k for r in stats.sample_n(df, n, "k").collect()]
        assert sorted(got, key=str) == sorted([None, *"aabbbcdd"][:n], key=str)


def test_rounding_of_the_binary_value(spark):
    values = [0.125, 2.675, -0.125, 0.375, 1.005, 2.5, 3.5, -2.5, 0.0, 1e300, 4503599627370497.5, 2251799813685248.25,
              0.1 + 0.2, 1e-320, 9007199254740993.0, 123456789.12345678, 5e15 / 3, -1e15 / 7, None]
    values += [i / 8 for i in range(-40, 40)] + [i / 1000 for i in range(-999, 1000, 3)] + [1.1 ** i for i in range(-300, 380, 7)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 1, 2, 3, 7, 15):
        got = [r.x for r in df.select(round_fixed_binary("v", digits).alias("x")).collect()]
        assert got == [None if v is None else float(round(v, digits)) for v in values]
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),)], "v double")
    assert [str(r.x) for r in odd.select(round_fixed_binary("v", 2).alias("x")).collect()] == ["nan", "inf", "-inf"]
    with pytest.raises(ValueError):
        round_fixed_binary("v", 23)
