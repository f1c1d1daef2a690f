"""The banded join misses no pair of ``near_dup_pairs``."""

import random

import pytest

from tidewash.operators import similarity as S


def corpus():
    """Pairs of token sets just above, at and below a similarity of 0.85, of few and many tokens."""
    rows = []
    for k in range(60):
        for common, only in ((851, 150), (850, 150), (849, 151), (18, 3), (17, 3), (16, 3)):
            shared = [f"{k}c{only}x{common}n{i}" for i in range(common)]
            rest = [f"{k}r{only}x{common}n{i}" for i in range(only)]
            cut = only // 2
            for part in (rest[:cut], rest[cut:]):
                words = shared + part
                random.Random(len(rows)).shuffle(words)
                rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize("strict,per", [(True, 2), (False, 4)])
def test_complete_against_the_exact_join(spark, strict, per):
    df = spark.createDataFrame(corpus(), "id long, text string").repartition(8)
    want = {tuple(r) for r in S.near_dup_pairs(df, "id", "text", 0.85, strict).collect()}
    assert {tuple(r) for r in S.near_dup_pairs_approx(df, "id", "text", 0.85, strict).collect()} == want
    assert len(want) == 60 * per


def test_odds_of_the_bands():
    for t in (0.1, 0.3, 0.5, 0.7, 0.85, 0.95, 0.99):
        bands, width = S.band_shape(t)
        assert (1 - t ** width) ** bands <= 1e-9 and (bands <= 32 or width == 1)
    assert S.band_shape(0.85) == (29, 4) and S.band_shape(1) == (1, 1)


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {tuple(r) for r in S.near_dup_pairs(df, "doc_id", "text").collect()}
    assert {tuple(r) for r in S.near_dup_pairs_approx(df, "doc_id", "text").collect()} == want


@pytest.mark.parametrize("tables", [None, 2])
def test_a_pair_that_shares_no_band(spark, tables):
    """6 of 7 tokens in common, and in each of the 66 bands a min-hash of the seventh is the least."""
    words = "w1931 w1422 w511 w1070 w2309 w110"
    df = spark.createDataFrame([(1, words), (2, words + " w588")], "id long, text string")
    sets = S.RankedSets(df, "id", "text").sets.select("rid", "ranks")
    bands, width = S.band_shape(0.85, most=S.WIDE_BANDS)
    keys = sets.mapInArrow(lambda b: S._band_keys(b, bands, width, 17), "rid long, key long")
    assert bands == 66 and keys.select("key").distinct().count() == 2 * bands
    assert [tuple(r) for r in S.near_dup_pairs_approx(df, "id", "text", num_hash_tables=tables).collect()] == [(1, 2, 6, 7)]
