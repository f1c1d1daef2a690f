"""The part keys of the near-duplicate join: complete, and few by chance."""

import random

import pytest

from tidewash.operators import similarity as S


def _sets(spark, rows):
    return S.RankedSets(spark.createDataFrame(rows, "id long, text string").repartition(4), "id", "text").sets


@pytest.mark.parametrize("num,den", [(1, 2), (3, 5), (17, 20), (19, 20), (1, 1)])
def test_size_classes_hold_all_similar_sizes(num, den):
    bounds = S._size_classes(900, num, den)
    cls = lambda n: sum(1 for b in bounds if b <= n) - 1
    for n in range(1, 700):
        assert cls(min(n * den // num, 900)) - cls(n) in (0, 1)


@pytest.mark.parametrize("threshold,num,den", [(0.5, 1, 2), (0.6, 3, 5), (0.85, 17, 20), (0.95, 19, 20)])
def test_every_pair_at_the_threshold_shares_a_key(spark, threshold, num, den):
    """Sizes across class borders, tokens of every frequency; pairs as similar as the threshold asks, just."""
    rnd, rows, pairs = random.Random(3), [], set()
    words = [f"c{i}" for i in range(60)]
    for k, n in enumerate([2, 3, 5, 8, 13, 21, 40, 77, 130, 260, 511, 513, 700]):
        for extra in sorted({0, n * (den - num) // den, n * (den - num) // (2 * den)}):
            common = -(-num * n // den) if extra == 0 else n
            base = [w if rnd.random() < 0.4 else f"{k}x{extra}y{i}" for i, w in enumerate((words * 12)[:n])]
            base = list(dict.fromkeys(base))
            common = min(common, len(base))
            other = base[:common] + [f"o{k}x{extra}y{i}" for i in range(extra)]
            a, b = set(base), set(other)
            rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(other))]
            if a != b and len(a & b) * den >= num * len(a | b):
                pairs.add((len(rows) - 2, len(rows) - 1))
    got = {(r.id_a, r.id_b) for r in S.near_dup_pairs_of_sets(_sets(spark, rows), threshold, strict=False).collect()}
    assert pairs and pairs <= got


def test_few_candidates_by_chance(spark):
    """Unlike texts of one vocabulary: shared prefix tokens give pairs by the square of the rows, shared parts next to none."""
    rnd = random.Random(5)
    vocab, odds = [f"v{i}" for i in range(3000)], [1 / (i + 5) for i in range(3000)]
    sets = _sets(spark, [(i, " ".join(rnd.choices(vocab, odds, k=150))) for i in range(1000)])
    p = S.posting_lists(sets, S.sketches(sets), 17, 20)
    q = S.prefix_tokens(sets, 17, 20)
    by_prefix = q.alias("a").join(q.alias("b"), "tok").where("a.id < b.id").select("a.id", "b.id").distinct().count()
    by_parts = S._candidates(p, p, 17, 20).count()
    assert by_prefix > 10_000 and by_parts * 50 < by_prefix, (by_prefix, by_parts)


@pytest.mark.parametrize("wide", [True, False])
def test_edits_against_the_table(wide):
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rnd = random.Random(8)
    for k in range(200):
        a = "".join(rnd.choices("aab\u00e9\U0001f600 ", k=rnd.randrange(90)))
        b = "".join(c for c in a if rnd.random() < 0.9) + "xy" * (k % 3) if k % 2 else "".join(rnd.choices("ab\u00e9 ", k=rnd.randrange(90)))
        if wide:
            assert S._edits(a.encode("utf-32-le"), b.encode("utf-32-le"), True) == plain(a, b)
        else:
            assert S._edits(a.encode(), b.encode(), False) == plain(a.encode(), b.encode())


def test_edits_of_long_texts_take_no_table():
    import time

    rnd = random.Random(9)
    a = "".join(rnd.choices("abcdefgh ", k=60_000))
    b = "".join(c if rnd.random() < 0.9 else rnd.choice("xyz") for c in a)
    start = time.monotonic()
    d = S._edits(a.encode(), b.encode(), False)
    assert 5000 < d < 6500 and time.monotonic() - start < 20  # a table has 3.6e9 cells
