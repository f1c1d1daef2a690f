"""Pairs of large groups of near-copies: compared in cells, to which a text goes once."""

import random

import numpy as np
import pytest

from tidewash.operators import similarity as S


def _plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("together", [True, False])
def test_distances_against_the_table(together, monkeypatch):
    """Any guess and bound, in bands for many pairs at once and for one pair."""
    monkeypatch.setattr(S, "_alone", lambda size, words: np.full(len(size), not together))
    rnd, texts, want = random.Random(4), [], []
    for k in range(60):
        a = "".join(rnd.choices("aabé\U0001f600 cd", k=rnd.choice([0, 1, 30, 130, 300])))
        keep = rnd.choice([0.4, 0.9, 0.98])
        b = "z" * rnd.choice([0, 0, 40]) + "".join(c if rnd.random() < keep else rnd.choice(["", "x", "yz"]) for c in a) + "q" * rnd.choice([0, 3, 70])
        a, b = (a, b) if k % 2 else (b, a)
        texts += [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in (a, b)]
        want.append(_plain(a, b))
    x, want = np.arange(0, len(texts), 2), np.array(want)
    for most in (0, 40, 1000):
        for guess in (1, 100, 500, 1500):
            got = S._distances(texts, x, x + 1, np.full(len(x), guess), np.full(len(x), most))
            assert ((got == want) | ((got > most) & (want > most))).all()


def _copies(n, words=120):
    rnd, base = random.Random(6), [f"b{i}é" for i in range(words)]
    rows = []
    for i in range(n):
        own = list(base)
        for _ in range(rnd.randrange(5)):
            own[rnd.randrange(words)] = f"x{rnd.randrange(10 ** 6)}"
        rows.append((i, " ".join(own)))
    return rows


def test_a_text_is_not_sent_to_each_of_its_pairs(spark, monkeypatch):
    """300 near-copies have some 27,000 pairs; each text goes to a few cells, of few pairs each."""
    monkeypatch.setattr(S, "BLOCK_MEMBERS", 32)
    rows = _copies(300)
    sent, cut = [], S._cells

    def cells(pairs, sizes):
        found = cut(pairs, sizes)
        sent.append((found.count(), S._asked(found).count(), found.groupBy("cell").count().selectExpr("max(count)").first()[0]))
        return found

    monkeypatch.setattr(S, "_cells", cells)
    df = spark.createDataFrame(rows, "id long, text string")
    got = {(r.id_a, r.id_b): (r.edit_distance, r.edit_ratio) for r in S.near_dup_pairs_edit(df, "id", "text", 0.85, 0.85).collect()}
    assert len(sent) == 2 and len(got) > 20_000  # the sets, then the texts
    for pairs, asked, most in sent:
        assert pairs >= len(got) and asked * 5 < pairs and most < 4 * 32 * 32, sent
    for (a, b), (d, ratio) in random.Random(7).sample(sorted(got.items()), 40):
        ta, tb = rows[a][1], rows[b][1]
        assert d == _plain(ta, tb) and ratio == 1 - d / max(len(ta), len(tb))


def test_texts_of_repeated_ids_each_meet(spark):
    """Each pair of ids comes with each text of both, as often as the ids are paired."""
    a, b = "a b c d e f g h i j", "a b c d e f g h i j k"
    df = spark.createDataFrame([(1, a), (1, a), (2, b), (2, "short"), (None, a), (3, None)], "id long, text string")
    pairs = S.near_dup_pairs(df, "id", "text").count()
    got = [(r.id_a, r.id_b, r.edit_distance) for r in S.near_dup_pairs_edit(df, "id", "text").collect()]
    assert pairs == 2 and got == [(1, 2, 2)] * 4


def test_nothing_passing_is_left(spark):
    import os
    from pathlib import Path
    from urllib.parse import urlparse

    folder = Path(os.path.dirname(urlparse(S.scratch_path(spark, "any")).path))
    names = lambda: {p.name for p in folder.iterdir()} if folder.exists() else set()
    before = names()
    df = spark.createDataFrame(_copies(20), "id long, text string")
    out = S.near_dup_pairs_edit(df, "id", "text")
    left = {n.rsplit("-", 1)[0] for n in names() - before}
    assert left == {"neardup-pairs", "neardup-edits"} and out.count() > 0
    assert spark.conf.get(S.SHUFFLE_CLEANUP, "false") == "false"
