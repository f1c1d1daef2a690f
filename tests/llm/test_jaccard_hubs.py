"""Large groups of near copies of which many just miss the threshold: no pairs by the square of the group."""

import random

import pytest

from tests.llm.test_jaccard_join import brute, collect, docs
from tidewash.llm import jaccard_join as J


def edited(rng, words, edits):
    w = list(words)
    for _ in range(edits):
        i = rng.randrange(len(w))
        kind = rng.random()
        w[i:i + 1] = [f"x{rng.randrange(10**6)}"] if kind < 0.6 else [] if kind < 0.8 else [w[i], f"y{rng.randrange(40)}"]
    return w


def found(spark, rows, size, num, den):
    out = collect(J.similarity_classes(docs(spark, rows), "doc_id", "text", size, num, den))
    return sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in out), key=repr)


def test_copies_that_miss_the_threshold_are_not_paired(spark, monkeypatch):
    rng = random.Random(11)
    base = [f"w{rng.randrange(300)}" for _ in range(150)]
    rows = [(i, " ".join(edited(rng, base, rng.randint(0, 9)))) for i in range(400)]
    tried, verified = [], J._verified

    def counted(docs_, pairs, *rest):
        tried.append(pairs.count())
        return verified(docs_, pairs, *rest)

    monkeypatch.setattr(J, "_verified", counted)
    assert found(spark, rows, 4, 85, 100) == brute(rows, 4, 85, 100)
    assert sum(tried) < 10 * len(rows), tried


@pytest.mark.parametrize("seed,size,num,den", [(2, 5, 4, 5), (3, 1, 6, 10)])
def test_groups_of_copies_of_copies(spark, seed, size, num, den):
    """Copies of edited copies share edits, so that pairs link far from the hub; lengths differ."""
    rng = random.Random(seed)
    rows, texts = [], [[f"w{rng.randrange(200)}" for _ in range(rng.randint(20, 120))] for _ in range(3)]
    for i in range(220):
        texts.append(edited(rng, rng.choice(texts[-30:] if rng.random() < 0.7 else texts[:3]), rng.randint(1, 4)))
        rows.append((1000 - i, " ".join(texts[-1])))
    assert found(spark, rows, size, num, den) == brute(rows, size, num, den)
