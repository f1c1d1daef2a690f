import random
import re

import pytest

from tests.llm.helpers import collect, docs
from tidewash.llm.components import components
from tidewash.llm.jaccard_join import drop_similar, similarity_classes


def shingles(t, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, size, num, den):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(least[r], d)
    return sorted(((d, len(s), least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def corpus(seed, n=150, vocab=400):
    """Near copies by word edits around a few texts, with a passage that many share."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(vocab)]
    text = lambda k: [rng.choice(words) for _ in range(k)]
    bases, passage = [text(rng.randint(3, 90)) for _ in range(6)], text(25)
    rows = []
    for i in range(n):
        w = list(rng.choice(bases)) if rng.random() < 0.8 else text(rng.randint(1, 60))
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(words)
        if rng.random() < 0.3:
            w += passage
        rows.append((i * 2, (" " if rng.random() < 0.5 else "\t\n").join(w)))
    return rows + [(1, None), (3, ""), (5, " \t"), (7, "one"), (9, "ONE"), (None, rows[0][1]), (11, "a b"), (13, "b a"),
                   (0, rows[0][1]), (21, " ".join(text(20_000)))]


@pytest.mark.parametrize("seed,size,num,den", [(1, 4, 85, 100), (3, 2, 1, 2)])
def test_against_brute_force(spark, seed, size, num, den):
    rows = corpus(seed)
    out = similarity_classes(docs(spark, rows, clash=True), "doc_id", "text", size, num, den)
    got = sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in collect(out)), key=repr)
    assert got == brute(rows, size, num, den)


def test_small_vocabulary_where_every_list_is_long(spark):
    rows = corpus(7, 120, 12)
    out = similarity_classes(docs(spark, rows), "doc_id", "text", 3, 7, 10)
    assert sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in collect(out)), key=repr) == brute(rows, 3, 7, 10)


def test_drop_similar_keeps_one_of_each_component(spark):
    rows = [r for r in corpus(5, 60) if r[0] is not None]
    out = drop_similar(docs(spark, rows), "doc_id", "text", 5, 4, 5)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    want = sorted({c for _, n, c in brute(rows, 5, 4, 5) if n} | {d for d, n, _ in brute(rows, 5, 4, 5) if not n})
    assert sorted(r["doc_id"] for r in collect(out)) == want


def test_empty_table(spark):
    assert collect(similarity_classes(docs(spark, []), "doc_id", "text")) == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(140, 300), (7, 7)]
    out = components(spark.createDataFrame(edges, "a long, b long"))
    label = {r["node"]: r["label"] for r in collect(out)}
    assert label == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)} | {300: 100}
