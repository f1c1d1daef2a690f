import random
import re

import pytest

from tests.llm.helpers import collect, docs
from tidewash.llm.license_scan import TEMPLATES, Catalogue, min_hashes, scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(t):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]


def brute(text):
    """All windows of all size classes against all templates, exactly."""
    found, mine = set(), grams(text)
    for name, template in TEMPLATES:
        want, span = set(grams(template)), 8
        while span < 1.25 * (len(grams(template)) + 4):
            span *= 2
        for a in range(0, max(1, len(mine)), span):
            if 5 * len(want & set(mine[a:a + 2 * span - 4])) >= 4 * len(want):
                found.add(name)
    return sorted(found)


def corpus(seed, n=200):
    rng = random.Random(seed)
    noise = lambda k: " ".join(rng.choice(["lorem", "ipsum", "the", "license", "Version", "2", "under"]) for _ in range(k))
    rows = []
    for i in range(n):
        parts = [noise(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            w = rng.choice(TEMPLATES)[1].split(" ")
            if rng.random() < 0.4:
                w[rng.randrange(len(w))] = "changed"
            parts += [" ".join(w).upper() if rng.random() < 0.5 else "\n".join(w), noise(rng.randint(0, 60))]
        rows.append((i, " ".join(parts)))
    return rows + [(900, None), (901, ""), (902, "Released under the MIT"), (None, TEMPLATES[0][1]), (3, rows[3][1]),
                   (903, noise(30_000) + " Released under the MIT License. " + noise(10))]


def test_against_brute_force(spark):
    rows = corpus(1)
    out = collect(scan(docs(spark, rows, clash=True), "doc_id", "text"))
    got = sorted(((r["id"], r["licenses"]) for r in out), key=repr)
    assert got == sorted(((i, brute(t)) for i, t in rows), key=repr)
    assert all(m["containment"] >= 0.8 for r in out for m in r["matches"])


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["id"]: r["licenses"] for r in collect(scan(df, "doc_id", "text"))}
    assert got == {r.doc_id: brute(r.text) for r in df.collect()} and any(got.values())


def test_bands_estimate_similarity():
    import numpy as np

    rng = np.random.default_rng(0)
    common = rng.integers(0, 1 << 62, 60).astype(np.uint64)
    a = np.concatenate([common, rng.integers(0, 1 << 62, 20).astype(np.uint64)])
    b = np.concatenate([common, rng.integers(0, 1 << 62, 20).astype(np.uint64)])
    assert abs(np.mean(min_hashes(a) == min_hashes(b)) - 0.6) < 0.15


def test_refuses_short_templates_and_takes_empty_inputs(spark):
    with pytest.raises(ValueError):
        Catalogue([("x", "too short")])
    assert collect(scan(docs(spark, []), "doc_id", "text")) == []
    assert [r["licenses"] for r in collect(scan(docs(spark, [(1, "any text")]), "doc_id", "text", []))] == [[]]
