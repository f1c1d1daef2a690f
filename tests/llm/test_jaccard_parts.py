"""The keys of the Jaccard join: unlike texts that share sentences hardly meet, and alike ones all do."""

import random

from tests.llm.test_jaccard_join import brute, collect, docs
from tidewash.llm import jaccard_join as J


def test_shared_sentences_make_no_candidates(spark, monkeypatch):
    """Long texts of common sentences, each in a fifteenth of them: posting lists of single shingles grow with the table."""
    rng = random.Random(4)
    sentences = [[f"s{k}w{i}" for i in range(10)] for k in range(1500)]
    rows = [(i, " ".join(w for k in rng.sample(range(1500), 100) for w in sentences[k])) for i in range(120)]
    rows += [(200 + i, rows[i][1] + " more words") for i in range(2)]
    seen, written = {}, J.written

    def counted(df, name):
        out = written(df, name)
        seen.setdefault(name, out.count())
        return out

    monkeypatch.setattr(J, "written", counted)
    out = collect(J.similarity_classes(docs(spark, rows), "doc_id", "text", 5, 4, 5))
    assert sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in out), key=repr) == brute(rows, 5, 4, 5)
    assert seen["jaccard-entries"] < 5_000  # the two pairs' own, about 2,400


def test_bits_of_all_sizes_bound_the_difference():
    import numpy as np

    rng = np.random.default_rng(2)
    for n in (1, 3, 255, 256, 2047, 2048, 5000):
        x = np.unique(rng.integers(0, 2 ** 64, n + 40, dtype=np.uint64))[:n]
        y = np.unique(np.concatenate([x[: n - n // 10], rng.integers(0, 2 ** 64, n // 10, dtype=np.uint64)]))
        a, b = J._parity(x), J._parity(y)
        differ = sum(int(v).bit_count() for v in (a ^ b).view(np.uint64))
        assert len(a) == len(b) and differ <= len(np.setxor1d(x, y))
        assert differ * 2 >= len(np.setxor1d(x, y))
