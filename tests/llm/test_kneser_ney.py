import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import collect, docs
from tidewash.llm import kneser_ney as kn


def tokens(t):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) + ["</s>"]


class Brute:
    """The model's formulas on dictionaries."""

    def __init__(self, texts):
        self.c, self.pair = Counter(), Counter()
        for t in texts:
            prev = "<s>"
            for w in tokens(t):
                self.c[w] += 1
                self.pair[prev, w] += 1
                prev = w
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.left, self.total, self.follow = Counter(), Counter(), defaultdict(Counter)
        for (h, w), n in self.pair.items():
            self.left[w] += 1
            self.total[h] += n
            self.follow[h][min(n, 3)] += 1
        of = lambda values: [sum(x == k for x in values) for k in (1, 2, 3, 4)]
        self.d2, self.d1 = kn.discounts(*of(self.pair.values())), kn.discounts(*of(self.left.values()))
        self.floor = sum(self.d1[min(x, 3)] for x in self.left.values()) / max(1, len(self.pair))

    def p_word(self, w):
        pairs = len(self.pair)
        if not pairs:
            return 1 / (self.v + 1)
        return max(self.left[w] - self.d1[min(self.left[w], 3)], 0) / pairs + self.floor / (self.v + 1)

    def p(self, h, w):
        if not self.total[h]:
            return self.p_word(w)
        n = self.pair[h, w]
        back = sum(self.d2[k] * x for k, x in self.follow[h].items())
        return (max(n - self.d2[min(n, 3)], 0) + back * self.p_word(w)) / self.total[h]

    def score(self, t):
        w = tokens(t)
        return sum(math.log10(self.p(h, x)) for h, x in zip(["<s>", *w], w))

    def base(self, t):
        return sum(math.log10((self.c[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in tokens(t))


def corpus(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]


def check(spark, train, rows):
    brute = Brute([t for _, t in train])
    model = kn.train(docs(spark, train, clash=True), "text")
    assert (model.n, model.v, model.pairs) == (brute.n, brute.v, len(brute.pair))
    got = sorted(collect(kn.score(docs(spark, rows, clash=True), "doc_id", "text", model)), key=lambda r: repr((r["id"], r["n_tokens"])))
    want = sorted(rows, key=lambda r: repr((r[0], len(tokens(r[1])))))
    for r, (i, t) in zip(got, want, strict=True):
        w = tokens(t)
        assert (r["id"], r["n_tokens"], r["n_known"]) == (i, len(w), sum(x in brute.c for x in w))
        assert math.isclose(r["score"], brute.score(t), rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(r["base_score"], brute.base(t), rel_tol=1e-9, abs_tol=1e-9)


def test_against_brute_force(spark, monkeypatch):
    rows = corpus(spark)
    edge = [(900, None), (901, ""), (None, "The of"), (902, "unseen words only here"), (5, rows[5][1]), (903, "the " * 50_000)]
    check(spark, [r for r in rows if r[0] % 3] + edge[:3], rows + edge)


def test_without_training_rows(spark):
    check(spark, [], [(1, "a b"), (2, None)])


def test_probabilities_sum_to_one(spark):
    train = [(1, "a b a c"), (2, "b b a"), (3, "c"), (4, "a b c d e a b a b")]
    model = kn.train(docs(spark, train), "text")
    brute = Brute([t for _, t in train])
    words = [*brute.c, "<unknown>"]
    for h in ["<s>", *brute.c, "<unknown>"]:
        assert math.isclose(sum(brute.p(h, w) for w in words), 1.0, rel_tol=1e-9)
    assert model.v == len(brute.c)


def test_empty_table(spark):
    model = kn.train(docs(spark, [(1, "a b")]), "text")
    assert collect(kn.score(docs(spark, []), "doc_id", "text", model)) == []


def test_files_are_sorted_and_mapped(tmp_path):
    keys, n = np.array([3, 9, 11], np.uint64), np.array([1, 2, 3], np.uint64)
    for big, size in ((3, 4), (2 ** 32 - 1, 4), (2 ** 32, 8), (2 ** 63, 8)):  # 32 bits where they suffice
        n[2] = big
        kn.save_arrays(f"file://{tmp_path}/x/pair-000000", keys, [n])
        a, b = kn.map_arrays(f"{tmp_path}/x/pair-000000", 1)
        assert a.tolist() == [3, 9, 11] and b.tolist() == [1, 2, big] and isinstance(a.base, np.memmap | np.ndarray)
        assert b.dtype.itemsize == size
    kn.save_arrays(f"{tmp_path}/x/pair-000001", keys[:0], [n[:0]])
    assert [len(x) for x in kn.map_arrays(f"{tmp_path}/x/pair-000001", 1)] == [0, 0]


def test_messages_with_large_counts():
    """Counts of 32 and of 64 bits meet in one bucket; sums pass 32 bits."""
    import pyarrow as pa

    rows = []
    for counts in ([2 ** 32 - 1, 5], [2 ** 40, 7], [1, 1]):
        columns = {"prev": np.array([1, 2], np.uint64), "word": np.array([8, 9], np.uint64), "n": kn._narrow(np.array(counts))}
        rows += kn._packed(columns, np.zeros(2, np.int64), "bucket")
    rows.append(pa.RecordBatch.from_pylist([{"bucket": 1, "prev": b"", "word": b"", "n": b""}], schema=rows[0].schema))
    (bucket, x), (empty, none) = kn._by_bucket(iter(rows), "bucket", ["prev", "word"], ["n"])
    key, (n,), _ = kn._summed(x["prev"], x["n"])
    assert (bucket, key.tolist(), n.tolist()) == (0, [1, 2], [2 ** 32 + 2 ** 40, 13])
    assert empty == 1 and len(kn._summed(none["prev"], none["n"])[0]) == 0


def test_few_mapped_files_and_a_lost_one(spark, monkeypatch):
    import os

    rows = corpus(spark)[:50]
    model = kn.train(docs(spark, rows), "text")
    prev, token, _ = kn.token_stream(docs(spark, rows).select("text").toArrow().to_batches()[0])
    want = kn.Lookup(model).log_probs(prev, token)
    monkeypatch.setattr(kn, "MAPPED", 2)
    few = kn.Lookup(model)
    assert all((a == b).all() for a, b in zip(want, few.log_probs(prev, token))) and len(few.mapped) <= 2
    os.remove(f"{kn._local(model.folder)}/pair-000003")
    with pytest.raises(FileNotFoundError):
        kn.Lookup(model).log_probs(prev, token)


@pytest.mark.parametrize("i", [0, 7, 123456789])
def test_fold(spark, i):
    assert spark.range(1).select(kn.fold(F.lit(i), 5)).first()[0] == zlib.crc32(str(i).encode()) % 5


def test_query_learns_and_beats_the_base_on_held_out_rows(spark):
    from tidewash.llm.queries import QUERIES

    out = QUERIES["op1_lm_scoring"](spark, "/root/testdata/sf0.01")
    assert out.columns[:7] == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = [r for r in collect(out) if r["held_out"]]
    assert {zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in rows} == {1}
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)
