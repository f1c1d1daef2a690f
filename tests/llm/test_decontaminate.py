import random
import re

import numpy as np
import pytest

from tests.llm.helpers import collect, docs
from tidewash.llm.decontaminate import decontaminate, drop_contaminated, winnow

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, items):
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for item, it in items:
            iw = words(it)
            if not iw:
                continue
            n = min(13, len(iw))
            grams = {tuple(iw[k:k + n]) for k in range(len(iw) - n + 1)}
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in grams:
                    hit.update(range(p, p + n))
                    found.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, key string")


def found(spark, rows, items, **more):
    out = decontaminate(docs(spark, rows, clash=True), items_frame(spark, items), "doc_id", "text", "item_id", "text", **more)
    return sorted(((r["id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in collect(out)), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["Aa", "bb", "é1", "dd", "0", "zz9"]
    item = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(1, item(40)), (2, item(13)), (3, item(14)), (10, item(12)), (11, item(1)), (12, item(9)), (13, None), (14, ""),
             (None, item(20)), (2, item(15)), (20, "., ;")]
    rows = []
    for i in range(60):
        parts = [item(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 2)):
            w = (rng.choice(items)[1] or "").split(" ")
            a = rng.randint(0, 6)
            parts += [("-- ".join(w[a:a + rng.randint(5, 40)])).upper(), item(rng.randint(0, 60))]
        rows.append((i, " ".join(parts)))
    return rows + [(100, None), (101, ""), (102, "..."), (None, items[0][1]), (3, rows[3][1]), (104, items[0][1] * 30)], items


@pytest.mark.parametrize("gram", [5, 8, 13])
def test_against_brute_force(spark, gram):
    rows, items = corpus(gram)
    assert found(spark, rows, items, gram=gram) == brute(rows, items)


def test_long_items_only_and_hot_passage(spark):
    passage = " ".join(f"w{k}" for k in range(30))
    rows = [(i, f"own{i} start {passage} end{i}") for i in range(400)] + [(1000, "w1 w2 w3")]
    items = [(7, passage), (8, f"before {passage}")]
    assert found(spark, rows, items) == brute(rows, items)


def test_empty_tables(spark):
    rows, items = corpus(1)
    assert found(spark, [], items) == []
    assert all(r[2] == 0 and not r[4] for r in found(spark, rows, []))


def test_drop_keeps_columns_and_clean_rows(spark):
    rows, items = corpus(2)
    out = drop_contaminated(docs(spark, rows), items_frame(spark, items), "doc_id", "text", "item_id", "text")
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    want = sorted((r[0] for r in brute(rows, items) if not r[4]), key=repr)
    assert sorted((r["doc_id"] for r in collect(out)), key=repr) == want


def test_winnowing_guarantee():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 6, 400).astype(np.uint64)  # many ties
    at = winnow(h, np.array([0, 150, 150, 153, 400]), 6)
    for a, b in ((0, 150), (153, 400)):
        for p in range(a, b - 5):
            w = h[p:p + 6]
            assert p + max(k for k in range(6) if w[k] == w.min()) in at
    assert not set(at) & set(range(150, 153))
