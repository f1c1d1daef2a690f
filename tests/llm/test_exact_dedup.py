import hashlib

import pytest

from tests.llm.helpers import collect, docs
from tidewash.llm.exact_dedup import Trie, drop_copies, exact_dedup


def norm(t):
    return (t or "").encode().lower()


def brute(rows, keep):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    low = lambda x: (x is not None, x or 0)
    best = {b: (max if keep == "largest" else min)(ids, key=low) for b, ids in groups.items()}
    return sorted(((i, best[norm(t)], len(groups[norm(t)]), hashlib.sha256(norm(t)).digest()) for i, t in rows), key=repr)


ROWS = [(1, "Alpha beta"), (2, "alpha BETA"), (3, "Ärger"), (4, "ärger"), (5, ""), (6, None), (7, "alpha betb"),
        (8, "x" * 100_000), (9, "X" * 100_000), (None, "alpha beta"), (11, "solo"), (12, "y"), (12, "y"), (12, "Y")]


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("spill", [1, 1 << 20])
def test_against_brute_force(spark, keep, spill):
    out = collect(exact_dedup(docs(spark, ROWS, clash=True), "doc_id", "text", keep, spill))
    assert sorted(((r["id"], r["keep_id"], r["group_size"], bytes(r["sha"])) for r in out), key=repr) == brute(ROWS, keep)
    kept = {}
    for r in out:
        if r["kept"]:
            assert r["id"] == r["keep_id"]
            kept[bytes(r["sha"])] = kept.get(bytes(r["sha"]), 0) + 1
    assert kept == {hashlib.sha256(norm(t)).digest(): 1 for _, t in ROWS}  # one of each group


def test_drop_copies_keeps_one_whole_row_of_each_group(spark):
    out = drop_copies(docs(spark, ROWS), "doc_id", "text", "largest")
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    rows = collect(out)
    assert sorted(norm(r["text"]) for r in rows) == sorted({norm(t) for _, t in ROWS})
    assert {r["doc_id"] for r in rows if norm(r["text"]) == norm("alpha beta")} == {2}


def test_hot_group(spark):
    rows = [(i, "same text") for i in range(2000)] + [(5000 + i, f"own {i}") for i in range(100)]
    out = collect(exact_dedup(docs(spark, rows), "doc_id", "text", "smallest"))
    assert {(r["keep_id"], r["group_size"]) for r in out if r["id"] < 5000} == {(0, 2000)}
    assert sum(r["kept"] for r in out) == 101


def test_empty_table(spark):
    assert collect(exact_dedup(docs(spark, []), "doc_id", "text")) == []
    assert collect(drop_copies(docs(spark, []), "doc_id", "text")) == []


def test_trie_holds_prefixes_and_full_strings():
    trie, keys = Trie(), [b"", b"a", b"abc", b"abd", b"ab", b"b" * 1000, b"b" * 999]
    for k in keys + keys:
        trie.insert(k, (1,), lambda a, b: (a[0] + b[0],))
    assert dict(trie.items()) == {k: (2,) for k in keys}
