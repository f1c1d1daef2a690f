"""One row of each component stays, whatever the ids."""

from collections import Counter

from tests.llm.helpers import collect, docs
from tidewash.llm.jaccard_join import drop_similar, similarity_classes


def copies(name, n):
    """Near copies of one text."""
    return [" ".join(f"{name}{i}" for i in range(60)) + f" end{k}" for k in range(n)]


def kept(spark, rows):
    return Counter((r["doc_id"], r["text"]) for r in collect(drop_similar(docs(spark, rows, clash=True), "doc_id", "text")))


def test_near_copies_that_share_an_id(spark):
    texts = copies("a", 4)
    out = kept(spark, [(7, t) for t in texts] + [(9, texts[0])])
    assert sum(out.values()) == 1 and next(iter(out))[0] == 7


def test_components_of_null_ids(spark):
    out = kept(spark, [(None, t) for t in copies("a", 3)] + [(None, t) for t in copies("b", 3)] + [(None, copies("c", 1)[0])] * 3)
    assert sorted(t[0] for _, t in out.elements()) == ["a", "b", "c"]


def test_two_components_with_the_same_smallest_id(spark):
    a, b = copies("a", 3), copies("b", 3)
    out = kept(spark, [(1, a[0]), (2, a[1]), (None, a[2]), (1, b[0]), (3, b[1]), (1, b[2]), (1, None), (1, None), (5, "")])
    assert Counter(i for i, _ in out.elements()) == {1: 4, 5: 1}
    assert sorted((t or "-")[0] for _, t in out.elements() if t != "") == ["-", "-", "a", "b"]


def test_classes_have_the_same_columns(spark):
    out = similarity_classes(docs(spark, [(1, "a b c d e f")]), "doc_id", "text")
    assert out.columns == ["id", "key", "n_shingles", "component_id", "class_size"]
