"""Texts stay where they are when rows go: only dropped and repeated rows are looked up."""

from collections import Counter

from tests.llm.helpers import collect, docs
from tidewash.llm.jaccard_join import drop_similar

LIMIT = "spark.sql.autoBroadcastJoinThreshold"


def words(name, n=40):
    return " ".join(f"{name}{i}" for i in range(n))


def test_texts_are_not_shuffled(spark):
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, "32k")
    try:
        out = drop_similar(docs(spark, [(i, words(f"t{i}_", 8)) for i in range(4000)]), "doc_id", "text")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert out.count() == 4000
    finally:
        spark.conf.set(LIMIT, before)


def test_copies_repeats_and_near_copies(spark):
    a, b = words("a"), words("b")
    rows = ([(3, a)] * 3 + [(5, a)] * 2 + [(4, a + " end")] + [(9, b), (8, b + " end"), (7, b + " end")] + [(None, a)]
            + [(1, words("c"))] * 2 + [(2, words("d")), (6, ""), (6, "")])
    out = Counter((r["doc_id"], r["text"]) for r in collect(drop_similar(docs(spark, rows, clash=True), "doc_id", "text")))
    assert out == {(3, a): 1, (7, b + " end"): 1, (1, words("c")): 1, (2, words("d")): 1, (6, ""): 2}
