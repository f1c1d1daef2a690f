import pytest

import corpus_pipeline as cp
from tests.llm.helpers import CLASHES, collect, docs
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_exact_dedup import norm
from tests.llm.test_jaccard_join import brute as similar
from tidewash.llm.sentencepiece_codec import MODEL_PATH, Codec

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's rows, made from its predecessor's."""
    df = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", collect(df))]
    for name, f in cp.STAGES:
        df = cp.written(f(spark, df, SF), f"test-{name}")
        out.append((name, collect(df)))
    return dict(out)


def pairs(rows):
    return [(r["doc_id"], r["text"]) for r in rows]


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_stage_list():
    assert [n for n, _ in cp.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "decontaminate", "sentencepiece"]


def test_columns(stages):
    for name in ("documents", "language_id", "exact_dedup", "jaccard_join", "decontaminate"):
        assert list(stages[name][0]) == cp.COLUMNS


def test_language_keeps_clean_documents(stages):
    assert ids(stages["language_id"]) == ids(stages["documents"])


def test_exact_stage(stages):
    best = {}
    for d, t in pairs(stages["language_id"]):
        best[norm(t)] = max(best.get(norm(t), -1), d)
    assert ids(stages["exact_dedup"]) == sorted(best.values())


def test_jaccard_stage(stages):
    want = similar(pairs(stages["exact_dedup"]), 5, 4, 5)
    assert ids(stages["jaccard_join"]) == sorted({c for _, n, c in want if n} | {d for d, n, _ in want if not n})


def test_decontaminate_stage(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = contaminated(pairs(stages["jaccard_join"]), items)
    assert ids(stages["decontaminate"]) == sorted(r[0] for r in want if not r[4])
    assert any(r[4] for r in want)


def test_encode_stage(stages):
    import numpy as np

    with open(MODEL_PATH, "rb") as f:
        codec = Codec(f.read())
    got = {r["doc_id"]: r["ids"] for r in stages["sentencepiece"]}
    assert got == {d: codec.reference.encode(t) for d, t in pairs(stages["decontaminate"])}
    assert np.mean([r["round_trip"] for r in stages["sentencepiece"]]) == 1


def test_run_is_registered():
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is cp.run


TEXT = "The house and the river of the old town are in this picture of ours."
ROWS = [(None, None), (1, ""), (2, TEXT), (2, TEXT), (3, None), (None, TEXT + " x"), (5, TEXT.upper()), (6, (TEXT + " ") * 3000)]
#: What each stage keeps of ROWS (its own input), as numbers of ROWS.
SURVIVORS = {"language_id": [2, 3, 5, 6, 7], "exact_dedup": [4, 5, 6, 7], "jaccard_join": [0, 1, 2, 4, 7],
             "decontaminate": range(8), "sentencepiece": range(8)}


@pytest.mark.parametrize("name,stage", cp.STAGES)
def test_exact_survivors_of_awkward_rows(spark, name, stage):
    """Nulls, empty and long texts, repeated rows, texts equal but for case, columns with clashing names."""
    out = collect(stage(spark, docs(spark, ROWS, clash=True), SF))
    if name == "sentencepiece":
        assert sorted((repr(r["doc_id"]) for r in out)) == sorted(repr(i) for i, _ in ROWS)
        assert all((r["n_tokens"] > 0) == bool(t) for r in out for i, t in ROWS if r["doc_id"] == i and i is not None)
        return
    want = sorted((ROWS[k] for k in SURVIVORS[name]), key=repr)
    got = sorted(((r["doc_id"], r["text"]) for r in out), key=repr)
    assert got == want
    assert all(r[c] == "x" for r in out for c in CLASHES)  # and the values of all columns


@pytest.mark.parametrize("name,stage", cp.STAGES)
def test_empty_tables(spark, name, stage):
    assert collect(stage(spark, docs(spark, []), SF)) == []
