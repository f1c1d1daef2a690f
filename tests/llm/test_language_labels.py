"""Every label with rows is a language of the model, however many there are."""

import random

import pytest

from tests.llm.test_language_id import identify
from tidewash.llm import language_id as li


def corpus(n):
    """Rows of ``n`` made-up languages, each with words of its own; the last ones are the rarest."""
    rows = []
    for k in range(n):
        rng = random.Random(k)
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(30)]
        rows += [(len(rows) + i, " ".join(rng.choice(words) for _ in range(60)), f"l{k:03}") for i in range(4 if k < n - 8 else 2)]
    return rows


def test_rare_labels_are_languages_too(spark):
    rows = corpus(70)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = li.train(df, "text", "lang")
    assert model[0] == sorted({x for *_, x in rows}) and model[1].shape == (71, li.SLOTS)
    out = {r["id"]: r for r in identify(df, model).collect()}
    assert all(out[i]["language"] == x and out[i]["accepted"] for i, _, x in rows)


def test_too_many_labels_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(li, "MAX_LANGUAGES", 9)
    df = spark.createDataFrame(corpus(10), "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="more than 9 labels"):
        li.train(df, "text", "lang")
    assert li.train(df, "text", "lang", languages=["l001", "l009"])[0] == ["l001", "l009"]
