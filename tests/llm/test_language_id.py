import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import collect, docs
from tidewash.llm import language_id as li
from tidewash.llm.common import doc_key

DOCS = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def model(spark):
    train = spark.read.parquet(DOCS).where("doc_id % 2 = 0")
    return li.train(train, "text", "lang")


def identify(df, model, host=None, declared=None, **more):
    none = F.lit(None).cast("string")
    return li.identify(df, model, F.col("doc_id"), doc_key("doc_id", "text"), F.col("text"), declared=declared if declared is not None else none,
                       host=host if host is not None else none, domain=none, suffix=none, path=none, **more)


def test_held_out_accuracy_by_text_alone(spark, model):
    df = spark.read.parquet(DOCS).where("doc_id % 2 = 1")
    want = {r.doc_id: r.lang for r in df.collect()}
    out = collect(identify(df, model))
    assert len(out) == len(want)
    assert sum(r["language"] == want[r["id"]] for r in out) / len(out) > 0.97
    assert sum(r["accepted"] for r in out) / len(out) > 0.99


def test_marks_and_host_decide_where_text_does_not(spark, model):
    base = spark.read.parquet(DOCS).where("doc_id % 2 = 1 and lang in ('fr', 'de')").select(
        "doc_id", "text", F.concat(F.col("lang"), F.lit(".host")).alias("host"), "lang")
    weak = spark.createDataFrame([(100_000, "42", "fr.host", "fr"), (100_001, "42", "de.host", "de")], base.schema)
    out = {r["id"]: r for r in collect(identify(base.unionByName(weak), model, F.col("host"), F.col("lang")))}
    assert out[100_000]["language"] == "fr" and out[100_001]["language"] == "de"
    assert not out[100_000]["accepted"]  # no text of its own


def test_posteriors_against_brute_force(spark, model):
    """The same formula in plain Python, for host and declared language."""
    import math

    rows = [(i, "der die das und ist" if i % 3 else "the and of that this", f"h{i % 4}", "de" if i % 2 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, host string, declared string")
    out = {r["id"]: r for r in collect(identify(df, model, F.col("host"), F.col("declared")))}
    names, log_p = [*model[0], li.UNKNOWN], model[1]
    own = {}
    for i, t, _, _ in rows:
        import numpy as np

        data = np.frombuffer(t.encode(), np.uint8)
        slot, _ = li._trigrams(data, np.array([0, len(data)]))
        s = np.array([p[slot].sum(dtype=np.float64) for p in log_p]) * min(1, li.EFFECTIVE / len(slot))
        own[i] = (s - s.max(), np.exp(s - s.max()) / np.exp(s - s.max()).sum())
    total = sum(p for _, p in own.values())
    base = (total + 1) / (total.sum() + len(names))
    for i, t, host, declared in rows:
        others = sum((own[j][1] for j, _, h, _ in rows if h == host), 0) - own[i][1]
        others = np.maximum(others, 0)
        prior = (others + li.HOST_K * base) / (others.sum() + li.HOST_K)
        mark = sum(own[j][1] for j, _, _, d in rows if d == declared)
        logits = own[i][0] + np.log(prior) + np.log((mark + 0.5) / (total + 1.0)) + 2 * np.log((total + 0.5) / (total + 0.5))
        post = np.exp(logits - logits.max())
        post /= post.sum()
        assert out[i]["language"] == names[int(post.argmax())]
        assert math.isclose(out[i]["posterior"], post.max(), rel_tol=1e-4)


def test_junk_is_unknown_and_clean_is_kept(spark, model):
    rows = [(1, "#### %%%% 1234 5678 ::::"), (2, None), (3, ""), (4, "qzx wvk jjq xxz kkq zzv qqj vvx wwq " * 5),
            (5, "The house and the river of the old town are in this picture."), (5, "The house and the river of the old town are in this picture.")]
    out = collect(identify(docs(spark, rows, clash=True), model))
    assert sorted(r["id"] for r in out if not r["accepted"]) == [1, 2, 3, 4]


def test_address_and_markup_marks(spark):
    rows = [("https://user@Blog.Example.CO.uk:80/fr-FR/x?y", "<HTML dir=ltr LANG='pt-BR'>"), ("http://a.de", '<meta http-equiv="content-language" content="de">'),
            ("nonsense", "x"), (None, None)]
    df = spark.createDataFrame(rows, "url string, html string")
    host, domain, suffix, path = li.address_marks(F.col("url"))
    got = [tuple(r) for r in df.select(host, domain, suffix, path, li.declared_language(F.col("html"))).collect()]
    assert got == [("blog.example.co.uk", "co.uk", "uk", "fr", "pt"), ("a.de", "a.de", "de", None, "de"),
                   (None, None, None, None, None), (None, None, None, None, None)]
    assert li.visible_text("a<script>b</script><style>c</style><!-- d -->&amp;<b>e</b>").split() == ["a", "&", "e"]


def test_empty_tables(spark, model):
    assert collect(identify(docs(spark, []), model)) == []
    empty = li.train(docs(spark, []), "text", "lang")
    assert [r["accepted"] for r in collect(identify(docs(spark, [(1, "some text")]), empty))] == [False]
