import html
import itertools
import re

import numpy as np
import pytest

from tests.llm.helpers import collect
from tidewash.llm import html_extract as h

PAGES = "/root/testdata/sf0.01/pages.parquet"


def article(page):
    """The text of the one article element, by plain string work."""
    inner = re.search(r"(?s)<article>(.*?)</article>", page).group(1)
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(x for x in parts if x)


@pytest.fixture(scope="module")
def model(spark):
    return h.train(spark.read.parquet(PAGES), "html")


def test_every_page_of_the_table(spark, model):
    rows = spark.read.parquet(PAGES).collect()
    got = {r["id"]: r["text"] for r in collect(h.extract(spark.read.parquet(PAGES), "page_id", "url", "html", model))}
    assert len(got) == len(rows) and all(got[r.page_id] == article(r.html) for r in rows)


def test_held_out_layouts(spark, model):
    """Block accuracy on layouts (made with other seeds) of pages that were not trained on."""
    from pyspark.sql import functions as F

    html_col = F.col("html")
    rest = spark.read.parquet(PAGES).orderBy(F.desc(F.xxhash64(html_col))).limit(40).collect()
    right = total = 0
    for k, r in enumerate(rest):
        found = h.blocks(r.html)
        for page, labels in h.layouts(found, h.labels_by_markup(found), 10_000 + k):
            got = model.viterbi(h.features(page))
            right += sum(a == b for a, b in zip(got, labels))
            total += len(labels)
    assert right / total > 0.97


@pytest.mark.parametrize("page,want", [
    ("<body><div class='menu'><ul><li><a href=x>Home</a></li></ul></div><div id=content><h1>Title here</h1><p>First long"
     " paragraph of the story, with words.</p><p>Second &eacute;&nbsp;one\n here.</p></div><div class=sidebar><p>Popular"
     " posts</p></div><div class='comments'><p>Nice read, thanks a lot for it.</p></div><div class=footer>c 2020</div></body>",
     "Title here\nFirst long paragraph of the story, with words.\nSecond é one here."),
    ("<main><p>Body text of the article, and more.</p><form><p>Your mail please</p><input></form><aside><p>Related"
     "</p></aside><p>More body text of it.</p></main><footer>x</footer>",
     "Body text of the article, and more.\nMore body text of it."),
])
def test_other_layouts(model, page, want):
    assert h.extract_text(model, page) == want


def test_blocks_of_broken_markup():
    texts = lambda s: [b[0] for b in h.blocks(s)]
    assert texts("<p>a<br>b<p>c <b>d</p>e</div><script>var x='<p>no</p>'</script><!-- <p>no -->f") == ["a b", "c d", "ef"]
    assert texts("<ul><li>a<li>b</ul>&lt;p&gt;&amp;amp;") == ["a", "b", "<p>&amp;"]
    assert texts(None) == texts("") == texts("<p> </p>") == texts("<title>x</title>") == []
    assert texts("x" * 200_000) == ["x" * 200_000]


def test_viterbi_and_marginals_against_enumeration():
    rng = np.random.default_rng(3)
    chain = h.Chain(rng.normal(size=(h.SLOTS, 2)), rng.normal(size=(2, 2)))
    slots = [[int(x) for x in rng.integers(0, h.SLOTS, 4)] for _ in range(6)]
    s = chain.scores(slots)
    total = {y: sum(s[i, a] for i, a in enumerate(y)) + sum(chain.moves[a, b] for a, b in itertools.pairwise(y))
             for y in itertools.product((0, 1), repeat=6)}
    assert tuple(chain.viterbi(slots)) == max(total, key=total.get)
    z = sum(np.exp(v) for v in total.values())
    p, moves = chain.marginals(s)
    for i in range(6):
        assert np.isclose(p[i, 1], sum(np.exp(v) for y, v in total.items() if y[i]) / z)
    assert np.isclose(moves[0, 1], sum(np.exp(v) * sum((a, b) == (0, 1) for a, b in itertools.pairwise(y)) for y, v in total.items()) / z)


def test_null_empty_repeated_and_clashing_columns(spark, model):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<article><p>Some text, of words.</p></article>")] * 2 + [(None, "u", "<p></p>")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, text string, id string")
    got = [(r["id"], r["text"]) for r in collect(h.extract(df, "page_id", "url", "html", model))]
    assert sorted(got, key=repr) == sorted([(1, ""), (2, ""), (3, "Some text, of words.")] * 2 + [(None, "")], key=repr)


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert collect(h.extract(df, "page_id", "url", "html")) == []
