import random

import pytest

from tidewash.operators import keywords
from tidewash.operators.keywords import POSITIONS, keyword_any_table


def _hits(spark, texts, words, **how):
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    table = spark.createDataFrame([(w,) for w in words], "word string")
    return {r.i: r.hit for r in keyword_any_table(df, "text", table, "word", **how).collect()}


@pytest.fixture(params=["broadcast", "joined"], autouse=True)
def way(request, monkeypatch):
    if request.param == "joined":
        monkeypatch.setattr(keywords, "BROADCAST_CHARS", -1)


@pytest.mark.parametrize("empty", [True, False])
def test_edges(spark, empty):
    edge = "x" * (POSITIONS - 2)  # a keyword that lies across the border of two blocks
    texts = [None, "", "LICENSE here", "licens", edge + "Needle at the border", "a\nb", "été \U0001f600 ok", "q", "Q", "q",
             "y" * 200_000 + " the very long keyword of more than one block " + "z " * 40 + "end"]
    words = ["license", "needle", "a\nb", "\U0001f600 o", "q", None, "", "LICENSE", "z " * 40 + "end"]
    got = _hits(spark, texts, words, empty_is_hit=empty)
    lowered = {w.lower() for w in words if w}
    assert got == {i: empty if not t else any(w in t.lower() for w in lowered) for i, t in enumerate(texts)}


def test_without_keywords_or_texts(spark):
    assert _hits(spark, ["a", None], [None, ""]) == {0: False, 1: True}
    assert _hits(spark, [], ["a"]) == {}


def test_a_hundred_thousand_keywords(spark):
    rnd = random.Random(5)
    word = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    words = ["abcdef" + word(rnd.randint(1, 9)) for _ in range(50_000)] + [word(rnd.randint(7, 12)) for _ in range(50_000)]
    texts = [" ".join(word(rnd.randint(1, 9)) for _ in range(40)) for _ in range(120)]
    texts[::4] = [t + " " + rnd.choice(words).upper() + "h" for t in texts[::4]]
    known = set(words)
    brute = {i: any(t[a:b] in known for t in [t.lower()] for a in range(len(t)) for b in range(a + 7, min(a + 15, len(t)) + 1))
             for i, t in enumerate(texts)}
    assert _hits(spark, texts, words) == brute and 30 <= sum(brute.values()) < 120
