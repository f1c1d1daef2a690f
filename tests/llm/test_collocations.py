import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import SCHEMA, collect
from tidewash.llm import words as W
from tidewash.llm.collocations import WORD, _unlike, mine_phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top, covered):
    """The contract in plain Python over (lang, text) rows."""
    grams, sizes = {}, Counter()
    for lang, text in rows:
        counts = grams.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            sizes["und" if lang is None else lang] += len(w)
            for k in (1, 2, 3):
                counts.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in grams.items():
        cand = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        kept = []
        for g, a in cand.items():
            score, k = min((1_000_000 * a * a // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g)))
            if not any(len(t) > len(g) and 100 * b >= covered * a and any(t[i:i + len(g)] == g for i in range(len(t))) for t, b in cand.items()):
                kept.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


def mined(spark, rows, clash=False, **named):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, t, lang, "s", 0) for i, (lang, t) in enumerate(rows)], SCHEMA)
    if clash:
        df = df.withColumns({c: F.lit("x") for c in ("h", "h1", "word", "f", "a", "l", "r", "score", "level", "rank", "phrase", "k", "n")})
    out = mine_phrases(df.repartition(3), "lang", "text", **named)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r.values()) for r in collect(out))


def chatter(seed, n, words=14):
    r = random.Random(seed)
    vocabulary = ["Red", "red", "é", "Ärger", "ärger", "x", " y", "zz", "long-word", "a", "b", "c", "d", "e"][:words]
    return [(r.choice(["en", "fr", "en", None]), "".join(
        r.choice(vocabulary) + r.choice([" ", " ", " ", "\t", ", ", ".", "\n", "  "]) for _ in range(r.randrange(30)))) for _ in range(n)]


@pytest.mark.parametrize("least,top,covered", [(2, 3, 50), (3, 2000, 50), (2, 40, 100), (5, 1, 10)])
def test_against_brute_force(spark, least, top, covered):
    rows = chatter(least * top, 120) + [("en", None), ("de", ""), (None, ".,;"), ("en", "alone")]
    assert mined(spark, rows, clash=True, least=least, top=top, covered=covered) == brute(rows, least, top, covered)


def test_languages_settle_at_different_levels(spark):
    rows = [("en", f"p{i} q{i}. " * 3 + "p1 z. ") for i in range(300)] + chatter(2, 80, 6)
    assert mined(spark, rows, least=3, top=4) == brute(rows, 3, 4, 50)


def test_copies_and_ties(spark):
    rows = [("en", "one two three four five, one two.")] * 400 + [("en", f"t{i % 50} u{i % 50} v{i % 50}") for i in range(600)]
    for top in (1, 7, 100):
        assert mined(spark, rows, least=10, top=top) == brute(rows, 10, top, 50)


def test_long_text_is_cut_between_pieces(spark):
    r = random.Random(9)
    text = "".join(r.choice("abcdef") + r.choice([" ", " ", ". "]) for _ in range(60_000))
    rows = [("en", text), ("en", "w " * 5000), ("fr", "x " * 10 + "." * 3000)]
    assert mined(spark, rows, least=10, top=50, block=1000) == brute(rows, 10, 50, 50)


def test_word_and_language_never_change_places(spark):
    rows = [("es", "en la"), ("en", "es la")] * 10 + [("es", "es es"), ("en", "en en")] * 12
    assert mined(spark, rows) == brute(rows, 10, 2000, 50)


def test_words_that_share_a_hash_are_seen():
    data = np.frombuffer(b"Abc abd abc ab", np.uint8)
    begin, end = W.spans(data, np.array([0, len(data)]), WORD)
    lang, model = np.array([0, 0, 0, 0]), np.array([0, 0, 0, 0])
    assert _unlike(data, begin, end, lang, model).tolist() == [1, 3]
    assert _unlike(data, begin, end, np.array([0, 0, 1, 0]), model).tolist() == [1, 2, 3]


def test_empty_table(spark):
    assert mined(spark, []) == [] and mined(spark, [("en", None)]) == []
