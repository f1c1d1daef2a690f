import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewash.functions import text as X

WS_SAMPLES = [" ", "\t", "\n", "\u001c", "\u200b", "\u3000", "\u00a0", "\x85", "\u2009", "\r"]


def _py_clean(text):
    text = re.sub(r"\n{3,}", "\n\n", text)
    text = re.sub(r" {2,}", " ", text)
    return text.strip()


def _one(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.x for r in df.select("i", expr.alias("x")).orderBy("i").collect()]


def test_whitespace_constant_is_python_set():
    import sys
    assert X.PY_WHITESPACE_CHARS == "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())


def test_normalize_matches_python_on_edges(spark):
    vals = ["a\n\n\n\nb", "a  b   c", "   x\t", "\u001cz\u001f", "\u200bq\u200b", "", "   ",
            "x\n\n\n  \n\n\ny", "a \n\n\n b", "\u3000full\u00a0"]
    assert _one(spark, vals, X.normalize_whitespace("s")) == [_py_clean(v) for v in vals]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab. ") + WS_SAMPLES), max_size=30), min_size=1, max_size=20))
def test_normalize_and_tokens_property(spark, vals):
    assert _one(spark, vals, X.normalize_whitespace("s")) == [_py_clean(v) for v in vals]
    got = _one(spark, vals, F.array_sort(X.tokens("s")))
    assert [list(x) for x in got] == [sorted(set(v.lower().split())) for v in vals]


def test_key_normalize(spark):
    vals = ["  Hello World  ", "ÉCOLE\t"]
    assert _one(spark, vals, X.key_normalize("s")) == [v.lower().strip() for v in vals]


def test_content_hash_separator(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "a string, b string")
    plain = {r.h for r in df.select(X.content_hash("a", "b", separator_free=True).alias("h")).collect()}
    framed = {r.h for r in df.select(X.content_hash("a", "b").alias("h")).collect()}
    assert len(plain) == 1 and len(framed) == 2


def test_substring_count_and_length(spark):
    vals = ["aaaa", "The the THE", "x\ny\n", "😀😀a"]
    assert _one(spark, vals, X.substring_count("s", "aa")) == [v.count("aa") for v in vals]
    assert _one(spark, vals, X.substring_count("s", "the", case_insensitive=True)) == \
        [v.lower().count("the") for v in vals]
    assert _one(spark, vals, X.char_length("s")) == [len(v) for v in vals]


def test_slices_and_labels(spark):
    vals = ["abcdef", "ab"]
    assert _one(spark, vals, X.head_slice("s", 3)) == [v[:3] for v in vals]
    assert _one(spark, vals, X.tail_slice("s", 3)) == [v[-3:] for v in vals]
    assert _one(spark, vals, X.label_part(X.prefix_label(F.lit("src"), "s"), 2)) == vals
    assert _one(spark, vals, X.capped_linear(F.length("s"), 2, 2.5)) == [min(len(v) / 2, 2.5) for v in vals]
