"""Does a text contain any keyword of a table of keywords?

``filters.keyword_any`` writes its list into the plan; here the keywords are a table of any
size.  Its size is measured first.  Up to ``BROADCAST_CHARS`` characters the keywords are
broadcast, and each worker builds one Aho-Corasick automaton of them, which reads a text once.
Beyond that, texts meet the table in joins, with the same result and at a higher price:

1. every position of a text gives its first few characters, which are joined with the
   distinct beginnings of the keywords; a match carries the lengths of the keywords that
   begin so;
2. such a position gives one string per length, which is joined with the keywords.

A position meets at most one row of the table in each join, however many keywords begin
alike.  Texts are not shuffled: only the strings are, and only if the table of keywords is
too large for the planner to broadcast.
"""

from __future__ import annotations

import ahocorasick
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewash.functions.common import col_of
from tidewash.session import scratch_path

#: Keywords with this many characters together are broadcast; an automaton of them takes some 100 MB.
BROADCAST_CHARS = 2_000_000
#: Characters of a keyword's beginning; shorter keywords are their own beginning.
BEGINNING = 6
#: Positions of a text that are cut from one block.
POSITIONS = 64


def _blocks(text: Column, longest: int) -> Column:
    """A text's blocks: ``POSITIONS`` characters each, and what a keyword that begins in them
    can reach beyond.  One pass over the text, however long it is."""
    reach = POSITIONS + longest - 1
    return F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{1,{reach}}})).{{1,{POSITIONS}}}"), F.lit(1))


def _lowered_words(keywords: DataFrame, keyword_col: str) -> DataFrame:
    """Distinct lower-case keywords (_tw_word) and their lengths (_tw_size), written."""
    words = (keywords.select(F.lower(col_of(keyword_col)).alias("_tw_word")).where(F.col("_tw_word") != "")
             .distinct().withColumn("_tw_size", F.char_length("_tw_word")))
    path = scratch_path(keywords.sparkSession, "keywords")
    words.write.parquet(path)
    return keywords.sparkSession.read.schema(words.schema).parquet(path)


#: The worker's last automaton, by the number of its broadcast.
_AUTOMATA: dict[int, ahocorasick.Automaton] = {}


def _automaton(number: int, words: list[str]) -> ahocorasick.Automaton:
    if number not in _AUTOMATA:
        _AUTOMATA.clear()
        a = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for w in words:
            a.add_word(w)
        a.make_automaton()
        _AUTOMATA[number] = a
    return _AUTOMATA[number]


def _any_of(number: int, words: Broadcast):
    """A vectorised function: does a lower-case text contain any of ``words``?"""
    @F.pandas_udf("boolean")
    def contains(text: pd.Series) -> pd.Series:
        found = _automaton(number, words.value).iter
        return text.map(lambda t: next(found(t), None) is not None, na_action="ignore")
    return contains


def texts_with_keywords(texts: DataFrame, text_col: str, words: DataFrame) -> DataFrame:
    """(text_sha), once for each distinct lower-cased text that contains one of ``words``
    (``_lowered_words``).  Null and empty texts are left out."""
    longest = words.agg(F.max("_tw_size")).first()[0]
    sizes = [r[0] for r in words.select(F.least("_tw_size", F.lit(BEGINNING))).distinct().collect()]  # BEGINNING rows at most
    lower = F.lower(col_of(text_col))
    found = texts.select(F.sha2(lower, 256).alias("text_sha"), F.explode(_blocks(lower, longest or 1)).alias("_tw_block"))
    if not sizes:
        return found.select("text_sha").where("false")
    begins = (words.groupBy(F.substring("_tw_word", 1, BEGINNING).alias("_tw_begin"))
              .agg(F.collect_set("_tw_size").alias("_tw_sizes")))
    starts = F.array(*[F.struct(F.col("_tw_at"), F.substring(F.col("_tw_block"), F.col("_tw_at"), F.lit(s)).alias("_tw_begin"))
                       for s in sorted(sizes)])
    at = found.select("*", F.explode(F.sequence(F.lit(1), F.least(F.char_length("_tw_block"), F.lit(POSITIONS)))).alias("_tw_at"))
    opened = at.select("text_sha", "_tw_block", F.inline(starts)).join(begins, "_tw_begin")
    strings = opened.select("text_sha", "_tw_block", "_tw_at", F.explode("_tw_sizes").alias("_tw_size")).select(
        "text_sha", F.substring(F.col("_tw_block"), F.col("_tw_at"), F.col("_tw_size")).alias("_tw_word"))
    return strings.join(words.select("_tw_word"), "_tw_word").select("text_sha").distinct()


def keyword_any_table(df: DataFrame, text_col: str, keywords: DataFrame, keyword_col: str,
                      out: str = "hit", empty_is_hit: bool = True) -> DataFrame:
    """``df`` with a flag: does the text contain any keyword, both lower-cased?

    Null or empty text counts as a hit when ``empty_is_hit``.  Null and empty keywords are
    left out.  Where the keywords are too many to broadcast, rows are joined with the hits by
    the text's SHA-256, so null and repeated ids do not matter.  The hits are written
    first; a text with very many copies is then split among tasks like any skewed join key.
    """
    spark, s = df.sparkSession, col_of(text_col)
    words = _lowered_words(keywords, keyword_col)
    size = words.agg(F.sum("_tw_size")).first()[0] or 0
    empty = s.isNull() | (s == "")
    if size <= BROADCAST_CHARS:
        shared = spark.sparkContext.broadcast([r[0] for r in words.select("_tw_word").collect()])
        hit = _any_of(shared._jbroadcast.id(), shared)(F.lower(s)) if size else F.lit(False)
        return df.withColumn(out, F.when(empty, F.lit(empty_is_hit)).otherwise(hit))
    path = scratch_path(spark, "keyword-hits")
    hits = texts_with_keywords(df, text_col, words)
    hits.write.parquet(path)
    hits = spark.read.schema(hits.schema).parquet(path).withColumnRenamed("text_sha", "_tw_sha")
    joined = df.withColumn("_tw_key", F.sha2(F.lower(s), 256)).join(hits, F.col("_tw_key") == F.col("_tw_sha"), "left")
    return joined.withColumn(out, F.when(empty, F.lit(empty_is_hit)).otherwise(F.col("_tw_sha").isNotNull())).drop("_tw_key", "_tw_sha")
