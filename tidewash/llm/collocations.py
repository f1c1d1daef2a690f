"""Operator 11, phrase collocation mining: best-first branch-and-bound growth of phrases.

A phrase of two or three words with a occurrences scores floor(scale * a * a / (l * r)) at
its worst cut into two parts of l and r occurrences.  Phrases grow word by word from their
prefixes; a prefix's count bounds what can grow from it:

* a phrase occurs no more often than its words and pairs, so those below ``least`` grow
  nothing;
* three words a b c score at most scale * f(ab) / f(a) by the first cut and at most
  scale * f(bc) / f(c) by the second, and a pair's own score is below both of its bounds.

So each language has a frontier of pairs ordered by bound.  A round lowers the language's
level to the score of a later pair and expands every pair whose bound reaches the level:
three-word phrases are counted where both bounds reach it, or where they hold a pair that
scores as much (they may drop that pair).  Then everything that scores at least the level
is known exactly, dropped or not.  A language is settled once ``top`` phrases survive at
its level, ties included; the last level is 0, where all is expanded.

How it runs: tasks count each block of text in numpy and Spark adds the counts up (partial
sums, then one shuffle on the phrase).  A word is known by a 64-bit hash of language and
word; the first job counts the words themselves, so two words with one hash are seen and
another hash family is taken.  Tasks learn which words and pairs may grow from bitmaps of
a fixed size (``SLOTS`` bits each); a false positive is counted and thrown away later.  So
counts are exact; scores are decimal integers of 38 digits.

Defined cases: a null text is empty, a null language is ``und``; repeated rows count
again; a long text is cut between its pieces, one piece of any length stands whole;
languages without a phrase have no rows; an empty table gives an empty result; other
columns are ignored.  Equal scores go by count, then by the phrase's UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewash.llm import words as W
from tidewash.llm.common import buffers, frees, release, sliced, written

#: Bytes of text that a task counts at once, and bits of a bitmap.
BLOCK = 4 << 20
SLOTS = 1 << 25
SCALE = 1_000_000

#: Ends of pieces, and all bytes between words.
ENDS = ~W.byte_table([(0x0A, 0x0D), *[(ord(c), ord(c)) for c in ".,;:!?"]])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Two values for each hash family.
_FAMILIES = np.random.default_rng(11).integers(1, 1 << 63, 16, dtype=np.uint64)
WORD = W.byte_table([(0x20, 0x20), (0x09, 0x09), (0x0A, 0x0D), *[(ord(c), ord(c)) for c in ".,;:!?"]])


def _blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[str]]]:
    """(bytes, offsets, language of each text); a text above ``limit`` is cut behind ends of pieces."""
    for batch in sliced(batches, "text", limit):
        data, offsets = buffers(batch.column("text"))
        langs = batch.column("lang").to_pylist()
        if batch.num_rows > 1 or len(data) <= limit:
            yield data, offsets, langs
            continue
        ends = np.flatnonzero(ENDS[data]) + 1
        start = 0
        while start < len(data):
            at = np.searchsorted(ends, start + limit, "right") - 1
            stop = int(ends[at]) if at >= 0 and ends[at] > start else int(ends[at + 1]) if at + 1 < len(ends) else len(data)
            stop = len(data) if len(data) - start <= limit else stop
            yield data[start:stop], np.array([0, stop - start]), langs
            start = stop


def _words(data: np.ndarray, offsets: np.ndarray, langs: list[str], family: int):
    """(hash of language and word, begin, end, language number, languages) of each word, and
    for each word whether the next one follows in the same piece."""
    h, begin, end, bounds = W.word_hashes(data, offsets, WORD)
    names, number = np.unique(np.array(langs, dtype=object).astype(str), return_inverse=True)
    encoded = [n.encode() for n in names]
    at = np.cumsum([0] + [len(e) for e in encoded])
    raw = np.frombuffer(b"".join(encoded), np.uint8)
    salt = W.mix(W.span_hashes(raw, at[:-1], at[1:]) ^ _FAMILIES[2 * family])
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    lang = number[text]
    h = W.mix(W.mix(h ^ _FAMILIES[2 * family + 1]) + salt[lang]) if len(h) else h
    piece = np.cumsum(ENDS[data], dtype=np.int64)[begin] if len(h) else np.zeros(0, np.int64)
    follows = np.zeros(len(h), bool)
    follows[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
    return h, begin, end, lang, names, follows


def _has(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    slots = slots & np.uint64(SLOTS - 1)
    return (bits[(slots >> np.uint64(3)).astype(np.int64)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _pair_slot(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return (h1 >> np.uint64(17)) ^ h2


def _rows(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)


def _unlike(data: np.ndarray, begin: np.ndarray, end: np.ndarray, lang: np.ndarray, model: np.ndarray) -> np.ndarray:
    """The words that are not the same, byte by byte, as the word ``model`` names for them."""
    size = end - begin
    bad = (size != size[model]) | (lang != lang[model])
    alike = np.flatnonzero(~bad)
    n = size[alike]
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    differ = _LOWER[data[np.repeat(begin[alike], n) + inside]] != _LOWER[data[np.repeat(begin[model[alike]], n) + inside]]
    bad[np.repeat(alike, n)[differ]] = True
    return np.flatnonzero(bad)


@frees
def _count_words(batches: Iterator[pa.RecordBatch], family: int, limit: int) -> Iterator[pa.RecordBatch]:
    for data, offsets, langs in _blocks(batches, limit):
        h, begin, end, lang, names, _ = _words(data, offsets, langs, family)
        keys, first, inv, counts = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        other = _unlike(data, begin, end, lang, first[inv])  # shown with no count, so that Spark sees both
        at = np.concatenate([first, other])
        raw = data.tobytes()
        found = [raw[b:e].lower().decode() for b, e in zip(begin[at], end[at])]
        yield _rows(["lang", "h", "word", "c"], pa.array(names[lang[at]], pa.string()), h[at].view(np.int64),
                    pa.array(found, pa.string()), np.concatenate([counts, np.zeros(len(other), np.int64)]))


@frees
def _count_pairs(batches: Iterator[pa.RecordBatch], family: int, limit: int, common: bytes) -> Iterator[pa.RecordBatch]:
    bits = np.frombuffer(common, np.uint8)
    for data, offsets, langs in _blocks(batches, limit):
        h, *_, follows = _words(data, offsets, langs, family)
        grows = _has(bits, h)
        at = np.flatnonzero(follows[:-1] & grows[:-1] & grows[1:])
        keys, inv = np.unique(h[grows], return_inverse=True)
        place = np.zeros(len(h), np.int64)
        place[grows] = inv
        codes, counts = np.unique(place[at] * len(keys) + place[at + 1], return_counts=True)
        yield _rows(["h1", "h2", "c"], keys[codes // max(len(keys), 1)].view(np.int64),
                    keys[codes % max(len(keys), 1)].view(np.int64), counts)


@frees
def _count_triples(batches: Iterator[pa.RecordBatch], family: int, limit: int, maps: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Counts only where both pairs are common, and either both bounds reach the level or a
    pair scores as much."""
    common, left, right, high = (np.frombuffer(m, np.uint8) for m in maps)
    for data, offsets, langs in _blocks(batches, limit):
        h, *_, follows = _words(data, offsets, langs, family)
        slots = _pair_slot(h[:-1], h[1:])
        pair = follows[:-1] & _has(common, slots)
        tall = _has(high, slots)
        wanted = _has(left, slots)[:-1] & _has(right, slots)[1:] | tall[:-1] | tall[1:]
        at = np.flatnonzero(pair[:-1] & pair[1:] & wanted) if len(h) > 2 else np.zeros(0, np.int64)
        keys, inv = np.unique(h[np.concatenate([at, at + 1, at + 2])], return_inverse=True)
        a, b, c = inv.reshape(3, -1) if len(at) else (inv, inv, inv)
        pairs, front = np.unique(a * len(keys) + b, return_inverse=True)
        codes, counts = np.unique(front * len(keys) + c, return_counts=True)
        n = max(len(keys), 1)
        front = pairs[codes // n]
        yield _rows(["h1", "h2", "h3", "c"], keys[front // n].view(np.int64), keys[front % n].view(np.int64),
                    keys[codes % n].view(np.int64), counts)


def _bitmaps(rows: DataFrame, slot: Column, *conditions: Column) -> list[bytes]:
    """For each condition a bitmap of ``SLOTS`` bits with those of its rows; gathered by Spark
    in parts of 32,768 bits, so the driver gets that many bytes whatever the rows."""
    placed = rows.select((slot.bitwiseAND(F.lit(SLOTS - 1))).alias("slot"), *[c.alias(f"is{i}") for i, c in enumerate(conditions)])
    bit = F.bitmap_bit_position(F.col("slot") + F.lit(1))  # counts from one
    parts = placed.groupBy(F.shiftright("slot", 15).alias("part")).agg(
        *[F.bitmap_construct_agg(F.when(F.col(f"is{i}"), bit)).alias(f"is{i}") for i in range(len(conditions))])
    out = [bytearray(SLOTS // 8) for _ in conditions]
    for row in parts.toLocalIterator():
        for i, bits in enumerate(row[1:]):
            out[i][row[0] * 4096:row[0] * 4096 + 4096] = bits
    return [bytes(b) for b in out]


def _wide(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def _score(a: str, l: str, r: str) -> Column:  # noqa: E741
    return F.call_function("div", _wide(F.lit(SCALE)) * _wide(a) * _wide(a), _wide(l) * _wide(r)).cast("long")


def word_counts(docs: DataFrame, block: int = BLOCK, families: int = len(_FAMILIES) // 2) -> tuple[DataFrame, int]:
    """((h, lang, word, f) of every word, the hash family in which no two words share h)."""
    for family in range(families):
        found = written(
            docs.mapInArrow(lambda b, k=family: _count_words(b, k, block), "lang string, h long, word string, c long")
            .groupBy("h", "lang", "word").agg(F.sum("c").alias("f")), "phrase-words")
        if found.groupBy("h").count().where("count > 1").isEmpty():
            return found, family
        release(found)
    raise RuntimeError(f"two words share a hash in each of {families} families")


def mine_phrases(docs: DataFrame, lang_col: str, text_col: str, least: int = 10, top: int = 2000,
                 covered: int = 50, block: int = BLOCK) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases.

    Phrases occur ``least`` times or more; one is dropped if a longer one around it has
    ``covered`` per cent of its occurrences or more.  ``block``: bytes counted at once."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    words, family = word_counts(texts, block)
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    common = words.where(F.col("f") >= least)
    known = spark.sparkContext.broadcast(_bitmaps(common, F.col("h"), F.lit(True))[0])
    pairs = written(
        texts.mapInArrow(lambda b: _count_pairs(b, family, block, known.value), "h1 long, h2 long, c long")
        .groupBy("h1", "h2").agg(F.sum("c").alias("a")).where(F.col("a") >= least), "phrase-pairs-counted")
    first = common.select(F.col("h").alias("h1"), F.col("lang"), F.col("f").alias("l"))
    second = common.select(F.col("h").alias("h2"), F.col("f").alias("r"))
    scored = written(pairs.join(first, "h1").join(second, "h2").select(
        "lang", "h1", "h2", "a", "l", "r", _score("a", "l", "r").alias("score"),
        F.call_function("div", _wide(F.lit(SCALE)) * _wide("a"), _wide("l")).cast("long").alias("left"),
        F.call_function("div", _wide(F.lit(SCALE)) * _wide("a"), _wide("r")).cast("long").alias("right")), "phrase-pairs")
    release(pairs)

    settled, open_langs = None, None
    for depth in (2 * top, 32 * top, None):
        levels = _levels(scored, depth)
        if open_langs is not None:
            levels = levels.join(open_langs, "lang", "left_semi")
        found = written(_expand(spark, texts, scored, levels, family, least, covered, block), "phrase-survivors")
        enough = found.groupBy("lang").agg(F.count(F.lit(1)).alias("k"))
        levels = levels.join(enough, "lang", "left").where((F.coalesce("k", F.lit(0)) < top) & (F.col("level") > 0))
        left = written(levels.select("lang"), "phrase-open")
        done = found.join(left, "lang", "left_anti")
        settled = done if settled is None else settled.unionByName(done)
        open_langs = left
        if left.isEmpty():
            break

    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near = settled.withColumn("place", F.rank().over(best)).where(F.col("place") <= top).drop("place")
    for i in (1, 2, 3):
        near = near.join(common.select(F.col("h").alias(f"h{i}"), F.col("word").alias(f"w{i}")), f"h{i}", "left")
    named = near.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return named.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top).join(
        sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _levels(scored: DataFrame, depth: int | None) -> DataFrame:
    """(lang, level): the score of each language's pair at ``depth``, or 0 where there are fewer."""
    if depth is None:
        return scored.select("lang").distinct().withColumn("level", F.lit(0).cast("long"))
    # scores are whole numbers up to SCALE, so the window sees so many rows a language at most
    higher = Window.partitionBy("lang").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = scored.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("k")).withColumn("reached", F.sum("k").over(higher))
    return counts.groupBy("lang").agg(
        F.coalesce(F.max(F.when(F.col("reached") >= depth, F.col("score"))), F.lit(0).cast("long")).alias("level"))


def _expand(spark: SparkSession, texts: DataFrame, scored: DataFrame, levels: DataFrame, family: int, least: int,
            covered: int, block: int) -> DataFrame:
    """(lang, h1, h2, h3, a, l, r, score): what scores its language's level and survives."""
    ahead = scored.join(levels, "lang")
    slot = F.shiftrightunsigned("h1", 17).bitwiseXOR(F.col("h2"))
    maps = spark.sparkContext.broadcast(_bitmaps(
        ahead, slot, F.lit(True), F.col("left") >= F.col("level"), F.col("right") >= F.col("level"), F.col("score") >= F.col("level")))
    counted = written(
        texts.mapInArrow(lambda b: _count_triples(b, family, block, maps.value), "h1 long, h2 long, h3 long, c long")
        .groupBy("h1", "h2", "h3").agg(F.sum("c").alias("a")).where(F.col("a") >= least), "phrase-triples")
    front = scored.select("lang", "h1", "h2", F.col("l").alias("l1"), F.col("a").alias("l2"))
    back = scored.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("r1"), F.col("r").alias("r2"))
    triples = written(counted.join(front, ["h1", "h2"]).join(back, ["h2", "h3"]).withColumns(
        {"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")}), "phrase-triples-scored")
    one = F.col("s1") <= F.col("s2")
    kept3 = triples.select(
        "lang", "h1", "h2", "h3", "a", F.when(one, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(one, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    around = triples.select("h1", "h2", F.col("a").alias("longer")).unionByName(
        triples.select(F.col("h2").alias("h1"), F.col("h3").alias("h2"), F.col("a").alias("longer"))
    ).groupBy("h1", "h2").agg(F.max("longer").alias("longer"))
    kept2 = ahead.where(F.col("score") >= F.col("level")).join(around, ["h1", "h2"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * F.lit(100) < F.col("a") * F.lit(covered))).select(
        "lang", "h1", "h2", F.lit(None).cast("long").alias("h3"), "a", "l", "r", "score")
    return kept2.unionByName(kept3.join(levels, "lang").where(F.col("score") >= F.col("level")).drop("level"))
