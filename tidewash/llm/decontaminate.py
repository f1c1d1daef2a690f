"""Operator 2, benchmark decontamination: winnowing, fingerprint join, extension.

1. Winnowing: of every ``window - gram + 1`` consecutive ``gram``-word hashes the
   smallest is kept (the rightmost of equal ones).  Any two texts that share
   ``window`` words therefore keep a fingerprint at the same place of the shared span.
   An item of fewer words is one fingerprint of its own length; documents are
   fingerprinted at each such length that the benchmark has.
2. Join: a document's fingerprint travels only if a bitmap of the benchmark's
   fingerprints (fixed size) knows its slot; it carries the words around it.  The join
   on the fingerprint is salted, as one passage may sit in a third of all documents.
3. Extension: words left and right of the shared gram are compared one by one.  A run
   of ``window`` words (or a whole short item) is an occurrence and its words are hit.

The result is exact: fingerprints only propose, words decide.

Defined cases: a null or wordless text has no words and no hits; a null or wordless
item has no windows; items with one id are one item, null ids are the item ""; repeated
rows each get their result; empty tables give no hits or no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewash.llm.common import buffers, doc_key, frees, sliced, written
from tidewash.llm.words import ALNUM, shingles, word_hashes

WINDOW = 13
GRAM = 8
#: Slots of the bitmap that tells which fingerprints the benchmark may have (2 MB).
SLOTS = 1 << 24
#: Copies of the benchmark's side, among which a frequent passage's hits are dealt.
SALTS = 8


def winnow(hashes: np.ndarray, bounds: np.ndarray, width: int) -> np.ndarray:
    """Positions of the rightmost smallest of every ``width`` hashes of one text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = hashes[:n].copy(), np.arange(n)
    for k in range(1, width):
        nxt = hashes[k:n + k]
        take = nxt <= best
        best[take] = nxt[take]
        at[take] = np.flatnonzero(take) + k
    inside = np.zeros(len(hashes) + 1, np.int64)  # windows that lie within one text
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= width:
            inside[a] += 1
            inside[b - width + 1] -= 1
    return np.unique(at[np.cumsum(inside)[:n] > 0])


def _fingerprints(data, offsets, window, gram, lengths):
    """(kind, text, first word, fingerprint) arrays per kind, then the words.

    Kind 0 are winnowed grams; kind n are all runs of n words, for each n in ``lengths``."""
    hashes, begin, end, bounds = word_hashes(data, offsets, ALNUM)
    found = []
    counts = np.diff(bounds)
    for kind in [0, *lengths]:
        size = kind or gram
        sh, sb = shingles(hashes, bounds, size)
        if kind:
            keep = np.repeat(counts >= size, np.diff(sb))
            at = np.flatnonzero(keep)
        else:
            at = winnow(sh, sb, window - gram + 1)
        text = np.searchsorted(sb, at, "right") - 1
        found.append((kind, text, at - sb[text], sh[at].view(np.int64)))
    return found, begin, end, bounds


_FOUND = "fp long, kind int, ctx binary, left int"


def _context(raw, begin, end, bounds, text, word, kind, window, gram):
    low, high = int(bounds[text]), int(bounds[text + 1])
    at = low + int(word)
    if kind:
        first, last = at, at + kind
    else:
        first, last = max(low, at - (window - gram)), min(high, at + window)
    return b" ".join(raw[begin[i]:end[i]].tobytes() for i in range(first, last)).lower(), at - first


@frees
def _item_rows(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text"):
        raw, offsets = buffers(batch.column("text"))
        items = batch.column("item").to_pylist()
        hashes, begin, end, bounds = word_hashes(raw, offsets, ALNUM)
        short = sorted({int(n) for n in np.diff(bounds) if 0 < n < window})
        found, begin, end, bounds = _fingerprints(raw, offsets, window, gram, short)
        n_words = np.diff(bounds)
        rows = []
        for kind, text, word, fp in found:
            for t, w, f in zip(text, word, fp):
                if kind and n_words[t] != kind:
                    continue
                ctx, left = _context(raw, begin, end, bounds, t, w, kind, window, gram)
                rows.append((items[t], int(f), kind, ctx, left))
        yield _batch(rows, [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.int32()],
                     ["item", "fp", "kind", "ctx", "left"])


def _batch(rows, types, names):
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


@frees
def _doc_rows(batches: Iterator[pa.RecordBatch], known: bytes, lengths: list[int],
              window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """A row per document (fp null) and one per fingerprint that the bitmap knows."""
    bits = np.unpackbits(np.frombuffer(known, np.uint8)).view(bool)
    types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64()]
    names = ["id", "key", "n_words", "fp", "kind", "ctx", "left", "at"]
    for batch in sliced(batches, "text"):
        raw, offsets = buffers(batch.column("text"))
        keys, ids = batch.column("key").to_pylist(), batch.column("id").to_pylist()
        found, begin, end, bounds = _fingerprints(raw, offsets, window, gram, lengths)
        rows = [(i, k, int(n), None, None, None, None, None) for i, k, n in zip(ids, keys, np.diff(bounds))]
        for kind, text, word, fp in found:
            hit = np.flatnonzero(bits[fp & (SLOTS - 1)])
            for t, w, f in zip(text[hit], word[hit], fp[hit]):
                ctx, left = _context(raw, begin, end, bounds, t, w, kind, window, gram)
                rows.append((None, keys[t], None, int(f), kind, ctx, left, int(w)))
        yield _batch(rows, types, names)


@frees
def _extended(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Aligned contexts of document and item -> the run of equal words around the gram."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            a, b = r["ctx"].split(b" "), r["item_ctx"].split(b" ")
            if r["kind"]:
                if a == b:
                    rows.append((r["key"], r["item"], r["at"], r["at"] + r["kind"]))
                continue
            i, j = r["left"], r["item_left"]
            if a[i:i + gram] != b[j:j + gram]:
                continue
            low = 0
            while low < min(i, j) and a[i - low - 1] == b[j - low - 1]:
                low += 1
            high = gram
            while i + high < len(a) and j + high < len(b) and a[i + high] == b[j + high]:
                high += 1
            if low + high >= window:
                rows.append((r["key"], r["item"], r["at"] - low, r["at"] + high))
        yield _batch(rows, [pa.binary(), pa.string(), pa.int64(), pa.int64()], ["key", "item", "low", "high"])


def occurrences(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str,
                item_text_col: str, window: int = WINDOW, gram: int = GRAM
                ) -> tuple[DataFrame, DataFrame]:
    """(documents, spans): id, key, n_words per row of ``docs``; and key, item, low, high
    for the word ranges of documents that occur in items."""
    spark = docs.sparkSession
    bench = written(items.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text"))
        .mapInArrow(lambda b: _item_rows(b, window, gram), f"item string, {_FOUND}")
        .distinct(), "bench-fingerprints")
    lengths = sorted(r[0] for r in bench.where("kind > 0").select("kind").distinct().collect())  # < window values
    slots = bench.select(F.col("fp").bitwiseAND(SLOTS - 1).cast("int").alias("s")).distinct().toArrow()  # <= SLOTS values
    bits = np.zeros(SLOTS, bool)
    bits[slots.column("s").to_numpy()] = True
    known = spark.sparkContext.broadcast(np.packbits(bits).tobytes())

    rows = docs.select(F.col(id_col).cast("long").alias("id"), doc_key(id_col, text_col).alias("key"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = written(rows.mapInArrow(lambda b: _doc_rows(b, known.value, lengths, window, gram),
                                    f"id long, key binary, n_words long, {_FOUND}, at long"),
                    "doc-fingerprints")
    salted = bench.select("fp", "kind", "item", F.col("ctx").alias("item_ctx"), F.col("left").alias("item_left"),
                          F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    pairs = (found.where("fp is not null").drop("id", "n_words")
             .withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
             .join(salted, ["fp", "kind", "salt"]))
    spans = pairs.select("key", "kind", "ctx", "left", "at", "item", "item_ctx", "item_left").mapInArrow(
        lambda b: _extended(b, window, gram), "key binary, item string, low long, high long")
    return found.where("fp is null").select("id", "key", "n_words"), spans


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str,
                  item_text_col: str, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per document: id, key, n_words, n_hit, items (sorted), spans (merged word
    ranges) and contaminated (some hit, and hit words are a twentieth of all or more)."""
    rows, spans = occurrences(docs, items, id_col, text_col, item_col, item_text_col, window, gram)
    per_doc = spans.groupBy("key").agg(F.collect_set("item").alias("items"),
                                       F.array_sort(F.collect_set(F.struct("low", "high"))).alias("raw"))
    merged = F.expr("""aggregate(raw, cast(array() as array<struct<low:bigint,high:bigint>>), (acc, x) ->
        if(size(acc) > 0 and x.low <= element_at(acc, -1).high,
           concat(slice(acc, 1, size(acc) - 1),
                  array(named_struct('low', element_at(acc, -1).low, 'high', greatest(element_at(acc, -1).high, x.high)))),
           concat(acc, array(x))))""")
    per_doc = per_doc.select("key", F.array_sort("items").alias("items"), merged.alias("spans"))
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.high - s.low)")
    out = rows.join(per_doc, "key", "left").select(
        "id", "key", "n_words", F.coalesce(n_hit, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str,
                      item_text_col: str) -> DataFrame:
    """``docs`` without the contaminated rows."""
    bad = written(decontaminate(docs, items, id_col, text_col, item_col, item_text_col)
                  .where("contaminated").select("key").distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("doc"), doc_key(id_col, text_col).alias("key"))
    return rows.join(bad, "key", "left_anti").select("doc.*")
