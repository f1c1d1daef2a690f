"""Operator 4, suffix-array dedup: byte strings of a given length that occur again.

A suffix array of the whole corpus would sort every byte.  Only suffixes that share
``length`` bytes with another one matter, so the array is built in parts that hold all
of these:

1. Segments.  Of the ``gram``-byte hashes in a window of ``length`` bytes the smallest
   (the leftmost of equal ones) is the window's anchor.  Equal windows have equal anchors at equal
   places, so windows are grouped by anchor: consecutive windows with one anchor form a
   segment, cut at the bytes they span, never over a text's border.
2. Equal segments (128-bit hashes of their bytes) are counted; a segment that occurs
   twice consists of repeated windows.  One of each goes on, if its anchor has others.
3. Suffix order.  All segments of an anchor meet in one task, which sorts the suffixes
   at their windows by prefix doubling up to ``length`` bytes.  Suffixes that share
   ``length`` bytes are a run of equal ranks, in it by position: an entry has an earlier
   match exactly if it does not start its run, and a later one if it does not end it.
   (Lengths of matches above ``length``, as a longest-previous-factor array has them, are
   not found.)
4. An anchor with over ``GROUP`` distinct segments (the border of a passage that many
   texts hold) is dealt by the 128-bit hash of each window instead, with partial
   aggregation, so it never meets in one task; the earliest position comes from the
   same order of positions.

``keep="first"`` removes what has an earlier match, so the first copy stays;
``keep="none"`` removes every copy.  Matches are judged on the input.

Defined cases: null and empty texts have no bytes and nothing to remove; texts under
``length`` bytes cannot match; the order of texts is by id (null first), then by content;
repeated rows (same id and text) match each other, and with ``keep="first"`` are not told
apart, so all of them stay; an empty table gives an empty result; other columns are
ignored, whatever their names.  What is kept is binary, as a cut may split a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewash.llm.common import BLOCK_BYTES, buffers, doc_key, frees, release, sliced, written
from tidewash.llm.words import _powers, mix

LENGTH, GRAM = 400, 64
#: Distinct segments of one anchor that meet in one task.
GROUP = 2048
#: Bytes of segments sorted together.
CHUNK = 2 << 20
#: Copies of a repeated segment's row, among which its occurrences are dealt.
SALTS = 16

_RNG = np.random.default_rng(41)
_BITS = 23  # positions in a piece
_STEP = 1 << 16
_MASK64 = (1 << 64) - 1


class _Roll:
    """Hashes of any byte range of a piece from prefix sums modulo 2**64."""

    values = [_RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2)]
    bases = [int(_RNG.integers(1, 1 << 62)) * 2 + 1 for _ in range(2)]
    tables = [(_powers(b), _powers(pow(b, -1, 1 << 64))) for b in bases]

    def __init__(self, data: np.ndarray, which: int) -> None:
        (up, up_step), (down, down_step) = self.tables[which]
        self.down, n = self._full(down, down_step, len(data) + 1), len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[which][data] * self._full(up, up_step, n), out=self.sums[1:])

    @staticmethod
    def _full(low: np.ndarray, step: int, n: int) -> np.ndarray:
        out = np.empty(-(-n // _STEP) * _STEP, np.uint64)
        p = 1
        for at in range(0, len(out), _STEP):
            np.multiply(low, np.uint64(p), out=out[at:at + _STEP])
            p = p * step & _MASK64
        return out[:n]

    def ranges(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[begin]) * self.down[begin]

    def runs(self, size: int) -> np.ndarray:
        return (self.sums[size:] - self.sums[:-size]) * self.down[:len(self.sums) - size]


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive values, in two passes over blocks."""
    n = len(x)
    padded = np.full(-(-n // width) * width, _MASK64, np.uint64)
    padded[:n] = x
    rows = padded.reshape(-1, width)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - width + 1], left[width - 1:n])


def _pieces(raw: np.ndarray, offsets: np.ndarray, length: int
            ) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(bytes, offsets, number of first text, its first byte); a text longer than a piece
    comes in overlapping pieces that hold each of its windows once."""
    if len(raw) <= 2 * BLOCK_BYTES - length:
        yield raw, offsets, 0, 0
        return
    step = BLOCK_BYTES
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        for at in range(int(a), max(int(a) + 1, int(b) - length + 1), step):
            end = min(int(b), at + step + length - 1)
            yield raw[at:end], np.array([0, end - at]), i, at - int(a)


def segments(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray] | None:
    """Segments of a piece: text, low, high (bytes of the text), off (of the anchor),
    anchor, s1, s2 (hash of the bytes and off)."""
    if len(data) < length:
        return None
    first, second = _Roll(data, 0), _Roll(data, 1)
    grams = mix(first.runs(gram))
    place = np.uint64((1 << _BITS) - 1)
    best = _least((grams & ~place) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
    sizes = np.maximum(np.diff(offsets) - length + 1, 0)
    if not sizes.sum():
        return None
    text = np.repeat(np.arange(len(sizes)), sizes)
    window = np.repeat(offsets[:-1] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(text))
    anchor = (best[window] & place).astype(np.int64)
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(text)) - 1
    low, high, at, owner = window[begin], window[end] + length, anchor[begin], text[begin]
    off = at - low
    salt = mix(off.astype(np.uint64) + (high - low).astype(np.uint64) * np.uint64(0x100000001B3))
    return {"text": owner, "low": low - offsets[owner], "high": high - offsets[owner], "off": off,
            "anchor": grams[at], "s1": mix(first.ranges(low, high) + salt), "s2": mix(second.ranges(low, high) ^ salt)}


_SEGMENT = "id long, key binary, low long, high long, off int, anchor long, s1 long, s2 long"


@frees
def _segment_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text"):
        raw, offsets = buffers(batch.column("text"))
        for data, bounds, base, at in _pieces(raw, offsets, length):
            s = segments(data, bounds, length, gram)
            if s is None:
                continue
            text = pa.array(s["text"] + base)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(text), batch.column("key").take(text), pa.array(s["low"] + at), pa.array(s["high"] + at),
                 pa.array(s["off"].astype(np.int32)), *(pa.array(s[c].view(np.int64)) for c in ("anchor", "s1", "s2"))],
                ["id", "key", "low", "high", "off", "anchor", "s1", "s2"])


def _ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length`` bytes at each place, by prefix doubling (8, 16, ... bytes)."""
    n = len(data) - 7
    word = np.zeros(n, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | data[k:n + k].astype(np.uint64)
    rank = np.unique(word, return_inverse=True)[1].astype(np.int64)
    size = 8
    while size < length:
        step = min(size, length - size)
        n = len(rank) - step
        rank = np.unique((rank[:n] << 32) | rank[step:step + n], return_inverse=True)[1].astype(np.int64)
        size += step
    return rank


def matched_windows(bodies: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(body, window, has an earlier match, has a later match) of all windows of bodies
    that match elsewhere; bodies come in the order of their texts' positions."""
    sizes = np.array([len(b) for b in bodies])
    begin = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(bodies), np.uint8)
    rank = _ranks(data, length)
    windows = sizes - length + 1
    body = np.repeat(np.arange(len(bodies)), windows)
    place = np.repeat(begin - (np.cumsum(windows) - windows), windows) + np.arange(len(body))
    # Suffix order; suffixes that share ``length`` bytes are a run, in it by position.
    mine = rank[place]
    order = np.argsort(mine, kind="stable")
    run = mine[order]
    same = run[1:] == run[:-1]
    # Within a run positions rise, so the nearest smaller position before an entry is the
    # entry before it and there is none after it in the run: an entry has a previous
    # factor of ``length`` exactly if it does not start its run.  Larger: likewise after it.
    earlier, later = np.zeros(len(order), bool), np.zeros(len(order), bool)
    earlier[1:], later[:-1] = same, same
    hit = earlier | later
    back = order[hit]
    by = np.argsort(back)
    back = back[by]
    return body[back], (place - begin[body])[back], earlier[hit][by], later[hit][by]


def _spans(body: np.ndarray, window: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """(body, low, high) of maximal runs of neighbouring windows."""
    if not len(body):
        return
    new = np.concatenate([[True], (body[1:] != body[:-1]) | (window[1:] != window[:-1] + 1)])
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(body)) - 1
    yield from zip(body[a].tolist(), window[a].tolist(), (window[b] + length).tolist())


_SPAN = "key binary, low long, high long"


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    k, a, b = zip(*rows) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(k, pa.binary()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                      ["key", "low", "high"])


@frees
def _sorted_groups(batches: Iterator[pa.RecordBatch], length: int, first: bool) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by anchor and position; whole anchors are sorted together."""
    def solved(rows):
        body, window, earlier, later = matched_windows([r[4] for r in rows], length)
        keep = earlier if first else earlier | later
        return _span_batch([(rows[i][1], rows[i][2] + a, rows[i][2] + b)
                            for i, a, b in _spans(body[keep], window[keep], length)])

    held, group, size, current = [], [], 0, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("anchor", "key", "low", "high", "body")]
        for row in zip(*columns):
            if row[0] != current:
                held, group, current = held + group, [], row[0]
                if size >= CHUNK:
                    yield solved(held)
                    held, size = [], 0
            group.append(row)
            size += len(row[4])
    if held or group:
        yield solved(held + group)


@frees
def _window_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The windows of segments, by the 128-bit hash of their bytes."""
    for batch in batches:
        for i, key, low, body in zip(*(batch.column(c).to_pylist() for c in ("id", "key", "low", "body"))):
            data = np.frombuffer(body, np.uint8)
            n = len(data) - length + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * n, pa.int64()), pa.array([key] * n, pa.binary()), pa.array(np.arange(low, low + n)),
                 pa.array(mix(_Roll(data, 0).runs(length)).view(np.int64)),
                 pa.array(mix(_Roll(data, 1).runs(length)).view(np.int64))],
                ["id", "key", "low", "w1", "w2"])


def repeated_spans(docs: DataFrame, length: int, gram: int, first: bool, group: int = GROUP) -> DataFrame:
    """(key, low, high): byte ranges to remove, from rows (id, key, text)."""
    found = written(docs.mapInArrow(lambda b: _segment_rows(b, length, gram), _SEGMENT), "suffix-segments")
    often = written(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "suffix-anchors")
    shared = written(found.join(often, "anchor", "left_semi"), "suffix-shared")
    release(found, often)
    equal = ["anchor", "s1", "s2"]
    distinct = written(shared.groupBy(equal).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "key", "low", "high", "off")).alias("least")), "suffix-distinct")

    # Segments that occur again whole.
    again = distinct.where("n > 1").select(*equal, F.col("least.key").alias("first_key"), F.col("least.low").alias("first_low"),
                                           F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    whole = shared.withColumn("salt", F.pmod(F.xxhash64("key", "low"), F.lit(SALTS)).cast("int")).join(again, [*equal, "salt"])
    if first:
        whole = whole.where("key <> first_key or low <> first_low")
    whole = written(whole.select("key", "low", "high"), "suffix-whole")

    # One of each distinct segment, where its anchor has several.
    several = written(distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("segments")).where("segments > 1"), "suffix-several")
    wanted = written(distinct.join(several, "anchor").select("least.*", "anchor", "segments"), "suffix-wanted")
    body = F.substring(F.col("text").cast("binary"), (F.col("low") + 1).cast("int"), (F.col("high") - F.col("low")).cast("int"))
    bodies = docs.select("key", "text").join(wanted, "key").select("id", "key", "low", "high", "anchor", "segments", body.alias("body"))
    bodies = written(bodies, "suffix-bodies")
    release(shared, distinct, several, wanted)
    order = ["anchor", "id", "key", "low"]
    small = (bodies.where(F.col("segments") <= group).repartition("anchor").sortWithinPartitions(*order)
             .select("anchor", "key", "low", "high", "body").mapInArrow(lambda b: _sorted_groups(b, length, first), _SPAN))

    # Anchors with very many distinct segments: window by window.
    window = written(bodies.where(F.col("segments") > group).select("id", "key", "low", "body").mapInArrow(
        lambda b: _window_rows(b, length), "id long, key binary, low long, w1 long, w2 long"), "suffix-windows")
    seen = window.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "key", "low")).alias("least"))
    seen = written(seen.where("n > 1").select("w1", "w2", F.col("least.key").alias("first_key"), F.col("least.low").alias("first_low")),
                   "suffix-seen").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    large = window.withColumn("salt", F.pmod(F.xxhash64("key", "low"), F.lit(SALTS)).cast("int")).join(seen, ["w1", "w2", "salt"])
    if first:
        large = large.where("key <> first_key or low <> first_low")
    large = large.select("key", "low", (F.col("low") + length).alias("high"))
    return whole.unionByName(small).unionByName(large)


@frees
def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge each text's ranges and cut them out."""
    for batch in batches:
        kept, spans = [], []
        for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
            data = (text or "").encode()
            merged: list[list[int]] = []
            for r in ranges or []:
                if merged and r["low"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], r["high"])
                else:
                    merged.append([r["low"], r["high"]])
            edges = [0, *(x for m in merged for x in m), len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])) if merged else data)
            spans.append([{"low": a, "high": b} for a, b in merged])
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("key"), pa.array(kept, pa.binary()),
             pa.array(spans, pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())])))],
            ["id", "key", "kept", "spans"])


def remove_repeats(docs: DataFrame, id_col: str, text_col: str, length: int = LENGTH, gram: int = GRAM,
                   keep: str = "first", group: int = GROUP) -> DataFrame:
    """One row per input row: id, key, n_bytes, kept (binary), spans (removed byte ranges,
    maximal and in order)."""
    if keep not in ("first", "none"):
        raise ValueError("keep is 'first' or 'none'")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), doc_key(id_col, text_col).alias("key"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    spans = repeated_spans(rows, length, gram, keep == "first", group)
    per_text = written(spans.distinct().groupBy("key").agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias("ranges")),
                       "suffix-ranges")
    out = rows.join(per_text, "key", "left").select("id", "key", "text", "ranges").mapInArrow(
        _removed, "id long, key binary, kept binary, spans array<struct<low:bigint,high:bigint>>")
    removed = F.expr("aggregate(spans, 0L, (n, s) -> n + s.high - s.low)")
    return out.select("id", "key", (F.octet_length("kept") + removed).alias("n_bytes"), "kept", "spans")
