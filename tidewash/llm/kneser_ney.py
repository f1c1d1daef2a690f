"""Operator 1, LM scoring: an interpolated modified Kneser-Ney bigram model.

Counting in Spark: map tasks count word pairs in chunks and send them, packed as arrays,
to a bucket by the context word; contexts that make up more than a 4096th of all tokens
(at most 4096 words) are spread over the buckets by the pair.  A bucket's task adds up
its pairs and writes them as one file of sorted 64-bit hashes with counts; what it knows
of each word (occurrences, left neighbours, successors by count) goes on to a bucket by
word, whose task writes a second file of sorted hashes.  Every bucket has a file of both
kinds, if need be an empty one, so a lost file is an error and never a bucket without words.
Workers memory-map a file when a batch first needs it, keep it for later tasks, and look up
a batch's sorted distinct words and pairs; at most ``MAPPED`` files are mapped at a time.
Counts take 32 bits where a file's (or message's) largest count allows it, else 64.

    p(w | h) = max(c(h w) - D, 0) / c(h) + (D1 N1(h) + D2 N2(h) + D3 N3(h)) / c(h) * p(w)
    p(w)     = max(N(. w) - D', 0) / N(. .) + (D1' T1 + D2' T2 + D3' T3) / N(. .) / (V + 1)

with the discounts D1, D2, D3 of modified Kneser-Ney for each order, the V + 1st word
being any unknown one.  Every text starts in a begin state and ends with an end token.

Files are named by bucket and put in place by renaming, so a task that runs again after
a lost executor writes the same file again.

Defined cases: null and empty texts are one end token; a null id counts as the empty
text in the fold's checksum; repeated rows count as often as they occur; without
training rows all words are unknown; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import os
import tempfile
from collections import OrderedDict, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewash.llm.common import buffers, frees, holds, sliced
from tidewash.llm.words import SPACED, mix, word_hashes
from tidewash.session import scratch_path

#: Tokens counted together in a map task, and about as many per bucket.
CHUNK, BUCKET = 3 << 19, 1 << 20
#: Buckets per partition, so that partitions even out; a task holds one bucket at a time.
SPREAD = 4
#: Bytes of text that are scored at once.
SCORED_BYTES = 2 << 20
#: Files that a worker maps at once (Linux allows 65,530 maps a process).
MAPPED = 16_384
#: A word with this share of the tokens is spread as a context.
SHARE = 4096
BEGIN, END = np.uint64(0x9E6C63D0876A9A47), np.uint64(0xD1342543DE82EF95)
_C = np.uint64(0x9FB21C651E98DF25)


def pair_key(prev: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(prev * _C + word)


def token_stream(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, token, bounds) of the texts' tokens, each text ended by END."""
    hashes, _, _, bounds = word_hashes(*buffers(batch.column("text")), SPACED)
    n = len(bounds) - 1
    out = bounds + np.arange(n + 1)
    token = np.empty(len(hashes) + n, np.uint64)
    last = out[1:] - 1
    token[last] = END
    is_word = np.ones(len(token), bool)
    is_word[last] = False
    token[is_word] = hashes
    prev = np.empty_like(token)
    prev[1:] = token[:-1]
    prev[out[:-1]] = BEGIN
    return prev, token, out


@frees
def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with a large share of a chunk, and (as word 0) the number of tokens."""
    def counted(parts):
        word, n = np.unique(np.concatenate(parts), return_counts=True)
        keep = n * (SHARE // 2) >= n.sum()
        return pa.RecordBatch.from_arrays(
            [pa.array(np.append(word[keep].view(np.int64), 0)), pa.array(np.append(n[keep], n.sum()).astype(np.int64))],
            ["word", "n"])

    parts, held = [], 0
    for batch in sliced(batches, "text"):
        parts.append(token_stream(batch)[1])
        held += len(parts[-1])
        if held >= CHUNK:
            yield counted(parts)
            parts, held = [], 0
    if parts:
        yield counted(parts)


def _bucket_of(prev: np.ndarray, key: np.ndarray, often: np.ndarray, buckets: int) -> np.ndarray:
    at = np.minimum(np.searchsorted(often, prev), len(often) - 1)
    return (np.where(often[at] == prev, key, mix(prev)) % np.uint64(buckets)).astype(np.int64)


def _narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in 32 bits if all of them fit, else in 64."""
    return counts.astype(np.uint32 if counts.max(initial=0) < 1 << 32 else np.uint64)


def _packed(columns: dict[str, np.ndarray], by: np.ndarray, first: str) -> Iterator[pa.RecordBatch]:
    """One row per bucket: the bucket and each array's bytes."""
    order = np.argsort(by, kind="stable")
    by = by[order]
    cuts = np.flatnonzero(np.diff(by, prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(by)]):
        part = order[a:b]
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(by[a])], pa.int32()), *(pa.array([np.ascontiguousarray(x[part]).tobytes()], pa.binary())
                                                   for x in columns.values())], [first, *columns])


@frees
def _count_pairs(batches: Iterator[pa.RecordBatch], often: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    def counted(parts):
        prev, word = (np.concatenate(x) for x in zip(*parts))
        key, at, n = np.unique(pair_key(prev, word), return_index=True, return_counts=True)
        prev, word = prev[at], word[at]
        return _packed({"prev": prev, "word": word, "n": _narrow(n)}, _bucket_of(prev, key, often, buckets), "bucket")

    parts, held = [], 0
    for batch in sliced(batches, "text"):
        prev, token, _ = token_stream(batch)
        parts.append((prev, token))
        held += len(token)
        if held >= CHUNK:
            yield from counted(parts)
            parts, held = [], 0
    if parts:
        yield from counted(parts)


def _by_bucket(batches: Iterator[pa.RecordBatch], first: str, hashes: list[str], counts: list[str]) -> Iterator[tuple[int, dict]]:
    """(bucket, arrays) of rows that come sorted by bucket.  A row's counts have as many
    entries as its first array of hashes, which tells 32 from 64 bits."""
    types = [*hashes, *counts]
    current, parts = None, defaultdict(list)
    for batch in batches:
        for i, bucket in enumerate(batch.column(first).to_pylist()):
            if bucket != current and current is not None:
                yield current, {c: np.concatenate(parts.pop(c)) for c in types}
                parts = defaultdict(list)
            current = bucket
            size = len(batch.column(hashes[0])[i].as_buffer())
            for c in types:
                data = batch.column(c)[i].as_buffer()
                parts[c].append(np.frombuffer(data, np.uint64 if c in hashes or len(data) == size else np.uint32))
    if current is not None:
        yield current, {c: np.concatenate(parts.pop(c)) for c in types}


def _local(uri: str) -> str | None:
    """The path of a shared folder that is mounted, else None."""
    return uri.removeprefix("file://") if uri.startswith(("file:///", "/")) else uri[5:] if uri.startswith("file:/") else None


def save_arrays(uri: str, hashes: np.ndarray, counts: list[np.ndarray]) -> None:
    """Write sorted hashes and their counts one after the other, after their length, which is
    negative where the counts have 64 bits; atomic."""
    narrow = [_narrow(x) for x in counts]
    wide = any(x.dtype == np.uint64 for x in narrow)
    data = [np.array([~len(hashes) if wide else len(hashes)], np.int64), hashes,
            *(x.astype(np.uint64) for x in narrow if wide), *(x for x in narrow if not wide)]
    path = _local(uri)
    if path:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with tempfile.NamedTemporaryFile(dir=os.path.dirname(path), delete=False) as f:
            for x in data:
                f.write(memoryview(np.ascontiguousarray(x)).cast("B"))
        os.replace(f.name, path)
        return
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    with store.open_output_stream(f"{path}.{os.getpid()}") as f:
        for x in data:
            f.write(np.ascontiguousarray(x))
    store.move(f"{path}.{os.getpid()}", path)


def map_arrays(uri: str, n_counts: int) -> list[np.ndarray]:
    """The hashes of a file and its ``n_counts`` arrays of counts, memory-mapped (from a
    nameless local copy where the shared folder is not mounted)."""
    path = _local(uri)
    if path:
        raw = np.memmap(path, np.uint8, "r")
    else:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(uri)
        copy = tempfile.TemporaryFile()
        with store.open_input_stream(path) as f:
            while block := f.read(1 << 20):
                copy.write(block)
        copy.flush()
        raw = np.memmap(copy, np.uint8, "r")
    n, at, out = int(raw[:8].view(np.int64)[0]), 8, []
    n, count = (n, np.uint32) if n >= 0 else (~n, np.uint64)
    for t in [np.uint64, *[count] * n_counts]:
        size = n * np.dtype(t).itemsize
        out.append(raw[at:at + size].view(t))
        at += size
    return out


#: What is known of a word: occurrences, left neighbours, and successors that follow it once, twice, more often.
_COUNTS = ["c", "left", "s1", "s2", "s3"]
_STATS = ["word", *_COUNTS]


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    order = np.argsort(keys, kind="stable")
    if not len(order):
        return keys, [v.astype(np.uint64) for v in values], order
    keys = keys[order]
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[cuts], [np.add.reduceat(v[order].astype(np.uint64), cuts) for v in values], order[cuts]


@frees
def _add_pairs(batches: Iterator[pa.RecordBatch], folder: str, buckets: int) -> Iterator[pa.RecordBatch]:
    """Write each bucket's pairs; pass on its words' counts and (bucket -1) counts of counts."""
    for bucket, x in _by_bucket(batches, "bucket", ["prev", "word"], ["n"]):
        key, (n,), at = _summed(pair_key(x["prev"], x["word"]), x["n"])
        prev, word = x["prev"][at], x["word"][at]
        save_arrays(f"{folder}/pair-{bucket:06d}", key, [n])
        zero, one = np.zeros(len(n), np.uint64), np.ones(len(n), np.uint64)
        words, sums, _ = _summed(
            np.concatenate([word, prev]), np.concatenate([n, zero]), np.concatenate([one, zero]),
            np.concatenate([zero, n == 1]), np.concatenate([zero, n == 2]), np.concatenate([zero, n > 2]))
        columns = dict(zip(_STATS, [words, *map(_narrow, sums)]))
        yield from _packed(columns, (mix(words) % np.uint64(buckets)).astype(np.int64), "bucket")
        counts = np.array([int((n == k).sum()) for k in (1, 2, 3, 4)], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1], pa.int32()), pa.array([counts.tobytes()], pa.binary()),
             *(pa.array([b""], pa.binary()) for _ in range(len(_STATS) - 1))], ["bucket", *_STATS])


_TOTALS = ["n", "v", "pairs", "k1", "k2", "k3", "k4"]
_META = "kind string, " + ", ".join(f"{c} long" for c in _TOTALS)


@frees
def _add_words(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Write each bucket's words; return the totals that the model needs."""
    rows = []
    for bucket, x in _by_bucket(batches, "bucket", ["word"], _COUNTS):
        if bucket < 0:
            rows.append(("pair", 0, 0, 0, *map(int, x["word"].reshape(-1, 4).sum(axis=0))))
            continue
        word, sums, _ = _summed(x["word"], *(x[c] for c in _COUNTS))
        save_arrays(f"{folder}/word-{bucket:06d}", word, sums)
        c, left = sums[0], sums[1]
        rows.append(("word", int(c.sum()), int((c > 0).sum()), int(left.sum()),
                     *(int((left == k).sum()) for k in (1, 2, 3, 4))))
    columns = list(zip(*rows)) if rows else [[]] * 8
    yield pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], ["kind", *_TOTALS])


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float, float]:
    """(0, D1, D2, D3) of modified Kneser-Ney; counts of counts that are missing fall back to 0.75."""
    if not (n1 and n2):
        return 0.0, 0.75, 0.75, 0.75
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return 0.0, *(min(max(d, 0.05), k - 0.05) for k, d in enumerate((d1, d2, d3), 1))


@dataclass
class Model:
    """Where the files are, and the numbers that belong to no single word."""

    folder: str
    buckets: int
    often: np.ndarray  # at most SHARE words and the begin state
    n: int  # tokens
    v: int  # distinct tokens
    pairs: int  # distinct pairs
    d_pair: tuple
    d_word: tuple
    floor: float  # weight of the uniform distribution below the words


def train(docs: DataFrame, text_col: str) -> Model:
    """Count the texts of ``docs`` and write the model below the shared folder."""
    spark = docs.sparkSession
    rows = docs.select(F.col(text_col).cast("string").alias("text"))
    seen = rows.mapInArrow(_often, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # the number of tokens (word 0), then the words that can have their share of it
    counts = {r["word"]: r["n"] for r in seen.orderBy(F.col("n").desc(), "word").limit(SHARE + 2).collect()}
    total = counts.pop(0, 0)
    often = np.unique(np.append(np.array([w for w, n in counts.items() if n * SHARE >= total], np.int64).view(np.uint64), BEGIN))
    buckets = max(8, -(-total // BUCKET))
    folder = scratch_path(spark, "kneser-ney")
    packed = lambda names: "bucket int, " + ", ".join(f"{c} binary" for c in names)

    def by_bucket(df: DataFrame) -> DataFrame:
        """Rows sorted by bucket, with an empty row for every bucket, so that each is written."""
        empty = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"),
                                            *[F.lit(b"").alias(c) for c in df.columns[1:]])
        return df.unionByName(empty).repartition(-(-buckets // SPREAD), "bucket").sortWithinPartitions("bucket")

    pairs = rows.mapInArrow(lambda b: _count_pairs(b, often, buckets), packed(["prev", "word", "n"]))
    words = by_bucket(pairs).mapInArrow(lambda b: _add_pairs(b, folder, buckets), packed(_STATS))
    meta = by_bucket(words).mapInArrow(lambda b: _add_words(b, folder), _META)
    sums = {r["kind"]: r for r in meta.groupBy("kind").agg(*[F.sum(c).alias(c) for c in _TOTALS]).collect()}
    word = sums["word"]
    counts_of = lambda kind: [sums[kind][f"k{k}"] for k in (1, 2, 3, 4)]
    t, d_word = counts_of("word"), discounts(*counts_of("word"))
    above = word["v"] - t[0] - t[1]
    floor = (d_word[1] * t[0] + d_word[2] * t[1] + d_word[3] * above) / word["pairs"] if word["pairs"] else 1.0
    return Model(folder, buckets, often, word["n"], word["v"], word["pairs"], discounts(*counts_of("pair")), d_word, floor)


class Lookup:
    """A worker's memory-mapped view of a model: files used last are kept mapped."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.mapped: OrderedDict[tuple[str, int], list[np.ndarray]] = OrderedDict()

    def _file(self, kind: str, bucket: int, n: int) -> list[np.ndarray]:
        found = self.mapped.get((kind, bucket))
        if found is None:
            while len(self.mapped) >= MAPPED:
                self.mapped.popitem(last=False)
            found = self.mapped[kind, bucket] = map_arrays(f"{self.model.folder}/{kind}-{bucket:06d}", n)
        else:
            self.mapped.move_to_end((kind, bucket))
        return found

    def _find(self, kind: str, buckets: np.ndarray, keys: np.ndarray, n: int) -> list[np.ndarray]:
        out = [np.zeros(len(keys), np.int64) for _ in range(n)]
        order = np.argsort(buckets, kind="stable")
        cuts = np.flatnonzero(np.diff(buckets[order], prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(order)]):
            mine = order[a:b]
            found = self._file(kind, int(buckets[mine[0]]), n)
            if not len(found[0]):
                continue
            at = np.minimum(np.searchsorted(found[0], keys[mine]), len(found[0]) - 1)
            hit = found[0][at] == keys[mine]
            for x, column in zip(out, found[1:]):
                x[mine[hit]] = column[at[hit]]
        return out

    def log_probs(self, prev: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log10 p(token | prev), log10 of the base, count) of each token."""
        m = self.model
        words, inverse = np.unique(np.concatenate([token, prev]), return_inverse=True)
        c, left, s1, s2, s3 = self._find("word", (mix(words) % np.uint64(m.buckets)).astype(np.int64), words, 5)
        d = np.array(m.d_word)
        p_word = m.floor / (m.v + 1) + np.maximum(left - d[np.minimum(left, 3)], 0) / max(m.pairs, 1)
        # A word is followed as often as it occurs; the begin state by every text's first token.
        d = np.array(m.d_pair)
        follow = d[1] * s1 + d[2] * s2 + d[3] * s3
        at, before = inverse[:len(token)], inverse[len(token):]
        key, unique = np.unique(pair_key(prev, token), return_index=True)
        back = np.searchsorted(key, pair_key(prev, token))
        n, = self._find("pair", _bucket_of(prev[unique], key, m.often, m.buckets), key, 1)
        kept = np.maximum(n - d[np.minimum(n, 3)], 0)[back]
        total = np.where(prev == BEGIN, self.texts, c[before])
        seen = total > 0
        p = np.where(seen, (kept + follow[before] * p_word[at]) / np.maximum(total, 1), p_word[at])
        count = c[at]
        return np.log10(p), np.log10((count + 0.5) / (m.n + 0.5 * (m.v + 1))), count

    @property
    def texts(self) -> int:
        """Texts counted: each has one end token."""
        if not hasattr(self, "_texts"):
            self._texts = int(self._find("word", (mix(np.array([END])) % np.uint64(self.model.buckets)).astype(np.int64),
                                         np.array([END]), 1)[0][0])
        return self._texts


#: The worker's last model.
_LOOKUPS: dict[str, Lookup] = {}


def _lookup(model: Model) -> Lookup:
    if model.folder not in _LOOKUPS:
        _LOOKUPS.clear()
        _LOOKUPS[model.folder] = Lookup(model)
    holds(__name__, _LOOKUPS.clear)
    return _LOOKUPS[model.folder]


@frees
def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    lookup = _lookup(model)
    for batch in sliced(batches, "text", SCORED_BYTES):
        prev, token, bounds = token_stream(batch)
        score, base, count = lookup.log_probs(prev, token)
        starts, n = bounds[:-1], np.diff(bounds)
        total = np.add.reduceat(score, starts)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(n), pa.array(np.add.reduceat((count > 0).astype(np.int64), starts)),
             pa.array(np.add.reduceat(base, starts)), pa.array(total), pa.array(10 ** np.minimum(-total / n, 300))],
            ["id", "n_tokens", "n_known", "base_score", "score", "perplexity"])


def score(docs: DataFrame, id_col: str, text_col: str, model: Model) -> DataFrame:
    """id, n_tokens, n_known, base_score, score (log10 probability), perplexity per row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _scored(b, shared.value),
                           "id long, n_tokens long, n_known long, base_score double, score double, perplexity double")


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds

