"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewash.session import checkpoint_root, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Bytes of text that a Python task works on at once.
BLOCK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; ``lower`` would fold every script."""
    return F.translate(c, UPPER, LOWER)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet below ``spark.checkpoint.dir`` and
    read it back.  Later jobs then depend on shared files, not on executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Delete tables made by ``written`` that no later step reads."""
    for df in frames:
        spark = df.sparkSession
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        root = checkpoint_root(spark)
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/tidewash-scratch/" in folder and root.split("://")[-1].lstrip("/") in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)


def doc_key(id_col: str, text_col: str) -> Column:
    """16 bytes that identify a row by id and text; rows equal in both share it.

    Null ids and null texts get their own marks, so a null id never meets another id."""
    return F.unhex(F.md5(F.concat(
        F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("~")),
        F.lit("\x00"),
        F.coalesce(F.concat(F.lit("="), F.col(text_col).cast("string")), F.lit("~")))))


#: What modules keep in a worker between tasks: module -> how to drop it.
_HELD: dict[str, Callable[[], None]] = {}


def holds(module: str, drop: Callable[[], None]) -> None:
    """Tells that ``module`` keeps something in this worker; tasks of other modules call ``drop`` first."""
    _HELD[module] = drop


def frees(f: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """For functions of ``mapInArrow``, which run in workers that Spark keeps for later tasks:
    a task first drops what other modules hold, and gives freed memory back when it ends."""
    @functools.wraps(f)
    def run(*args, **named):
        try:
            for module in [m for m in _HELD if m != f.__module__]:
                _HELD.pop(module)()
            yield from f(*args, **named)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
            if trim:
                trim(0)

    return run


def share_limit(wanted: int, total: int) -> int:
    """The largest 64-bit hash of about four times ``wanted`` of ``total`` rows."""
    share = min(1.0, 4 * max(wanted, 25) / max(total, 1))
    return int(-(2 ** 63) + share * (2 ** 64 - 1024)) if share < 1 else 2 ** 63 - 1


def hash_share(c: Column, wanted: int, total: int) -> Column:
    """Keeps rows by a hash of ``c``, about four times ``wanted`` of ``total``: all rows with
    the smallest ``wanted`` hashes are among them, but for odds of less than 1 in 10**40 at a hundred.
    So a bounded sample moves a bounded number of rows, however many tasks read the table."""
    return F.xxhash64(c) <= F.lit(share_limit(wanted, total))


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_string(column.type) else column
    column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    wide = column.cast(pa.large_binary())
    n = len(wide)
    _, offs, data = wide.buffers()
    offsets = np.frombuffer(offs, np.int64, n + 1 + wide.offset)[wide.offset:]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    return raw, offsets - offsets[0]


def sliced(batches: Iterator[pa.RecordBatch], text: str,
           limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Record batches of at most about ``limit`` text bytes (a longer text stands alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.diff(buffers(batch.column(text))[1])
        start, total = 0, 0
        for i, s in enumerate(sizes):
            if total and total + s > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(s)
        yield batch.slice(start)
