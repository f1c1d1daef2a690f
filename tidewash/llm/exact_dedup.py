"""Operator 10, exact dedup: Patricia-trie owners.

1. Each map task inserts its texts (after lower-casing A-Z) as whole byte strings
   into compressed radix tries, one per (length, content hash); a terminal node keeps
   the smallest and largest id, the row count and the ties.  When the tries hold
   ``spill_bytes``, they are emitted subtree by subtree and started anew, so memory
   is bounded and a group of copies leaves a task as a few rows.
2. Rows go to owners by (length, content hash).  An owner inserts the full byte
   strings of its partition, sorted by that key, one trie per key: equal hashes of
   different texts part inside the trie.  Terminal nodes hold the group's survivor.
3. Every row joins its group on the digest of its text.  Only groups of two or more
   rows are joined; they are repeated ``SALTS`` times and rows pick a salt by id, so
   a group with a third of all rows meets its survivor in many tasks.

Defined cases: a null text counts as empty; a null id is smaller than any id; of
repeated rows (same id, same text) exactly one is kept; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewash.llm.common import ascii_lower, frees, written

#: Bytes of distinct text that a task's tries hold before they spill.
SPILL_BYTES = 64 << 20
#: Copies of a group's survivor row, among which the group's rows are dealt.
SALTS = 16


class Trie:
    """A compressed radix trie (Patricia trie) of byte strings.

    A node is ``[label, children, value]``; ``label`` is the run of bytes that leads
    to it, children are told apart by their first byte, a terminal has a value."""

    def __init__(self) -> None:
        self.root = [b"", {}, None]

    def insert(self, key: bytes, value: tuple, merge) -> bool:
        """Add ``value`` at ``key``, merged with what is there; True if key is new."""
        node, at = self.root, 0
        while at < len(key):
            child = node[1].get(key[at])
            if child is None:
                node[1][key[at]] = [key[at:], {}, value]
                return True
            label = child[0]
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = _common(label, key, at)
            fork = [label[:same], {label[same]: child}, None]
            child[0] = label[same:]
            node[1][key[at]] = fork
            node, at = fork, at + same
        new = node[2] is None
        node[2] = value if new else merge(node[2], value)
        return new

    def items(self) -> Iterator[tuple[bytes, tuple]]:
        """(key, value) of every terminal, one subtree after the other."""
        stack = [(self.root, b"")]
        while stack:
            node, prefix = stack.pop()
            key = prefix + node[0]
            if node[2] is not None:
                yield key, node[2]
            stack.extend((c, key) for c in node[1].values())


def _common(label: bytes, key: bytes, at: int) -> int:
    """Length of the common start of ``label`` and ``key[at:]``, by halving."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if label[:mid] == key[at:at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _merge(a: tuple, b: tuple) -> tuple:
    """(smallest, largest, rows, rows with the smallest, rows with the largest)"""
    low = lambda x: (x is not None, x if x is not None else 0)
    small, n_small = (a[0], a[3] + b[3]) if a[0] == b[0] else min((a[0], a[3]), (b[0], b[3]), key=lambda x: low(x[0]))
    large, n_large = (a[1], a[4] + b[4]) if a[1] == b[1] else max((a[1], a[4]), (b[1], b[4]), key=lambda x: low(x[0]))
    return small, large, a[2] + b[2], n_small, n_large


_VALUE = "smallest long, largest long, n long, n_smallest long, n_largest long"
_VALUE_TYPES = [(c, pa.int64()) for c in ("smallest", "largest", "n", "n_smallest", "n_largest")]
_LOCAL = pa.schema([("len", pa.int64()), ("hash", pa.int64()), ("body", pa.binary()), *_VALUE_TYPES])
_OWNED = pa.schema([("sha", pa.binary()), *_VALUE_TYPES])


def _spilled(tries: dict, schema: pa.Schema, row) -> Iterator[pa.RecordBatch]:
    out, held = [], 0
    for key, trie in tries.items():
        for body, value in trie.items():
            out.append(row(key, body) + value)
            held += len(body) + 64
            if held >= 4 << 20:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                out, held = [], 0
    if out:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)


@frees
def _local_tries(batches: Iterator[pa.RecordBatch], spill_bytes: int) -> Iterator[pa.RecordBatch]:
    tries, held = {}, 0
    row = lambda key, body: (*key, body)
    for batch in batches:
        for i, body in zip(batch.column("id").to_pylist(), batch.column("body").to_pylist()):
            body = body.lower()  # of bytes: A-Z only
            key = len(body), int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "little", signed=True)
            trie = tries.get(key) or tries.setdefault(key, Trie())
            if trie.insert(body, (i, i, 1, 1, 1), _merge):
                held += len(body) + 200
        if held >= spill_bytes:
            yield from _spilled(tries, _LOCAL, row)
            tries, held = {}, 0
    yield from _spilled(tries, _LOCAL, row)


@frees
def _owner_tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (len, hash): one trie at a time."""
    current, trie, out = None, Trie(), {}
    n = 0
    row = lambda key, body: (hashlib.sha256(body).digest(),)
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("len", "hash", "body", "smallest", "largest", "n", "n_smallest", "n_largest")]
        for length, h, body, *value in zip(*columns):
            if (length, h) != current:
                out[n] = trie
                n += 1
                current, trie = (length, h), Trie()
            trie.insert(body, tuple(value), _merge)
        yield from _spilled(out, _OWNED, row)
        out = {}
    yield from _spilled({0: trie}, _OWNED, row)


def groups_of_equal_texts(docs: DataFrame, id_col: str, text_col: str,
                          spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """One row per distinct text: sha (SHA-256 bytes of the normalised text), smallest,
    largest, n (rows), and how many rows carry the smallest and the largest id."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("body"))
    local = rows.mapInArrow(lambda b: _local_tries(b, spill_bytes), f"len long, hash long, body binary, {_VALUE}")
    return (local.repartition(F.col("len"), F.col("hash")).sortWithinPartitions("len", "hash")
            .mapInArrow(_owner_tries, f"sha binary, {_VALUE}"))


def exact_dedup(docs: DataFrame, id_col: str, text_col: str, keep: str = "smallest",
                spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, sha (bytes), tie.

    ``keep`` names the survivor of a group: "smallest" or "largest" id.  ``tie`` is
    true where several rows with the survivor's id and text exist; one is kept.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.unhex(F.sha2(ascii_lower(text), 256)).alias("sha"),
                       F.monotonically_increasing_id().alias("row"))
    rows = written(rows, "exact-rows")
    found = groups_of_equal_texts(docs, id_col, text_col, spill_bytes).where("n > 1").select(
        "sha", F.col(keep).alias("keep_id"), F.col("n").alias("group_size"),
        (F.col(f"n_{keep}") > 1).alias("tie"))
    found = written(found, "exact-groups")
    # Repeated rows of a survivor: the first of them stays.  Mostly there are none.
    first = (rows.join(found.where("tie"), "sha").where(F.col("id").eqNullSafe(F.col("keep_id")))
             .groupBy("sha").agg(F.min("row").alias("first_row")))
    salted = found.join(first, "sha", "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(
        salted, ["sha", "salt"], "left")
    grouped = F.col("group_size").isNotNull()
    return joined.select(
        "id",
        F.when(grouped, F.col("keep_id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(~grouped, True).when(~F.col("tie"), F.col("id").eqNullSafe(F.col("keep_id")))
        .otherwise(F.coalesce(F.col("row") == F.col("first_row"), F.lit(False))).alias("kept"),
        "sha", F.coalesce("tie", F.lit(False)).alias("tie"))


def drop_copies(docs: DataFrame, id_col: str, text_col: str, keep: str = "smallest") -> DataFrame:
    """``docs`` without the rows that another row with an equal text replaces."""
    kept = exact_dedup(docs, id_col, text_col, keep).where("kept").select(
        "id", "sha", "tie")
    kept = written(kept, "exact-kept")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("doc"), F.unhex(F.sha2(ascii_lower(text), 256)).alias("sha"),
                       F.col(id_col).cast("long").alias("id"))
    match = lambda k: (rows["sha"] == k["sha"]) & rows["id"].eqNullSafe(k["id"])
    single, tied = kept.where("not tie"), kept.where("tie")
    plain = rows.join(single, match(single), "left_semi").select("doc.*")
    # Survivors that are repeated rows: all columns but the text may differ; the least row stays.
    again = rows.join(tied, match(tied), "left_semi").groupBy("sha").agg(F.min("doc").alias("doc")).select("doc.*")
    return plain.unionByName(again)
