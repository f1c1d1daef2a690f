"""Near-duplicate detection: an exact set-similarity self join.

Similarity is Jaccard over the distinct lower-case whitespace tokens of a
text.  Candidate pairs come from a partition filter (Arasu et al. 2006, Deng
et al. 2016): two sets of sizes nx and ny with Jaccard >= t differ in at most
``h = floor((1-t)/(1+t) * (nx+ny))`` tokens.  Tokens are dealt by hash among
``m > h`` parts, so similar sets have ``m - h`` equal parts at least, and meet
on them.  Candidates are then verified exactly with integer arithmetic, so the
result equals the all-pairs answer.

Scale notes:

* Texts with identical token sets are collapsed first (one representative,
  the smallest id).  A group of exact copies, however large, never reaches
  the pair join, so no quadratic pair set is produced within it.
* Tokens are told apart by 64-bit hashes (of two given tokens, equal with odds of
  2**-64), so neither strings nor a vocabulary are shuffled: a set is a sorted array of
  numbers, written once.  What is shuffled of a set without a similar one is its part keys.
* A shared part of several tokens is far rarer than a shared token, whose posting list
  grows with the table.  Of its ``m`` parts a set leaves out the ``m - h - 1`` that
  are most often alike by chance (few and frequent tokens); by the prefix argument
  similar sets still share one of the others.  Only keys of several sets are written and joined.
* Verification fetches the sets of candidate ids alone.
* Rows are dropped by an anti-join with the dropped row numbers, usually few, so
  the planner can broadcast them and texts are not shuffled.

Ids give the order; rows are told apart by a number of their own (``rid``), given
when the table is stored.  A row without an id has no place in the order: it is compared
with nothing and stays.  Rows with one id are each compared with the rows of smaller
ids, but not with each other, as none is earlier.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewash.functions.common import as_fraction
from tidewash.functions.text import tokens
from tidewash.session import checkpoint_root, scratch_path


def materialize(df: DataFrame) -> DataFrame:
    """Write an intermediate that several branches read to the shared
    checkpoint folder (reliable, lineage cut) instead of recomputing it.

    It also makes a join's side a plain shuffle stage: AQE splits a skewed
    sort-merge join only if neither side is an aggregate or a window."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


#: Spark deletes the shuffle files of a query when it ends, instead of when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_PASSING: ContextVar[Passing | None] = ContextVar("_PASSING", default=None)


class Passing:
    """The tables that ``stored`` wrote in a block of ``passing``."""

    def __init__(self) -> None:
        self.paths: list[tuple[SparkSession, str]] = []

    def delete(self) -> None:
        """Deletes them; no later step may read one."""
        for spark, name in self.paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        self.paths = []


@contextmanager
def passing() -> Iterator[Passing]:
    """Notes what ``stored`` writes in the block, to be deleted when it has been read."""
    token = _PASSING.set(made := Passing())
    try:
        yield made
    finally:
        _PASSING.reset(token)


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Like ``materialize``, as Parquet, so that later steps read only the columns they use.
    What was shuffled for it goes at once.  ``keep``: not to be deleted with what is ``passing``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if (made := _PASSING.get()) and not keep:
        made.paths.append((spark, path))
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def token_sets(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, toks, n, skey): distinct tokens, their count, canonical set key."""
    t = df.select(F.col(id_col).alias("id"), tokens(text_col).alias("toks"))
    return (t.withColumn("n", F.size("toks"))
            .withColumn("skey", F.md5(F.array_join(F.sort_array("toks"), " "))))


class RankedSets:
    """The token sets of a table, written: ``rows`` (the table with ``rid``), ``ids`` (rid, id,
    skey) of all rows with tokens and an id, ``copies`` (rid) of rows whose set an earlier
    row has, and ``sets`` (rid, id, n, ranks) of the others; ranks are token numbers, sorted.
    ``keep_rows``: whether ``without`` will be asked for; else the table itself is not written."""

    def __init__(self, df: DataFrame, id_col: str, text_col: str, keep_rows: bool = True) -> None:
        self.columns = df.columns
        self.rows = df.withColumn("_tw_rid", F.monotonically_increasing_id())
        if keep_rows:
            self.rows = stored(self.rows, "neardup-rows")
        toks = self.rows.select(F.col("_tw_rid").alias("rid"), F.col(id_col).alias("id"), tokens(text_col).alias("toks"))
        toks = stored(toks.select("rid", "id", F.size("toks").alias("n"),
                                  F.md5(F.array_join(F.sort_array("toks"), " ")).alias("skey"),
                                  F.sort_array(F.transform("toks", lambda t: F.xxhash64(t))).alias("ranks")),
                      "neardup-tokens").where("id is not null and n > 0")
        self.ids = toks.select("rid", "id", "skey")
        self.firsts = stored(self.ids.groupBy("skey").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
                             .where("copies > 1").drop("copies"), "neardup-firsts")
        self.copies = stored(self.ids.join(self.firsts, "skey").where("id > first_id").select("rid"), "neardup-copies")
        self.sets = toks.join(self.copies, "rid", "left_anti").select("rid", "id", "n", "ranks")

    def without(self, rids: DataFrame) -> DataFrame:
        """The table without the copies and the rows ``rids``."""
        gone = stored(self.copies.unionByName(rids.select("rid")).withColumnRenamed("rid", "_tw_rid"), "neardup-dropped")
        return self.rows.join(gone, "_tw_rid", "left_anti").select(self.columns)


def _prefix_len(num: int, den: int):
    n = F.col("n").cast("bigint")
    ceil_tn = F.floor((n * F.lit(num) + F.lit(den - 1)) / F.lit(den)).cast("bigint")
    return n - ceil_tn + F.lit(1)


def prefix_tokens(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(rid, id, n, tok, pos) for the rarest-first prefix of every set (tok is a rank,
    pos its 1-based position in the set's order)."""
    head = F.slice("ranks", F.lit(1), _prefix_len(num, den).cast("int"))
    return sets.select("rid", "id", "n", F.posexplode(head).alias("_p", "tok")).select(
        "rid", "id", "n", "tok", (F.col("_p") + F.lit(1)).alias("pos"))


#: Sets whose tokens are counted for the order of the parts, about, and the tokens kept
#: (the most frequent).  The order steers cost only; any gives the same pairs.
SAMPLE_SETS, FREQUENT = 40_000, 1 << 16
#: Parts beyond ``h + 1``, as a share of them: so many of the commonest are left out.
SLACK = 0.4


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values whose output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _size_classes(most: int, num: int, den: int) -> np.ndarray:
    """Lower bounds of classes of sizes, two beyond that of ``most``: a set and a larger similar
    one are in one class or in neighbouring ones."""
    bounds = [1]
    while bounds[-1] <= most:
        bounds.append(max(bounds[-1] + 1, (bounds[-1] - 1) * den // num + 1))
    return np.array([*bounds, max(bounds[-1] + 1, (bounds[-1] - 1) * den // num + 1)], np.int64)


def _keys_of(tokens_: np.ndarray, owner: np.ndarray, cls: np.ndarray, high: np.ndarray, weight: np.ndarray,
             num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(set, key) of sets for one class each: ``owner`` is the set of each token, ``cls`` and
    ``high`` are the class of each set and its largest size."""
    h = 2 * high * (den - num) // (den + num)
    keep = h + 1
    parts = keep + np.where(h > 0, np.ceil(SLACK * keep), 0).astype(np.int64)
    start = np.concatenate([[0], np.cumsum(parts)])
    salted = _mixed(tokens_ ^ (cls[owner].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    at = start[owner] + ((salted >> np.uint64(32)) * parts[owner].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    again = _mixed(salted)
    total = int(start[-1])
    # sums of halves are exact in doubles: 2**32 * 2**20 tokens of a part at most
    low = np.bincount(at, (again & np.uint64(0xFFFFFFFF)).astype(np.float64), total).astype(np.uint64)
    top = np.bincount(at, (again >> np.uint64(32)).astype(np.float64), total).astype(np.uint64)
    weights = np.bincount(at, weight, total).astype(np.int64)
    of = np.repeat(np.arange(len(parts)), parts)
    part = np.arange(total) - start[of]
    key = _mixed(_mixed(low ^ _mixed(top)) ^ (part.astype(np.uint64) << np.uint64(24)) ^ cls[of].astype(np.uint64))
    order = np.lexsort((key, -weights, of))
    kept = order[part < keep[of]]  # the first ``keep`` of each set: the least common ones
    return of[kept], key[kept]


def _part_keys(batches: Iterator[pa.RecordBatch], num: int, den: int, frequent: np.ndarray, value: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(rid, key, own) of sets (rid, n, ranks): the keys of a set's size class, which are its own, and
    of the next one.  ``value`` is the weight of the sorted ``frequent`` tokens: less than ``RARE``."""
    for whole in batches:
        for i in range(0, whole.num_rows, 512):
            batch = whole.slice(i, 512)
            ranks = batch.column("ranks")
            owner = np.repeat(np.arange(batch.num_rows), ranks.value_lengths().to_numpy(zero_copy_only=False))
            toks = ranks.flatten().to_numpy(zero_copy_only=False)
            near = np.minimum(np.searchsorted(frequent, toks), max(len(frequent) - 1, 0))
            known = frequent[near] == toks if len(frequent) else np.zeros(len(toks), bool)
            weight = np.where(known, value[near] if len(frequent) else 0, RARE)
            toks = toks.view(np.uint64)
            n = batch.column("n").to_numpy().astype(np.int64)
            bounds = _size_classes(int(n.max()), num, den)
            cls = np.searchsorted(bounds, n, side="right") - 1
            rid = batch.column("rid").to_numpy()
            for own in (True, False):
                c = cls if own else cls + 1
                of, key = _keys_of(toks, owner, c, bounds[c + 1] - 1, weight, num, den)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid[of]), pa.array(key.view(np.int64)), pa.array(np.full(len(of), own))], ["rid", "key", "own"])


#: Weight of a token that is not known to be frequent, in hundredths of a natural logarithm of odds.
RARE = 1200


def _frequent_tokens(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The frequent tokens, sorted, and their weights: the logarithm of how seldom a set has them."""
    total = max(sets.count(), 1)
    share = min(1.0, SAMPLE_SETS / total)
    some = sets.where(F.xxhash64("rid") <= F.lit(int(-(2 ** 63) + share * (2 ** 64 - 1024)))) if share < 1 else sets
    seen = max(total * share, 1.0)
    found = (some.select(F.explode("ranks").alias("tok")).groupBy("tok").agg(F.count(F.lit(1)).alias("df"))
             .where("df > 1").orderBy(F.desc("df"), "tok").limit(FREQUENT).toArrow())
    tok, df = found.column("tok").to_numpy(), found.column("df").to_numpy()
    by = np.argsort(tok)
    return tok[by], np.clip(np.log(seen / df[by]) * 100, 0, RARE).astype(np.int64)


def posting_lists(sets: DataFrame, facts: DataFrame, num: int, den: int, more: DataFrame | None = None) -> DataFrame:
    """(key, rid, id, n, own) of keys that several sets have; similar sets share a key, one of
    them as its own.  Below a threshold of 1/2, where parts would hold single tokens or none,
    the keys are the tokens of the prefix.  ``more``: further keys (key, rid, own) to meet on."""
    if 2 * num < den:
        keys = prefix_tokens(sets, num, den).select(F.col("tok").alias("key"), "rid", F.lit(True).alias("own"))
    else:
        order = sets.sparkSession.sparkContext.broadcast(_frequent_tokens(sets))
        keys = sets.select("rid", "n", "ranks").mapInArrow(
            lambda batches: _part_keys(batches, num, den, *order.value), "rid long, key long, own boolean")
    if more is not None:
        keys = keys.select("key", "rid", "own").unionByName(more)
    # a list is counted where it meets; it is as long as a group of sets that look alike
    several = keys.withColumn("_k", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("_k > 1").drop("_k")
    met = stored(several, "neardup-met")
    return stored(met.join(facts.select("rid", "id", "n"), "rid"), "neardup-postings")


def candidate_condition(a: str, b: str, num: int, den: int):
    """Join condition for two entries of posting lists: same key, ordered ids, a key that is
    the own of one of them, and the length filter."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    return ((F.col(f"{a}.key") == F.col(f"{b}.key")) & (F.col(f"{a}.id") < F.col(f"{b}.id"))
            & (F.col(f"{a}.own") | F.col(f"{b}.own"))
            & (F.least(na, nb) * F.lit(den) >= F.greatest(na, nb) * F.lit(num)))


#: Longs of parity bits of a set, for fewer than SMALL tokens and for more.
SMALL, SHORT, LONG = 512, 8, 32


def _parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, id, n, bits) of sets: a bit is the parity of the number of tokens that a hash deals to it."""
    powers = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for whole in batches:
        for i in range(0, whole.num_rows, 512):
            batch = whole.slice(i, 512)
            words = np.where(batch.column("n").to_numpy() < SMALL, SHORT, LONG)
            start = np.concatenate([[0], np.cumsum(words)])
            ranks = batch.column("ranks")
            owner = np.repeat(np.arange(batch.num_rows), ranks.value_lengths().to_numpy(zero_copy_only=False))
            hashed = _mixed(ranks.flatten().to_numpy(zero_copy_only=False).view(np.uint64))
            bit = start[owner] * 64 + (hashed >> np.uint64(32)).astype(np.int64) % (words[owner] * 64)
            parity = (np.bincount(bit, minlength=int(start[-1]) * 64) & 1).astype(np.uint64).reshape(-1, 64)
            bits = pa.ListArray.from_arrays(pa.array(start, pa.int32()), pa.array((parity * powers).sum(axis=1, dtype=np.uint64).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("id"), batch.column("n"), bits], ["rid", "id", "n", "bits"])


def sketches(sets: DataFrame) -> DataFrame:
    """(rid, id, n, bits) of sets, written."""
    kind = sets.schema["id"].dataType.simpleString()
    return stored(sets.mapInArrow(_parities, f"rid long, id {kind}, n int, bits array<long>"), "neardup-sketches")


#: Keys at most that are broadcast to pick rows, so that the others are not shuffled.
WANTED = 1 << 20


def _among(df: DataFrame, keys: DataFrame, by: str) -> DataFrame:
    """The rows of ``df`` whose ``by`` is one of the distinct ``keys``."""
    keys = stored(keys, "neardup-wanted")
    return df.join(F.broadcast(keys) if keys.count() <= WANTED else keys, by, "left_semi")


def _verify(cand: DataFrame, sets: DataFrame, facts: DataFrame, num: int, den: int, strict: bool, many: bool = False) -> DataFrame:
    """Exact Jaccard check of candidate pairs (rid_a, rid_b) on the sets of these rows;
    integer arithmetic only.  (rid_a, rid_b, id_a, id_b, n_common, n_union).

    The sets of a pair differ in as many tokens as their parity bits (``facts``) at least; only
    pairs that may pass by this have their sets fetched.  ``many``: there may be many pairs of
    one set; they are compared in cells (``_cells``), so it is not sent to each of them."""
    bits = lambda x: facts.select(F.col("rid").alias(f"rid_{x}"), F.col("n").alias(f"m_{x}"), F.col("bits").alias(f"bits_{x}"))
    apart = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    both = (F.col("m_a") + F.col("m_b")).cast("bigint")
    may = (F.size("bits_a") != F.size("bits_b")) | (apart * F.lit(num + den) <= both * F.lit(den - num))
    cand = stored(cand.join(bits("a"), "rid_a").join(bits("b"), "rid_b").where(may).select("rid_a", "rid_b"), "neardup-candidates")
    wanted = cand.select(F.col("rid_a").alias("rid")).union(cand.select("rid_b")).distinct()
    some = stored(_among(sets, wanted, "rid"), "neardup-candidate-sets")
    if many:
        met = _sets_in_cells(cand, some)
    else:
        side = lambda x: some.select(*[F.col(c).alias(f"{c}_{x}") for c in ("rid", "id", "ranks", "n")])
        met = cand.join(side("a"), "rid_a").join(side("b"), "rid_b")
    v = met.withColumn("n_common", F.size(F.array_intersect("ranks_a", "ranks_b")).cast("bigint"))
    v = v.withColumn("n_union", (F.col("n_a") + F.col("n_b") - F.col("n_common")).cast("bigint"))
    lhs = F.col("n_common") * F.lit(den)
    rhs = F.col("n_union") * F.lit(num)
    return (v.where(lhs > rhs if strict else lhs >= rhs)
            .select("rid_a", "rid_b", "id_a", "id_b", "n_common", "n_union"))


#: Sets or texts of a block, and their bytes, about: a cell compares the members of two blocks, or of one.
BLOCK_MEMBERS, BLOCK_BYTES = 64, 1 << 20


def _cells(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Pairs (key, other, ...) with the ``cell`` that they are compared in, written; ``sizes``: (key, bytes).

    Members are dealt into blocks of a bounded size, those with one least neighbour together, and
    a cell has the pairs of two blocks: a member goes to its cells once, not to each of its pairs.
    So k near-copies, which have k * k pairs, are sent k / BLOCK_MEMBERS times each."""
    ends = pairs.select("key", "other").union(pairs.select("other", "key"))
    hubs = ends.groupBy("key").agg(F.least(F.min("other"), "key").alias("hub"))
    hubs = stored(hubs.join(sizes, "key"), "neardup-hubs")
    parts = hubs.groupBy("hub").agg(F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(BLOCK_MEMBERS), F.sum("bytes") / F.lit(BLOCK_BYTES))).alias("parts"))
    block = F.xxhash64("hub", F.pmod(F.xxhash64("key", F.lit("part")), F.greatest("parts", F.lit(1))))
    blocks = stored(hubs.join(parts, "hub").select("key", block.alias("block")), "neardup-blocks")
    both = (pairs.join(blocks.withColumnRenamed("block", "block_a"), "key")
            .join(blocks.select(F.col("key").alias("other"), F.col("block").alias("block_b")), "other"))
    cell = F.xxhash64(F.least("block_a", "block_b"), F.greatest("block_a", "block_b"))
    return stored(both.select(*pairs.columns, cell.alias("cell")), "neardup-cells")


def _asked(cells: DataFrame) -> DataFrame:
    """(cell, key): the members of each cell, once."""
    return cells.select("cell", "key").union(cells.select("cell", "other")).distinct()


def _sets_in_cells(cand: DataFrame, some: DataFrame) -> DataFrame:
    """Pairs (rid_a, rid_b) with the ids, sizes and ranks of both."""
    cells = _cells(cand.select(F.col("rid_a").alias("key"), F.col("rid_b").alias("other")),
                   some.select(F.col("rid").alias("key"), (F.col("n").cast("long") * 8).alias("bytes")))
    members = _asked(cells).join(some.withColumnRenamed("rid", "key"), "key")
    rows = (members.select("cell", F.struct("key", F.struct("id", "n", "ranks").alias("set")).alias("member"))
            .unionByName(cells.select("cell", F.struct("key", "other").alias("pair")), allowMissingColumns=True))
    rows = rows.groupBy("cell").agg(F.map_from_entries(F.collect_list("member")).alias("sets"), F.collect_list("pair").alias("pairs"))
    each = rows.select("sets", F.explode("pairs").alias("pair")).select(
        "pair", F.element_at("sets", F.col("pair.key")).alias("a"), F.element_at("sets", F.col("pair.other")).alias("b"))
    return each.select(F.col("pair.key").alias("rid_a"), F.col("pair.other").alias("rid_b"),
                       *[F.col(f"{x}.{c}").alias(f"{c}_{x}") for x in ("a", "b") for c in ("id", "n", "ranks")])


def _pairs_of(joined: DataFrame) -> DataFrame:
    return joined.select(F.col("a.rid").alias("rid_a"), F.col("b.rid").alias("rid_b")).distinct()


def _candidates(pa: DataFrame, pb: DataFrame, num: int, den: int) -> DataFrame:
    return _pairs_of(pa.alias("a").join(pb.alias("b"), candidate_condition("a", "b", num, den)))


def near_dup_pairs_of_sets(sets: DataFrame, threshold=0.85, strict: bool = True) -> DataFrame:
    """Verified pairs (id_a < id_b) between sets (rid, id, n, ranks)."""
    f = as_fraction(threshold)
    num, den = f.numerator, f.denominator
    facts = sketches(sets)
    p = posting_lists(sets, facts, num, den)
    return _verify(_candidates(p, p, num, den), sets, facts, num, den, strict, many=True).drop("rid_a", "rid_b")


# Phase-one width of the existence search: each row is first compared with
# the earliest HEAD_WIDTH members of each of its posting lists.
HEAD_WIDTH = 8


def _heads(p: DataFrame, width: int) -> DataFrame:
    """The earliest ``width`` members of each posting list (a map-side top-N, ``WindowGroupLimit``)."""
    w = Window.partitionBy("key").orderBy("id", "rid")
    heads = p.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= F.lit(width)).drop("_r")
    return stored(heads, "neardup-heads")


def rows_with_earlier_match(sets: DataFrame, threshold=0.85, strict: bool = True,
                            head_width: int = HEAD_WIDTH) -> DataFrame:
    """(rid, id) of sets that have an earlier (smaller id) similar one.

    Exact, in two phases.  Phase 1 compares every row with the earliest
    ``head_width`` members of each of its posting lists only; rows that find
    a match there are settled.  Phase 2 compares the still-open rows with
    every earlier member.  A cluster of k mutually similar near-copies sharing
    keys costs about k*head_width comparisons instead of k*k, since
    almost every member matches the cluster's first rows in phase 1.
    """
    f = as_fraction(threshold)
    num, den = f.numerator, f.denominator
    facts = sketches(sets)
    p = posting_lists(sets, facts, num, den)
    heads = _heads(p, head_width)
    found1 = stored(_verify(_candidates(heads, p, num, den), sets, facts, num, den, strict).select(
        F.col("rid_b").alias("rid"), F.col("id_b").alias("id")).distinct(), "neardup-settled")
    open_rows = p.join(found1, "rid", "left_anti")
    found2 = _verify(_candidates(p, open_rows, num, den), sets, facts, num, den, strict).select(
        F.col("rid_b").alias("rid"), F.col("id_b").alias("id")).distinct()
    return found1.unionByName(found2).distinct()


def earliest_matches(sets: DataFrame, threshold=0.85, strict: bool = True,
                     head_width: int = HEAD_WIDTH) -> DataFrame:
    """(id, earliest_id): for every set that has an earlier similar one, the first of them.

    One row a set, however large its cluster.  Phase 1 as in ``rows_with_earlier_match``
    gives most rows a first match; phase 2 looks only among the members that are earlier
    still (all earlier members for rows without a match), so in a cluster of near-copies,
    where phase 1 finds the cluster's first rows, it has next to nothing left to compare."""
    f = as_fraction(threshold)
    num, den = f.numerator, f.denominator
    facts = sketches(sets)
    p = posting_lists(sets, facts, num, den)
    first = _verify(_candidates(_heads(p, head_width), p, num, den), sets, facts, num, den, strict)
    first = stored(first.groupBy(F.col("rid_b").alias("rid"), F.col("id_b").alias("id")).agg(F.min("id_a").alias("bound")),
                   "neardup-first")
    a, b = p.alias("a"), p.join(first.select("rid", "bound"), "rid", "left").alias("b")
    still = F.col("b.bound").isNull() | (F.col("a.id") < F.col("b.bound"))
    cand = _pairs_of(a.join(b, candidate_condition("a", "b", num, den) & still))
    second = _verify(cand, sets, facts, num, den, strict).select(
        F.col("rid_b").alias("rid"), F.col("id_b").alias("id"), F.col("id_a").alias("earliest_id"))
    return first.withColumnRenamed("bound", "earliest_id").unionByName(second).groupBy("rid", "id").agg(
        F.min("earliest_id").alias("earliest_id"))


def near_dup_earliest(df: DataFrame, id_col: str, text_col: str, threshold=0.85, strict: bool = True) -> DataFrame:
    """(id, earliest_id, same_set): the first earlier near-duplicate of every row that has one.

    Linear in the rows: a copy names its set's first row or, if that has an earlier match,
    the match; ``same_set`` tells whether the two texts have the same tokens."""
    r = RankedSets(df, id_col, text_col)
    found = stored(earliest_matches(r.sets, threshold, strict), "neardup-earliest")
    # what a set's first rows found holds for its copies; written, so that a hot set is split
    keys = r.ids.join(found, ["rid", "id"]).select("skey", "earliest_id").distinct()
    copied = stored(r.firsts.join(keys, "skey", "left"), "neardup-groups")
    first = F.coalesce("earliest_id", "first_id")
    copies = r.ids.join(r.copies, "rid", "left_semi").join(copied, "skey").select(
        "id", first.alias("earliest_id"), F.col("earliest_id").isNull().alias("same_set"))
    return found.select("id", "earliest_id", F.lit(False).alias("same_set")).unionByName(copies)


def near_dup_pairs(df: DataFrame, id_col: str, text_col: str, threshold=0.85,
                   strict: bool = True) -> DataFrame:
    """Near-duplicate pairs between distinct token sets.

    Rows whose token set equals an earlier row's are reported by
    ``duplicate_members`` instead of as pairs.
    """
    return near_dup_pairs_of_sets(RankedSets(df, id_col, text_col, keep_rows=False).sets, threshold, strict)


def duplicate_members(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, rep_id) for every row whose token set equals an earlier row's."""
    ts = token_sets(df, id_col, text_col).where(F.col("id").isNotNull())
    reps = ts.where(F.col("n") > 0).groupBy("skey").agg(F.min("id").alias("rep_id"), F.count(F.lit(1)).alias("k"))
    reps = materialize(reps.where("k > 1").drop("k"))
    # the inner join drops empty sets (they have no representative)
    return (ts.join(reps, "skey").where(F.col("id") != F.col("rep_id"))
            .select("id", "rep_id"))


def near_dup_drop_earliest(df: DataFrame, id_col: str, text_col: str, threshold=0.85,
                           strict: bool = True) -> DataFrame:
    """Drop every row that has an earlier (smaller id) near-duplicate.

    Rows with no tokens or without an id never match.  Returns the surviving input rows.
    """
    r = RankedSets(df, id_col, text_col)
    return r.without(rows_with_earlier_match(r.sets, threshold, strict))


def near_dup_drop_greedy(df: DataFrame, id_col: str, text_col: str, threshold=0.85,
                         strict: bool = True, head_width: int = HEAD_WIDTH) -> DataFrame:
    """Greedy first-wins: scan rows by id, keep a row unless it is similar to
    an earlier *kept* row (a dropped row does not suppress later rows).

    The lexicographically-first maximal independent set of the similarity
    graph, computed in rounds without building the whole graph:

    * edges start as the pairs found against the earliest ``head_width``
      members of each posting list; rows with none of those get their
      full list of earlier edges ("expanded");
    * per round, an undecided row with a kept earlier neighbour is dropped;
      one whose known earlier neighbours are all dropped is kept if expanded,
      else its full earlier-edge list is fetched first (exact: the smallest
      undecided row can always be decided or expanded).

    A cluster of k mutually similar near-copies is settled from the head
    edges (about k*head_width comparisons, not k*k).  Rounds are bounded by
    the longest dependency chain; every round's state is a reliable
    checkpoint in the shared checkpoint folder.
    """
    f = as_fraction(threshold)
    num, den = f.numerator, f.denominator
    r = RankedSets(df, id_col, text_col)
    sets = r.sets
    facts = sketches(sets)
    p = posting_lists(sets, facts, num, den)
    e1 = _verify(_candidates(_heads(p, head_width), p, num, den), sets, facts, num, den, strict).select("rid_a", "rid_b")
    e1 = materialize(e1)
    partial = e1.select(F.col("rid_b").alias("rid")).distinct()
    open_p = p.join(partial, "rid", "left_anti")
    e2 = _verify(_candidates(p, open_p, num, den), sets, facts, num, den, strict).select("rid_a", "rid_b")
    edges = materialize(e1.unionByName(e2).distinct())

    def nodes_of(e):
        return e.select(F.col("rid_a").alias("rid")).unionByName(e.select(F.col("rid_b").alias("rid"))).distinct()

    # st: 0 undecided, 1 kept, 2 dropped; exp: full earlier-edge list known
    status = materialize(nodes_of(edges).join(partial.withColumn("_p", F.lit(True)), "rid", "left").select(
        "rid", F.lit(0).alias("st"), F.col("_p").isNull().alias("exp")))
    pending = status.limit(1).count() > 0
    before = None
    while pending:
        src = status.select(F.col("rid").alias("rid_a"), F.col("st").alias("st_a"))
        verdict = (edges.join(src, "rid_a")
                   .groupBy(F.col("rid_b").alias("rid"))
                   .agg(F.max((F.col("st_a") == 1).cast("int")).alias("any_kept"),
                        F.min((F.col("st_a") == 2).cast("int")).alias("all_dropped")))
        v = status.join(verdict, "rid", "left")
        any_kept = F.coalesce(F.col("any_kept"), F.lit(0)) == 1
        all_dropped = F.coalesce(F.col("all_dropped"), F.lit(1)) == 1
        undecided = F.col("st") == 0
        v = v.withColumn("_expand", undecided & ~any_kept & all_dropped & ~F.col("exp"))
        v = materialize(v.select(
            "rid", "exp", "_expand",
            F.when(~undecided, F.col("st")).when(any_kept, F.lit(2))
            .when(all_dropped & F.col("exp"), F.lit(1)).otherwise(F.lit(0)).alias("st")))
        n_open, n_grow = v.agg(F.count_if(F.col("st") == 0), F.count_if("_expand")).first()
        if (n_open, n_grow) == before and not n_grow:
            raise RuntimeError("a round of the greedy near-duplicate removal changed nothing")
        before = (n_open, n_grow)
        if n_grow:
            # fetch the full earlier-edge lists of the rows that need them
            grow = v.where("_expand").select("rid")
            new_e = _verify(_candidates(p, p.join(grow, "rid", "left_semi"), num, den),
                            sets, facts, num, den, strict).select("rid_a", "rid_b")
            edges = materialize(edges.unionByName(new_e).distinct())
            # an earlier endpoint not seen before had no head edges, so its
            # earlier edges were all fetched up front: it is expanded
            fresh = nodes_of(new_e).join(v.select("rid"), "rid", "left_anti").select(
                "rid", F.lit(0).alias("st"), F.lit(True).alias("exp"))
            status = v.select("rid", "st", (F.col("exp") | F.col("_expand")).alias("exp")).unionByName(fresh)
        else:
            status = v.select("rid", "st", "exp")
        pending = n_open > 0 or n_grow > 0
    return r.without(status.where(F.col("st") == 2))


#: Pairs of which a task compares the texts, about.
EDIT_PAIRS = 20_000
def _edits(a: bytes, b: bytes, wide: bool) -> int:
    """The Levenshtein distance of two texts: their UTF-32 code points (``wide``) or their bytes.

    Bit-parallel (Myers 1999, Hyyro 2003): a column of the table is two whole numbers with a
    bit for each character of ``a``, so a character of ``b`` costs a few operations on them."""
    x, y = (np.frombuffer(t, np.uint32 if wide else np.uint8) for t in (a, b))
    for _ in range(2):  # what both begin with goes; turned round, what both end with
        k = min(len(x), len(y))
        same = x[:k] == y[:k]
        k = k if same.all() else int(same.argmin())
        x, y = x[k:][::-1], y[k:][::-1]
    if not len(x) or not len(y):
        return len(x) + len(y)
    letters, code = np.unique(x, return_inverse=True)
    places = [int.from_bytes(np.packbits(code == i, bitorder="little").tobytes(), "little") for i in range(len(letters))]
    where = dict(zip(letters.tolist(), places))
    full, top, score = (1 << len(x)) - 1, len(x) - 1, len(x)
    plus, minus = full, 0
    for c in y.tolist():
        eq = where.get(c, 0)
        zero = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | (full & ~(zero | plus)), zero & plus
        score += (up >> top & 1) - (down >> top & 1)
        up, down = (up << 1 | 1) & full, down << 1 & full
        plus, minus = down | (full & ~(zero | up)), up & zero
    return score


def _edits_in_band(x: np.ndarray, y: np.ndarray, width: int, places: dict[int, int]) -> int:
    """The least edits of a path that keeps to ``width`` diagonals around the ends of the table.
    ``places``: for each character the places in ``x`` that have it, as bits."""
    slope = len(x) - len(y)
    slack = (width - 1 - abs(slope)) // 2
    first = min(0, slope) - slack  # the lowest diagonal; a bit is a row, and the rows move down with the columns
    full, top, score = (1 << width) - 1, width - 1, first + width - 1
    plus, minus = full >> -first << -first, 0
    for j, c in enumerate(y.tolist(), first):
        eq = places.get(c, 0)
        eq = (eq >> j if j > 0 else eq << -j) & full
        zero = (((eq & plus) + plus) & full ^ plus) | eq | minus
        up, down = minus | (full & ~(zero | plus)), zero & plus
        score += 1 - (zero >> top)
        zero >>= 1
        plus, minus = down | (full & ~(zero | up)), zero & up
    below = (full >> 1) >> (slope - first) << (slope - first)  # rows between the last one of x and the score's
    return score - (plus & below).bit_count() + (minus & below).bit_count()


def _edits_up_to(x: np.ndarray, y: np.ndarray, most: int, width: int) -> int:
    """The Levenshtein distance, or any larger number than ``most`` if it is more than that; ``width``
    is the number of diagonals to begin with."""
    for _ in range(2):
        k = min(len(x), len(y))
        same = x[:k] == y[:k]
        k = k if same.all() else int(same.argmin())
        x, y = x[k:][::-1], y[k:][::-1]
    if not len(x) or not len(y):
        return len(x) + len(y)
    letters, code = np.unique(x, return_inverse=True)
    places = {c: int.from_bytes(np.packbits(code == i, bitorder="little").tobytes(), "little") for i, c in enumerate(letters.tolist())}
    apart = abs(len(x) - len(y))
    while True:
        width = min(max(width, apart + 33), max(most, apart) + 2, len(x) + len(y) + 2)
        found, sure = _edits_in_band(x, y, width, places), _sure(width, apart)
        if found <= sure + 1 or sure >= most or width == len(x) + len(y) + 2:
            return found
        width *= 2


def _sure(width, apart):
    """Paths of so many edits keep to ``width`` diagonals, if the texts' lengths are ``apart``."""
    return apart + 2 * ((width - 1 - apart) // 2) + 1


#: Words of 64 diagonals that pairs are compared with together, at most; beyond, one by one.
TOGETHER = 32
#: Bytes of the bits of a text's characters, at most, for it to be compared with others together.
PLACES = 4 << 20
#: Characters and pairs of which a task compares the texts at once, about.
AT_ONCE, PAIRS_AT_ONCE = 4 << 20, 1 << 13


class _Places:
    """For each text and character (numbered from 0), the places that have it as bits of words, at ``start``
    in ``bits``; ``pad`` words of zeros (by text) stand before them, and more after.  Characters that
    a text lacks have zeros as well, as have all characters of texts without a pad."""

    def __init__(self, codes: np.ndarray, begin: np.ndarray, size: np.ndarray, letters: int, pad: np.ndarray) -> None:
        self.start, self.pad = np.zeros(len(size) * letters, np.int64), np.where(size > 0, pad, 0)
        words = np.where(self.pad > 0, size // 64 + 2 * pad + 3, 0)
        total = int(words.max(initial=0))  # of zeros, for characters that a text lacks
        found = [np.zeros(total, np.uint64)]
        for t in np.flatnonzero(self.pad):
            own = codes[begin[t]:begin[t] + size[t]]
            kinds = np.flatnonzero(np.bincount(own, minlength=letters))
            if len(kinds) * words[t] * 8 > PLACES:
                self.pad[t] = 0
                continue
            number = np.zeros(letters, np.int64)
            number[kinds] = np.arange(len(kinds))
            place = np.arange(len(own)) + 64 * pad[t]
            # sums of distinct powers below 2**32 are exact in doubles
            halves = np.bincount(number[own] * (2 * words[t]) + (place >> 5), np.ldexp(1.0, place & 31), 2 * len(kinds) * words[t])
            found.append(halves.astype(np.uint32).view(np.uint64))
            self.start[t * letters + kinds] = total + np.arange(len(kinds)) * words[t]
            total += len(found[-1])
        self.bits = np.concatenate(found)


def _edits_together(p: _Places, codes: np.ndarray, letters: int, begin: np.ndarray, size: np.ndarray,
                    x: np.ndarray, y: np.ndarray, words: int) -> np.ndarray:
    """As ``_edits_in_band`` for all pairs of texts ``x`` and ``y`` at once, with 64 * ``words`` diagonals."""
    order = np.argsort(-size[y], kind="stable")
    x, y = x[order], y[order]
    u64, one = np.uint64, np.uint64(1)
    width, slope = 64 * words, size[x] - size[y]
    first = np.minimum(0, slope) - (width - 1 - np.abs(slope)) // 2
    ones = lambda start: np.stack([  # bits from ``start`` on
        np.where(start <= 64 * i, ~u64(0), np.where(start >= 64 * i + 64, u64(0), ~u64(0) << (np.clip(start - 64 * i, 0, 63)).astype(u64)))
        for i in range(words)])
    plus, minus = ones(-first), np.zeros((words, len(x)), u64)
    score = first + width - 1
    at, char, table = first + 64 * p.pad[x], begin[y].copy(), x * letters
    next_words = np.arange(words + 1)[:, None]
    longest, ends = size[y], -size[y]
    for j in range(int(longest[0]) if len(x) else 0):
        k = int(np.searchsorted(ends, -j, side="left"))  # the pairs that have a column j
        row = p.start[table[:k] + codes[char[:k]]]
        row += at[:k] >> 6
        shift = (at[:k] & 63).astype(u64)
        back = u64(63) - shift
        char[:k] += 1
        at[:k] += 1
        vp, vn = plus[:, :k], minus[:, :k]
        near = p.bits[row + next_words]
        eq = (near[:-1] >> shift) | (near[1:] << one << back)
        both = eq & vp
        zero = both + vp
        if words > 1:
            over = zero[:-1] < vp[:-1]  # carries, which seldom go on for more than a word
            while over.any():
                zero[1:] += over
                over = over[:-1] & (zero[1:-1] == 0)
                over = np.concatenate([np.zeros((1, k), bool), over])
        zero ^= vp
        zero |= eq
        zero |= vn
        up = vn | ~(zero | vp)
        down = zero & vp
        score[:k] += 1 - (zero[-1] >> u64(63)).astype(np.int64)
        low = zero >> one
        low[:-1] |= zero[1:] << u64(63)
        np.bitwise_or(down, ~(low | up), out=vp)
        np.bitwise_and(low, up, out=vn)
    below = ones(slope - first)
    below[-1] &= ~u64(0) >> one
    score += (np.bitwise_count(minus & below).astype(np.int64) - np.bitwise_count(plus & below)).sum(axis=0)
    found = np.empty(len(x), np.int64)
    found[order] = score
    return found


def _alone(size: np.ndarray, words: int) -> np.ndarray:
    """Which of some pairs (by their columns) cost less one by one than as columns of all: the longest, if few."""
    order = np.argsort(-size, kind="stable")
    by = np.append(size[order], 0).astype(float)
    # microseconds: a column of all, a column of one pair by itself, a column of one pair among many
    cost = (60 + words) * by + np.concatenate([[0], np.cumsum(by[:-1])]) * (1.0 - 0.02 * words)
    found = np.zeros(len(size), bool)
    found[order[:int(cost.argmin())]] = True
    return found


def _distances(texts: list[np.ndarray], x: np.ndarray, y: np.ndarray, guess: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Levenshtein distances of pairs of ``texts``, or larger numbers than ``most`` where it is more than
    that; ``guess`` is about how many edits they may be apart and changes the time only."""
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(size) - size
    codes = np.concatenate([*texts, np.zeros(0, np.uint8)])
    known = np.zeros(int(codes.max(initial=0)) + 1, bool)
    known[codes] = True
    letters = max(int(known.sum()), 1)
    number = np.cumsum(known) - 1
    codes = number.astype(np.min_scalar_type(letters))[codes]
    found, apart = np.full(len(x), -1, np.int64), np.abs(size[x] - size[y])
    words = np.maximum(np.minimum(guess, most) + 2, apart + 17)
    words = 1 << np.ceil(np.log2(np.maximum(words / 64, 1))).astype(np.int64)
    pad = np.zeros(len(texts), np.int64)
    np.maximum.at(pad, x, np.minimum(np.where(words > TOGETHER, 0, 2 * words), TOGETHER))
    places = _Places(codes, begin, size, letters, pad)
    n = 1
    while n <= TOGETHER:
        now = np.flatnonzero((found < 0) & (words == n) & (places.pad[x] >= n))
        now = now[~_alone(size[y[now]], n)]
        if len(now):
            d = _edits_together(places, codes, letters, begin, size, x[now], y[now], n)
            sure = _sure(64 * n, apart[now])
            settled = (d <= sure + 1) | (sure >= most[now])
            found[now[settled]] = d[settled]
            words[now[~settled]] = 2 * n
        n *= 2
    for i in np.flatnonzero(found < 0):
        found[i] = _edits_up_to(texts[x[i]], texts[y[i]], int(most[i]), 64 * int(words[i]))
    return found


def _edit_cells(batches: Iterator[pa.RecordBatch], wide: bool, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Cells, one after another, of texts (key, text) and then pairs of keys (key, other, ...): the pairs
    with ``longest`` and ``edit_distance``, for all texts of the keys, where num/den of the longest or
    less are edits."""
    texts, of, chars = [], {}, 0
    waiting, xs, ys = [], [], []

    def settled() -> Iterator[pa.RecordBatch]:
        x, y = np.array(xs, np.int64), np.array(ys, np.int64)
        if len(x):
            rows = pa.Table.from_batches([b for b, _ in waiting]).combine_chunks().to_batches()[0]
            row = np.concatenate([r for _, r in waiting])
            size = np.array([len(t) for t in texts], np.int64)
            longest, apart = np.maximum(size[x], size[y]), np.abs(size[x] - size[y])
            most = longest * num // den
            may = np.flatnonzero(apart <= most)
            x, y, row, longest, most = x[may], y[may], row[may], longest[may], most[may]
            differ = (rows.column("n_union").to_numpy() - rows.column("n_common").to_numpy())[row]
            d = _distances(texts, x, y, 4 * differ + 16, most)
            good = np.flatnonzero(d <= most)
            out = rows.take(pa.array(row[good]))
            yield pa.RecordBatch.from_arrays(
                [out.column(c) for c in ("id_a", "id_b", "n_common", "n_union")] + [pa.array(longest[good]), pa.array(d[good], pa.int32())],
                ["id_a", "id_b", "n_common", "n_union", "longest", "edit_distance"])

    cell, total = None, 0
    for whole in batches:
        cells = whole.column("cell").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            if cells[start] != cell:
                if chars > AT_ONCE or len(xs) > PAIRS_AT_ONCE:
                    yield from settled()
                    texts, chars, waiting, xs, ys, total = [], 0, [], [], [], 0
                cell, of = cells[start], {}
            part = whole.slice(start, end - start)
            is_text = part.column("text").is_valid().to_numpy(zero_copy_only=False)
            here = int(is_text.sum())  # texts stand first
            for key, text in zip(part.column("key").slice(0, here).to_pylist(), part.column("text").slice(0, here).to_pylist()):
                of.setdefault(key, []).append(len(texts))
                texts.append(np.frombuffer(text.encode("utf-32-le" if wide else "utf-8"), np.uint32 if wide else np.uint8))
                chars += len(texts[-1])
            rest = part.slice(here).drop_columns(["text"])
            row = []
            for i, (a, b) in enumerate(zip(rest.column("key").to_pylist(), rest.column("other").to_pylist()), total):
                for v in of.get(a, ()):
                    for w in of.get(b, ()):
                        xs.append(v)
                        ys.append(w)
                        row.append(i)
            if rest.num_rows:
                waiting.append((rest, np.array(row, np.int64)))
                total += rest.num_rows
    yield from settled()


def near_dup_pairs_edit(df: DataFrame, id_col: str, text_col: str, threshold=0.85,
                        min_edit_ratio: float = 0.85, strict: bool = True, unit: str = "chars") -> DataFrame:
    """Jaccard-verified pairs that also pass an edit ratio
    ``1 - levenshtein(a, b) / max(len(a), len(b)) >= min_edit_ratio``.

    The edit distance runs on verified pairs only; texts of their ids alone are sent to the
    cells that compare them (``_cells``).  ``unit``: edits and lengths count ``chars`` (code
    points) or ``bytes`` of the UTF-8 form.
    """
    if unit not in ("chars", "bytes"):
        raise ValueError("unit is 'chars' or 'bytes'")
    with passing() as made:
        pairs = near_dup_pairs(df, id_col, text_col, threshold, strict)
    pairs = stored(pairs, "neardup-pairs")
    made.delete()
    texts = df.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.xxhash64(id_col).alias("key"), F.col(text_col).alias("text"))
    with passing() as made:
        cells = _cells(pairs.select("*", F.xxhash64("id_a").alias("key"), F.xxhash64("id_b").alias("other")),
                       texts.groupBy("key").agg(F.sum(F.octet_length("text")).alias("bytes")))
        asked = stored(_asked(cells), "neardup-asked")
        texts = _among(texts, asked.select("key").distinct(), "key")
        f = as_fraction(min_edit_ratio)
        rows = asked.join(texts, "key").unionByName(cells, allowMissingColumns=True)
        rows = rows.repartition(max(4 * df.sparkSession.sparkContext.defaultParallelism, pairs.count() // EDIT_PAIRS), "cell")
        rows = rows.sortWithinPartitions("cell", F.col("text").isNull()).select("cell", "key", "other", "text", *pairs.columns)
        kinds = {n: pairs.schema[n].dataType.simpleString() for n in pairs.columns} | {"longest": "bigint", "edit_distance": "int"}
        found = stored(rows.mapInArrow(lambda b: _edit_cells(b, unit == "chars", f.denominator - f.numerator, f.denominator),
                                       ", ".join(f"{n} {k}" for n, k in kinds.items())), "neardup-edits", keep=True)
    made.delete()
    ratio = F.lit(1.0) - F.col("edit_distance") / F.col("longest")
    return found.select("id_a", "id_b", "n_common", "n_union", "edit_distance", ratio.alias("edit_ratio"))


def band_shape(threshold, loss: float = 1e-9, most: int = 32) -> tuple[int, int]:
    """(bands, min-hashes in a band) that miss a pair at the threshold with odds of at most ``loss``.

    A band holds as many as need ``most`` bands at most; higher similarities are missed less."""
    t = float(as_fraction(threshold))
    if t >= 1:
        return 1, 1
    need = lambda r: math.ceil(math.log(loss) / math.log1p(-t ** r))
    r = 1
    while r < 8 and need(r + 1) <= most:
        r += 1
    return need(r), r


def near_dup_pairs_approx(df: DataFrame, id_col: str, text_col: str, threshold=0.85,
                          strict: bool = True, num_hash_tables: int | None = None,
                          seed: int = 17) -> DataFrame:
    """The pairs of ``near_dup_pairs``, all of them: candidates share one of several bands of seeded
    min-hashes over 64-bit hashes of token ranks, or a key of the exact join; then the same
    exact verification.

    Bands alone leave out a pair above the threshold that shares none (odds below 1e-9 with
    the default number of bands, ``band_shape``; more with fewer ``num_hash_tables``), so the
    sets meet on the part keys of ``posting_lists`` as well, which similar sets always share.
    ``num_hash_tables`` and ``seed`` change the candidates, not the result.
    """
    f = as_fraction(threshold)
    num, den = f.numerator, f.denominator
    sets = RankedSets(df, id_col, text_col, keep_rows=False).sets
    facts = sketches(sets)
    bands, width = band_shape(threshold, most=32 if num_hash_tables else WIDE_BANDS)
    bands = num_hash_tables or bands
    keys = sets.select("rid", "ranks").mapInArrow(lambda b: _band_keys(b, bands, width, seed), "rid long, key long")
    p = posting_lists(sets, facts, num, den, keys.withColumn("own", F.lit(True)))
    return _verify(_candidates(p, p, num, den), sets, facts, num, den, strict, many=True).drop("rid_a", "rid_b")


#: Bands at most where the caller names no number: the more, the more min-hashes in each
#: and the fewer candidates by chance.
WIDE_BANDS = 70


def _band_keys(batches: Iterator[pa.RecordBatch], bands: int, width: int, seed: int) -> Iterator[pa.RecordBatch]:
    """(rid, key) of sets (rid, ranks): a hash of each band of ``width`` seeded min-hashes."""
    seeds = _mixed(np.arange(seed, seed + bands * width, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    odd = seeds | np.uint64(1)
    for batch in batches:
        rid = batch.column("rid").to_numpy()
        ranks = batch.column("ranks")
        ends = np.cumsum(ranks.value_lengths().to_numpy(zero_copy_only=False))
        toks = _mixed(ranks.flatten().to_numpy(zero_copy_only=False).view(np.uint64))
        out, start = np.empty((len(rid), bands), np.uint64), 0
        for i, end in enumerate(ends):
            least = np.full(bands * width, np.uint64(0xFFFFFFFFFFFFFFFF))
            for j in range(start, end, 1024):  # so a long set takes no more memory than a short one
                some = toks[j:min(j + 1024, end), None] * odd
                some ^= some >> np.uint64(32)
                some *= seeds
                np.minimum(least, some.min(axis=0), out=least)
            start = end
            key = np.arange(bands, dtype=np.uint64)
            for m in least.reshape(bands, width).T:
                key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) ^ m)
            out[i] = key
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(rid, bands)), pa.array(out.ravel().view(np.int64))], ["rid", "key"])
