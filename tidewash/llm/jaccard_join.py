"""Operator 9, n-gram Jaccard join with set parts as keys.

A document is its set of distinct word shingles.  Linked sets of sizes nx and ny differ in
at most ``h = (nx + ny) * (den - num) / (den + num)`` shingles.  Shingles are dealt by hash
among more than ``h`` parts, so linked sets have equal parts and meet on them.  Unlike a
shingle, whose posting list grows with the table, a part of several shingles is shared by
copies and next to nobody else, so candidates grow with the links and not with the square of the table.

1. Weights: shingles that many documents have are found by counts in chunks.  A set leaves
   out the parts that are most often alike by chance.  The weights steer cost only; any
   give the same result.
2. Sets with equal hashes are one class, so copies never meet each other again.
3. A set has the keys of its own size class and of the next one (a linked larger set is in
   either); only keys of several classes are written (``operators.similarity`` explains them).
   Below a threshold of 1/2, where parts would be empty, keys are the shingles of a prefix.
4. Stars, ``TURNS`` times: on every posting list each document meets ``HUBS`` members, and
   one of them is verified on whole sets; verified pairs are merged into components.  In the
   first turn it is the most central member (with most and longest lists), the document's hub;
   later it is the one that it shares most keys with, on lists that hold several components.
5. Rest, across hubs: documents outside the largest component of a list are paired with all
   documents of other components and other hubs that share a key.
6. Rest, of one hub: two documents differ exactly where their differences from the hub differ.
   So they meet on a prefix of these differences (``_within_hubs``), most of which are a
   document's own.  So every candidate pair is either verified, excluded by a bound or already
   connected, and no link between components is lost, while the pairs inside a large group of
   near copies are not enumerated, whether they link or just miss the threshold.

Bounds (never lossy): sizes; parity bits of a set, whose differences count at most
the symmetric difference of two sets.  Whole sets decide with integer arithmetic.

Defined cases: texts without words, empty or null have no set and link with nothing;
a text with fewer words than a shingle has its whole sequence as one; null ids are
ignored when a component's smallest id is taken (a component of null ids has null);
repeated rows link as copies; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewash.llm.common import buffers, doc_key, frees, release, sliced, written
from tidewash.llm.components import components
from tidewash.llm.words import SPACED, mix, shingles, word_hashes
from tidewash.operators.similarity import RARE, _keys_of, _size_classes

#: Shingles counted together when frequent ones are sought.
CHUNK = 4 << 20
#: A shingle in a document of this many (of a chunk, of all) is frequent.
CHUNK_SHARE, TABLE_SHARE = 1000, 5000
#: Frequent shingles that have a weight, the most frequent first (16 MB broadcast).
#: Beyond it the weights only get less sharp.
FREQUENT = 1 << 20
#: Parity bits of a set, in longs, by its size: the lower bounds of the sizes and the longs.
BIT_SIZES, BIT_LONGS = (0, 256, 2048), (8, 32, 128)
#: Members of a posting list that its other members meet in a turn, and turns.
HUBS, TURNS = 16, 2
#: Rounds of component search in a turn.  Labels that are not final only leave more pairs
#: to the next step; the last search runs to the end.
LABEL_ROUNDS = 2
#: Posting lists of this length and more are dealt among SALTS tasks.
LONG_LIST, SALTS = 1000, 16
#: Slots of the bitmap of documents whose whole sets are needed (2 MB).
SLOTS = 1 << 24


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    hashes, _, _, bounds = word_hashes(*buffers(batch.column("text")), SPACED)
    sh, sb = shingles(hashes, bounds, size)
    for a, b in zip(sb[:-1], sb[1:]):
        yield np.unique(sh[a:b])


@frees
def _frequent(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    def counted(parts):
        token, df = np.unique(np.concatenate(parts), return_counts=True)
        keep = df >= max(2, len(parts) // CHUNK_SHARE)
        return pa.RecordBatch.from_arrays([pa.array(token[keep].view(np.int64)), pa.array(df[keep].astype(np.int64)),
                                           ], ["token", "df"])

    parts, held = [], 0
    for batch in sliced(batches, "text"):
        for s in _sets(batch, size):
            parts.append(s)
            held += len(s)
            if held >= CHUNK:
                yield counted(parts)
                parts, held = [], 0
    if parts:
        yield counted(parts)


def _parity(s: np.ndarray) -> np.ndarray:
    """The parities of the numbers of shingles that the leading bits deal to each place, as longs."""
    longs = BIT_LONGS[int(np.searchsorted(BIT_SIZES, len(s), side="right")) - 1]
    places = longs * 64
    odd = np.bincount((s >> np.uint64(65 - places.bit_length())).astype(np.int64), minlength=places) & 1
    powers = np.uint64(1) << np.arange(64, dtype=np.uint64)
    return (odd.reshape(longs, 64).astype(np.uint64) * powers).sum(axis=1, dtype=np.uint64).view(np.int64)


def _keys(sets: list[np.ndarray], num: int, den: int, frequent: np.ndarray, weights: np.ndarray) -> list[pa.Array]:
    """Per set, the keys of its size class (own) and those of the next one."""
    n = np.array([len(s) for s in sets], np.int64)
    tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    if 2 * num < den:
        at = np.arange(len(tokens)) - np.repeat(np.cumsum(n) - n, n)
        first = at <= (n + (-num * n // den))[owner]
        found = [(owner[first], tokens[first]), (owner[:0], tokens[:0])]
    else:
        weight = np.full(len(tokens), RARE, np.int64)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
            weight = np.where(frequent[at] == tokens, weights[at], RARE)
        bounds = _size_classes(int(n.max(initial=1)), num, den)
        some = np.flatnonzero(n)
        own = np.searchsorted(bounds, n[some], side="right") - 1
        place = np.repeat(np.arange(len(some)), n[some])
        parts = [_keys_of(tokens, place, c, bounds[c + 1] - 1, weight, num, den) for c in (own, own + 1)]
        found = [(some[of], key) for of, key in parts]
    bound = [np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(sets)))]) for of, _ in found]
    return [pa.ListArray.from_arrays(pa.array(b, pa.int32()), pa.array(key.view(np.int64))) for b, (_, key) in zip(bound, found)]


@frees
def _profiles(batches: Iterator[pa.RecordBatch], size: int, num: int, den: int,
              frequent: np.ndarray, weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per document: set size, set digest, parity bits and keys.

    ``frequent`` are the sorted frequent shingles, ``weights`` how seldom documents have them."""
    for batch in sliced(batches, "text"):
        sets = list(_sets(batch, size))
        rows = [(len(s), int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)),
                 int(mix(s + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64).view(np.int64)),
                 _parity(s) if len(s) else None) for s in sets]
        *numbers, bits = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("key"), *(pa.array(c, pa.int64()) for c in numbers),
             pa.array(bits, pa.list_(pa.int64())), *_keys(sets, num, den, frequent, weights)],
            ["id", "key", "n", "sig_a", "sig_b", "bits", "own", "next"])


@frees
def _whole_sets(batches: Iterator[pa.RecordBatch], size: int, wanted: bytes) -> Iterator[pa.RecordBatch]:
    """The sets of documents whose slot is wanted; of repeated rows one in each task."""
    flags = np.unpackbits(np.frombuffer(wanted, np.uint8)).view(bool)
    seen: set[bytes] = set()
    for batch in sliced(batches, "text"):
        keep = flags[batch.column("slot").to_numpy(zero_copy_only=False)]
        for i in np.flatnonzero(keep):
            key = batch.column("key")[int(i)].as_py()
            keep[i] = key not in seen
            seen.add(key)
        some = batch.filter(pa.array(keep))
        if some.num_rows:
            yield pa.RecordBatch.from_arrays(
                [some.column("key"), pa.array([s.view(np.int64) for s in _sets(some, size)], pa.list_(pa.int64()))],
                ["key", "tokens"])


def _required(n_x: Column, n_y: Column, num: int, den: int) -> Column:
    """Smallest overlap of sets of these sizes that are linked."""
    return F.ceil(num * (n_x + n_y) / F.lit(num + den)).cast("long")


def _sizes_allow(x: str, y: str, num: int, den: int) -> Column:
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    return (den * F.least(nx, ny) >= num * F.greatest(nx, ny)) & (F.col(f"{x}.own") | F.col(f"{y}.own"))


def _sets_of(docs: DataFrame, keys: list[DataFrame], size: int) -> DataFrame:
    """(key, tokens), the sets of the documents with these keys: a pass over the texts, led by a
    bitmap of the keys (fixed size; what it lets through in excess, a join drops)."""
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(SLOTS)).cast("int")
    flags = np.zeros(SLOTS, bool)
    for some in keys:
        flags[some.select(slot("key").alias("s")).distinct().toArrow().column("s").to_numpy()] = True  # <= SLOTS values
    wanted = docs.sparkSession.sparkContext.broadcast(np.packbits(flags).tobytes())
    return written(docs.withColumn("slot", slot("key")).mapInArrow(
        lambda b: _whole_sets(b, size, wanted.value), "key binary, tokens array<long>"), "jaccard-sets")


def _verified(docs: DataFrame, pairs: DataFrame, facts: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose whole sets are linked; first their parity bits are compared.

    Only documents of some pair give their sets."""
    side = lambda c: facts.select(F.col("row").alias(c), *(F.col(f).alias(f"{f}_{c}") for f in ("key", "n", "bits")))
    differ = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    n_a, n_b = F.col("n_a"), F.col("n_b")
    may = (F.size("bits_a") != F.size("bits_b")) | (differ <= n_a + n_b - 2 * _required(n_a, n_b, num, den))
    keyed = written(pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").where(may)
                    .select("a", "b", "key_a", "key_b"), "jaccard-pairs")
    if keyed.isEmpty():
        return keyed.select("a", "b")
    sets = _sets_of(docs, [keyed.select(F.explode(F.array("key_a", "key_b")).alias("key"))], size)
    both = (keyed.join(sets.select(F.col("key").alias("key_b"), F.col("tokens").alias("y")), "key_b").drop("key_b")
            .join(sets.select(F.col("key").alias("key_a"), F.col("tokens").alias("x")), "key_a"))
    inter, total = F.size(F.array_intersect("x", "y")).cast("long"), (F.size("x") + F.size("y")).cast("long")
    linked = written(both.select("a", "b", inter.alias("i"), total.alias("s"))
                     .where(F.col("i") * den >= (F.col("s") - F.col("i")) * num).select("a", "b"), "jaccard-links")
    release(keyed, sets)
    return linked


def _postings(reps: DataFrame) -> DataFrame:
    """(row, n, token, own, df, central): the keys that several classes have; df: how many;
    central: the sum of a row's df."""
    # one number for row and own: this shuffle is the largest
    keys = reps.select((F.col("row") * 2 + 1).alias("at"), F.explode("own").alias("token")).unionByName(
        reps.select((F.col("row") * 2).alias("at"), F.explode("next").alias("token")))
    # a list is as long as a group of sets that look alike
    met = written(keys.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("df > 1").select(
        F.shiftright("at", 1).alias("row"), "token", (F.col("at") % 2 == 1).alias("own"), "df"), "jaccard-met")
    central = met.groupBy("row").agg(F.sum("df").alias("central"))
    entries = written(met.join(reps.select("row", "n").join(central, "row"), "row"), "jaccard-entries")
    release(met)
    return entries


def _mixed_lists(entries: DataFrame, label: DataFrame | None) -> DataFrame:
    """Posting lists that hold several components: the entries with comp, and major, the
    component with most members in the list."""
    comp = F.col("row") if label is None else F.coalesce("label", "row")
    known = entries if label is None else entries.join(label.withColumnRenamed("node", "row"), "row", "left")
    known = written(known.select(*entries.columns, comp.alias("comp")), "jaccard-known")
    mixed = written(known.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("k"))
                    .groupBy("token").agg(F.count(F.lit(1)).alias("comps"), F.max_by("comp", F.struct("k", "comp")).alias("major"))
                    .where("comps > 1").select("token", "major"), "jaccard-mixed")
    lists = written(known.join(mixed, "token"), "jaccard-lists")
    release(known, mixed)
    return lists


def _star(lists: DataFrame, turn: int, num: int, den: int) -> DataFrame:
    """(row, hub): a document and one of the HUBS first members of its lists, if sizes allow.

    In the first turn the most central members are first, and each document takes the most
    central one that is more central than itself.  Later a hash ranks documents alike in all
    lists, so that many settle on the same hub, and each document outside a list's largest
    component takes the one of another component that it shares most keys with."""
    rank = -F.col("central") if turn == 0 else F.xxhash64("row", F.lit(turn))
    long_list = F.col("df") >= LONG_LIST  # df is the same in all rows of a key
    lists = lists.withColumn("rank", rank)
    nth = F.row_number().over(Window.partitionBy("token").orderBy("rank", "row"))
    hubs = lists.withColumn("nth", nth).where(F.col("nth") <= HUBS).withColumn("salt", F.explode(
        F.when(long_list, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    hubs = written(hubs.select("row", "n", "own", "comp", "token", "rank", "salt"), "jaccard-hubs")
    members = (lists if turn == 0 else lists.where("comp <> major")).withColumn(
        "salt", F.when(long_list, F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).otherwise(0))
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    before = (y("rank") < x("rank")) | ((y("rank") == x("rank")) & (y("row") < x("row")))
    met = members.alias("x").join(hubs.alias("y"), (x("token") == y("token")) & (x("salt") == y("salt"))
                                  & (before if turn == 0 else x("comp") != y("comp")) & _sizes_allow("x", "y", num, den))
    met = met.groupBy(x("row").alias("row"), y("row").alias("hub"), y("rank")).agg(F.count(F.lit(1)).alias("k"))
    shared = F.lit(0) if turn == 0 else -F.col("k")
    best = met.groupBy("row").agg(F.min(F.struct(shared.alias("k"), "rank", "hub")).alias("best"))
    star = written(best.select("row", "best.hub"), "jaccard-star")
    release(hubs)
    return star


def _within_hubs(docs: DataFrame, lists: DataFrame, facts: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """(a, b): documents of one hub and of different components that may be linked.

    With the hub ``h``, d_x is the size of the symmetric difference of x and h.  Sets x and y are
    linked if theirs, d_x + d_y - 2 * (common differences), is at most c * (n_x + n_y), where
    c = (den - num) / (den + num).  If neither is far (d > c * (n + n_h)), the first star has linked
    both to the hub.  As n_y <= n_h + d_y, and common differences are at most d_y, a far x needs
    (d_x - c * (n_x + n_h)) / (1 + c) of them at least.  As d_x > 2c * n_h / (1 + c) for a far x, another y
    needs more than half of d_y - c * (n_y + n_h) + 2c * n_h * (1 - c) / (1 + c).  So they share one of
    the first differences of each (all but as many as needed, and one); where it is the first one that is shared, the
    differences from there on bound the rest.  What a set has beyond the hub comes first, as
    it is rarer than what it lacks."""
    total, less = num + den, den - num
    members = lists.where("row <> hub").select("row", "n", "comp", "hub").distinct()  # the hub itself was tried
    several = members.groupBy("hub").agg(F.min("comp").alias("least"), F.max("comp").alias("most"), F.count(F.lit(1)).alias("members"))
    several = written(several.where("least < most").select("hub", "members"), "jaccard-several")
    members = written(members.join(several, "hub").join(facts.select("row", "key"), "row"), "jaccard-members")
    hubs = written(several.join(facts.select(F.col("row").alias("hub"), "key", F.col("n").alias("n_hub")), "hub"), "jaccard-centres")
    sets = _sets_of(docs, [members, hubs], size)
    long_list = F.col("members") >= LONG_LIST
    own = members.join(sets, "key").withColumn(
        "salt", F.when(long_list, F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).otherwise(0)).drop("key", "members")
    theirs = hubs.join(sets.withColumnRenamed("tokens", "hub_tokens"), "key").withColumn("salt", F.explode(
        F.when(long_list, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("key", "members")
    n, d, n_hub = F.col("n"), F.col("d"), F.col("n_hub")
    excess = total * d - less * (n + n_hub)
    far_needs = F.floor((excess + (2 * den - 1)) / F.lit(2 * den))
    near_needs = F.floor((den * excess + 2 * less * num * n_hub) / F.lit(2 * total * den)) + 1
    needed = F.greatest(F.lit(1), F.when(F.col("far"), far_needs).otherwise(near_needs))
    apart = own.join(theirs, ["hub", "salt"]).select("row", "n", "comp", "hub", "n_hub", F.concat(
        F.array_except("tokens", "hub_tokens"), F.array_except("hub_tokens", "tokens")).alias("apart"))
    apart = apart.withColumn("d", F.size("apart").cast("long")).withColumn("far", excess > 0)
    first = F.slice("apart", F.lit(1), F.greatest(F.lit(0), d - needed + 1).cast("int"))
    places = written(apart.select("row", "n", "comp", "hub", "d", "far", F.posexplode(first).alias("p", "token")), "jaccard-apart")
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    most = F.least(x("d") - x("p"), y("d") - y("p"))  # common differences from the shared one on
    return places.where("far").alias("x").join(places.alias("y"), (
        (x("hub") == y("hub")) & (x("token") == y("token")) & (x("comp") != y("comp")) & (~y("far") | (x("row") < y("row")))
        & (total * (x("d") + y("d") - 2 * most) <= less * (x("n") + y("n"))))).select(
            F.least("x.row", "y.row").alias("a"), F.greatest("x.row", "y.row").alias("b"))


def _links(docs: DataFrame, entries: DataFrame, facts: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Edges (a, b) between classes whose components are those of all links."""
    pairs_of = lambda star: star.select(F.least("row", "hub").alias("a"), F.greatest("row", "hub").alias("b")).distinct()
    label, centre, tried, edges = None, None, None, None
    for turn in range(TURNS):
        lists = _mixed_lists(entries, label) if turn else entries.withColumn("comp", F.col("row"))
        star = _star(lists, turn, num, den)
        pairs = pairs_of(star)
        if turn:
            release(lists)
            if star.isEmpty():
                break
        linked = _verified(docs, pairs, facts, size, num, den)
        centre, tried, edges = (star, pairs, linked) if turn == 0 else (centre, tried.unionByName(pairs), edges.unionByName(linked))
        label = components(edges, LABEL_ROUNDS)

    # What is left: all pairs across components.
    hub = F.coalesce("hub", "row").alias("hub")
    lists = _mixed_lists(entries.join(centre, "row", "left").select(*entries.columns, hub), label)
    x, y = lists.where("comp <> major").alias("x"), lists.alias("y")
    across = (x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.comp") != F.col("y.comp")) & (F.col("x.hub") != F.col("y.hub"))
                     & ((F.col("y.comp") == F.col("y.major")) | (F.col("x.row") < F.col("y.row")))
                     & _sizes_allow("x", "y", num, den))
              .select(F.least("x.row", "y.row").alias("a"), F.greatest("x.row", "y.row").alias("b")))
    within = _within_hubs(docs, lists, facts, size, num, den)
    rest = across.unionByName(within).distinct().join(tried.distinct(), ["a", "b"], "left_anti")
    linked = _verified(docs, rest, facts, size, num, den)
    release(tried, lists, within)
    return edges.unionByName(linked)


def similarity_classes(docs: DataFrame, id_col: str, text_col: str, shingle: int = 5,
                       num: int = 4, den: int = 5) -> DataFrame:
    """One row per input row: id, key, n_shingles, component_id (smallest id reachable by
    links of Jaccard >= num/den over ``shingle``-word shingles) and class_size (rows with
    the same set)."""
    return _classes(docs, id_col, text_col, shingle, num, den).drop("component")


def _classes(docs: DataFrame, id_col: str, text_col: str, shingle: int, num: int, den: int) -> DataFrame:
    """The rows of ``similarity_classes`` and component, a number that the rows of one
    component share and no others have, whatever their ids."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), doc_key(id_col, text_col).alias("key"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    spark = docs.sparkSession

    often = (rows.select("text").mapInArrow(lambda b: _frequent(b, shingle), "token long, df long")
             .groupBy("token").agg(F.sum("df").alias("df")))
    total = docs.count()
    often = (often.where(F.col("df") >= max(8, total // TABLE_SHARE))
             .orderBy(F.desc("df"), "token").limit(FREQUENT).toArrow())
    token = often.column("token").to_numpy().view(np.uint64)
    by = np.argsort(token)
    seldom = np.log(max(total, 1) / often.column("df").to_numpy()[by]) * 100
    order = spark.sparkContext.broadcast((token[by], np.clip(seldom, 0, RARE).astype(np.int64)))

    profiles = rows.mapInArrow(
        lambda b: _profiles(b, shingle, num, den, *order.value),
        "id long, key binary, n long, sig_a long, sig_b long, bits array<long>, own array<long>, next array<long>")
    profiles = written(profiles.withColumn("row", F.monotonically_increasing_id()), "jaccard-profiles")

    sig = ["n", "sig_a", "sig_b"]
    classes = written(profiles.where("n > 0").groupBy(sig).agg(
        F.min("row").alias("rep"), F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")), "jaccard-classes")
    # copies, usually few, leave by an anti-join, so that the keys of the others stay where they are
    dealt = F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int").alias("salt")
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    extras = written(profiles.select("row", *sig, dealt).join(classes.where("rows > 1").select(*sig, "rep", every), [*sig, "salt"])
                     .where("row <> rep").select("row"), "jaccard-copies")
    reps = profiles.where("n > 0").join(extras, "row", "left_anti")
    entries = _postings(reps)
    facts = written(reps.join(entries.select("row").distinct(), "row", "left_semi").select("row", "key", "n", "bits"), "jaccard-facts")
    wide, profiles = profiles, written(profiles.drop("bits", "own", "next"), "jaccard-sizes")
    release(wide)
    links = _links(rows.select("key", "text"), entries, facts, shingle, num, den)
    label = components(links).withColumnRenamed("node", "rep")

    joined = classes.join(label, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    least = joined.groupBy("label").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("classes"))
    grouped = written(joined.join(least, "label").where("rows > 1 or classes > 1")
                      .select(*sig, "rows", "component_id", "label"), "jaccard-components")
    release(classes, extras, entries, facts)
    salted = grouped.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    out = profiles.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(
        salted, [*sig, "salt"], "left")
    return out.select("id", "key", F.col("n").alias("n_shingles"),
                      F.when(F.col("rows").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
                      F.coalesce("rows", F.lit(1)).cast("long").alias("class_size"),
                      F.coalesce("label", "row").alias("component"))


def drop_similar(docs: DataFrame, id_col: str, text_col: str, shingle: int = 5, num: int = 4,
                 den: int = 5) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id (null ids last)
    and, of several texts with that id, the smallest key.

    Rows without a set stay.  Of repeated rows one stays."""
    found = written(_classes(docs, id_col, text_col, shingle, num, den).select("id", "key", "component"), "jaccard-found")
    first = F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("first")
    several = written(found.groupBy("component").agg(first, F.count(F.lit(1)).alias("rows")).where("rows > 1").select(
        "component", F.col("first.key").alias("kept")), "jaccard-several-rows")
    # Repeated rows have the same set, so only components of several rows can hold any.
    salted = several.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    counts = (found.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(salted, ["component", "salt"])
              .groupBy("key").agg(F.first(F.col("key") == F.col("kept")).alias("stays"), F.count(F.lit(1)).alias("rows")))
    moved = written(counts.where("not stays or rows > 1").select("key", "stays"), "jaccard-moved")
    # What goes or is repeated is usually little, so the texts of the others are not shuffled.
    rows = docs.select(F.struct("*").alias("doc"), doc_key(id_col, text_col).alias("key"))
    plain = rows.join(moved.select("key"), "key", "left_anti").select("doc.*")
    again = rows.join(moved.where("stays"), "key", "left_semi").groupBy("key").agg(F.min("doc").alias("doc")).select("doc.*")
    return plain.unionByName(again)
