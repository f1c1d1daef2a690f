"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewash.llm.common import release, written

#: Copies of each node's smallest neighbour, among which a hub's edges are dealt.
SALTS = 8


def _star(pairs: DataFrame) -> DataFrame:
    """(u, v) -> (v, smallest neighbour of u), without loops.  Salted: a hub may have
    most edges."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return (pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
            .join(least, ["u", "salt"]))


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b: long); label: the smallest node.

    With ``rounds``, stop after so many: nodes with one label are connected then, but
    connected nodes may still have different labels.

    Each round links nodes to their smallest neighbours (large star: larger neighbours;
    small star: smaller ones) and is written; it ends when a round changes nothing.
    The number of rounds grows with the logarithm of the longest chain.
    """
    current = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .where("u <> v").distinct(), "edges")
    seen, done = None, 0
    while done != rounds and not current.isEmpty():
        done += 1
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        hub = _star(large)
        small = (hub.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(hub.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        after = written(small, "edges")
        state = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        release(current)
        current = after
        if state == seen:
            break
        seen = state
    both = current.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("label")))
    return both.groupBy("node").agg(F.min("label").alias("label"))
