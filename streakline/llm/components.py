"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streakline.llm.tables import stored


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 20)))).first()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    near = down.join(least, "a")
    return (
        near.select(F.col("m").alias("a"), "b").union(least.select(F.col("m").alias("a"), F.col("a").alias("b")))
        .filter("a <> b").distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node of its component.

    Minima pre-aggregate before each shuffle, a hub's rows are a join side that
    adaptive execution can split, and every round is written to the shared
    folder.  Self loops alone make no row.
    """
    current = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    before = None
    while (now := _state(current)) != before and now[0]:
        before = now
        current = stored(_small_star(_large_star(current)), "edges")
    return current.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        current.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
