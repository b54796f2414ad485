"""Connected components of an edge table, by alternating large and small stars.

Each round is a group-by with a map-side minimum and a join, written to the shared folder. The joins hash
the minima, one row a vertex, and stream the edges past them, so a hub's edges are never sorted in one task. Hashed rows
can't spill, so there are as many partitions as keep a task's share of them small. The driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.shared import CLEANED, drop, partitions_for, settings, written

HASHED_ROWS = 1_000_000  # vertices of a task, on average


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least.hint("shuffle_hash"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least.hint("shuffle_hash"), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _size(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _dealt(spark: SparkSession, edges: int) -> dict[str, str]:
    """Settings of a round over so many edges, which have twice as many vertices at most. Partitions that were made small are not merged again."""
    if 2 * edges <= HASHED_ROWS:
        return CLEANED
    parts = max(partitions_for(spark), -(-2 * edges // HASHED_ROWS))
    return CLEANED | {"spark.sql.shuffle.partitions": str(parts), "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def components(edges: DataFrame) -> DataFrame:
    """(a, b): each vertex of ``edges`` (two long columns a, b) with the smallest vertex of its component.

    Roots themselves have no row. Self-loops are ignored.
    """
    spark = edges.sparkSession
    with settings(spark, CLEANED):
        edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _size(edges)
    while before[0]:
        with settings(spark, _dealt(spark, before[0])):
            last, edges = edges, written(_small_star(_large_star(edges).distinct()).where("a <> b").distinct(), "edges")
        drop(last)
        now = _size(edges)
        if now == before:
            break
        before = now
    return edges
