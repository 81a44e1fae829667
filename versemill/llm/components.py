"""Connected components of a link table, by alternating large and small stars.

Every step is two groupings by node, each aggregated before its shuffle, and a join whose hot
keys adaptive execution splits; a step's links are written to the shared folder, which cuts
lineage. Nothing but the answer whether it is done reaches the driver after a step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from versemill.session import Staging, stage_table


def _large_star(links: DataFrame) -> DataFrame:
    """Links each node's larger neighbours to the smallest node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _settled(state: DataFrame) -> bool:
    """Whether every node has one link and no node that is linked to has one itself."""
    twice = state.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a")
    inner = state.select(F.col("b").alias("a")).join(state, "a", "left_semi")
    return twice.unionByName(inner).limit(1).count() == 0


def connected_components(links: DataFrame) -> DataFrame:
    """``id, root`` for every node of ``links`` (``a, b`` long): ``root`` is the smallest node reachable."""
    with Staging(links.sparkSession) as staging:
        state = staging.table(_small_star(staging.table(links.select("a", "b").where("a != b").distinct())))
        while not _settled(state):
            state = staging.table(_small_star(staging.table(_large_star(state))))
        roots = state.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()
        return stage_table(state.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(roots))
