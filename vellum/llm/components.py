"""Connected components of a link table, by alternating stars: every round is
a few aggregates and joins; nothing is collected but whether it was the last."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vellum.session import shared_path


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = shared_path(df.sparkSession, "components", name, unique=True)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _large_star(links: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least node it knows."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the least."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _settled(links: DataFrame) -> bool:
    """Whether every node is either a root only or links to one node only."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    sums = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(links: DataFrame, at_hand: bool = False) -> DataFrame:
    """links (a, b) -> (node, root): the least node of the component, for all
    nodes that have a link. Links that are ``at_hand`` in a stored table are
    read there."""
    down = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = down if at_hand else _stored(down.distinct(), "links")
    while not _settled(now):
        now = _stored(_small_star(_large_star(now)).distinct(), "stars")
    # now every link points from a node to its root
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
