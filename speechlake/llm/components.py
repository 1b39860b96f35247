"""Connected components of a link table, in rounds over the shared folder."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechlake.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the least of the node and its neighbours instead."""
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, are linked to the least of those neighbours instead."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionAll(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (least node reachable) of every node of ``links`` (``a``, ``b``) that is not its own root.

    Alternating star contractions: groups of links meet only in minimum aggregates and in joins whose skew the runtime
    splits. Each round is written, so the plan stays short and lost executors cost one round. Self links and repeated
    links count once; null ends are left out; without links the result is empty.
    """
    rounds = written(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    while True:
        rounds = written(_small_star(_large_star(rounds)), "links")
        # Two sums that only stay equal, round to round, when the links do.
        now = rounds.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            return rounds.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now
