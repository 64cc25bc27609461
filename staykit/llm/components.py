"""Connected components of a table of links, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from staykit.sources.tables import Workspace


def _large_star(links: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to the smallest node it knows."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    moved = both.where("b > a").join(smallest, "a")
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node ties itself and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    smallest = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(smallest, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(smallest.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame, work: Workspace) -> DataFrame:
    """``node`` and ``root``, the smallest node it can reach, for every node that has a link in ``links`` (a, b: numbers).

    Repeated links, links in either direction and loops are allowed; NULLs link nothing. Nodes without another node do not
    appear. Each step is written to the workspace, so plans stay short; the number of steps grows with the logarithm of
    the longest path. Links never leave Spark; only a count and a checksum do.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = work.store(links, "links")
    before = None
    while True:
        links = work.store(_small_star(_large_star(links)), "links")
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before or not now[0]:
            break
        before = now
    roots = links.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
