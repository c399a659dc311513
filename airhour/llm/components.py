"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airhour.session import scratch_path


def _with_least(links: DataFrame) -> DataFrame:
    """Each (node, other) with the least of the node and all its others; partial minima meet, then a join."""
    least = links.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    return links.join(least, "node")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
    return _with_least(both).filter("other > node").select(F.col("other").alias("node"), F.col("least").alias("other"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other"))
    starred = _with_least(down)
    kept = starred.select(F.col("other").alias("node"), F.col("least").alias("other"))
    own = starred.select("node", F.col("least").alias("other"))
    return kept.unionByName(own).filter("node != other").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node with a link; the root is the least node of its component, which is left out.

    Every round is written to the shared folder, which cuts the lineage; only a count and a checksum
    reach the driver. The rounds grow with the logarithm of the longest chain.
    """
    spark = links.sparkSession
    now = links.select(F.col(a).alias("node"), F.col(b).alias("other")).filter("node != other").distinct()
    last = None
    while True:
        path = scratch_path(spark, "stars")
        now.write.parquet(path)
        now = spark.read.schema(now.schema).parquet(path)
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))).first()
        if mark == last or mark[0] == 0:
            return now.select("node", F.col("other").alias("root"))
        last = mark
        now = _small_star(_large_star(now))
