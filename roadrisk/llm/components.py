"""Connected components of links, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.shared import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on its smallest one: those above the node (large) or up to it (small)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else \
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    met = both.join(least, "a")
    if large:
        out = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it can reach, for every node of ``links(a, b)`` that is not a root.

    Alternates large and small stars until every link leads to a root.  Each round is written to the shared folder;
    nothing but a count and a checksum of the round reaches the driver.
    """
    held, seen = written(links.where("a <> b").distinct(), "links"), None
    while True:
        held = written(_star(_star(held, True), False), "links")
        state = tuple(held.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            return held.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
