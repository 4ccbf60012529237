"""Connected components by alternating large-star and small-star rounds.

Each round is two grouped minima and two joins over links, written to the
shared folder, so a lost executor repeats one round at most.  Only two
numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    rest = down.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """links (a, b) of longs, a <> b -> (a, b): every linked node but the
    smallest of its component, with that smallest node."""
    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    e, seen = stored(links.select("a", "b").distinct(), "links"), None
    while (now := mark(e)) != seen and now[0]:
        seen = now
        e = stored(_small(_large(e)), "links")
    return e
