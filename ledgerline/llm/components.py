"""Connected components by alternating large-star and small-star rounds
(Kiveris et al., 2014). Links stay distributed; each round is a table in the
shared folder, so a lost executor costs one round at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialise


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star round over links (a, b)."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.filter("v > u").join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    small = down.join(low, "u").select(F.explode(F.array(F.struct(F.col("u").alias("x"), "m"), F.struct(F.col("v").alias("x"), "m"))).alias("e"))
    return small.select(F.col("e.x").alias("b"), F.col("e.m").alias("a")).filter("a != b").select("a", "b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), roots included; root:
    the smallest node of the component. Rounds go on until nothing moves: their
    number grows with the logarithm of the longest path."""
    links = materialise(links, "links")
    while True:
        links = materialise(_stars(links), "stars")
        # Done when every node hangs on one root and no root hangs on another.
        ends = links.select(F.col("b").alias("n"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(links.select(F.col("a"), F.lit(0), F.lit(1)))
        loose = ends.groupBy("n").agg(F.sum("below").alias("below"), F.max("above").alias("above")).filter("below > 1 or (below > 0 and above > 0)")
        if loose.isEmpty():
            return links.select(F.col("b").alias("node"), F.col("a").alias("root")).union(links.select(F.col("a"), F.col("a")).distinct())
