"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import stage


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) between numbers become (node, root): root is the smallest node reachable.

    Alternates large and small stars: every round moves links towards the
    smallest node of each neighbourhood, so a component becomes a star in a
    number of rounds that grows with the logarithm of its size.  Each round is
    a written table.  Nodes without a link to another node are not returned.
    """
    now = stage(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    mark = None
    while True:
        found = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).distinct()
        mark = found
        both = now.select("a", "b").union(now.select("b", "a"))
        least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = stage(
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(),
            "large",
        )
        least = stage(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.where("a > b").join(least, "a")
        now = stage(
            small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.where("a <> m"))
            .distinct(),
            "links",
        )
