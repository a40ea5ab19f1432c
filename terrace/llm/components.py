"""Connected components over links, as joins and grouped minima that Spark distributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (smallest node of its component) of every node with a link.

    Small-star and large-star steps by turns: every node's links are moved to the smallest node it knows, until nothing
    changes. The number of steps grows with the logarithm of the longest path. Each step is a grouped minimum (combined
    before the shuffle) joined back to the links, and is written to the shared folder. NULL ends and self-links are ignored;
    no links give no rows.
    """
    edges = stage(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links")
    size = edges.count()
    while size:
        # Large star: every node links its larger neighbours to the smallest node it knows, itself included.
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = edges.join(least.withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v")).distinct()
        # Small star: every node links its smaller neighbours, and itself, to the smallest of them.
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(down, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        after = stage(moved.where("u <> v").distinct(), "links")
        now = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        was = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        edges = after
        if tuple(now) == tuple(was):
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
