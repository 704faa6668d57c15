"""Connected components of a graph given by its links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """node, root of every node in links(a, b): root is the least node that it is linked with, over any number of links.

    Links may repeat, go either way and join a node with itself. Each step is a grouped minimum and a join by node, and
    its result is written to the shared folder; no group is gathered.
    """
    a, b = F.least("a", "b"), F.greatest("a", "b")
    now = staged(links.select(b.alias("a"), a.alias("b")).distinct(), "links")  # a >= b
    state = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(now.where("a = b"))
        large = staged(large.distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        now = staged(small.distinct(), "links")
        seen = now.where("a <> b").agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    return now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), F.least("a", "root").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    ).groupBy("node").agg(F.min("root").alias("root"))
