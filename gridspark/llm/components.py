"""Connected components of links, by alternating stars; the links never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """`node`, `root` for every node of `links` (`a`, `b`): root is the smallest node it is tied to.

    Each round ties the neighbours of a node to the smallest of them (large star, then small star);
    it ends when a round changes nothing, after about log(nodes) rounds.
    """
    now = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "links")
    mark = _mark(now)
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # Large star: larger neighbours go to the smallest one.
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        # Small star: smaller neighbours and the node itself do.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        after = written(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        now, last, mark = after, mark, _mark(after)
        if mark == last:
            break
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
