"""Connected components of large edge tables, by alternating star contraction."""

from pyspark.sql import DataFrame, functions as F

from hirelens.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (columns ``a``, ``b``, any order, repeats and self-links
    allowed, nulls ignored); ``root`` is the smallest node that can be reached.

    Each round first links all larger neighbours of a node to its smallest one, then does the same among
    the smaller neighbours; every round is staged, so lost executors cost one round at most.  Only two
    numbers a round come to the driver.  A hot node costs a partial minimum and a join on a table with one
    row per node, which Spark splits at run time.
    """
    pairs = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")
    known = None
    while True:
        pairs = stage(_small_star(_large_star(pairs)).distinct(), "stars")
        summary = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if summary == known:
            break
        known = summary
    # At the fixed point every edge leads from a node to its root.
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.join(_apart(least.select("u", F.least("u", "m").alias("m"))), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(_apart(least), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _apart(least: DataFrame) -> DataFrame:
    """One row per node, shuffled once more for the join: only then can Spark split the edges of a hot node."""
    return least.withColumn("u", F.bitwise_not(F.bitwise_not("u")))
