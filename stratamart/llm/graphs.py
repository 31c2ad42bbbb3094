"""Connected components by alternating stars, with the edges rewritten in every round."""

from itertools import count

from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import Steps
from stratamart.sources.layers import scratch_directory


def stored(df: DataFrame) -> DataFrame:
    """The rows written to the cluster's shared folder and read again: lineage ends here."""
    path = scratch_directory(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))


def _hangs_directly(edges: DataFrame) -> bool:
    """Whether every ``a`` has one ``b``, below which nothing hangs that has a ``b`` itself."""
    up = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    down = edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    ends = up.unionByName(down).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.filter("up > 1 OR up + down > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``a, b`` edges.

    Each round hangs the larger neighbours of every node, then its smaller ones, below its
    least neighbour, until every node hangs directly below the least of its component.
    The number of rounds grows with the logarithm of the longest path. A node with very many
    neighbours costs one row per neighbour; minima are combined on the map side. A round's
    table is removed when the next one is written.
    """
    steps = Steps(edges.sparkSession)
    both = edges.select("a", "b").filter("a <> b")
    current = steps.store("0", both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for number in count(1):
        if _hangs_directly(current):
            break
        around = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            around.join(_least(around), "a")
            .filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .distinct()
        )
        below = _least(large)
        small = large.join(below, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        small = small.unionByName(below.select("a", F.col("least").alias("b")))
        current = steps.store(str(number), small.filter("a <> b").distinct())
        steps.drop(str(number - 1))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
