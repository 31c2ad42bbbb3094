"""Joins.

No join carries a broadcast hint: Spark broadcasts a side when its estimated or (under
adaptive execution) measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and
falls back to a sort-merge join above it.
"""

from pyspark.sql import DataFrame, functions as F


def left_lookup(many: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """Left outer join of a table whose key may be skewed with a table unique on that key.

    Adaptive execution splits a skewed key only if both sides of the sort-merge join read
    a shuffle directly. A side that was just deduplicated or aggregated by the same key is
    already partitioned and gets no shuffle of its own. Rebuilding the key as an expression
    hides that partitioning; the narrow side is shuffled once more and a key that holds a
    third of ``many`` is spread over many tasks.
    """
    return many.join(_reshuffled(one, key), key, "left")


def inner_lookup(many: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """Inner variant of :func:`left_lookup`."""
    return many.join(_reshuffled(one, key), key)


def _reshuffled(one: DataFrame, key: str) -> DataFrame:
    return one.withColumn(key, F.element_at(F.array(F.col(key)), 1))


def orphan_keys(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Distinct fact keys without a dimension row; a NULL key never matches, so it is one."""
    keys = fact.select(F.col(fact_key).alias("_fact_key")).distinct()
    known = dim.select(F.col(dim_key).alias("_dim_key"))
    return keys.join(known, F.col("_fact_key") == F.col("_dim_key"), "left_anti")
