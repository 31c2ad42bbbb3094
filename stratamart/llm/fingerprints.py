"""Threshold-scaled document fingerprints in DataFrame functions only.

A sketch keeps every shingle hash below a fixed fraction of the hash range, and the smallest
hash besides (so that a short text is not left without one). Its size follows the text, so
a paragraph inside a book can be estimated: sketches of equal threshold merge by union and
give unbiased likeness and containment however unequal the documents are.

Defined cases: a null text is empty; an empty text has an empty sketch, and two empty
sketches are alike (1.0). Fewer than five words make one shingle. Null ids come before all
others; rows that share an id are ordered by text (null first). Long texts are taken whole.
Only id and text are read, so other columns cannot clash; an empty table gives no rows.
"""

import math

from pyspark.sql import DataFrame, Window, functions as F

from stratamart.llm.common import let, partitions_for, words_of

SHINGLE = 5
FRACTION = 1 / 4
#: Buckets of neighbouring ids per shuffle partition.
BUCKETS_PER_PARTITION = 4


def shingle_hashes(words, size: int = SHINGLE):
    """64-bit hashes of all runs of ``size`` words; of all words where there are fewer."""
    return let(
        words,
        lambda w: F.when(
            F.size(w) > size,
            F.transform(
                F.sequence(F.lit(1), F.size(w) - (size - 1)),
                lambda i: F.xxhash64(F.slice(w, i, size)),
            ),
        )
        .when(F.size(w) > 0, F.array(F.xxhash64(w)))
        .otherwise(F.array().cast("array<bigint>")),
    )


def sketch(text, fraction: float = FRACTION):
    """Sorted array column of the retained hashes of a text column."""
    limit = -(1 << 63) + int((1 << 64) * fraction)
    return let(
        shingle_hashes(words_of(text)),
        lambda hashes: F.sort_array(
            F.array_distinct(
                F.concat(
                    F.filter(hashes, lambda h: h < F.lit(limit)),
                    F.filter(F.array(F.array_min(hashes)), lambda h: h >= F.lit(limit)),
                )
            )
        ),
    )


def merge(left, right):
    """The sketch of two documents together."""
    return F.sort_array(F.array_union(left, right))


def likeness(left, right):
    """Estimated Jaccard similarity of two sketch columns."""
    union = F.size(F.array_union(left, right))
    return F.when(union == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(left, right)) / union
    )


def containment(part, whole):
    """Estimated share of ``part``'s shingles that ``whole`` holds."""
    size = F.size(part)
    return F.when(size == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(part, whole)) / size)


def as_text(hashes):
    """A sketch column as hexadecimal text, 16 digits a hash."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def fingerprints(docs: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """``doc_id`` and ``sketch`` for every row."""
    return docs.select("doc_id", sketch(F.col("text"), fraction).alias("sketch"))


def _bucket(ids, bounds: list[int]):
    """How many of the sorted bounds are at most the id, found in two steps."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    below = lambda column, values: F.size(F.filter(values, lambda b: b <= column))
    heads = F.array(*map(F.lit, bounds[::step]))
    jumped = F.greatest(below(ids, heads) - 1, F.lit(0)) * step
    return F.when(ids.isNull(), F.lit(0)).otherwise(
        let(
            jumped,
            lambda j: j + below(ids, F.slice(F.array(*map(F.lit, bounds)), j + 1, step)),
        )
    )


def with_next(docs: DataFrame, columns: dict) -> DataFrame:
    """Each row with the ``columns`` of the row that follows by ascending id, as ``next_*``.

    The last is followed by the first. Rows are dealt to buckets of neighbouring ids, whose
    bounds are quantiles of all ids; the first row of a bucket is copied to the end of the
    bucket before it. So no task sees more than a bucket and nothing is ordered globally.
    """
    buckets = BUCKETS_PER_PARTITION * partitions_for(docs.sparkSession)
    shares = [i / buckets for i in range(1, buckets)]
    found = docs.select(
        F.percentile_approx("doc_id", shares, 100 * buckets).alias("bounds"),
        F.min("doc_id").alias("least"),
        F.count_if(F.col("doc_id").isNull()).alias("nulls"),
    ).first()
    bounds = sorted({b for b in found.bounds or () if b > found.least})
    rows = docs.select("doc_id", *[c.alias(name) for name, c in columns.items()])
    own = rows.withColumns({"bucket": _bucket(F.col("doc_id"), bounds), "copy": F.lit(False)})
    heads = rows.filter(F.col("doc_id").isin(bounds)) if bounds else rows.limit(0)
    heads = heads.withColumn("bucket", _bucket(F.col("doc_id"), bounds) - 1)
    first = F.col("doc_id").isNull() if found.nulls else F.col("doc_id") == F.lit(found.least)
    wrapped = rows.filter(first).withColumn("bucket", F.lit(len(bounds)))
    copies = heads.unionByName(wrapped).withColumn("copy", F.lit(True))
    order = Window.partitionBy("bucket").orderBy("copy", "doc_id", *columns)
    following = {f"next_{name}": F.lead(name).over(order) for name in columns}
    return own.unionByName(copies).withColumns(following).filter(~F.col("copy"))
