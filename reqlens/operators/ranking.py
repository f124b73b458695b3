"""Ranks over all rows without a task that sees all rows.

``rank()`` over a window without a partition key sends every row to one task.  Here a value's rank is one more than the
number of rows with better values: rows are counted per distinct value, values fall into buckets by sign, length and leading
bits, so that a better bucket holds better values alone, and a value's count of better rows is the sum of
the better buckets (a table of at most 4,096 rows, whatever the input) plus a running sum within its own.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Leading bits of a value that tell its bucket, besides its length.
BITS = 5


def bucket(value: Column) -> Column:
    """A number that never falls as a long ``value`` grows: at most 64 lengths x 32 leading parts of either sign."""
    size = F.abs(value.cast("decimal(20,0)"))  # the least long has no positive one
    length = F.length(F.bin(F.abs(F.greatest(value, F.lit(-(2**63) + 1)))))
    head = F.floor(size / F.pow(F.lit(2.0), F.greatest(length - BITS, F.lit(0)))).cast("long")
    number = length * F.lit(2**BITS) + head
    return F.when(value < 0, -number).otherwise(number)


def value_ranks(rows: DataFrame, descending: Mapping[str, bool]) -> DataFrame:
    """``column, value, rank`` of each distinct non-NULL value of some long columns of ``rows``.

    ``descending`` names the columns and whether their largest value comes first.  Ties share the least rank, as
    ``rank()`` has it.  All columns are ranked at once, so ``rows`` are computed once.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("value")) for c in descending])
    # a value's complement falls as the value grows, without overflow
    falls = F.col("column").isin([c for c, down in descending.items() if down])
    counts = (
        rows.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_key", F.when(falls, F.bitwise_not("value")).otherwise(F.col("value")))
        .withColumn("_b", bucket(F.col("_key")))
    )
    # one row: an array of the buckets' sizes
    sizes = counts.groupBy("column", "_b").agg(F.sum("_n").alias("_of")).agg(F.collect_list(F.struct("column", "_b", "_of")).alias("_sizes"))
    inside = Window.partitionBy("column", "_b").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    better = F.filter("_sizes", lambda x: (x["column"] == F.col("column")) & (x["_b"] < F.col("_b")))
    return counts.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(F.broadcast(sizes)).select(
        "column", "value", (1 + F.aggregate(better, F.col("_inside"), lambda n, x: n + x["_of"])).cast("int").alias("rank")
    )
