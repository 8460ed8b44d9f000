"""Global order without one task: range-partitioned sort, totals per partition, offsets.

The sorted rows are written once with their partition number, so the totals
and the rows that use them see the same partitions. Only one row per
partition meets in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise


def running_total(df: DataFrame, order: Sequence[Column], weight: str, out: str = "before") -> DataFrame:
    """Add ``out``: the sum of ``weight`` over all rows before this one in ``order``."""
    tagged = materialise(df.orderBy(*order).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row")), "sorted")
    first = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    parts = tagged.groupBy("_part").agg(F.sum(weight).alias("_sum"))
    parts = parts.select("_part", F.coalesce(F.sum("_sum").over(first), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(weight).over(inner), F.lit(0))
    return (tagged.join(parts, "_part").withColumn(out, (F.col("_base") + own).cast("bigint"))
            .drop("_part", "_row", "_base"))


def numbered(df: DataFrame, order: Sequence[Column], out: str, start: int = 0) -> DataFrame:
    """Add ``out``: the row's place in ``order``, from ``start``."""
    one = running_total(df.withColumn("_one", F.lit(1).cast("bigint")), order, "_one", out)
    return one.withColumn(out, F.col(out) + start).drop("_one")


def quantiles(values: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """Exact quantiles (linear interpolation) of a numeric column, one row with an array ``q``.

    Equal values are counted first; the counts are put in order, and only the
    values around each wanted rank are kept.
    """
    x = (values.select(F.col(col).cast("double").alias("v")).filter("v IS NOT NULL")
         .groupBy("v").agg(F.count(F.lit(1)).alias("n")))
    x = running_total(x, [F.col("v").asc()], "n")
    total = x.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()["total"]
    if not total:
        return values.sparkSession.range(1).select(F.lit(None).cast("array<double>").alias("q"))
    ranks = [p * (total - 1) for p in probs]
    want = [(int(h), min(int(h) + 1, total - 1), h - int(h)) for h in ranks]

    def at(rank: int) -> Column:
        return F.max(F.when((F.col("before") <= rank) & (F.col("before") + F.col("n") > rank), F.col("v")))

    return x.agg(F.array(*[at(lo) + (at(hi) - at(lo)) * f for lo, hi, f in want]).alias("q"))
