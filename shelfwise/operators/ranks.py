"""Running totals over sorted data without a single-task sort.

A window over a whole group would put that group into one task. Here the data is range-partitioned by (keys, order),
so a large group is cut into value ranges; the totals of the ranges are summed first and each range is then numbered
on its own, starting where the range before it ended.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import materialize


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    amount: str,
) -> DataFrame:
    """Add ``start`` and ``end``: the total of ``amount`` before and up to each row, within ``keys``."""
    keys = list(keys)
    # The range number must be a stored fact: were the ranges drawn again, a row could change its range.
    ranges = materialize(
        df.repartitionByRange(*[F.col(k) for k in keys], *order).withColumn("_range", F.spark_partition_id())
    )
    totals = ranges.groupBy(*keys, "_range").agg(F.sum(amount).alias("_in_range"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "_range", F.coalesce(F.sum("_in_range").over(earlier), F.lit(0)).alias("_before")
    )
    # Without keys there is one row per range, which bounds the broadcast; with keys sizes decide.
    joined = ranges.join(offsets if keys else F.broadcast(offsets), [*keys, "_range"])
    within = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        joined.withColumn("end", F.col("_before") + F.sum(amount).over(within))
        .withColumn("start", F.col("end") - F.col(amount))
        .drop("_range", "_before")
    )
