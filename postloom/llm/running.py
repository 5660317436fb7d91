"""Running totals inside groups of any size, in a given order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def running_totals(
    df: DataFrame, group: str, order: Sequence[str], amount: Column, name: str, total: str | None = None, about: DataFrame | None = None
) -> DataFrame:
    """The rows with `name`: the sum of `amount` over the rows of the group that come before in this order, and with the sum
    of the whole group in `total`, if a name is given. `about` has further columns of each group.

    Rows are split by ranges of (group, order), so a large group lies in many partitions; a part of a group is summed by
    itself and shifted by the sums of the parts before, of which a group has at most as many as there are partitions. The group is never null.
    Rows that are equal in group and order stay together: combine them first where there may be many.
    """
    keys = [group, *order]
    ranged = cut(df.repartitionByRange(*keys).withColumns({"_part": F.spark_partition_id(), "_amount": amount}))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy(group, "_part").agg(F.sum("_amount").alias("_sum")).select(
        group, "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_shift"),
        *([F.sum("_sum").over(Window.partitionBy(group)).alias(total)] if total else []))
    if about is not None:  # joined to the parts, so that a large group is not brought together for it
        parts = parts.join(about, group)
    inside = Window.partitionBy(group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn("_before", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
    return summed.join(parts, [group, "_part"]).withColumn(name, F.col("_before") + F.col("_shift")).drop(
        "_part", "_amount", "_before", "_shift")
