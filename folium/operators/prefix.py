"""Running sums and ranks inside groups that may be arbitrarily large.

A window over a hot group would run in one task. Here each group is cut into many ordered buckets: the
sum of every bucket is a small aggregate, a window over those sums gives each bucket its offset, and the
window over rows runs per bucket only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folium.runtime import join_bounded


def running_sum(
    df: DataFrame, groups: list[str], bucket: str, order: list[str | Column], value: str, out: str
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before each row in its group, by (bucket, order).

    ``bucket`` is an integer column that grows with the wanted order; the more values it has, the
    smaller the tasks. Null values count as 0.
    """
    v = F.coalesce(F.col(value), F.lit(0))
    sums = df.groupBy(*groups, bucket).agg(F.sum(v).alias("_sum"))
    over = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*groups, bucket, F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_offset"))
    inner = Window.partitionBy(*groups, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = df.withColumn("_within", F.coalesce(F.sum(v).over(inner), F.lit(0)))
    joined = join_bounded(within, offsets, [*groups, bucket], "left")
    return joined.withColumn(out, F.col("_offset") + F.col("_within")).drop("_offset", "_within")
