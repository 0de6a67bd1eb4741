"""Row numbers in a total order without one task for all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.staging import staged


def numbered(df: DataFrame, order: list[str], key: str) -> DataFrame:
    """Adds `key`: 1, 2, ... by `order`, which must leave no ties. Ranges of the order are numbered side by side, each from
    the count of the rows in the ranges before it; only these counts, one row per range, meet in one task."""
    dealt = staged(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return dealt.join(F.broadcast(base), "_range").withColumn(key, F.col("_base") + own).drop("_range", "_base")
