"""Dense positions in a global order without gathering the rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerlens.session import materialized


def numbered(rows: DataFrame, *order: str, name: str = "position") -> DataFrame:
    """``rows`` with their position, from 1, in the order of the given columns (unique together).

    Rows are dealt by range and written; a window numbers each range by itself, and only the ranges' row counts
    (one row each) are summed in order.
    """
    ranges = materialized(rows.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    counts = ranges.groupBy("__range").agg(F.count(F.lit(1)).alias("__rows"))
    before = F.sum("__rows").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__range", F.coalesce(before, F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return ranges.withColumn("__own", own).join(offsets, "__range").select(
        *rows.columns, (F.col("__before") + F.col("__own")).alias(name))
