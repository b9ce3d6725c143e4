"""Places in an order over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daypanel.session import staged


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``place``, from 0 in the given order, which must tell all rows apart.

    The rows are exchanged by ranges of the order and every range is numbered on its own; a table of one row per range
    gives the number of rows before it. The ranges are stored in between: both parts must see the same ones.
    """
    ranges = staged(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    places = ranges.withColumn("_inside", inside).join(counts, "_range")
    return places.withColumn("place", F.col("_before") + F.col("_inside") - 1).drop("_range", "_before", "_inside")
