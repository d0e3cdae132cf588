"""Places of rows in one global order, with no task that holds more than its range of rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import written

RANGE_ROWS = 200_000  # rows that one task sorts, about
_IN_TASK = (1 << 33) - 1  # of monotonically_increasing_id: the row's place in its partition


def positions(rows: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """``rows``, a written table, with each row's place (from 0) in the order.

    Ranges of the order are sorted where they fall; a row's place is its place in the range after the rows of earlier
    ranges. The last of ``order`` must tell all rows apart, or a hot value would be one range.
    """
    spark = rows.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / RANGE_ROWS))
    placed = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    placed = written(placed.withColumn("_place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_place", 33)
    # One row a range: some hundred thousand at thirty billion rows.
    sizes = placed.groupBy(part.alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    joined = placed.withColumn("_range", part).join(F.broadcast(starts), "_range")
    return joined.select(*rows.columns, (F.col("_before") + F.col("_place").bitwiseAND(F.lit(_IN_TASK))).alias(name))
