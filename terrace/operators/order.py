"""Order as a column, for results that are stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrace.operators.graph import cut


def numbered(df: DataFrame, *order: str, name: str = "at") -> DataFrame:
    """``df`` with the place of each row in an order, from 1. Rows are range-sorted and counted where they are; what goes through one task is a count for each range. Ties are in any order."""
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    rows = cut(df.orderBy(*order).select("*", F.spark_partition_id().alias("__range"), place.alias("__place")))
    counts = rows.groupBy("__range").agg(F.count("*").alias("n"))
    before = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    return rows.join(F.broadcast(starts), "__range").withColumn(name, F.col("__before") + F.col("__place") + 1).drop("__range", "__place", "__before")
