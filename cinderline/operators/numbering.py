"""Numbers 0, 1, 2, ... in a global order, without sorting in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import checkpoint


def number_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df with the place of each row in the order, which must be total for the numbers to be determined.

    Rows are range-partitioned; each partition is numbered by itself and starts where the counts before it end. Spark reads what it
    partitions by range twice, once for a sample, so rows that cost something to make should be written before.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the number of the partition in the upper bits, the place within it in the lower 33
    laid = checkpoint(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each partition
    starts = laid.groupBy(part).count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_first")
    return laid.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn(name, place).drop("_part", "_first", "_at")


def dense_numbers(df: DataFrame, key: str, name: str, *, stretch: int = 1 << 16) -> DataFrame:
    """df, with distinct integers from 0 on in `key`, with the place of each among them; tasks take stretches of the integers."""
    laid = df.withColumn("_part", F.floor(F.col(key) / stretch))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each stretch
    starts = laid.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("_part").orderBy(key)
    return laid.join(F.broadcast(starts), "_part").withColumn(name, F.row_number().over(inside) - 1 + F.col("_first")).drop("_part", "_first")
