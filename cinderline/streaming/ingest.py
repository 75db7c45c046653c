"""Continuous ingestion: files of raw detections, each detection once, into the store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schema import DEDUP_KEY, RAW
from ..sources.store import upsert_raw


def arrivals(spark: SparkSession, path: str, *, late: str = "10 days") -> DataFrame:
    """Rows of new CSV files in a folder; a detection that comes again within `late` of its time is left out."""
    raw = spark.readStream.schema(RAW).option("header", True).csv(path)
    minutes = F.coalesce(F.floor(F.col("acq_time") / 100) * 60 + F.col("acq_time") % 100, F.lit(0))
    timed = raw.withColumn("acq_ts", F.timestamp_seconds(F.unix_date("acq_date").cast("bigint") * 86400 + minutes * 60))
    return timed.withWatermark("acq_ts", late).dropDuplicatesWithinWatermark(DEDUP_KEY)


def into_store(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Merges each batch into the store; a batch that runs again changes nothing."""

    def merge(batch: DataFrame, _: int) -> None:
        for source in [r[0] for r in batch.select("source").distinct().collect() if r[0] is not None]:
            upsert_raw(batch.sparkSession, path, source, batch.where(F.col("source") == source).drop("acq_ts"))

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily_counts(rows: DataFrame) -> DataFrame:
    """Detections by day and satellite, as a day is over."""
    return rows.groupBy(F.window("acq_ts", "1 day").alias("day"), "sat").agg(F.count("*").alias("detections")).select(F.to_date("day.start").alias("date"), "sat", "detections")
