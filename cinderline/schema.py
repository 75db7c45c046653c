"""Schemas of stored relations."""

from pyspark.sql import types as T

RAW = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("bright_ti4", T.DoubleType()),
    T.StructField("scan", T.DoubleType()),
    T.StructField("track", T.DoubleType()),
    T.StructField("acq_date", T.DateType()),
    T.StructField("acq_time", T.IntegerType()),
    T.StructField("satellite", T.StringType()),
    T.StructField("instrument", T.StringType()),
    T.StructField("confidence", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("bright_ti5", T.DoubleType()),
    T.StructField("frp", T.DoubleType()),
    T.StructField("daynight", T.StringType()),
    T.StructField("type", T.IntegerType()),
    T.StructField("source", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("sat", T.StringType()),
])
WINDOW_LOG = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("start", T.DateType()),
    T.StructField("end", T.DateType()),
    T.StructField("rows", T.LongType()),
    T.StructField("fetched_at", T.TimestampType()),
])
EXCLUSIONS = T.StructType([
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("radius_m", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("origin", T.StringType()),
])
DEDUP_KEY = ["sat", "acq_date", "acq_time", "latitude", "longitude"]
