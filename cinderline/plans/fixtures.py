"""Detections, places and polygons over the given tables: integer arithmetic that any SQL engine repeats exactly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.grid import to_grid
from ..operators.geo import edges
from ..operators.ingest import authoritative, confidence_letter, keep_first, satellite_name
from ..schema import DEDUP_KEY

SHORT = """
SELECT event_id AS row_id,
 51e0 + ((user_id*37)%61)*5e-2 + ((event_id*13)%7)*4e-3 AS latitude,
 -5e0 + ((user_id*53)%67)*8e-2 + ((event_id*29)%5)*6e-3 AS longitude,
 CAST(ts AS DATE) AS acq_date,
 CAST(hour(ts)*100 + minute(ts) AS INT) AS acq_time,
 CASE event_id%5 WHEN 0 THEN 'N' WHEN 1 THEN '1' WHEN 2 THEN 'N20' WHEN 3 THEN 'N21' ELSE 'X9' END AS satellite,
 CASE WHEN event_id%97=0 THEN NULL WHEN event_type='view' THEN 'nominal' WHEN event_type='purchase' THEN 'high'
      WHEN event_type='click' THEN 'n' WHEN event_type='error' THEN 'low' ELSE 'H' END AS confidence,
 value AS frp,
 CASE WHEN hour(ts) BETWEEN 7 AND 18 THEN 'D' ELSE 'N' END AS daynight,
 CASE WHEN event_id%7=0 OR CAST(ts AS DATE) > DATE '2024-01-22' THEN 'NRT' ELSE 'SP' END AS product,
 CAST(CASE WHEN event_id%7=0 OR CAST(ts AS DATE) > DATE '2024-01-22' THEN NULL
           WHEN event_id%11=0 THEN 2 WHEN event_id%13=0 THEN 3 ELSE 0 END AS INT) AS type
FROM {events}"""

LONG = """
SELECT o_orderkey AS row_id,
 50e0 + (CAST(floor(o_custkey/10e0) AS BIGINT)%61)*8e-2 + ((o_orderkey*13)%3)*4e-3 AS latitude,
 -6e0 + (CAST(floor(o_custkey/610e0) AS BIGINT)%80)*8e-2 + ((o_orderkey*29)%3)*6e-3 AS longitude,
 CAST(o_orderdate AS DATE) AS acq_date,
 CAST(o_orderkey%2400 AS INT) AS acq_time,
 CASE o_orderstatus WHEN 'F' THEN 'SNPP' WHEN 'O' THEN 'NOAA20' ELSE 'NOAA21' END AS sat,
 CASE WHEN CAST(substring(o_orderpriority,1,1) AS INT) <= 2 THEN 'h' ELSE 'n' END AS confidence,
 o_totalprice/1e3 AS frp,
 CASE WHEN o_orderkey%3=0 THEN 'N' ELSE 'D' END AS daynight,
 'SP' AS product,
 CAST(CASE WHEN o_orderkey%17=0 THEN 2 ELSE 0 END AS INT) AS type
FROM {orders}"""

# rings of (longitude, latitude): a square with a square hole, and a second part
RINGS = {"a": [(-4.0, 51.0), (-1.0, 51.0), (-1.0, 53.5), (-4.0, 53.5)], "b": [(-3.011, 52.007), (-2.411, 52.007), (-2.411, 52.407), (-3.011, 52.407)], "c": [(-0.513, 51.203), (0.207, 51.203), (0.207, 51.603), (-0.513, 51.603)]}
# (name, latitude, longitude, radius in metres)
SITES = [("north works", 53.104, -3.392, 9100), ("mill", 52.551, -1.803, 12300), ("mill yard", 52.552, -1.791, 7700), ("south works", 51.452, -2.205, 14100), ("coast plant", 51.303, -3.551, 8900), ("old kiln", 52.8, -2.6, 23300)]
PLACES = [("harbour", 52.011, -3.013), ("quarry", 52.011, -3.013), ("steel town", 51.452, -2.203), ("north works", 53.101, -3.391), ("airfield", 51.907, -1.407), ("hill farm", 52.705, -2.309)]
EPISODES = [("first week", 52.011, -3.013, "2024-01-02", "2024-01-08"), ("mid month", 51.452, -2.203, "2024-01-14", "2024-01-18"), ("nowhere", 57.33, -4.80, "2024-01-01", "2024-01-30"), ("late", 52.705, -2.309, "2024-01-20", "2024-01-29")]


def sql_values(rows: list[tuple], names: str) -> str:
    """A relation of constants."""
    def text(v) -> str:
        return f"'{v}'" if isinstance(v, str) else f"CAST({v} AS INT)" if isinstance(v, int) and not isinstance(v, bool) else str(v).lower() if isinstance(v, bool) else f"{v!r}e0"

    return f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(text, r)) + ')' for r in rows)}) AS v({names}))"


VERTICES = [(k, i, lat, lon) for k, ring in RINGS.items() for i, (lon, lat) in enumerate(ring)]


def short_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SHORT, events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def short_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = short_raw(spark, sf_dir)
    return raw.withColumn("sat", satellite_name(raw["satellite"])).withColumn("confidence", confidence_letter(raw["confidence"])).drop("satellite")


def short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month of detections, authoritative and without duplicates."""
    rows = authoritative(short_normalised(spark, sf_dir))
    return keep_first(rows, DEDUP_KEY, [rows["product"].desc(), rows["row_id"]])


def long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six and a half years of detections."""
    return spark.sql(LONG, orders=spark.read.parquet(f"{sf_dir}/orders.parquet"))


def sides(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(VERTICES, "ring string, seq int, latitude double, longitude double")
    return edges(to_grid(rows))


def exclusions(spark: SparkSession) -> DataFrame:
    return to_grid(spark.createDataFrame(SITES, "name string, latitude double, longitude double, radius_m int"))


def places(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *p) for i, p in enumerate(PLACES)], "ord int, name string, lat double, lon double")


def episodes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EPISODES, "name string, lat double, lon double, first string, last string").selectExpr("name", "lat", "lon", "CAST(first AS DATE) AS first", "CAST(last AS DATE) AS last")
