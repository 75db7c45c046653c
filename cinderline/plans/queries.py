"""Queries over the given tables, each with the SQL that states its result."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import SATELLITES
from ..functions.grid import grid_sql, to_grid
from ..functions.numbers import scaled_round
from ..operators import aggregate, cluster, filters, geo, ingest, persistent, publish, sanity
from ..operators.graph import checkpoint, shared_folder
from ..sources import store
from . import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

START, END = date(2024, 1, 1), date(2024, 1, 30)
LONG_START, LONG_END = date(1995, 1, 1), date(2001, 8, 1)
YEARS = list(range(1995, 2002))
TODAY = date(2001, 6, 30)


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


# ---- the SQL side: named steps that queries are put together from

_SAT = "CASE satellite " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SATELLITES.items()) + " ELSE satellite END"
_KM = "sqrt(pow(({a} - {c}) * 111.2e0, 2) + pow(({b} - {d}) * 111.2e0 * cos(radians({a})), 2))"
_COUNTS = "detections, detections_snpp, detections_noaa20, detections_noaa21, active_events, frp_sum, product_status, new_events"


def _daily(det: str, events: str, start: date, end: date, places: int) -> str:
    return f"""(SELECT date, {_COUNTS},
 round_even(avg(active_events) OVER w * 100, 0) / 100 AS active_events_7d, round_even(avg(detections) OVER w * 100, 0) / 100 AS detections_7d
 FROM (SELECT s.date, coalesce(n, 0) AS detections, coalesce(n1, 0) AS detections_snpp, coalesce(n2, 0) AS detections_noaa20, coalesce(n3, 0) AS detections_noaa21,
  coalesce(e, 0) AS active_events, coalesce(f, 0e0) AS frp_sum, coalesce(p, '') AS product_status, coalesce(k, 0) AS new_events
  FROM (SELECT CAST(unnest(generate_series(DATE '{start}', DATE '{end}', INTERVAL 1 DAY)) AS DATE) AS date) s
  LEFT JOIN (SELECT acq_date, count(*) n, count(*) FILTER (sat='SNPP') n1, count(*) FILTER (sat='NOAA20') n2, count(*) FILTER (sat='NOAA21') n3, count(DISTINCT event_id) e,
    round_even(CAST(sum(CAST(round_even(frp * 1e{places}, 0) AS BIGINT)) AS DOUBLE) / 1e{places - 1}, 0) / 10e0 f,
    CASE WHEN count(*) FILTER (product='SP') = count(*) THEN 'SP' WHEN count(*) FILTER (product='NRT') = count(*) THEN 'NRT' ELSE 'mixed' END p FROM {det} GROUP BY 1) d ON d.acq_date = s.date
  LEFT JOIN (SELECT start_date, count(*) k FROM {events} GROUP BY 1) x ON x.start_date = s.date)
 WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""


_EVENT_KEY = "CAST(floor(latitude*100e0) AS BIGINT)*1000000000 + CAST(floor((longitude+10e0)*100e0) AS BIGINT)*100000 + CAST(year(acq_date)*12 + month(acq_date) AS BIGINT)"
_SIMPLE_EVENTS = "SELECT event_id, min(acq_date) AS start_date, max(acq_date) AS end_date, count(*) AS n_detections, date_diff('day', min(acq_date), max(acq_date)) + 1 AS duration_days FROM {0} GROUP BY 1"

STEPS = {
    "short": fx.SHORT.format(events="events"),
    "norm": f"SELECT row_id, latitude, longitude, acq_date, acq_time, lower(substring(confidence, 1, 1)) AS confidence, frp, daynight, product, type, {_SAT} AS sat FROM short",
    "loaded": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY sat, acq_date, acq_time, latitude, longitude ORDER BY product DESC, row_id) rn
 FROM norm n WHERE product = 'SP' OR NOT EXISTS (SELECT 1 FROM norm s WHERE s.product = 'SP' AND s.sat = n.sat AND s.acq_date = n.acq_date)) WHERE rn = 1""",
    "points": grid_sql("loaded"),
    "verts": grid_sql(fx.sql_values(fx.VERTICES, "ring, seq, latitude, longitude") + " AS q"),
    "sides": "SELECT a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM verts a JOIN verts b ON a.ring = b.ring AND b.seq = (a.seq + 1) % (SELECT count(*) FROM verts c WHERE c.ring = a.ring)",
    "sites": grid_sql(fx.sql_values(fx.SITES, "name, latitude, longitude, radius_m") + " AS q"),
    "land": """SELECT row_id, sum(CASE WHEN (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) % 2 = 1 AS inside,
 min(sqrt(pow(x - (x1 + t * (x2 - x1)), 2) + pow(y - (y1 + t * (y2 - y1)), 2))) < 750 AS close FROM
 (SELECT row_id, x, y, x1, y1, x2, y2, greatest(0e0, least(1e0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / (pow(x2 - x1, 2) + pow(y2 - y1, 2)))) AS t FROM points, sides) GROUP BY 1""",
    "flags": """SELECT p.*, l.inside OR l.close AS uk_land, type IS NULL OR type NOT IN (1, 2, 3) AS not_static_type, coalesce(confidence IN ('n', 'h'), false) AS confidence_kept,
 NOT EXISTS (SELECT 1 FROM sites s WHERE pow(s.x - p.x, 2) + pow(s.y - p.y, 2) <= pow(CAST(s.radius_m AS DOUBLE), 2)) AS not_persistent FROM points p JOIN land l USING (row_id)""",
    "det": "SELECT *, CAST(row_number() OVER (ORDER BY acq_date, row_id) - 1 AS BIGINT) AS row_no FROM flags WHERE uk_land AND not_static_type AND confidence_kept AND not_persistent",
    "pairs": "SELECT a.row_no AS a, b.row_no AS b, pow(a.x - b.x, 2) + pow(a.y - b.y, 2) AS d2, abs(date_diff('day', a.acq_date, b.acq_date)) AS days FROM det a JOIN det b ON a.row_no < b.row_no AND abs(date_diff('day', a.acq_date, b.acq_date)) <= 2 AND abs(a.x - b.x) <= 1500 AND abs(a.y - b.y) <= 1500 WHERE pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= 2250000",
    "linked": "SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs",
    "reach": "SELECT row_no AS node, row_no AS seen FROM det UNION SELECT r.node, b.b FROM reach r JOIN linked b ON r.seen = b.a",
    "labels": "SELECT node AS row_no, CAST(dense_rank() OVER (ORDER BY c) - 1 AS BIGINT) AS event_id FROM (SELECT node, min(seen) AS c FROM reach GROUP BY 1)",
    "tagged": "SELECT det.*, event_id FROM det JOIN labels USING (row_no)",
    "events_sum": """SELECT event_id, min(acq_date) AS start_date, max(acq_date) AS end_date, count(DISTINCT acq_date) AS n_days_detected, count(*) AS n_detections,
 round_even(CAST(sum(CAST(round_even(latitude * 1e5, 0) AS BIGINT)) AS DOUBLE) / count(*) / 1e5 * 1e5, 0) / 1e5 AS centroid_lat,
 round_even(CAST(sum(CAST(round_even(longitude * 1e5, 0) AS BIGINT)) AS DOUBLE) / count(*) / 1e5 * 1e5, 0) / 1e5 AS centroid_lon,
 min(latitude) AS min_lat, max(latitude) AS max_lat, min(longitude) AS min_lon, max(longitude) AS max_lon, round_even(max(frp) * 100, 0) / 100 AS max_frp,
 round_even(CAST(sum(CAST(round_even(frp * 100, 0) AS BIGINT)) AS DOUBLE) / 1e0, 0) / 1e2 AS sum_frp,
 array_to_string(list_sort(list_distinct(list(sat))), '+') AS satellites, count(*) FILTER (confidence = 'h') AS n_high_conf, count(*) FILTER (daynight = 'N') AS n_night,
 CAST(date_diff('day', min(acq_date), max(acq_date)) + 1 AS INT) AS duration_days FROM tagged GROUP BY 1""",
    "daily": "SELECT * FROM " + _daily("tagged", "events_sum", START, END, 2),
    "olong": fx.LONG.format(orders="orders"),
    "ldet": f"SELECT *, {_EVENT_KEY} AS event_id FROM olong",
    "levents": _SIMPLE_EVENTS.format("ldet"),
    "ldaily": "SELECT * FROM " + _daily("ldet", "levents", LONG_START, LONG_END, 5),
    "lpoints": grid_sql("olong"),
    "cells": """SELECT CAST(floor(x / 1000) AS BIGINT) AS cx, CAST(floor(y / 1000) AS BIGINT) AS cy, count(*) AS n, count(DISTINCT month(acq_date)) AS cal_months, count(DISTINCT year(acq_date) * 100 + month(acq_date)) AS year_months, count(DISTINCT year(acq_date)) AS years,
 round_even(count(*) FILTER (daynight = 'N') / count(*) * 100, 0) / 100 AS night_share, round_even(count(*) FILTER (coalesce(type IN (1, 2, 3), false)) / count(*) * 100, 0) / 100 AS static_type_share,
 CAST(sum(CAST(round_even(latitude * 1e5, 0) AS BIGINT)) AS DOUBLE) / count(*) / 1e5 AS lat, CAST(sum(CAST(round_even(longitude * 1e5, 0) AS BIGINT)) AS DOUBLE) / count(*) / 1e5 AS lon FROM lpoints GROUP BY 1, 2""",
    "pcells": "SELECT *, cx * 4294967296 + cy AS id FROM cells WHERE cal_months >= 8 OR year_months >= 15",
    "creach": "SELECT id AS node, id AS seen FROM pcells UNION SELECT r.node, b.id FROM creach r JOIN pcells a ON a.id = r.seen JOIN pcells b ON abs(a.cx - b.cx) <= 1 AND abs(a.cy - b.cy) <= 1",
    "csites": "SELECT p.*, c.site FROM pcells p JOIN (SELECT node, min(seen) AS site FROM creach GROUP BY 1) c ON c.node = p.id",
    "places": fx.sql_values([(i, *p) for i, p in enumerate(fx.PLACES)], "ord, name, lat, lon"),
    "psites": """SELECT round_even(CAST(sum(CAST(round_even(lat * 1e7, 0) AS BIGINT) * n) AS DOUBLE) / sum(n) / 1e7 * 1e5, 0) / 1e5 AS lat, round_even(CAST(sum(CAST(round_even(lon * 1e7, 0) AS BIGINT) * n) AS DOUBLE) / sum(n) / 1e7 * 1e5, 0) / 1e5 AS lon,
 count(*) AS n_cells, CAST(sum(n) AS BIGINT) AS n, max(cal_months) AS cal_months, max(year_months) AS year_months, max(years) AS years,
 round_even(CAST(sum(CAST(round_even(night_share * 100, 0) AS BIGINT) * n) AS DOUBLE) / sum(n) / 100 * 100, 0) / 100 AS night_share, round_even(CAST(sum(CAST(round_even(static_type_share * 100, 0) AS BIGINT) * n) AS DOUBLE) / sum(n) / 100 * 100, 0) / 100 AS static_type_share,
 CAST(greatest(1000, round_even(sqrt(count(*)) * 750 / 100, 0) * 100) AS INT) AS radius_m FROM csites GROUP BY site""",
    "episodes": "SELECT name, lat, lon, CAST(first AS DATE) AS first, CAST(last AS DATE) AS last FROM " + fx.sql_values(fx.EPISODES, "name, lat, lon, first, last"),
}
CHAIN = list(STEPS)
NEEDS = {
    "short": "", "norm": "short", "loaded": "norm", "points": "loaded", "verts": "", "sides": "verts", "sites": "", "land": "points sides", "flags": "points land sites", "det": "flags", "pairs": "det", "linked": "pairs", "reach": "det linked", "labels": "reach", "tagged": "det labels",
    "events_sum": "tagged", "daily": "tagged events_sum", "olong": "", "ldet": "olong", "levents": "ldet", "ldaily": "ldet levents", "lpoints": "olong", "cells": "lpoints", "pcells": "cells", "creach": "pcells", "csites": "pcells creach", "places": "", "psites": "csites", "episodes": "",
}


def sql(last: str, *steps: str) -> str:
    """A statement with the steps that it needs before it."""
    wanted: set[str] = set()
    todo = list(steps)
    while todo:
        s = todo.pop()
        if s not in wanted:
            wanted.add(s)
            todo += NEEDS[s].split()
    return "WITH RECURSIVE " + ", ".join(f"{s} AS {'' if s in ('reach', 'creach') else 'MATERIALIZED '}({STEPS[s]})" for s in CHAIN if s in wanted) + " " + last


# ---- the Spark side: shared inputs


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.flag_steps(to_grid(fx.short(spark, sf_dir)), fx.sides(spark), fx.exclusions(spark))


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.ordered(filters.qualifying(flagged(spark, sf_dir)), [F.col("row_id")])


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.assign_events(detections(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    det = checkpoint(tagged(spark, sf_dir))
    events = cluster.summarise_events(det)
    return aggregate.daily_table(det, events, START, END), events


def long_daily(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Daily table of the long history; an event is a cell and month there."""
    det = fx.long(spark, sf_dir).withColumn("event_id", F.expr(_EVENT_KEY))
    events = det.groupBy("event_id").agg(F.min("acq_date").alias("start_date"), F.max("acq_date").alias("end_date"), F.count("*").alias("n_detections"))
    events = events.withColumn("duration_days", F.date_diff("end_date", "start_date") + 1)
    return aggregate.daily_table(det, events, LONG_START, LONG_END, frp_places=5), events


# ---- ingestion


@query("WITH s AS (SELECT *, CAST(floor(latitude * 20e0) AS BIGINT) * 100000 + CAST(floor(longitude * 20e0) AS BIGINT) AS event_id FROM (" + sql("SELECT * FROM norm", "norm") + ")), e AS (SELECT event_id, min(acq_date) AS start_date FROM s GROUP BY 1) SELECT * FROM " + _daily("s", "e", START, END, 2))
def daily_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily table of all detections of the month, by a coarse cell as event."""
    det = fx.short_normalised(spark, sf_dir).withColumn("event_id", F.expr("CAST(floor(latitude * 20e0) AS BIGINT) * 100000 + CAST(floor(longitude * 20e0) AS BIGINT)"))
    events = det.groupBy("event_id").agg(F.min("acq_date").alias("start_date"))
    return aggregate.daily_table(det, events, START, END)


@query(sql("SELECT * FROM norm", "norm"))
def normalise_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.short_raw(spark, sf_dir).withColumn("version", F.col("row_id").cast("string"))
    parts = [ingest.normalise(raw.where(F.col("product") == p).drop("product"), source) for p, source in (("SP", "VIIRS_SNPP_SP"), ("NRT", "VIIRS_SNPP_NRT"))]
    out = parts[0].unionByName(parts[1]).withColumn("row_id", F.col("version").cast("bigint"))
    return out.select(*fx.short_normalised(spark, sf_dir).columns)


@query(sql("SELECT * FROM norm n WHERE product = 'SP' OR NOT EXISTS (SELECT 1 FROM norm s WHERE s.product = 'SP' AND s.sat = n.sat AND s.acq_date = n.acq_date)", "norm"))
def sp_over_nrt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.authoritative(fx.short_normalised(spark, sf_dir))


@query(sql("""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY sat, acq_date, acq_time, latitude, longitude ORDER BY product DESC, frp, row_id) rn
 FROM norm n WHERE product = 'SP' OR NOT EXISTS (SELECT 1 FROM norm s WHERE s.product = 'SP' AND s.sat = n.sat AND s.acq_date = n.acq_date)) WHERE rn = 1""", "norm"))
def load_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.short_normalised(spark, sf_dir)
    named = rows.withColumn("source", F.concat(F.lit("VIIRS_SNPP_"), F.col("product")))
    return ingest.load(named, F.col("row_id")).select(*rows.columns)


@query("SELECT l_orderkey, l_suppkey, l_linenumber, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY l_orderkey, l_linenumber) rn FROM lineitem) WHERE rn = 1")
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    first = ingest.keep_first(rows, ["l_suppkey", "l_shipdate"], [F.col("l_orderkey"), F.col("l_linenumber")])
    return first.select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity")


@query(sql("SELECT * EXCLUDE (rn, k) FROM (SELECT *, row_number() OVER (PARTITION BY sat, acq_date, acq_time, latitude, longitude ORDER BY k, frp) rn FROM (SELECT *, 0 AS k FROM norm WHERE acq_date <= DATE '2024-01-25' AND acq_date NOT BETWEEN DATE '2024-01-12' AND DATE '2024-01-20' UNION ALL SELECT *, 1 AS k FROM norm WHERE acq_date >= DATE '2024-01-15')) WHERE rn = 1", "norm"))
def upsert_replace_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.short_normalised(spark, sf_dir)
    return ingest.upsert(rows.where("acq_date <= DATE '2024-01-25'"), rows.where("acq_date >= DATE '2024-01-15'"), (date(2024, 1, 12), date(2024, 1, 20)))


_WINDOWS = "SELECT source, CAST(w AS DATE) AS window_start, CAST(least(CAST(w AS DATE) + 4, e) AS DATE) AS window_end FROM (SELECT o_orderpriority AS source, CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders GROUP BY 1), LATERAL unnest(generate_series(s, e, INTERVAL 5 DAY)) AS u(w)"


@query(f"SELECT source, window_start, window_end FROM ({_WINDOWS}) WHERE NOT (month(window_start) = 3 AND window_end = window_start + 4)")
def fetch_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    ranges = orders.groupBy(F.col("o_orderpriority").alias("source")).agg(F.to_date(F.min("o_orderdate")).alias("s"), F.to_date(F.max("o_orderdate")).alias("e"))
    windows = ingest.request_windows(ranges, "s", "e").select("source", "window_start", "window_end")
    log = windows.where("month(window_start) = 3").select("source", F.col("window_start").alias("start"), F.date_add("window_start", 4).alias("end"))
    return ingest.not_fetched(windows, log)


@query("SELECT source, CAST(s AS DATE) AS start, e AS \"end\", replace FROM (SELECT source, CASE WHEN source LIKE '%SP' THEN last + 1 ELSE greatest(mn, mx - 9) END AS s, mx AS e, source NOT LIKE '%SP' AS replace FROM (SELECT CASE o_orderkey % 5 WHEN 0 THEN 'VIIRS_SNPP_SP' WHEN 1 THEN 'VIIRS_SNPP_NRT' WHEN 2 THEN 'VIIRS_NOAA20_SP' WHEN 3 THEN 'VIIRS_NOAA20_NRT' ELSE 'VIIRS_NOAA21_NRT' END AS source, CAST(min(o_orderdate) AS DATE) AS mn, CAST(max(o_orderdate) AS DATE) AS mx, CAST(max(CASE WHEN year(o_orderdate) < 2001 THEN o_orderdate END) AS DATE) AS last FROM orders GROUP BY 1)) WHERE s <= e")
def update_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    name = F.expr("CASE o_orderkey % 5 WHEN 0 THEN 'VIIRS_SNPP_SP' WHEN 1 THEN 'VIIRS_SNPP_NRT' WHEN 2 THEN 'VIIRS_NOAA20_SP' WHEN 3 THEN 'VIIRS_NOAA20_NRT' ELSE 'VIIRS_NOAA21_NRT' END")
    day = F.to_date("o_orderdate")
    rows = orders.select(name.alias("source"), day.alias("day"))
    available = rows.groupBy("source").agg(F.min("day").alias("min_date"), F.max("day").alias("max_date"))
    log = rows.where("year(day) < 2001").groupBy("source").agg(F.max("day").alias("end"))
    return ingest.due_ranges(available, log)


@query(sql("SELECT sat, max(acq_date) FILTER (product = 'SP') AS sp_max_date, max(acq_date) FILTER (product = 'NRT') AS nrt_max_date FROM norm WHERE sat IN ('SNPP', 'NOAA20', 'NOAA21') GROUP BY 1", "norm"))
def sat_product_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.latest_by_product(fx.short_normalised(spark, sf_dir))


# ---- geometry and filters


@query(sql("SELECT row_id, round_even(x * 1000, 0) / 1000 AS x, round_even(y * 1000, 0) / 1000 AS y FROM lpoints", "lpoints"))
def metric_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_grid(fx.long(spark, sf_dir)).select("row_id", scaled_round(F.col("x"), 3).alias("x"), scaled_round(F.col("y"), 3).alias("y"))


_CELL = "cx, cy, n, cal_months, year_months, years, night_share, static_type_share, round_even(lat * 1e9, 0) / 1e9 AS lat, round_even(lon * 1e9, 0) / 1e9 AS lon"


def _shown_cells(cells: DataFrame) -> DataFrame:
    return cells.withColumn("lat", scaled_round(F.col("lat"), 9)).withColumn("lon", scaled_round(F.col("lon"), 9))


@query(sql(f"SELECT {_CELL} FROM cells", "cells"))
def grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_cells(persistent.cell_stats(to_grid(fx.long(spark, sf_dir))))


@query(sql(f"SELECT {_CELL} FROM pcells", "pcells"))
def persistent_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_cells(persistent.persistent_cells(persistent.cell_stats(to_grid(fx.long(spark, sf_dir)))))


@query(sql(f"SELECT s.*, coalesce((SELECT arg_min(p.name, (d, p.ord)) FROM (SELECT *, {_KM.format(a='s.lat', b='s.lon', c='q.lat', d='q.lon')} AS d FROM places q) p WHERE d < 6), 'unnamed persistent heat source') AS name FROM psites s", "psites", "places"))
def persistent_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return persistent.derive(to_grid(fx.long(spark, sf_dir)), fx.places(spark))


@query(sql("SELECT row_id, inside FROM land", "land"))
def point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.inside_flag(to_grid(fx.short(spark, sf_dir)), fx.sides(spark), "inside").select("row_id", "inside")


@query(sql("SELECT row_id, inside OR close AS inside FROM land", "land"))
def within_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.inside_flag(to_grid(fx.short(spark, sf_dir)), fx.sides(spark), "inside", buffer_m=750.0).select("row_id", "inside")


@query(sql("SELECT row_id, latitude, longitude FROM flags WHERE NOT not_persistent", "flags"))
def near_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.near_flag(to_grid(fx.short(spark, sf_dir)), fx.exclusions(spark), "near").where("near").select("row_id", "latitude", "longitude")


@query(sql("SELECT row_id, latitude, longitude FROM flags WHERE not_persistent", "flags"))
def not_near_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.near_flag(to_grid(fx.short(spark, sf_dir)), fx.exclusions(spark), "near").where("not near").select("row_id", "latitude", "longitude")


_SUPPLIER = "SELECT s_suppkey, 51e0 + (s_suppkey % 41) * 5e-2 AS lat, -4e0 + ((s_suppkey * 7) % 53) * 6e-2 AS lon FROM {supplier}"


@query(sql(f"SELECT s_suppkey, coalesce(name, 'none') AS place, round_even(d * 1e6, 0) / 1e6 AS place_km FROM ({_SUPPLIER.format(supplier='supplier')}) s LEFT JOIN (SELECT s_suppkey, arg_min(name, (d, ord)) AS name, min(d) AS d FROM (SELECT s.s_suppkey, p.name, p.ord, {_KM.format(a='s.lat', b='s.lon', c='p.lat', d='p.lon')} AS d FROM ({_SUPPLIER.format(supplier='supplier')}) s, places p) WHERE d < 40 GROUP BY 1) USING (s_suppkey)", "places"))
def nearest_known_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = spark.sql(_SUPPLIER, supplier=spark.read.parquet(f"{sf_dir}/supplier.parquet"))
    near = geo.nearest_place(points, fx.places(spark), "lat", "lon", within_km=40.0, otherwise="none")
    return near.select("s_suppkey", "place", scaled_round(F.col("place_km"), 6).alias("place_km"))


_FUNNEL = "SELECT count(*) AS bbox, count(*) FILTER (uk_land) AS uk_land, count(*) FILTER (uk_land AND not_static_type) AS not_static_type, count(*) FILTER (uk_land AND not_static_type AND confidence_kept) AS confidence, count(*) FILTER (uk_land AND not_static_type AND confidence_kept AND not_persistent) AS not_persistent FROM flags"


@query(sql(_FUNNEL, "flags"))
def filter_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.funnel(flagged(spark, sf_dir))


@query(sql(f"SELECT step, n, CAST(lag(n) OVER (ORDER BY k) - n AS BIGINT) AS dropped FROM (SELECT unnest(['bbox', 'uk_land', 'not_static_type', 'confidence', 'not_persistent']) AS step, unnest([bbox, uk_land, not_static_type, confidence, not_persistent]) AS n, unnest([0, 1, 2, 3, 4]) AS k FROM ({_FUNNEL}))", "flags"))
def funnel_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = filters.funnel(flagged(spark, sf_dir))
    steps = F.array(*[F.struct(F.lit(c).alias("step"), F.col(c).alias("n")) for c in one.columns])
    return one.select(F.posexplode(steps).alias("k", "s")).select("s.step", "s.n", (F.lag("s.n").over(Window.orderBy("k")) - F.col("s.n")).alias("dropped"))


@query(sql("SELECT row_id, acq_date, sat, confidence, frp FROM det", "det"))
def filtered_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.qualifying(flagged(spark, sf_dir)).select("row_id", "acq_date", "sat", "confidence", "frp")


# ---- events


@query(sql("SELECT a, b, round_even(sqrt(d2) * 1000, 0) / 1000 AS metres, CAST(days AS INT) AS days FROM pairs", "pairs"))
def space_time_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = geo.space_time_pairs(detections(spark, sf_dir), "row_no", eps_m=1500.0, gap_days=2)
    return pairs.select("a", "b", scaled_round(F.sqrt("d2"), 3).alias("metres"), "days")


@query(sql("SELECT row_id, event_id FROM tagged", "tagged"))
def event_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged(spark, sf_dir).select("row_id", "event_id")


@query(sql("SELECT * FROM events_sum", "events_sum"))
def event_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.summarise_events(tagged(spark, sf_dir))


@query(sql("SELECT * FROM daily", "daily"))
def daily_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily(spark, sf_dir)[0]


@query(sql("SELECT * FROM events_sum ORDER BY n_detections DESC, sum_frp DESC, event_id LIMIT 15", "events_sum"))
def top_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.top_events(cluster.summarise_events(tagged(spark, sf_dir)))


@query(sql("SELECT acq_date, acq_time, round_even(latitude * 1e5, 0) / 1e5 AS latitude, round_even(longitude * 1e5, 0) / 1e5 AS longitude, round_even(frp * 10, 0) / 10 AS frp, confidence, sat, CAST(daynight = 'N' AS INT) AS night, event_id FROM tagged WHERE acq_date >= DATE '2024-01-20'", "tagged"))
def recent_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.recent_detections(tagged(spark, sf_dir), END, 10)


@query(sql("SELECT event_id, start_date, end_date, n_detections FROM events_sum WHERE end_date >= DATE '2024-01-10' AND start_date <= DATE '2024-01-14'", "events_sum"))
def map_period_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = cluster.summarise_events(tagged(spark, sf_dir))
    return publish.overlapping(events, date(2024, 1, 10), date(2024, 1, 14)).select("event_id", "start_date", "end_date", "n_detections")


@query(sql("SELECT CAST(coalesce(sum(active_events) FILTER (date > DATE '2024-01-23'), 0) AS BIGINT) AS events_last7, CAST(coalesce(sum(new_events) FILTER (date > DATE '2024-01-23'), 0) AS BIGINT) AS new_events_last7, CAST(coalesce(sum(detections) FILTER (date > DATE '2024-01-23'), 0) AS BIGINT) AS detections_last7, CAST(coalesce(sum(new_events) FILTER (date > DATE '2023-12-31'), 0) AS BIGINT) AS new_events_last30, CAST(coalesce(sum(detections) FILTER (date > DATE '2023-12-31'), 0) AS BIGINT) AS detections_last30, arg_max(active_events_7d, date) AS avg7_active_events FROM daily", "daily"))
def headline_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.headline(daily(spark, sf_dir)[0], END)


@query(sql(f"SELECT p.name, coalesce(n_events, 0) AS n_events, event_id, n_detections, start_date, end_date, duration_days, max_frp, coalesce(n_events, 0) > 0 AS ok FROM episodes p LEFT JOIN (SELECT *, count(*) OVER (PARTITION BY name) AS n_events, row_number() OVER (PARTITION BY name ORDER BY n_detections DESC, event_id) AS rn FROM (SELECT p.name, e.* FROM episodes p JOIN events_sum e ON {_KM.format(a='e.centroid_lat', b='e.centroid_lon', c='p.lat', d='p.lon')} < 8 AND e.end_date >= p.first AND e.start_date <= p.last)) x ON x.name = p.name AND x.rn = 1", "events_sum", "episodes"))
def episode_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanity.episode_check(cluster.summarise_events(tagged(spark, sf_dir)), fx.episodes(spark))


_CUSTOMERS = "SELECT c_custkey AS name, 50e0 + (c_custkey % 67) * 6e-2 AS lat, -5e0 + ((c_custkey * 3) % 71) * 7e-2 AS lon, c_custkey % 2 = 0 AS industrial FROM {customer}"


@query(sql(f"SELECT c.name, c.industrial, x.site, round_even(x.km * 1000, 0) / 1000 AS km, CASE WHEN c.industrial THEN coalesce(x.km, 'inf'::DOUBLE) < 4 ELSE coalesce(x.km, 'inf'::DOUBLE) >= 3 END AS ok FROM ({_CUSTOMERS.format(customer='customer')}) c LEFT JOIN (SELECT name, arg_min(site, (km, site)) AS site, min(km) AS km FROM (SELECT c.name, s.name AS site, {_KM.format(a='s.latitude', b='s.longitude', c='c.lat', d='c.lon')} AS km FROM ({_CUSTOMERS.format(customer='customer')}) c, sites s) WHERE km < 50 GROUP BY 1) x ON x.name = c.name", "sites"))
def proximity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = spark.sql(_CUSTOMERS, customer=spark.read.parquet(f"{sf_dir}/customer.parquet"))
    sites = fx.exclusions(spark).select("name", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    return sanity.proximity_check(places, sites, widest_km=50.0)


_SWEEP = " UNION ALL ".join(f"SELECT {e} AS eps_m, {g} AS gap_days, yr AS year, count(*) AS events FROM (SELECT c, min(CAST(year(acq_date) AS INT)) AS yr FROM (SELECT node, min(seen) AS c FROM r{e}_{g} GROUP BY 1) JOIN det ON det.row_no = node GROUP BY 1) GROUP BY 3" for e in (1000, 1500, 2000) for g in (1, 2, 3))
_WIDE = "wide AS MATERIALIZED (SELECT * FROM (SELECT a.row_no AS a, b.row_no AS b, pow(a.x - b.x, 2) + pow(a.y - b.y, 2) AS d2, abs(date_diff('day', a.acq_date, b.acq_date)) AS days FROM det a JOIN det b ON a.row_no <> b.row_no AND abs(date_diff('day', a.acq_date, b.acq_date)) <= 3 AND abs(a.x - b.x) <= 2000 AND abs(a.y - b.y) <= 2000) WHERE d2 <= 4000000)"
_REACHES = ", ".join(f"r{e}_{g} AS (SELECT row_no AS node, row_no AS seen FROM det UNION SELECT r.node, w.b FROM r{e}_{g} r JOIN wide w ON w.a = r.seen AND w.d2 <= {e * e} AND w.days <= {g})" for e in (1000, 1500, 2000) for g in (1, 2, 3))


@query(sql("", "det").rstrip() + f", {_WIDE}, {_REACHES} {_SWEEP}")
def sensitivity_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.sensitivity(detections(spark, sf_dir))


# ---- long tables


@query(sql("SELECT CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, CAST(sum(detections) AS BIGINT) AS detections, CAST(sum(active_events) AS BIGINT) AS event_days, CAST(sum(new_events) AS BIGINT) AS new_events, CAST(sum(CAST(round_even(frp_sum * 10, 0) AS BIGINT)) AS DOUBLE) / 10 AS frp_sum, count(*) AS days, coalesce(any_value(big), 0) AS largest_event_detections FROM ldaily LEFT JOIN (SELECT year(start_date) AS yy, month(start_date) AS mm, max(n_detections) AS big FROM levents GROUP BY 1, 2) ON yy = year(date) AND mm = month(date) GROUP BY 1, 2", "ldaily"))
def monthly_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.monthly_table(*long_daily(spark, sf_dir))


_ANNUAL = "SELECT a.*, strftime(peak, '%Y-%m-%d') AS peak_day, coalesce(big, 0) AS largest_event_detections, CAST(coalesce(longest, 0) AS INT) AS longest_event_days, year < max(year) OVER () AS complete FROM (SELECT CAST(year(date) AS INT) AS year, CAST(sum(detections) AS BIGINT) AS detections, CAST(sum(active_events) AS BIGINT) AS event_days, CAST(sum(new_events) AS BIGINT) AS new_events, CAST(sum(CAST(round_even(frp_sum * 10, 0) AS BIGINT)) AS DOUBLE) / 10 AS frp_sum, count(*) FILTER (active_events > 0) AS days_with_activity, max(active_events) AS peak_active_events, count(*) AS days FROM ldaily GROUP BY 1) a JOIN (SELECT year(date) AS py, arg_min(date, (-active_events, date)) AS peak FROM ldaily GROUP BY 1) ON py = a.year LEFT JOIN (SELECT year(start_date) AS yy, max(n_detections) AS big, max(duration_days) AS longest FROM levents GROUP BY 1) ON yy = a.year"


@query(sql(_ANNUAL, "ldaily"))
def annual_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.annual_table(*long_daily(spark, sf_dir))


def _cumulative(c: str) -> str:
    cols = ", ".join(f"CAST(coalesce(max(total) FILTER (year = {y} AND doy <= d), 0) AS BIGINT) AS y{y}" for y in YEARS)
    return f"SELECT CAST(d AS INT) AS doy, {cols} FROM generate_series(1, 366) AS g(d), (SELECT year(date) AS year, dayofyear(date) AS doy, sum({c}) OVER (PARTITION BY year(date) ORDER BY date) AS total FROM ldaily) GROUP BY d"


@query(sql(_cumulative("new_events"), "ldaily"))
def cumulative_by_doy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.cumulative_by_doy(long_daily(spark, sf_dir)[0], YEARS)


@query(sql(_cumulative("detections"), "ldaily"))
def cumulative_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.cumulative_by_doy(long_daily(spark, sf_dir)[0], YEARS, "detections")


@query(sql("SELECT CAST(max(t) FILTER (y = 2001) AS BIGINT) AS ytd, round_even(CAST(sum(t) FILTER (y < 2001) AS DOUBLE) / count(*) FILTER (y < 2001) * 10, 0) / 10 AS prior_mean, CAST(max(t) FILTER (y < 2001) AS BIGINT) AS prior_max, CAST(arg_min(y, (-t, y)) FILTER (y < 2001) AS INT) AS prior_max_year, array_to_string(list(y ORDER BY y) FILTER (y < 2001), ',') AS prior_years, CAST(count(*) FILTER (y < 2001 AND t > (SELECT sum(new_events) FROM ldaily WHERE year(date) = 2001 AND dayofyear(date) <= 181)) + 1 AS INT) AS rank FROM (SELECT year(date) AS y, CAST(sum(new_events) AS BIGINT) AS t FROM ldaily WHERE dayofyear(date) <= 181 GROUP BY 1)", "ldaily"))
def same_period_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.same_period_stats(long_daily(spark, sf_dir)[0], TODAY).withColumn("prior_years", F.array_join("prior_years", ","))


@query(sql("SELECT CAST(month(date) AS INT) AS month, " + ", ".join(f"CAST(coalesce(sum(new_events) FILTER (year(date) = {y}), 0) AS BIGINT) AS y{y}" for y in YEARS) + " FROM ldaily GROUP BY 1", "ldaily"))
def heatmap_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = long_daily(spark, sf_dir)[0].select(F.month("date").alias("month"), F.year("date").alias("year"), "new_events")
    wide = rows.groupBy("month").pivot("year", YEARS).agg(F.sum("new_events"))
    return wide.select("month", *[F.coalesce(F.col(str(y)), F.lit(0)).alias(f"y{y}") for y in YEARS])


@query(sql("SELECT year, total, CAST(rank() OVER (ORDER BY total DESC) AS INT) AS place FROM (SELECT CAST(year(date) AS INT) AS year, CAST(sum(detections) AS BIGINT) AS total FROM ldaily WHERE dayofyear(date) <= 181 GROUP BY 1) ORDER BY total DESC, year LIMIT 8", "ldaily"))
def compare_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = long_daily(spark, sf_dir)[0].where(F.dayofyear("date") <= 181).groupBy(F.year("date").alias("year")).agg(F.sum("detections").alias("total"))
    ranked = totals.withColumn("place", F.rank().over(Window.orderBy(F.desc("total"))))
    return ranked.orderBy(F.desc("total"), "year").limit(8)


@query(sql("SELECT date, detections_snpp AS detections, round_even(avg(detections_snpp) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) * 100, 0) / 100 AS mean_7d FROM ldaily", "ldaily"))
def rolling_single_satellite(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = long_daily(spark, sf_dir)[0]
    return rows.select("date", F.col("detections_snpp").alias("detections"), aggregate.rolling_mean("detections_snpp", 7).alias("mean_7d"))


@query(sql("SELECT CAST(coalesce(max(t) FILTER (y = 2001), 0) AS BIGINT) AS total, round_even(CAST(sum(t) FILTER (y < 2001) AS DOUBLE) / count(*) FILTER (y < 2001) * 10, 0) / 10 AS prior_mean, CAST(max(t) FILTER (y < 2001) AS BIGINT) AS prior_max, CAST(arg_min(y, (-t, y)) FILTER (y < 2001) AS INT) AS prior_max_year FROM (SELECT year(date) AS y, CAST(sum(new_events) AS BIGINT) AS t FROM ldaily WHERE month(date) IN (3, 4) GROUP BY 1)", "ldaily"))
def seasonal_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanity.season_totals(long_daily(spark, sf_dir)[0], (3, 4), 2001)


@query(sql("SELECT date, detections, active_events, active_events_7d FROM ldaily WHERE date IN (DATE '1998-07-19', DATE '2000-06-27', DATE '2001-04-05')", "ldaily"))
def notable_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanity.notable_days(long_daily(spark, sf_dir)[0], [date(1998, 7, 19), date(2000, 6, 27), date(2001, 4, 5)])


# ---- payloads and page figures

_DAILY_COLUMNS = ["detections", "detections_snpp", "detections_noaa20", "detections_noaa21", "active_events", "frp_sum", "product_status", "new_events", "active_events_7d", "detections_7d"]
_DAILY_LISTS = ", ".join(f"{c} := list({c} ORDER BY date)" for c in _DAILY_COLUMNS)
_ANNUAL_COLUMNS = "year detections event_days new_events frp_sum days_with_activity peak_active_events days peak_day largest_event_detections longest_event_days complete".split()
_YEAR_LISTS = ", ".join(f"\"{y}\" := list(y{y} ORDER BY doy)" for y in YEARS)


@query(sql(f"SELECT CAST(to_json(struct_pack(date := list(strftime(date, '%Y-%m-%d') ORDER BY date), {_DAILY_LISTS})) AS VARCHAR) AS payload FROM ldaily", "ldaily"))
def payload_columnar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.columnar(long_daily(spark, sf_dir)[0], ["date"])


@query(sql(f"SELECT CAST(to_json(list(struct_pack({', '.join(f'{c} := {c}' for c in _ANNUAL_COLUMNS)}) ORDER BY year)) AS VARCHAR) AS payload FROM ({_ANNUAL})", "ldaily"))
def payload_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.records(aggregate.annual_table(*long_daily(spark, sf_dir)), ["year"])


@query(sql(f"SELECT CAST(to_json(struct_pack(doy := list(doy ORDER BY doy), years := struct_pack({_YEAR_LISTS}))) AS VARCHAR) AS payload FROM ({_cumulative('new_events')})", "ldaily"))
def payload_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.cumulative(long_daily(spark, sf_dir)[0])


@query(sql("", "det").rstrip() + f", {_WIDE}, {_REACHES} SELECT year, " + ", ".join(f"CAST(sum(events) FILTER (eps_m = {e} AND gap_days = {g}) AS BIGINT) AS e{e}_g{g}" for e in (1000, 1500, 2000) for g in (1, 2, 3)) + f" FROM ({_SWEEP}) GROUP BY 1")
def sensitivity_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.sensitivity_pivot(cluster.sensitivity(detections(spark, sf_dir)))


@query(sql("SELECT date, active_events, new_events, detections, detections_snpp, detections_noaa20, detections_noaa21, round_even(active_events_7d * 10, 0) / 10 AS mean_7d, CASE WHEN product_status = '' THEN '\u2014' ELSE product_status END AS data FROM ldaily WHERE date <= DATE '2001-06-30' ORDER BY date DESC LIMIT 400", "ldaily"))
def newest_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.newest_days(long_daily(spark, sf_dir)[0], LONG_START, TODAY)


@query(sql("SELECT count(*) AS events, CAST(coalesce(sum(n_detections), 0) AS BIGINT) AS detections FROM events_sum WHERE end_date >= DATE '2024-01-10' AND start_date <= DATE '2024-01-14'", "events_sum"))
def period_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = publish.overlapping(cluster.summarise_events(tagged(spark, sf_dir)), date(2024, 1, 10), date(2024, 1, 14))
    return shown.agg(F.count("*").alias("events"), F.coalesce(F.sum("n_detections"), F.lit(0)).alias("detections"))


@query(sql("SELECT event_id, round_even((4 + 10 * sqrt(least(n_detections, 200) / 200e0)) * 1e6, 0) / 1e6 AS radius FROM events_sum", "events_sum"))
def event_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.summarise_events(tagged(spark, sf_dir)).select("event_id", scaled_round(publish.marker_radius(F.col("n_detections")), 6).alias("radius"))


@query(sql("SELECT CAST(max(n) AS BIGINT) AS most FROM (SELECT sum(new_events) AS n FROM ldaily GROUP BY year(date), month(date))", "ldaily"))
def heatmap_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_month = long_daily(spark, sf_dir)[0].groupBy(F.year("date"), F.month("date")).agg(F.sum("new_events").alias("n"))
    return by_month.agg(F.max("n").alias("most"))


@query(sql("SELECT ytd, prior_mean, CAST(floor((ytd / prior_mean - 1) * 100 + 0.5) AS BIGINT) AS percent FROM (SELECT CAST(sum(t) FILTER (y = 2001) AS BIGINT) AS ytd, round_even(CAST(sum(t) FILTER (y < 2001) AS DOUBLE) / count(*) FILTER (y < 2001) * 10, 0) / 10 AS prior_mean FROM (SELECT year(date) AS y, sum(new_events) AS t FROM ldaily WHERE dayofyear(date) <= 181 GROUP BY 1))", "ldaily"))
def percent_of_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.percent_of_prior(aggregate.same_period_stats(long_daily(spark, sf_dir)[0], TODAY))


@query(sql("SELECT acq_date, acq_time, round_even(latitude * 1e5, 0) / 1e5 AS latitude, round_even(longitude * 1e5, 0) / 1e5 AS longitude, round_even(frp * 10, 0) / 10 AS frp, confidence, sat, CAST(daynight = 'N' AS INT) AS night, event_id FROM tagged WHERE acq_date BETWEEN DATE '2024-01-25' AND DATE '2024-01-30'", "tagged"))
def period_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections on the map of the last six days."""
    return publish.detections_in(publish.recent_detections(tagged(spark, sf_dir), END, 10), *publish.chosen_period("6", END))


@query(sql("SELECT date, detections, active_events_7d FROM ldaily WHERE date > DATE '2001-06-30' - 365 AND date <= DATE '2001-06-30'", "ldaily"))
def last_year_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series as its chart first shows it."""
    return publish.last_days(long_daily(spark, sf_dir)[0], 365, TODAY).select("date", "detections", "active_events_7d")


@query(sql("SELECT CAST(year(date) AS INT) AS year, format('{:,}', CAST(sum(detections) AS BIGINT)) AS shown FROM ldaily GROUP BY 1", "ldaily"))
def yearly_totals_shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = long_daily(spark, sf_dir)[0].groupBy(F.year("date").alias("year")).agg(F.sum("detections").alias("n"))
    return totals.select("year", publish.thousands(F.col("n")).alias("shown"))


_STORED = "round_even(latitude * 1e6, 0) / 1e6 AS latitude, round_even(longitude * 1e6, 0) / 1e6 AS longitude, acq_date, acq_time, sat, confidence, frp, source"


@query(sql(f"""SELECT {_STORED} FROM (SELECT *, row_number() OVER (PARTITION BY source, sat, acq_date, acq_time, latitude, longitude ORDER BY batch, frp NULLS LAST) AS rn FROM (
 SELECT *, 'VIIRS_SNPP_SP' AS source, 0 AS batch FROM norm WHERE product = 'SP'
 UNION ALL SELECT *, 'VIIRS_SNPP_NRT', 0 FROM norm WHERE acq_date < DATE '2024-01-12' OR acq_date BETWEEN DATE '2024-01-21' AND DATE '2024-01-25'
 UNION ALL SELECT *, 'VIIRS_SNPP_NRT', 1 FROM norm WHERE acq_date >= DATE '2024-01-15')) WHERE rn = 1""", "norm"))
def store_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections through the store: an authoritative source, a provisional one, days of it replaced and later ones added, compaction, and
    the same rows once more, which add nothing."""
    path = f"{shared_folder(spark)}/store-{uuid.uuid4().hex}"
    rows = checkpoint(fx.short_raw(spark, sf_dir).withColumn("version", F.col("row_id").cast("string")))
    given = lambda where, source: checkpoint(ingest.normalise(rows.where(where).drop("product", "row_id"), source))
    sp, nrt = "VIIRS_SNPP_SP", "VIIRS_SNPP_NRT"
    store.upsert_raw(spark, path, sp, given("product = 'SP'", sp))
    store.upsert_raw(spark, path, nrt, given("acq_date <= DATE '2024-01-25'", nrt))
    later = given("acq_date >= DATE '2024-01-15'", nrt)
    store.upsert_raw(spark, path, nrt, later, (date(2024, 1, 12), date(2024, 1, 20)))
    store.compact(spark, path)
    store.upsert_raw(spark, path, nrt, later)
    micro = lambda c: scaled_round(F.col(c), 6).alias(c)
    return store.read_raw(spark, path).select(micro("latitude"), micro("longitude"), "acq_date", "acq_time", "sat", "confidence", "frp", "source")
