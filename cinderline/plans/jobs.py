"""Jobs: fetch detections into the store, derive persistent sources, build and publish the tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, SOURCES, Settings
from ..functions.grid import to_grid
from ..operators import aggregate, cluster, filters, geo, ingest, persistent, publish, sanity
from ..operators.graph import checkpoint
from ..sources import area_api, store

# rows of one source, as the API answers them, for windows of (first day, number of days)
Fetch = Callable[[str, list[tuple[date, int]]], DataFrame]
EPISODES = "name string, lat double, lon double, first date, last date"
PLACES = "name string, lat double, lon double, industrial boolean"
SENSITIVITY = "eps_m int, gap_days int, year int, events bigint"


def api_fetch(spark: SparkSession, url: str, key: str, bbox: str, **options: str) -> Fetch:
    """Fetches by the API's data source."""
    spark.dataSource.register(area_api.AreaSource)

    def fetch(source: str, windows: list[tuple[date, int]]) -> DataFrame:
        asked = ",".join(f"{d.isoformat()}:{n}" for d, n in windows)
        return spark.read.format("detections_area").options(url=url, key=key, source=source, bbox=bbox, windows=asked, **options).load()

    return fetch


def _log(spark: SparkSession, log_path: str, source: str, windows: list[tuple[date, date]], rows: DataFrame) -> None:
    """Logs windows with the number of rows of each."""
    held = spark.createDataFrame([(source, a, b) for a, b in windows], "source string, start date, end date")
    by_day = rows.groupBy("acq_date").agg(F.count("*").alias("n"))
    days = held.select("source", "start", "end", F.explode(F.sequence("start", "end")).alias("acq_date"))
    counted = days.join(by_day, "acq_date", "left").groupBy("source", "start", "end").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    store.append_window_log(counted.withColumn("fetched_at", F.current_timestamp()), log_path)


def fetch_range(spark: SparkSession, path: str, log_path: str, source: str, start: date, end: date, fetch: Fetch) -> int:
    """Fetches the windows of start to end that the log does not hold, a year at a time; how many rows were added.

    A year's rows are in the store before its windows are logged: a run that was cut off fetches that year again and adds nothing twice.
    """
    span = spark.createDataFrame([(source, start, end)], "source string, s date, e date")
    windows = ingest.request_windows(span, "s", "e").select("source", "window_start", "window_end")
    due = ingest.not_fetched(windows, store.read_window_log(spark, log_path).where(F.col("source") == source)).orderBy("window_start").collect()
    added = 0
    for year in sorted({w.window_start.year for w in due}):
        part = [(w.window_start, w.window_end) for w in due if w.window_start.year == year]
        rows = checkpoint(ingest.normalise(fetch(source, [(a, (b - a).days + 1) for a, b in part]), source))
        added += store.upsert_raw(spark, path, source, rows)
        _log(spark, log_path, source, part, rows)
    return added


def backfill(spark: SparkSession, path: str, log_path: str, availability: DataFrame, fetch: Fetch, *, start: date | None = None, end: date | None = None) -> dict[str, int]:
    """All history of each source that is on offer; rows added by source."""
    due = {r.source: r for r in ingest.backfill_ranges(availability, start, end).collect()}
    return {s: fetch_range(spark, path, log_path, s, due[s].start, due[s].end, fetch) for s in SOURCES if s in due}


def update(spark: SparkSession, path: str, log_path: str, availability: DataFrame, fetch: Fetch, settings: Settings = DEFAULT) -> dict[str, int]:
    """The days since the last update of authoritative sources, the last days of provisional ones anew; rows added by source."""
    due = {r.source: r for r in ingest.due_ranges(availability, store.read_window_log(spark, log_path), settings.refresh_days).collect()}
    added = {}
    for source in (s for s in SOURCES if s in due):
        first, last = due[source].start, due[source].end
        if not due[source].replace:
            added[source] = fetch_range(spark, path, log_path, source, first, last, fetch)
            continue
        span = spark.createDataFrame([(source, first, last)], "source string, s date, e date")
        windows = [(w.window_start, (w.window_end - w.window_start).days + 1) for w in ingest.request_windows(span, "s", "e", settings.days_per_request).orderBy("window_start").collect()]
        rows = checkpoint(ingest.normalise(fetch(source, windows), source))
        added[source] = store.upsert_raw(spark, path, source, rows, (first, last))
        _log(spark, log_path, source, [(first, last)], rows)
    return added


def _exclusions_on_grid(exclusions: DataFrame) -> DataFrame:
    return to_grid(exclusions.select(F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), "radius_m", "name"))


def _flagged(raw: DataFrame, sides: DataFrame, exclusions: DataFrame, settings: Settings) -> DataFrame:
    return filters.flag_steps(to_grid(raw), sides, _exclusions_on_grid(exclusions), settings)


def _numbered(flagged: DataFrame) -> DataFrame:
    order = [ingest.source_order(F.col("source")), F.asc_nulls_last("acq_time"), F.col("latitude"), F.col("longitude"), F.col("sat")]
    return cluster.ordered(filters.qualifying(flagged), order)


def derive_sources(spark: SparkSession, path: str, folder: str, sides: DataFrame, places: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Persistent sources of all land detections, written for the exclusion list and for review."""
    points = to_grid(ingest.load(store.read_raw(spark, path)))
    land = geo.inside_flag(points, sides, "_land", buffer_m=settings.land_buffer_m).where("_land")
    found = checkpoint(persistent.derive(land, places, settings))
    store.write_sites(found, folder)
    return found


def sensitivity(spark: SparkSession, path: str, out: str, sides: DataFrame, exclusions: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Events by year for all settings, written as a table that `build` publishes; returned wide."""
    raw = ingest.load(store.read_raw(spark, path))
    counts = checkpoint(cluster.sensitivity(_numbered(_flagged(raw, sides, exclusions, settings)), settings).orderBy("eps_m", "gap_days", "year"))
    store.write_table(counts, f"{out}/clustering_sensitivity")
    return publish.sensitivity_pivot(counts, settings).orderBy("year")


def build(spark: SparkSession, path: str, log_path: str, out: str, sides: DataFrame, exclusions: DataFrame, settings: Settings = DEFAULT) -> dict[str, DataFrame]:
    """Loads, filters and clusters the stored detections, writes the five tables and publishes them; the tables by name.

    sides are the edges of the land polygon on the grid (see geo.edges), exclusions as read_exclusions gives them. The tables end with
    the last day that was fetched, or that of the last detection where no window is logged.
    """
    raw = checkpoint(ingest.load(store.read_raw(spark, path)))
    last = store.read_window_log(spark, log_path).agg(F.max("end")).first()[0] or raw.agg(F.max("acq_date")).first()[0]
    if last is None:
        raise ValueError(f"no detections in {path}: run backfill first")
    flagged = checkpoint(_flagged(raw, sides, exclusions, settings))
    det = checkpoint(cluster.assign_events(_numbered(flagged), eps_m=settings.eps_m, gap_days=settings.gap_days))
    events = checkpoint(cluster.summarise_events(det))
    daily = checkpoint(aggregate.daily_table(det, events, settings.history_start, last, window=settings.rolling_days))
    monthly, annual = aggregate.monthly_table(daily, events), aggregate.annual_table(daily, events)
    published = [*[f.name for f in store.RAW], "event_id"]
    tables = {"events": events.orderBy("start_date", "event_id"), "daily": daily.orderBy("date"), "monthly": monthly.orderBy("year", "month"), "annual": annual.orderBy("year")}
    store.write_table(det.select(*published), f"{out}/detections_filtered", compression="gzip")
    for name, table in tables.items():
        store.write_table(table, f"{out}/{name}")
    for name in ("daily", "events"):  # copies to be downloaded from the page
        store.write_csv_file(tables[name], f"{out}/site/{name}.csv")

    light = events.select(F.col("event_id").alias("id"), F.col("start_date").alias("start"), F.col("end_date").alias("end"), F.col("centroid_lat").alias("lat"), F.col("centroid_lon").alias("lon"), F.col("n_detections").alias("n"), F.col("n_days_detected").alias("days"), "max_frp", "sum_frp")
    recent = publish.recent_detections(det, last, settings.recent_days).toDF("date", "time", "lat", "lon", "frp", "conf", "sat", "night", "event")
    counts = store.read_table(spark, f"{out}/clustering_sensitivity", SENSITIVITY)
    payloads = {
        "daily": publish.columnar(daily.withColumnRenamed("date", "dates"), ["dates"]),
        "events_all": publish.columnar_pieces(light, ["start", "id"]),
        "detections_recent": publish.columnar_pieces(recent, ["date", "time", "event", "lat", "lon", "sat"]),
        "annual": publish.records(annual, ["year"]),
        "monthly": publish.records(monthly, ["year", "month"]),
        "cumulative": publish.cumulative(daily),
        "cumulative_detections": publish.cumulative(daily, "detections"),
        "persistent_sources": publish.records(exclusions, ["origin", "name", "lat", "lon"]),
        "meta": publish.meta(spark, raw, events, daily, filters.funnel(flagged), exclusions, counts, last, settings),
    }
    for name, payload in payloads.items():
        store.write_payload(payload, f"{out}/site/{name}.json")
    return {"detections_filtered": det.select(*published), **tables}


def import_raw(spark: SparkSession, path: str, source: str, files: str) -> int:
    """Takes raw rows of an archive of CSV files, plain or gzip, with a header, into the store; rows added. `files` may hold wildcards.
    Rows of any source but the one named are left out; files that do not name theirs are taken to be of it."""
    rows = store.read_raw_csv(spark, files)
    named = rows.where(F.coalesce(F.col("source"), F.lit(source)) == source)
    return store.upsert_raw(spark, path, source, checkpoint(ingest.normalise(named, source)))


def check(spark: SparkSession, out: str, exclusions: DataFrame, episodes: DataFrame, places: DataFrame, days: list[date], months: tuple[int, ...] = (3, 4)) -> DataFrame:
    """(topic, name, status, detail) of checks of the published tables, which are read again: each episode (see EPISODES) has an event,
    industrial places (see PLACES) have an excluded site and others none, what the given days look like, how many events began in
    each year, and how the months of the last year compare with those of earlier ones.

    status: PASS or FAIL for episodes and places, WARN for a season below the mean, INFO for figures.
    """
    events = spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/events")
    daily = spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/daily").withColumn("date", F.to_date("date"))
    said = lambda topic, name, status, text: (F.lit(topic).alias("topic"), name.alias("name"), status.alias("status"), text.alias("detail"))
    passed = F.when(F.col("ok"), "PASS").otherwise("FAIL")
    found = sanity.episode_check(events, episodes)
    parts = [found.select(*said("episode", F.col("name"), passed, F.when(F.col("ok"), F.format_string("%d events, the largest with %d detections, %s to %s, most power %s", "n_events", "n_detections", F.col("start_date").cast("string"), F.col("end_date").cast("string"), F.col("max_frp").cast("string"))).otherwise("no event")))]
    near = sanity.proximity_check(places, exclusions)
    parts.append(near.select(*said("place", F.col("name"), passed, F.coalesce(F.concat(F.col("site"), F.lit(", "), F.col("km").cast("string"), F.lit(" km")), F.lit("no site")))))
    shown = sanity.notable_days(daily, days)
    parts.append(shown.select(*said("day", F.col("date").cast("string"), F.lit("INFO"), F.format_string("%d detections, %d active events, mean of seven days %s", "detections", "active_events", F.col("active_events_7d").cast("string")))))
    parts.append(daily.groupBy(F.year("date").cast("string").alias("year")).agg(F.sum("new_events").alias("n")).select(*said("year", F.col("year"), F.lit("INFO"), F.concat(F.col("n").cast("string"), F.lit(" events began")))))
    last = daily.agg(F.max(F.year("date"))).first()[0]
    season = sanity.season_totals(daily, months, last or 0)
    parts.append(season.select(*said("season", F.lit(str(last)), F.when(F.col("total") < F.col("prior_mean"), "WARN").otherwise("INFO"), F.concat(F.col("total").cast("string"), F.lit(" events began, mean of earlier years "), F.coalesce(F.col("prior_mean").cast("string"), F.lit("unknown"))))))
    everything = parts[0]
    for p in parts[1:]:
        everything = everything.unionByName(p)
    return everything
