"""Payloads and headline figures."""

from __future__ import annotations

import json
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, SHOWN_SATELLITES, Settings
from .aggregate import cumulative_long, same_period_stats
from .graph import checkpoint
from .numbering import number_rows


def _number(c: Column) -> Column:
    """A double as JSON text: its shortest digits, plain from 1e-6 up to 1e21, and with a lower-case e beyond; null unless it is finite.
    Spark's own JSON writes 1.0E7 for 10000000.0."""
    plain = lambda kind: F.regexp_replace(c.try_cast(kind).cast("string"), r"(\.\d+?)0+$", "$1")
    size, text = F.abs(c), c.cast("string")
    short = F.replace(F.replace(text, F.lit(".0E"), F.lit("E")), F.lit("E"), F.lit("e"))
    told = F.when((size == 0) | ((size >= 1e-3) & (size < 1e7)), text).when((size >= 1e7) & (size < 1e21), plain("decimal(38,10)")).when((size >= 1e-6) & (size < 1e-3), plain("decimal(38,24)")).otherwise(short)
    return F.when(F.isnan(c) | (size == float("inf")), None).otherwise(told)


def _json(c: Column, kind: T.DataType) -> Column:
    """JSON text of a value: null for null and for doubles that are no finite numbers, ISO text for dates, in arrays and structs too."""
    if isinstance(kind, T.StructType):
        inside = [F.concat(F.lit(json.dumps(f.name, ensure_ascii=False) + ":"), _json(c[f.name], f.dataType)) for f in kind]
        text = F.concat(F.lit("{"), F.concat_ws(",", *inside), F.lit("}"))
        return F.when(c.isNull(), "null").otherwise(text)
    if isinstance(kind, T.ArrayType):
        text = F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: _json(x, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, T.FloatType):
        text = _number(c.cast("string").cast("double"))
    elif isinstance(kind, T.DoubleType):
        text = _number(c)
    elif isinstance(kind, T.DateType):
        text = F.concat(F.lit('"'), F.date_format(c, "yyyy-MM-dd"), F.lit('"'))
    elif isinstance(kind, (T.IntegralType, T.BooleanType)):
        text = c.cast("string")
    else:
        text = _bare(F.to_json(F.array(c), {"ignoreNullFields": "false"}))
    return F.coalesce(text, F.lit("null"))


def _bare(text: Column) -> Column:
    """What stands between the brackets of a JSON array."""
    return F.substr(text, F.lit(2), F.length(text) - 2)


def _listed(rows: Column, fields: T.StructType, column: str | None = None) -> Column:
    """What stands between the brackets of the JSON array of rows (structs with a field `row` of these fields), or of one column of theirs."""
    one = (lambda r: _json(r["row"], fields)) if column is None else (lambda r: _json(r["row"][column], fields[column].dataType))
    return F.array_join(F.transform(rows, one), ",")


def _sorted_rows(df: DataFrame, order: list[str]) -> DataFrame:
    """One row: all rows in the order of the given columns."""
    return df.agg(F.sort_array(F.collect_list(F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)], F.struct(*df.columns).alias("row")))).alias("rows"))


def columnar(df: DataFrame, order: list[str]) -> DataFrame:
    """One row, one column `payload`: an object of parallel arrays in the order of the given columns. For published tables."""
    arrays = [F.concat(F.lit(f'"{c}":['), _listed(F.col("rows"), df.schema, c), F.lit("]")) for c in df.columns]
    return _sorted_rows(df, order).select(F.concat(F.lit("{"), F.concat_ws(",", *arrays), F.lit("}")).alias("payload"))


def records(df: DataFrame, order: list[str]) -> DataFrame:
    """One row, one column `payload`: an array of objects in the order of the given columns. For published tables."""
    return _sorted_rows(df, order).select(F.concat(F.lit("["), _listed(F.col("rows"), df.schema), F.lit("]")).alias("payload"))


def _runs(df: DataFrame, order: list[str], rows_a_piece: int) -> DataFrame:
    """(run, rows): the rows in order, in runs of at most so many, as sorted arrays of structs (place, row)."""
    placed = number_rows(checkpoint(df), [F.col(c) for c in order], "_place")
    row = F.struct("_place", F.struct(*df.columns).alias("row"))
    return placed.groupBy(F.floor(F.col("_place") / rows_a_piece).alias("run")).agg(F.sort_array(F.collect_list(row)).alias("rows"))


def columnar_pieces(df: DataFrame, order: list[str], *, rows_a_piece: int = 20_000) -> DataFrame:
    """The payload of `columnar` in pieces (at, place, payload), for tables of any size: no row holds more than rows_a_piece values.
    The order should be total."""
    runs = _runs(df, order, rows_a_piece)
    out = None
    for i, c in enumerate(df.columns):
        values = _listed(F.col("rows"), df.schema, c)
        part = runs.select(F.lit(2 * i + 1).alias("at"), F.col("run").alias("place"), F.concat(F.when(F.col("run") > 0, ",").otherwise(""), values).alias("payload"))
        out = part if out is None else out.unionByName(part)
    marks = [(2 * i, ("{" if not i else "],") + f'"{c}":[') for i, c in enumerate(df.columns)] + [(2 * len(df.columns), "]}" if df.columns else "{}")]
    return out.unionByName(df.sparkSession.createDataFrame([(at, 0, text) for at, text in marks], "at int, place bigint, payload string"))


def record_pieces(df: DataFrame, order: list[str], *, rows_a_piece: int = 20_000) -> DataFrame:
    """The payload of `records` in pieces (at, place, payload), for tables of any size. The order should be total."""
    objects = _listed(F.col("rows"), df.schema)
    parts = _runs(df, order, rows_a_piece).select(F.lit(1).alias("at"), F.col("run").alias("place"), F.concat(F.when(F.col("run") > 0, ",").otherwise(""), objects).alias("payload"))
    return parts.unionByName(df.sparkSession.createDataFrame([(0, 0, "["), (2, 0, "]")], "at int, place bigint, payload string"))


def latest_by_product(raw: DataFrame) -> DataFrame:
    """(sat, sp_max_date, nrt_max_date) of the satellites that are shown."""
    when = lambda p: F.max(F.when(F.col("product") == p, F.col("acq_date")))
    return raw.where(F.col("sat").isin(*SHOWN_SATELLITES)).groupBy("sat").agg(when("SP").alias("sp_max_date"), when("NRT").alias("nrt_max_date"))


def headline(daily: DataFrame, end: date) -> DataFrame:
    """One row of figures over the last 7 and 30 days. events_last7 is a sum of active events by day."""
    since = lambda n: F.col("date") > end - timedelta(days=n)
    total = lambda c, n: F.coalesce(F.sum(F.when(since(n), F.col(c))), F.lit(0)).cast("bigint")
    return daily.agg(
        total("active_events", 7).alias("events_last7"),
        total("new_events", 7).alias("new_events_last7"),
        total("detections", 7).alias("detections_last7"),
        total("new_events", 30).alias("new_events_last30"),
        total("detections", 30).alias("detections_last30"),
        F.max_by("active_events_7d", "date").alias("avg7_active_events"),
    )


def top_events(events: DataFrame, n: int = 15) -> DataFrame:
    return events.orderBy(F.desc("n_detections"), F.desc("sum_frp"), "event_id").limit(n)


def recent_detections(det: DataFrame, end: date, days: int = DEFAULT.recent_days) -> DataFrame:
    """Detections from `days` before the end on, as the map shows them."""
    place = lambda c, n: (F.rint(F.col(c) * float(10**n)) / float(10**n)).alias(c)
    return det.where(F.col("acq_date") >= end - timedelta(days=days)).select("acq_date", F.col("acq_time").cast("int").alias("acq_time"), place("latitude", 5), place("longitude", 5), place("frp", 1), "confidence", "sat", (F.col("daynight") == "N").cast("int").alias("night"), "event_id")


def overlapping(events: DataFrame, start: date, end: date) -> DataFrame:
    """Events that have a day in common with start to end."""
    return events.where((F.col("end_date") >= start) & (F.col("start_date") <= end))


def cumulative(daily: DataFrame, column: str = "new_events") -> DataFrame:
    """One row, one column `payload`: the days 1 to 366 of a year, and for each year the running totals on them."""
    runs = cumulative_long(daily, column).groupBy(F.col("year").cast("string").alias("year")).agg(F.sort_array(F.collect_list(F.struct("doy", "total"))).alias("run"))
    years = F.map_from_entries(F.sort_array(F.collect_list(F.struct("year", F.transform("run", lambda r: r["total"]).alias("totals")))))
    return runs.agg(F.to_json(F.struct(F.sequence(F.lit(1), F.lit(366)).alias("doy"), years.alias("years"))).alias("payload"))


def one_object(row: DataFrame) -> DataFrame:
    """The JSON object of a table of one row, as column `payload`."""
    return row.select(_json(F.struct("*"), row.schema).alias("payload"))


def document(parts: dict[str, DataFrame]) -> DataFrame:
    """One row, one column `payload`: an object of named parts. A part is one row of JSON, or none at all, which is null."""
    named = None
    for i, (name, part) in enumerate(parts.items()):
        row = part.agg(F.lit(i).alias("i"), F.concat(F.lit(f'"{name}":'), F.coalesce(F.first("payload"), F.lit("null"))).alias("text"))
        named = row if named is None else named.unionByName(row)
    texts = F.transform(F.sort_array(F.collect_list(F.struct("i", "text"))), lambda x: x["text"])
    return named.agg(F.concat(F.lit("{"), F.array_join(texts, ","), F.lit("}")).alias("payload"))


def meta(spark: SparkSession, raw: DataFrame, events: DataFrame, daily: DataFrame, funnel: DataFrame, exclusions: DataFrame, sensitivity: DataFrame, end: date, settings: Settings = DEFAULT) -> DataFrame:
    """One row, one column `payload`: what the published tables rest on, headline figures, the largest events."""
    plain = lambda c: spark.range(1).select(c.alias("payload"))
    text = lambda d: plain(F.lit(f'"{d}"'))
    count = lambda df: df.agg(F.count("*").cast("string").alias("payload"))
    latest = latest_by_product(raw)
    by_sat = lambda c: latest.where(F.col(c).isNotNull()).agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("sat", F.date_format(c, "yyyy-MM-dd").alias("day")))))).alias("payload"))
    shown = F.struct(
        F.array(*[F.lit(c) for c in sorted(settings.confidence_kept)]).alias("confidence_keep"),
        F.lit(settings.land_buffer_m).alias("land_buffer_m"),
        F.lit(settings.eps_m).alias("cluster_eps_m"),
        F.lit(settings.gap_days).alias("cluster_max_gap_days"),
        F.lit(settings.least_calendar_months).alias("persistent_min_cal_months"),
        F.lit(settings.least_year_months).alias("persistent_min_year_months"),
        F.lit(settings.least_radius_m).alias("persistent_exclude_radius_m"),
        F.array(*[F.lit(x) for x in settings.bbox]).alias("bbox"),
    )
    figures = headline(daily, end)
    kpis = {c: figures.select(_json(F.col(c), figures.schema[c].dataType).alias("payload")) for c in figures.columns}
    kpis |= {"ytd": one_object(same_period_stats(daily, end)), "ytd_detections": one_object(same_period_stats(daily, end, "detections"))}
    best = top_events(events)
    place = F.struct((-F.col("n_detections")).alias("n"), (-F.col("sum_frp")).alias("f"), "event_id", F.struct("*").alias("row"))
    top = best.agg(F.concat(F.lit("["), _listed(F.sort_array(F.collect_list(place)), best.schema), F.lit("]")).alias("payload"))
    return document({
        "updated_at": plain(F.date_format(F.current_timestamp(), "'\"'yyyy-MM-dd'T'HH:mm:ssXXX'\"'")),
        "data_start": text(settings.history_start.isoformat()),
        "data_end": text(end.isoformat()),
        "sp_max_date": by_sat("sp_max_date"),
        "nrt_max_date": by_sat("nrt_max_date"),
        "funnel": one_object(funnel),
        "n_events": count(events),
        "n_persistent_sources": count(exclusions),
        "config": plain(F.to_json(shown)),
        "headline": document(kpis),
        "top_events": top,
        "sensitivity": records(sensitivity, ["eps_m", "gap_days", "year"]),
    })


def sensitivity_pivot(counts: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Years by settings, wide: e<eps>_g<gap>; null where a setting has no event in a year."""
    names = [f"e{int(e)}_g{g}" for e in settings.sensitivity_eps_m for g in settings.sensitivity_gap_days]
    named = counts.select("year", F.format_string("e%d_g%d", F.col("eps_m").cast("int"), F.col("gap_days").cast("int")).alias("setting"), "events")
    return named.groupBy("year").pivot("setting", names).agg(F.first("events"))


def newest_days(daily: DataFrame, start: date, end: date, n: int = 400) -> DataFrame:
    """The newest n days of a period, newest first, as the page's table shows them."""
    shown = daily.where(F.col("date").between(start, end)).orderBy(F.desc("date")).limit(n)
    return shown.select("date", "active_events", "new_events", "detections", "detections_snpp", "detections_noaa20", "detections_noaa21", (F.rint(F.col("active_events_7d") * 10.0) / 10.0).alias("mean_7d"), F.when(F.col("product_status") == "", "\u2014").otherwise(F.col("product_status")).alias("data"))


def marker_radius(n: Column, most: int = 200) -> Column:
    """How large an event of n detections is drawn."""
    return 4.0 + 10.0 * F.sqrt(F.least(n, F.lit(most)) / float(most))


def percent_of_prior(stats: DataFrame) -> DataFrame:
    """How many percent this year's total lies above the mean of the years before; null without one. Halves go up."""
    return stats.select("ytd", "prior_mean", F.when(F.col("prior_mean") != 0, F.floor((F.col("ytd") / F.col("prior_mean") - 1) * 100 + 0.5)).alias("percent"))


def last_days(daily: DataFrame, days: int, end: date) -> DataFrame:
    """The last days of the series up to the end, as a chart first shows them."""
    return daily.where(F.col("date").between(end - timedelta(days=days - 1), end))


def chosen_period(choice: str, end: date) -> tuple[date, date]:
    """First and last day of what a reader chose: a year by its four digits, or a number of days up to the end."""
    return (date(int(choice), 1, 1), date(int(choice), 12, 31)) if len(choice) == 4 else (end - timedelta(days=int(choice) - 1), end)


def detections_in(recent: DataFrame, start: date, end: date) -> DataFrame:
    """Of the detections on the map (see recent_detections), those of a period."""
    return recent.where(F.col("acq_date").between(start, end))


def thousands(n: Column) -> Column:
    """A whole number with commas between thousands."""
    return F.format_number(n, 0)
