"""Daily, monthly, annual, cumulative and same-period tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, SHOWN_SATELLITES
from ..functions.numbers import scaled_round, sum_rounded, units


def spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Every day from start to end."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date"))


def rolling_mean(c: str, days: int) -> Column:
    """Mean of a day and those before it, of a gap-free series; the first days have fewer. Ordered in one task: a row a day."""
    return scaled_round(F.avg(c).over(Window.orderBy("date").rowsBetween(-(days - 1), 0)), 2)


def product_status() -> Column:
    n, sp, nrt = F.count("*"), F.count_if(F.col("product") == "SP"), F.count_if(F.col("product") == "NRT")
    return F.when(sp == n, "SP").when(nrt == n, "NRT").otherwise("mixed")


def daily_table(det: DataFrame, events: DataFrame, start: date, end: date, *, window: int = DEFAULT.rolling_days, frp_places: int = 2) -> DataFrame:
    """One row for each day, days without detections included; what lies outside start to end is not counted."""
    by_day = det.groupBy(F.col("acq_date").alias("date")).agg(
        F.count("*").alias("detections"),
        *[F.count_if(F.col("sat") == s).alias(f"detections_{s.lower()}") for s in SHOWN_SATELLITES],
        F.count_distinct("event_id").alias("active_events"),
        sum_rounded(F.col("frp"), frp_places, 1).alias("frp_sum"),
        product_status().alias("product_status"),
    )
    started = events.groupBy(F.col("start_date").alias("date")).agg(F.count("*").alias("new_events"))
    out = spine(det.sparkSession, start, end).join(by_day, "date", "left").join(started, "date", "left")
    counts = ["detections", *[f"detections_{s.lower()}" for s in SHOWN_SATELLITES], "active_events", "new_events"]
    out = out.fillna(0, counts).fillna(0.0, ["frp_sum"]).fillna("", ["product_status"])
    out = out.withColumn("active_events_7d", rolling_mean("active_events", window)).withColumn("detections_7d", rolling_mean("detections", window))
    return out.select("date", *counts[:5], "frp_sum", "product_status", "new_events", "active_events_7d", "detections_7d")


def _total(c: str) -> Column:
    """The exact sum of daily values of one decimal."""
    return (F.sum(units(F.col(c), 1)) / 10.0).alias(c)


def monthly_table(daily: DataFrame, events: DataFrame) -> DataFrame:
    """By year and month; the largest event counts for the month it started in, 0 if none did."""
    out = daily.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(F.sum("detections").alias("detections"), F.sum("active_events").alias("event_days"), F.sum("new_events").alias("new_events"), _total("frp_sum"), F.count("*").alias("days"))
    largest = events.groupBy(F.year("start_date").alias("year"), F.month("start_date").alias("month")).agg(F.max("n_detections").alias("largest_event_detections"))
    return out.join(largest, ["year", "month"], "left").fillna(0, ["largest_event_detections"])


def annual_table(daily: DataFrame, events: DataFrame) -> DataFrame:
    """By year, with the first of its days of most active events; every year before the last one counts as complete."""
    out = daily.groupBy(F.year("date").alias("year")).agg(
        F.sum("detections").alias("detections"),
        F.sum("active_events").alias("event_days"),
        F.sum("new_events").alias("new_events"),
        _total("frp_sum"),
        F.count_if(F.col("active_events") > 0).alias("days_with_activity"),
        F.max("active_events").alias("peak_active_events"),
        F.count("*").alias("days"),
        F.max(F.struct(F.col("active_events"), (-F.unix_date("date")).alias("back"), "date"))["date"].alias("peak_day"),
    )
    most = events.groupBy(F.year("start_date").alias("year")).agg(F.max("n_detections").alias("largest_event_detections"), F.max("duration_days").alias("longest_event_days"))
    out = out.join(most, "year", "left").fillna(0, ["largest_event_detections", "longest_event_days"])
    # a row for each year: the window over all of them is small
    return out.withColumn("peak_day", F.date_format("peak_day", "yyyy-MM-dd")).withColumn("complete", F.col("year") < F.max("year").over(Window.partitionBy()))


def cumulative_long(daily: DataFrame, column: str = "new_events") -> DataFrame:
    """(year, doy, total) for days 1 to 366: running totals; gaps keep the value before them, 0 before the first."""
    run = daily.select(F.year("date").alias("year"), F.dayofyear("date").alias("doy"), F.sum(column).over(Window.partitionBy(F.year("date")).orderBy("date")).alias("total"))
    grid = run.select("year").distinct().withColumn("doy", F.explode(F.sequence(F.lit(1), F.lit(366))))
    held = F.last("total", ignorenulls=True).over(Window.partitionBy("year").orderBy("doy"))
    return grid.join(run, ["year", "doy"], "left").select("year", "doy", F.coalesce(held, F.lit(0)).alias("total"))


def cumulative_by_doy(daily: DataFrame, years: list[int], column: str = "new_events") -> DataFrame:
    """Days of the year by years, wide. Years that are given but absent are 0."""
    out = cumulative_long(daily, column).groupBy("doy").pivot("year", years).agg(F.first("total"))
    return out.select("doy", *[F.coalesce(F.col(str(y)), F.lit(0)).cast("bigint").alias(f"y{y}") for y in years])


def same_period_stats(daily: DataFrame, today: date, column: str = "new_events") -> DataFrame:
    """One row: this year's total so far, and the totals of the years before for the same days of the year.

    The first year is left out if the series starts after its fifth day.
    """
    doy = today.timetuple().tm_yday
    first = daily.agg(F.min("date").alias("first")).select((F.year("first") + (F.dayofyear("first") > 5).cast("int")).alias("from_year"))
    years = daily.where(F.dayofyear("date") <= doy).groupBy(F.year("date").alias("year")).agg(F.sum(column).alias("total"))
    ytd = F.coalesce(F.sum(F.when(F.col("year") == today.year, F.col("total"))), F.lit(0))
    prior = F.when((F.col("year") < today.year) & (F.col("year") >= F.col("from_year")), F.struct("year", "total"))
    out = years.join(F.broadcast(first)).agg(ytd.alias("ytd"), F.sort_array(F.collect_list(prior)).alias("prior"))
    some = F.size("prior") > 0
    totals = F.transform("prior", lambda p: p["total"])
    top = F.array_max(F.transform("prior", lambda p: F.struct(p["total"].alias("total"), (-p["year"]).alias("back"))))
    mean = F.aggregate(totals, F.lit(0).cast("bigint"), lambda a, x: a + x) / F.size("prior")
    return out.select(
        F.col("ytd").cast("bigint").alias("ytd"),
        F.when(some, scaled_round(mean, 1)).alias("prior_mean"),
        F.when(some, F.array_max(totals)).cast("bigint").alias("prior_max"),
        F.when(some, -top["back"]).cast("int").alias("prior_max_year"),
        F.transform("prior", lambda p: p["year"]).alias("prior_years"),
        F.when(some, F.size(F.filter(totals, lambda t: t > F.col("ytd"))) + 1).cast("int").alias("rank"),
    )
