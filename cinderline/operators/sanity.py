"""Checks of published tables against known episodes and places."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .geo import around_cell, grid_cell, nearest_place, planar_km


def episode_check(events: DataFrame, episodes: DataFrame, *, within_km: float = 8.0) -> DataFrame:
    """For each episode (name, lat, lon, first, last) how many events lie near it in that time, and the largest of them.

    Episodes come first in the join: one without an event has 0 and nulls. Distance is planar about the event.
    """
    laid = around_cell(episodes, "lat", "lon", within_km, ("_band", "_column"))
    band, column = grid_cell(F.col("centroid_lat"), F.col("centroid_lon"), within_km)
    near = laid.join(events.withColumn("_band", band).withColumn("_column", column), ["_band", "_column"])
    near = near.where((planar_km(F.col("centroid_lat"), F.col("centroid_lon"), F.col("lat"), F.col("lon")) < within_km) & (F.col("end_date") >= F.col("first")) & (F.col("start_date") <= F.col("last")))
    largest = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("n_detections"), "event_id"))
    counted = near.withColumn("n_events", F.count("*").over(Window.partitionBy("name"))).withColumn("_place", largest).where("_place = 1")
    out = episodes.join(counted.select("name", "n_events", "event_id", "n_detections", "start_date", "end_date", "duration_days", "max_frp"), "name", "left")
    return out.select("name", F.coalesce("n_events", F.lit(0)).cast("bigint").alias("n_events"), "event_id", "n_detections", "start_date", "end_date", "duration_days", "max_frp", (F.coalesce("n_events", F.lit(0)) > 0).alias("ok"))


def proximity_check(places: DataFrame, sites: DataFrame, *, must_km: float = 4.0, must_not_km: float = 3.0, widest_km: float | None = None) -> DataFrame:
    """For each place (name, lat, lon, industrial) the nearest site (name, lat, lon), within widest_km where that is given, and whether
    that is as it should be: an industrial place has one less than must_km away, another place none less than must_not_km away."""
    held = sites.select(F.col("name").alias("ord"), "name", "lat", "lon")  # of sites at one distance, the first by name
    near = nearest_place(places, held, "lat", "lon", within_km=widest_km, otherwise=None, about_place=True)
    d = F.coalesce("place_km", F.lit(float("inf")))
    return near.select("name", "industrial", F.col("place").alias("site"), (F.rint(F.col("place_km") * 1000.0) / 1000.0).alias("km"), F.when(F.col("industrial"), d < must_km).otherwise(d >= must_not_km).alias("ok"))


def season_totals(daily: DataFrame, months: tuple[int, ...], year: int, column: str = "new_events") -> DataFrame:
    """One row: the total of the months in `year`, and mean, maximum and its year over the years before."""
    years = daily.where(F.month("date").isin(*months)).groupBy(F.year("date").alias("year")).agg(F.sum(column).alias("total"))
    prior = F.when(F.col("year") < year, F.col("total"))
    top = F.max(F.when(F.col("year") < year, F.struct("total", (-F.col("year")).alias("back"))))
    return years.agg(F.coalesce(F.sum(F.when(F.col("year") == year, F.col("total"))), F.lit(0)).cast("bigint").alias("total"), (F.rint(F.sum(prior) / F.count(prior) * 10.0) / 10.0).alias("prior_mean"), F.max(prior).cast("bigint").alias("prior_max"), (-top["back"]).cast("int").alias("prior_max_year"))


def notable_days(daily: DataFrame, days: list[date]) -> DataFrame:
    return daily.where(F.col("date").isin(*days)).select("date", "detections", "active_events", "active_events_7d")
