"""Persistent heat sources: cells of the archive that are seen all year round, merged into sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..functions.numbers import scaled_round, units
from .geo import cell, nearest_place
from .graph import checkpoint_with, gathered, tiled_components

UNNAMED = "unnamed persistent heat source"


def cell_stats(points: DataFrame, settings: Settings = DEFAULT, *, coordinate_places: int = 5) -> DataFrame:
    """One row for each grid cell (cx, cy) of points (x, y, latitude, longitude, acq_date, daynight, type)."""
    static = F.coalesce(F.col("type").isin(*settings.static_types), F.lit(False))
    mean = lambda c: F.sum(units(F.col(c), coordinate_places)) / F.count(c) / float(10**coordinate_places)
    return points.groupBy(cell(F.col("x"), settings.grid_m).alias("cx"), cell(F.col("y"), settings.grid_m).alias("cy")).agg(
        F.count("*").alias("n"),
        F.count_distinct(F.month("acq_date")).alias("cal_months"),
        F.count_distinct(F.year("acq_date") * 100 + F.month("acq_date")).alias("year_months"),
        F.count_distinct(F.year("acq_date")).alias("years"),
        scaled_round(F.count_if(F.col("daynight") == "N") / F.count("*"), 2).alias("night_share"),
        scaled_round(F.count_if(static) / F.count("*"), 2).alias("static_type_share"),
        mean("latitude").alias("lat"),
        mean("longitude").alias("lon"),
    )


def persistent_cells(cells: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    return cells.where((F.col("cal_months") >= settings.least_calendar_months) | (F.col("year_months") >= settings.least_year_months))


def site_radius(n_cells: Column, settings: Settings = DEFAULT) -> Column:
    return F.greatest(F.lit(settings.least_radius_m), F.rint(F.sqrt(n_cells) * (settings.grid_m * 0.75) / 100.0) * 100.0).cast("int")


def merge_cells(cells: DataFrame, *, tiles: tuple[int, ...] = (64, 1024), at_once: int = 200_000) -> DataFrame:
    """cells with site: cells that touch, at corners too, are one. tiles: sides of the tiles that components are contracted in, where
    there are more than at_once pairs."""
    near = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((1, -1), (1, 0), (1, 1), (0, 1))]))
    keyed, seen = checkpoint_with(cells.withColumn("id", F.col("cx") * (1 << 32) + F.col("cy")), F.count(F.lit(1)).alias("n"))
    keyed = gathered(keyed, seen["n"], 20_000)
    asks = keyed.select(F.col("id").alias("a"), "cx", "cy", near.alias("s")).select("a", F.col("cx").alias("x"), F.col("cy").alias("y"), (F.col("cx") + F.col("s.i")).alias("cx"), (F.col("cy") + F.col("s.j")).alias("cy"))

    def tile(size: int) -> Column:
        own, other = ([F.floor(F.col(c) / size) for c in pair] for pair in (("cx", "cy"), ("x", "y")))
        return F.when(F.array(*own) == F.array(*other), F.xxhash64(*own))

    marks = {f"t{i}": tile(s) for i, s in enumerate(tiles)}
    pairs = asks.join(keyed.select("cx", "cy", F.col("id").alias("b")), ["cx", "cy"]).withColumns(marks).select("a", "b", *marks)
    sites = tiled_components(pairs, [*marks], at_once=at_once).withColumnRenamed("node", "id")
    return keyed.join(sites, "id", "left").withColumn("site", F.coalesce("component", "id")).drop("id", "component")


def sites(merged: DataFrame, places: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """One row for each site, named after the nearest known place. Shares, rounded by cell, are weighted by detections."""
    weighted = lambda c, n: scaled_round(F.sum(units(F.col(c), n) * F.col("n")) / F.sum("n") / float(10**n), min(n, 5))
    out = merged.groupBy("site").agg(
        weighted("lat", 7).alias("lat"),
        weighted("lon", 7).alias("lon"),
        F.count("*").alias("n_cells"),
        F.sum("n").alias("n"),
        F.max("cal_months").alias("cal_months"),
        F.max("year_months").alias("year_months"),
        F.max("years").alias("years"),
        weighted("night_share", 2).alias("night_share"),
        weighted("static_type_share", 2).alias("static_type_share"),
    )
    out = out.withColumn("radius_m", site_radius(F.col("n_cells"), settings))
    return nearest_place(out, places, "lat", "lon", within_km=6.0, otherwise=UNNAMED).withColumnRenamed("place", "name").drop("site", "place_km")


def derive(points: DataFrame, places: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Sites of land detections, most detections first. All columns are there when nothing is persistent, too."""
    merged = merge_cells(persistent_cells(cell_stats(points, settings), settings))
    return sites(merged, places, settings).orderBy(F.desc("n"), "lat", "lon")
