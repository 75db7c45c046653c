"""Events: single linkage of detections in space and time, their labels and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..functions.numbers import mean_rounded, scaled_round, sum_rounded
from .geo import cell_of, linked_cells
from .graph import checkpoint, checkpoint_with, gathered, small, tiled_components
from .numbering import dense_numbers, number_rows

TILES = ["t0", "t1"]


def ordered(points: DataFrame, order: list[Column]) -> DataFrame:
    """points with row_no, their place in (day, input order), and day, the number of the date."""
    # written before they are numbered, since a partitioning by range reads its input twice
    return number_rows(checkpoint(points.withColumn("day", F.unix_date("acq_date"))), [F.col("day"), *order], "row_no")


def assign_events(rows: DataFrame, *, eps_m: float = DEFAULT.eps_m, gap_days: int = DEFAULT.gap_days) -> DataFrame:
    """rows (see ordered) with event_id: 0, 1, ... in the order in which events first appear. A row with a null coordinate or date is
    in no event: its event_id is null."""
    cells, links = linked_cells(rows, "row_no", [(eps_m, gap_days)])
    found = tiled_components(links, TILES)
    placed, seen = checkpoint_with(cells.join(found, "node", "left").select("cx", "cy", "ct", F.coalesce("component", "node").alias("component")), F.count(F.lit(1)).alias("n"))
    labels = dense_numbers(gathered(placed, seen["n"]).select("component").distinct(), "component", "event_id")
    named = placed.join(labels, "component").select("cx", "cy", "ct", "event_id")
    here = {c: at for c, at in zip(("_cx", "_cy", "_ct"), cell_of(eps_m, gap_days), strict=True)}
    return rows.withColumns(here).join(small(named.toDF(*here, "event_id"), seen["n"]), list(here), "left").drop(*here)


def summarise_events(det: DataFrame, *, frp_places: int = 2, coordinate_places: int = 5) -> DataFrame:
    """One row for each event_id. Sums are exact for values of so many decimals."""
    places = lambda c: mean_rounded(F.col(c), coordinate_places, 5)
    out = det.groupBy("event_id").agg(
        F.min("acq_date").alias("start_date"),
        F.max("acq_date").alias("end_date"),
        F.count_distinct("acq_date").alias("n_days_detected"),
        F.count("*").alias("n_detections"),
        places("latitude").alias("centroid_lat"),
        places("longitude").alias("centroid_lon"),
        F.min("latitude").alias("min_lat"),
        F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_lon"),
        F.max("longitude").alias("max_lon"),
        scaled_round(F.max("frp"), 2).alias("max_frp"),
        sum_rounded(F.col("frp"), frp_places, 2).alias("sum_frp"),
        F.array_join(F.sort_array(F.collect_set("sat")), "+").alias("satellites"),
        F.count_if(F.col("confidence") == "h").alias("n_high_conf"),
        F.count_if(F.col("daynight") == "N").alias("n_night"),
    )
    return out.withColumn("duration_days", F.date_diff("end_date", "start_date") + 1)


def lattice(settings: list[tuple[float, int]]) -> list[int | None]:
    """For each setting, in ascending order, the place of the widest earlier one that it contains; None for the first."""
    below = [[k for k in range(i) if settings[k][0] <= e and settings[k][1] <= g] for i, (e, g) in enumerate(settings)]
    return [max(b, key=lambda k: (settings[k][0], settings[k][1]), default=None) for b in below]


def nested_components(rows: DataFrame, settings: list[tuple[float, int]]) -> list[DataFrame]:
    """For each setting (eps_m, gap_days): (node, day, component) of groups of rows that are linked under all of them; node is the least
    row_no of a group and day its first day.

    What a setting links, wider ones link too. So each starts from the components of a narrower one, and only links that are new go
    through the graph, between components and not rows. Where all settings contain the first, the components of that one are the groups
    of all others, and links are laid between them once.
    """
    cells, links = linked_cells(rows, "row_no", settings)
    links = checkpoint(links)  # every setting reads them
    groups = cells.select("node", "day", *TILES)
    tiles = groups.select(F.col("node").alias("component"), *TILES)
    parents = lattice(settings)
    out: list[DataFrame] = []
    for i, narrower in enumerate(parents):
        new = F.col("mask").bitwiseAND(F.lit(1 << i)) != 0
        if narrower is None:
            held, edges = groups.select("node", "day", F.col("node").alias("component"), *TILES), links.where(new)
        else:
            held = out[narrower]
            edges = _between(links.where(new & (F.col("mask").bitwiseAND(F.lit(1 << narrower)) == 0)), held)
        found = tiled_components(edges.select("a", "b", *TILES) if narrower is None else edges.select("a", "b", *TILES).distinct(), TILES)
        onward = found.select(F.col("node").alias("component"), F.col("component").alias("_next"))
        moved = held.drop(*TILES).join(onward, "component", "left").select("node", "day", F.coalesce("_next", "component").alias("component"))
        out.append(checkpoint(moved.join(tiles, "component")))
        if not i and None not in parents[1:]:
            groups = out[0].groupBy(F.col("component").alias("node"), *TILES).agg(F.min("day").alias("day"))
            groups = checkpoint(groups.select("node", "day", F.col("node").alias("component"), *TILES))
            links = checkpoint(_between(links, out[0]).groupBy("a", "b", *TILES).agg(F.bit_or("mask").alias("mask")))
            tiles = groups.select("component", *TILES)
            out[0] = groups
    return out


def _between(links: DataFrame, held: DataFrame) -> DataFrame:
    """links (a, b, mask) between the components of their ends, with the tile that both lie in; those within one are left out. A component
    lies in the tile of its least row."""
    for end in ("a", "b"):
        links = links.join(held.select(F.col("node").alias(end), F.col("component").alias(f"_{end}"), *[F.col(t).alias(f"{t}{end}") for t in TILES]), end)
    return links.where("_a <> _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"), "mask", *[F.when(F.col(f"{t}a") == F.col(f"{t}b"), F.col(f"{t}a")).alias(t) for t in TILES])


def sensitivity(rows: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(eps_m, gap_days, year, events): events by the year of their first detection, for each pair of settings."""
    pairs = [(e, g) for e in sorted(settings.sensitivity_eps_m) for g in sorted(settings.sensitivity_gap_days)]
    out = None
    for (eps, gap), held in zip(pairs, nested_components(rows, pairs), strict=True):
        counted = held.groupBy("component").agg(F.year(F.date_from_unix_date(F.min("day"))).alias("year")).groupBy("year").agg(F.count("*").alias("events"))
        counted = counted.select(F.lit(int(eps)).alias("eps_m"), F.lit(gap).alias("gap_days"), "year", "events")
        out = counted if out is None else out.unionByName(counted)
    return out
