"""Raw detections: normalisation, authoritative product, duplicates, upsert, request windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, SATELLITES, SOURCES
from ..schema import DEDUP_KEY, RAW


def whole_number(c: Column) -> Column:
    """An integer, or null where the text is none; '0124' is 124 and '2.0' is 2."""
    return c.cast("string").try_cast("double").try_cast("int")


def literal_map(items: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in items.items() for x in pair])


def satellite_name(code: Column) -> Column:
    """The satellite of a code; an unknown code stays as it is."""
    return F.coalesce(F.try_element_at(literal_map(SATELLITES), code), code)


def confidence_letter(c: Column) -> Column:
    """The first letter, lower case. Null stays null, and so fails the confidence filter."""
    return F.lower(F.substring(c, 1, 1))


def normalise(df: DataFrame, source: str) -> DataFrame:
    """Rows of one source in the raw schema: columns that are missing are null, texts that are no numbers too."""
    if source not in SOURCES:
        raise KeyError(source)
    have = set(df.columns)
    given = {f.name: F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType) for f in RAW}
    for name in ("acq_time", "type"):
        if name in have:
            given[name] = whole_number(F.col(name))
    given |= {"source": F.lit(source), "product": F.lit(SOURCES[source]), "sat": satellite_name(F.col("satellite").cast("string")), "confidence": confidence_letter(F.col("confidence"))}
    return df.select(*[given[f.name].alias(f.name) for f in RAW])


def source_order(source: Column) -> Column:
    """The place of a source in the order that decides between duplicates; unknown ones come last."""
    return F.coalesce(F.try_element_at(literal_map({s: i for i, s in enumerate(SOURCES)}), source), F.lit(len(SOURCES)))


def authoritative(df: DataFrame) -> DataFrame:
    """Without provisional rows of a satellite and day for which the authoritative product has rows."""
    settled = df.where("product = 'SP'").select("sat", "acq_date").distinct().withColumn("_settled", F.lit(True))
    # one join, and no union, so that rows which lie by satellite and day stay where they are
    return df.join(settled, ["sat", "acq_date"], "left").where("product = 'SP' or _settled is null").select(*df.columns)


def keep_first(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the order."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def load(raw: DataFrame, *more: Column) -> DataFrame:
    """Raw rows of all sources as they are analysed: authoritative, each detection once. `more` orders rows that are alike otherwise."""
    order = [source_order(F.col("source")), F.year("acq_date"), "acq_date", F.asc_nulls_last("acq_time"), "latitude", "longitude", "frp", *more]
    return keep_first(authoritative(raw), DEDUP_KEY, order)


def upsert(existing: DataFrame, new: DataFrame, replace: tuple[date, date] | None = None) -> DataFrame:
    """Existing rows, without those on the days to be replaced, and new rows whose key is not among them."""
    if replace:
        existing = existing.where(~F.coalesce(F.col("acq_date").between(*replace), F.lit(False)))
    both = existing.withColumn("_load", F.lit(0)).unionByName(new.withColumn("_load", F.lit(1)))
    return keep_first(both, DEDUP_KEY, [F.col("_load"), F.asc_nulls_last("frp")]).drop("_load")


def request_windows(df: DataFrame, start: str, end: str, days: int = DEFAULT.days_per_request) -> DataFrame:
    """df with a row for each window of `days` days that tile start to end; the last one may be shorter."""
    spread = F.explode(F.sequence(F.col(start), F.col(end), F.expr(f"INTERVAL {days} DAYS")))
    out = df.where(F.col(start) <= F.col(end)).withColumn("window_start", spread)
    return out.withColumn("window_end", F.least(F.date_add("window_start", days - 1), F.col(end)))


def not_fetched(windows: DataFrame, log: DataFrame) -> DataFrame:
    """Windows that the log does not hold with just this start and end."""
    done = log.select("source", F.col("start").alias("window_start"), F.col("end").alias("window_end"))
    return windows.join(done, ["source", "window_start", "window_end"], "left_anti")


def due_ranges(availability: DataFrame, log: DataFrame, refresh_days: int = DEFAULT.refresh_days) -> DataFrame:
    """(source, start, end, replace) of a daily update: authoritative sources from their last window on, others their last days."""
    last = log.groupBy("source").agg(F.max("end").alias("last"))
    known = availability.where(F.col("source").isin(*SOURCES)).join(last, "source", "left")
    settled = F.try_element_at(literal_map(SOURCES), F.col("source")) == "SP"
    start = F.when(settled, F.coalesce(F.date_add("last", 1), F.col("min_date"))).otherwise(F.greatest("min_date", F.date_sub("max_date", refresh_days - 1)))
    return known.select("source", start.alias("start"), F.col("max_date").alias("end"), (~settled).alias("replace")).where("start <= end")


def backfill_ranges(availability: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """(source, start, end) of a full history, within given limits; sources that are not known are left out."""
    first = F.greatest("min_date", F.lit(start)) if start else F.col("min_date")
    last = F.least("max_date", F.lit(end)) if end else F.col("max_date")
    return availability.where(F.col("source").isin(*SOURCES)).select("source", first.alias("start"), last.alias("end")).where("start <= end")


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RAW)
