"""Stored relations: raw detections, the log of fetched windows, exclusion sites, published tables."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.graph import checkpoint
from ..operators.ingest import empty, keep_first, whole_number
from ..schema import DEDUP_KEY, EXCLUSIONS, RAW, WINDOW_LOG


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop))


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw rows of CSV files with a header, gzip or not. Texts that are no numbers are null; no file gives no row."""
    if not _exists(spark, path):
        return empty(spark)
    given = spark.read.option("header", True).csv(path)
    value = lambda f: whole_number(F.col(f.name)) if isinstance(f.dataType, T.IntegerType) else F.col(f.name).try_cast(f.dataType)
    return given.select(*[(value(f) if f.name in given.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in RAW])


# ---- the store of raw rows: folders of rows, and a list of those that hold


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _text(spark: SparkSession, path: str) -> str:
    """A small file."""
    fs, name = _fs(spark, path)
    given = fs.open(name)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(given, "UTF-8")
    finally:
        given.close()


@dataclass(frozen=True)
class Commit:
    """One addition to the store: a folder of rows, and the days of sources whose older rows no longer hold."""

    folder: str  # commit=<number>-<a random name>
    source: str
    years: tuple[int, ...]
    rows: int
    hides: tuple[tuple[str, str, str], ...] = ()  # (source, first day, last day)

    @property
    def number(self) -> int:
        return int(self.folder.split("=")[1].split("-")[0])


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, folder = _fs(spark, f"{path}/versions")
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit()) if fs.exists(folder) else []


def commits(spark: SparkSession, path: str) -> tuple[int, list[Commit]]:
    """(number of the last version, what it holds, oldest first); a store that is not there yet has version 0."""
    known = _versions(spark, path)
    if not known:
        return 0, []
    # a line for each commit since the last compaction
    lines = _text(spark, f"{path}/versions/{known[-1]:010d}").splitlines()
    return known[-1], [Commit(x["folder"], x["source"], tuple(x["years"]), x["rows"], tuple(map(tuple, x["hides"]))) for x in map(json.loads, lines)]


class Conflict(RuntimeError):
    """Another writer has published a version meanwhile."""


def publish(spark: SparkSession, path: str, version: int, held: list[Commit]) -> None:
    """Makes `held` the content of the store, as the version after `version`: readers see all of it from then on, and nothing of it before.
    The file is written under another name first; its new name is given once, so of two writers one fails."""
    text = "".join(json.dumps(asdict(c)) + "\n" for c in held)
    fs, made = _fs(spark, f"{path}/versions/.{uuid.uuid4().hex}")
    final = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/versions/{version + 1:010d}")
    out = fs.create(made, False)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(final) or not fs.rename(made, final):
        fs.delete(made, False)
        raise Conflict(f"version {version + 1} of {path} is there already")


def _hidden(held: list[Commit]) -> Column:
    """A row of an older commit on days that a later one hides."""
    gone = F.lit(False)
    for c in held:
        for source, first, last in c.hides:
            gone = gone | ((F.col("_number") < c.number) & (F.col("source") == source) & F.col("acq_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return gone


def _rows(spark: SparkSession, path: str, held: list[Commit], where: Column | None = None) -> DataFrame:
    """Rows of the raw schema that hold: one scan of the commits' folders, without a shuffle."""
    folders = [f"{path}/rows/{c.folder}" for c in held if c.rows]
    if not folders:
        return spark.createDataFrame([], RAW)
    stored = T.StructType([*RAW.fields, T.StructField("commit", T.StringType()), T.StructField("year", T.IntegerType())])
    rows = spark.read.schema(stored).option("basePath", f"{path}/rows").parquet(*folders)
    if where is not None:
        rows = rows.where(where)
    rows = rows.withColumn("_number", F.split("commit", "-")[0].cast("int"))
    return rows.where(~_hidden(held)).select(*[f.name for f in RAW])


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """What the last version holds. A store that is not there yet is an empty one."""
    return _rows(spark, path, commits(spark, path)[1])


def _write_rows(df: DataFrame, path: str, number: int) -> str:
    """Rows by source and year in a folder of their own; its name. Tasks take ranges of days, so a large year is not one task."""
    folder = f"commit={number}-{uuid.uuid4().hex[:8]}"
    laid = df.withColumn("year", F.year("acq_date")).repartitionByRange("source", "year", "acq_date").sortWithinPartitions("source", "year", "acq_date", "acq_time", "latitude", "longitude")
    laid.write.partitionBy("source", "year").parquet(f"{path}/rows/{folder}")
    return folder


def upsert_raw(spark: SparkSession, path: str, source: str, new: DataFrame, replace: tuple[date, date] | None = None, *, most_commits: int = 40) -> int:
    """Merges rows of one source into the store; how many rows were added.

    Days to be replaced lose their old rows first. Then rows are added whose key is not there yet, once each. Only these rows are
    written: older ones stay where they are, and those that no longer hold are hidden from the version on that this publishes last. A job
    that is lost before that leaves the store as it was. Of two writers at a time one gets a Conflict, and may try again.
    Rows without a day are left out. Beyond most_commits the store is compacted.
    """
    version, held = commits(spark, path)
    new = checkpoint(keep_first(new.where((F.col("source") == source) & F.col("acq_date").isNotNull()).select(*[f.name for f in RAW]), DEDUP_KEY, [F.asc_nulls_last("frp")]))
    years = tuple(sorted(r[0] for r in new.select(F.year("acq_date")).distinct().collect()))
    hides = ((source, replace[0].isoformat(), replace[1].isoformat()),) if replace else ()
    if not years and not hides:
        return 0
    old = _rows(spark, path, held, (F.col("source") == source) & F.col("year").isin(*years)) if years else spark.createDataFrame([], RAW)
    if replace:
        old = old.where(~F.col("acq_date").between(*replace))
    keys = old.select(*[F.col(c).alias(f"_{c}") for c in DEDUP_KEY])
    same = reduce(lambda a, b: a & b, [new[c].eqNullSafe(keys[f"_{c}"]) for c in DEDUP_KEY])
    added = checkpoint(new.join(keys, same, "left_anti"))
    n = added.count()
    if not n and not hides:
        return 0
    folder = _write_rows(added, path, version + 1) if n else f"commit={version + 1}-none"
    publish(spark, path, version, [*held, Commit(folder, source, years, n, hides)])
    if len(held) + 1 > most_commits:
        compact(spark, path)
    return n


def compact(spark: SparkSession, path: str) -> None:
    """Writes the rows that hold into one folder, and publishes it as all there is. Folders of older versions stay for their readers until
    `vacuum`."""
    version, held = commits(spark, path)
    if len(held) < 2:
        return
    folder = _write_rows(_rows(spark, path, held), path, version + 1)
    written = Commit(folder, "", (), 1)
    n = _rows(spark, path, [written]).count()  # from the footers
    years = tuple(sorted({y for c in held for y in c.years}))
    publish(spark, path, version, [Commit(folder, "", years, n)] if n else [])


def write_bucketed(spark: SparkSession, path: str, folder: str, *, buckets: int = 64) -> DataFrame:
    """The rows that hold, laid out by satellite and day in a folder that must be new, as a table that loading does not shuffle. buckets
    should follow the size of the store, some 100 MB to each."""
    name = f"detections_{uuid.uuid4().hex}"
    rows = read_raw(spark, path).repartition(buckets, "sat", "acq_date")
    rows.write.bucketBy(buckets, "sat", "acq_date").sortBy("sat", "acq_date").option("path", folder).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # its files stay
    return read_bucketed(spark, folder, buckets=buckets)


def read_bucketed(spark: SparkSession, folder: str, *, buckets: int = 64) -> DataFrame:
    """What write_bucketed wrote with as many buckets, in this session or another."""
    name = f"detections_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in RAW)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (sat, acq_date) SORTED BY (sat, acq_date) INTO {buckets} BUCKETS LOCATION '{folder}'")
    return spark.table(name)


def vacuum(spark: SparkSession, path: str, *, versions: int = 2) -> list[str]:
    """Drops all but the last versions, and the folders that none of them names; the names of those. Not while a writer is at work,
    whose folder no version names yet."""
    known = _versions(spark, path)
    fs, rows = _fs(spark, f"{path}/rows")
    named = {json.loads(line)["folder"] for v in known[-versions:] for line in _text(spark, f"{path}/versions/{v:010d}").splitlines()}
    for v in known[:-versions]:
        fs.delete(_fs(spark, f"{path}/versions/{v:010d}")[1], False)
    gone = sorted(f.getPath().getName() for f in fs.listStatus(rows) if f.getPath().getName() not in named) if fs.exists(rows) else []
    for name in gone:
        fs.delete(_fs(spark, f"{path}/rows/{name}")[1], True)
    return gone


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet relation; a path that does not exist yet is an empty one."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path)


def read_window_log(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, WINDOW_LOG)


def append_window_log(rows: DataFrame, path: str) -> None:
    """Adds rows to the log; no rows leave it as it is."""
    if rows.isEmpty():
        return
    rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in WINDOW_LOG]).write.mode("append").parquet(path)


def read_exclusions(spark: SparkSession, geojson: str | None, manual_csv: str | None, default_radius_m: int = 1000) -> DataFrame:
    """Derived sites of a GeoJSON file (coordinates are longitude, latitude) and manual ones of a CSV file."""
    out = spark.createDataFrame([], EXCLUSIONS)
    if geojson:
        schema = "features array<struct<geometry:struct<coordinates:array<double>>,properties:struct<radius_m:int,name:string>>>"
        f = spark.read.schema(schema).option("multiLine", True).json(geojson).select(F.explode("features").alias("f"))
        place = F.col("f.geometry.coordinates")
        out = out.unionByName(f.select(place[1].alias("lat"), place[0].alias("lon"), F.coalesce("f.properties.radius_m", F.lit(default_radius_m)).alias("radius_m"), F.coalesce("f.properties.name", F.lit("")).alias("name"), F.lit("derived").alias("origin")))
    if manual_csv:
        m = spark.read.option("header", True).csv(manual_csv)
        radius = F.col("radius_m").try_cast("double").cast("int") if "radius_m" in m.columns else F.lit(None).cast("int")
        out = out.unionByName(m.select(F.col("lat").try_cast("double").alias("lat"), F.col("lon").try_cast("double").alias("lon"), F.coalesce(radius, F.lit(default_radius_m)).alias("radius_m"), "name", F.lit("manual").alias("origin")))
    return out


def read_polygon(spark: SparkSession, geojson: str) -> DataFrame:
    """Vertices (ring, seq, lon, lat) of all rings of the polygons of a GeoJSON file; a ring's closing vertex is left out."""
    schema = "features array<struct<geometry:struct<type:string,coordinates:string>>>"
    f = spark.read.schema(schema).option("multiLine", True).json(geojson).select(F.posexplode("features").alias("feature", "f"))
    many = F.when(F.col("f.geometry.type") == "Polygon", F.array(F.from_json("f.geometry.coordinates", "array<array<array<double>>>"))).otherwise(F.from_json("f.geometry.coordinates", "array<array<array<array<double>>>>"))
    parts = f.select("feature", F.posexplode(many).alias("part", "rings")).select("feature", "part", F.posexplode("rings").alias("hole", "ring"))
    points = parts.select(F.concat_ws("/", "feature", "part", "hole").alias("ring"), F.posexplode("ring").alias("seq", "p"), F.size("ring").alias("n"))
    return points.where("seq < n - 1").select("ring", "seq", F.col("p")[0].alias("lon"), F.col("p")[1].alias("lat"))


def write_sites(sites: DataFrame, folder: str) -> None:
    """Sites for the exclusion list (GeoJSON lines of features) and for review (CSV)."""
    point = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    about = F.struct("name", "radius_m", F.col("n").alias("n_detections"), "n_cells", "cal_months", "year_months", "years", "night_share")
    feature = F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), about.alias("properties"))
    # a published list of sites: one file
    one = sites.agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("back"), "lat", "lon", feature.alias("f")))).alias("all"))
    one.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.transform("all", lambda x: x["f"]).alias("features"))).alias("value")).write.mode("overwrite").text(f"{folder}/persistent_sources")
    sites.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/persistent_sources_review")


def _joined(spark: SparkSession, folder: str, path: str) -> None:
    """One file of the part files of a folder, in their order, in place of the folder. Bytes are copied as a stream; the file has its name
    only when it is whole."""
    fs, parts = _fs(spark, folder)
    names = sorted(f.getPath().toString() for f in fs.listStatus(parts) if f.getPath().getName().startswith("part-") and f.getLen() > 0)
    made, final = (_fs(spark, p)[1] for p in (f"{path}.{uuid.uuid4().hex}", path))
    out = fs.create(made, False)
    for name in names:
        part = fs.open(spark._jvm.org.apache.hadoop.fs.Path(name))
        spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
        part.close()
    out.close()
    fs.delete(final, True)
    if not fs.rename(made, final):
        raise OSError(f"{path} could not be written")
    fs.delete(parts, True)


def write_table(df: DataFrame, path: str, *, compression: str = "none") -> None:
    df.write.mode("overwrite").option("header", True).option("compression", compression).csv(path)


def write_csv_file(df: DataFrame, path: str) -> None:
    """A published table as one CSV file by name, in the order of its rows."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}.parts")
    _joined(df.sparkSession, f"{path}.parts", path)


def write_payload(pieces: DataFrame, path: str) -> None:
    """One JSON file by name, of rows (at, place, payload) that make it up in the order of (at, place), or of one row `payload`."""
    if "at" in pieces.columns:
        pieces = pieces.repartitionByRange("at", "place").sortWithinPartitions("at", "place")
    # pieces have blanks between them, which JSON allows
    pieces.select(F.col("payload").alias("value")).write.mode("overwrite").option("lineSep", " ").text(f"{path}.parts")
    _joined(pieces.sparkSession, f"{path}.parts", path)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A published table read again; one that was not written yet is empty."""
    return spark.read.schema(schema).option("header", True).csv(path) if _exists(spark, path) else spark.createDataFrame([], schema)
