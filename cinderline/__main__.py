"""The jobs from a command line: python -m cinderline JOB --store FOLDER --out FOLDER [...]

Spark takes its settings from spark-submit or the defaults of the installation.
"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from .config import DEFAULT, SOURCES
from .functions.grid import to_grid
from .operators.geo import edges
from .plans import jobs
from .sources import area_api, store

# fixed values: addresses of the public API
API = "https://firms.modaps.eosdis.nasa.gov"
AREA, OFFERED, STATUS = "/api/area/csv/{key}/{source}/{bbox}/{days}/{date}", "/api/data_availability/csv/{key}/ALL", "/mapserver/mapkey_status/?MAP_KEY={key}"


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="cinderline", description="Fetch detections, derive tables, publish and check them.")
    p.add_argument("job", choices=["backfill", "update", "import", "compact", "derive-sources", "sensitivity", "build", "check"])
    p.add_argument("--store", required=True, help="folder of raw rows and of the log of fetched windows")
    p.add_argument("--out", help="folder of published tables")
    p.add_argument("--land", help="GeoJSON of the land polygon")
    p.add_argument("--derived", help="GeoJSON of derived persistent sources")
    p.add_argument("--manual", help="CSV of sites to exclude besides: lat, lon, radius_m, name")
    p.add_argument("--places", help="CSV of known places: name, lat, lon, and for check whether they are industrial")
    p.add_argument("--episodes", help="CSV of known episodes: name, lat, lon, first, last")
    p.add_argument("--days", default="", help="days to show, with commas")
    p.add_argument("--sources", default=",".join(SOURCES))
    p.add_argument("--start", type=date.fromisoformat)
    p.add_argument("--end", type=date.fromisoformat)
    p.add_argument("--files", help="raw CSV files to import, of the one source that is named")
    p.add_argument("--api", default=API)
    p.add_argument("--key-variable", default="FIRMS_MAP_KEY", help="the environment variable that holds the key of the API")
    p.add_argument("--parallel", default="1", help="requests at the same time; all share one pace")
    args = p.parse_args(argv)
    needs = {"derive-sources": ("out", "land", "places"), "sensitivity": ("out", "land"), "build": ("out", "land"), "check": ("out",), "import": ("files",)}
    if missing := [n for n in needs.get(args.job, ()) if not getattr(args, n)]:
        p.error(f"{args.job} needs --" + ", --".join(missing))
    return args


def key_of(args: argparse.Namespace) -> str:
    key = os.environ.get(args.key_variable, "").strip()
    if not key:
        raise SystemExit(f"set {args.key_variable} to the key of the API")
    return key


def _table(spark: SparkSession, path: str | None, schema: str) -> DataFrame:
    """A CSV file with a header; columns go by name."""
    if not path:
        return spark.createDataFrame([], schema)
    given = spark.read.option("header", True).csv(path)
    wanted = spark.createDataFrame([], schema).schema
    return given.selectExpr(*[f"try_cast(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" if f.name in given.columns else f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in wanted])


def main(argv: list[str] | None = None) -> int:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"cinderline {args.job}").getOrCreate()
    raw, log = f"{args.store}/raw", f"{args.store}/windows"
    exclusions = lambda: store.read_exclusions(spark, args.derived, args.manual)
    sides = lambda: edges(to_grid(store.read_polygon(spark, args.land).selectExpr("ring", "seq", "lat AS latitude", "lon AS longitude")))
    if args.job in ("backfill", "update"):
        key = key_of(args)
        offer = area_api.availability(spark, args.api + OFFERED, key)
        offer = offer.where(offer["source"].isin(*args.sources.split(",")))
        fetch = jobs.api_fetch(spark, args.api + AREA, key, ",".join(map(str, DEFAULT.bbox)), status=args.api + STATUS, parallel=args.parallel)
        added = jobs.backfill(spark, raw, log, offer, fetch, start=args.start, end=args.end) if args.job == "backfill" else jobs.update(spark, raw, log, offer, fetch)
        for source, n in added.items():
            print(f"{source}: {n} rows added")
    elif args.job == "import":
        print(f"{jobs.import_raw(spark, raw, args.sources, args.files)} rows added")
    elif args.job == "compact":
        store.compact(spark, raw)
        print(f"{len(store.vacuum(spark, raw))} folders dropped")
    elif args.job == "derive-sources":
        places = _table(spark, args.places, "ord int, name string, lat double, lon double")
        jobs.derive_sources(spark, raw, args.out, sides(), places).show(40, truncate=False)
    elif args.job == "sensitivity":
        jobs.sensitivity(spark, raw, args.out, sides(), exclusions()).show(100)
    elif args.job == "build":
        tables = jobs.build(spark, raw, log, args.out, sides(), exclusions())
        tables["daily"].orderBy("date", ascending=False).limit(10).orderBy("date").show()
    else:
        found = jobs.check(spark, args.out, exclusions(), _table(spark, args.episodes, jobs.EPISODES), _table(spark, args.places, jobs.PLACES), [date.fromisoformat(d) for d in args.days.split(",") if d])
        lines = found.orderBy("topic", "name").collect()  # a line for each episode, place, day and year
        for r in lines:
            print(f"{r.status} {r.topic} {r.name}: {r.detail}")
        return int(any(r.status == "FAIL" for r in lines))
    return 0


if __name__ == "__main__":
    sys.exit(main())
