"""Behaviour of the library's operators on small inputs."""

from __future__ import annotations

import os
import random
import sys
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from cinderline.functions.grid import to_grid
from cinderline.operators import aggregate, cluster, filters, geo, ingest, persistent, sanity
from cinderline.operators.graph import connected_components
from cinderline.sources import area_api, store

LAT, LON = 53.53, -1.98
DET = "latitude double, longitude double, acq_date date, acq_time int, confidence string, frp double, daynight string, type int, product string, sat string, row_id long, x double, y double"


def det(i, dx, dy, day, *, sat="SNPP", conf="n", frp=5.0, time=130, night="N", typ=None, product="SP"):
    return (LAT + dy / 111200, LON + dx / 66000, day, time, conf, frp, night, typ, product, sat, i, float(dx), float(dy))


def frame(spark, rows):
    return spark.createDataFrame([det(i, *r[:3], **(r[3] if len(r) > 3 else {})) for i, r in enumerate(rows)], DET)


def labels(spark, rows, **how):
    out = cluster.assign_events(cluster.ordered(frame(spark, rows), [F.col("row_id")]), **how)
    return {r.row_id: r.event_id for r in out.select("row_id", "event_id").collect()}


D = date(2018, 6, 24)


def day(n):
    return D + timedelta(days=n)


def test_three_night_fire(spark):
    rows = [(x, y, day(n)) for n in range(3) for x, y in ((0, 0), (375, 0), (0, 375))]
    out = cluster.assign_events(cluster.ordered(frame(spark, rows), [F.col("row_id")]))
    e = cluster.summarise_events(out).collect()
    assert len(e) == 1 and (e[0].n_detections, e[0].n_days_detected, e[0].start_date, e[0].end_date, e[0].duration_days) == (9, 3, D, day(2), 3)


def test_linkage(spark):
    assert labels(spark, [(0, 0, D), (400, 0, D), (5000, 0, D), (5400, 0, D)]) == {0: 0, 1: 0, 2: 1, 3: 1}
    assert len(set(labels(spark, [(0, 0, D), (0, 0, day(2))]).values())) == 1
    assert len(set(labels(spark, [(0, 0, D), (0, 0, day(3))]).values())) == 2
    assert len(set(labels(spark, [(0, 0, D), (1200, 0, D), (2400, 0, D)]).values())) == 1
    assert labels(spark, [(0, 0, day(1)), (5000, 0, D), (10000, 0, day(2))]) == {0: 1, 1: 0, 2: 2}
    assert len(set(labels(spark, [(0, 0, D), (1800, 0, D)]).values())) == 2
    assert len(set(labels(spark, [(0, 0, D), (1800, 0, D)], eps_m=2000.0).values())) == 1
    assert labels(spark, []) == {}


def test_components_against_union_find(spark):
    turn = random.Random(3)
    pairs = [(turn.randrange(60), turn.randrange(60)) for _ in range(45)] + [(None, 3), (4, 4)]
    root = list(range(60))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        if a is not None:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    touched = {x for a, b in pairs if a is not None and a != b for x in (a, b)}
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "src long, dst long")).collect()}
    assert got == {i: find(i) for i in touched}


def test_pairs_against_all(spark):
    turn = random.Random(5)
    rows = [(turn.uniform(0, 9000), turn.uniform(0, 9000), day(turn.randrange(6))) for _ in range(120)]
    points = frame(spark, rows).withColumn("day", F.unix_date("acq_date"))
    for gap in (0, 1, 2):
        got = {(r.a, r.b) for r in geo.space_time_pairs(points, "row_id", eps_m=1500.0, gap_days=gap).collect()}
        want = {(i, j) for i, p in enumerate(rows) for j, q in enumerate(rows) if i < j and abs((p[2] - q[2]).days) <= gap and (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= 1500**2}
        assert got == want


def test_daily_table(spark):
    rows = [(0, 0, D), (300, 0, D), (0, 0, day(1)), (8000, 0, day(1), {"sat": "NOAA20"}), (8000, 0, day(3))]
    out = cluster.assign_events(cluster.ordered(frame(spark, rows), [F.col("row_id")]))
    t = {r.date: r for r in aggregate.daily_table(out, cluster.summarise_events(out), day(-2), day(4)).collect()}
    assert len(t) == 7 and t[day(-2)].detections == 0 and t[day(-2)].product_status == ""
    assert (t[D].detections, t[D].active_events, t[D].new_events, t[D].active_events_7d) == (2, 1, 1, 0.33)
    assert (t[day(1)].detections_noaa20, t[day(1)].active_events, t[day(1)].new_events) == (1, 2, 1)
    assert t[day(2)].active_events == 0 and (t[day(3)].active_events, t[day(3)].new_events) == (1, 0)


def test_long_tables(spark):
    rows = [(0, 0, date(2018, 3, 1)), (0, 0, date(2019, 2, 1)), (6000, 0, date(2019, 5, 1))]
    out = cluster.assign_events(cluster.ordered(frame(spark, rows), [F.col("row_id")]))
    events = cluster.summarise_events(out)
    table = aggregate.daily_table(out, events, date(2018, 1, 1), date(2019, 6, 30))
    c = {r.doy: r for r in aggregate.cumulative_by_doy(table, [2018, 2019]).collect()}
    assert (c[60].y2018, c[366].y2018, c[32].y2019, c[121].y2019, c[1].y2019) == (1, 1, 1, 2, 0)
    s = aggregate.same_period_stats(table, date(2019, 6, 30)).first()
    assert (s.ytd, s.prior_mean, s.prior_max, s.prior_max_year, s.prior_years, s["rank"]) == (2, 1.0, 1, 2018, [2018], 1)
    a = {r.year: r for r in aggregate.annual_table(table, events).collect()}
    assert a[2018].complete and not a[2019].complete and a[2019].new_events == 2 and a[2019].peak_day == "2019-02-01"
    m = {(r.year, r.month): r for r in aggregate.monthly_table(table, events).collect()}
    assert m[2019, 5].detections == 1 and m[2019, 6].largest_event_detections == 0


def test_filters(spark):
    side = geo.edges(spark.createDataFrame([("a", 0, -1e5, -1e5), ("a", 1, 1e5, -1e5), ("a", 2, 1e5, 1e5), ("a", 3, -1e5, 1e5), ("b", 0, 2e4, 2e4), ("b", 1, 4e4, 2e4), ("b", 2, 4e4, 4e4), ("b", 3, 2e4, 4e4)], "ring string, seq int, x double, y double"))
    rows = [(0, 0, D, {"conf": c, "typ": t}) for c, t in (("l", None), ("n", None), ("h", None), ("n", 2), ("h", 3), ("h", 0))] + [(30000, 30000, D), (30000, 20500, D), (0, 0, D, {"conf": None})]
    none = spark.createDataFrame([], "x double, y double, radius_m int")
    f = filters.funnel(filters.flag_steps(frame(spark, rows), side, none)).first()
    assert tuple(f) == (9, 8, 6, 4, 4)
    sites = spark.createDataFrame([(0.0, 0.0, 1000), (10.0, 0.0, 1000)], "x double, y double, radius_m int")
    near = geo.near_flag(frame(spark, [(x, 0, D) for x in (0, 900, 1200, 5000)]), sites, "near")
    assert {r.row_id: r.near for r in near.collect()} == {0: True, 1: True, 2: False, 3: False}


def test_grid(spark):
    r = to_grid(spark.createDataFrame([(52.65798, 1.71605)], "latitude double, longitude double")).first()
    assert abs(r.x - 651409.76) < 0.1 and abs(r.y - 313177.42) < 0.1


def test_ingest(spark):
    raw = spark.createDataFrame([("0124", "N21", "nominal", "53.5", "-2", "2024-04-20"), ("x", "2", None, "53.5", "-2", "2024-04-20")], "acq_time string, satellite string, confidence string, latitude string, longitude string, acq_date string")
    a, b = ingest.normalise(raw, "VIIRS_NOAA21_NRT").orderBy(F.asc_nulls_last("acq_time")).collect()
    assert (a.acq_time, a.sat, a.confidence, a.type, a["product"]) == (124, "NOAA21", "n", None, "NRT") and (b.acq_time, b.confidence) == (None, None)
    with pytest.raises(KeyError):
        ingest.normalise(raw, "other")
    span = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 12))], "s date, e date")
    assert [(r.window_end - r.window_start).days + 1 for r in ingest.request_windows(span, "s", "e").orderBy("window_start").collect()] == [5, 5, 2]
    rows = frame(spark, [(0, 0, D), (9, 0, D), (0, 0, D, {"product": "NRT"}), (0, 0, day(1), {"product": "NRT"}), (0, 0, D, {"product": "NRT", "sat": "NOAA20"})])
    assert sorted((r.sat, r["product"], r.acq_date) for r in ingest.authoritative(rows).collect()) == [("NOAA20", "NRT", D), ("SNPP", "NRT", day(1)), ("SNPP", "SP", D), ("SNPP", "SP", D)]


def test_store(spark, tmp_path):
    def raw(*days):
        rows = [(53.0, -2.0, d, 130) for d in days]
        return ingest.normalise(spark.createDataFrame(rows, "latitude double, longitude double, acq_date date, acq_time int").withColumn("satellite", F.lit("N")).withColumn("confidence", F.lit("n")), "VIIRS_SNPP_NRT")

    path = str(tmp_path / "raw")
    assert store.upsert_raw(spark, path, "VIIRS_SNPP_NRT", raw(date(2024, 8, 10), date(2024, 8, 15))) == 2
    store.upsert_raw(spark, path, "VIIRS_SNPP_NRT", raw(date(2024, 8, 15), date(2024, 8, 16)), (date(2024, 8, 12), date(2024, 8, 20)))
    assert [r.acq_date.day for r in store.read_raw(spark, path).orderBy("acq_date").collect()] == [10, 15, 16]
    log = str(tmp_path / "log")
    store.append_window_log(spark.createDataFrame([("a", date(2024, 1, 1), date(2024, 1, 5), 3, None)], "source string, start date, end date, rows long, fetched_at timestamp"), log)
    assert store.read_window_log(spark, log).count() == 1 and store.read_window_log(spark, log + "x").count() == 0


def test_area_api(spark):
    answers, waits = [(503, ""), (0, "lost"), (200, "latitude,longitude,acq_date,frp\n1,2,2024-01-01,\n")], []
    body = area_api.fetch("http://x/KEY1/", "KEY1", get=lambda u: answers.pop(0), sleep=waits.append)
    assert waits == [2, 4] and area_api.parse(body)[0][:6] == ("1", "2", None, None, None, "2024-01-01")
    for answer in ((503, ""), (403, "KEY1 is wrong")):
        with pytest.raises(area_api.ApiError) as e:
            area_api.fetch("http://x/KEY1/", "KEY1", get=lambda u: answer, sleep=lambda s: None)
        assert "KEY1" not in str(e.value)
    with pytest.raises(area_api.ApiError):
        area_api.parse("Invalid")
    told, waits = [(200, '{"current_transactions": 99, "transaction_limit": 100}'), (200, '{"current_transactions": 9, "transaction_limit": 100}')], []
    area_api.hold_back("http://x", get=lambda u: told.pop(0), sleep=waits.append)
    area_api.hold_back("http://x", get=lambda u: (500, ""), sleep=waits.append)
    assert waits == [60.0]
    offered = area_api.availability(spark, "http://x/{key}", "K", get=lambda u: (200, "data_id,min_date,max_date\nVIIRS_SNPP_SP,2012-01-20,2024-01-31\n")).first()
    assert (offered.source, offered.min_date, offered.max_date) == ("VIIRS_SNPP_SP", date(2012, 1, 20), date(2024, 1, 31))
    parts = area_api.AreaReader({"start": "2024-01-01", "end": "2024-01-12", "parallel": "2"}).partitions()
    assert [p.items for p in parts] == [[("2024-01-01", 5), ("2024-01-11", 2)], [("2024-01-06", 5)]]
    assert area_api.AreaReader({"start": "2024-01-02", "end": "2024-01-01"}).partitions()[0].items == []


def test_persistent_sites(spark):
    rows = [(500 + 1000 * c, 500 + 1000 * c, date(2020, m, 1)) for c in (0, 1) for m in range(1, 9)] + [(9500, 500, date(2020, m, 1)) for m in range(1, 8)]
    places = spark.createDataFrame([(0, "mill", LAT, LON), (1, "mill too", LAT, LON)], "ord int, name string, lat double, lon double")
    (s,) = persistent.derive(frame(spark, rows), places).collect()
    assert (s.n_cells, s.n, s.radius_m, s.name, s.cal_months) == (2, 16, 1100, "mill", 8)
    radius = spark.createDataFrame([(11,), (5,), (1,)], "n int").select(persistent.site_radius(F.col("n")).alias("r"))
    assert [r.r for r in radius.collect()] == [2500, 1700, 1000]


def test_checks(spark):
    events = spark.createDataFrame([(0, 53.53, -1.98, D, day(1), 9, 2, 5.0)], "event_id long, centroid_lat double, centroid_lon double, start_date date, end_date date, n_detections long, duration_days int, max_frp double")
    episodes = spark.createDataFrame([("here", 53.54, -1.97, D, D), ("later", 53.54, -1.97, day(5), day(6))], "name string, lat double, lon double, first date, last date")
    assert {r.name: (r.n_events, r.ok) for r in sanity.episode_check(events, episodes).collect()} == {"here": (1, True), "later": (0, False)}


def test_registry():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and "daily_activity" in e.queries()


def test_entry_without_text_operators(tmp_path):
    """A copy of the repository without the text operators still registers its own queries."""
    import shutil
    import subprocess

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/cinderline", tmp_path / "cinderline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(f"{root}/{name}"):
            shutil.copy(f"{root}/{name}", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), sum(k.startswith('op') or k == 'pipeline' for k in q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True, check=True)
    number, oracles, text = map(int, out.stdout.split())
    assert number > 40 and oracles > 40 and text == 0
