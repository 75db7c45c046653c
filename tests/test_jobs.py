"""The jobs on a small store: fetch, resume, refresh, derive, build."""

from __future__ import annotations

import json
from datetime import date, timedelta

import pytest

from cinderline.config import Settings
from cinderline.operators import geo
from cinderline.plans import jobs
from cinderline.sources import area_api, store

SP, NRT = "VIIRS_SNPP_SP", "VIIRS_SNPP_NRT"
TEXTS = ", ".join(f"{c} string" for c in area_api.COLUMNS)
SETTINGS = Settings(history_start=date(2023, 12, 20))


@pytest.fixture
def sides(spark):
    corners = [("a", 0, -1e6, -1e6), ("a", 1, 2e6, -1e6), ("a", 2, 2e6, 2e6), ("a", 3, -1e6, 2e6)]
    return geo.edges(spark.createDataFrame(corners, "ring string, seq int, x double, y double"))


def answers(spark, asked, broken=()):
    """One detection a day, as an API would answer; what was asked is noted."""

    def fetch(source, windows):
        asked.append((source, windows))
        if windows[0][0].year in broken:
            raise area_api.ApiError("out of reach")
        rows = []
        for first, n in windows:
            for i in range(n):
                d = (first + timedelta(days=i)).isoformat()
                rows.append(tuple({"latitude": "53.5", "longitude": "-2.0", "acq_date": d, "acq_time": "0130", "satellite": "N", "confidence": "nominal", "frp": "5.5", "daynight": "N"}.get(c) for c in area_api.COLUMNS))
        return spark.createDataFrame(rows, TEXTS)

    return fetch


def available(spark, *rows):
    return spark.createDataFrame(list(rows), "source string, min_date date, max_date date")


def test_backfill_resumes(spark, tmp_path):
    raw, log, asked = str(tmp_path / "raw"), str(tmp_path / "log"), []
    offer = available(spark, (SP, date(2023, 12, 25), date(2024, 1, 8)), ("OTHER", date(2023, 1, 1), date(2024, 1, 1)))
    with pytest.raises(area_api.ApiError):
        jobs.backfill(spark, raw, log, offer, answers(spark, asked, broken={2024}))
    # the first year is stored and logged, the second is neither
    assert store.read_raw(spark, raw).count() == 10
    assert {(r.start, r.end, r.rows) for r in store.read_window_log(spark, log).collect()} == {(date(2023, 12, 25), date(2023, 12, 29), 5), (date(2023, 12, 30), date(2024, 1, 3), 5)}
    asked.clear()
    assert jobs.backfill(spark, raw, log, offer, answers(spark, asked)) == {SP: 5}
    assert asked == [(SP, [(date(2024, 1, 4), 5)])] and store.read_raw(spark, raw).count() == 15
    asked.clear()
    assert jobs.backfill(spark, raw, log, offer, answers(spark, asked)) == {SP: 0} and asked == []


def test_update_extends_and_refreshes(spark, tmp_path):
    raw, log, asked = str(tmp_path / "raw"), str(tmp_path / "log"), []
    jobs.backfill(spark, raw, log, available(spark, (SP, date(2024, 1, 1), date(2024, 1, 5)), (NRT, date(2024, 1, 1), date(2024, 1, 20))), answers(spark, []))
    offer = available(spark, (SP, date(2024, 1, 1), date(2024, 1, 7)), (NRT, date(2024, 1, 1), date(2024, 1, 22)))
    assert jobs.update(spark, raw, log, offer, answers(spark, asked)) == {SP: 2, NRT: 10}
    assert asked == [(SP, [(date(2024, 1, 6), 2)]), (NRT, [(date(2024, 1, 13), 5), (date(2024, 1, 18), 5)])]
    assert store.read_raw(spark, raw).where("product = 'NRT'").count() == 22
    last = store.read_window_log(spark, log).where("source = 'VIIRS_SNPP_NRT'").orderBy("end", ascending=False).first()
    assert (last.start, last.end, last.rows) == (date(2024, 1, 13), date(2024, 1, 22), 10)


def test_build(spark, tmp_path, sides):
    raw, log, out = str(tmp_path / "raw"), str(tmp_path / "log"), str(tmp_path / "out")
    none = store.read_exclusions(spark, None, None)
    with pytest.raises(ValueError):
        jobs.build(spark, raw, log, out, sides, none, SETTINGS)
    jobs.backfill(spark, raw, log, available(spark, (SP, date(2023, 12, 30), date(2024, 1, 5)), (NRT, date(2024, 1, 4), date(2024, 1, 8))), answers(spark, []))
    wide = jobs.sensitivity(spark, raw, out, sides, none, SETTINGS).collect()
    assert len(wide) == 1 and wide[0].year == 2023 and wide[0].e1500_g2 == 1
    counts = [tuple(r) for r in store.read_table(spark, f"{out}/clustering_sensitivity", jobs.SENSITIVITY).collect()]
    assert counts == sorted(counts) and len(counts) == 9  # in the files' own order
    jobs.build(spark, raw, log, out, sides, none, SETTINGS)
    table = lambda name: spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/{name}").collect()
    # 12-30 to 01-05 are settled; provisional rows are left of 01-06 to 01-08
    (event,) = table("events")
    assert (event.n_detections, event.n_days_detected, event.duration_days, event.sum_frp) == (10, 10, 10, 55.0)
    days = {r.date: r for r in table("daily")}
    assert len(days) == 20 and days[date(2023, 12, 20)].detections == 0 and days[date(2024, 1, 8)].product_status == "NRT"
    assert [(r.year, r.month, r.detections, r.new_events) for r in table("monthly")] == [(2023, 12, 2, 1), (2024, 1, 8, 0)]
    assert [(r.year, r.detections, r.complete) for r in table("annual")] == [(2023, 2, True), (2024, 8, False)]
    assert len(table("detections_filtered")) == 10
    payload = lambda name: json.loads(spark.read.text(f"{out}/site/{name}.json").first()[0])
    meta = payload("meta")
    assert meta["funnel"] == {"bbox": 10, "uk_land": 10, "not_static_type": 10, "confidence": 10, "not_persistent": 10}
    assert (meta["data_end"], meta["n_events"], meta["n_persistent_sources"]) == ("2024-01-08", 1, 0)
    assert meta["sp_max_date"] == {"SNPP": "2024-01-05"} and meta["nrt_max_date"] == {"SNPP": "2024-01-08"}
    assert meta["headline"]["detections_last7"] == 7 and meta["headline"]["ytd"]["ytd"] == 0 and meta["headline"]["avg7_active_events"] == 1.0
    assert meta["config"]["cluster_eps_m"] == 1500.0 and meta["top_events"][0]["start_date"] == "2023-12-30" and len(meta["sensitivity"]) == 9
    runs = payload("cumulative_detections")
    assert runs["doy"][-1] == 366 and runs["years"]["2023"][364] == 2 and runs["years"]["2024"][:9] == [1, 2, 3, 4, 5, 6, 7, 8, 8]
    assert payload("daily")["dates"][0] == "2023-12-20" and payload("events_all")["n"] == [10] and payload("detections_recent")["night"] == [1] * 10
    assert payload("persistent_sources") == [] and len(payload("annual")) == 2
    # files by name, copies of two tables among them
    assert (tmp_path / "out" / "site" / "daily.json").is_file()
    assert (tmp_path / "out" / "site" / "daily.csv").read_text().splitlines()[1].startswith("2023-12-20,0,") and len((tmp_path / "out" / "site" / "events.csv").read_text().splitlines()) == 2


def test_derive_sources(spark, tmp_path, sides):
    raw, log = str(tmp_path / "raw"), str(tmp_path / "log")
    jobs.backfill(spark, raw, log, available(spark, (SP, date(2023, 1, 1), date(2023, 8, 31))), answers(spark, []))
    places = spark.createDataFrame([(0, "mill", 53.5, -2.0)], "ord int, name string, lat double, lon double")
    (site,) = jobs.derive_sources(spark, raw, str(tmp_path), sides, places).collect()
    assert (site.name, site.n, site.cal_months, site.radius_m) == ("mill", 243, 8, 1000)
    (held,) = store.read_exclusions(spark, f"{tmp_path}/persistent_sources", None).collect()
    assert (held.name, held.radius_m, held.origin) == ("mill", 1000, "derived") and abs(held.lat - 53.5) < 1e-6


def test_raw_csv(spark, tmp_path):
    assert store.read_raw_csv(spark, f"{tmp_path}/none.csv").count() == 0
    (tmp_path / "a.csv").write_text("latitude,longitude,acq_date,acq_time,type\n1.5,2,2024-01-01,0124,2.0\nx,,2024-01-02,late,\n")
    a, b = store.read_raw_csv(spark, f"{tmp_path}/a.csv").orderBy("acq_date").collect()
    assert (a.latitude, a.acq_time, a.type, a.frp) == (1.5, 124, 2, None) and (b.latitude, b.longitude, b.acq_time) == (None, None, None)


def test_sites_in_files(spark, tmp_path):
    (tmp_path / "m.csv").write_text("lat,lon,radius_m,name\n53.1,-2.2,,yard\n")
    assert [tuple(r) for r in store.read_exclusions(spark, None, f"{tmp_path}/m.csv").collect()] == [(53.1, -2.2, 1000, "yard", "manual")]
    ring = "[[[0,0],[4,0],[4,4],[0,0]],[[1,1],[2,1],[2,2],[1,1]]]"
    (tmp_path / "p.json").write_text('{"features":[{"geometry":{"type":"MultiPolygon","coordinates":[' + ring + "]}}]}")
    assert [(r.ring, r.n) for r in store.read_polygon(spark, f"{tmp_path}/p.json").groupBy("ring").count().toDF("ring", "n").orderBy("ring").collect()] == [("0/0/0", 3), ("0/0/1", 3)]


def test_windows_option():
    parts = area_api.AreaReader({"windows": "2024-01-01:5,2024-03-01:2"}).partitions()
    assert [p.items for p in parts] == [[("2024-01-01", 5), ("2024-03-01", 2)]]


def test_strict_json(spark):
    from cinderline.operators import publish

    df = spark.createDataFrame([(float("inf"), [1.5, float("nan")], (date(2024, 1, 2), -float("inf")))], "a double, b array<double>, c struct<d:date,e:double>")
    assert json.loads(publish.one_object(df).first()[0]) == {"a": None, "b": [1.5, None], "c": {"d": "2024-01-02", "e": None}}
