"""The store of raw rows, the API source through Spark, the stream into the store, published files, the checks."""

from __future__ import annotations

import csv
import json
import threading
import time
from collections import Counter
from datetime import date, timedelta
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from cinderline.operators import ingest, publish
from cinderline.plans import jobs
from cinderline.sources import area_api, store
from cinderline.streaming import ingest as stream

SP, NRT = "VIIRS_SNPP_SP", "VIIRS_SNPP_NRT"


def raw(spark, *rows, source=NRT):
    """Rows (day, time), or (day, time, frp)."""
    given = [(53.0, -2.0, r[0], r[1], float(r[2]) if len(r) > 2 else 1.0, "N", "n") for r in rows]
    return ingest.normalise(spark.createDataFrame(given, "latitude double, longitude double, acq_date date, acq_time int, frp double, satellite string, confidence string"), source)


def held(spark, path):
    return sorted((r.source, r.acq_date.isoformat(), r.acq_time, r.frp) for r in store.read_raw(spark, path).collect())


def day(n):
    return date(2024, 1, 1) + timedelta(days=n)


def test_upserts_hide_and_add(spark, tmp_path):
    path = f"{tmp_path}/raw"
    assert held(spark, path) == [] and store.upsert_raw(spark, path, NRT, raw(spark)) == 0
    assert store.upsert_raw(spark, path, NRT, raw(spark, (day(0), 1), (day(0), 1, 7), (day(5), 2), (day(400), 3))) == 3
    assert store.upsert_raw(spark, path, SP, raw(spark, (day(0), 1), source=SP)) == 1
    # a key that is there keeps its row; replaced days lose theirs, of this source alone
    assert store.upsert_raw(spark, path, NRT, raw(spark, (day(0), 1, 9), (day(1), 1))) == 1
    assert store.upsert_raw(spark, path, NRT, raw(spark, (day(5), 9)), (day(0), day(5))) == 1
    want = [(NRT, "2024-01-06", 9, 1.0), (NRT, "2025-02-04", 3, 1.0), (SP, "2024-01-01", 1, 1.0)]
    assert held(spark, path) == want
    # what was replaced comes in anew, and older versions of it stay hidden
    assert store.upsert_raw(spark, path, NRT, raw(spark, (day(0), 1, 5))) == 1
    want = sorted([*want, (NRT, "2024-01-01", 1, 5.0)])
    assert held(spark, path) == want
    version, commits = store.commits(spark, path)
    assert version == len(commits) == 5 and sum(c.rows for c in commits) == 7
    store.compact(spark, path)
    assert held(spark, path) == want and [c.rows for c in store.commits(spark, path)[1]] == [4]
    assert len(store.vacuum(spark, path, versions=1)) == 5 and held(spark, path) == want
    assert store.upsert_raw(spark, path, NRT, raw(spark), (day(0), day(900))) == 0
    assert held(spark, path) == [(SP, "2024-01-01", 1, 1.0)]


def test_compaction_by_itself(spark, tmp_path):
    path = f"{tmp_path}/raw"
    for k in range(5):
        store.upsert_raw(spark, path, NRT, raw(spark, (day(k), 1)), most_commits=3)
    assert len(store.commits(spark, path)[1]) <= 3 and len(held(spark, path)) == 5


def test_a_job_that_is_lost_leaves_the_store_whole(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/raw"
    store.upsert_raw(spark, path, NRT, raw(spark, (day(0), 1), (day(1), 1)))
    before = held(spark, path)
    real = store.publish

    def lost(*_):
        raise KeyboardInterrupt  # after the rows were written, before readers see them

    monkeypatch.setattr(store, "publish", lost)
    with pytest.raises(KeyboardInterrupt):
        store.upsert_raw(spark, path, NRT, raw(spark, (day(1), 5), (day(2), 5)), (day(0), day(2)))
    assert held(spark, path) == before
    monkeypatch.setattr(store, "publish", real)
    assert store.upsert_raw(spark, path, NRT, raw(spark, (day(1), 5), (day(2), 5)), (day(0), day(2))) == 2
    assert held(spark, path) == [(NRT, "2024-01-02", 5, 1.0), (NRT, "2024-01-03", 5, 1.0)]
    assert len(store.vacuum(spark, path)) == 1  # the folder that no version names


def test_two_writers(spark, tmp_path):
    path = f"{tmp_path}/raw"
    store.upsert_raw(spark, path, NRT, raw(spark, (day(0), 1)))
    version, commits = store.commits(spark, path)
    store.publish(spark, path, version, commits)
    with pytest.raises(store.Conflict):
        store.publish(spark, path, version, commits)


def test_reading_the_store_shuffles_nothing(spark, tmp_path):
    path = f"{tmp_path}/raw"
    store.upsert_raw(spark, path, NRT, raw(spark, (day(0), 1), (day(1), 1)))
    store.upsert_raw(spark, path, NRT, raw(spark, (day(1), 2)), (day(1), day(1)))
    plan = store.read_raw(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan parquet") == 1


def test_loading_a_bucketed_store_shuffles_nothing(spark, tmp_path):
    path = f"{tmp_path}/raw"
    store.upsert_raw(spark, path, SP, raw(spark, *[(day(k % 9), k % 5) for k in range(40)], source=SP))
    store.upsert_raw(spark, path, NRT, raw(spark, *[(day(k % 14), k % 7) for k in range(60)]))
    want = sorted(map(str, ingest.load(store.read_raw(spark, path)).collect()))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        laid = ingest.load(store.write_bucketed(spark, path, f"{tmp_path}/laid", buckets=4))
        assert sorted(map(str, laid.collect())) == want and len({(r.source, r.acq_date) for r in laid.collect()}) == 14
        assert "Exchange" not in laid._jdf.queryExecution().executedPlan().toString()
        again = ingest.load(store.read_bucketed(spark, f"{tmp_path}/laid", buckets=4))
        assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString() and again.count() == len(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_order_within_files(spark, tmp_path):
    path = f"{tmp_path}/raw"
    store.upsert_raw(spark, path, NRT, raw(spark, *[(day(k * 7 % 20), k * 5 % 9) for k in range(60)]))
    files = [r.f for r in store.read_raw(spark, path).select(F.input_file_name().alias("f")).distinct().collect()]
    for f in files:
        rows = [(r.acq_date, r.acq_time) for r in spark.read.parquet(f).collect()]
        assert rows == sorted(rows)


# ---- the API through Spark


class Api(BaseHTTPRequestHandler):
    """Answers windows with a row a day; each window fails once; the budget is used up at the second question."""

    def do_GET(self):
        s = self.server
        with s.lock:
            s.asked.append((time.time(), self.path))
            tries = sum(p == self.path for _, p in s.asked)
        if self.path.startswith("/status"):
            used = 99 if tries == 2 else 1
            return self.say(200, json.dumps({"current_transactions": used, "transaction_limit": 100}))
        if self.path.startswith("/offer"):
            return self.say(200, f"data_id,min_date,max_date\n{SP},2024-01-01,2024-01-18\n")
        _, key, source, bbox, n, first = self.path.strip("/").split("/")
        if tries == 1 and first == "2024-01-06":
            return self.say(503, "busy")
        if key != "KEY":
            return self.say(403, f"Invalid {key}")
        days = [(date.fromisoformat(first) + timedelta(days=i)).isoformat() for i in range(int(n))]
        self.say(200, "latitude,longitude,acq_date,acq_time,satellite,confidence,extra\n" + "".join(f"53.5,-2,{d},0130,N,nominal,x\n" for d in days))

    def say(self, code, text):
        self.send_response(code)
        self.end_headers()
        self.wfile.write(text.encode())

    def log_message(self, *_):
        pass


@pytest.fixture
def api():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Api)
    server.lock, server.asked = threading.Lock(), []
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield server
    server.shutdown()


def test_api_source_through_spark(spark, api, tmp_path):
    base = f"http://127.0.0.1:{api.server_port}"
    offer = area_api.availability(spark, base + "/offer/{key}", "KEY")
    fetch = jobs.api_fetch(spark, base + "/area/{key}/{source}/{bbox}/{days}/{date}", "KEY", "1,2,3,4", status=base + "/status/{key}", parallel="2", pace="0.05", pause="0.3")
    assert jobs.backfill(spark, f"{tmp_path}/raw", f"{tmp_path}/log", offer, fetch) == {SP: 18}
    rows = store.read_raw(spark, f"{tmp_path}/raw").collect()
    assert sorted(r.acq_date for r in rows) == [day(n) for n in range(18)] and {(r.acq_time, r.confidence, r.type) for r in rows} == {(130, "n", None)}
    seen = Counter(p for _, p in api.asked)
    windows = {p: n for p, n in seen.items() if p.startswith("/area")}
    assert len(windows) == 4 and sorted(windows.values()) == [1, 1, 1, 2]  # one was asked again
    # two partitions asked for the budget once each, one of them once more after a pause
    assert seen["/status/KEY"] == 3
    asked = [t for t, p in api.asked if p.startswith("/status")]
    assert asked[-1] - asked[0] >= 0.28
    wrong = jobs.api_fetch(spark, base + "/area/{key}/{source}/{bbox}/{days}/{date}", "SECRET", "1")
    with pytest.raises(Exception) as e:
        wrong(SP, [(day(0), 2)]).collect()
    assert "answered [403]" in str(e.value) and "SECRET" not in str(e.value).split("answered")[1]


def test_hold_back_ends():
    with pytest.raises(area_api.ApiError):
        area_api.hold_back("http://x", get=lambda u: (200, '{"current_transactions": 9, "transaction_limit": 9}'), sleep=lambda s: None, most_pauses=3)


# ---- a stream into the store


def lines(*rows):
    head = [f.name for f in store.RAW]
    given = [{"latitude": 53.0, "longitude": -2.0, "satellite": "N", "source": NRT, "product": "NRT", "sat": "SNPP", **dict(zip(("acq_date", "acq_time"), r, strict=True))} for r in rows]
    return "\n".join([",".join(head), *[",".join(str(g.get(c, "")) for c in head) for g in given]]) + "\n"


def test_stream_into_the_store(spark, tmp_path):
    """Repeats within the watermark come once, late rows beyond it are left out, and a restart goes on where the last run stopped."""
    inbox, path, state = tmp_path / "in", f"{tmp_path}/raw", f"{tmp_path}/state"
    inbox.mkdir()

    def run():
        query = stream.into_store(stream.arrivals(spark, str(inbox), late="2 days"), path, state)
        query.awaitTermination(120)
        assert query.exception() is None
        return [(d, t) for _, d, t, _ in held(spark, path)]

    (inbox / "a.csv").write_text(lines(("2024-01-10", 100), ("2024-01-10", 100), ("2024-01-11", 200)))
    assert run() == [("2024-01-10", 100), ("2024-01-11", 200)]
    (inbox / "b.csv").write_text(lines(("2024-01-20", 100), ("2024-01-11", 200)))
    assert run() == [("2024-01-10", 100), ("2024-01-11", 200), ("2024-01-20", 100)]
    # the watermark stands at 01-18 now: older rows are late
    (inbox / "c.csv").write_text(lines(("2024-01-12", 100), ("2024-01-19", 100), ("2024-01-20", 100)))
    assert run() == [("2024-01-10", 100), ("2024-01-11", 200), ("2024-01-19", 100), ("2024-01-20", 100)]
    assert run() == [("2024-01-10", 100), ("2024-01-11", 200), ("2024-01-19", 100), ("2024-01-20", 100)]
    # a batch whose end was not noted runs again and adds nothing
    newest = max(int(p.name) for p in (tmp_path / "state" / "commits").iterdir() if p.name.isdigit())
    for name in (str(newest), f".{newest}.crc"):
        (tmp_path / "state" / "commits" / name).unlink()
    assert run() == [("2024-01-10", 100), ("2024-01-11", 200), ("2024-01-19", 100), ("2024-01-20", 100)]


# ---- published files


def test_payloads_in_pieces(spark, tmp_path):
    rows = [(i * 7 % 1000, date(2024, 1, 1), None if i % 5 == 0 else i / 3, float("nan") if i % 11 == 0 else 1.0, f'"{i}"\n') for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, d date, a double, b double, t string").repartition(6)
    for whole, pieces in ((publish.columnar, publish.columnar_pieces), (publish.records, publish.record_pieces)):
        store.write_payload(pieces(df, ["id"], rows_a_piece=90), f"{tmp_path}/x.json")
        assert json.loads((tmp_path / "x.json").read_text()) == json.loads(whole(df, ["id"]).first()[0])
        store.write_payload(pieces(df.limit(0), ["id"]), f"{tmp_path}/x.json")
        assert json.loads((tmp_path / "x.json").read_text()) in ({c: [] for c in df.columns}, [])
    assert publish.columnar_pieces(df, ["id"], rows_a_piece=90).where("at = 1").count() == 12
    assert not list(tmp_path.glob("x.json?*"))


def test_numbers_in_payloads_are_plain(spark):
    rows = [(0, 12345678.9), (1, 1e7), (2, -123456789012.5), (3, 1e20), (4, 1.5e21), (5, 1e-4), (6, 1.5e-6), (7, 1e-7), (8, 0.0), (9, 0.001), (10, 2.0), (11, float("inf")), (12, None)]
    df = spark.createDataFrame(rows, "id int, a double")
    shown = "12345678.9,10000000.0,-123456789012.5,100000000000000000000.0,1.5e21,0.0001,0.0000015,1e-7,0.0,0.001,2.0,null,null"
    assert publish.columnar(df, ["id"]).first()[0] == f'{{"id":[0,1,2,3,4,5,6,7,8,9,10,11,12],"a":[{shown}]}}'
    assert publish.records(df.limit(1), ["id"]).first()[0] == '[{"id":0,"a":12345678.9}]'
    assert [json.loads(publish.one_object(df.where(f"id = {i}")).first()[0])["a"] for i in range(11)] == [x for _, x in rows[:11]]


def test_import_of_an_archive(spark, tmp_path):
    (tmp_path / "a.csv").write_text("latitude,longitude,acq_date,acq_time,satellite,confidence,type\n1.5,2,2024-01-01,0124,N,nominal,0\n1.5,2,2024-01-01,124,N,high,0\n")
    (tmp_path / "b.csv").write_text("latitude,longitude,acq_date,acq_time,satellite,confidence,source\n1.5,2,2024-02-01,0124,N,n,VIIRS_SNPP_SP\n1.5,2,2024-02-02,0124,N,n,OTHER\n")
    path = f"{tmp_path}/raw"
    assert jobs.import_raw(spark, path, SP, f"{tmp_path}/a.csv") == 1 and jobs.import_raw(spark, path, SP, f"{tmp_path}/b.csv") == 1
    assert jobs.import_raw(spark, path, SP, f"{tmp_path}/a.csv") == 0
    assert [(r.acq_date, r.acq_time, r.confidence, r["product"]) for r in store.read_raw(spark, path).orderBy("acq_date").collect()] == [(date(2024, 1, 1), 124, "n", "SP"), (date(2024, 2, 1), 124, "n", "SP")]


def test_checks_of_published_tables(spark, tmp_path, capsys):
    events = spark.createDataFrame([(0, 53.53, -1.98, date(2023, 6, 24), date(2023, 6, 25), 9, 2, 5.0)], "event_id long, centroid_lat double, centroid_lon double, start_date date, end_date date, n_detections long, duration_days int, max_frp double")
    daily = spark.createDataFrame([(date(2022, 3, 1), 5, 1, 4, 1.0), (date(2023, 3, 1), 2, 1, 1, 1.0)], "date date, detections long, active_events long, new_events long, active_events_7d double")
    out = f"{tmp_path}/out"
    store.write_table(events, f"{out}/events")
    store.write_table(daily, f"{out}/daily")
    (tmp_path / "episodes.csv").write_text("name,lat,lon,first,last\nhere,53.54,-1.97,2023-06-24,2023-06-24\nlater,53.54,-1.97,2023-07-24,2023-07-25\n")
    (tmp_path / "places.csv").write_text("name,lat,lon,industrial\nmill,53.0,-2.0,true\nmoor,53.0,-2.01,false\nheath,55.0,-2.0,false\n")
    (tmp_path / "manual.csv").write_text("lat,lon,radius_m,name\n53.0,-2.0,,yard\n")
    from cinderline.__main__ import main

    code = main(["check", "--store", str(tmp_path), "--out", out, "--episodes", f"{tmp_path}/episodes.csv", "--places", f"{tmp_path}/places.csv", "--manual", f"{tmp_path}/manual.csv", "--days", "2023-03-01"])
    said = capsys.readouterr().out.splitlines()
    got = {tuple(line.split(":")[0].split(" ", 2)) for line in said if line.split(" ")[0] in ("PASS", "FAIL", "WARN", "INFO")}
    assert code == 1 and got == {("PASS", "episode", "here"), ("FAIL", "episode", "later"), ("PASS", "place", "mill"), ("FAIL", "place", "moor"), ("PASS", "place", "heath"), ("INFO", "day", "2023-03-01"), ("INFO", "year", "2022"), ("INFO", "year", "2023"), ("WARN", "season", "2023")}


def test_command_line(monkeypatch):
    from cinderline.__main__ import arguments, key_of

    args = arguments(["backfill", "--store", "s", "--start", "2024-01-02"])
    assert args.start == date(2024, 1, 2) and args.sources.startswith("VIIRS_SNPP_SP,")
    monkeypatch.delenv("FIRMS_MAP_KEY", raising=False)
    with pytest.raises(SystemExit):
        key_of(args)
    monkeypatch.setenv("FIRMS_MAP_KEY", " k ")
    assert key_of(args) == "k"
    with pytest.raises(SystemExit):
        arguments(["build", "--store", "s"])


def test_orders_of_published_tables(spark, tmp_path):
    """Events by (start, id), days by date, in the files as they are read line by line."""
    df = spark.createDataFrame([(i * 37 % 50, date(2024, 1, 1) + timedelta(days=i * 11 % 7)) for i in range(50)], "event_id int, start_date date").repartition(5)
    store.write_csv_file(df.orderBy("start_date", "event_id"), f"{tmp_path}/events.csv")
    with (tmp_path / "events.csv").open() as f:
        rows = [(r["start_date"], int(r["event_id"])) for r in csv.DictReader(f)]
    assert rows == sorted(rows) and len(rows) == 50
