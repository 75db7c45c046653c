"""Linkage, polygons, sites and nearest places against brute force, and what they cost on dense input."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderline.operators import cluster, geo, graph, persistent
from cinderline.operators.graph import checkpoint
from cinderline.operators.numbering import dense_numbers, number_rows


def rows_frame(spark, rows):
    return checkpoint(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_no long, x double, y double, day int"))


def least_reachable(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def linked(rows, eps, gap):
    return least_reachable(len(rows), [(i, j) for i, p in enumerate(rows) for j, q in enumerate(rows[:i]) if abs(p[2] - q[2]) <= gap and (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= eps * eps])


def scattered(turn):
    """Clusters of several widths, chains just within and beyond reach, a lattice, repeated places."""
    rows = []
    for _ in range(10):
        x, y, day, wide = turn.uniform(-9000, 9000), turn.uniform(-9000, 9000), turn.randrange(-3, 8), turn.choice([0, 5, 300, 900])
        rows += [(turn.gauss(x, wide), turn.gauss(y, wide), day + turn.randrange(3)) for _ in range(40)]
    rows += [(1500.0 * k, 20_000.0, 3) for k in range(5)] + [(1500.001 * k, 30_000.0, 3) for k in range(5)] + [(40_000.0, 1000.0 * k, 2 * k) for k in range(5)] + [(50_000.0, 0.0, 3 * k) for k in range(4)]
    rows += [(float(x), float(y), 4) for x in range(-6000, 0, 750) for y in range(60_000, 63_000, 750)]
    # two dense patches whose closest points are just about eps apart
    rows += [(100_000.0 + turn.uniform(0, 900), turn.uniform(0, 900), 1) for _ in range(120)] + [(102_399.0 + turn.uniform(0, 900), turn.uniform(0, 900), 2) for _ in range(120)]
    rows.sort(key=lambda r: r[2])
    return rows


def test_events_against_brute_force(spark):
    rows = scattered(random.Random(1))
    held = rows_frame(spark, rows)
    for eps, gap in ((1500.0, 2), (700.0, 0)):
        want = linked(rows, eps, gap)
        place = {c: i for i, c in enumerate(sorted(set(want)))}
        got = {r.row_no: r.event_id for r in cluster.assign_events(held, eps_m=eps, gap_days=gap).collect()}
        assert [got[i] for i in range(len(rows))] == [place[c] for c in want]


def test_rows_without_a_place_are_in_no_event(spark):
    held = checkpoint(spark.createDataFrame([(0, 1.0, 1.0, 1), (1, None, 1.0, 1), (2, 1.0, 1.0, None), (3, 5.0, 5.0, 2)], "row_no long, x double, y double, day int"))
    assert {r.row_no: r.event_id for r in cluster.assign_events(held).collect()} == {0: 0, 1: None, 2: None, 3: 0}


def test_nested_settings_against_brute_force(spark):
    rows = scattered(random.Random(2))
    assert cluster.lattice([(e, g) for e in (1000.0, 1500.0, 2000.0) for g in (1, 3)]) == [None, 0, 0, 2, 2, 4]
    settings = [(1000.0, 1), (1500.0, 3), (2000.0, 1)]
    for (eps, gap), held in zip(settings, cluster.nested_components(rows_frame(spark, rows), settings), strict=True):
        want = linked(rows, eps, gap)
        got = held.collect()
        assert len({r.component for r in got}) == len(set(want)) and all(r.component == want[r.node] for r in got)


def test_wider_settings_take_components_not_cells(spark):
    """A chain of cells, linked under the narrowest setting, is one group of the wider one."""
    rows = rows_frame(spark, [(700.0 * i + (2500.0 if i >= 40 else 0.0), 0.0, 0) for i in range(50)])
    narrow, wide = cluster.nested_components(rows, [(1000.0, 1), (4000.0, 1)])
    assert sorted((r.node, r.component) for r in narrow.collect()) == [(0, 0), (40, 40)]
    assert sorted((r.node, r.component) for r in wide.collect()) == [(0, 0), (40, 0)]


def test_a_dense_cell_gives_no_pairs(spark):
    """50,000 rows in one cell, as many next to it: links grow with cells."""
    turn = np.random.default_rng(3)
    n = 50_000
    x = np.concatenate([turn.uniform(0, 900, n), turn.uniform(1100, 1900, n), turn.uniform(90_000, 90_900, n)])
    y, day = turn.uniform(0, 900, 3 * n), turn.integers(0, 3, 3 * n)
    import pandas as pd

    held = checkpoint(spark.createDataFrame(pd.DataFrame({"row_no": np.arange(3 * n), "x": x, "y": y, "day": day})))
    cells, links = geo.linked_cells(held, "row_no", [(1500.0, 2)])
    assert cells.count() == 3 and cells.agg(F.sum("n")).first()[0] == 3 * n and links.count() == 1
    counts = {r.event_id: r["count"] for r in cluster.assign_events(held).groupBy("event_id").count().collect()}
    assert counts == {0: 2 * n, 1: n}


def test_contraction_leaves_little_to_rounds(spark, monkeypatch):
    """A chain of 400 cells within one coarse tile needs no rounds at all; one across tiles goes through rounds with few edges."""
    rounds = []
    before = graph._star
    monkeypatch.setattr(graph, "_star", lambda edges, large: rounds.append(edges.count()) or before(edges, large))
    schema = "cx long, cy long, n long"
    whole = persistent.merge_cells(spark.createDataFrame([(k, k % 2, 1) for k in range(400)], schema), at_once=0)
    assert [r.site for r in whole.select("site").distinct().collect()] == [0] and rounds == []
    across = persistent.merge_cells(spark.createDataFrame([(k, 5, 1) for k in range(-700, 1500)], schema), at_once=0)
    assert across.select("site").distinct().count() == 1 and 0 < max(rounds) <= 4


def test_tiled_components_against_union_find(spark):
    turn = random.Random(4)
    place = [turn.randrange(300) for _ in range(150)]
    pairs = [(i, j) for i in range(150) for j in range(i) if abs(place[i] - place[j]) <= 1]
    tile = lambda a, b, s: place[a] // s if place[a] // s == place[b] // s else None
    edges = spark.createDataFrame([(a, b, tile(a, b, 10), tile(a, b, 80)) for a, b in pairs], "a long, b long, t0 long, t1 long")
    want = least_reachable(150, pairs)
    got = {r.node: r.component for r in graph.tiled_components(edges, ["t0", "t1"], at_once=0).collect()}
    assert got == {r.node: r.component for r in graph.tiled_components(edges, ["t0", "t1"]).collect()}
    assert got == {i: want[i] for i in {x for p in pairs for x in p}}
    assert graph.tiled_components(edges.where("a < 0"), ["t0", "t1"]).count() == 0


def test_numbers(spark):
    turn = random.Random(5)
    values = [turn.randrange(10**6) for _ in range(3000)]
    got = number_rows(spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v long, i long"), [F.col("v"), F.col("i")], "place").collect()
    assert [(r.v, r.i) for r in sorted(got, key=lambda r: r.place)] == sorted((v, i) for i, v in enumerate(values)) and {r.place for r in got} == set(range(3000))
    some = sorted(set(values))
    got = dense_numbers(spark.createDataFrame([(v,) for v in some], "v long"), "v", "place", stretch=1000).collect()
    assert {r.v: r.place for r in got} == {v: i for i, v in enumerate(some)}


# ---- polygons


def rings_frame(spark, rings):
    return geo.edges(spark.createDataFrame([(str(k), i, float(x), float(y)) for k, ring in enumerate(rings) for i, (x, y) in enumerate(ring)], "ring string, seq int, x double, y double"))


def inside_and_distance(rings, x, y):
    odd, best = False, math.inf
    for ring in rings:
        a = np.array(ring)
        b = np.roll(a, -1, axis=0)
        with np.errstate(divide="ignore", invalid="ignore"):
            at = (b[:, 0] - a[:, 0]) * (y - a[:, 1]) / (b[:, 1] - a[:, 1]) + a[:, 0]
        odd ^= bool((((a[:, 1] > y) != (b[:, 1] > y)) & (x < at)).sum() % 2)
        d = b - a
        t = np.clip(((x - a[:, 0]) * d[:, 0] + (y - a[:, 1]) * d[:, 1]) / (d**2).sum(axis=1), 0, 1)
        best = min(best, float(np.hypot(x - a[:, 0] - t * d[:, 0], y - a[:, 1] - t * d[:, 1]).min()))
    return odd, best


def coast(turn, n, wide, x=0.0, y=0.0):
    """A ring with bays."""
    waves = [(turn.randrange(2, 60), turn.uniform(0, 6), turn.uniform(0, 0.06)) for _ in range(12)]
    angles = [2 * math.pi * k / n for k in range(n)]
    radii = [wide * (1 + sum(h * math.sin(f * a + p) for f, p, h in waves)) for a in angles]
    return [(x + r * math.cos(a), y + r * math.sin(a)) for a, r in zip(angles, radii, strict=True)]


@pytest.mark.parametrize("buffer", [0.0, 750.0])
def test_polygons_against_brute_force(spark, buffer):
    turn = random.Random(6)
    rings = [coast(turn, 500, 60_000), coast(turn, 90, 9000, 5000, 5000), [(200_000, 0), (300_000, 0), (300_000, 50), (200_000, 50)], [(-200_000, -200_000), (-120_000, -90_000), (-150_000, -80_000)]]
    points = [(turn.uniform(-210_000, 310_000), turn.uniform(-210_000, 100_000)) for _ in range(400)] + [(turn.uniform(-80_000, 80_000), turn.uniform(-80_000, 80_000)) for _ in range(600)]
    points += [(x + turn.gauss(0, 400), y + turn.gauss(0, 400)) for ring in rings for x, y in ring[::3]]
    given = spark.createDataFrame([(i, *p) for i, p in enumerate(points)] + [(-1, None, 1.0)], "i long, x double, y double")
    sizes = (64_000.0, 8_000.0, 1_000.0) if buffer else geo.COVER
    got = {r.i: r["in"] for r in geo.inside_flag(given, rings_frame(spark, rings), "in", buffer_m=buffer, sizes=sizes).collect()}
    assert len(got) == len(points) + 1 and got[-1] is False
    for i, p in enumerate(points):
        odd, km = inside_and_distance(rings, *p)
        assert got[i] == (odd or km < buffer), p
    assert not any(r["in"] for r in geo.inside_flag(given, rings_frame(spark, [[(0, 0)]]), "in", buffer_m=buffer).collect())


def test_a_ring_of_many_vertices(spark):
    """100,000 vertices: results are equal, and few points meet edges, each of them a small part of all."""
    turn = random.Random(7)
    ring = coast(turn, 100_000, 300_000)
    sides = checkpoint(rings_frame(spark, [ring]))
    points = [(turn.uniform(-4e5, 4e5), turn.uniform(-4e5, 4e5)) for _ in range(150)] + [(x + turn.gauss(0, 500), y + turn.gauss(0, 500)) for x, y in ring[::2000]]
    given = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i long, x double, y double")
    got = {r.i: r["in"] for r in geo.inside_flag(given, sides, "in", buffer_m=750.0).collect()}
    for i, p in enumerate(points):
        odd, m = inside_and_distance([ring], *p)
        assert got[i] == (odd or m < 750), p
    cover, n = geo.polygon_cover(sides, reach=750.0)
    assert n == cover.agg(F.sum(1 + F.coalesce(F.size("sides"), F.lit(0)))).first()[0]
    held = cover.where("sides is not null").agg(F.count("*").alias("n"), F.avg(F.size("sides")).alias("mean"), F.max(F.size("sides")).alias("most")).first()
    assert held.mean < 400 and held.most < 2000  # of 100,000
    at = given.select(geo.cell(F.col("x"), geo.COVER[-1]).alias("cx"), geo.cell(F.col("y"), geo.COVER[-1]).alias("cy"))
    met = at.join(cover.where("sides is not null").select("cx", "cy", F.size("sides").alias("n")), ["cx", "cy"], "left").agg(F.avg(F.coalesce("n", F.lit(0)))).first()[0]
    assert met < 150


# ---- sites and places


def test_sites_of_unlike_radius(spark):
    turn = random.Random(8)
    sites = [(turn.uniform(-1e5, 1e5), turn.uniform(-1e5, 1e5), turn.choice([0, 50, 999, 1000, 1001, 4000, 23_300, 60_000])) for _ in range(40)] + [(0.0, 0.0, 1000), (None, 1.0, 5)]
    points = [(turn.uniform(-2e5, 2e5), turn.uniform(-2e5, 2e5)) for _ in range(700)] + [(1000.0, 0.0), (1000.5, 0.0)]
    given = spark.createDataFrame([(i, *p) for i, p in enumerate(points)] + [(-1, None, 0.0)], "i long, x double, y double")
    held = spark.createDataFrame(sites, "x double, y double, radius_m int")
    for strict in (False, True):
        near = lambda p: any(s[0] is not None and ((p[0] - s[0]) ** 2 + (p[1] - s[1]) ** 2 < s[2] ** 2 if strict else (p[0] - s[0]) ** 2 + (p[1] - s[1]) ** 2 <= s[2] ** 2) for s in sites)  # noqa: E731, B023
        got = {r.i: r.near for r in geo.near_flag(given, held, "near", strict=strict).collect()}
        assert got == {-1: False, **{i: near(p) for i, p in enumerate(points)}}
    assert not any(r.near for r in geo.near_flag(given, held.where("x > 1e9"), "near").collect())


def planar(a, b):
    return math.sqrt(((a[0] - b[0]) * 111.2) ** 2 + ((a[1] - b[1]) * 111.2 * math.cos(math.radians(a[0]))) ** 2)


@pytest.mark.parametrize("within", [None, 40.0, 3.0])
@pytest.mark.parametrize("about_place", [False, True])
def test_nearest_places(spark, within, about_place):
    turn = random.Random(9)
    spot = lambda: (turn.uniform(-88, 88), turn.uniform(-180, 180)) if turn.random() < 0.3 else (turn.gauss(53, 1), turn.gauss(-2, 1))
    places = [spot() for _ in range(120)]
    places += places[:10]  # ties go to the lower ord
    points = [spot() for _ in range(300)] + places[:5]
    held = spark.createDataFrame([(i, f"p{i}", *p) for i, p in enumerate(places)] + [(999, "nowhere", None, 1.0)], "ord int, name string, lat double, lon double")
    given = spark.createDataFrame([(i, *p) for i, p in enumerate(points)] + [(-1, None, 1.0)], "i long, lat double, lon double")
    got = {r.i: (r.place, r.place_km) for r in geo.nearest_place(given, held, "lat", "lon", within_km=within, otherwise="none", about_place=about_place).collect()}
    assert got.pop(-1) == ("none", None)
    for i, p in enumerate(points):
        km, k = min((planar(q, p) if about_place else planar(p, q), k) for k, q in enumerate(places))
        if within is None or km < within:
            assert got[i][0] == f"p{k}" and abs(got[i][1] - km) < 1e-6, p
        else:
            assert got[i] == ("none", None), p
