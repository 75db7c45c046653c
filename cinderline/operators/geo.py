"""Spatial predicates as equi joins on cells, with the exact test as a residual condition.

Sites, polygons and named places are dimensions: they are gathered by cell into small arrays, so that a detection meets those of
its cell in one join and no detection is multiplied. Spark broadcasts them when they are small and shuffles otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import checkpoint_with, gathered, small


def cell(c: Column, size: Column | float) -> Column:
    return F.floor(c / size).cast("bigint")


def around(c: Column, size: float, reach: Column | float) -> Column:
    """The cells that a stretch of `reach` to either side of c meets."""
    return F.explode(F.sequence(cell(c - reach, size), cell(c + reach, size)))


def near_flag(points: DataFrame, sites: DataFrame, name: str, *, strict: bool = False, least_size: float = 1000.0) -> DataFrame:
    """points (x, y) with a flag: within radius_m of a site (x, y, radius_m). A radius is met inclusively unless strict.

    No sites, or null coordinates or radius: false. Sites may overlap; points are not multiplied. A site lies in the grid whose cells
    are at least as wide as its radius, so in nine cells at most; grids are four times as wide from one to the next, and a point meets
    the cell that it is in once for each grid that is in use.
    """
    held = sites.where("x is not null and y is not null and radius_m is not null")
    level = F.greatest(F.lit(0), F.ceil(F.log(4.0, F.greatest(F.col("radius_m"), F.lit(least_size)) / least_size) - 1e-9)).cast("int")
    held = held.select("x", "y", F.col("radius_m").cast("double").alias("radius_m"), level.alias("_level")).withColumn("s", F.struct("x", "y", "radius_m"))

    def meets(s: Column) -> Column:
        d2 = (s["x"] - F.col("x")) * (s["x"] - F.col("x")) + (s["y"] - F.col("y")) * (s["y"] - F.col("y"))
        return d2 < s["radius_m"] * s["radius_m"] if strict else d2 <= s["radius_m"] * s["radius_m"]

    out, near = points, F.lit(False)
    # a number for each power of four of the radius
    for k, n in sorted(tuple(r) for r in held.groupBy("_level").count().collect()):
        size, cx, cy = least_size * 4.0**k, f"_cx{k}", f"_cy{k}"
        laid = gathered(held.where(F.col("_level") == k), n).select("s", "y", "radius_m", around(F.col("x"), size, F.col("radius_m")).alias(cx))
        laid = laid.select("s", cx, around(F.col("y"), size, F.col("radius_m")).alias(cy)).groupBy(cx, cy).agg(F.collect_list("s").alias(f"_sites{k}"))
        out = out.withColumn(cx, cell(F.col("x"), size)).withColumn(cy, cell(F.col("y"), size)).join(small(laid, 9 * n), [cx, cy], "left")
        near = near | F.coalesce(F.exists(f"_sites{k}", meets), F.lit(False))
    return out.withColumn(name, near).select(*points.columns, name)


def edges(rings: DataFrame) -> DataFrame:
    """Edges (x1, y1, x2, y2) of rings of vertices (ring, seq, x, y); the last vertex is joined to the first."""
    order = Window.partitionBy("ring").orderBy("seq")
    first = F.first(F.struct("x", "y")).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    onward = F.coalesce(F.lead(F.struct("x", "y")).over(order), first)
    out = rings.select(F.col("x").alias("x1"), F.col("y").alias("y1"), onward.alias("n"))
    return out.select("x1", "y1", F.col("n.x").alias("x2"), F.col("n.y").alias("y2")).where("x1 <> x2 or y1 <> y2")


COVER = (32_000.0, 2_000.0)


def _touched(sides: DataFrame, size: float, reach: float) -> DataFrame:
    """(cx, cy, s): cells that an edge s comes as near to as `reach`. An edge is cut into rows of cells, and meets those of its part."""
    reach += 0.001
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = sides.withColumn("cy", F.explode(F.sequence(cell(low - reach, size), cell(high + reach, size))))
    at = lambda y: F.when(F.col("y1") == F.col("y2"), None).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (y - F.col("y1")) / (F.col("y2") - F.col("y1")))))
    down, up = at(F.col("cy") * size - reach), at((F.col("cy") + 1) * size + reach)
    x = lambda t, other: F.col("x1") + F.coalesce(t, F.lit(other)) * (F.col("x2") - F.col("x1"))
    a, b = x(down, 0.0), x(up, 1.0)
    cells = F.explode(F.sequence(cell(F.least(a, b) - reach, size), cell(F.greatest(a, b) + reach, size)))
    return rows.select(cells.alias("cx"), "cy", F.struct("x1", "y1", "x2", "y2").alias("s"))


def _crossing(s: Column, y: Column) -> Column:
    """Where the edge crosses the level y; an edge has its lower end, and not its upper one."""
    return (s["x2"] - s["x1"]) * (y - s["y1"]) / (s["y2"] - s["y1"]) + s["x1"]


def _centres_inside(cells: DataFrame, sides: DataFrame, size: float) -> DataFrame:
    """cells (cx, cy) with inside: their centres are, by a running count of the crossings along each row of cells."""
    y = (F.col("cy") + 0.5) * size
    low, high = cell(F.least("y1", "y2"), size), cell(F.greatest("y1", "y2"), size)
    crossed = sides.withColumn("cy", F.explode(F.sequence(low, high))).where((F.col("y1") > y) != (F.col("y2") > y))
    own = F.struct("x1", "y1", "x2", "y2")
    both = cells.select("cx", "cy", ((F.col("cx") + 0.5) * size).alias("_x")).unionByName(crossed.select(F.lit(None).cast("bigint").alias("cx"), "cy", _crossing(own, y).alias("_x")))
    row = Window.partitionBy("cy")
    beyond = F.count_if(F.col("cx").isNull()).over(row) - F.count_if(F.col("cx").isNull()).over(row.orderBy("_x").rangeBetween(Window.unboundedPreceding, 0))
    return both.withColumn("inside", beyond % 2 == 1).where("cx is not null").drop("_x")


def polygon_cover(sides: DataFrame, *, reach: float = 0.0, sizes: tuple[float, ...] = COVER) -> tuple[DataFrame, int]:
    """(level, cx, cy, inside, sides): cells that cover polygons, of several sizes from coarse to fine, each a multiple of the next; and how
    many cells and edges in cells there are.

    A cell that no edge comes as near to as `reach` is inside or outside as a whole. Others are split, down to the finest size, where
    they hold the edges near them, and whether their centre is inside. What no cell covers is outside. Written, as it is read often.
    """
    n = F.count(F.lit(1)).alias("n")
    sides, seen = checkpoint_with(sides.select("x1", "y1", "x2", "y2"), n)
    few = seen["n"] <= 2000  # then all is done in one task, at one go
    sides = gathered(sides, seen["n"], 2000)
    extent = sides.agg(*[f(g(f"{c}1", f"{c}2")).alias(f"{c}{n}") for c in "xy" for n, f, g in (("0", F.min, F.least), ("9", F.max, F.greatest))]).where("x0 is not null")
    stretch = lambda c: F.explode(F.sequence(cell(F.col(f"{c}0") - reach, sizes[0]), cell(F.col(f"{c}9") + reach, sizes[0])))
    cells = extent.withColumn("cx", stretch("x")).withColumn("cy", stretch("y")).select("cx", "cy")
    out = []
    for k, size in enumerate(sizes):
        last = k == len(sizes) - 1
        near = _touched(sides, size, reach).groupBy("cx", "cy").agg(F.collect_list("s").alias("sides") if last else F.lit(True).alias("split"))
        found = _centres_inside(cells, sides, size).join(near, ["cx", "cy"], "left")
        if last:
            out.append(found.select(F.lit(k).alias("level"), "cx", "cy", "inside", "sides"))
        else:
            if not few:
                found, _ = checkpoint_with(found, n)
            out.append(found.where("split is null").select(F.lit(k).alias("level"), "cx", "cy", "inside", F.lit(None).cast("array<struct<x1:double,y1:double,x2:double,y2:double>>").alias("sides")))
            parts = round(size / sizes[k + 1])
            steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(parts) for j in range(parts)]))
            cells = found.where("split").select("cx", "cy", steps.alias("s")).select((F.col("cx") * parts + F.col("s.i")).alias("cx"), (F.col("cy") * parts + F.col("s.j")).alias("cy"))
    held, seen = checkpoint_with(reduce(DataFrame.unionByName, out), F.sum(1 + F.coalesce(F.size("sides"), F.lit(0))).alias("n"))
    return held, seen["n"] or 0


def inside_flag(points: DataFrame, sides: DataFrame, name: str, *, buffer_m: float = 0.0, sizes: tuple[float, ...] = COVER) -> DataFrame:
    """points (x, y) with a flag: inside the polygons by the even-odd rule, or less than buffer_m from an edge.

    Holes and several parts follow from the rule. A point looks up its cell of each size in the polygons' cover. Only in the finest
    cells that edges come near to does it meet edges, those of its cell: the edges between it and the cell's centre tell whether both
    are on one side. Points with null coordinates are outside; a point on an edge itself counts as on either side.
    """
    cover, n = polygon_cover(sides, reach=buffer_m, sizes=sizes)
    x, y = F.col("x"), F.col("y")
    out = points
    for k, size in enumerate(sizes):
        held = cover.where(F.col("level") == k).select(F.col("cx").alias(f"_x{k}"), F.col("cy").alias(f"_y{k}"), F.col("inside").alias(f"_in{k}"), *([F.col("sides").alias("_sides")] if k == len(sizes) - 1 else []))
        out = out.withColumns({f"_x{k}": cell(x, size), f"_y{k}": cell(y, size)}).join(small(held, n), [f"_x{k}", f"_y{k}"], "left")
    last, size = len(sizes) - 1, sizes[-1]
    mx, my = (F.col(f"_x{last}") + 0.5) * size, (F.col(f"_y{last}") + 0.5) * size

    def parts(s: Column) -> Column:
        """The edge lies between the point and the centre, on a way first up or down and then along the centre's level."""
        level = (s["y2"] - s["y1"]) * (x - s["x1"]) / (s["x2"] - s["x1"]) + s["y1"]
        first = ((s["x1"] > x) != (s["x2"] > x)) & ((level > y) != (level > my))
        then = ((s["y1"] > my) != (s["y2"] > my)) & ((_crossing(s, my) > x) != (_crossing(s, my) > mx))
        return F.coalesce(first, F.lit(False)) != F.coalesce(then, F.lit(False))

    inside = F.coalesce(*[F.col(f"_in{k}") for k in range(last)], F.col(f"_in{last}") != (F.size(F.filter("_sides", parts)) % 2 == 1), F.col(f"_in{last}"), F.lit(False))
    if buffer_m:

        def close(s: Column) -> Column:
            dx, dy = s["x2"] - s["x1"], s["y2"] - s["y1"]
            t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - s["x1"]) * dx + (y - s["y1"]) * dy) / (dx * dx + dy * dy)))
            ox, oy = x - (s["x1"] + t * dx), y - (s["y1"] + t * dy)
            return ox * ox + oy * oy < buffer_m * buffer_m

        inside = inside | F.coalesce(F.exists("_sides", close), F.lit(False))
    return out.withColumn(name, inside).select(*points.columns, name)


def planar_km(lat: Column, lon: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in km on a plane that touches at the first point."""
    return F.sqrt(F.pow((lat - lat2) * 111.2, F.lit(2.0)) + F.pow((lon - lon2) * 111.2 * F.cos(F.radians(lat)), F.lit(2.0)))


def _lon_width(band: Column, km: float) -> Column:
    """Degrees of longitude that are at least km wide, on a plane that touches anywhere in a band of latitude or the ones next to it."""
    size = km / 111.2
    most = F.least(F.lit(89.0), F.greatest(F.abs((band - 1) * size), F.abs((band + 2) * size)))
    return size / F.cos(F.radians(most))


def grid_cell(lat: Column, lon: Column, km: float) -> list[Column]:
    """(band, column) of a place on a grid whose cells are km high, and at least km wide."""
    band = cell(lat, km / 111.2)
    return [band, cell(lon, _lon_width(band, km))]


def around_cell(df: DataFrame, lat: str, lon: str, km: float, names: tuple[str, str]) -> DataFrame:
    """df with the nine cells in and around a place's own; all that is within km of it, up to 89 degrees of latitude, is in them."""
    out = df.withColumn(names[0], around(F.col(lat), km / 111.2, F.lit(km / 111.2)))
    width = _lon_width(F.col(names[0]), km)
    return out.withColumn(names[1], around(F.col(lon), width, width))


def nearest_place(points: DataFrame, places: DataFrame, lat: str, lon: str, *, within_km: float | None, otherwise: str | None, first_km: float = 5.0, about_place: bool = False) -> DataFrame:
    """points with place and place_km: the nearest of places (ord, name, lat, lon) less than within_km away, or anywhere if that is
    None; ties go to the lower ord. Where there is none, or a coordinate is null, `otherwise` and null.

    A point looks at the places in and around its cell of a grid, first a fine one, then ones four times as wide, up to within_km or
    the whole world. It is done as soon as the nearest place so far is no further away than the cells that it has seen reach. So a
    point that has a place near by meets few, however many there are. about_place: the plane of distances touches at the place.
    """
    world = 360.0 * 111.2
    most = world if within_km is None else within_km
    sizes = [min(first_km, most)]
    while sizes[-1] < most:
        sizes.append(min(sizes[-1] * 4.0, most))
    at, out = F.struct("ord", "name", "lat", "lon"), points
    held = places.where("lat is not null and lon is not null").select(at.alias("p"), "lat", "lon")
    for k, km in enumerate(sizes):
        names = (f"_b{k}", f"_c{k}")
        laid = around_cell(held, "lat", "lon", km, names).groupBy(*names).agg(F.collect_list("p").alias("_places"))
        own = dict(zip(names, grid_cell(F.col(lat), F.col(lon), km), strict=True))
        out = out.withColumns(own).join(laid, list(names), "left")
        ends = (F.col(lat), F.col(lon))
        apart = lambda p: planar_km(p["lat"], p["lon"], *ends) if about_place else planar_km(*ends, p["lat"], p["lon"])
        one = lambda p: F.struct(apart(p).alias("km"), p["ord"].alias("ord"), p["name"].alias("name"))
        found = F.array_min(F.transform("_places", one) if within_km is None else F.filter(F.transform("_places", one), lambda b: b["km"] < within_km))
        furthest = F.least(F.lit(90.0), F.greatest(F.abs((F.col(names[0]) - 1) * km / 111.2), F.abs((F.col(names[0]) + 2) * km / 111.2)))
        reach = F.least(F.lit(km), 111.2 * _lon_width(F.col(names[0]), km) * F.cos(F.radians(furthest))) * (1 - 1e-9)
        # a point that is done looks no further
        out = out.withColumn("_best", F.when(F.col("_done"), F.col("_best")).otherwise(found) if k else found)
        out = out.withColumn("_done", F.coalesce(F.col("_best.km") <= reach, F.lit(False))).drop("_places", *names)
    return out.select(*points.columns, F.coalesce("_best.name", F.lit(otherwise)).alias("place"), F.col("_best.km").alias("place_km"))


def space_time_pairs(df: DataFrame, key: str, *, eps_m: float, gap_days: int) -> DataFrame:
    """(a, b, d2, days) of rows (x, y, day) no more than eps_m and gap_days apart, a < b; d2 is the squared distance.

    Each row lies in one cell of eps_m by eps_m by gap_days; its partners are in that cell or next to it. A cell asks the half of
    its neighbours that come after it, and itself, so that a pair is met once and rows are multiplied 14-fold on one side only.
    """
    span = max(gap_days, 1)
    laid = df.select(F.col(key).alias("k"), "x", "y", "day", cell(F.col("x"), eps_m).alias("cx"), cell(F.col("y"), eps_m).alias("cy"), cell(F.col("day"), float(span)).alias("ct"))
    half = [(i, j, t) for i in (-1, 0, 1) for j in (-1, 0, 1) for t in (-1, 0, 1) if (i, j, t) >= (0, 0, 0)]
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(t).alias("t")) for i, j, t in half]))
    asks = laid.withColumn("s", steps).select(F.col("k").alias("k1"), F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("day").alias("day1"), (F.col("cx") + F.col("s.i")).alias("cx"), (F.col("cy") + F.col("s.j")).alias("cy"), (F.col("ct") + F.col("s.t")).alias("ct"), (F.struct("s.i", "s.j", "s.t") == F.struct(F.lit(0), F.lit(0), F.lit(0))).alias("own"))
    met = asks.join(laid, ["cx", "cy", "ct"]).withColumn("d2", (F.col("x") - F.col("x1")) * (F.col("x") - F.col("x1")) + (F.col("y") - F.col("y1")) * (F.col("y") - F.col("y1"))).withColumn("days", F.abs(F.col("day") - F.col("day1")))
    met = met.where((F.col("d2") <= eps_m * eps_m) & (F.col("days") <= gap_days) & (~F.col("own") | (F.col("k1") < F.col("k"))))
    return met.select(F.least("k1", "k").alias("a"), F.greatest("k1", "k").alias("b"), "d2", F.col("days").cast("int").alias("days"))


# ---- links between groups of rows, without their pairs


def _extent(rows: DataFrame, by: list[str], key: str, *more: Column) -> DataFrame:
    """One row for each group: what x, y and day range over, and rows at the ends of these ranges, which are tried first."""
    spot = F.struct("x", "y", "day")
    ends = [F.min_by(spot, key), F.min_by(spot, "x"), F.max_by(spot, "x"), F.min_by(spot, "y"), F.max_by(spot, "y"), F.min_by(spot, "day"), F.max_by(spot, "day")]
    ranges = F.struct(*[f(c).alias(f"{c}{i}") for c in ("x", "y", "day") for i, f in enumerate((F.min, F.max))])
    return rows.groupBy(*by).agg(*more, ranges.alias("r"), F.array_distinct(F.array(*ends)).alias("ends"))


def _gap(a: Column, b: Column, c: str) -> Column:
    """How far apart two ranges are, 0 where they overlap. Rounding is monotone, so no pair of members is computed as closer."""
    none = F.lit(0) if c == "day" else F.lit(0.0)
    return F.greatest(none, b[f"{c}0"] - a[f"{c}1"], a[f"{c}0"] - b[f"{c}1"])


def _span(a: Column, b: Column, c: str) -> Column:
    """The largest distance between members of two ranges."""
    return F.greatest(b[f"{c}1"] - a[f"{c}0"], a[f"{c}1"] - b[f"{c}0"])


def _bits(settings: list[tuple[float, int]], test) -> Column:
    return reduce(lambda x, y: x.bitwiseOR(y), [F.when(test(eps, gap), F.lit(1 << i)).otherwise(F.lit(0)) for i, (eps, gap) in enumerate(settings)])


def _judged(pairs: DataFrame, settings: list[tuple[float, int]]) -> DataFrame:
    """pairs (r1, ends1, r2, ends2) with `sure`, the settings under which some members are certainly linked, and `may`, those
    under which they could be, beyond the sure ones."""
    r1, r2 = F.col("r1"), F.col("r2")
    sq = lambda f: f(r1, r2, "x") * f(r1, r2, "x") + f(r1, r2, "y") * f(r1, r2, "y")
    pairs = pairs.select("*", sq(_gap).alias("_near"), sq(_span).alias("_far"), _gap(r1, r2, "day").alias("_days"), _span(r1, r2, "day").alias("_most"))
    may = _bits(settings, lambda eps, gap: (F.col("_near") <= eps * eps) & (F.col("_days") <= gap))
    sure = _bits(settings, lambda eps, gap: (F.col("_far") <= eps * eps) & (F.col("_most") <= gap))
    pairs = pairs.select("*", may.alias("_may"), sure.alias("_all")).where("_may <> 0")

    def tried(p: Column, q: Column) -> Column:
        d2 = (q["x"] - p["x"]) * (q["x"] - p["x"]) + (q["y"] - p["y"]) * (q["y"] - p["y"])
        return _bits(settings, lambda eps, gap: (d2 <= eps * eps) & (F.abs(q["day"] - p["day"]) <= gap))

    some = F.aggregate("ends1", F.lit(0), lambda s, p: F.aggregate("ends2", s, lambda t, q: t.bitwiseOR(tried(p, q))))
    sure = F.when(F.col("_may") == F.col("_all"), F.col("_all")).otherwise(F.col("_all").bitwiseOR(some))
    pairs = pairs.withColumn("sure", sure)
    return pairs.withColumn("may", F.col("_may").bitwiseAND(F.bitwise_not("sure"))).drop("_near", "_far", "_days", "_most", "_may", "_all", "r1", "r2", "ends1", "ends2")


def linked_cells(rows: DataFrame, key: str, settings: list[tuple[float, int]], *, tiles: tuple[int, ...] = (64, 1024)) -> tuple[DataFrame, DataFrame]:
    """Single linkage of rows (x, y, day) in time that does not grow with the square of how dense they lie.

    settings: pairs (eps_m, gap_days) that rows may be apart. Returns cells (cx, cy, ct, node, day, n) whose rows are all linked under
    every setting, and links (a, b, mask, t0, t1, ...) between nodes: bit i of mask tells that some row of a and some row of b
    are linked under setting i. node is the least key of the cell, day its first day. A cell lies in a tile (t0, t1, ...) of each of the
    sizes in `tiles` (in cells, fine to coarse); a link has the tile that both its ends lie in, or null.

    Cells are so small that their diagonal is below eps, and span gap_days + 1 days. Two cells are compared by what their rows range
    over, and by the outermost rows: most pairs are settled so. Those that are not go on with the cells of an eighth of the size
    in them, day by day, then a sixty-fourth, and in the end with different places; a pair of cells is dropped once it is settled.
    Rows that lie at one place on one day count once. Rows with nulls are in no cell.
    """
    least, most = min(e for e, _ in settings), max(e for e, _ in settings)
    short, long = min(g for _, g in settings), max(g for _, g in settings)
    size, days = least / 1.5, short + 1
    rows = rows.where(F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("day").isNotNull())
    at = lambda s: [cell(F.col("x"), s).alias("cx"), cell(F.col("y"), s).alias("cy")]
    slot = F.floor(F.col("day") / days).cast("bigint").alias("ct")
    spots = rows.select(F.col(key).alias("key"), "x", "y", "day", *at(size), slot)
    marks = [f"t{i}" for i in range(len(tiles))]
    lies = {m: F.xxhash64(*[F.floor(F.col(c) / s) for c in ("cx", "cy", "ct")]) for m, s in zip(marks, tiles, strict=True)}
    cells, met = checkpoint_with(_extent(spots, ["cx", "cy", "ct"], "key", F.min("key").alias("node"), F.count("*").alias("n")).withColumns(lies), F.count(F.lit(1)).alias("n"))
    cells = small(cells, met["n"], 10_000)  # rows of about a kilobyte

    # pairs of cells: in blocks as wide as a link can reach, a block asks itself and the half of its neighbours that come after it
    wide, late = int(most / size) + 1, max(0, (long - 1) // days + 1)
    block = {"cx": wide, "cy": wide, "ct": max(1, late)}
    own = cells.select("node", "cx", "cy", "ct", "r", "ends", *marks, *[F.floor(F.col(c) / w).alias(f"b{c}") for c, w in block.items()])
    half = [(i, j, t) for i in (-1, 0, 1) for j in (-1, 0, 1) for t in (-1, 0, 1) if (i, j, t) >= (0, 0, 0)]
    asks = own.withColumn("s", F.explode(F.array(*[F.struct(*map(F.lit, s)) for s in half])))
    asks = asks.select(*[F.col(c).alias(f"{c}1") for c in ("node", "cx", "cy", "ct", "r", "ends", *marks)], *[(F.col(f"b{c}") + F.col(f"s.col{i + 1}")).alias(f"b{c}") for i, c in enumerate(block)], (F.col("s") == F.struct(F.lit(0), F.lit(0), F.lit(0))).alias("same"))
    met = asks.join(own.withColumnsRenamed({"r": "r2", "ends": "ends2"}), [f"b{c}" for c in block]).where(~F.col("same") | (F.col("node1") < F.col("node")))
    met = met.where((F.abs(F.col("cx") - F.col("cx1")) <= wide) & (F.abs(F.col("cy") - F.col("cy1")) <= wide) & (F.abs(F.col("ct") - F.col("ct1")) <= late))

    met = met.withColumns({m: F.when(F.col(m) == F.col(f"{m}1"), F.col(m)) for m in marks})
    first = F.col("node1") < F.col("node")
    ends = [F.least("node1", "node").alias("a"), F.greatest("node1", "node").alias("b")]
    sides = [F.when(first, F.col(f"{c}1")).otherwise(F.col(f"{c}2")).alias(f"{c}1") for c in ("r", "ends")] + [F.when(first, F.col(f"{c}2")).otherwise(F.col(f"{c}1")).alias(f"{c}2") for c in ("r", "ends")]
    figures = (F.count(F.lit(1)).alias("n"), F.count_if(F.col("may") != 0).alias("open"))
    judged, seen = checkpoint_with(_judged(met.select(*ends, *marks, *sides), settings), *figures)
    links = [judged.where("sure <> 0").select("a", "b", F.col("sure").alias("mask"), *marks)]
    left = judged.where("may <> 0").select("a", "b", *marks, F.col("may").alias("need"), F.lit(None).cast("string").alias("c1"), F.lit(None).cast("string").alias("c2"))

    # the rows of cells that are left
    for k, part in enumerate((8.0, 64.0, None)):
        if not seen["open"]:
            break
        name = lambda s: F.concat_ws(",", *at(s), "day")
        last = F.lit(None).cast("string") if k == 0 else name(size / 8.0 ** k)
        here = F.concat_ws(",", "x", "y", "day") if part is None else name(size / part)
        asked = left.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.coalesce("c1", F.lit("")).alias("last")), F.struct(F.col("b").alias("node"), F.coalesce("c2", F.lit("")).alias("last")))).alias("s")).select("s.node", "s.last").distinct()
        inside = spots.join(cells.select("cx", "cy", "ct", "node"), ["cx", "cy", "ct"]).select("node", "key", "x", "y", "day", last.alias("last"), here.alias("here"))
        inside = inside.withColumn("last", F.coalesce("last", F.lit(""))).join(asked, ["node", "last"], "left_semi")
        held, _ = checkpoint_with(_extent(inside, ["node", "last", "here"], "key"), F.count(F.lit(1)).alias("n"))
        pairs = left
        for i, end in (("1", "a"), ("2", "b")):
            kids = held.select(F.col("node").alias(end), F.col("last").alias(f"_p{i}"), F.col("here").alias(f"h{i}"), F.col("r").alias(f"r{i}"), F.col("ends").alias(f"ends{i}"))
            pairs = pairs.withColumn(f"_p{i}", F.coalesce(f"c{i}", F.lit(""))).join(kids, [end, f"_p{i}"])
        judged = _judged(pairs.select("a", "b", *marks, "need", "h1", "h2", "r1", "r2", "ends1", "ends2"), settings)
        judged = judged.withColumn("sure", F.col("sure").bitwiseAND(F.col("need"))).withColumn("may", F.col("may").bitwiseAND(F.col("need"))).where("sure <> 0 or may <> 0")
        judged, seen = checkpoint_with(judged, *figures)
        links.append(judged.where("sure <> 0").groupBy("a", "b", *marks).agg(F.bit_or("sure").alias("mask")).select("a", "b", "mask", *marks))
        if not seen["open"]:
            break
        got = links[-1].select("a", "b", F.col("mask").alias("_got"))
        need = F.col("may").bitwiseAND(F.bitwise_not(F.coalesce("_got", F.lit(0))))
        left, seen = checkpoint_with(judged.where("may <> 0").join(got, ["a", "b"], "left").select("a", "b", *marks, need.alias("need"), F.col("h1").alias("c1"), F.col("h2").alias("c2")).where("need <> 0"), F.count(F.lit(1)).alias("open"))
    all_links = reduce(DataFrame.unionByName, links)
    if len(links) > 1:
        all_links = all_links.groupBy("a", "b", *marks).agg(F.bit_or("mask").alias("mask"))
    return cells.select("cx", "cy", "ct", "node", F.col("r.day0").alias("day"), "n", *marks), all_links


def cell_of(eps_m: float, gap_days: int) -> list[Column]:
    """The cell (cx, cy, ct) of a row (x, y, day) that linked_cells lays for these as its least settings."""
    return [cell(F.col("x"), eps_m / 1.5).alias("cx"), cell(F.col("y"), eps_m / 1.5).alias("cy"), F.floor(F.col("day") / (gap_days + 1)).cast("bigint").alias("ct")]
