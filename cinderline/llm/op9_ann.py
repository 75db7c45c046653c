"""Nearest neighbours by cosine, along shifted space-filling curves.

Vectors are scaled to length 1 and projected to a few dimensions, once for each of several curves, each with directions and
a shift of its own. The place of a projected vector on a Hilbert curve is its key: near keys mostly mean near vectors.
Spark range-partitions, sorts and numbers the keys of every curve. The ordering is cut into blocks by these numbers, and a block
also gets the rows next to it, so that no window ends at a border. A query's candidates are the vectors in a window of places around
it on each curve; they are ranked by vectors of two bytes a component, the windows of all curves are merged, and the best of them are
reranked by the exact measure.

What recall a number of curves and a window give depends on how near the neighbours are, and for a window of fixed width it falls as rows
grow. So the window is a share of the rows, and recall on vectors without near neighbours, the hardest kind, holds at any size. Memory
grows with the rows times the number of curves, work besides with the queries times curves times window: see the README.

Equal vectors are one class with the smallest of their ids, so that any number of copies takes one place in a window. Vectors of
different lengths have no cosine; they never meet.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from .common import checkpoint, partitions, table

CURVES, DIMENSIONS, BITS = 48, 7, 9
WINDOW = 320  # places on either side, at least
SHARE = 1 / 156  # of the rows, on either side
BLOCK = 16_384  # places searched together, at least; a window must not be wider
ROUGH = 4  # candidates that stay for each one that is asked for, until the exact measure decides
KEYS = "c long, low long, asks boolean, curve long, key long, code binary"


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with integer coordinates below 2**bits, one row a point."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        p = q - 1
        for i in range(n):
            on = (x[i] & q) > 0
            t = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = top
    while q > 1:
        t = np.where((x[n - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def curve_keys(unit: np.ndarray, curve: int) -> np.ndarray:
    """Keys of vectors of length 1 on one curve."""
    turn = np.random.default_rng([curve, unit.shape[1]])
    m = min(DIMENSIONS, unit.shape[1])
    directions, _ = np.linalg.qr(turn.standard_normal((unit.shape[1], m)))
    at = unit @ directions * np.sqrt(unit.shape[1]) / 6 + 0.5 + turn.uniform(-0.1, 0.1, m)
    return hilbert((at * (1 << BITS)).clip(0, (1 << BITS) - 1), BITS)


def codes(unit: np.ndarray) -> list[bytes]:
    """A scale and two bytes for each component."""
    scale = (np.abs(unit).max(axis=1, keepdims=True) / 32767).astype(np.float32)
    whole = np.round(unit / scale).clip(-32767, 32767).astype(np.int16)
    return [s.tobytes() + b.tobytes() for s, b in zip(scale, whole, strict=True)]


def _rough(held: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(held), dtype=np.uint8).reshape(len(held), -1)
    return np.ascontiguousarray(data[:, 4:]).view(np.int16).astype(np.float32) * np.ascontiguousarray(data[:, :4]).view(np.float32)


def _keys(curves: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for m, own in f.groupby("m"):
                for a in range(0, len(own), 8192):
                    part = own.iloc[a : a + 8192]
                    x = np.stack(part["x"].to_numpy())
                    x = x / np.abs(x).max(axis=1, keepdims=True)
                    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                    code = codes(unit)
                    for curve in range(curves):
                        yield pd.DataFrame({"c": part["c"], "low": part["low"], "asks": part["asks"], "curve": int(m) * curves + curve, "key": curve_keys(unit, curve), "code": code})

    return run


def _windows(k: int, window: int, width: int):
    """The roughly best of each query's window in a block; rows are sorted by block and place."""

    def search(f: pd.DataFrame, block: int) -> pd.DataFrame:
        place, curve, c, low = (f[x].to_numpy() for x in ("place", "curve", "c", "low"))
        asks = np.flatnonzero(f["asks"].to_numpy() & (place // width == block))
        out = []
        for one in np.unique(curve[asks]):  # in order, so the rows of a curve are a range; all have one length
            a, b = np.searchsorted(curve, [one, one + 1])
            rough = _rough(list(f["code"].iloc[a:b]))
            for i in asks[curve[asks] == one]:
                s, e = max(a, i - window), min(b, i + window + 1)
                score = rough[s - a : e - a] @ rough[i - a]
                best = np.argpartition(-score, k)[:k] if len(score) > k else np.arange(len(score))
                out.append(pd.DataFrame({"q": c[i], "c": c[s:e][best], "low": low[s:e][best], "rough": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"q": [], "c": [], "low": [], "rough": []})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, []
        for f in frames:
            for block, own in f.groupby("block", sort=True):
                if block != at and held:
                    yield search(pd.concat(held, ignore_index=True), at)
                    held = []
                at = block
                held.append(own)
        if held:
            yield search(pd.concat(held, ignore_index=True), at)

    return run


def _near_one(x):
    """The vector times the power of two that brings its largest component near 1, so that no product overflows or vanishes; such a
    multiplication rounds nothing, and the cosine stays what it is."""
    power = F.greatest(F.lit(-1000.0), F.least(F.lit(1000.0), -F.floor(F.log2(F.array_max(F.transform(x, F.abs))))))
    return F.transform(x, lambda v: v * F.pow(F.lit(2.0), power))


def _cosine(a: str, b: str):
    product = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda n, p: n + p)
    return product(a, b) / (F.sqrt(product(a, a)) * F.sqrt(product(b, b)))


def search(df: DataFrame, key: str, vector: str, asks, k: int, *, curves: int = CURVES, window: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where `asks` holds, its k nearest others by cosine, ties by smaller key.

    Null keys, and vectors that are null, empty, zero or hold null or non-finite components, take no part. A vector's neighbours have
    its length. Fewer than k others give fewer rows; an empty table gives none. Rows of one key are the same row to their query.
    Other columns of df are not looked at. Vectors of any finite size are compared, tiny and huge ones too. window: places on either
    side of a query; by default SHARE of the different vectors, and WINDOW at least.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("x"), asks.alias("asks")).where("id is not null and size(x) > 0")
    fine = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0)
    # 64 bits stand for a vector
    rows = rows.where(F.coalesce(fine, F.lit(False))).withColumn("c", F.xxhash64("x"))
    classes = checkpoint(rows.groupBy("c").agg(F.first("x").alias("x"), F.max("asks").alias("asks"), F.min("id").alias("low")).withColumn("x", _near_one(F.col("x"))).withColumn("m", F.size("x")))
    if window is None:
        window = max(WINDOW, math.ceil(classes.count() * SHARE))
    width = max(BLOCK, window)

    keyed = checkpoint(classes.mapInPandas(_keys(curves), KEYS))  # a partitioning by range reads its input twice
    placed = number_rows(keyed, [F.col("curve"), F.col("key"), F.col("c")], "place")
    at = lambda shift: F.floor((F.col("place") + shift) / width)
    blocks = placed.withColumn("block", F.explode(F.array_distinct(F.array(at(-window), at(0), at(window)))))
    blocks = blocks.repartition(max(2, partitions(spark)), "block").sortWithinPartitions("block", "place")
    some = ROUGH * (k + 1)
    found = blocks.mapInPandas(_windows(some, window, width), "q long, c long, low long, rough double").groupBy("q", "c", "low").agg(F.max("rough").alias("rough"))
    found = found.withColumn("at", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("rough"), "low", "c"))).where(F.col("at") <= some)

    one = classes.select("c", "x")
    exact = found.select("q", "c").join(one, "c").join(one.select(F.col("c").alias("q"), F.col("x").alias("y")), "q")
    exact = checkpoint(exact.select("q", "c", _cosine("y", "x").alias("score")))
    # of copies, the k + 1 smallest ids will do, since a query leaves out itself only
    few = rows.join(exact.select("c").distinct(), "c", "left_semi").select("c", "id").distinct()
    few = few.withColumn("at", F.row_number().over(Window.partitionBy("c").orderBy("id"))).where(F.col("at") <= k + 1)
    ids = few.groupBy("c").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    listed = exact.join(ids, "c").select("q", "score", F.explode("ids").alias("vec_id"))
    listed = listed.withColumn("at", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).where(F.col("at") <= k + 1)
    answers = listed.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("at", "vec_id", "score"))).alias("near"))
    out = rows.where("asks").select("id", "c").distinct().join(answers, F.col("c") == F.col("q"))
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("id")), 1, k)
    return out.select(F.col("id").alias("query_id"), F.posexplode(others).alias("rank", "x")).select("query_id", (F.col("rank") + 1).alias("rank"), "x.vec_id", "x.score")


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    asks = F.coalesce(F.pmod(F.col("vec_id"), F.lit(50)) == 0, F.lit(False))
    return search(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", asks, 5)


_DOT = "list_reduce(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * {b}.x[i]), lambda p, q: p + q)"
# all queries against all rows
_SQL = f"""WITH v AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0),
 a AS MATERIALIZED (SELECT *, {_DOT.format(b="a")} AS n FROM v AS a WHERE len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
 s AS (SELECT DISTINCT a.vec_id AS query_id, b.vec_id, {_DOT.format(b="b")} / (sqrt(a.n) * sqrt(b.n)) AS score FROM a JOIN a AS b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id AND len(a.x) = len(b.x))
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""

QUERIES = {"op9_ann": op9_ann}
ORACLE: dict[str, str] = {"op9_ann": _SQL}
