"""Connected components of a graph of pairs: contraction within groups of edges, then alternating large-star and small-star steps."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. One of this machine is taken only where Spark runs in a single process."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not context.master.split("[")[0] == "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def checkpoint_with(df: DataFrame, *figures: Column) -> tuple[DataFrame, Row]:
    """A checkpoint, and figures of its rows that are taken while they are written."""
    seen = Observation()
    held = checkpoint(df.observe(seen, *figures))
    return held, Row(**seen.get)


def small(df: DataFrame, rows: int, most: int = 100_000) -> DataFrame:
    """df, to be broadcast if its number of rows, which was counted, is small; else Spark shuffles both sides of its joins."""
    return F.broadcast(df) if rows <= most else df


def gathered(df: DataFrame, rows: int, most: int = 100_000) -> DataFrame:
    """df in one partition if its number of rows, which was counted, is small: what groups or sorts it then needs no shuffle."""
    return df.coalesce(1) if rows <= most else df


def least_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the least node that pairs (a, b) connect each with)."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = np.split(ends, 2)
    root = np.arange(len(nodes))
    while True:
        x, y = root[i], root[j]
        open_ = x != y
        if not open_.any():
            return nodes, nodes[root]
        i, j, x, y = i[open_], j[open_], x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != root[root]).any():
            root = root[root]


def contract(edges: DataFrame, group: str | None, *, most: int = 2_000_000) -> DataFrame:
    """(node, root) of the nodes of edges (a, b): root is the least node that the edges of the node's group connect it with.

    Edges of a group, or all of them where that is None, meet in one task. It holds `most` edges at a time, and in place of those that it has seen the root of each node:
    so its memory is that of the nodes of its groups, which callers bound.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, bound = [], 0, most

        def roots() -> tuple[np.ndarray, np.ndarray]:
            return least_reachable(*(np.concatenate([h[k] for h in held]) for k in (0, 1)))

        for batch in batches:
            held.append(tuple(batch.column(k).to_numpy() for k in (0, 1)))
            n += batch.num_rows
            if n > bound:
                held = [roots()]
                n = len(held[0][0])
                bound = max(most, 2 * n)  # so that the work stays in proportion to the edges
        if held:
            yield pa.RecordBatch.from_pydict(dict(zip(("node", "root"), map(pa.array, roots()), strict=True)))

    own = edges.withColumns({c: F.col(c).cast("bigint") for c in ("a", "b")})
    own = own.coalesce(1).select("a", "b") if group is None else own.repartition(group).select("a", "b")
    return own.mapInArrow(join, "node bigint, root bigint")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a, b) with a > b. Each node's neighbours (in the large step those above it, in the small one those below) are
    linked to the least node around it, itself included."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    met = both.join(least, "a")
    if large:
        met = met.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        met = met.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(least.select("a", F.col("low").alias("b")))
    return met.where("a > b").distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", *, most_rounds: int = 100) -> DataFrame:
    """(node, component) of every node that an edge to another one touches; component is the least node reachable.

    Edges have no direction; loops, repeats and null ends are left out. Each round keeps the edges' number or lowers it; the
    last one leaves an edge from each node to its component. What a round has changed is seen while it is written.
    """
    state = (F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("h"))
    now, before = checkpoint_with(edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst))).select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b")).distinct(), *state)
    for _ in range(most_rounds):
        if not before["n"]:
            break
        now, after = checkpoint_with(_star(_star(now, True), False), *state)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components have not settled")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _onto(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Edges between the roots of their ends; an end without a root stands for itself. Other columns stay."""
    for end in ("a", "b"):
        edges = edges.join(roots.select(F.col("node").alias(end), F.col("root").alias("_root")), end, "left").withColumn(end, F.coalesce("_root", end)).drop("_root")
    return edges.where("a <> b")


def _then(roots: DataFrame, further: DataFrame) -> DataFrame:
    """Roots of roots: (node, root) of the nodes of both."""
    onward = further.select(F.col("node").alias("root"), F.col("root").alias("_next"))
    moved = roots.join(onward, "root", "left").select("node", F.coalesce("_next", "root").alias("root"))
    return moved.unionByName(further.join(roots.select("node"), "node", "left_anti").select("node", "root"))


def tiled_components(edges: DataFrame, groups: list[str], *, at_once: int = 200_000) -> DataFrame:
    """(node, component) as connected_components gives them, for edges (a, b) of integers that lie in tiles.

    groups: columns that name the tile of an edge, from fine to coarse; null where its ends lie in different ones. Edges within a fine
    tile are contracted in one pass, what is left within coarse ones in another, and only edges between coarse tiles go through rounds.
    A tile must hold a bounded number of nodes. Edges are counted; up to at_once of them are contracted in one pass by themselves.
    """
    roots = None
    n = F.count(F.lit(1)).alias("n")
    edges, seen = checkpoint_with(edges.select("a", "b", *groups), n)
    if seen["n"] <= at_once:
        return checkpoint(contract(edges, None)).withColumnRenamed("root", "component")
    left = edges
    for k, group in enumerate(groups):
        if roots is not None:
            left, seen = checkpoint_with(_onto(left, roots).distinct(), n)
            if not seen["n"]:
                return roots.withColumnRenamed("root", "component")
        inside = contract(left.where(F.col(group).isNotNull()), group)
        roots = checkpoint(inside if roots is None else _then(roots, inside))
        left = (edges if k == 0 else left).where(F.col(group).isNull()).select("a", "b", *groups[k + 1 :])
    between = connected_components(_onto(left, roots), "a", "b").withColumnRenamed("component", "root")
    return _then(roots, between).withColumnRenamed("root", "component")
