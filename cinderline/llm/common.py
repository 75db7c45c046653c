"""Helpers that the text operators share: reading, checkpoints, row keys, batches of texts."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import checkpoint, shared_folder  # noqa: F401
from ..operators.numbering import number_rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; null for a null key."""
    return F.pmod(F.crc32(key.cast("string")), F.lit(n))


def held_out(key: Column, n: int, r: int) -> Column:
    """True on the fold that no model learns from. A null key is on no fold: neither held out nor learned from."""
    return F.coalesce(remainder(key, n) == r, F.lit(False))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """From now on, batches that go to Python have so many rows at most: texts can be long, and a worker holds a batch or two."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def give_back() -> None:
    """At the end of a task: memory that a worker has freed goes back to the system, since workers live on beside those of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def pieces(frames: Iterator[pd.DataFrame], text: str, most: int = 1_500_000) -> Iterator[pd.DataFrame]:
    """Rows in pieces of about `most` characters; a longer text is a piece of its own and stays whole."""
    for frame in frames:
        sizes = frame[text].str.len().fillna(0).to_numpy()
        start = total = 0
        for i, n in enumerate(sizes):
            if i > start and total + n > most:
                yield frame.iloc[start:i]
                start, total = i, 0
            total += n
        if start < len(frame):
            yield frame.iloc[start:]
    give_back()


def keyed(df: DataFrame, key: str, text: str, *, whole: bool = False) -> DataFrame:
    """(d, r, t, and with `whole` the row as a struct): a document's place (d, r) in the order of documents, and its text.

    d is the key and r is 0 where a key is unique. Rows of one key count as documents of their own, in the order of their texts; rows of
    null keys come first and have r < 0, so no value of a key is taken for null. Only rows of null and repeated keys are sorted for
    this; equal ones among them are told apart by where they were read, so no task holds all rows of a key, even if all are equal.
    """
    short_batches(df.sparkSession)
    columns = [F.col(f"`{key}`").cast("bigint").alias("d"), F.col(f"`{text}`").alias("t"), *([F.struct("*").alias("row")] if whole else [])]
    seen = df.agg(F.count("*").alias("n"), F.count_distinct(F.col(f"`{key}`")).alias("k")).first()
    df = df.select(*columns)
    rest = ["t", "row"] if whole else ["t"]
    known = F.coalesce("d", F.lit(-(1 << 63))).alias("d")  # never null, as Spark can see: so inner and left joins read the same rows
    if seen["n"] == seen["k"]:
        return df.select(known, F.lit(0).cast("bigint").alias("r"), *rest)
    again = checkpoint(df.where("d is not null").groupBy("d").count().where("count > 1").select("d"))
    single = df.where("d is not null").join(again, "d", "left_anti").select(known, F.lit(0).cast("bigint").alias("r"), *rest)
    others = df.where("d is null").unionByName(df.join(again, "d", "left_semi")).withColumn("_read", F.monotonically_increasing_id())
    placed = number_rows(checkpoint(others), [F.col("d").asc_nulls_first(), F.col("t").asc_nulls_first(), F.col("_read")], "place")
    return single.unionByName(placed.select(known, F.when(F.col("d").isNull(), F.col("place") - (1 << 62)).otherwise(F.col("place")).cast("bigint").alias("r"), *rest))


def binary(text: str = "t") -> Column:
    """The text as bytes, empty for null."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


def key_of(d: str = "d", r: str = "r") -> Column:
    """The key of the document at (d, r); null for rows of null keys."""
    return F.when(F.col(r) >= 0, F.col(d))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, label: str, per_label: int) -> tuple[DataFrame, dict[int, int]]:
    """(docs with a label of 0 or 1, how many labels of each kind there are).

    About per_label of the labels of either kind are drawn by a hash of the key, and 3 * per_label rows are kept at most in
    all; so the drawn labels can be broadcast, and documents do not move.
    """
    labels = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(key, F.col(label).cast("int").alias(label)).distinct()
    totals = {r[label]: r["count"] for r in labels.groupBy(label).count().collect()}
    drawn = F.lit(False)
    for k, n in totals.items():
        drawn = drawn | ((F.col(label) == k) & (F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 20)) < min(1.0, per_label / n) * (1 << 20)))
    some = labels.where(drawn).orderBy(F.xxhash64(key), key, label).limit(3 * per_label)
    return docs.join(F.broadcast(some), key), totals


# SQL for crc32, which states results: a table of its 256 steps
CRC_TABLE = "crcs AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) AS r(i)))"


def crc32_sql(values: str) -> str:
    """SQL for the crc32 of a list of bytes as BIGINT, beside the table `crcs`."""
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {values}), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)"
