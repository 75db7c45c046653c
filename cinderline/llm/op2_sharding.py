"""Sharding by jump consistent hashing, in DataFrame expressions only.

A row's shard depends on its key and the number of shards alone. The chain of jumps of a key is fixed:
from shard b the next one is floor((b + 1) / u), u in (0, 1] drawn from (key, b). The shard among n is the last
link below n, so going from n to n + 1 shards moves just the rows whose next link is n, about 1 in n + 1, and
moves them to the new shard only. There is no ring table and nothing to store.

Slots number the rows of a shard without gaps. A shard is not sorted in one task: its rows lie in buckets by a
hash of the key, a count of the buckets gives each its first slot, and rows are numbered within their bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import CRC_TABLE, crc32_sql, table

DIGITS = 13  # of an md5 sum in hexadecimal, 52 bits, which a double holds


def _number(key: Column, what: Column) -> Column:
    """A whole number of 52 bits that follows from the key as text alone, and so is the same in every engine; null is a key of its own."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", key.cast("string"), what.cast("string")).cast("binary")), 1, DIGITS), 16, 10).cast("bigint")


def _draw(key: Column, b: Column) -> Column:
    """Uniform in (0, 1], from the key and the shard the key stands on."""
    return (_number(key, b) + F.lit(1)) / F.lit(float(1 << 4 * DIGITS))


def jump(key: Column, shards: int) -> Column:
    """Struct (b, j): the shard of the key among `shards`, and the next link of its chain (>= shards).

    Null keys count as a key of their own. The chain rises by one at least with each step, so `shards` steps suffice;
    steps past the end are not evaluated.
    """
    start = F.struct(F.lit(0).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("j"))

    def step(s: Column, _: Column) -> Column:
        onward = F.least(F.floor((s["j"] + 1) / _draw(key, s["j"])), F.lit(1 << 40))
        return F.when(s["j"] < shards, F.struct(s["j"].alias("b"), onward.alias("j"))).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step)


def shard(df: DataFrame, key: str, shards: int, *, buckets: int = 1024) -> DataFrame:
    """All rows and columns of df, with shard, grown_shard (among shards + 1) and slot (from 0, gapless in a shard).

    Rows of equal keys share a shard and stand next to each other in an unspecified order. Null keys share one shard.
    buckets bounds the table of first slots to shards * buckets rows, which is what is broadcast.
    An empty table gives an empty result. The three names replace columns of df that are called so.
    """
    k = F.col(key)
    bucket = bucket_of(k, buckets)
    kept = [c for c in df.columns if c.lower() not in ("shard", "grown_shard", "slot")]
    own = F.struct(*[F.col(f"`{c}`") for c in kept])
    placed = df.select(own.alias("row"), k.alias("key"), jump(k, shards).alias("link"))
    placed = placed.select("row", "key", F.col("link.b").cast("int").alias("shard"), F.when(F.col("link.j") == shards, shards).otherwise(F.col("link.b")).cast("int").alias("grown"), bucket_of(F.col("key"), buckets).alias("bucket"))
    counts = df.select(jump(k, shards)["b"].cast("int").alias("shard"), bucket.alias("bucket")).groupBy("shard", "bucket").count()
    first = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "bucket", F.coalesce(F.sum("count").over(first), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "bucket").orderBy("key")
    numbered = placed.withColumn("place", F.row_number().over(inside)).join(F.broadcast(counts), ["shard", "bucket"])
    return numbered.select(*[F.col("row")[c].alias(c) for c in kept], F.col("shard"), (F.col("first") + F.col("place") - 1).alias("slot"), F.col("grown").alias("grown_shard"))


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(_number(key, F.lit("bucket")), F.lit(buckets))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 8).alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
    return shard(rows, "doc_id", 24).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


_NUMBER = f"('0x' || substr(md5(concat_ws(':', CAST(doc_id AS VARCHAR), CAST({{}} AS VARCHAR))), 1, {DIGITS}))::BIGINT"
_SQL = f"""WITH RECURSIVE
 links AS (SELECT doc_id, 0::BIGINT AS b, 0::BIGINT AS j FROM documents
  UNION ALL SELECT doc_id, j, least(floor((j + 1) / (({_NUMBER.format("j")} + 1) / {float(1 << 4 * DIGITS)}::DOUBLE)), {1 << 40})::BIGINT FROM links WHERE j < 24),
 placed AS (SELECT doc_id, b AS shard, CASE WHEN j = 24 THEN 24 ELSE b END AS grown, row_number() OVER (PARTITION BY b ORDER BY {_NUMBER.format("'bucket'")} % 1024, doc_id) - 1 AS slot FROM links WHERE j >= 24),
 {CRC_TABLE},
 sums AS (SELECT doc_id, CAST(coalesce(strlen(text), 0) + 8 AS BIGINT) AS size, CASE WHEN text IS NOT NULL THEN {crc32_sql("list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda y: ('0x' || y)::BIGINT)")} END AS text_crc32 FROM documents, crcs)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INT) AS shard, slot, CAST(grown AS INT) AS grown_shard FROM placed JOIN sums USING (doc_id)"""

QUERIES = {"op2_sharding": op2_sharding}
ORACLE: dict[str, str] = {"op2_sharding": _SQL}
