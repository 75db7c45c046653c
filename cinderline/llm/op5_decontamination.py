"""Benchmark decontamination by SimHash of item-sized windows, in DataFrame expressions only.

Texts are words: lower-case runs of letters and digits. Shingles are five words in a row, as 64-bit hashes.

1. Seeds. A window that is similar to an item holds some of its shingles. So a document's windows of an item's length are
   laid where shingles of that item, two at least if it has as many, say that the item would start.
2. SimHash. A window's fingerprint has a bit set where more than half of its shingles, repeats counted, have it set.
3. Multi-index. Of fingerprints within RADIUS bits of each other, one of BLOCKS blocks of bits differs by RADIUS // BLOCKS bits at
   most. An item stands under all values that are so near to each of its blocks; a join on length, block and the block's value finds
   all such pairs of windows and items.
4. Check. Candidates whose fingerprints are within the radius are compared exactly: the weighted Jaccard similarity of their
   shingles, each weighing as often as it occurs, is 0.8 or more.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import key_of, keyed, table

SHINGLE, SIMILAR = 5, 0.8
RADIUS = 20
BLOCKS, BITS = 8, 8
NEAR = [x for x in range(1 << BITS) if x.bit_count() <= RADIUS // BLOCKS]  # what a block may differ by


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(w: Column) -> Column:
    """Hashes of five words in a row, from each word on that has four after it; all words of a shorter text are one shingle."""
    at = F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))
    return F.when(F.size(w) >= SHINGLE, at).when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " "), F.size(w)))).otherwise(F.array().cast("array<bigint>"))


def simhash(s: Column) -> Column:
    bit = lambda b: F.aggregate(s, F.lit(0), lambda n, x: n + F.shiftrightunsigned(x, b).bitwiseAND(F.lit(1)).cast("int"))
    out = F.lit(0).cast("bigint")
    for b in range(64):
        out = out.bitwiseOR(F.when(bit(b) * 2 > F.size(s), F.lit(1 << b if b < 63 else -(1 << 63)).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return out


def blocks(fingerprint: Column) -> Column:
    """Numbers i << BITS | value of the blocks of a fingerprint."""
    return F.array(*[F.shiftrightunsigned(fingerprint, i * BITS).bitwiseAND(F.lit((1 << BITS) - 1)).bitwiseOR(F.lit(i << BITS)) for i in range(BLOCKS)])


def near_blocks(fingerprint: Column) -> Column:
    """The blocks that one within RADIUS of the fingerprint may hold."""
    return F.flatten(F.transform(blocks(fingerprint), lambda b: F.transform(F.array(*[F.lit(x).cast("bigint") for x in NEAR]), lambda x: b.bitwiseXOR(x))))


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two arrays of shingles."""
    count = lambda s, x: F.size(F.filter(s, lambda y: y == x))
    both = F.aggregate(F.array_distinct(b), F.lit(0), lambda n, x: n + F.least(count(a, x), count(b, x)))
    return both / (F.size(a) + F.size(b) - both)


def contaminated(df: DataFrame, text: str, key: str, items: DataFrame, item_text: str, item_key: str, *, broadcast_rows: int = 2_000_000) -> DataFrame:
    """(key, d, r, item, start, similarity): each document of df and item of which a window is similar, with the best window.

    start is the window's first word, from 0; ties go to the first one. Null and empty texts match nothing. An item of fewer
    than five words matches a document of just these words. Items of equal texts all match. Rows of null or repeated keys
    count as documents of their own (see keyed); a null item key stands in the result as null. Texts are read whole, however long; an
    empty table on either side gives an empty result. Other columns are not looked at, whatever their names are.
    The items' shingles are broadcast if they are `broadcast_rows` at most (24 bytes each), and shuffled beyond that.
    """
    listed = items.select(F.col(item_key).alias("item"), words(F.col(item_text)).alias("w")).where(F.size("w") > 0)
    listed = listed.select("item", F.size("w").alias("length"), shingles(F.col("w")).alias("s")).withColumn("mine", F.xxhash64("item", "s"))
    seeds = listed.select("item", "length", F.size("s").alias("held"), F.posexplode("s").alias("offset", "h"))
    small = listed.agg(F.sum(F.size("s"))).first()[0] or 0
    if small <= broadcast_rows:
        seeds = F.broadcast(seeds)

    docs = keyed(df, key, text)
    whole = docs.select("d", "r", words(F.col("t")).alias("w")).select("d", "r", F.size("w").alias("n"), F.posexplode(shingles(F.col("w"))).alias("at", "h"))
    hits = whole.join(seeds, "h").groupBy("d", "r", "n", "item", "length", "held", (F.col("at") - F.col("offset")).alias("start")).agg(F.count("*").alias("hits"))
    starts = hits.where(F.col("hits") >= F.least(F.lit(2), F.col("held")))
    place = F.greatest(F.lit(0), F.least(F.col("start"), F.col("n") - F.col("length")))
    windows = starts.groupBy("d", "r").agg(F.collect_set(F.struct("length", place.cast("int").alias("start"))).alias("windows"))

    # one select for each step: a column that a lambda uses would be computed anew for each of its elements
    cut = docs.join(windows, ["d", "r"]).select("d", "r", words(F.col("t")).alias("w"), "windows").select("d", "r", shingles(F.col("w")).alias("s"), "windows")
    cut = cut.select("d", "r", "s", F.explode("windows").alias("x")).select("d", "r", "x.length", "x.start", F.slice("s", F.col("x.start") + 1, F.greatest(F.col("x.length") - SHINGLE + 1, F.lit(1))).alias("own"))
    cut = cut.withColumn("mark", simhash(F.col("own")))
    index = listed.select("mine", "length", simhash(F.col("s")).alias("item_mark")).withColumn("block", F.explode(near_blocks(F.col("item_mark"))))
    near = cut.withColumn("block", F.explode(blocks(F.col("mark")))).join(index, ["length", "block"]).where(F.bit_count(F.col("mark").bitwiseXOR(F.col("item_mark"))) <= RADIUS)
    near = near.groupBy("d", "r", "mine", "start").agg(F.first("own").alias("own")).join(listed.select("mine", "item", F.col("s").alias("theirs")), "mine")
    exact = near.select("d", "r", "item", "start", similarity(F.col("own"), F.col("theirs")).alias("similarity")).where(F.col("similarity") >= SIMILAR)
    best = exact.groupBy("d", "r", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best"))
    return best.select(key_of().alias(key), "d", "r", "item", (-F.col("best.back")).alias("start"), F.col("best.similarity").alias("similarity"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contaminated(table(spark, sf_dir, "documents"), "text", "doc_id", table(spark, sf_dir, "benchmark"), "text", "item_id")
    return out.select("doc_id", F.col("item").alias("item_id"), "start", "similarity")


# every window of every document and item that share a shingle
_SQL = f"""WITH
 texts AS (SELECT false AS item, doc_id AS id, text FROM documents UNION ALL SELECT true, item_id, text FROM benchmark),
 split AS (SELECT item, id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS w FROM texts),
 cut AS (SELECT item, id, len(w) AS n, CASE WHEN len(w) >= {SHINGLE} THEN list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' ')) ELSE [array_to_string(w, ' ')] END AS s FROM split WHERE len(w) > 0),
 own AS MATERIALIZED (SELECT id, n, len(s) AS k, unnest(s) AS s, unnest(range(len(s))) AS at FROM cut WHERE NOT item),
 theirs AS MATERIALIZED (SELECT id AS item, n AS length, k, s, count(*) AS c FROM (SELECT id, n, len(s) AS k, unnest(s) AS s FROM cut WHERE item) GROUP BY ALL),
 hits AS MATERIALIZED (SELECT o.id, o.n, o.k AS held, o.at, t.* FROM own o JOIN theirs t ON o.s = t.s),
 windows AS (SELECT DISTINCT id, item, held, k, greatest(length - {SHINGLE - 1}, 1) AS wide, unnest(range(greatest(n - length, 0) + 1)) AS start FROM hits),
 met AS (SELECT w.id, w.item, w.start, w.k, least(w.wide, w.held - w.start) AS mine, least(count(*), h.c) AS shared FROM windows w JOIN hits h ON h.id = w.id AND h.item = w.item AND h.at >= w.start AND h.at < w.start + w.wide GROUP BY w.id, w.item, w.start, w.k, w.wide, w.held, h.s, h.c),
 sums AS (SELECT id, item, start, sum(shared)::BIGINT AS shared, mine + k AS total FROM met GROUP BY id, item, start, mine, k),
 near AS (SELECT id, item, start, shared / (total - shared) AS similarity FROM sums WHERE shared / (total - shared) >= {SIMILAR})
SELECT id AS doc_id, item AS item_id, CAST(arg_min(start, (-similarity, start)) AS INT) AS start, max(similarity) AS similarity FROM near GROUP BY id, item"""

QUERIES = {"op5_decontamination": op5_decontamination}
ORACLE: dict[str, str] = {"op5_decontamination": _SQL}


def brute_force(docs: list[tuple[int, str]], items: list[tuple[int, str]]) -> dict[tuple[int, int], float]:
    """The best similarity over all windows of each pair that reaches SIMILAR; for tests."""
    import regex

    split = lambda t: [w for w in regex.split(r"[^\p{L}\p{N}]+", (t or "").lower()) if w]

    def cut(w: list[str]) -> list[tuple]:
        return [tuple(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)] if len(w) >= SHINGLE else ([tuple(w)] if w else [])

    listed = [(i, len(split(t)), Counter(cut(split(t)))) for i, t in items if split(t)]
    out: dict[tuple[int, int], float] = {}
    for d, t in docs:
        w = split(t)
        own = cut(w)
        there = set(own)
        for i, length, theirs in listed:
            if not there & theirs.keys():
                continue
            n = max(length - SHINGLE + 1, 1)
            for start in range(max(0, len(w) - length) + 1):
                mine = Counter(own[start : start + n])
                both = sum((mine & theirs).values())
                score = both / (sum(mine.values()) + sum(theirs.values()) - both)
                if score >= SIMILAR and score > out.get((d, i), 0):
                    out[d, i] = score
    return out
