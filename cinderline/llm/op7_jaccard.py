"""Exact Jaccard join of documents on word shingles, by a token-group matrix.

A document is the set of its shingles' hashes (64 bits; "tokens" below). Documents of equal sets are one class, which all
work below handles once. Two classes x and y link when they share 4/9 of |x| + |y| tokens or more, which is the same as 80 % of
their union; so each shares 80 % of its own tokens at least.

1. Shared tokens. One shuffle of packed tokens tells how many of a class's tokens any other class holds as well. A class with
   less than 80 % of such tokens links with nothing, and leaves here; most do.
2. Groups. Classes meet under a few least hashes, and each is compared with one leader for each of them. Classes that link so,
   directly or through others, form components; near copies are mostly in one component by then, by links in stars and not in
   pairs. Groups are bounded pieces of a component, of like size and drawn by a hash.
3. The matrix. In a fixed order of tokens, the rarest first, two sets that link share a token early enough for all that they must
   share to follow. A cell (token, group) holds the least size and the most tokens that follow in a class of the group. Classes
   ask the groups of other components, those of larger ones only, that have a cell for such a token.
4. Bound and opening. A group's token union tells how much of a class it can hold at most. Only if that is enough is the group
   opened, and the class compared with each of its members, exactly.

No pair of components that links is missed, whatever the hashes and leaders are; these save work alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from . import bytehash
from .common import binary, checkpoint, give_back, key_of, keyed, partitions, pieces, table

SHINGLE, NEAR = 5, 80  # words of a shingle; least per cent of the union
SIGNS = 6  # least hashes of each class
GROUP_TOKENS = 50_000  # of a group's members, as far as single classes allow
BATCH = 600_000  # tokens that a task packs at once
BROADCAST_ROWS = 400_000  # of up to four numbers each; larger tables are shuffled
PACKED = "kind int, part int, d long, r long, c long, n long, blob binary"


def sets(texts: list[bytes], k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted hashes of each text's shingles of k words; all words of a shorter text are one shingle."""
    hashes, first = bytehash.words(texts)
    grams = bytehash.shingles(hashes, k)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            out.append(bytehash.shingles(hashes[a:b], int(b - a)) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def class_of(s: np.ndarray) -> int:
    """64 bits that stand for the set: a mixed sum over its tokens."""
    x = np.array([bytehash.mix(s ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64) + np.uint64(len(s))], dtype=np.uint64)
    return int(bytehash.mix(x).view(np.int64)[0])


def needed(n):
    """Tokens of a set of n that a linked set holds at least."""
    return -(-NEAR * n // 100)


# ---- 1: shared tokens


def _deal(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(order by part, where each part starts) of keys dealt out by their remainder."""
    part = (keys % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def _counts(c: np.ndarray, n: np.ndarray, shared: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    """Blocks (class, size, shared tokens) by part of the classes."""
    keep = shared > 0
    rows = np.stack([c[keep], n[keep], shared[keep]], axis=1)
    order, cuts = _deal(rows[:, 0].astype(np.int64).view(np.uint64), parts)
    for p in range(parts):
        if cuts[p + 1] > cuts[p]:
            yield p, np.ascontiguousarray(rows[order[cuts[p] : cuts[p + 1]]]).tobytes()


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["kind", "part", "d", "r", "c", "n", "blob"])


def _tokens(parts: int):
    """A row of kind 0 for each document, with its class. For each batch of classes, blocks of kind 1 by token, and of kind 2 with
    the tokens that classes of the batch share with each other; of such a token, the block has one entry that no class owns."""

    def send(own: dict[int, np.ndarray]) -> Iterator[pd.DataFrame]:
        c = np.array([*own, 0], dtype=np.int64)  # the last entry: no class
        n = np.array([*map(len, own.values()), 0], dtype=np.int64)
        token = np.concatenate([np.zeros(0, dtype=np.uint64), *own.values()])
        of = np.repeat(np.arange(len(n), dtype=np.int32), n)
        order = np.argsort(token)
        token, of = token[order], of[order]
        new = np.concatenate([[True], token[1:] != token[:-1]])
        twice = np.diff(np.append(np.flatnonzero(new), len(token))) > 1
        shared = np.bincount(of[np.repeat(twice, np.diff(np.append(np.flatnonzero(new), len(token))))], minlength=len(n))
        rows = [(2, p, 0, 0, 0, 0, b) for p, b in _counts(c, n, shared, parts)]
        token, of = token[new], np.where(twice, len(own), of[new])
        order, cuts = _deal(token, parts)
        for p in range(parts):
            at = order[cuts[p] : cuts[p + 1]]
            if len(at):
                at = at[np.argsort(of[at], kind="stable")]
                used, times = np.unique(of[at], return_counts=True)
                low = (token[at] // np.uint64(parts)).view(np.uint8).reshape(-1, 8)[:, :5]  # a chance match lets a class stay, no more
                cols = [np.array([len(used), len(at)], dtype=np.int64), c[used], n[used].astype(np.int32), times.astype(np.int32), low]
                rows.append((1, p, 0, 0, 0, 0, b"".join(np.ascontiguousarray(x).tobytes() for x in cols)))
        yield _frame(rows)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own: dict[int, np.ndarray] = {}
        held = 0
        for f in pieces(frames, "t"):
            found = sets(list(f["t"]))
            c = [class_of(s) for s in found]
            d = f["d"].to_numpy(dtype=np.int64)
            part = (bytehash.mix(d.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
            yield pd.DataFrame({"kind": 0, "part": part, "d": d, "r": f["r"], "c": c, "n": [len(s) for s in found], "blob": None})
            for x, s in zip(c, found, strict=True):
                if len(s) and x not in own:
                    own[x] = s
                    held += len(s)
            if held > BATCH:
                yield from send(own)
                own, held = {}, 0
        if own:
            yield from send(own)

    return run


def _meet(parts: int):
    """Lets rows of kinds 0 and 2 through; of the tokens of a part, those of more than one class give counts of kind 2."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[bytes]] = {}
        for f in frames:
            blocks = f["kind"] == 1
            if not blocks.all():
                yield f[~blocks]
            for part, blob in zip(f["part"][blocks], f["blob"][blocks], strict=True):
                held.setdefault(part, []).append(blob)
        for part in sorted(held):
            c, n, times, token = [], [], [], []
            for blob in held.pop(part):
                used, m = (int(x) for x in np.frombuffer(blob, np.int64, 2))
                c.append(np.frombuffer(blob, np.int64, used, 16))
                n.append(np.frombuffer(blob, np.int32, used, 16 + 8 * used))
                times.append(np.frombuffer(blob, np.int32, used, 16 + 12 * used))
                wide = np.zeros((m, 8), dtype=np.uint8)
                wide[:, :5] = np.frombuffer(blob, np.uint8, 5 * m, 16 + 16 * used).reshape(m, 5)
                token.append(wide.view(np.uint64).ravel())
            c, n, times, token = (np.concatenate(x) for x in (c, n, times, token))
            of = np.repeat(np.arange(len(c), dtype=np.int32), times)
            order = np.argsort(token)
            token, of = token[order], of[order]
            new = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            size = np.diff(np.append(new, len(token)))
            who, none = c[of], n[of] == 0
            apart = np.logical_or.reduceat((who != np.repeat(who[new], size)) | none, new)  # more classes than the first one
            shared = np.bincount(of[np.repeat(apart, size) & ~none], minlength=len(c))
            yield _frame([(2, p, 0, 0, 0, 0, b) for p, b in _counts(c, n.astype(np.int64), shared, parts)])
        give_back()

    return run


def _enough(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The classes that share as many tokens as a link needs. The counts of a class in several batches add up to too many, if to
    anything wrong."""
    held: dict[int, list] = {}
    for f in frames:
        for part, blob in zip(f["part"], f["blob"], strict=True):
            held.setdefault(part, []).append(np.frombuffer(blob, np.int64).reshape(-1, 3))
    for part in sorted(held):
        rows = np.concatenate(held.pop(part))
        c, first, back = np.unique(rows[:, 0], return_index=True, return_inverse=True)
        n = rows[first, 1]
        yield pd.DataFrame({"c": c[np.bincount(back, rows[:, 2]) >= needed(n)]})


def _own_sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each class with its set, in an order of its own, and the least of its tokens' hashes in SIGNS orders."""
    salts = [np.uint64(0x9E3779B97F4A7C15 * (k + 1) % (1 << 64)) for k in range(SIGNS)]
    for f in pieces(frames, "t"):
        found = sets(list(f["t"]))
        signs = [[int(bytehash.mix(s ^ salt).min().view(np.int64)) for salt in salts] for s in found]
        yield pd.DataFrame({"c": f["c"], "n": [len(s) for s in found], "s": [np.sort(s.view(np.int64)) for s in found], "signs": signs})


# ---- 2: groups


def _held(df: DataFrame) -> DataFrame:
    """df, fixed; to be broadcast if it has few enough rows of a few numbers each, else joined by a shuffle."""
    df = checkpoint(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _links(pairs: DataFrame) -> Column:
    both = F.size(F.array_intersect("s", "ms"))
    return F.lit(100) * both >= F.lit(NEAR) * (F.size("s") + F.size("ms") - both)


def _compare(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Those of the pairs (c, m) of classes that link."""
    pairs = _held(pairs)
    own = known.select("c", "s").join(pairs, "c")
    other = known.select(F.col("c").alias("m"), F.col("s").alias("ms"))
    return own.join(other, "m").where(_links(own)).select("c", "m")


def _labelled(df: DataFrame, labels: DataFrame) -> DataFrame:
    """df with the component of each class; a class that links with nothing is its own."""
    own = labels.select(F.col("node").alias("c"), F.col("component").alias("comp"))
    return df.join(own, "c", "left").withColumn("comp", F.coalesce("comp", "c"))


def _leader_links(known: DataFrame) -> DataFrame:
    signed = known.select("c", F.posexplode("signs").alias("k", "sign"))
    leaders = signed.groupBy("k", "sign").agg(F.min("c").alias("m"), F.count("*").alias("n")).where("n > 1").drop("n")
    return _compare(signed.join(leaders, ["k", "sign"]).where("c != m").select("c", "m").distinct(), known)


def _groups(known: DataFrame, labels: DataFrame) -> DataFrame:
    """(c, n, comp, weight, g): each class with its component, the classes in that, and its group."""
    placed = _labelled(known.select("c", "n"), labels)
    placed = placed.withColumn("band", F.floor(F.log(1.05, "n")))
    weights = _held(placed.groupBy("comp").agg(F.count("*").alias("weight")).where("weight > 1"))
    pieces_of = _held(placed.groupBy("comp", "band").agg(F.ceil(F.sum("n") / GROUP_TOKENS).alias("pieces")).where("pieces > 1"))
    placed = placed.join(weights, "comp", "left").join(pieces_of, ["comp", "band"], "left").withColumns({"weight": F.coalesce("weight", F.lit(1)), "pieces": F.coalesce("pieces", F.lit(1))})
    return placed.select("c", "n", "comp", "weight", F.xxhash64("comp", "band", F.pmod(F.xxhash64("c"), F.col("pieces"))).alias("g"))


# ---- 3: the matrix


def _least_shared(n: str, m: str) -> Column:
    """Tokens that sets of n and m share at least if they link: NEAR / (100 + NEAR) of both, rounded up."""
    return F.ceil((F.col(n) + F.col(m)) * NEAR / (100 + NEAR))


def _prefixes(known: DataFrame) -> DataFrame:
    """(c, token, rest): a class's tokens that another one holds too, as far as one of them must be the first that two linked sets
    share. rest: how many of the class's tokens follow in the order, this one included."""
    tokens = known.select("c", "n", F.explode("s").alias("token"))
    often = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    shared = tokens.join(often, "token").groupBy("c", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("own"))
    # tokens of one class alone come first in the order, and are left out
    early = F.col("n") - F.ceil(F.col("n") * NEAR / 100) + 1 - (F.col("n") - F.size("own"))
    early = shared.where(early > 0).select("c", F.size("own").alias("held"), F.posexplode(F.slice("own", 1, early.cast("int"))).alias("at", "x"))
    return early.select("c", "x.token", (F.col("held") - F.col("at")).alias("rest"))


def _asked(known: DataFrame, placed: DataFrame) -> DataFrame:
    """(c, g): the groups that a class asks."""
    rows = checkpoint(_prefixes(known).join(placed, "c"))
    met = rows.groupBy("token").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.max(F.struct("weight", "comp")).alias("top")).where("a != b").select("token", "top")
    cells = rows.groupBy("token", "g", "comp", "weight").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("rest").alias("most"))
    cells = cells.select("token", "g", F.struct("weight", "comp").alias("there"), "low", "high", "most")
    asking = rows.select("token", "c", "n", "rest", F.struct("weight", "comp").alias("here")).join(met, "token").where("here < top").drop("top")
    pairs = asking.join(cells, "token").where("here < there")
    return pairs.where((_least_shared("n", "low") <= F.least("rest", "most", "n", "high"))).select("c", "g").distinct()


# ---- 4: bound and opening


def _opened(asked: DataFrame, known: DataFrame, placed: DataFrame) -> DataFrame:
    """Links (c, m) of the asking classes and members of the groups."""
    asked = _held(asked)
    of = _held(placed.join(asked.select("g").distinct(), "g", "left_semi").select("c", "g"))
    members = checkpoint(known.select("c", "n", "s").join(of, "c"))
    union = checkpoint(members.groupBy("g").agg(F.min("n").alias("low"), F.array_distinct(F.flatten(F.collect_list("s"))).alias("union")))
    sides = known.select("c", "n", "s").join(asked, "c").join(union, "g")
    open_ = _held(sides.where(F.size(F.array_intersect("s", "union")) >= _least_shared("n", "low")).select("c", "g"))
    against = members.select("g", F.col("c").alias("m"), F.col("s").alias("ms"))
    return known.select("c", "s").join(open_, "c").join(against, "g").where(_links(against)).select("c", "m")


def class_links(known: DataFrame) -> DataFrame:
    """Links (c, m) between classes that join all classes of a component, all of them exact; known: (c, n, s, signs)."""
    led = checkpoint(_leader_links(known))
    placed = checkpoint(_groups(known, connected_components(led, "c", "m")))
    return led.unionByName(checkpoint(_opened(_asked(known, placed), known, placed)))


def components(df: DataFrame, text: str, key: str) -> DataFrame:
    """(key, d, r, c, n, component) of each row of df: its class, the size of its set, and the least key it is linked with.

    component is least by (key, row) of the rows that links reach, itself included, as a struct (d, r); rows without a key come after all
    others, so it has a key if any of them has one. Rows of null and
    repeated keys: see keyed. Rows without words (null, empty and blank texts) have n = 0 and are linked with nothing. Texts of any
    length are taken whole; equal texts, however many, are one class. An empty table gives an empty result. Other columns of df
    are not looked at, whatever their names are. The numbers in c and n are 64-bit hashes and sizes of the sets.
    """
    parts = max(2, partitions(df.sparkSession))
    texts = keyed(df, key, text).select("d", "r", binary().alias("t"))
    first = checkpoint(texts.mapInPandas(_tokens(parts), PACKED).repartition(parts, "part").mapInPandas(_meet(parts), PACKED))
    classes = first.where("kind = 0").select("d", "r", "c", "n")
    enough = first.where("kind = 2").select("part", "blob").repartition(parts, "part").mapInPandas(_enough, "c long")
    # one text stands for its class
    low = checkpoint(classes.where("n > 0").groupBy("c").agg(F.min(F.struct((F.col("r") < 0).alias("keyless"), "d", "r")).alias("low"), F.count("*").alias("copies")))
    chosen = _held(low.join(enough, "c", "left_semi").select("c", "low.d", "low.r"))
    known = checkpoint(texts.join(chosen, ["d", "r"]).select("c", "t").mapInPandas(_own_sets, "c long, n long, s array<long>, signs array<long>"))
    labels = connected_components(class_links(known), "c", "m")
    found = low.join(labels.select(F.col("node").alias("c"), F.col("component").alias("comp")), "c", "left").where("copies > 1 or comp is not null").withColumn("comp", F.coalesce("comp", "c"))
    where = _held(found.join(found.groupBy("comp").agg(F.min("low").alias("least")), "comp").select("c", "least"))
    out = classes.join(where, "c", "left")
    component = F.when(F.col("n") > 0, F.coalesce(F.when(F.col("least").isNotNull(), F.struct("least.d", "least.r")), F.struct("d", "r"))).otherwise(F.struct("d", "r"))
    return out.select(key_of().alias(key), "d", "r", "c", "n", component.alias("component"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = components(table(spark, sf_dir, "documents"), "text", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), key_of("component.d", "component.r").alias("component_id"))


# sets that are equal are one class, named by the least document of it; classes are linked by what they share
_SQL = r"""WITH RECURSIVE
 w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
 sets AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s FROM w),
 docs AS MATERIALIZED (SELECT doc_id, len(s) AS n, min(doc_id) OVER (PARTITION BY s) AS c FROM sets),
 items AS MATERIALIZED (SELECT doc_id AS c, len(s) AS n, unnest(s) AS x FROM sets WHERE doc_id IN (SELECT c FROM docs)),
 pairs AS MATERIALIZED (SELECT a.c AS a, b.c AS b FROM items a JOIN items b ON a.x = b.x AND a.c < b.c GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
 links AS MATERIALIZED (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
 reach AS (SELECT DISTINCT a AS node, a AS seen FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen),
 least AS (SELECT node, min(seen) AS low FROM reach GROUP BY node)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, CASE WHEN n = 0 THEN doc_id ELSE coalesce(low, c) END AS component_id FROM docs LEFT JOIN least ON node = c"""

QUERIES = {"op7_jaccard": op7_jaccard}
ORACLE: dict[str, str] = {"op7_jaccard": _SQL}


def brute_force(texts: list[str | None]) -> list[int]:
    """Component of each text, as the first index it is linked with; for tests."""
    words = [[w for w in (t or "").encode().lower().split()] for t in texts]
    own = [{tuple(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)} if len(w) >= SHINGLE else ({tuple(w)} if w else set()) for w in words]
    label = list(range(len(own)))
    by: dict[tuple, list[int]] = {}
    for i, s in enumerate(own):
        for x in s:
            by.setdefault(x, []).append(i)
    for i, s in enumerate(own):
        shared: dict[int, int] = {}
        for x in s:
            for j in by[x]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if 100 * n >= NEAR * (len(s) + len(own[j]) - n):
                a, b = label[i], label[j]
                if a != b:
                    label = [min(a, b) if y in (a, b) else y for y in label]
    return label
