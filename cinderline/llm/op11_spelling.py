"""Spelling variants: words that differ by one letter, by a trie over counts of letter groups.

A word is described by how often each of 26 letter groups occurs in it. Words are arranged in a trie by these counts, one group a level.
One edit changes few counts: an inserted letter adds one to a group, a deleted one takes one away, a replaced one does both. So a search
goes down the trie with a budget of one surplus and one deficit, and leaves a path when a budget is overdrawn; words at the leaves that
it reaches are then compared letter by letter.

In Spark, words lie in stretches of such a trie: sorted by coarse counts (a few groups of groups, whose sum is the length), then by the
fine ones, and cut into chunks of bounded size. A chunk meets those chunks whose coarse counts lie within the budget, by an equi join on
the coarse counts, and a task searches one chunk's trie with another one's: both go down together, depth first, so that a prefix which
many words share is compared once. A large subtree is many chunks, and so many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import checkpoint
from .common import CRC_TABLE, crc32_sql, give_back, table

GROUPS = 26
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def group_of(groups: int) -> np.ndarray:
    """The letter group of each code point up to U+00FF."""
    points = np.arange(0x100)
    return np.where(points < 0x80, points - ord("a"), points) % groups


def counts_of(words: list[str], groups: int) -> np.ndarray:
    """How often each group occurs in each word."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    rows = np.repeat(np.arange(len(words)), lengths)
    letters = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
    return np.bincount(rows * groups + group_of(groups)[letters], minlength=len(words) * groups).reshape(len(words), groups)


class Trie:
    """Words of one length in the order of their counts. A node of level k is a run of rows with equal counts of the groups before k."""

    def __init__(self, words: list[str], totals: np.ndarray):
        counts = counts_of(words, GROUPS)
        order = np.lexsort(counts.T[::-1])
        counts = counts[order]
        self.words = [words[i] for i in order]
        self.totals = totals[order]
        self.letters = np.frombuffer("".join(self.words).encode("latin-1"), dtype=np.uint8).reshape(len(words), -1)
        self.rank = np.argsort(np.array(sorted(range(len(words)), key=self.words.__getitem__)))  # in the order of code points
        begins, starts = np.zeros(len(words), dtype=bool), np.array([0])
        begins[0] = True
        self.count: list[np.ndarray] = []  # of the group of a level, for each child
        self.child: list[np.ndarray] = []  # the first child of each node, and the end
        for k in range(GROUPS):
            begins[1:] |= counts[1:, k] != counts[:-1, k]
            children = np.flatnonzero(begins)
            self.count.append(counts[children, k])
            self.child.append(np.append(np.searchsorted(children, starts), len(children)))
            starts = children
        self.rows = np.append(starts, len(words))


def _all_of(a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every (i, j) with i in a0..a1 and j in b0..b1, for each of several such pairs of ranges, and which one it is of."""
    wide, n = b1 - b0, (a1 - a0) * (b1 - b0)
    which = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    return a0[which] + at // wide[which], b0[which] + at % wide[which], which


def candidates(a: Trie, b: Trie, *, block: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (of a, of b) whose counts differ by a surplus of one and a deficit of one at most; where a is b, each pair once.

    A stack holds pairs of nodes with what is left of both budgets. It is worked off depth first, in blocks, so it stays small.
    """
    one = np.array([1])
    stack = [(0, one - 1, one - 1, one, one)]
    while stack:
        k, i, j, surplus, deficit = stack.pop()
        first, other = (a.child[k], b.child[k]) if k < GROUPS else (a.rows, b.rows)
        if len(i) > 1 and ((first[i + 1] - first[i]) * (other[j + 1] - other[j])).sum() > block:
            half = len(i) // 2
            stack += [(k, *(x[half:] for x in (i, j, surplus, deficit))), (k, *(x[:half] for x in (i, j, surplus, deficit)))]
            continue
        x, y, which = _all_of(first[i], first[i + 1], other[j], other[j + 1])
        if k == GROUPS:
            once = x < y if a is b else slice(None)
            yield x[once], y[once]
            continue
        more = b.count[k][y] - a.count[k][x]
        surplus, deficit = surplus[which] - np.maximum(more, 0), deficit[which] + np.minimum(more, 0)
        left = (surplus >= 0) & (deficit >= 0)
        if a is b:
            left &= x <= y
        if left.any():
            stack.append((k + 1, x[left], y[left], surplus[left], deficit[left]))


def _one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows differ by exactly one edit; rows of `long` are as long, or longer by one letter."""
    n = short.shape[1]
    if long.shape[1] == n:
        return (short != long).sum(axis=1) == 1
    stop = np.zeros((len(short), 1), dtype=bool)
    front = np.argmin(np.hstack([short == long[:, :n], stop]), axis=1)
    back = np.argmin(np.hstack([(short == long[:, 1:])[:, ::-1], stop]), axis=1)
    return front + back >= n


def near_rows(a: Trie, b: Trie, *, letters: int = 4_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Rows (of a, of b) of words that are near; b's words are as long as a's, or longer by one."""
    found_a, found_b = [], []
    for i, j in candidates(a, b):
        step = max(1, letters // a.letters.shape[1])
        for at in range(0, len(i), step):
            x, y = i[at : at + step], j[at : at + step]
            near = _one_edit(a.letters[x], b.letters[y])
            found_a.append(x[near])
            found_b.append(y[near])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def _best(own: Trie, other: Trie, i: np.ndarray, j: np.ndarray) -> dict[str, list]:
    """For each row of `own` among i: how many near words there are, and the one of largest total among them."""
    order = np.lexsort((other.rank[j], -other.totals[j], i))
    rows, first, n = np.unique(i[order], return_index=True, return_counts=True)
    best = j[order][first]
    return {"word": [own.words[r] for r in rows], "n_near": n.tolist(), "best_n": other.totals[best].tolist(), "best": [other.words[r] for r in best]}


def spelled(df: DataFrame, text: str, key: str, *, least: int = 7, every: int | None = 31) -> DataFrame:
    """(word, n) of all words of at least `least` letters: runs of letters up to U+00FF, in which A to Z are lower-cased.

    Where `every` is given, a run whose crc32 with its document's key is a multiple of it loses the letter at that crc32 modulo its
    length. Null texts have no words; a run of a null key loses none. Repeated rows count as often as they occur.
    """
    runs = df.select(F.col(f"`{key}`").cast("string").alias("d"), F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"[A-Za-zÀ-ÿ]{{{least},}}"), F.lit(0))).alias("w"))
    # translate is slow, and lower() would change letters beyond Z
    word = F.when(F.octet_length("w") == F.char_length("w"), F.lower("w")).otherwise(F.translate("w", UPPER, UPPER.lower()))
    runs = runs.select("d", word.alias("w"))
    if every:
        h = F.crc32(F.concat_ws(":", "d", "w").cast("binary"))
        at = (h % F.char_length("w")).cast("int")
        lost = F.concat(F.substring(F.col("w"), F.lit(1), at), F.substr(F.col("w"), at + 2))
        runs = runs.select(F.when(F.col("d").isNotNull() & (h % every == 0), lost).otherwise(F.col("w")).alias("w"))
    return runs.groupBy(F.col("w").alias("word")).agg(F.count("*").alias("n")).where(F.char_length("word") >= least)


def _coarse(word: Column, groups: int) -> Column:
    """Counts of `groups` groups of letters, as an array; their sum is the length."""
    letters = [chr(c) for c in [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]]
    group = group_of(GROUPS)
    mine = [[c for c in letters if group[ord(c)] % groups == g] for g in range(groups)]
    return F.array(*[F.char_length(word) - F.char_length(F.translate(word, "".join(m), "")) for m in mine])


def coarse_groups(words: int, per_chunk: int) -> int:
    """How many coarse groups let a subtree hold about a chunk: words of nine letters on the average spread over their compositions."""
    return next((k for k in range(3, 13) if words <= per_chunk * 6 * math.comb(8 + k, k - 1)), 12)


def chunks(words: DataFrame, groups: int, per_chunk: int, *, letters: int = 1_000_000) -> DataFrame:
    """(coarse, chunk, words, totals): words by their coarse counts, then by their letters in order, in chunks of at most per_chunk words
    and about `letters` letters, so that a chunk is a stretch of the trie. words: (word, n)."""
    order = ["coarse", F.array_sort(F.split("word", "")), "word"]
    laid = words.select("word", "n", _coarse(F.col("word"), groups).alias("coarse")).repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, totals, size = None, [], [], 0

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"coarse": pa.array([now], pa.list_(pa.int32())), "chunk": pa.array([held[0]], pa.string()), "words": pa.array([held], pa.list_(pa.string())), "totals": pa.array([totals], pa.list_(pa.int64()))})

        for b in batches:
            for w, n, c in zip(*(b.column(x).to_pylist() for x in range(3)), strict=True):
                if held and (c != now or len(held) >= per_chunk or size >= letters):
                    yield full()
                    held, totals, size = [], [], 0
                now = c
                held.append(w)
                totals.append(n)
                size += len(w)
        if held:
            yield full()
        give_back()

    return laid.mapInArrow(cut, "coarse array<int>, chunk string, words array<string>, totals array<bigint>")


def _reach(coarse: Column, groups: int) -> Column:
    """Coarse counts within a surplus of one and a deficit of one, of words as long or longer by one, each pair from one side only."""
    steps = [[int(g == a) - int(g == b) for g in range(groups)] for a in range(groups) for b in [None, *range(groups)] if a != b]
    steps = [s for s in steps if sum(s) == 1 or next(x for x in s if x) > 0]
    moved = [F.array(*[coarse[g] + s[g] for g in range(groups)]) for s in [[0] * groups, *steps]]
    return F.explode(F.filter(F.array(*moved), lambda c: F.array_min(c) >= 0))


def near_words(words: DataFrame, *, per_chunk: int = 6000) -> DataFrame:
    """words (word, n) with n_near, best_n and best: how many words are near each one, and the nearest of largest n, ties to the smallest
    word. A word without near ones has 0 and nulls. words is read three times, so it should be written."""
    groups = coarse_groups(words.count(), per_chunk)
    held = checkpoint(chunks(words, groups, per_chunk))
    asks = held.select(F.col("coarse").alias("own"), F.col("chunk").alias("own_chunk"), F.col("words").alias("own_words"), F.col("totals").alias("own_totals"), _reach(F.col("coarse"), groups).alias("coarse"))
    met = asks.join(held, "coarse").where((F.col("own") != F.col("coarse")) | (F.col("own_chunk") <= F.col("chunk")))
    met = met.select("own_words", "own_totals", "words", "totals", (F.col("own_chunk") == F.col("chunk")).alias("same"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                mine, its = (Trie(b.column(c)[row].as_py(), b.column(c + 1)[row].values.to_numpy()) for c in (0, 2))
                if b.column(4)[row].as_py():
                    its = mine
                i, j = near_rows(mine, its)
                for part in (_best(mine, its, i, j), _best(its, mine, j, i)) if len(i) else ():
                    yield pa.RecordBatch.from_pydict(part, schema=pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())]))
        give_back()

    found = met.mapInArrow(search, "word string, n_near bigint, best_n bigint, best string")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w"))).alias("b"))
    found = found.select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.w").alias("best"))
    return words.join(found, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "best_n", "best")


def variants(words: DataFrame, *, times: int = 10, per_chunk: int = 6000) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of words (word, n).

    form is the near word of largest n, if that is `times` the word's own or more; root is where forms lead to. n grows along forms, so
    they end; each round doubles the steps that a root stands for. An empty table gives an empty result; words are distinct and not null.
    """
    near = near_words(words, per_chunk=per_chunk)
    good = F.col("best_n") >= times * F.col("n")
    out = checkpoint(near.select("word", F.when(good, F.col("best")).alias("form"), "n", "n_near", F.when(good, F.col("best_n")).alias("form_n")))
    steps = checkpoint(out.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    most = out.agg(F.max("n")).first()[0] or 1
    longest = max(1, math.floor(math.log(most, times)) + 1)  # n grows that often at most
    for _ in range(math.ceil(math.log2(longest))):
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = checkpoint(steps.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return out.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelled(table(spark, sf_dir, "documents"), "text", "doc_id")
    return variants(checkpoint(words.where("n >= 2")))


_CRC = crc32_sql("list_transform(range(1, length(x) // 2 + 1), lambda i: ('0x' || substr(x, 2 * i - 1, 2))::BIGINT)")
_SQL = f"""WITH RECURSIVE
 runs AS (SELECT CAST(doc_id AS VARCHAR) AS d, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS w FROM documents),
 held AS MATERIALIZED (SELECT d, translate(w, '{UPPER}', '{UPPER.lower()}') AS w, count(*) AS k FROM runs WHERE length(w) >= 7 GROUP BY ALL),
 {CRC_TABLE},
 hashed AS (SELECT w, k, {_CRC} AS h FROM (SELECT *, hex(encode(d || ':' || w)) AS x FROM held), crcs),
 words AS MATERIALIZED (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (SELECT k, CASE WHEN h % 31 = 0 THEN substr(w, 1, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS word FROM hashed) WHERE length(word) >= 7 GROUP BY 1 HAVING sum(k) >= 2),
 less AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS r FROM words, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)),
 near AS (SELECT a.word AS a, b.word AS b FROM less a JOIN less b ON a.i = b.i AND a.r = b.r AND a.word <> b.word UNION SELECT l.word, w.word FROM less l JOIN words w ON l.r = w.word UNION SELECT w.word, l.word FROM less l JOIN words w ON l.r = w.word),
 best AS (SELECT a, count(*) AS n_near, max(w.n) AS top, arg_min(b, (-w.n, b)) AS b FROM near JOIN words w ON w.word = b GROUP BY a),
 forms AS MATERIALIZED (SELECT w.word, CASE WHEN top >= 10 * n THEN b END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 10 * n THEN top END AS form_n FROM words w LEFT JOIN best ON a = w.word),
 steps AS (SELECT word, word AS at FROM forms UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, s.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN steps s ON s.word = f.word JOIN forms e ON e.word = s.at AND e.form IS NULL"""

QUERIES = {"op11_spelling": op11_spelling}
ORACLE: dict[str, str] = {"op11_spelling": _SQL}
