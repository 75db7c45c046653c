"""Quality by Bradley-Terry pairwise ranking.

A document's quality is a linear score of features of its text. Pairs of a labelled good and a labelled bad document
are preferences; the probability that the good one wins is the logistic function of the difference of the scores, and
the weights come from the logistic loss on feature differences. A quantile of the scores, at the share of bad
documents, is the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import small
from ..operators.numbering import number_rows
from . import logistic
from .bytehash import mix, prefix, spans, words
from .common import checkpoint, held_out, pieces, short_batches, table
from .logistic import packed

KINDS = {"lower": "abcdefghijklmnopqrstuvwxyz", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "space": " \t", "line": "\n\r", "stop": ".,;:!?", "bar": "|", "angle": "<>{}[]()/\\", "sign": "#$%&*@^~=+_`\"'-"}
FEATURES = [*KINDS, "beyond", "log_bytes", "word_bytes", "distinct_words", "distinct_pairs", "line_bytes", "distinct_lines", "words_with_sign", "upper_words", "top_byte"]


def features(texts: list[bytes]) -> np.ndarray:
    """A row of FEATURES for each text: shares of kinds of bytes, sizes and repetition of words and lines. Whole texts count."""
    out = np.zeros((len(texts), len(FEATURES)))
    ids = [np.frombuffer(k.encode(), dtype=np.uint8) for k in KINDS.values()]
    hashes, first = words(texts)
    for i, t in enumerate(texts):
        n = max(1, len(t))
        data = np.frombuffer(t, dtype=np.uint8)
        counts = np.bincount(data, minlength=256)
        row = [counts[k].sum() / n for k in ids]
        row.append(counts[128:].sum() / n)
        own = hashes[first[i] : first[i + 1]]
        m = max(1, len(own))
        pairs = mix(own[1:] + own[:-1] * np.uint64(3))
        ends = np.flatnonzero(data == 10)
        lines = spans(prefix(data), np.concatenate([[0], ends + 1]), np.concatenate([ends, [len(data)]])) if len(data) else own[:0]
        spelled = t.split()
        signs = sum(not w[-1:].isalnum() and w[-1] < 128 and w[-1] not in b".,;:!?|\"')" for w in spelled)
        row += [np.log1p(len(t)), (n - counts[KINDS_SPACE].sum()) / m / 10, len(np.unique(own)) / m, len(np.unique(pairs)) / max(1, len(pairs)), np.log1p(n / max(1, len(lines))), len(np.unique(lines)) / max(1, len(lines)), signs / m, sum(w.isupper() for w in spelled) / m, counts[33:].max() / n if len(t) else 0.0]
        out[i] = row
    return out


KINDS_SPACE = [9, 10, 11, 12, 13, 32]


@dataclass(frozen=True)
class Model:
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    threshold: float  # the score at the quantile
    slope: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return expand((x - np.array(self.centre)) / np.array(self.scale)) @ np.array(self.weights)


def expand(z: np.ndarray) -> np.ndarray:
    """Standardised features, clipped, with their squares: too little of something can be as bad as too much."""
    z = np.clip(z, -4, 4)
    return np.c_[z, z * z]


def measured(df: DataFrame, text: str, *columns: Column) -> DataFrame:
    """columns of df and x, the features of the text; those of null are those of an empty text."""
    short_batches(df.sparkSession)

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            own = [features([t.encode() for t in f["t"]]) for f in pieces(iter([b.fillna("").to_frame("t")]), "t")]
            yield pd.Series([row for x in own for row in x], dtype=object)

    return df.select(*columns, run(F.col(text)).alias("x"))


def train(rows: DataFrame, text: str, label: str, key: str, totals: dict[int, int] | None = None, *, rivals: int = 6) -> Model:
    """Learns from all rows with a text and a label 0 or 1; others teach nothing. See `fit`."""
    rows = rows.where(F.col(text).isNotNull() & F.col(label).isin(0, 1))
    return fit(checkpoint(measured(rows, text, F.col(label).cast("int").alias("label"), F.xxhash64(key).alias("h"))), totals, rivals=rivals)


def fit(known: DataFrame, totals: dict[int, int] | None = None, *, rivals: int = 6) -> Model:
    """Learns from all rows (label, h, x: see `measured`), which are read many times, in an order that h, label and x give.

    totals: how many labels of each kind the rows stand for, if other than their own numbers. Each text of the kind that has more is set
    against `rivals` of the other. Rows and pairs stay in their tasks; sums over them reach the driver. Without both labels every text
    gets the same score.
    """
    width = len(FEATURES)
    at = [F.col("x")[i] for i in range(width)]
    held = known.agg(F.count_if(F.col("label") == 0).alias("n0"), F.count_if(F.col("label") == 1).alias("n1"), F.array(*[F.percentile_approx(c, 0.5, 10_000) for c in at]).alias("centre"), F.array(*[F.stddev_pop(c) for c in at]).alias("scale")).first()
    n0, n1 = held["n0"], held["n1"]
    if not n0 or not n1:
        return Model((0.0,) * width, (1.0,) * width, (0.0,) * (2 * width), -0.5 if n1 else 0.5, 1.0)
    centre, scale = np.array(held["centre"]), np.array(held["scale"]) + 1e-6
    shown = lambda x: expand((np.stack(x.to_numpy()) - centre) / scale)

    # bad texts have the places 0 to n0 - 1, good ones those from n0 on
    placed = number_rows(known, [F.col("label"), F.col("h"), F.col("x")], "place")
    more, fewer = max(n0, n1), min(n0, n1)
    asks, asked = (placed.where(F.col("label") == k) for k in ((0, 1) if n0 >= n1 else (1, 0)))
    turns = F.explode(F.transform(F.sequence(F.lit(1), F.lit(rivals)), lambda j: F.pmod(F.xxhash64("place", j), F.lit(fewer))))
    asks = asks.select(F.col("x").alias("x1"), turns.alias("rival"))
    asked = asked.select(F.col("x").alias("x2"), (F.col("place") - (n0 if n0 >= n1 else 0)).alias("rival"))
    sign = -1.0 if n0 >= n1 else 1.0

    def differences(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                yield packed(np.c_[sign * (shown(f["x1"]) - shown(f["x2"])), np.ones(len(f))])

    pairs = checkpoint(asks.join(small(asked, fewer, 20_000), "rival").select("x1", "x2").mapInPandas(differences, "block binary"))
    # a pair stands for both of its orders, so no bias is learned; their loss is twice that of one
    weights, _ = logistic.fit(pairs, 2 * width, ridge=2.5, bias=False)
    weights = np.round(weights, 9)  # sums of other orders give the same

    def strengths(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                yield pd.DataFrame({"label": f["label"], "s": shown(f["x"]) @ weights})

    totals = totals or {0: n0, 1: n1}
    scored = checkpoint(known.select("label", "x").mapInPandas(strengths, "label int, s double"))
    weighed = scored.select("s", F.when(F.col("label") == 1, totals[1] / n1).otherwise(totals[0] / n0).alias("w"))
    threshold = _quantile(weighed, totals[0] / (totals[0] + totals[1]))
    spread = (scored.agg(F.stddev_pop("s")).first()[0] or 0.0) + 1e-9

    def levels(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                yield packed(np.c_[(f["s"] - threshold) / spread, f["label"]])

    slope, _ = logistic.fit(scored.mapInPandas(levels, "block binary"), 1, ridge=1.0)
    return Model(tuple(centre), tuple(scale), tuple(weights), float(threshold), float(max(slope[0], 0.1) / spread))


def _quantile(rows: DataFrame, share: float, *, bins: int = 1000) -> float:
    """The middle between the least s up to which rows (s, w) have `share` of all weight, and the next s: exact, by ever finer bins."""
    s = F.col("s")
    low, high, total = rows.agg(F.min(s), F.max(s), F.sum("w")).first()
    below, wanted = 0.0, share * total * (1 - 1e-12)
    while low < high:
        place = F.least(F.lit(bins - 1), F.floor((s - low) / (high - low) * bins))
        for r in sorted(rows.where(s.between(low, high)).groupBy(place.alias("k")).agg(F.sum("w").alias("w"), F.min(s).alias("a"), F.max(s).alias("b")).collect()):
            low, high = r["a"], r["b"]
            if below + r["w"] >= wanted:
                break
            below += r["w"]
    above = rows.where(s > low).agg(F.min(s)).first()[0]
    return low if above is None else (low + above) / 2


def judged(df: DataFrame, model: Model, *columns: Column) -> DataFrame:
    """columns of df, score and predicted (see `score`), from the features x."""

    @F.pandas_udf("double")
    def run(x: pd.Series) -> pd.Series:
        at = model.slope * (model.strength(np.stack(x.to_numpy())) - model.threshold) if len(x) else np.zeros(0)
        return pd.Series(1 / (1 + np.exp(-np.clip(at, -30, 30))))

    out = df.select(*columns, run("x").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def score(df: DataFrame, text: str, model: Model) -> DataFrame:
    """df with score (0 to 1; 0.5 at the quantile) and predicted (1 where score >= 0.5), which replace such columns.

    Null texts are scored as empty ones. Equal texts get equal scores.
    """
    kept: list[Column] = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("score", "predicted")]
    return judged(measured(df, text, F.struct(*kept).alias("row")), model, F.col("row")).select("row.*", "score", "predicted")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts are measured once; labels meet the features, not the texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = held_out(F.col("doc_id"), 3, 1)
    seen = checkpoint(measured(docs, "text", F.col("doc_id"), fold.alias("held_out"), F.col("text").isNotNull().alias("written")))
    labels = table(spark, sf_dir, "labels").where(F.col("quality").isin(0, 1) & ~fold).select("doc_id", F.col("quality").cast("int").alias("label")).distinct()
    known = seen.where("written and not held_out").join(labels, "doc_id").select("label", F.xxhash64("doc_id").alias("h"), "x")
    return judged(seen, fit(checkpoint(known)), F.col("doc_id"), F.col("held_out"))


QUERIES = {"op4_quality": op4_quality}
ORACLE: dict[str, str] = {}
