"""Toxicity by compression distance.

Two raw-content zstandard dictionaries, one of toxic and one of ordinary text. Both hold the same frequent words, so
that ordinary text costs the same under either; before them each holds all words, and pairs of neighbouring words, that tell its
label beyond chance however many terms are tried, and blanks up to the same length. A text is compressed in short overlapping windows
against both. Letters are moved by their place in their word
first, so that a term matches words that begin like it, not the inside of others. How many bytes the toxic dictionary saves in its windows is the evidence; a logistic curve turns it into a score. The
curve is fitted on texts that the dictionaries they are measured by were not made of: each of FOLDS parts is measured by dictionaries
of the others. With few parts these would hold fewer terms, and fewer that chance put there, than the dictionaries that score; the curve
would then trust small savings too much.

Whole passages in the dictionaries in place of terms tell less, since the chance matches of their ordinary words outweigh what the
toxic ones save (figures in the README).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, give_back, held_out, labelled_sample, short_batches, table

WINDOW = 64
OVERLAP = 12
FOLDS = 5
STEP = 61  # what a byte is moved by for each place
LEAST_SAVED = (2, 3, 4, 6)  # bytes that a window saves, for the counts of windows
FEATURES = ["most", "second", *[f"hits{n}" for n in LEAST_SAVED], "share", "saved", "windows"]


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]
    bias: float


def _words(text: Column) -> Column:
    """Lower-case runs of letters, as far as ASCII tells, and of all other characters beyond ASCII."""
    return F.filter(F.split(F.lower(text), r"[\x00-\x60\x7b-\x7f]+"), lambda w: w != "")


def _with_fold(rows: DataFrame) -> DataFrame:
    """rows with a hash that near copies mostly share, the least one of three words in a row, and a fold drawn by it."""
    own = rows.select("text", "label", _words(F.col("text")).alias("own"))
    last = F.greatest(F.size("own") - 3, F.lit(0))
    least = F.array_min(F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.get("own", i), F.get("own", i + 1), F.get("own", i + 2))))
    return own.select("text", "label", least.alias("sketch")).withColumn("fold", F.pmod(F.xxhash64("sketch"), F.lit(FOLDS)).cast("int"))


def _apart(rows: DataFrame) -> DataFrame:
    """(own, label, fold): the words of texts, near copies with one label once: of those that share the hash, one stays. Else the words of one text that is copied often would tell its label."""
    one = _with_fold(rows).groupBy("sketch", "label", "fold").agg(F.min("text").alias("text"))
    return one.select(_words(F.col("text")).alias("own"), "label", "fold")


def _terms(rows: DataFrame) -> DataFrame:
    """(w, toxic0, n0, toxic1, n1, ...): in how many texts, and toxic ones, of all folds but one a word, or a pair of words with a blank
    between, occurs; last in those of all folds."""
    rest = F.greatest(F.size("own") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("own", 1, rest), F.slice("own", 2, rest), lambda a, b: F.concat_ws(" ", a, b))
    rows = rows.select(F.explode(F.array_distinct(F.concat("own", pairs))).alias("w"), "label", "fold")
    count = lambda what, h: F.sum(F.when(F.col("fold") != h, what).otherwise(0))
    return rows.groupBy("w").agg(*[count(what, h).alias(f"{name}{h}") for h in range(FOLDS + 1) for name, what in (("toxic", F.col("label")), ("n", F.lit(1)))])


def _evidence_of(k: Column, n: Column, share: float) -> Column:
    """The logarithm of how much likelier k toxic ones of n texts are at their own share than at `share`; negative below it."""
    part = lambda x, expected: F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)
    return (part(k, n * share) + part(n - k, n * (1 - share))) * F.when(k >= n * share, 1).otherwise(-1)


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    """As that of op3_language, with tables that reach over the whole dictionary however long it is."""
    log = min(27, max(17, (len(dictionary) + 1024).bit_length()))
    settings = zstandard.ZstdCompressionParameters(window_log=log, chain_log=log - 1, hash_log=log - 1, search_log=4, min_match=3, target_length=8, strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False)
    d = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=settings)


def by_place(data: bytes) -> bytes:
    """Lower-case text in which each byte of a word is moved by its place in the word, so that a word, or its beginning, matches words
    that begin so, and not the inside of others."""
    own = np.frombuffer(data, dtype=np.uint8)
    inside = (own >= 0x80) | ((own >= 0x61) & (own <= 0x7A))
    at = np.arange(len(own))
    place = at - np.maximum.accumulate(np.where(inside, -1, at)) - 1 if len(own) else at
    return np.where(inside, own + place * STEP, own).astype(np.uint8).tobytes()


def _evidence(text: str | None, tools: tuple) -> tuple[float, ...]:
    """Of the bytes that the toxic dictionary saves in each window: the two largest, how many windows save so many, the share of
    windows that save 3, the sum; and how many windows there are."""
    data = by_place((text or "").lower().encode())
    n = max(1, -(-len(data) // WINDOW))
    saved = np.zeros(n)
    ordinary, toxic = tools
    for i in range(n):
        part = data[max(0, i * len(data) // n - OVERLAP) : (i + 1) * len(data) // n]
        saved[i] = len(ordinary.compress(part)) - len(toxic.compress(part))
    top = np.sort(saved)[::-1].clip(-2, 12)
    hits = [float(np.log1p((saved >= x).sum())) for x in LEAST_SAVED]
    return float(top[0]), float(top[1]) if n > 1 else 0.0, *hits, float((saved >= 3).mean()), float(np.log1p(np.maximum(saved - 1, 0).sum())), float(np.log1p(n))


def _measure(texts: Column, which: Column, pairs: list[tuple[bytes, bytes]]) -> Column:
    """The evidence of each text under the pair of dictionaries (ordinary, toxic) that `which` names."""

    @F.pandas_udf(", ".join(f"{k} double" for k in FEATURES))
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        tools = [(compressor(by_place(a)), compressor(by_place(b))) for a, b in pairs]
        for texts, own in batches:
            yield pd.DataFrame([_evidence(t, tools[i]) for t, i in zip(texts, own, strict=True)], columns=FEATURES)
        give_back()

    return run(texts, which)


def fit_logistic(x: np.ndarray, y: np.ndarray, *, ridge: float = 1e-2, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Weights and bias by Newton's method on the ridge-penalised logistic loss."""
    a = np.c_[x, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + ridge * w
        h = (a * (p * (1 - p))[:, None]).T @ a + (ridge + 1e-9) * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def _dictionaries(told: dict[str, float], usual: list[str]) -> tuple[bytes, bytes]:
    """(ordinary, toxic): the terms of each label, the most telling ones last, and then the frequent words that tell nothing."""

    def front(sign: int) -> bytes:
        own = {w for w, x in told.items() if x * sign > 0}
        return b" ".join(w.encode() for w in sorted(own, key=lambda w: (abs(told[w]), w)) if " " not in w or own.isdisjoint(w.split(" ")))

    base = " ".join(w for w in reversed(usual) if w not in told).encode()
    toxic, ordinary = front(1), front(-1)
    size = max(len(toxic), len(ordinary))
    return ordinary.rjust(size) + b" " + base, toxic.rjust(size) + b" " + base


def train(rows: DataFrame, text: str, label: str, totals: dict[int, int], *, sure: float = 2.0, common: int = 4000) -> Model:
    """Learns from rows with a text and a label 0 or 1; others teach nothing. An empty table gives a model that calls nothing toxic.

    rows is a bounded sample (see labelled_sample), totals says how many labels of each kind it stands for. Terms are counted
    over all rows, near copies once; those of a single text tell nothing. Rows of any length are counted whole, null texts and labels
    are left out. A term tells a label if its counts are e ** (sure + ln(number of terms)) times likelier at its
    own share than by chance; all such terms reach the driver, but for pairs with a word that tells the same by itself. So do
    `common` frequent words of ordinary texts, and a few numbers for each row, for the curve.
    """
    rows = rows.where(F.col(text).isNotNull() & F.col(label).isin(0, 1)).select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"))
    seen = checkpoint(_apart(rows).select("own", "label", "fold"))
    held = seen.groupBy("fold", "label").count().collect()
    # (h, label): how many texts there are beside fold h; FOLDS stands for none
    counted = {(h, y): sum(r["count"] for r in held if r["label"] == y and r["fold"] != h) for h in range(FOLDS + 1) for y in (0, 1)}
    if not counted[FOLDS, 0] or not counted[FOLDS, 1]:
        return Model(b" ", b" ", (0.0,) * len(FEATURES), 10.0 if counted[FOLDS, 1] else -10.0)
    terms = checkpoint(_terms(seen).where(F.col(f"n{FOLDS}") > 1))
    number = terms.agg(*[F.sum((F.col(f"n{h}") > 1).cast("int")).alias(f"m{h}") for h in range(FOLDS + 1)]).first()

    told: list[dict[str, float]] = []
    for h in range(FOLDS + 1):
        share = counted[h, 1] / max(1, counted[h, 0] + counted[h, 1])
        if not 0 < share < 1:
            told.append({})
            continue
        tells = _evidence_of(F.col(f"toxic{h}"), F.col(f"n{h}"), share)
        found = terms.where((F.col(f"n{h}") > 1) & (F.abs(tells) >= sure + float(np.log(number[f"m{h}"] or 1)))).select("w", tells.alias("x")).collect()
        told.append({r["w"]: r["x"] for r in found})
    usual = [r["w"] for r in terms.where(~F.contains("w", F.lit(" "))).orderBy(F.desc(F.col(f"n{FOLDS}") - F.col(f"toxic{FOLDS}")), "w").limit(common).collect()]
    pairs = [_dictionaries(x, usual) for x in told]

    # a text is measured by the dictionaries of the other folds than that of its near copies
    sample = _with_fold(rows).select("label", _measure(F.col("text"), F.col("fold"), pairs).alias("x")).select("label", "x.*").toPandas()
    x, y = sample[FEATURES].to_numpy(), sample["label"].to_numpy().astype(float)
    weights, bias = fit_logistic(x, y)
    drawn_odds = y.mean() / (1 - y.mean())
    bias += float(np.log(totals[1] / totals[0]) - np.log(drawn_odds))  # the sample has its own share of toxic texts
    return Model(*pairs[FOLDS], tuple(float(w) for w in weights), bias)


def score(df: DataFrame, text: str, model: Model, *, threshold: float = 0.3) -> DataFrame:
    """df with score (0 to 1) and predicted (1 where score >= threshold), which replace columns of those names.

    Null and empty texts are scored like a text without evidence. Equal texts get equal scores, repeated rows repeated ones. Texts of
    any length are measured whole. An empty table gives an empty result.
    """
    short_batches(df.sparkSession)
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("score", "predicted")]
    out = df.select(*kept, _measure(F.col(text), F.lit(0), [(model.ordinary, model.toxic)]).alias("_x"))
    margin = F.lit(model.bias)
    for k, w in zip(FEATURES, model.weights, strict=True):
        margin = margin + F.col(f"_x.{k}") * w
    out = out.select(*kept, (1 / (1 + F.exp(-margin))).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = held_out(F.col("doc_id"), 4, 2)
    labels = table(spark, sf_dir, "labels").where(F.col("doc_id").isNotNull() & ~fold).select("doc_id", "toxic")
    rows, totals = labelled_sample(docs, labels, "doc_id", "toxic", 10_000)
    model = train(rows, "text", "toxic", totals)
    return score(docs.select("doc_id", fold.alias("held_out"), "text"), "text", model).drop("text")


QUERIES = {"op10_toxicity": op10_toxicity}
ORACLE: dict[str, str] = {}
