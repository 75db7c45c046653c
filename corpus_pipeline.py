"""A corpus pipeline: documents through five of the text operators, each stage written as Parquet and read again.

Each stage takes rows of null and repeated ids as documents of their own (see keyed), texts of any length whole, and an empty table for
an empty result. Columns beyond those that a stage reads go through it, whatever their names are.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderline.llm import op1_suffix_dedup, op3_language, op5_decontamination, op6_bpe, op7_jaccard
from cinderline.llm.common import binary, checkpoint, keyed, shared_folder, table


def _but(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """The rows of docs whose place (d, r) is, or is not, among those found."""
    found = checkpoint(found.select("d", "r").distinct())  # what it was found by can go, before the next stage begins
    return keyed(docs, "doc_id", "text", whole=True).join(found, ["d", "r"], how).select("row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a clear margin; texts without a letter go too, null and empty ones among them."""
    own = docs.select(F.struct("*").alias("row"), "doc_id", "text", "lang")
    dicts = op3_language.train(own.where(op3_language.learned_fold(F.col("doc_id"))), "text", "lang", "doc_id")
    return op3_language.classify(own, "text", dicts).where(~F.col("rejected")).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that is linked by Jaccard similarity, the document of the least id. Null and empty texts are linked with nothing."""
    return _but(docs, op7_jaccard.components(docs, "text", "doc_id").where(F.col("component") == F.struct("d", "r")), "left_semi")


SPANS = "array<struct<s:bigint,e:bigint>>"


def _whole_characters(text: Column, cuts: Column) -> Column:
    """The text from which `cuts` (spans of bytes) went, without the bytes of characters that a cut split: those that continue one
    at the end of a cut, and those that begin one before it. Elsewhere nothing goes."""

    @F.pandas_udf("string")
    def run(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, own in zip(texts, spans, strict=True):
            data, kept, at = t.encode(), [], 0
            for a, b in [*op1_suffix_dedup.joined(own), (len(data), len(data))]:
                kept.append(data[at:a].decode(errors="ignore"))  # a piece of whole text can be broken at its two ends alone
                at = b
            out.append("".join(kept))
        return pd.Series(out, dtype=object)

    return run(text, cuts)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings that occur before; what is left of a character that was cut goes, and so does a document of
    which nothing is left. n_chars, where there is one, follows the text. Null and empty texts stay as they are."""
    found = checkpoint(op1_suffix_dedup.repeated_spans(keyed(docs, "doc_id", "text").select("d", "r", binary().alias("t")), 100))
    out = keyed(docs, "doc_id", "text", whole=True).join(found, ["d", "r"], "left")
    out = out.select("row", "spans", F.when(F.col("spans").isNull(), F.col("t")).otherwise(_whole_characters(F.coalesce("t", F.lit("")), F.coalesce("spans", F.array().cast(SPANS)))).alias("left"))
    out = out.where(F.col("spans").isNull() | (F.length("left") > 0))
    new = {"text": F.col("left"), "n_chars": F.when(F.col("spans").isNull(), F.col("row")["n_chars"]).otherwise(F.length("left").cast("bigint")) if "n_chars" in docs.columns else None}
    return out.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window that is similar to an item of the benchmark. Null and empty texts hold none."""
    return _but(docs, op5_decontamination.contaminated(docs, "text", "doc_id", table(spark, sf_dir, "benchmark"), "text", "item_id"), "left_anti")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their texts, how many there are, and the digest of what they decode to; these three replace columns
    that are called so. Null and empty texts have no ids."""
    made = ("ids", "n_tokens", "decoded_sha256")
    coded = op6_bpe.tokenize(docs.select(F.struct("*").alias("row"), "text"), "text", op6_bpe.vocabulary())
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in made]
    return coded.select(*kept, "ids", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeated_strings", repeated_strings), ("decontamination", decontamination), ("encoding", encoding)]
ORACLE_SQL = None  # compression, suffix runs and BPE are beyond SQL; the stages are tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
