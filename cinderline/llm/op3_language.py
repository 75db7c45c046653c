"""Language identification by compression.

Each language has a raw-content zstandard dictionary: text of that language, at most `dict_bytes` long, from a
bounded sample of labelled rows. A text is compressed window by window against every dictionary; the language
whose dictionary gives the fewest bytes over the whole text wins. A narrow margin is a rejection.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back, held_out, short_batches, table

UND = "und"


def train(rows: DataFrame, text: str, lang: str, key: str, *, per_lang: int = 400, clip: int = 300, dict_bytes: int = 131072) -> dict[str, bytes]:
    """A dictionary for each non-null language; an empty table, or one without such rows, gives none.

    Bounds: about per_lang rows of a language are drawn by a hash of the key, one passage of `clip` characters from
    a place that the hash chooses is used of each, and a dictionary holds dict_bytes at most, equal passages once.
    Short passages of many rows keep a wrongly labelled row, or copies of one text under two labels, from mattering.
    Rows with a null text or language teach nothing. Languages have as many places on the driver as they have dictionaries.
    """
    rows = rows.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & (F.length(text) > 0))
    counts = {r[lang]: r["count"] for r in rows.groupBy(lang).count().collect()}
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_lang / n))])
    drawn = F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 20)) < F.try_element_at(share, F.col(lang)) * F.lit(float(1 << 20))
    sample = rows.where(drawn).select(F.col(lang).alias("lang"), F.substring(F.col(text), F.pmod(F.xxhash64(F.col(key), F.lit("place")), F.greatest(F.length(text) - clip, F.lit(1))).cast("int") + 1, F.lit(clip)).alias("text")).distinct().orderBy(F.xxhash64("text"), "lang").limit(2 * per_lang * len(counts)).collect()
    held: dict[str, bytearray] = {k: bytearray() for k in counts}
    for r in sample:
        own = held[r["lang"]]
        if len(own) < dict_bytes:
            own += r["text"].encode()[: dict_bytes - len(own)] + b"\n"
    return {k: bytes(v) for k, v in held.items() if v}


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    """Matches of 3 bytes count, which the fast levels do not see; they carry most of what tells languages apart."""
    settings = zstandard.ZstdCompressionParameters(window_log=18, chain_log=17, hash_log=17, search_log=4, min_match=3, target_length=8, strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False)
    d = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=settings)


def windows(data: bytes, size: int) -> list[bytes]:
    """The whole text cut in windows of `size` bytes; a short rest joins the last one."""
    n = max(1, round(len(data) / size))
    return [data[i * len(data) // n : (i + 1) * len(data) // n] for i in range(n)]


def classify(df: DataFrame, text: str, dicts: dict[str, bytes], *, window: int = 4096, narrow: float = 0.002) -> DataFrame:
    """df with lang_pred, score (0 to 1, from the margin of the best language over the second) and rejected.

    Null texts and texts without a letter are `und`, score 0, rejected. Ties go to the first language by name. A margin
    of less than `narrow` of the best length, or no model at all, is a rejection; the prediction stands beside it.
    The three names replace columns of df that are called so. Texts are compressed whole, however long; repeated rows get equal results,
    and an empty table gives an empty one.
    """
    short_batches(df.sparkSession)
    names, shared = sorted(dicts), df.sparkSession.sparkContext.broadcast(dicts)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tools = [compressor(shared.value[k]) for k in names]
        for texts in batches:
            out = []
            for t in texts:
                if t is None or not tools or not any(c.isalpha() for c in t):
                    out.append((UND, 0.0, True))
                    continue
                parts = windows(t.encode(), window)
                sizes = np.array([sum(len(c.compress(p)) for p in parts) for c in tools], dtype=float)
                best = int(sizes.argmin())
                rest = np.delete(sizes, best)
                margin = (rest.min() - sizes[best]) / sizes[best] if len(rest) else 1.0
                out.append((names[best], float(1 - np.exp(-12 * margin)), bool(margin < narrow)))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "rejected"])
        give_back()

    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("lang_pred", "score", "rejected")]
    return df.select(*kept, predict(F.col(text)).alias("_guess")).select(*kept, "_guess.*")


def learned_fold(key: Column) -> Column:
    return ~held_out(key, 5, 0) & key.isNotNull()


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dicts = train(docs.where(learned_fold(F.col("doc_id"))), "text", "lang", "doc_id")
    rows = docs.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "text")
    return classify(rows, "text", dicts).drop("text")


QUERIES = {"op3_language": op3_language}
ORACLE: dict[str, str] = {}
