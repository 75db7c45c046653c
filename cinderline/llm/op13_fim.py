"""Fill-in-the-middle: a text is cut at two places between code points, and its parts change their order.

Where code points begin is a set of byte offsets, held as roaring bitmaps are: a container for each 65,536 bytes, which is a sorted
array of offsets, a bitmap, or runs, whichever is smallest, with the number of members before each container. The member of a given
rank is found by a search in these numbers and a selection within one container; both cuts of a text are found so, and the text is
cut as bytes. ASCII is one run a container, so the set of a plain text of any length takes a few bytes for each 64 KB.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import short_batches, table

BLOCK = 1 << 16
MARKS = {"p": "<P>", "s": "<S>", "m": "<M>"}


class Boundaries:
    """Byte offsets at which the code points of a text begin, and its end: rank k is the offset after k code points."""

    def __init__(self, data: bytes):
        own = np.frombuffer(data, dtype=np.uint8)
        # a byte that does not continue a code point begins one; the end of the text is a member too
        begins = np.append((own & 0xC0) != 0x80, True)
        self.containers: list[tuple[str, np.ndarray]] = []
        counts = []
        for at in range(0, len(begins), BLOCK):
            kind, held, n = _container(begins[at : at + BLOCK])
            self.containers.append((kind, held))
            counts.append(n)
        self.before = np.concatenate([[0], np.cumsum(counts)])  # members before each container

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The member of rank k, from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        c = int(np.searchsorted(self.before, k, side="right")) - 1
        return c * BLOCK + _local(*self.containers[c], k - int(self.before[c]))


def _container(mask: np.ndarray) -> tuple[str, np.ndarray, int]:
    """(kind, members, how many) of up to 65,536 flags, in the form that takes the fewest bytes."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).view(np.int8)))
    n, runs = int(mask.sum()), len(edges) // 2
    sizes = {"run": 4 * runs, "array": 2 * n, "bitmap": BLOCK // 8}
    kind = min(sizes, key=sizes.get)
    if kind == "run":
        return kind, np.stack([edges[0::2], edges[1::2] - edges[0::2] - 1]).astype(np.uint16), n  # first member, length less one
    if kind == "array":
        return kind, np.flatnonzero(mask).astype(np.uint16), n
    return kind, np.packbits(mask, bitorder="little"), n


def _local(kind: str, held: np.ndarray, k: int) -> int:
    """The member of rank k of one container."""
    if kind == "array":
        return int(held[k])
    if kind == "run":
        lengths = held[1].astype(np.int64) + 1
        before = np.cumsum(lengths) - lengths
        r = int(np.searchsorted(before, k, side="right")) - 1
        return int(held[0][r]) + k - int(before[r])
    upto = np.cumsum(np.bitwise_count(held), dtype=np.int64)
    byte = int(np.searchsorted(upto, k, side="right"))
    k -= int(upto[byte - 1]) if byte else 0
    return 8 * byte + int(np.flatnonzero(np.unpackbits(held[byte : byte + 1], bitorder="little"))[k])


def draws(key: Column) -> list[Column]:
    """Four numbers of 32 bits that follow from the key alone; a null key draws as an empty one."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def _cut(text: Column, h1: Column, h2: Column, form: Column) -> Column:
    """Struct (n, prefix_chars, middle_chars, output) of each text; plain texts are not cut."""

    @F.pandas_udf("n bigint, prefix_chars bigint, middle_chars bigint, output string")
    def run(texts: pd.Series, first: pd.Series, second: pd.Series, forms: pd.Series) -> pd.DataFrame:
        rows = []
        for t, a, b, kind in zip(texts, first, second, forms, strict=True):
            data = t.encode()
            ends = Boundaries(data)
            n = len(ends) - 1
            if kind == "plain":
                rows.append((n, None, None, t))
                continue
            low, high = sorted((int(a) % (n + 1), int(b) % (n + 1)))
            i, j = ends.select(low), ends.select(high)
            parts = {"p": data[:i], "m": data[i:j], "s": data[j:]}
            rows.append((n, low, high - low, "".join(MARKS[x] + parts[x].decode() for x in kind)))
        out = pd.DataFrame(rows, columns=["n", "prefix_chars", "middle_chars", "output"])
        return out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    return run(text, h1, h2, form)


def transform(df: DataFrame, text: str, key: str, *, fim_percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """df with n, form, prefix_chars, middle_chars and output; these replace columns that are called so.

    A text stays plain if it is null or empty, if it holds a mark, or in 100 - fim_percent of 100 cases; else spm_percent of 100 have
    the suffix first. All draws follow from the key, so repeated rows give repeated results and a task that runs again gives the same;
    a null key draws as an empty one. Texts are cut whole at any length. Nulls count as empty texts. An empty table gives an empty result.
    """
    short_batches(df.sparkSession)
    made = ("n", "form", "prefix_chars", "middle_chars", "output")
    kept = [c for c in df.columns if c.lower() not in made]
    h1, h2, h3, h4 = draws(F.col(f"`{key}`"))
    own = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    marked = F.lit(False)
    for m in MARKS.values():
        marked = marked | F.contains(F.col("_t"), F.lit(m))
    plain = (F.col("_t") == "") | marked | (h3 % 100 >= fim_percent)
    out = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.col(f"`{key}`"), own.alias("_t"))
    out = out.select("_row", "_t", h1.alias("_h1"), h2.alias("_h2"), F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm").alias("form"))
    out = out.select("_row", "form", _cut(F.col("_t"), F.col("_h1"), F.col("_h2"), F.col("form")).alias("_cut"))
    return out.select(*[F.col("_row")[c].alias(c) for c in kept], "form", "_cut.n", "_cut.prefix_chars", "_cut.middle_chars", "_cut.output")


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of. Marks occur in no part, so the places where they stand are certain."""
    parts = F.split(F.substr(output, F.lit(4)), "|".join(MARKS.values()), -1)
    return F.when(form == "plain", output).when(form == "psm", F.concat(parts[0], parts[2], parts[1])).when(form == "spm", F.concat(parts[1], parts[2], parts[0]))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = transform(docs, "text", "doc_id")
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


_H = ", ".join(f"('0x' || substr(h, {8 * i + 1}, 8))::BIGINT AS h{i + 1}" for i in range(4))
_SQL = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
 e AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, {_H} FROM d),
 f AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM e),
 g AS (SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1) AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM g"""

QUERIES = {"op13_fim": op13_fim}
ORACLE: dict[str, str] = {"op13_fim": _SQL}
