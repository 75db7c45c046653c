"""Removal of repeated strings, by a distributed merge sort of suffixes.

Every byte goes that is covered by a string of `width` bytes which also starts earlier: in a document before, or
further left in the same one. Strings are judged on the input and never reach across documents.

1. Anchors. Of the grams of `GRAM` bytes in a string of `width` bytes, the one with the least hash (the first of
   such) is the string's anchor. Equal strings have their anchors at the same place, so only strings whose anchor
   gram occurs more than once can be repeated. One shuffle of hashes finds these anchors: about one position in 31,
   before most of them drop out.
2. Suffixes at anchors. The strings of one anchor lie in a row; together they span a context. Tasks sort the suffixes
   that start at anchors, as far as the context goes and followed by what stands left of the anchor, front-code the
   sorted runs and exchange them by key ranges. A loser tree merges the runs; it knows from the front codes how many
   bytes neighbours share. Of equal contexts all but the first are repeated as a whole.
3. Strings. A distinct context that shares enough with a neighbour (the common prefixes of step 2 say how much)
   gives its single strings to a second exchange of the same kind: those that are equal to an earlier one are repeated.
4. The covered spans of each document are put together and cut out.

Equal suffixes collapse in the run that first holds them, so a text with any number of copies takes one place in
each run and no more, and a key range is not made heavy by it. Contexts that differ never meet in one place only
because they share an anchor: key ranges split between them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytehash, suffix_runs
from .common import binary, give_back, key_of, keyed, partitions, pieces, table

GRAM = 40
RUN_BYTES = 24_000_000
END = b"\xff"  # never a byte of UTF-8
ROWS = "part int, d long, r long, s long, e long, blob binary"


def _rows(part, d=0, r=0, s=0, e=0, blob=None) -> pd.DataFrame:
    n = len(part)
    full = lambda x: np.full(n, x) if np.isscalar(x) else x
    return pd.DataFrame({"part": full(part), "d": full(d), "r": full(r), "s": full(s), "e": full(e), "blob": blob if blob is not None else [None] * n})


# ---- step 1


def anchors_of(texts: list[bytes], width: int) -> tuple[np.ndarray, ...]:
    """For each anchor: number of its text, its place, first and last start of its strings, hash of its gram."""
    data, starts = bytehash.join(texts)
    sizes = np.diff(starts) - 1
    hashes = bytehash.grams(data, GRAM)
    reach = width - GRAM + 1
    n = len(data) - width + 1
    none = np.zeros(0, dtype=np.int64)
    if n <= 0 or not (sizes >= width).any():
        return none, none, none, none, np.zeros(0, dtype=np.uint64)
    # the hash's upper half decides; the place in the lower half makes the first of equal ones the least
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    step = 1
    while 2 * step <= reach:
        least = np.minimum(least[: len(least) - step], least[step:])
        step *= 2
    if reach > step:
        least = np.minimum(least[: len(least) - (reach - step)], least[reach - step :])
    delta = np.zeros(n + 1, dtype=np.int64)
    long = np.flatnonzero(sizes >= width)
    delta[starts[long]] += 1
    np.add.at(delta, starts[long] + sizes[long] - width + 1, -1)
    at = np.flatnonzero(np.cumsum(delta)[:n] > 0)
    anchor = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    first, last, place = at[new], at[np.concatenate([new[1:], [len(at)]]) - 1], anchor[new]
    doc = np.searchsorted(starts, place, side="right") - 1
    return doc, place - starts[doc], first - starts[doc], last - starts[doc], hashes[place]


def _pack(v: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.diff(v, prepend=0).tobytes())


def _unpack(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.int64).cumsum()


def _pack_rows(d: np.ndarray, r: np.ndarray, v: np.ndarray) -> bytes:
    """Anchors of many documents in one block."""
    order = np.lexsort((v, r, d))
    cols = np.diff(d[order], prepend=0), np.diff(r[order], prepend=0), np.diff(v[order], prepend=0)
    return zstandard.ZstdCompressor(level=1).compress(b"".join([len(d).to_bytes(8, "little"), *[c.tobytes() for c in cols]]))


def _unpack_rows(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(data[:8], "little")
    return np.frombuffer(data, np.int64, n, 8).cumsum(), np.frombuffer(data, np.int64, n, 8 + 8 * n).cumsum(), np.frombuffer(data, np.int64, n, 8 + 16 * n).cumsum()


BARE = 255


def _list_anchors(parts: int, width: int):
    """Anchors in blocks by hash. Grams that repeat within a piece are settled at once and send one bare entry."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in pieces(frames, "t"):
            doc, place, first, last, h = anchors_of(list(f["t"]), width)
            if not len(doc):
                continue
            d, r = f["d"].to_numpy()[doc], f["r"].to_numpy()[doc]
            before, after = place - first, place - last
            part = (h % np.uint64(parts)).astype(np.int64)
            h = h // np.uint64(parts)
            _, where, back, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
            twice = count[back] > 1
            if twice.any():
                # e = 1 marks what is settled
                yield _rows([int(d[0]) % parts], e=1, blob=[_pack_rows(d[twice], r[twice], (place << 16 | before << 8 | after)[twice])])
            before = np.where(twice, BARE, before)
            one = np.sort(where)
            order = one[np.argsort(part[one], kind="stable")]
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            blobs = []
            for p in range(parts):
                own = order[cuts[p] : cuts[p + 1]]
                if len(own):
                    # 40 bits of hash beside the part: a chance match costs a comparison later, no more
                    low = h[own].view(np.uint8).reshape(-1, 8)[:, :5]
                    cols = [low.T, np.diff(d[own], prepend=0), np.diff(r[own], prepend=0), np.diff(place[own], prepend=0).astype(np.int32), before[own].astype(np.uint8), after[own].astype(np.uint8)]
                    data = b"".join([len(own).to_bytes(8, "little"), *[np.ascontiguousarray(c).tobytes() for c in cols]])
                    blobs.append((p, zstandard.ZstdCompressor(level=1).compress(data)))
            yield _rows([p for p, _ in blobs], blob=[b for _, b in blobs])

    return run


def _meet_anchors(parts: int):
    """Blocks of the anchors whose gram occurs more than once in all texts, by document."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        found: list[tuple] = []
        for f in frames:
            for part, settled, blob in zip(f["part"], f["e"], f["blob"], strict=True):
                if settled:
                    found.append(_unpack_rows(blob))
                    continue
                data = zstandard.ZstdDecompressor().decompress(blob)
                n = int.from_bytes(data[:8], "little")
                wide = np.zeros((n, 8), dtype=np.uint8)
                wide[:, :5] = np.frombuffer(data, np.uint8, 5 * n, 8).reshape(5, n).T
                at, cols = 8 + 5 * n, [wide.view(np.uint64).ravel()]
                for kind in (np.int64, np.int64, np.int32, np.uint8, np.uint8):
                    cols.append(np.frombuffer(data, kind, n, at))
                    at += n * np.dtype(kind).itemsize
                cols[1], cols[2], cols[3] = cols[1].cumsum(), cols[2].cumsum(), cols[3].cumsum(dtype=np.int64)
                held.setdefault(part, []).append(cols)
        for part in sorted(held):
            h, d, r, place, before, after = (np.concatenate(x) for x in zip(*held.pop(part), strict=True))
            order = np.argsort(h, kind="stable")
            same = h[order][1:] == h[order][:-1]
            keep = order[(np.concatenate([[False], same]) | np.concatenate([same, [False]])) & (before[order] != BARE)]
            # a bare entry stands for grams that are settled; a lone place of the same gram elsewhere meets it here
            found.append((d[keep], r[keep], place[keep] << 16 | before[keep].astype(np.int64) << 8 | after[keep].astype(np.int64)))
        if not found:
            return
        d, r, v = (np.concatenate(x) for x in zip(*found, strict=True))
        to = (bytehash.mix(d.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        cuts = np.searchsorted(to[order], np.arange(parts + 1))
        out = [(p, _pack_rows(*(x[order[cuts[p] : cuts[p + 1]]] for x in (d, r, v)))) for p in range(parts) if cuts[p + 1] > cuts[p]]
        yield pd.DataFrame(out, columns=["part", "blob"])
        del held, found, d, r, v, to, order, out
        give_back()

    return run


def _gather_anchors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(d, r, anchors): all anchors of a document, packed in order."""
    held: dict[int, list] = {}
    for f in frames:
        for part, blob in zip(f["part"], f["blob"], strict=True):
            held.setdefault(part, []).append(_unpack_rows(blob))
    for part in sorted(held):
        d, r, v = (np.concatenate(x) for x in zip(*held.pop(part), strict=True))
        order = np.lexsort((v, r, d))
        d, r, v = d[order], r[order], v[order]
        new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (r[1:] != r[:-1])]))
        yield pd.DataFrame({"d": d[new], "r": r[new], "anchors": [_pack(x) for x in np.split(v, new[1:])]})
    give_back()


# ---- steps 2 and 3


class Runs:
    """Strings on their way into sorted, collapsed, front-coded runs, one block for each key range.

    A string comes with numbers (d, r, first, last, ...): its document, and the span start to last + width it stands for;
    the order of (d, r, first) tells which of equal strings is the earliest.
    """

    def __init__(self, splits: list[bytes], width: int):
        self.splits, self.width, self.items, self.size = splits, width, [], 0

    def add(self, key: bytes, numbers: tuple[int, ...]) -> None:
        self.items.append((key, numbers))
        self.size += len(key) + 120

    def full(self) -> bool:
        return self.size > RUN_BYTES

    def flush(self) -> Iterator[pd.DataFrame]:
        """Blocks of what is held, and the spans of strings that equal an earlier one of the run."""
        items, self.items, self.size = sorted(self.items), [], 0
        if not items:
            return
        keys, numbers, shared, covered = [], [], [], []
        for key, own in items:
            if keys and key == keys[-1]:
                covered.append(own[:4])
                continue
            shared.append(suffix_runs.common(keys[-1], key) if keys else 0)
            keys.append(key)
            numbers.append(own)
        if covered:
            yield _covered(covered, self.width, len(self.splits) + 1)
        out, numbers, start = [], np.array(numbers, dtype=np.int64), 0
        for part in range(len(self.splits) + 1):
            stop = bisect_left(keys, self.splits[part], start) if part < len(self.splits) else len(keys)
            if stop > start:
                out.append((part, suffix_runs.encode(keys[start:stop], shared[start:stop], numbers[start:stop])))
            start = stop
        yield _rows([p for p, _ in out], blob=[b for _, b in out])


def _covered(items: list[tuple[int, ...]], width: int, parts: int) -> pd.DataFrame:
    """Spans to remove, dealt out evenly; those of a document that touch are joined."""
    d, r, first, last = np.array(items, dtype=np.int64).T
    order = np.lexsort((first, r, d))
    d, r, first, end = d[order], r[order], first[order], last[order] + width
    doc = np.cumsum(np.concatenate([[0], (d[1:] != d[:-1]) | (r[1:] != r[:-1])]))
    far = int(end.max()) + 1
    reach = np.maximum.accumulate(doc * far + end)  # how far the spans of a document before this one go
    new = np.flatnonzero(np.concatenate([[True], doc[1:] * far + first[1:] > reach[:-1]]))
    end = reach[np.append(new[1:], len(reach)) - 1] - doc[new] * far
    return _rows((d[new] ^ first[new]) % parts, d[new], r[new], first[new], end)


def _context_runs(splits: list[bytes], width: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs = Runs(splits, width)
        for f in frames:
            for d, r, text, packed in zip(f["d"], f["r"], f["t"], f["anchors"], strict=True):
                for v in _unpack(packed).tolist():
                    place = v >> 16
                    first, last = place - (v >> 8 & 255), place - (v & 255)
                    right = text[place : last + width]
                    runs.add(right + END + text[first:place], (int(d), int(r), first, last, place))
                if runs.full():
                    yield from runs.flush()
        yield from runs.flush()
        give_back()

    return run


def _merged(held: dict[int, list[bytes]]) -> Iterator[list]:
    """Groups of equal strings in order: [bytes shared with the group before, string, first owner, the other owners]."""
    for part in sorted(held):
        group = None
        for shared, key, own in suffix_runs.merge(sorted(held[part])):
            if group and shared == len(key) == len(group[1]):
                group[3].append(own)
                continue
            if group:
                yield group
            group = [shared if group else -1, key, own, []]
        if group:
            yield group
        yield [-1, b"", None, []]  # the end of a key range


def _meet(splits: list[bytes] | None, width: int):
    """Merges the runs of a key range. Contexts (splits given) send strings on; of single strings (none) just the spans stay."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[bytes]] = {}
        for f in frames:
            done = f["blob"].isna()
            if done.any():
                yield f[done]
            for part, blob in zip(f["part"][~done], f["blob"][~done], strict=True):
                held.setdefault(part, []).append(blob)
        parts = 1 if splits is None else len(splits) + 1
        runs, covered, before = Runs(splits or [], width), [], None
        for group in _merged(held):
            shared, key, own, others = group
            if own is not None:
                first, *rest = sorted([own, *others])
                covered += [x[:4] for x in rest]
                group[2] = first
            if splits is not None:
                if before and before[2] is not None:
                    _strings(before, before[0], shared, runs, width)
                    if runs.full():
                        yield from runs.flush()
                before = group
            if len(covered) > 100_000:
                yield _covered(covered, width, parts)
                covered = []
        if covered:
            yield _covered(covered, width, parts)
        covered = []
        yield from runs.flush()
        give_back()

    return run


def _strings(group: list, left: int, right: int, runs: Runs, width: int) -> None:
    """Adds the strings of a context that another one may hold: such a one shares as much after the anchor as they need.

    left, right: bytes shared with the neighbours in order; -1 at an end of the key range, where the neighbour isn't seen.
    """
    _, key, (d, r, first, last, place), _ = group
    after = key.index(END)
    most = after if min(left, right) < 0 else min(after, max(left, right))
    whole = key[after + 1 :] + key[:after]
    for start in range(first, min(last, place - width + most) + 1):
        runs.add(whole[start - first : start - first + width], (d, r, start, start))


# ---- step 4


def joined(spans) -> list[tuple[int, int]]:
    """Spans (structs s, e; null for none) in order, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted((int(x["s"]), int(x["e"])) for x in (spans if spans is not None else [])):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        out = []
        for text, spans in zip(f["t"], f["spans"], strict=True):
            gone = joined(spans)
            kept, at = [], 0
            for s, e in gone:
                kept.append(text[at:s])
                at = e
            kept.append(text[at:])
            out.append((len(text), sum(e - s for s, e in gone), [{"start": s, "end": e} for s, e in gone], b"".join(kept)))
        yield pd.DataFrame({"d": f["d"], "r": f["r"], **{k: [x[i] for x in out] for i, k in enumerate(("n_bytes", "n_removed", "spans", "kept"))}})
    give_back()


def split_keys(texts: DataFrame, parts: int, per_part: int = 64) -> list[bytes]:
    """parts - 1 strings that cut the suffixes in ranges of like size, from a sample of per_part suffixes a range.

    The sample only balances the work; every suffix finds its range whatever the splits are.
    """
    n = texts.count()
    share = min(1.0, parts * per_part / max(1, n))
    at = F.pmod(F.xxhash64("d", F.lit("at")), F.greatest(F.length("t"), F.lit(1))).cast("int") + 1
    some = texts.where(F.pmod(F.xxhash64("d", F.lit("split")), F.lit(1 << 20)) < share * (1 << 20)).select(F.substring("t", at, F.lit(24)).alias("k")).limit(4 * parts * per_part)
    keys = sorted({bytes(r["k"]) for r in some.collect()})
    return sorted({keys[i * len(keys) // parts] for i in range(1, parts)}) if keys else []


def repeated_spans(texts: DataFrame, width: int) -> DataFrame:
    """(d, r, spans) of the documents that hold repeated strings, the spans in no order (see joined); texts: (d long, r long, t binary)."""
    parts = max(2, partitions(texts.sparkSession))
    splits = split_keys(texts, parts)
    met = texts.mapInPandas(_list_anchors(parts, width), ROWS).repartition(parts, "part").mapInPandas(_meet_anchors(parts), "part int, blob binary")
    found = met.repartition(parts, "part").mapInPandas(_gather_anchors, "d long, r long, anchors binary")
    contexts = texts.join(found, ["d", "r"]).mapInPandas(_context_runs(splits, width), ROWS)
    strings = contexts.repartition(parts, "part").mapInPandas(_meet(splits, width), ROWS)
    covered = strings.repartition(parts, "part").mapInPandas(_meet(None, width), ROWS)
    return covered.groupBy("d", "r").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def dedup(df: DataFrame, text: str, key: str, *, width: int = 100) -> DataFrame:
    """One row (key, d, r, n_bytes, n_removed, spans, kept) for each row of df: `kept` are the bytes that stay.

    width is between GRAM + 1 and 255. Null texts are empty. Texts shorter than width stay as they are; others are read whole, however
    long. Copies of a text in later rows go as a whole. See keyed for null and repeated keys. An empty table gives an empty result.
    Other columns of df are not looked at, whatever their names are.
    """
    texts = keyed(df, key, text).select("d", "r", binary().alias("t"))
    out = texts.join(repeated_spans(texts, width), ["d", "r"], "left").mapInPandas(_cut, "d long, r long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")
    return out.select(key_of().alias(key), "*")


def brute_force(docs: list[tuple[int, bytes]], width: int) -> list[list[tuple[int, int]]]:
    """The spans to remove of each document, by a table of all strings; for tests."""
    seen: dict[bytes, int] = {}
    out = []
    for _, t in docs:
        spans: list[list[int]] = []
        for s in range(len(t) - width + 1):
            x = t[s : s + width]
            if x in seen:
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = s + width
                else:
                    spans.append([s, s + width])
            seen[x] = 1
        out.append([tuple(x) for x in spans])
    return out


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(table(spark, sf_dir, "documents"), "text", "doc_id")
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


# bytes as pairs of hexadecimal digits; strings of 100 bytes by their md5
_SQL = """WITH h AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
 blocks AS MATERIALIZED (SELECT doc_id, 1024 * b AS first, substr(h, 2048 * b + 1, 2246) AS h FROM h, LATERAL (SELECT unnest(range(0, length(h) // 2048 + 1)) AS b)),
 starts AS (SELECT doc_id, first + i AS i, md5_number(substr(h, 2 * i + 1, 200)) AS s FROM blocks, LATERAL (SELECT unnest(range(0, least(1024, length(h) // 2 - 99))) AS i)),
 again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS place FROM starts) WHERE place > 1),
 runs AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh FROM again)),
 spans AS MATERIALIZED (SELECT doc_id, min(i) AS s, max(i) + 100 AS e FROM runs GROUP BY doc_id, run),
 cuts AS (SELECT doc_id, s, e FROM spans UNION ALL SELECT doc_id, length(h) // 2, length(h) // 2 FROM h),
 kept AS (SELECT doc_id, string_agg(substr(h, 2 * up + 1, 2 * (s - up)), '' ORDER BY s, e) AS k FROM (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s, e), 0) AS up FROM cuts) JOIN h USING (doc_id) GROUP BY doc_id)
SELECT h.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(sum(e - s), 0) AS BIGINT) AS n_removed, count(s) AS n_spans, sha256(unhex(any_value(k))) AS kept_sha256 FROM h JOIN kept ON kept.doc_id = h.doc_id LEFT JOIN spans ON spans.doc_id = h.doc_id GROUP BY h.doc_id, h"""

QUERIES = {"op1_suffix_dedup": op1_suffix_dedup}
ORACLE: dict[str, str] = {"op1_suffix_dedup": _SQL}
