"""Token ids in binary files, with document boundaries in Elias-Fano form.

A file holds a segment: some millions of ids of documents that follow each other in the order of their keys, joined without gaps, and
two monotone sequences, where documents begin and what their keys are. Each is kept as Elias and Fano describe: the low bits of every
value side by side, the high bits in unary, in all about 2 + log2(range / values) bits a value, and the place of every 256th one bit,
so that a value is found by decoding one stretch of the unary part. No table has an entry of 64 bits for each document.

Documents are laid out by ranges of keys; a task sorts its range, encodes it and hands on segments as it goes, which Spark's own writer
puts into files of one segment, so a task that is lost leaves nothing behind and runs again. Offsets within the whole corpus need the
number of ids before each segment, which the headers tell.
"""

from __future__ import annotations

import os
import re
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import give_back, keyed, shared_folder, table

HEADER = 256  # bytes: the fields of FIELDS as decimal numbers after the name of the format, with blanks up to the end
FORMAT = "CTOK1"
FIELDS = ("width", "part", "seq", "docs", "ids", "nulls", "first_key", "key_range")
STEP = 256  # one bits from one entry of the select structure to the next


class EliasFano:
    """A sequence that never falls, from 0 to `most`."""

    def __init__(self, n: int, most: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.most, self.bits = n, most, _low_bits(n, most)
        self.low, self.high, self.samples = (np.frombuffer(x, dtype=t) for x, t in ((low, np.uint8), (high, np.uint8), (samples, "<u4")))

    @classmethod
    def of(cls, values: np.ndarray, most: int) -> EliasFano:
        v, n = values.astype(np.uint64), len(values)
        bits = np.uint64(_low_bits(n, most))
        low = (v[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
        high = np.zeros(n + (most >> int(bits)) + 1, dtype=bool)
        ones = (v >> bits).astype(np.int64) + np.arange(n)
        high[ones] = True
        return cls(n, most, np.packbits(low.astype(bool).ravel(), bitorder="little").tobytes(), np.packbits(high, bitorder="little").tobytes(), ones[::STEP].astype("<u4").tobytes())

    @staticmethod
    def sizes(n: int, most: int) -> tuple[int, int, int]:
        """Bytes of the low bits, the high bits, and the select structure."""
        bits = _low_bits(n, most)
        return -(-n * bits // 8), -(-(n + (most >> bits) + 1) // 8), 4 * -(-n // STEP)

    def stretch(self, s: int) -> np.ndarray:
        """Values s * STEP to (s + 1) * STEP, by the select structure: the one bits between two of its entries."""
        first = s * STEP
        n = min(STEP, self.n - first)
        begin = int(self.samples[s])
        end = int(self.samples[s + 1]) if s + 1 < len(self.samples) else 8 * len(self.high)
        flags = np.unpackbits(self.high[begin // 8 : -(-end // 8)], bitorder="little")[begin % 8 :]
        ones = np.flatnonzero(flags)[:n] + begin - np.arange(first, first + n)
        if not self.bits:
            return ones.astype(np.uint64)
        at = first * self.bits
        low = np.unpackbits(self.low[at // 8 : -(-(at + n * self.bits) // 8)], bitorder="little")[at % 8 :][: n * self.bits].reshape(n, self.bits)
        parts = low.astype(np.uint64) << np.arange(self.bits, dtype=np.uint64)
        return (ones.astype(np.uint64) << np.uint64(self.bits)) | np.bitwise_or.reduce(parts, axis=1)

    def select(self, i: int) -> int:
        """Value i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        return int(self.stretch(i // STEP)[i % STEP])

    def tobytes(self) -> bytes:
        return self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()


def _low_bits(n: int, most: int) -> int:
    """How many low bits of each value are kept as they are: about log2 of the mean gap."""
    return max(0, (most // max(n, 1)).bit_length() - 1)


class Segment:
    """The content of one file: documents by place, their ids and keys, without decoding the rest."""

    def __init__(self, content: bytes):
        name, *given = bytes(content[:HEADER]).decode("ascii").split()
        if name != FORMAT:
            raise ValueError(f"no token file: it begins with {name!r}")
        self.head = dict(zip(FIELDS, map(int, given), strict=True))
        h, at = self.head, HEADER + self.head["ids"] * self.head["width"]
        self.ids = np.frombuffer(content, dtype=f"<u{h['width']}", count=h["ids"], offset=HEADER)
        self.bounds, at = _sequence(content, at, h["docs"] + 1, h["ids"])
        self.keys, at = _sequence(content, at, h["docs"] - h["nulls"], h["key_range"])

    def __len__(self) -> int:
        return self.head["docs"]

    def __getitem__(self, i: int) -> np.ndarray:
        """The ids of document i of the segment."""
        return self.ids[self.bounds.select(i) : self.bounds.select(i + 1)]

    def key(self, i: int) -> int | None:
        """The key of document i; those of null keys come first."""
        return self.keys.select(i - self.head["nulls"]) + self.head["first_key"] if i >= self.head["nulls"] else None

    def stretches(self) -> Iterator[tuple[int, np.ndarray, list]]:
        """(first document, the bounds of up to STEP documents and the end of the last, their keys)."""
        for s in range(-(-len(self) // STEP)):
            bounds = self.bounds.stretch(s).astype(np.int64)[: len(self) - s * STEP]
            last = min(len(self), (s + 1) * STEP)
            yield s * STEP, np.append(bounds, self.bounds.select(last)), [self.key(i) for i in range(s * STEP, min(last, self.head["nulls"]))] + self._keys(max(s * STEP, self.head["nulls"]), last)

    def _keys(self, a: int, b: int) -> list[int]:
        a, b = a - self.head["nulls"], b - self.head["nulls"]
        if b <= a:
            return []
        held = np.concatenate([self.keys.stretch(s) for s in range(a // STEP, (b - 1) // STEP + 1)])[a % STEP :][: b - a]
        return [int(x) + self.head["first_key"] for x in held]


def _sequence(content: bytes, at: int, n: int, most: int) -> tuple[EliasFano, int]:
    parts = []
    for size in EliasFano.sizes(n, most):
        parts.append(content[at : at + size])
        at += size
    return EliasFano(n, most, *parts), at


def pack(part: int, seq: int, ids: bytes, width: int, lengths: list[int], keys: list[int | None]) -> bytes:
    """A segment of documents in the order of their keys, nulls first."""
    bounds = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    known = [k for k in keys if k is not None]
    first, span = (known[0], known[-1] - known[0]) if known else (0, 0)
    gaps = np.array([k - first for k in known], dtype=np.uint64)
    head = " ".join(map(str, (FORMAT, width, part, seq, len(keys), int(bounds[-1]), len(keys) - len(known), first, span)))
    return head.ljust(HEADER).encode("ascii") + ids + EliasFano.of(bounds, int(bounds[-1])).tobytes() + EliasFano.of(gaps, span).tobytes()


PLAIN = "֏"  # up to here, all versions of Unicode agree on letters, numbers and white space


class ByteWords:
    """Ids of whole texts by a byte-level vocabulary file, as packed bytes. The file's own model encodes each distinct word once."""

    MOST_WORDS = 300_000  # the table starts anew beyond this; words then are encoded once more

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        kind = str(self.whole.pre_tokenizer)
        if self.whole.normalizer is not None or "ByteLevel(add_prefix_space=False" not in kind or "use_regex=True" not in kind:
            raise ValueError("made for byte-level vocabularies without normalisation or a blank put before the text")
        self.width = 2 if self.whole.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.dtype = f"<u{self.width}"
        special = self.whole.get_added_tokens_decoder()
        self.special = {t.content: self._packed([i]) for i, t in special.items()}
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if special else None
        plain = [chr(i) for i in range(ord(PLAIN) + 1)]
        letters, numbers = ("".join(re.escape(c) for c in plain if unicodedata.category(c)[0] == kind) for kind in "LN")
        white = "\t\n\x0b\x0c\r \x85\xa0"
        self.split = re.compile(f" ?[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{numbers}]+| ?[^{white}{letters}{numbers}]+|[{white}]+(?![^{white}])|[{white}]+")
        # a byte's character in the model's words: printable ones stand for themselves, the others follow from 256 on
        shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        others = iter(range(0x100, 0x200))
        self.chars = {b: chr(b if b in shown else next(others)) for b in range(256)}
        self.table: dict[str, bytes] = {}

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def words(self, text: str) -> list[str]:
        parts = self.cut.split(text) if self.cut is not None and self.cut.search(text) else [text]
        out: list[str] = []
        for p in parts:
            if p in self.special:
                out.append(p)
            elif p.isascii() or max(p, default="") <= PLAIN:
                out += self.split.findall(p)
            else:
                out += [p[s:e] for _, (s, e) in self.whole.pre_tokenizer.pre_tokenize_str(p)]
        return out

    def encode(self, text: str) -> bytes:
        words = self.words(text)
        if len(self.table) > self.MOST_WORDS:
            self.table = {}
        known, chars, model = self.table, self.chars, self.whole.model
        for w in set(words).difference(known):
            known[w] = self.special.get(w) or self._packed([t.id for t in model.tokenize(w.encode().decode("latin-1").translate(chars))])
        return b"".join(map(known.__getitem__, words))


_words: dict[str, ByteWords] = {}


def write(docs: DataFrame, key: str, text: str, vocabulary: str, folder: str, *, end_id: int = 0, segment_ids: int = 2_000_000) -> None:
    """Writes the ids of all texts, in ascending order of keys, as files of about segment_ids ids, each with a segment.

    Null texts count as empty, each text is followed by end_id. Rows of one key follow each other in the order of their texts, those of
    null keys come first; repeated rows are written as often as they occur. A text is never cut: one of more than segment_ids ids is
    a segment of its own. An empty table gives a folder without segments. vocabulary: a file that all workers have.
    """
    laid = keyed(docs, key, text).repartitionByRange("d", "r").sortWithinPartitions("d", "r")
    rows = laid.select(F.when(F.col("r") >= 0, F.col("d")).alias("d"), F.coalesce("t", F.lit("")).alias("t"))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _words:
            _words[vocabulary] = ByteWords(vocabulary)
        own, part, seq = _words[vocabulary], TaskContext.get().partitionId(), 0
        ids, lengths, keys, held = [], [], [], 0
        end = own._packed([end_id])

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"segment": pa.array([pack(part, seq, b"".join(ids), own.width, lengths, keys)], pa.binary())})

        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                coded = own.encode(t.as_py()) + end
                n = len(coded) // own.width
                if held and held + n > segment_ids:
                    yield full()
                    ids, lengths, keys, held, seq = [], [], [], 0, seq + 1
                ids.append(coded)
                lengths.append(n)
                keys.append(k)
                held += n
        if keys:
            yield full()
        own.table = {}  # a task's table ends with it
        give_back()

    # the text writer puts the bytes of a value into the file as they are, and one line end after them
    made = rows.mapInArrow(segments, "segment binary").select(F.col("segment").cast("string").alias("value"))
    made.write.option("maxRecordsPerFile", 1).option("compression", "none").text(folder)


def files(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder: their content, the fields of their headers, and `before`, the number of ids in all files before each."""
    held = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).where("length > 0")
    fields = F.split(F.trim(F.substring("content", 1, HEADER).cast("string")), " ")
    held = held.select("content", *[fields[i + 1].cast("decimal(20,0)" if f == "key_range" else "bigint").alias(f) for i, f in enumerate(FIELDS)])
    # sums of the parts, of which there are no more than shuffle partitions; then within each part
    heads = held.select("part", "seq", "ids")
    parts = heads.groupBy("part").agg(F.sum("ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    before = heads.select("part", "seq", (F.sum("ids").over(inside) - F.col("ids")).alias("inside")).join(F.broadcast(parts), "part")
    # one small row for each file
    return held.join(F.broadcast(before.select("part", "seq", (F.col("base") + F.col("inside")).alias("before"))), ["part", "seq"])


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document of the files. start counts the ids of all documents before it; the check sum
    is that of its ids as little-endian numbers of 32 bits."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content, before in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                own = Segment(content.as_buffer())
                for _, bounds, keys in own.stretches():
                    wide = own.ids[bounds[0] : bounds[-1]].astype("<u4").tobytes()
                    at = ((bounds - bounds[0]) * 4).tolist()
                    sums = [zlib.crc32(memoryview(wide)[a:e]) for a, e in zip(at[:-1], at[1:], strict=True)]
                    yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.int64()), "start": pa.array(bounds[:-1] + before, pa.int64()), "n_tokens": pa.array(np.diff(bounds), pa.int64()), "ids_crc32": pa.array(sums, pa.int64())})
        give_back()

    return files(spark, folder).select("content", "before").mapInArrow(read, "key bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"), folder)
    return documents(spark, folder).withColumnRenamed("key", "doc_id")


QUERIES = {"op12_token_files": op12_token_files}
ORACLE: dict[str, str] = {}
