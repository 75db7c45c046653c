"""BPE encoding and decoding by a table of distinct words.

A tokenizer of this kind normalises a text, splits it into words and encodes each word by itself. So a task splits its
texts, encodes each distinct word once, and joins the ids back by position. Decoding joins the ids to their pieces. Both
tables belong to the task: words are encoded once for a task, not once for the corpus, since ids that come back through
a shuffle by document and position would move many times the text (see the README).
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back, short_batches, table

PLAIN = "֏"  # up to here, all versions of Unicode agree on letters and numbers


def splitter() -> re.Pattern:
    """How the vocabulary's tokenizer splits normalised text, where the only white space left is the blank; for characters up to
    PLAIN. The first characters of the alternatives differ, but for those after an apostrophe, so letters can come first."""
    plain = [chr(i) for i in range(ord(PLAIN) + 1)]
    letters, numbers = ("".join(re.escape(c) for c in plain if unicodedata.category(c)[0] == kind) for kind in "LN")
    return re.compile(f"[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d|[{numbers}]|[^ {letters}{numbers}]+")


MOST_WORDS = 300_000  # a task's table starts anew beyond this; words then are encoded once more


class WordTable:
    """Encodes texts word by word as the tokenizer file does, without truncation, padding or added special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        # the model takes the bytes of a word as characters: printable ones stand for themselves, the others follow from 256 on
        shown, others = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}, iter(range(0x100, 0x200))
        self.chars = {b: chr(b if b in shown else next(others)) for b in range(256)}
        special = self.whole.get_added_tokens_decoder()
        self.special = {t.content: np.array([i], dtype=np.int32).tobytes() for i, t in special.items()}
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if special else None
        self.split = splitter()
        self.pieces = np.full(self.whole.get_vocab_size(with_added_tokens=True), "", dtype=object)
        for piece, i in self.whole.get_vocab(with_added_tokens=True).items():
            self.pieces[i] = piece
        self.ids: dict[str, bytes] = {}  # of each word, packed

    def words(self, text: str) -> list[str]:
        if self.cut is None or not self.cut.search(text):
            parts = [text]
        else:
            parts = self.cut.split(text)
        out: list[str] = []
        for p in parts:
            if p in self.special:
                out.append(p)
                continue
            p = self.whole.normalizer.normalize_str(p)
            if p.isascii() or max(p) <= PLAIN:
                out += self.split.findall(p)
            else:
                # the library's own splitting; characters of its words are bytes, which the encoder takes back apart
                out += [p[s:e] for _, (s, e) in self.whole.pre_tokenizer.pre_tokenize_str(p)]
        return out

    def learn(self, words: Iterable[str]) -> None:
        """Enters words into the table. They are normalised already, with the text they stand in: the library's model encodes them as they
        are, since to normalise again would change the order of some combining marks."""
        model, chars = self.whole.model, self.chars
        for w in words:
            self.ids[w] = np.array([t.id for t in model.tokenize(w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(chars))], dtype=np.int32).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        split = [self.words(t) for t in texts]
        if len(self.ids) > MOST_WORDS:
            self.ids = {}
        self.ids |= self.special
        self.learn(set().union(*split) - self.ids.keys())
        ids = self.ids.__getitem__
        return [np.frombuffer(b"".join(map(ids, words)), dtype=np.int32) for words in split]


_tables: dict[str, WordTable] = {}


def _table(path: str) -> WordTable:
    if path not in _tables:
        _tables[path] = WordTable(path)
    return _tables[path]


def _slices(batches: Iterator[pd.Series], most: int = 1_500_000) -> Iterator[list]:
    """The values of the batches in slices of about `most` characters or ids."""
    for b in batches:
        held, n = [], 0
        for x in b:
            held.append(x)
            n += len(x) if x is not None else 0
            if n > most:
                yield held
                held, n = [], 0
        if held:
            yield held


def _joined(pieces: np.ndarray, ids) -> str:
    return " ".join(pieces[ids].tolist()) if ids is not None and len(ids) else ""


def encode(text: Column, path: str, *, decoded: bool = False) -> Column:
    """The ids of each whole text, as array<int>; null and empty texts have none. path: the vocabulary file, present on all workers.

    With `decoded`, a struct (ids, decoded): what decode() makes of the ids, looked up in the same table of ids and pieces while they
    are at hand.
    """

    @F.pandas_udf("ids array<int>, decoded string" if decoded else "array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own, pieces = _table(path), _pieces(path) if decoded else None
        for texts in _slices(batches):
            ids = own.encode([t or "" for t in texts])
            yield pd.DataFrame({"ids": ids, "decoded": [_joined(pieces, x) for x in ids]}) if decoded else pd.Series(ids, dtype=object)
        own.ids, ids = {}, []  # a task's table ends with it
        give_back()

    return run(text)


def decode(ids: Column, path: str) -> Column:
    """The text of ids, as the tokenizer decodes them with special tokens kept: without a decoder, pieces with blanks between. Null and
    empty lists give an empty text."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = _pieces(path)
        for b in _slices(batches):
            yield pd.Series([_joined(pieces, x) for x in b], dtype=object)

    return run(ids)


def _pieces(path: str) -> np.ndarray:
    """The table of ids and pieces."""
    own = _table(path)
    if own.whole.decoder is not None:
        raise ValueError("ids are decoded by joining pieces, which is what a vocabulary file without a decoder asks for")
    return own.pieces


def tokenize(df: DataFrame, text: str, path: str) -> DataFrame:
    """df with ids and decoded, the text of the ids; they replace columns of those names. Repeated rows give repeated results, texts of
    any length are encoded whole, and an empty table gives an empty result."""
    short_batches(df.sparkSession)
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("ids", "decoded")]
    return df.select(*kept, encode(F.col(text), path, decoded=True).alias("_coded")).select(*kept, "_coded.ids", "_coded.decoded")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def digests(df: DataFrame) -> DataFrame:
    spelled = F.array_join(F.col("ids").cast("array<string>"), " ")
    return df.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(spelled.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(tokenize(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", vocabulary()))


QUERIES = {"op6_bpe": op6_bpe}
ORACLE: dict[str, str] = {}
