"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs are quantised on a logarithmic scale: an n-gram of level q goes into the filter together
with each of 1 to q. A count is read back by probing for levels 1, 2, ... until one is missing, so the filter errs
upwards only, and rarely by more than a level. The filter is built in segments, one for each part of the hashes.

`train_and_score`, which the query uses, tells texts that are learned from and texts that are not in one pass: the distinct words and pairs of
a batch of texts go to their parts, where they are counted, put into the segment and looked up in it, and levels and exact counts come back
to the batch. Nothing is broadcast that grows with the input, and no task holds more than a part or a batch.

`train` and `score` are for texts that come later: the filter is broadcast where it has `broadcast_bytes` at most. A larger one stays in its
segments: the distinct words and pairs of each piece of texts go to them, packed by part, are probed there, and their levels come back. All
ways give the same scores.

A word's probability after another is a mixture of its share among the pairs and its smoothed share among
all words; the weight of the pairs depends on how often the first word was seen.

The probabilities of all words after one add up to 1 at most, in expectation over the filter's errors: a count that is divided is
the least one of its level, one that divides is the greatest, and to the latter is added what the filter's false hits give all words
of the vocabulary together.

Beside this score stands the exact smoothed unigram score. In `score` the counts of the most frequent words of each part, `head` in all,
are broadcast for it (16 bytes a word); all other words meet their exact counts through a shuffle by hash.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytehash
from .common import binary, checkpoint, give_back, held_out, key_of, keyed, partitions, pieces, table

END = np.uint64(0x5851F42D4C957F2D)  # stands for the end of a text in the hashes, and before its first word
LEVELS = np.unique(np.ceil(1.3 ** np.arange(100)).astype(np.int64))  # least count of each level
LEAST = np.concatenate([[0.0], LEVELS])  # least and greatest count of level q
MOST = np.concatenate([[0.0], LEVELS[1:] - 1.0, [np.inf]])
BITS, PROBES = 10, 4  # bits of filter for each entry, bits set for each
GROUPS = 12
ROWS = "part int, kind int, d long, r long, a double, b double, n long, blob binary"


def sequences(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the tokens of all texts, each text's words and then END; where each text starts, and the end)."""
    hashes, first = bytehash.words(texts)
    starts = first + np.arange(len(first))
    out = np.empty(len(hashes) + len(texts), dtype=np.uint64)
    ends = np.zeros(len(out), dtype=bool)
    ends[starts[1:] - 1] = True
    out[ends] = END
    out[~ends] = hashes
    return out, starts


def contexts(tokens: np.ndarray) -> np.ndarray:
    """The token before each one; END before a text's first."""
    return np.concatenate([[END], tokens[:-1]]).astype(np.uint64)


def pair(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return bytehash.mix(before * np.uint64(bytehash.BASE) + token)


# ---- counting


def _summed(h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order]
    new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, dtype=np.int64)
    return h[new], np.add.reduceat(c, new) if len(h) else c


def _counted(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes in order, and how often each one occurs."""
    h = np.sort(h)
    new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, dtype=np.int64)
    return h[new], np.diff(np.concatenate([new, [len(h)]]))


def _block(h: np.ndarray, c: np.ndarray, wide: int) -> bytes:
    """Hashes with `wide` of their bytes; counts as single bytes, those from 255 on apart."""
    large = c >= 255
    low = h.view(np.uint8).reshape(-1, 8)[:, :wide]
    return b"".join([np.array([len(h), large.sum()], dtype=np.int64).tobytes(), np.minimum(c, 255).astype(np.uint8).tobytes(), c[large].astype(np.int64).tobytes(), low.tobytes()])


def _unblock(data: bytes, wide: int) -> tuple[np.ndarray, np.ndarray]:
    n, m = (int(x) for x in np.frombuffer(data, np.int64, 2))
    c = np.frombuffer(data, np.uint8, n, 16).astype(np.int64)
    c[c == 255] = np.frombuffer(data, np.int64, m, 16 + n)
    full = np.zeros((n, 8), dtype=np.uint8)
    full[:, :wide] = np.frombuffer(data, np.uint8, n * wide, 16 + n + 8 * m).reshape(n, wide)
    return full.view(np.uint64).ravel(), c


def _emit(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["part", "kind", "d", "r", "a", "b", "n", "blob"])


def _parts(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by part, what is left of the hashes, where each part starts)."""
    p = (h % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)  # short numbers are sorted by their digits
    order = np.argsort(p, kind="stable")
    return order, h // np.uint64(parts), np.searchsorted(p[order], np.arange(parts + 1))


def _count(parts: int):
    """Counts of words (kind 0, whole hashes) and pairs (kind 1, 48 bits beside the part) of a task's texts, by part."""

    def send(held: list[list[np.ndarray]]) -> Iterator[pd.DataFrame]:
        for kind, wide in ((0, 8), (1, 6)):
            if not held[kind]:
                continue
            h, c = _counted(np.concatenate(held[kind]))
            order, rest, cuts = _parts(h, parts)
            rest, c = rest[order], c[order]
            if kind:
                rest = rest & np.uint64(0xFFFFFFFFFFFF)
            yield _emit([(p, kind, 0, 0, 0.0, 0.0, 0, _block(rest[cuts[p] : cuts[p + 1]], c[cuts[p] : cuts[p + 1]], wide)) for p in range(parts) if cuts[p + 1] > cuts[p]])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [[], []], 0
        for f in pieces(frames, "t"):
            tokens, _ = sequences(list(f["t"]))
            held[0].append(tokens)
            held[1].append(pair(contexts(tokens), tokens))
            n += len(tokens)
            if n > 2_000_000:
                yield from send(held)
                held, n = [[], []], 0
        yield from send(held)

    return run


def _level(c: np.ndarray) -> np.ndarray:
    return np.searchsorted(LEVELS, c, side="right")


def _places(h: np.ndarray, level: int, bits: np.ndarray | int) -> Iterator[np.ndarray]:
    """The bits of (hash, level) in a segment of so many bits."""
    x = bytehash.mix(h + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64)))
    step = bytehash.mix(x) | np.uint64(1)
    for i in range(PROBES):
        yield (x + step * np.uint64(i)) % np.asarray(bits, dtype=np.uint64)


def _fill(entry_bits: int):
    """Of each part: its words with exact counts (kind 0; a: words, n: tokens) and its segment of the filter (kind 1; n: bits, a:
    bits that are set), of entry_bits for each entry."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for f in frames:
            for part, kind, blob in zip(f["part"], f["kind"], f["blob"], strict=True):
                held.setdefault(part, [[], []])[kind].append(_unblock(blob, 6 if kind else 8))
        for part in sorted(held):
            own = [_summed(*(np.concatenate(x) for x in zip(*blocks, strict=True))) if blocks else (np.zeros(0, np.uint64), np.zeros(0, np.int64)) for blocks in held.pop(part)]
            (wh, wc), (ph, pc) = own
            segment = _segment([(_word_key(wh), wc), (ph, pc)], entry_bits)
            bits = len(segment)
            yield _emit([(part, 0, 0, 0, float(len(wh)), 0.0, int(wc.sum()), _block(wh, wc, 8)), (part, 1, 0, 0, float(segment.sum()), 0.0, bits, np.packbits(segment, bitorder="little").tobytes())])

    return run


def _segment(keys: list[tuple[np.ndarray, np.ndarray]], entry_bits: int) -> np.ndarray:
    """The bits of a segment that holds keys with their counts, of entry_bits for each entry. Words are known in it by their low 48 bits,
    as pairs are; a mark keeps the two apart."""
    keys = [(h, _level(c)) for h, c in keys]
    entries = sum(int(q.sum()) for _, q in keys)
    bits = max(64, -(-entries * entry_bits // 8) * 8)
    segment = np.zeros(bits, dtype=bool)
    for h, q in keys:
        for level in range(1, int(q.max(initial=0)) + 1):
            for at in _places(h[q >= level], level, bits):
                segment[at.astype(np.int64)] = True
    return segment


def _word_key(h: np.ndarray) -> np.ndarray:
    return bytehash.mix(h) & np.uint64(0xFFFFFFFFFFFF) | np.uint64(1 << 60)


def probe(held: np.ndarray, starts: np.ndarray | int, bits: np.ndarray | int, h: np.ndarray) -> np.ndarray:
    """The level of each of h in its segment, which begins at that byte of `held` and has so many bits (numbers, if one segment has them all);
    0 if not even the first one is in."""
    level = np.zeros(len(h), dtype=np.int64)
    alive = np.arange(len(h))
    q = 1
    while len(alive) and q <= len(LEVELS):
        found = np.ones(len(alive), dtype=bool)
        first = starts if np.isscalar(starts) else starts[alive]
        for at in _places(h[alive], q, bits if np.isscalar(bits) else bits[alive]):
            at = at.astype(np.int64)
            found &= (held[first + (at >> 3)] >> (at & 7).astype(np.uint8)) & 1 == 1
        alive = alive[found]
        level[alive] = q
        q += 1
    return level


def _word_entries(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(part, key in its segment) of words."""
    return (h % np.uint64(parts)).astype(np.int64), _word_key(h // np.uint64(parts))


def _pair_entries(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    return (h % np.uint64(parts)).astype(np.int64), (h // np.uint64(parts)) & np.uint64(0xFFFFFFFFFFFF)


@dataclass
class Model:
    """What is broadcast: the filter's segments unless they are too large, the head of the word counts, totals, and the weights of the
    mixture."""

    parts: int
    bits: np.ndarray
    starts: np.ndarray
    filter: np.ndarray | None
    head: np.ndarray
    head_counts: np.ndarray
    tokens: int
    words: int
    false_mass: float  # the words of the vocabulary that a false hit of the first level puts after a word, as expected
    weights: np.ndarray | None = None

    def _levels(self, part: np.ndarray, key: np.ndarray) -> np.ndarray:
        return probe(self.filter, self.starts[part], self.bits[part], key)

    def word_levels(self, h: np.ndarray) -> np.ndarray:
        return self._levels(*_word_entries(h, self.parts))

    def pair_levels(self, h: np.ndarray) -> np.ndarray:
        h, back = np.unique(h, return_inverse=True)
        return self._levels(*_pair_entries(h, self.parts))[back]

    def shares(self, tokens: np.ndarray, less: int = 0, before: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(group of the weight, share among the pairs, smoothed share among all words) of each token. less: taken off counts.
        before: the token before each one, if other than the one that stands there."""
        follows = before is None  # then all of them stand in `tokens` too, the end of a text among them
        before = contexts(tokens) if follows else before
        distinct, back = np.unique(tokens if follows else np.concatenate([tokens, before]), return_inverse=True)
        level = self.word_levels(distinct)[back]
        around = np.concatenate([self.word_levels(np.array([END])), level[:-1]]) if follows else level[len(tokens) :]
        return self.of_levels(level[: len(tokens)], self.pair_levels(pair(before, tokens)), around, less)

    def of_levels(self, level: np.ndarray, pairs: np.ndarray, around: np.ndarray, less: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As `shares`, from the levels of tokens, of their pairs, and of the tokens before them."""
        own = LEAST[level]
        both = np.minimum(np.minimum(LEAST[pairs], own), LEAST[around])
        most = np.minimum(MOST[around], self.tokens)
        own, both, most = (np.maximum(x - less, 0) for x in (own, both, most))
        unigram = (own + 0.1) / (self.tokens - less + 0.1 * (self.words + 1))
        group = np.minimum(np.log10(most + 1) * 2, GROUPS - 1).astype(np.int64)
        return group, np.where(most > 0, both / (np.maximum(most, 1) + self.false_mass), 0.0), unigram

    def log10(self, tokens: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        return self.mixed(*self.shares(tokens, before=before))

    def mixed(self, group: np.ndarray, among_pairs: np.ndarray, unigram: np.ndarray) -> np.ndarray:
        w = self.weights[group]
        return np.log10(w * among_pairs + (1 - w) * unigram)


# ---- levels from the segments where they are, for a filter that is not broadcast


def _ask(parts: int):
    """Of each piece of texts: its distinct words and pairs, as keys by part (kind 4), and its tokens as places among them (kind 5).
    (d, r) is a number of the piece's own."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in pieces(frames, "t"):
            if not len(f):
                continue
            tokens, starts = sequences(list(f["t"]))
            words, word_at = np.unique(tokens, return_inverse=True)
            pairs, pair_at = np.unique(pair(contexts(tokens), tokens), return_inverse=True)
            part, key = (np.concatenate(x) for x in zip(_word_entries(words, parts), _pair_entries(pairs, parts), strict=True))
            order = np.argsort(part, kind="stable")
            cuts, key = np.searchsorted(part[order], np.arange(parts + 1)), key[order]
            place = np.empty(len(order), dtype=np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            own = [int(x) for x in np.frombuffer(uuid.uuid4().bytes, np.int64)]
            sent = [(p, 4, *own, 0.0, 0.0, 0, key[cuts[p] : cuts[p + 1]].tobytes()) for p in range(parts) if cuts[p + 1] > cuts[p]]
            body = [np.array([len(f), len(tokens)]), f["d"].to_numpy(dtype=np.int64), f["r"].to_numpy(dtype=np.int64), starts.astype(np.int64), place[word_at], place[len(words) + pair_at]]
            yield _emit([*sent, (0, 5, *own, 0.0, 0.0, 0, b"".join(x.tobytes() for x in body))])

    return run


def _answer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Levels, a byte each, in place of the keys that were asked for; the segment of a part (kind 1) comes before its keys. The blocks of a
    frame are looked up together, as they are many and small."""
    here, bits, segment = -1, 64, np.zeros(8, dtype=np.uint8)
    for f in frames:
        for part, own in f.groupby("part", sort=False):
            for n, blob in own.loc[own["kind"] == 1, ["n", "blob"]].itertuples(index=False):
                here, bits, segment = part, int(n), np.frombuffer(blob, np.uint8)
            asked = own[own["kind"] == 4]
            keys = np.frombuffer(b"".join(asked["blob"]), np.uint64)
            level = (probe(segment, 0, bits, keys) if part == here else np.zeros(len(keys))).astype(np.uint8)
            cuts = np.cumsum([0, *[len(x) // 8 for x in asked["blob"]]])
            yield _emit([(part, 4, d, r, 0.0, 0.0, 0, level[x:y].tobytes()) for d, r, x, y in zip(asked["d"], asked["r"], cuts[:-1], cuts[1:], strict=True)])


def _returned(use: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], pd.DataFrame]):
    """use(d, r, starts, levels of tokens, of their pairs, of the tokens before) of each piece; its levels come in the order of parts, and
    then its tokens."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, got = None, []
        for f in frames:
            for kind, d, r, blob in zip(f["kind"], f["d"], f["r"], f["blob"], strict=True):
                if (d, r) != now:
                    now, got = (d, r), []
                if kind == 4:
                    got.append(blob)
                    continue
                n, m = (int(x) for x in np.frombuffer(blob, np.int64, 2))
                own, rows, starts = np.frombuffer(blob, np.int64, n, 16), np.frombuffer(blob, np.int64, n, 16 + 8 * n), np.frombuffer(blob, np.int64, n + 1, 16 + 16 * n)
                places = np.frombuffer(blob, np.int32, 2 * m, 24 + 24 * n)
                levels = np.frombuffer(b"".join(got), np.uint8).astype(np.int64)
                word = levels[places[:m]]
                # a piece ends with END, which stands before each text's first word too
                yield use(own, rows, starts, word, levels[places[m:]], np.concatenate([word[-1:], word[:-1]]))

    return run


def _through_segments(texts: DataFrame, built: DataFrame, parts: int, use: Callable, schema: str) -> DataFrame:
    """What `use` makes of the levels of all pieces of texts (d, r, t). Pieces are written once, as a task that ran again might cut
    others; nothing larger than a segment, or a piece, is held."""
    asked = checkpoint(texts.mapInPandas(_ask(parts), ROWS))
    met = built.where("kind = 1").unionByName(asked.where("kind = 4")).repartitionById(parts, "part").sortWithinPartitions("part", "kind")
    back = met.mapInPandas(_answer, ROWS).unionByName(asked.where("kind = 5")).repartition(parts, "d", "r").sortWithinPartitions("d", "r", "kind", "part")
    return back.mapInPandas(_returned(use), schema)


def _classes(group: np.ndarray, among_pairs: np.ndarray, unigram: np.ndarray, times: np.ndarray | None = None) -> pd.DataFrame:
    """How many tokens (n) there are of each group (g) and quotient of their two shares (odds). times: how many tokens each entry stands for."""
    odds = np.where(among_pairs > 0, np.round(np.log10(np.maximum(among_pairs, 1e-30) / unigram) * 4), -99).clip(-99, 99)
    seen = np.bincount(group * 199 + odds.astype(np.int64) + 99, times, GROUPS * 199).astype(np.int64)
    at = np.flatnonzero(seen)
    return pd.DataFrame({"g": at // 199, "odds": at % 199 - 99, "n": seen[at]})


def _weights(rows: DataFrame, model: Model, built: DataFrame) -> np.ndarray:
    """The weight of the pairs by how often the word before was seen, by expectation maximisation.

    On the texts that were counted, each token counting as if it had been left out. Only sums over classes of tokens with
    like shares reach the driver.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)
    schema = "g long, odds long, n long"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in pieces(frames, "t"):
            yield _classes(*shared.value.shares(sequences(list(f["t"]))[0], less=1))

    def of_piece(d, r, starts, word, pairs, around) -> pd.DataFrame:
        return _classes(*shared.value.of_levels(word, pairs, around, 1))

    if model.filter is None:
        found = _through_segments(rows.select("d", F.lit(0).cast("bigint").alias("r"), "t"), built, model.parts, of_piece, schema)
    else:
        found = rows.mapInPandas(run, schema)
    out = _settled(found)
    shared.unpersist()
    return out


def _settled(found: DataFrame) -> np.ndarray:
    """The weights from classes of tokens (g, odds, n)."""
    counts = found.groupBy("g", "odds").agg(F.sum("n").alias("n")).toPandas()
    w = np.full(GROUPS, 0.2)
    for g, own in counts.groupby("g"):
        ratio, n = np.where(own["odds"] <= -99, 0.0, 10.0 ** (own["odds"].to_numpy() / 4)), own["n"].to_numpy()
        x = 0.2
        for _ in range(50):
            x = float((n * (x * ratio / (x * ratio + 1 - x))).sum() / n.sum())
        w[int(g)] = min(max(x, 1e-4), 0.95)
    return w


def train(texts: DataFrame, *, head: int = 400_000, entry_bits: int = BITS, broadcast_bytes: int = 1 << 27) -> tuple[Model, DataFrame]:
    """(model, table of exact word counts and of the filter's segments, by part) of texts (d long, t binary), all of them.

    Bounds: `head` words with exact counts in the model, and `broadcast_bytes` of filter. The filter grows with the distinct words and
    pairs, by entry_bits for each and each level of its count; beyond the bound it stays in the table, and levels come from there by a
    shuffle. All texts fit the weights of the mixture. Null and empty texts have one token, their end; repeated rows count as often as
    they occur; texts of any length are counted whole. An empty table gives a model that has seen nothing.
    """
    model, built = count(texts, head=head, entry_bits=entry_bits, broadcast_bytes=broadcast_bytes)
    model.weights = _weights(texts, model, built)
    return model, built


def count(texts: DataFrame, *, head: int = 400_000, entry_bits: int = BITS, broadcast_bytes: int = 1 << 27) -> tuple[Model, DataFrame]:
    """As `train`, without the weights."""
    spark = texts.sparkSession
    parts = max(2, partitions(spark))
    built = checkpoint(texts.mapInPandas(_count(parts), ROWS).repartitionById(parts, "part").mapInPandas(_fill(entry_bits), ROWS))
    sizes = built.where("kind = 1").select("part", "n", "a", F.length("blob").alias("size")).collect()
    bits, held = np.full(parts, 64, dtype=np.int64), np.full(parts, 8, dtype=np.int64)
    for x in sizes:
        bits[x["part"]], held[x["part"]] = x["n"], x["size"]
    starts, filled = np.concatenate([[0], np.cumsum(held)[:-1]]), None
    if held.sum() <= broadcast_bytes:
        filled = np.zeros(int(held.sum()), dtype=np.uint8)
        for x in built.where("kind = 1").select("part", "blob").toLocalIterator():  # one segment at a time beside the filter
            filled[starts[x["part"]] : starts[x["part"]] + held[x["part"]]] = np.frombuffer(x["blob"], dtype=np.uint8)
    false = (sum(x["a"] for x in sizes) / max(1, int(bits.sum()))) ** PROBES
    totals = built.where("kind = 0").agg(F.sum("n").alias("n"), F.sum("a").alias("v")).first()

    share = max(1, head // parts)

    def frequent(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for part, blob in zip(f["part"], f["blob"], strict=True):
                h, c = _unblock(blob, 8)
                most = np.argsort(-c, kind="stable")[:share]
                yield pd.DataFrame({"blob": [np.stack([(h[most] * np.uint64(parts) + np.uint64(part)).view(np.int64), c[most]]).tobytes()]})

    top = built.where("kind = 0").select("part", "blob").mapInPandas(frequent, "blob binary").collect()
    top = np.concatenate([np.zeros((2, 0), dtype=np.int64), *[np.frombuffer(x["blob"], np.int64).reshape(2, -1) for x in top]], axis=1)
    h, c = top[0].view(np.uint64), top[1]
    order = np.argsort(h)
    model = Model(parts, bits, starts, filled, h[order], c[order], int(totals["n"] or 0), int(totals["v"] or 0), false * int(totals["v"] or 0))
    return model, built


# ---- scoring


def _score(shared, parts: int):
    """For each text a row of kind 2 (a: sum of log10(c + 0.1) of head words, n: tokens, part: known head words, blob: the levels of its tokens and of their pairs, a byte each, if the model has a filter)
    and for all other words blocks of kind 3 by part, with the number of the text's row among `blob`'s documents."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m: Model = shared.value
        for f in pieces(frames, "t"):
            tokens, starts = sequences(list(f["t"]))
            if not len(f):
                continue
            at = np.searchsorted(m.head, tokens).clip(0, max(0, len(m.head) - 1))
            known = m.head[at] == tokens if len(m.head) else np.zeros(len(tokens), dtype=bool)
            base = np.where(known, np.log10(m.head_counts[at] + 0.1), 0.0) if len(m.head) else np.zeros(len(tokens))
            cut = starts[:-1]
            d, r = f["d"].to_numpy(dtype=np.int64), f["r"].to_numpy(dtype=np.int64)
            blobs = [None] * len(f)
            if m.filter is not None:
                word, back = np.unique(tokens, return_inverse=True)
                both = np.stack([m.word_levels(word)[back], m.pair_levels(pair(contexts(tokens), tokens))]).astype(np.uint8)
                blobs = [both[:, a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
            yield _emit(list(zip(np.add.reduceat(known.astype(np.int64), cut).tolist(), [2] * len(f), d.tolist(), r.tolist(), np.add.reduceat(base, cut).tolist(), [0.0] * len(f), np.diff(starts).tolist(), blobs, strict=True)))
            rest = np.flatnonzero(~known)
            doc = (np.searchsorted(starts, rest, side="right") - 1).astype(np.int32)
            order, left, cuts = _parts(tokens[rest], parts)
            left, doc = left[order], doc[order]
            rows = []
            for p in range(parts):
                a, b = cuts[p], cuts[p + 1]
                if b > a:
                    used, local = np.unique(doc[a:b], return_inverse=True)
                    head = np.array([len(used), b - a], dtype=np.int64)
                    rows.append((p, 3, 0, 0, 0.0, 0.0, 0, b"".join([head.tobytes(), d[used].tobytes(), r[used].tobytes(), left[a:b].tobytes(), local.astype(np.int32).tobytes()])))
            yield _emit(rows)

    return run


def _levels_of(f: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, levels of tokens, of their pairs, of the tokens before) of rows of kind 2."""
    both = [np.frombuffer(x, np.uint8).reshape(2, -1) for x in f["blob"]]
    word, pairs = np.concatenate(both, axis=1).astype(np.int64)
    # a text ends with END, which stands before each text's first word too
    return np.concatenate([[0], np.cumsum([x.shape[1] for x in both])]), word, pairs, np.concatenate([word[-1:], word[:-1]])


def _mixed(shared):
    """Rows of kind 2 with the model's score as b, without their levels."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m: Model = shared.value
        for f in pieces(frames, "blob", 1_000_000):
            starts, *levels = _levels_of(f)
            yield f.assign(b=np.add.reduceat(m.mixed(*m.of_levels(*levels)), starts[:-1]), blob=None)

    return run


def _meet(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The exact counts of a part meet its words: for each text the sum of log10(c + 0.1) and how many are known."""
    counts: dict[int, tuple] = {}
    waiting: dict[int, list[bytes]] = {}
    for f in frames:
        done = f["kind"] == 2
        if done.any():
            yield pd.DataFrame({"d": f["d"][done], "r": f["r"][done], "base": f["a"][done], "score": f["b"][done], "n": f["n"][done], "known": f["part"][done].astype("int64")})
        for part, kind, blob in zip(f["part"], f["kind"], f["blob"], strict=True):
            if kind == 0:
                counts[part] = _unblock(blob, 8)
            elif kind == 3:
                waiting.setdefault(part, []).append(blob)
    for part in sorted(waiting):
        h, c = counts.get(part, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
        for blob in waiting[part]:
            n, m = (int(x) for x in np.frombuffer(blob, np.int64, 2))
            d, r = np.frombuffer(blob, np.int64, n, 16), np.frombuffer(blob, np.int64, n, 16 + 8 * n)
            own, doc = np.frombuffer(blob, np.uint64, m, 16 + 16 * n), np.frombuffer(blob, np.int32, m, 16 + 16 * n + 8 * m)
            at = np.searchsorted(h, own).clip(0, max(0, len(h) - 1))
            found = np.where(h[at] == own, c[at], 0) if len(h) else np.zeros(m, dtype=np.int64)
            yield pd.DataFrame({"d": d, "r": r, "base": np.bincount(doc, np.log10(found + 0.1), n), "score": 0.0, "n": 0, "known": np.bincount(doc, found > 0, n).astype(np.int64)})


def score(texts: DataFrame, model: Model, built: DataFrame) -> DataFrame:
    """(d, r, n_tokens, n_known, train_tokens, base_score, score) of each of texts (d long, r long, t binary), by what `train` gave.

    Words that the model has not seen have the smoothed probability of a count of 0. An empty text has one token, its end. Texts of any
    length are scored whole; equal texts have equal scores, and no row is left out. An empty table gives an empty result.
    """
    context = texts.sparkSession.sparkContext
    sent = texts.mapInPandas(_score(context.broadcast(model), model.parts), ROWS)
    sent = sent if model.filter is None else checkpoint(sent)
    shared = context.broadcast(replace(model, filter=None, head=model.head[:0], head_counts=model.head_counts[:0]))
    if model.filter is not None:
        sent = sent.where("kind = 2").mapInPandas(_mixed(shared), ROWS).unionByName(sent.where("kind = 3"))
    # rows of kind 2 carry a number in `part` that spreads them; blocks meet the counts of their part
    met = sent.unionByName(built.where("kind = 0")).repartition(model.parts, F.when(F.col("kind") == 2, F.pmod("d", F.lit(model.parts)).cast("int")).otherwise(F.col("part")))
    schema = "d long, r long, base double, score double, n long, known long"
    sums = met.mapInPandas(_meet, schema)
    if model.filter is None:

        def of_piece(d, r, starts, *levels) -> pd.DataFrame:
            m: Model = shared.value
            found = np.add.reduceat(m.mixed(*m.of_levels(*levels)), starts[:-1])
            return pd.DataFrame({"d": d, "r": r, "base": 0.0, "score": found, "n": 0, "known": 0})

        sums = sums.unionByName(_through_segments(texts, built, model.parts, of_piece, schema))
    sums = sums.groupBy("d", "r").agg(*[F.sum(k).alias(k) for k in ("base", "score", "n", "known")])
    return _scores(sums, model)


def _scores(sums: DataFrame, model: Model) -> DataFrame:
    below = float(np.log10(model.tokens + 0.1 * (model.words + 1)))
    return sums.select("d", "r", F.col("n").alias("n_tokens"), F.col("known").alias("n_known"), F.lit(model.tokens).cast("bigint").alias("train_tokens"), (F.col("base") - F.col("n") * below).alias("base_score"), "score")


# ---- learning and scoring in one pass

KNOWN = len(LEVELS) + 1  # levels, 0 among them
PART_BYTES = 1 << 25


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: all first bytes of an array's numbers, all second ones and so on, compressed."""
    data = b"".join(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes() for x in arrays)
    return np.array([len(data), *map(len, arrays)], dtype=np.int64).tobytes() + pa.compress(data, codec="zstd", asbytes=True)


def _unpacked(blob: bytes, *types: type) -> list[np.ndarray]:
    size, *lengths = (int(x) for x in np.frombuffer(blob, np.int64, len(types) + 1))
    data, at, out = pa.decompress(memoryview(blob)[8 * (len(types) + 1) :], size, codec="zstd", asbytes=True), 0, []
    for n, kind in zip(lengths, types, strict=True):
        wide = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(data, np.uint8, n * wide, at).reshape(wide, n).T).view(kind).ravel())
        at += n * wide
    return out


def _asked(task: int, batch: int, held: list[tuple], parts: int) -> Iterator[pd.DataFrame]:
    """The rows of a task's batch of (tokens, tokens of each text, d, r, own)."""
    tokens, sizes, d, r, own = (np.concatenate(x) for x in zip(*held, strict=True))
    times = np.repeat(own, sizes).astype(np.float64)
    at, words = pd.factorize(tokens)
    pairs, pair_at = np.unique(_follows(at, len(words)), return_inverse=True)
    hashes = pair(words[pairs // len(words)], words[pairs % len(words)])
    columns, part_of, cuts = [], [], []
    for h, keys, back in ((words, words // np.uint64(parts), at), (hashes, _pair_entries(hashes, parts)[1], pair_at)):
        part = (h % np.uint64(parts)).astype(np.uint16)
        order = _by_part(part)
        columns += [keys[order], np.bincount(back, times, len(h)).astype(np.uint32)[order]]
        part_of.append(part)
        cuts.append(np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))]))
    body = _packed(d, r, own, sizes, at.astype(np.uint32), *part_of)
    to = (int(task * 0.6180339887 % 1 * parts) + batch) % parts  # the golden section spreads tasks evenly, whatever their number
    of = int.from_bytes(hashlib.blake2b(body, digest_size=8, salt=np.array([task, batch], dtype=np.int64).tobytes()).digest(), "little", signed=True)
    there, (a, x) = np.flatnonzero(np.diff(cuts[0]) + np.diff(cuts[1])).tolist(), cuts
    yield _emit([(p, 4, to, of, 0.0, 0.0, 0, _packed(*[c[a[p] : a[p + 1]] for c in columns[:2]], *[c[x[p] : x[p + 1]] for c in columns[2:]])) for p in there])
    yield _emit([(to, 5, to, of, 0.0, 0.0, len(there), body)])


def _sent(parts: int, batch_tokens: int):
    """Of each batch of texts (d, r, t, own: learned from): its distinct words and pairs with their counts among texts of `own`, by part
    (kind 4), and its tokens as numbers of its words (kind 5; n: rows of kind 4). d is the partition where they meet again, r tells the
    batch and what it holds."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, batch, held, n = TaskContext.get().partitionId(), 0, [], 0
        for f in pieces(frames, "t"):
            if not len(f):
                continue
            tokens, starts = sequences(list(f["t"]))
            if held and n + len(tokens) > batch_tokens:
                yield from _asked(task, batch, held, parts)
                batch, held, n = batch + 1, [], 0
            held.append((tokens, np.diff(starts), f["d"].to_numpy(dtype=np.int64), f["r"].to_numpy(dtype=np.int64), f["own"].to_numpy(dtype=np.uint8)))
            n += len(tokens)
        if held:
            yield from _asked(task, batch, held, parts)
        give_back()

    return run


def _by_part(part: np.ndarray) -> np.ndarray:
    """The order in which keys are sent, and what was found for them comes back."""
    return np.argsort(part, kind="stable")


def _placed(part: np.ndarray, found: np.ndarray) -> np.ndarray:
    """What was found, in the order that the keys had before they were sent."""
    out = np.empty_like(found)
    out[_by_part(part)] = found
    return out


def _follows(at: np.ndarray, words: int) -> np.ndarray:
    """The pair of each token and the one before, as a number; a batch ends with END, which stands before each text's first word too."""
    at = at.astype(np.int64)
    return np.concatenate([at[-1:], at[:-1]]) * words + at


def _found(part: int, blocks: list[tuple], entry_bits: int) -> Iterator[pd.DataFrame]:
    """Totals of a part, and what is found for the words and pairs of each of its blocks (d, r, blob)."""
    sent = [_unpacked(x, np.uint64, np.uint32, np.uint64, np.uint32) for *_, x in blocks]
    keys, backs, cuts = [], [], []
    for k in (0, 2):
        h, back = np.unique(np.concatenate([x[k] for x in sent]), return_inverse=True)
        keys.append((h if k else _word_key(h), np.bincount(back, np.concatenate([x[k + 1] for x in sent]), len(h)).astype(np.int64)))
        backs.append(back)
        cuts.append(np.cumsum([0, *[len(x[k]) for x in sent]]))
    counts, segment = keys[0][1], _segment(keys, entry_bits)
    yield _emit([(part, 0, 0, 0, float((counts > 0).sum()), 0.0, int(counts.sum()), None), (part, 1, 0, 0, float(segment.sum()), 0.0, len(segment), None)])
    held, bits = np.packbits(segment, bitorder="little"), len(segment)
    word, pairs = (probe(held, 0, bits, h).astype(np.uint8)[back] for (h, _), back in zip(keys, backs, strict=True))
    counts, (a, x) = counts[backs[0]], cuts
    yield _emit([(part, 4, d, r, 0.0, 0.0, 0, _packed(word[a[i] : a[i + 1]], counts[a[i] : a[i + 1]], pairs[x[i] : x[i + 1]])) for i, (d, r, _) in enumerate(blocks)])


def _looked_up(entry_bits: int):
    """Of each part: its totals (kind 0; a: words, n: tokens) and those of its segment (kind 1; a: bits that are set, n: bits), and for each
    batch the levels and counts of the words, and the levels of the pairs, that it sent (kind 4), read from the segment. Rows of tokens
    go through."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for f in frames:
            yield f[f["kind"] == 5]
            for part, kind, d, r, blob in zip(f["part"], f["kind"], f["d"], f["r"], f["blob"], strict=True):
                if kind == 4:
                    held.setdefault(part, []).append((d, r, blob))
        for part in sorted(held):
            yield from _found(part, held.pop(part), entry_bits)
        give_back()

    return run


def _levels_met(body: bytes, got: list[bytes]) -> pd.DataFrame:
    """The rows of kinds 5 and 6 of a batch, from its tokens and what was found for it."""
    d, r, own, sizes, at, part, pair_part = _unpacked(body, np.int64, np.int64, np.uint8, np.int64, np.uint32, np.uint16, np.uint16)
    word, count, pairs = (np.concatenate(x) for x in zip(*[_unpacked(x, np.uint8, np.int64, np.uint8) for x in got], strict=True))
    word, count, pairs = _placed(part, word), _placed(part, count), _placed(pair_part, pairs)
    starts = np.cumsum(sizes) - sizes
    base, known = np.add.reduceat(np.log10(count + 0.1)[at], starts), np.add.reduceat((count > 0).astype(np.int64)[at], starts)
    word, pairs = word[at], pairs[np.unique(_follows(at, len(word)), return_inverse=True)[1]]
    seen = np.bincount(_together(word, pairs)[np.repeat(own, sizes) > 0])
    found = np.flatnonzero(seen)
    return _emit([(0, 5, 0, 0, 0.0, 0.0, 0, _packed(d, r, sizes, known, base, word, pairs)), (0, 6, 0, 0, 0.0, 0.0, 0, _packed(found, seen[found]))])


def _met(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each batch its texts (kind 5: d, r, tokens, known tokens, sum of log10(c + 0.1), and the levels of tokens and of pairs), and how
    often levels of a token, of its pair and of the token before meet in texts of `own` (kind 6). Totals go through."""
    now, got = None, []
    for f in frames:
        yield f[f["kind"] < 4]
        f = f[f["kind"] >= 4]
        for kind, d, r, n, blob in zip(f["kind"], f["d"], f["r"], f["n"], f["blob"], strict=True):
            if (d, r) != now:
                now, got = (d, r), []
            if kind == 4:
                got.append(blob)
                continue
            if len(got) != n:
                raise RuntimeError("texts came in another order when a lost task read them again; write them before they are scored")
            yield _levels_met(blob, got)
    give_back()


def _together(word: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The levels of each token, of its pair and of the token before as one number."""
    word = word.astype(np.int64)
    return (word * KNOWN + pairs) * KNOWN + np.concatenate([word[-1:], word[:-1]])


def _apart(number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return number // (KNOWN * KNOWN), number // KNOWN % KNOWN, number % KNOWN


def train_and_score(texts: DataFrame, own: Column, *, entry_bits: int = BITS, batch_tokens: int = 2_000_000) -> DataFrame:
    """What `score` gives for texts (d, r, t) by a model that `train` makes of those of `own`, a condition on d and r; without a broadcast that
    grows with the input. Texts are cut into words once, and words and pairs looked up once for the weights and the scores.

    Bounds: a task holds a batch of `batch_tokens` tokens, or one longer text, or what batches sent to a part, of which there are so many
    that each has PART_BYTES of text at most on the average, whatever the number of shuffle partitions. Rows must come in the same order
    if a lost task reads them again, as those of files and of `keyed` do; else the job fails.
    """
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.length("t"))).first()[0] or 0
    parts = min(max(2, partitions(spark), -(-size // PART_BYTES)), 1 << 16)
    sent = texts.select("d", "r", "t", F.coalesce(own, F.lit(False)).alias("own")).mapInPandas(_sent(parts, batch_tokens), ROWS)
    back = sent.repartitionById(parts, "part").mapInPandas(_looked_up(entry_bits), ROWS)
    met = checkpoint(back.repartitionById(parts, F.col("d").cast("int")).sortWithinPartitions("d", "r", "kind", "part").mapInPandas(_met, ROWS))
    sums = {x["kind"]: x for x in met.where("kind < 4").groupBy("kind").agg(F.count("*").alias("parts"), F.sum("a").alias("a"), F.sum("n").alias("n")).collect()}
    tokens, words, filled, bits, there = (int(sums[k][x]) if k in sums else 0 for k, x in ((0, "n"), (0, "a"), (1, "a"), (1, "n"), (1, "parts")))
    none = np.zeros(0, dtype=np.int64)
    false = (filled / (bits + 64 * (parts - there))) ** PROBES  # a part without a word or pair has an empty segment
    model = Model(parts, none, none, None, none.view(np.uint64), none, tokens, words, false * words)

    def classes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for blob in f["blob"]:
                found, n = _unpacked(blob, np.int64, np.int64)
                yield _classes(*model.of_levels(*_apart(found), 1), n)

    model.weights = _settled(met.where("kind = 6").select("blob").mapInPandas(classes, "g long, odds long, n long"))
    # the logarithms of all levels that can meet: less than a million, however large the input
    logs = spark.sparkContext.broadcast(model.mixed(*model.of_levels(*_apart(np.arange(KNOWN**3)))))

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for blob in f["blob"]:
                d, r, sizes, known, base, word, pairs = _unpacked(blob, np.int64, np.int64, np.int64, np.int64, np.float64, np.uint8, np.uint8)
                found = np.add.reduceat(logs.value[_together(word, pairs)], np.cumsum(sizes) - sizes)
                yield pd.DataFrame({"d": d, "r": r, "base": base, "score": found, "n": sizes, "known": known})

    return _scores(met.where("kind = 5").select("blob").mapInPandas(scored, "d long, r long, base double, score double, n long, known long"), model)


def fold(key: Column) -> Column:
    return held_out(key, 10, 0)


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = keyed(table(spark, sf_dir, "documents"), "doc_id", "text").select("d", "r", binary().alias("t"))
    own = key_of()
    out = train_and_score(texts, own.isNotNull() & ~fold(own))
    return out.select(own.alias("doc_id"), fold(own).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op8_lm": op8_lm}
ORACLE: dict[str, str] = {}
