"""Spelling variants, token files, fill-in-the-middle: brute force, round trips, edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cinderline.llm import logistic, op4_quality, op8_lm, op10_toxicity, op11_spelling, op12_token_files, op13_fim

DOCS = "doc_id long, text string, word string, n long, output string, d int"
LOWEST = -(1 << 63)


def frame(spark, rows):
    """Documents with columns whose names clash with those that the operators make."""
    return spark.createDataFrame([(i, t, "w", 7, "o", 9) for i, t in rows], DOCS).repartition(3)


# ---- spelling variants


def brute_variants(rows, every=31, least=7, times=10):
    lower, seen = str.maketrans(op11_spelling.UPPER, op11_spelling.UPPER.lower()), Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(lower)
            h = zlib.crc32(f"{i}:{w}".encode())
            if i is not None and h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            seen[w] += 1
    n = {w: k for w, k in seen.items() if len(w) >= least and k >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    links = {a: [b for b in n if near(a, b)] for a in n}
    best = {a: min(bs, key=lambda b: (-n[b], b)) for a, bs in links.items() if bs}
    form = {a: b for a, b in best.items() if n[b] >= times * n[a]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n[w], len(links[w]), n.get(form.get(w))) for w in n}


def variants(spark, rows, **how):
    words = op11_spelling.spelled(frame(spark, rows), "text", "doc_id", every=3).where("n >= 2")
    from cinderline.llm.common import checkpoint

    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in op11_spelling.variants(checkpoint(words), **how).collect()}


def spelling_corpus():
    turn = random.Random(4)
    base = ["".join(turn.choice("abcdé×ß") for _ in range(turn.randrange(6, 10))) for _ in range(25)] + ["aaaaaaaa", "aaaaaaab", "Étudiants", "Zzzzzzz"]
    rows = []
    for i in range(260):
        picked = [base[min(int(turn.expovariate(0.3)), len(base) - 1)] for _ in range(turn.randrange(1, 9))]
        for k in range(len(picked)):
            if turn.random() < 0.3:
                at, w = turn.randrange(len(picked[k])), picked[k]
                picked[k] = turn.choice([w[:at] + w[at + 1 :], w[:at] + "x" + w[at:], w[:at] + "Q" + w[at + 1 :]])
        rows.append((i, turn.choice([" ", "-", "1", "中"]).join(picked)))
    return [*rows, (None, "aaaaaaaa aaaaaaaa"), (7, rows[7][1]), (7, rows[7][1]), (LOWEST, "aaaaaaaa"), (300, None), (301, ""), (302, "y" * 90_000 + " " + "y" * 90_001), (303, "y" * 90_000 + " " + "y" * 90_001)]


def test_spelling_against_brute_force(spark):
    rows = spelling_corpus()
    want = brute_variants(rows, every=3)
    assert len(want) > 40 and sum(v[0] is not None for v in want.values()) > 5
    assert variants(spark, rows) == want
    assert variants(spark, rows, per_chunk=5) == want  # many chunks to a coarse class
    assert variants(spark, [(1, None)]) == variants(spark, []) == {}


def test_roots_follow_forms(spark):
    rows = [(i, f"{w} " * n) for i, (w, n) in enumerate([("abcdefg", 2), ("abcdefgh", 20), ("abcdefghi", 200), ("abcdefghij", 2000), ("bbcdefg", 2)])]
    from cinderline.llm.common import checkpoint

    words = checkpoint(op11_spelling.spelled(frame(spark, rows), "text", "doc_id", every=None))
    got = {r.word: (r.form, r.root) for r in op11_spelling.variants(words).collect()}
    assert got["abcdefg"] == ("abcdefgh", "abcdefghij") and got["abcdefghij"] == (None, "abcdefghij") and got["bbcdefg"] == (None, "bbcdefg")


def test_trie_gives_each_pair_once():
    turn = random.Random(9)
    by_length = defaultdict(set)
    for _ in range(900):
        w = "".join(turn.choice("abzéú") for _ in range(turn.choice((7, 8))))
        by_length[len(w)].add(w)
    short, long = (op11_spelling.Trie(sorted(by_length[k]), np.ones(len(by_length[k]), dtype=np.int64)) for k in (7, 8))
    for a, b in ((short, short), (short, long), (long, long)):
        pairs = [p for i, j in op11_spelling.candidates(a, b, block=50) for p in zip(i.tolist(), j.tolist())]
        counts = [[Counter(op11_spelling.group_of(26)[ord(c)] for c in w) for w in t.words] for t in (a, b)]
        want = {(i, j) for i, x in enumerate(counts[0]) for j, y in enumerate(counts[1]) if (a is not b or i < j) and (y - x).total() <= 1 and (x - y).total() <= 1}
        assert len(pairs) == len(set(pairs)) and set(pairs) == want


# ---- token files


@pytest.mark.parametrize("n,gap", [(1, 0), (7, 3), (256, 5), (257, 0), (1000, 1), (900, 2**50)])
def test_elias_fano(n, gap):
    turn = random.Random(n)
    values = np.cumsum([turn.randint(0, gap) for _ in range(n)]).astype(np.uint64)
    own = op12_token_files.EliasFano.of(values, int(values[-1]))
    assert [own.select(i) for i in range(n)] == values.tolist()
    sizes = op12_token_files.EliasFano.sizes(n, int(values[-1]))
    assert len(own.tobytes()) == sum(sizes)
    assert 8 * (sizes[0] + sizes[1]) <= n * (3 + max(1, int(values[-1]) // n).bit_length()) + 16  # near-minimal
    with pytest.raises(IndexError):
        own.select(n)


def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_byte_words_against_the_library():
    path, turn = public_tokenizers.path("byte_bpe_50k.json"), random.Random(8)
    own, whole = op12_token_files.ByteWords(path), library()
    letters = "ab 'st\n\t  \x1c\x85\xa0éİÖ̧ñ12½²字ー\U0001f642　​\r.,!?_'re'll"
    for k in range(4000):
        t = "".join(turn.choice(letters) for _ in range(turn.randrange(40)))
        t = t + "<|endoftext|>" + t if k % 7 == 0 else "".join(c for c in t if c < "֐") if k % 3 == 0 else t
        assert np.frombuffer(own.encode(t), dtype=own.dtype).tolist() == whole.encode(t, add_special_tokens=False).ids, t


def written(rows, whole):
    """(key, start, n_tokens, crc32) as the files should tell; null keys first, ties by text."""
    out, at = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = whole.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    return out


def test_token_files(spark, tmp_path):
    turn, whole = random.Random(2), library()
    texts = ["", None, "one two", "ünï字", "x <|endoftext|> y", "word " * 250_000, *["".join(turn.choice("abc de\n") for _ in range(turn.randrange(90))) for _ in range(700)]]
    plain = [(k * 3, t) for k, t in enumerate(texts)]
    odd = [*plain, (LOWEST, "low"), (2**63 - 1, "high"), (None, "nothing"), (None, None), (6, "again"), (6, "again")]
    for name, rows in (("plain", plain), ("odd", odd), ("none", [])):
        op12_token_files.write(frame(spark, rows), "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"), f"{tmp_path}/{name}", segment_ids=900)
        got = sorted(((r.key, r.start, r.n_tokens, r.ids_crc32) for r in op12_token_files.documents(spark, f"{tmp_path}/{name}").collect()), key=lambda r: r[1])
        assert got == written(rows, whole)
    # a segment by itself: any document by place, without the others
    held = [op12_token_files.Segment(bytes(r.content)) for r in op12_token_files.files(spark, f"{tmp_path}/odd").collect()]
    assert len(held) > 10 and sum(map(len, held)) == len(odd)
    text = dict(plain)
    for own in held:
        for i in range(0, len(own), 7):
            if own.key(i) in text and own.key(i) != 6:
                assert own[i].tolist() == whole.encode(text[own.key(i)] or "", add_special_tokens=False).ids + [0]
    with pytest.raises(ValueError):
        op12_token_files.Segment(b"something else".ljust(300))


# ---- fill-in-the-middle


def test_boundary_sets():
    turn = random.Random(6)
    texts = ["", "a", "é", "a" * 70_000, "é" * 70_000, "\U0001f642" * 40_000, "".join(turn.choice("aé字\U0001f642") for _ in range(90_000)), "a" * 65_536 + "字" * 65_536]
    kinds = set()
    for t in texts:
        own = op13_fim.Boundaries(t.encode())
        kinds |= {k for k, _ in own.containers}
        assert len(own) == len(t) + 1
        for k in {0, len(t), len(t) // 2, *(turn.randrange(len(t) + 1) for _ in range(60))}:
            assert own.select(k) == len(t[:k].encode())
    assert kinds == {"array", "bitmap", "run"}
    with pytest.raises(IndexError):
        op13_fim.Boundaries(b"").select(1)


def brute_fim(i, t):
    t, n = t or "", len(t or "")
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, t
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"
    return n, "psm", a, b - a, f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}"


def test_fim(spark):
    turn = random.Random(3)
    texts = [None, "", "a", "<P> is here", "x<M>", "<S", "S>P><", "<" * 50, "é字\U0001f642" * 400_000, *["".join(turn.choice("ab<>PSMé字\n") for _ in range(turn.randrange(60))) for _ in range(200)]]
    rows = [*enumerate(texts), (None, "no key"), (LOWEST, "lowest key"), (5, "again"), (5, "again")]
    made = op13_fim.transform(frame(spark, rows), "text", "doc_id")
    assert {"doc_id", "text", "word", "d"} < set(made.columns) and made.columns.count("output") == 1
    got = made.select("doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", op13_fim.restore(F.col("output"), F.col("form")).alias("back")).collect()
    assert len(got) == len(rows) and {r.form for r in got} == {"plain", "psm", "spm"}
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute_fim(r.doc_id, r.text) and r.back == (r.text or "")
    assert op13_fim.transform(frame(spark, []), "text", "doc_id").count() == 0


# ---- quality


def test_op4_learns_from_every_label(spark, tmp_path):
    """More labels than fitted a sample: the threshold parts all of them at their share, to the text."""
    turn = random.Random(8)
    rows = [(i, " ".join("".join(turn.choice("abcde") for _ in range(turn.randrange(2, 9))) + turn.choice(["$"] * (2 if i % 7 else 1) + [""] * 3) for _ in range(6))) for i in range(30_000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 7 > 2), 0) for i in range(30_000)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = [r for r in op4_quality.op4_quality(spark, str(tmp_path)).collect() if not r.held_out]
    below, bad = [r.score for r in got if r.predicted == 0], sum(r.doc_id % 7 <= 2 for r in got)
    # texts with equal features are on one side
    assert len(below) >= bad > sum(x < max(below) for x in below)
    x, y = np.random.default_rng(3).normal(size=(500, 3)), np.arange(500) % 2
    blocks = spark.createDataFrame(pd.concat([logistic.packed(np.c_[x, y][k::3]) for k in range(3)]))
    weights, bias = logistic.fit(blocks, 3, ridge=2.0)
    plain, plain_bias = op10_toxicity.fit_logistic(x, y.astype(float), ridge=2.0)
    assert np.allclose(weights, plain, atol=1e-6) and abs(bias - plain_bias) < 1e-6


def test_op8_probes_once_for_weights_and_scores(spark, monkeypatch):
    rows = [(i, 0, b"" if i == 4 else f"one two {'three ' * (i % 5)}word{i % 7} one two".encode()) for i in range(60)]
    texts = spark.createDataFrame(rows, "d long, r long, t binary").repartition(3)
    model, built = op8_lm.train(texts.where("d % 3 <> 0").select("d", "t"))
    want = {r.d: tuple(r) for r in op8_lm.score(texts, model, built).collect()}
    monkeypatch.setattr(op8_lm, "_weights", None)  # a pass that probes again
    got = {r.d: tuple(r) for r in op8_lm.train_and_score(texts, F.col("d") % 3 != 0).collect()}
    assert got.keys() == want.keys() and all(got[d] == pytest.approx(want[d]) for d in want)


def lm_rows(spark, n):
    rows = [(i, 0, b"" if i == 4 else f"one two {'three ' * (i % 5)}word{i % 700} {i} one two".encode()) for i in range(n)]
    return spark.createDataFrame(rows, "d long, r long, t binary").repartition(3)


def test_op8_broadcasts_nothing_that_grows(spark, monkeypatch):
    from pyspark import SparkContext, cloudpickle

    sent, plain = [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: (sent.append(len(cloudpickle.dumps(value))), plain(self, value))[1])
    sizes = []
    for n in (100, 3000):
        sent.clear()
        assert op8_lm.train_and_score(lm_rows(spark, n), F.col("d") % 3 != 0).count() == n
        sizes.append(sum(sent))
    assert sizes[1] < sizes[0] + 1000


def test_op8_batches_and_parts(spark, monkeypatch):
    """Many batches and more parts than shuffle partitions: the scores of a model that is broadcast, and all of its counts."""
    texts, own = lm_rows(spark, 900), F.col("d") % 3 != 0
    monkeypatch.setattr(op8_lm, "partitions", lambda _: 13)
    model, built = op8_lm.train(texts.where(own).select("d", "t"))
    want = {r.d: tuple(r) for r in op8_lm.score(texts, model, built).collect()}
    monkeypatch.setattr(op8_lm, "partitions", lambda _: 2)
    monkeypatch.setattr(op8_lm, "PART_BYTES", -(-texts.agg(F.sum(F.length("t"))).first()[0] // 13))
    got = {r.d: tuple(r) for r in op8_lm.train_and_score(texts, own, batch_tokens=1).collect()}
    assert got.keys() == want.keys() and all(got[d] == pytest.approx(want[d]) for d in want)
    assert all(r.n_known == 0 for r in op8_lm.train_and_score(texts, F.lit(None).cast("boolean")).collect())
    assert op8_lm.train_and_score(texts.limit(0), own).count() == 0


def test_op8_texts_that_change_between_reads():
    """Answers to another batch than the one whose tokens came are not taken for its own."""
    rows = [(0, 4, 1, 7, 0.0, 0.0, 0, b""), (0, 5, 1, 8, 0.0, 0.0, 1, b"")]
    with pytest.raises(RuntimeError):
        list(op8_lm._met(iter([op8_lm._emit(rows)])))
