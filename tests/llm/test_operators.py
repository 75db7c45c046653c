"""The text operators on small inputs: edge cases, brute force, round trips."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderline.llm import bytehash, op1_suffix_dedup, op2_sharding, op3_language, op4_quality, op5_decontamination, op6_bpe, op7_jaccard, op8_lm, op9_ann, op10_toxicity, suffix_runs
from cinderline.llm.common import binary, keyed, labelled_sample

DOCS = "doc_id long, text string, lang string, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", 9) for i, t in rows], DOCS)


def lm_texts(df):
    return keyed(df, "doc_id", "text").select("d", "r", binary().alias("t"))


def words(turn, n):
    return " ".join("".join(turn.choice("abcdefgh") for _ in range(turn.randrange(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, shared passages, a long text, an empty one, a null one, ties."""
    turn = random.Random(11)
    base = [words(turn, 120) for _ in range(12)]
    rows = list(base) + [base[0], base[0], base[1] + " tail", None, "", "one two", "One TWO", "one  two\n"]
    passage = words(turn, 60)
    rows += [words(turn, 40) + " " + passage + " " + words(turn, 40) for _ in range(6)]
    for k in range(10):
        near = base[2].split()
        near[k * 7] = f"x{k}"
        rows.append(" ".join(near))
    rows += ["é" * 400, "a" * 5000, words(turn, 9000)]
    return list(enumerate(rows))


def test_merge_of_runs():
    turn = random.Random(1)
    runs = [sorted({bytes(turn.choice(b"ab") for _ in range(turn.randrange(1, 9))) for _ in range(turn.randrange(1, 40))}) for _ in range(7)]
    blocks = []
    for r in runs:
        shared = [0] + [suffix_runs.common(a, b) for a, b in zip(r[:-1], r[1:])]
        blocks.append(suffix_runs.encode(r, shared, np.arange(len(r), dtype=np.int64)[:, None]))
    got = list(suffix_runs.merge(blocks))
    assert [k for _, k, _ in got] == sorted(x for r in runs for x in r)
    assert all(h == suffix_runs.common(a[1], b[1]) for a, b, h in zip(got[:-1], got[1:], [x[0] for x in got[1:]]))
    assert list(suffix_runs.merge([])) == []


def test_op1_against_brute_force(spark, corpus):
    docs = [(i, (t or "").encode()) for i, t in corpus]
    want = op1_suffix_dedup.brute_force(docs, 100)
    got = {r.doc_id: r for r in op1_suffix_dedup.dedup(frame(spark, corpus), "text", "doc_id").collect()}
    for (i, t), spans in zip(docs, want):
        assert [(s.start, s.end) for s in got[i].spans] == spans
        assert got[i].n_removed == sum(e - s for s, e in spans) and len(got[i].kept) == len(t) - got[i].n_removed
    assert op1_suffix_dedup.dedup(frame(spark, []), "text", "doc_id").count() == 0
    same = frame(spark, [(None, corpus[0][1]), (3, corpus[0][1]), (3, corpus[0][1])])
    assert sorted(r.n_removed > 0 for r in op1_suffix_dedup.dedup(same, "text", "doc_id").collect()) == [False, True, True]


def test_op2(spark):
    rows = [(i, f"t{i % 3}") for i in range(500)] + [(7, "t1"), (None, None)]
    out = op2_sharding.shard(frame(spark, rows), "doc_id", 24)
    assert "shard" in out.columns and out.columns.count("shard") == 1
    got = out.collect()
    assert len(got) == 502 and all(r.grown_shard in (r.shard, 24) for r in got)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    one = op2_sharding.shard(frame(spark, rows), "doc_id", 25).collect()
    assert {(r.doc_id, r.shard) for r in one} == {(r.doc_id, r.grown_shard) for r in got}

    def jump(key, n):
        b = j = 0
        while j < n:
            b = j
            h = int(hashlib.md5(f"{key}:{b}".encode()).hexdigest()[:13], 16)
            j = int((b + 1) / ((h + 1) / (1 << 52)))
        return b

    assert all(r.shard == jump(r.doc_id, 24) for r in got if r.doc_id is not None)
    assert op2_sharding.shard(frame(spark, []), "doc_id", 24).count() == 0


def test_op3(spark):
    turn = random.Random(2)
    tongue = {"aa": "bacade", "bb": "wixuyoz"}
    lexicon = {k: ["".join(turn.choice(v) for _ in range(turn.randrange(3, 8))) for _ in range(60)] for k, v in tongue.items()}
    make = lambda k, n: " ".join(turn.choice(lexicon[k]) for _ in range(n))
    rows = [(i, make(k, 60), k, 0) for i, k in enumerate(["aa", "bb"] * 40)]
    df = spark.createDataFrame(rows, DOCS)
    dicts = op3_language.train(df, "text", "lang", "doc_id")
    assert sorted(dicts) == ["aa", "bb"]
    new = spark.createDataFrame([(1, make("aa", 30), "bb", 0), (2, make("bb", 3000), None, 0), (3, None, None, 0), (4, "", None, 0), (5, "12 !?", None, 0)], DOCS)
    got = {r.doc_id: r for r in op3_language.classify(new, "text", dicts).collect()}
    assert (got[1].lang_pred, got[2].lang_pred) == ("aa", "bb") and [got[i].lang_pred for i in (3, 4, 5)] == ["und"] * 3
    assert all(0 <= r.score <= 1 for r in got.values()) and got[3].rejected
    assert op3_language.train(df.limit(0), "text", "lang", "doc_id") == {}


def test_op4_and_op10(spark):
    turn = random.Random(4)
    bad = lambda: " | ".join(words(turn, 1) + "$$$" for _ in range(40))
    rude = lambda: words(turn, 20) + " grumblefrats " + words(turn, 20)
    docs = [(i, bad() if i % 4 == 0 else rude() if i % 4 == 1 else words(turn, 50)) for i in range(200)]
    df = frame(spark, docs + [(900, None), (901, "")])
    labels = spark.createDataFrame([(i, int(i % 4 != 0), int(i % 4 == 1)) for i in range(120)] + [(121, None, None)], "doc_id long, quality int, toxic int")
    rows, totals = labelled_sample(df, labels, "doc_id", "quality", 50)
    model = op4_quality.train(rows, "text", "quality", "doc_id", totals)
    got = {r.doc_id: r for r in op4_quality.score(df, "text", model).collect()}
    assert sum(got[i].predicted == int(i % 4 != 0) for i in range(120, 200)) >= 76 and 0 <= got[900].score == got[901].score <= 1
    rows, totals = labelled_sample(df, labels, "doc_id", "toxic", 100)
    model = op10_toxicity.train(rows, "text", "toxic", totals)
    got = {r.doc_id: r for r in op10_toxicity.score(df, "text", model).collect()}
    assert sum(got[i].predicted == int(i % 4 == 1) for i in range(120, 200)) >= 76 and got[900].predicted == got[901].predicted == 0


def test_op10_rare_terms_and_phrases(spark):
    """Many toxic words, each much rarer than the best one; short ones; phrases of ordinary words. The words of a copied text tell nothing."""
    turn = random.Random(12)
    rare = [f"{words(turn, 1)}zq{words(turn, 1)}" for _ in range(40)]
    copied = words(turn, 40)
    rows = []
    for i in range(6400):
        mark = [] if i % 8 else [["grumblefrats"], [rare[i // 16 % 40]], [["green", "paint"], ["xq"]][i // 32 % 2], [rare[i // 16 % 40]]][i // 8 % 4]
        rest = [] if mark else [turn.choice(["green", "paint"])]
        rows.append((" ".join(words(turn, 6).split() + mark + rest + words(turn, 6).split()), int(i % 8 == 0)))
    rows += [(copied + f" w{k}", 1) for k in range(60)]
    df = spark.createDataFrame(rows, "text string, toxic int")
    model = op10_toxicity.train(df, "text", "toxic", {0: 5600, 1: 860})
    front = model.toxic.split(b"  ")[-1]
    assert all(t.encode() in front for t in ["grumblefrats", "green paint", "xq", *rare])
    assert sum(w.encode() in front.split(b" ") for w in copied.split() if len(w) > 6) == 0
    empty = spark.createDataFrame([], "text string, toxic int")
    assert op10_toxicity.score(df.limit(3), "text", op10_toxicity.train(empty, "text", "toxic", {})).agg(F.sum("predicted")).first()[0] == 0


def test_op10_letters_by_place():
    coded = op10_toxicity.by_place
    assert coded(b"") == b"" and coded(b"an  an").split(b"  ") == [coded(b"an")] * 2 and coded(b"andes").startswith(coded(b"and"))
    assert coded(b"sand")[1:] != coded(b"and") and coded("é1é".encode()) == coded("é".encode()) + b"1" + coded("é".encode())


def test_op5_against_brute_force(spark, corpus):
    items = [(0, corpus[3][1][40:260]), (1, corpus[25][1][200:520]), (2, "one two"), (3, ""), (4, None), (5, words(random.Random(99), 40))]
    want = op5_decontamination.brute_force([(i, t) for i, t in corpus], items)
    found = op5_decontamination.contaminated(frame(spark, corpus), "text", "doc_id", spark.createDataFrame(items, "item_id long, text string"), "text", "item_id")
    got = {(r.doc_id, r.item): r.similarity for r in found.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got) and len(got) > 3
    assert op5_decontamination.contaminated(frame(spark, []), "text", "doc_id", spark.createDataFrame(items, "item_id long, text string"), "text", "item_id").count() == 0


def test_op6_round_trip(spark, corpus):
    from tokenizers import Tokenizer

    path = op6_bpe.vocabulary()
    whole = Tokenizer.from_file(path)
    odd = ["<|startoftext|>Hi there<|endoftext|>x", "日本語 naïve Ü", "I'M it's 'S ''s !'s\x85\x1c a\x0bb", "İ ΣΑΣ", "½ ² ٣ x²", "😀😀 123abc", "'re 'v don't"]
    rows = corpus + [(1000 + i, t) for i, t in enumerate(odd)]
    for r in op6_bpe.tokenize(frame(spark, rows), "text", path).collect():
        ids = whole.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == whole.decode(ids, skip_special_tokens=False)


def test_op6_decodes_any_ids(spark):
    from tokenizers import Tokenizer

    path = op6_bpe.vocabulary()
    whole = Tokenizer.from_file(path)
    rows = [([5, 900, 44000, 17],), ([],), (None,), (list(range(0, 49000, 7)),)]
    for r in spark.createDataFrame(rows, "ids array<int>").select("ids", op6_bpe.decode(F.col("ids"), path).alias("t")).collect():
        assert r.t == whole.decode(r.ids or [], skip_special_tokens=False)
    df = frame(spark, [(1, "one two"), (2, None)]).withColumns({"ids": F.lit("x"), "Decoded": F.lit("y")})
    out = op6_bpe.tokenize(df, "text", path)
    assert sorted(c.lower() for c in out.columns) == ["decoded", "doc_id", "ids", "lang", "shard", "text"] and out.count() == 2
    assert op6_bpe.tokenize(df.limit(0), "text", path).count() == 0


def shingle_counts(texts):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append(len({tuple(w[i : i + 5]) for i in range(len(w) - 4)}) if len(w) >= 5 else int(bool(w)))
    return out


def test_op7_against_brute_force(spark, corpus):
    texts = [t for _, t in corpus]
    got = {r.doc_id: (r.n, r.component.d) for r in op7_jaccard.components(frame(spark, corpus), "text", "doc_id").collect()}
    assert [got[i][1] for i, _ in corpus] == op7_jaccard.brute_force(texts) and [got[i][0] for i, _ in corpus] == shingle_counts(texts)
    assert got[17][1] == got[18][1] == got[19][1] == 17


def test_op7_chains_groups_and_odd_keys(spark):
    """A large group of near copies, a chain whose ends do not link, texts at the threshold, repeated and null keys, the least key."""
    turn = random.Random(31)
    base = words(turn, 200).split()
    rows = []
    for k in range(120):  # most near copies link with the base, some only with others
        near = list(base)
        for _ in range(turn.randrange(1, 9)):
            near[turn.randrange(200)] = f"y{turn.randrange(10**6)}"
        rows.append(" ".join(near))
    chain = words(turn, 300).split()
    rows += [" ".join(chain[k * 12 : k * 12 + 150]) for k in range(12)]
    shared = words(turn, 80)
    rows += [shared + " " + words(turn, n) for n in (8, 12, 16, 17, 18, 20, 24) for _ in range(3)]
    rows += ["a b c d e f g h", "a b c d e f g h i", "a b c d e f g h i j", None, " \t", ""]
    got = {r.doc_id: r for r in op7_jaccard.components(frame(spark, list(enumerate(rows))), "text", "doc_id").collect()}
    assert [got[i].component.d for i in range(len(rows))] == op7_jaccard.brute_force(rows) and [got[i].n for i in range(len(rows))] == shingle_counts(rows)
    least = -(1 << 63)
    odd = frame(spark, [(None, base_text) for base_text in rows[:2]] + [(least, rows[0]), (5, rows[150]), (5, rows[150])]).withColumn("c", F.lit("x")).withColumn("d", F.lit("y"))
    seen = sorted((r.doc_id is None, r.doc_id, r.component.r < 0) for r in op7_jaccard.components(odd, "text", "doc_id").collect())
    assert [x[1] for x in seen] == [least, 5, 5, None, None] and [x[2] for x in seen] == [False, False, False, False, True]  # the last one is linked with nothing
    assert op7_jaccard.components(frame(spark, []), "text", "doc_id").count() == 0


def test_op8_against_counts(spark, corpus):
    import math
    from collections import Counter

    texts = lm_texts(frame(spark, corpus))
    seen = [i for i, _ in corpus if zlib.crc32(str(i).encode()) % 10]
    model, counts = op8_lm.train(texts.where(F.col("d").isin(seen)).select("d", "t"), head=40)
    own = {i: (t or "").encode().lower().split() + [None] for i, t in corpus}
    c = Counter(w for i in seen for w in own[i])
    n, v = sum(c.values()), len(c)
    got = {r.d: r for r in op8_lm.score(texts, model, counts).collect()}
    for i, w in own.items():
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        assert abs(got[i].base_score - base) < 1e-6 and (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
        assert got[i].score <= 0


def test_op8_pairs_seen_once(spark):
    turn = random.Random(3)
    rows = [(i, words(turn, 40)) for i in range(60)]
    model, _ = op8_lm.train(lm_texts(frame(spark, rows)).select("d", "t"))
    tokens, _ = op8_lm.sequences([rows[7][1].encode()])
    assert (model.pair_levels(op8_lm.pair(op8_lm.contexts(tokens), tokens)) >= 1).all()
    never = op8_lm.pair(tokens[2:], tokens[:-2])
    assert (model.pair_levels(never) == 0).mean() > 0.9


def lm_corpus():
    turn = random.Random(13)
    lexicon = words(turn, 600).split()
    return [(i, " ".join(lexicon[min(int(turn.paretovariate(0.6)), 599)] for _ in range(turn.randrange(5, 60)))) for i in range(400)]


def test_op8_probabilities_add_up(spark):
    """After frequent and rare words, the probabilities of all words and the end add up to 1 at most."""
    rows = lm_corpus()
    model, _ = op8_lm.train(lm_texts(frame(spark, rows)).select("d", "t"))
    vocabulary = np.unique(op8_lm.sequences([t.encode() for _, t in rows])[0])
    sums = [(10 ** model.log10(vocabulary, np.full(len(vocabulary), h))).sum() for h in vocabulary]
    assert len(sums) > 300 and np.mean(sums) < 1 and max(sums) < 1.02 and np.mean(np.array(sums) <= 1) > 0.97


def test_op8_score_against_brute_force(spark):
    """The score from exact counts; with a filter so large that it makes no errors."""
    from collections import Counter

    rows = lm_corpus()
    texts = lm_texts(frame(spark, rows))
    model, counts = op8_lm.train(texts.select("d", "t"), entry_bits=400)
    own = {i: (t or "").encode().lower().split() + [None] for i, t in rows}
    one, two = Counter(w for x in own.values() for w in x), Counter(p for x in own.values() for p in zip([None, *x], x))
    n, v = sum(one.values()), len(one)
    low = lambda c: max([0, *[x for x in op8_lm.LEVELS if x <= c]])
    high = lambda c: min([x - 1 for x in op8_lm.LEVELS if x > c]) if c else 0
    got = {r.d: r.score for r in op8_lm.score(texts, model, counts).collect()}
    for i, x in own.items():
        score = 0.0
        for h, w in zip([None, *x], x):
            share = min(low(two[h, w]), low(one[w]), low(one[h])) / (min(high(one[h]), n) + model.false_mass)
            weight = model.weights[min(int(np.log10(min(high(one[h]), n) + 1) * 2), op8_lm.GROUPS - 1)]
            score += np.log10(weight * share + (1 - weight) * (low(one[w]) + 0.1) / (n + 0.1 * (v + 1)))
        assert abs(got[i] - score) < 1e-6


def test_op8_weights_of_all_texts(spark):
    """The weights are those of sums over all training texts, far more than a thousand of them."""
    turn = random.Random(6)
    lexicon = words(turn, 40).split()
    rows = [(i, " ".join(w for k in (turn.randrange(40) for _ in range(9)) for w in lexicon[k : k + turn.choice([1, 1, 2])])) for i in range(3000)]
    texts = lm_texts(frame(spark, rows)).select("d", "t")
    model, _ = op8_lm.train(texts)
    group, among, unigram = model.shares(op8_lm.sequences([t.encode() for _, t in rows])[0], less=1)
    for g in np.unique(group):
        ratio, x = np.where(among > 0, 10 ** (np.round(np.log10(np.maximum(among, 1e-30) / unigram) * 4) / 4), 0.0)[group == g], 0.2
        for _ in range(50):
            x = (x * ratio / (x * ratio + 1 - x)).mean()
        assert abs(model.weights[g] - min(max(x, 1e-4), 0.95)) < 1e-9
    assert ((model.weights[np.unique(group)] > 0.001) & (model.weights[np.unique(group)] < 0.9)).any()


def test_op8_segments_that_are_not_broadcast(spark, corpus):
    """Levels that come from the segments by a shuffle give the same weights and scores as a filter that is broadcast."""
    rows = [*corpus, (None, corpus[0][1]), (3, corpus[4][1]), (3, None)]
    texts = lm_texts(frame(spark, rows))
    seen = texts.where("d % 3 <> 0").select("d", "t")
    got = []
    for most in (1 << 27, 0):
        model, built = op8_lm.train(seen, broadcast_bytes=most)
        assert (model.filter is None) == (most == 0)
        scored = op8_lm.score(texts, model, built)
        assert scored.count() == len(rows)
        got.append((model.weights, {(r.d, r.r): r for r in scored.collect()}))
    assert np.allclose(got[0][0], got[1][0], atol=1e-12) and got[0][1].keys() == got[1][1].keys()
    for at, one in got[0][1].items():
        other = got[1][1][at]
        assert abs(one.score - other.score) < 1e-6 and abs(one.base_score - other.base_score) < 1e-6 and (one.n_tokens, one.n_known) == (other.n_tokens, other.n_known)
    model, built = op8_lm.train(seen.limit(0), broadcast_bytes=0)
    assert op8_lm.score(texts, model, built).where("n_known > 0").count() == 0 and op8_lm.score(texts.limit(0), model, built).count() == 0


def test_op9_against_brute_force(spark):
    turn = np.random.default_rng(8)
    x = turn.standard_normal((400, 16))
    x[100:200] = x[100] + turn.standard_normal((100, 16)) * 0.05
    x[300:330] = x[300]
    rows = [(i, [float(y) for y in v]) for i, v in enumerate(x)] + [(500, None), (501, [0.0] * 16), (502, [float("nan")] * 16), (503, [None] * 16), (504, []), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = {}
    for r in op9_ann.search(df, "vec_id", "v", F.coalesce(F.col("vec_id") % 10 == 0, F.lit(False)), 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 400, 10))
    hits = 0
    for q, found in got.items():
        s = unit @ unit[q]
        s[q] = -9
        best = np.lexsort((np.arange(400), -s.round(12)))[:5]
        hits += len({v for _, v, _ in found} & set(best.tolist()))
        assert [k for k, _, _ in sorted(found)] == [1, 2, 3, 4, 5]
    assert hits >= 0.95 * 5 * len(got)


def test_op9_recall_of_the_curves(spark):
    """Vectors without near neighbours, the hardest case: the windows cover a part of the rows and cross the borders of blocks."""
    from cinderline.llm.common import table

    x = np.array([r.embedding for r in table(spark, "/root/testdata/sf0.1", "embeddings").orderBy("vec_id").collect()])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = {}
    for r in op9_ann.op9_ann(spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q, found in got.items():
        s = unit @ unit[q]
        s[q] = -9
        hits += len(found & set(np.argsort(-s)[:5].tolist()))
    assert len(got) == len(x) // 50 and hits >= 0.95 * 5 * len(got)


def test_op9_lengths_and_empty(spark):
    rows = [(i, [1.0, i / 10]) for i in range(6)] + [(10 + i, [1.0, 0.5, i / 10]) for i in range(3)] + [(0, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>").withColumn("c", F.lit(1)).withColumn("curve", F.lit("x"))
    got = [(r.query_id, r["rank"], r.vec_id) for r in op9_ann.search(df, "vec_id", "v", F.col("vec_id").isin(0, 10), 5).collect()]
    assert sorted(got) == [(0, k, k) for k in range(1, 6)] + [(10, 1, 11), (10, 2, 12)]
    assert op9_ann.search(df.limit(0), "vec_id", "v", F.lit(True), 5).count() == 0


def test_hashes_of_words():
    a, first = bytehash.words([b"One two\xc2\xa0x  three", b"", b"one"])
    assert len(a) == 4 and a[0] == a[3] and first.tolist() == [0, 3, 3, 4]


def test_op6_combining_marks_against_the_library():
    """Text whose marks change their order when it is normalised twice."""
    from tokenizers import Tokenizer

    path, turn = op6_bpe.vocabulary(), random.Random(12)
    own, whole = op6_bpe.WordTable(path), Tokenizer.from_file(path)
    whole.no_truncation()
    whole.no_padding()
    letters = "aALİIiéÖ̧̇̀́ß字 \n'’12½ıſ"
    texts = ["ALİ" + "̧", *("".join(turn.choice(letters) for _ in range(turn.randrange(1, 14))) for _ in range(4000))]
    for t, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == whole.encode(t, add_special_tokens=False).ids, t


def test_op7_component_of_rows_without_a_key(spark):
    """The least key that is reached counts; a row without one comes into it only where no other has one."""
    text = "one two three four five six seven eight nine ten"
    rows = [(None, text), (8, text), (5, text + " eleven"), (-(1 << 63), "a b c d e f"), (None, "a b c d e f"), (None, "x y z u v w"), (None, "x y z u v w")]
    found = op7_jaccard.components(frame(spark, rows), "text", "doc_id").collect()
    got = sorted(((r.doc_id, r.component.d if r.component.r >= 0 else None) for r in found), key=str)
    assert got == sorted([(None, 5), (8, 5), (5, 5), (-(1 << 63), -(1 << 63)), (None, -(1 << 63)), (None, None), (None, None)], key=str)


def test_keyed_tells_repeated_rows_apart(spark):
    rows = [(i, f"t{i % 3}") for i in range(50)] + [(7, "t"), (7, "t"), (7, None), (None, "t"), (None, "t"), (None, None), (-(1 << 63), "low")]
    got = [(r.d, r.r, r.t, r.row.doc_id) for r in keyed(frame(spark, rows).repartition(5), "doc_id", "text", whole=True).collect()]
    assert len({g[:2] for g in got}) == len(got) == len(rows)
    assert sorted((g[3], g[2]) for g in got if g[1] == 0 and g[3] not in (7, None)) == sorted((i, t) for i, t in rows if i not in (7, None))
    assert [g[2] for g in sorted(g for g in got if g[3] == 7)] == [None, "t", "t", "t1"] and all(g[1] < 0 for g in got if g[3] is None)


def test_op9_tiny_and_huge_vectors(spark):
    rows = [(0, [1e-200, 2e-200]), (1, [1.0, 2.0]), (2, [1e200, 2e200]), (3, [-3e300, 1e300]), (4, [5e-324, 0.0]), (5, [3.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    got = {}
    for r in op9_ann.search(df, "vec_id", "v", F.lit(True), 5).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert len(got) == 6 and all(len(v) == 5 for v in got.values())
    for q, v in rows:
        for c, score in got[q]:
            x, y = (np.array(w, dtype=np.longdouble) for w in (v, dict(rows)[c]))
            x, y = x / np.abs(x).max(), y / np.abs(y).max()
            assert abs(score - float(x @ y / np.sqrt((x @ x) * (y @ y)))) < 1e-12
    assert [c for c, _ in got[0][:2]] == [1, 2] or {got[0][0][1], got[0][1][1]} <= {1.0, 0.9999999999999998, 1.0000000000000002}


def test_op9_recall_at_more_rows(spark):
    """Random vectors in 64 dimensions have no near neighbours: the hardest case. The window is a share of the rows."""
    turn = np.random.default_rng(5)
    x = turn.standard_normal((12_000, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, v array<double>")
    asks = F.col("vec_id") % 400 == 0
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = n = 0
    found = {}
    for r in op9_ann.search(df, "vec_id", "v", asks, 5).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    for q in range(0, 12_000, 400):
        score = unit @ unit[q]
        score[q] = -2
        hit += len(found[q] & set(np.argsort(-score)[:5].tolist()))
        n += 5
    assert hit / n >= 0.9
