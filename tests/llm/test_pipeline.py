"""The pipeline on a small folder: what each stage takes out, and what stays."""

from __future__ import annotations

import random


import corpus_pipeline


def test_run(spark, tmp_path):
    turn = random.Random(21)
    lexicon = {k: ["".join(turn.choice(v) for _ in range(turn.randrange(3, 8))) for _ in range(400)] for k, v in (("aa", "bacade"), ("bb", "wixuyoz"))}
    text = lambda k, n: " ".join(turn.choice(lexicon[k]) for _ in range(n))
    rows = [(i, text("ab"[i % 2] * 2, 150), "ab"[i % 2] * 2) for i in range(60)]
    item, passage = text("aa", 40), text("bb", 50)
    rows += [(100, rows[0][1], "aa"), (101, rows[1][1] + " end", "bb"), (102, text("aa", 60) + " " + item + " " + text("aa", 60), "aa"), (103, None, "aa"), (104, "12 34", None)]
    rows += [(110 + k, text("bb", 60) + " " + passage + " " + text("bb", 60), "bb") for k in range(3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, k, "s", len(t or "")) for i, t, k in rows], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {*range(60), 110, 111, 112} == got.keys()
    assert passage in got[110].text and passage not in got[111].text and got[111].n_chars == len(got[111].text)
    assert got[5].text == rows[5][1] and got[5].n_tokens == len(got[5].ids)
