"""The five stages on a small corpus with planted cases, each stage judged on
what its predecessor kept."""

import random
import zlib

import numpy as np

import corpus_pipeline
from cuadra.llm import tokens
from cuadra.llm.common import staged
from tests.llm.test_llm_operators import library, linked, prose


def corpus(spark, folder):
    rng = random.Random(20)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    leak = prose(rng, 30, words)
    rows = []
    for i in range(200):
        text = prose(rng, rng.randint(30, 120), words).split()
        lang = "en" if i % 4 else "fr"
        text += (["the", "and", "of"] if lang == "en" else ["les", "des", "une"]) * 8
        rng.shuffle(text)
        if i % 5 == 0:
            for w in ("badword", "uglyterm"):
                text[rng.randrange(len(text))] = w
        if i in (31, 62):
            text[10:10] = leak.split()
        rows.append([i, " ".join(text), lang, "s", 0])
    rows += [[300 + i, rows[i][1] + " tail", "en", "s", 0] for i in (1, 2, 3)] + [[310, rows[7][1], "en", "s", 0]]
    rows += [[400, None, None, None, None], [401, "", "en", "s", 0]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, leak)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_stages_in_order(spark, tmp_path):
    folder = f"file://{tmp_path}"
    corpus(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = staged(stage(spark, docs, folder), name)
        seen[name] = [r.doc_id for r in docs.select("doc_id").collect()]
        if name != "tokens":
            assert docs.columns == columns
            assert docs.join(before, "doc_id", "left_anti").count() == 0
    toxic = {i for i in range(200) if i % 5 == 0}
    left = set(seen["toxicity"])
    assert len(left & toxic) <= 2 and len(left - toxic) >= 0.98 * (206 - len(toxic))
    # near copies: one document of each class of what the first stage kept
    first = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect() if r.doc_id in left)
    _, lead = linked([t for _, t in first])
    assert sorted(seen["near_duplicates"]) == sorted({first[i][0] for i in lead})
    assert not {301, 302, 303, 310} & set(seen["near_duplicates"])
    assert set(seen["near_duplicates"]) - set(seen["decontamination"]) == {31, 62}
    # mixing drops nobody and repeats some
    assert set(seen["mixing"]) == set(seen["decontamination"]) and len(seen["mixing"]) > len(seen["decontamination"])
    rows = sorted(docs.collect(), key=lambda r: r.start)
    texts = {r.doc_id: r.text or "" for r in before.collect()}
    at = 0
    for r in rows:
        ids = [*library().encode(texts[r.doc_id], add_special_tokens=False).ids, tokens.END_ID]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_empty_corpus(spark, tmp_path):
    folder = f"file://{tmp_path}"
    corpus(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, folder), "empty")
        assert docs.count() == 0
