"""Collocations against a plain count of every phrase, with many small shards."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from cuadra.llm import phrases as P

TABLE = "doc_id long, text string, lang string, length int, phrase string, n long, h long, a string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark, rows):
    return spark.createDataFrame([(i, t, v, 1, "p", 2, 3, "z") for i, (t, v) in enumerate(rows)], TABLE)


def counts(rows, longest):
    found, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                found.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    return found, n


def brute(rows, longest, support, share, top):
    found, n = counts(rows, longest)
    often = {p: c for p, c in found.items() if c >= support}
    by_lang = {}
    for (lang, words), a in often.items():
        if len(words) < 2:
            continue
        inside = lambda q: any(q[i:i + len(words)] == words for i in range(len(q) - len(words) + 1))
        if any(v == lang and len(q) > len(words) and 100 * c >= share * a and inside(q) for (v, q), c in often.items()):
            continue
        cuts = [(1000 * a * n[lang] // (found[lang, words[:k]] * found[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        by_lang.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), found[lang, words[:k]], found[lang, words[k:]]))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, rows in by_lang.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    words = ["the", "The", "new", "york", "of", "é", "ÉL", "a-b", "\x1c", "it's", "\U0001F600", "x", "y", "zz"]
    glue = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]
    made = [("".join(rng.choice(words[:6 + i % 9]) + rng.choice(glue) for _ in range(rng.randint(0, 60))), rng.choice(["en", "fr", None, "und", ""]))
            for i in range(300)]
    return [*made, (None, "en"), ("", None), ("... ", "fr"), ("new york " * 3000, "en"), *[("Of the New York.", "de")] * 40, ("only", "nl")]


def filed(spark, rows, folder, files=7):
    """The table read from several files, which are dealt over the shards."""
    table(spark, rows).repartition(files).write.parquet(f"{folder}/documents.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.mark.parametrize("shards,block_words,support,share", [(5, 50, 5, 100), (3, 700, 12, 100), (8, 10**6, 40, 100), (4, 300, 9, 60), (40, 100, 7, 100)])
def test_equals_a_plain_count(spark, rows, tmp_path, shards, block_words, support, share):
    got = P.collocations(filed(spark, rows, tmp_path), 5, support, share, 50, shards, block_words).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 5, support, share, 50)


def test_rows_from_no_file_are_one_shard(spark, rows):
    got = P.collocations(table(spark, rows).repartition(5), 3, 10, 100, 50, 8, 500).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 3, 10, 100, 50)


@pytest.mark.parametrize("longest", [2, 4])
def test_every_frequent_phrase_with_its_count(spark, rows, tmp_path, longest):
    known, totals = P.frequent(filed(spark, rows, tmp_path), longest, 6, 4, 90)
    found, n = counts(rows, longest)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.n for r in known.collect()} == {p: c for p, c in found.items() if c >= 6}
    assert {r.lang: r.n for r in totals.collect()} == {v: c for v, c in n.items() if c}


def test_scores_beyond_64_bits_are_exact(spark):
    rng = random.Random(4)
    known, expected = [], {}
    for i in range(200):
        a = rng.randint(100, 10**rng.randint(3, 14))
        left, right = a + rng.randint(0, 10**rng.randint(1, 14)), a + rng.randint(0, 10**rng.randint(1, 14))
        known += [("en", 1, f"l{i}", left), ("en", 1, f"r{i}", right), ("en", 2, f"l{i} r{i}", a)]
        expected[f"l{i} r{i}"] = 1000 * a * 10**16 // (left * right)
    rows = P.scored(spark.createDataFrame(known, "lang string, length int, phrase string, n long"), spark.createDataFrame([("en", 10**16)], "lang string, n long")).collect()
    assert {r.phrase: r.score for r in rows} == expected


def test_filter_holds_what_was_put_in(spark):
    rng = np.random.default_rng(1)
    put, other = rng.integers(0, 2**63, 5000, dtype=np.uint64), rng.integers(0, 2**63, 5000, dtype=np.uint64)
    known = P.Filter(P.bloom(spark.createDataFrame([(int(h),) for h in put], "h long"), len(put)))
    assert known.holds(put).all() and known.holds(other).mean() < 0.01
    assert not P.Filter(P.bloom(spark.createDataFrame([], "h long"), 0)).holds(other).any()


def test_empty_table(spark):
    assert P.collocations(table(spark, [])).collect() == []
    assert P.collocations(table(spark, [(None, None), ("", "en")])).collect() == []


def test_filters_take_one_python_step_a_task(spark, rows, tmp_path, monkeypatch):
    """Two steps in one task are two workers, each with memory of its own."""
    steps, bloom = [], P.bloom
    monkeypatch.setattr(P, "bloom", lambda hashes, *a: steps.append(hashes._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")) or bloom(hashes, *a))
    P.collocations(filed(spark, rows, tmp_path), support=20, shards=3, block_words=500).collect()
    assert steps and not any(steps)


@pytest.mark.parametrize("held", [1, 64, 10**6])
def test_blocks_of_a_task_are_added_up(held):
    rng = np.random.default_rng(2)
    parts = [[np.full(50, i % 2, np.int32), rng.integers(0, 9, 50), rng.integers(1, 5, 50), np.full(50, 3 + i % 2, np.int32),
              rng.integers(0, 2, 50).astype(np.int32), rng.integers(-99, 99, 50)] for i in range(40)]
    expected = {}
    for p in parts:
        for shard, h, n, least, x, place in zip(*map(np.ndarray.tolist, p)):
            old = expected.get((shard, h, x), (0, 0, place))
            expected[shard, h, x] = (old[0] + n, least, min(old[2], place))
    got, rows = {}, 0
    for p in P.added_up(iter(parts), held):
        rows += len(p[0])
        for shard, h, n, least, x, place in zip(*map(np.ndarray.tolist, p)):
            old = got.get((shard, h, x), (0, 0, place))
            got[shard, h, x] = (old[0] + n, least, min(old[2], place))
    assert got == expected
    assert rows == len(expected) or held < 100
    assert list(P.added_up(iter([]), held)) == []


def test_heavy_buckets_hold_what_reaches_the_support(spark):
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 2**63, 30_000, dtype=np.uint64)
    rows = spark.createDataFrame([(int(h), 60 if i < 300 else 1) for i, h in enumerate([*hashes, *hashes[:200]])], "h long, n long").repartition(3)

    def counted(batches):
        for b in batches:
            yield b.column("h").to_numpy().view(np.uint64), b.column("n").to_numpy()

    bits = P.heavy_buckets(rows, counted, 60 * 300 + 29_900, 61)
    assert P.in_bucket(bits, hashes[:200]).all() and P.in_bucket(bits, hashes).mean() < 0.05
    assert not P.in_bucket(P.heavy_buckets(rows.where("n < 0"), counted, 0, 61), hashes).any()
