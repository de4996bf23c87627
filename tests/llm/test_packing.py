"""Packing against the tokenizers library and a plain best-fit decreasing over lists."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cuadra.llm import packing as P

TABLE = "doc_id long, text string, shard string, length string, sequence_id int, ids string, id int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(str(public_tokenizers.path(P.TOKENIZER)))


def table(spark, texts, ids=None):
    return spark.createDataFrame([(i if ids is None else ids[i], t, "a", "b", 1, "c", 2) for i, t in enumerate(texts)], TABLE)


def best_fit(lengths, window):
    """Fill of each window, trying every open one for each length."""
    fills = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, f in enumerate(fills) if window - f >= n]
        if fits:
            fills[max(fits, key=lambda i: fills[i])] += n
        else:
            fills.append(n)
    return fills


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghi") for _ in range(rng.randint(2, 9))) for _ in range(500)]
    made = [" ".join(rng.choice(words) for _ in range(int(rng.expovariate(1 / 150)))) for _ in range(300)]
    return [*made, None, "", "", "é\U0001F600" * 3, "x " * 30000, made[0], made[0], "<|endoftext|>"]


def check(rows, texts, library, window):
    ids = [[*library.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(range(len(texts)))
    for d, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[d])
            assert list(np.frombuffer(r.ids, "<u4")) == ids[d][at:at + r.length]
            at += r.length
        assert at == len(ids[d])
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return [sum(r.length for r in pieces) for pieces in by_sequence.values()], [len(i) for i in ids]


@pytest.mark.parametrize("window", [64, 100, 1024])
def test_pieces_cover_documents_and_fill_as_best_fit_does(spark, texts, library, window):
    rows = P.pack(table(spark, texts), window=window).collect()
    fills, lengths = check(rows, texts, library, window)
    whole = sum(n // window for n in lengths)
    assert sorted(fills) == sorted([window] * whole + best_fit([n % window for n in lengths if n % window], window))


def test_many_shards(spark, texts, library, monkeypatch):
    monkeypatch.setattr(P, "SHARD_PIECES", 20)
    fills, lengths = check(P.pack(table(spark, texts), window=256).collect(), texts, library, 256)
    assert sum(fills) == sum(lengths)


def test_sequences_join_their_pieces(spark, texts):
    packed = P.staged(P.pack(table(spark, texts), window=256), "packed")
    by_sequence = defaultdict(list)
    for r in packed.collect():
        by_sequence[r.sequence_id].append(r)
    made = P.sequences(packed).collect()
    assert len(made) == len(by_sequence)
    for s in made:
        pieces = sorted(by_sequence[s.sequence_id], key=lambda r: r.offset)
        assert bytes(s.ids) == b"".join(bytes(r.ids) for r in pieces) and s.length == sum(r.length for r in pieces)
        assert [(d.doc_id, d.start, d.length) for d in s.docs] == [(r.doc_id, r.start, r.length) for r in pieces]


def test_tree_finds_the_tightest_window():
    rng = random.Random(2)
    for window in (7, 64, 1000):
        tree, held = P.Capacities(window), defaultdict(int)
        for _ in range(3000):
            c = rng.randint(1, window)
            n = 1 if rng.random() < 0.5 or not held[c] else -1
            tree.add(c, n)
            held[c] += n
            need = rng.randint(1, window)
            assert tree.tightest(need) == min((k for k, v in held.items() if v and k >= need), default=-1)


def test_repeated_ids_and_empty_table(spark, library):
    rows = P.pack(table(spark, ["a b", "a b", "c"], ids=[1, 1, None])).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows) == sorted([(1, len(library.encode("a b").ids) + 1)] * 2 + [(0, 2)])
    assert sorted(r.offset for r in rows)[0] == 0 and len({r.sequence_id for r in rows}) == 1
    assert P.pack(table(spark, [])).collect() == []


def test_query(spark, texts, library, tmp_path):
    table(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = P.op12_packing(spark, str(tmp_path)).collect()
    for r in rows:
        ids = [*library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 0]
        assert (r.doc_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes()))
    assert sum(r.length for r in rows) == sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts)
