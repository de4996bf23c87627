"""Each training-data operator against a brute-force version on small tables:
nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cuadra.llm import decontaminate, langid, minhash, mixing, pii, suffix, tokens, toxicity, urls, vptree
from cuadra.llm.common import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, row string, key string, n int, component long"


def docs(spark, texts, langs=None, ids=None):
    """A documents table with more columns, whose names the operators use inside."""
    rows = []
    for i, t in enumerate(texts):
        d = i if ids is None else ids[i]
        rows.append((d, t, langs[i] if langs else None, "s", len(t or ""), -1, "x", "y", 7, 9))
    return spark.createDataFrame(rows, DOCS)


def prose(rng, n, words=None):
    words = words or ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    return " ".join(rng.choice(words) for _ in range(n))


# ------------------------------------------------------------------ op 1

def base_spans(text):
    text, out = text or "", []
    luhn = lambda d: sum(int(c) if i % 2 == 0 else sum(divmod(int(c) * 2, 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    only = lambda s: re.sub("[^0-9]", "", s)
    for kind, pattern, ok in (
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
            ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(only(s)) <= 19 and luhn(only(s))),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(only(s)) <= 15)):
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if ok(m.group())]
    return out


def test_pii_base_spans_and_added_kinds(spark):
    rng = random.Random(1)
    alphabet = ["a", "b.c", "@", "x@y.zz", ".", "1", "23", "4111 1111 1111 1111", "10.0.0.255", "256.1.1.1", "+34 600 123 456", "-", " ", "_", "é", "\U0001F600", "%", "+"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    texts += [None, "", "a@b.c_d@e.f", "x" * 50000 + "@b.c", "1 " * 20000, texts[0], texts[0], "001.002.003.004", "1.2.3.4.5.6.7.8"]
    got = {r.doc_id: [(f.kind, f.start, f.end) for f in r.findings] for r in pii.find(docs(spark, texts)).collect()}
    base = {k.name for k in pii.KINDS if k.base}
    for i, t in enumerate(texts):
        assert [f for f in got[i] if f[0] in base] == base_spans(t), t
    extra = ["pay to GB82 WEST 1234 5698 7654 32 now", "GB82 WEST 1234 5698 7654 33", "my ssn 123-45-6789", "code 123-45-6789",
             "call 555-123-4567", "555-123-4567 x", "routing 021000021"]
    kinds = [[f.kind for f in r.findings] for r in pii.find(docs(spark, extra)).orderBy("doc_id").collect()]
    assert kinds == [["iban"], [], ["ssn"], [], ["phone_local"], [], ["routing"]]
    red = pii.redact(pii.find(docs(spark, ["mail a@b.cc, ip 1.2.3.4."])))
    assert red.first().redacted == "mail <EMAIL>, ip <IP>."
    assert pii.find(docs(spark, [])).count() == 0


def test_pii_cards_without_adjacent_digits(spark):
    card = "4111111111111111"
    texts = ["card " + " ".join(card), "-".join(card), "x" + "-".join(card) + ".", "4 1-1 1-1 1-1 1-1 1-1 1-1 1-1 1", "pay " + " ".join("4111111111111112"), "4  1  1"]
    got = {r.doc_id: [(f.kind, f.start, f.end) for f in r.findings] for r in pii.find(docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == [base_spans(t) for t in texts]
    assert [len(got[i]) for i in range(len(texts))] == [1, 1, 1, 1, 0, 0]


# ------------------------------------------------------------------ op 2

def test_url_rules_and_vocabulary(spark):
    cases = {
        "https://a.Example.ORG/es/1": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/12?x": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://x.org/casino": ("x.org", "/casino", "org/", "allow"),
        "http://x.org": ("x.org", "", None, "allow"),
        "http://shop.com/fr/": ("shop.com", "/fr/", "com/fr/", "allow"),
        "http://shop.com/de/a#b": ("shop.com", "/de/a", "com/de/", "block"),
        "http://Casino-win.net/a": ("casino-win.net", "/a", None, "block"),
        "http://mycasino.net/a": ("mycasino.net", "/a", None, "allow"),
        "http://free-free.net/free": ("free-free.net", "/free", None, "allow"),
        "http://free-bets.net/": ("free-bets.net", "/", None, "block"),
        "notorg/x": ("", "", None, "allow"), None: ("", "", None, "allow"), "": ("", "", None, "allow"),
        "http://h#f://y": ("h", "", None, "allow"), "http://" + "a" * 100000 + "/casino": ("a" * 100000, "/casino", None, "block")}
    rows = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(cases)], "page_id long, url string, host string")
    got = [(r.judged.host, r.judged.path, r.judged.rule, r.judged.verdict) for r in urls.judge(rows).orderBy("page_id").collect()]
    assert got == list(cases.values())
    assert urls.judge(rows.limit(0)).count() == 0


def test_url_vocabulary_covers_the_whole_url(spark):
    cases = {
        "http://a.net/go?to=casino&x=viagra": ("block", 2, 0), "http://a.net/#XXX": ("block", 1, 0), "www.porn.com/xxx": ("block", 2, 0),
        "http://a.net/free?free=1#bets": ("block", 0, 2), "http://a.net/?q=mycasino": ("allow", 0, 0), "http://x.org/?casino": ("allow", 1, 0),
        "casino": ("block", 1, 0), "/free": ("allow", 0, 1), "casino://a.net/": ("block", 1, 0)}
    rows = spark.createDataFrame(list(enumerate(cases)), "page_id long, url string")
    got = [(r.judged.verdict, r.judged.n_strict, r.judged.n_soft) for r in urls.judge(rows).orderBy("page_id").collect()]
    assert got == list(cases.values())


# ------------------------------------------------------------------ op 3

def test_mixing_meets_targets_and_handles_edges(spark):
    rng = random.Random(3)
    en, fr = [[prose(rng, 30, w.split()) for _ in range(n)] for w, n in (("the and of with house", 30), ("les des une maison avec", 10))]
    texts, langs = [*en, *fr, None, "", en[0]], ["en"] * 30 + ["fr"] * 10 + [None, "en", None]
    rows, found = mixing.mix(docs(spark, texts, langs), targets={"en": 0.5, "fr": 0.5})
    assert np.abs(found.totals - found.targets).sum() <= 1e-4 * found.targets.sum()
    got = rows.orderBy("doc_id").collect()
    assert len(got) == len(texts) and all(r.mixing.rate >= 0.999 and r.mixing.copies >= 0 for r in got)
    assert {r.mixing.domain for r in got[:30]} == {"en"}
    rows, found = mixing.mix(docs(spark, ["a", None]))
    assert [r.mixing.copies for r in rows.collect()] == [1, 1] and found.names == []
    rows, _ = mixing.mix(docs(spark, []))
    assert rows.count() == 0


def test_mixing_is_least_squares_under_nonnegative_rates(spark):
    p = np.array([[0.7, 0.3] if i % 2 else [0.2, 0.8] for i in range(60)])
    n = np.array([float(i % 7 + 1) for i in range(60)])
    rows = spark.createDataFrame([(float(a), b.tolist()) for a, b in zip(n, p)], "__tokens double, __posterior array<double>")
    for targets in ({"a": 1.0}, {"a": 0.5, "b": 0.5}, {"b": 1.0}):
        found = mixing.fit(rows, ["a", "b"], targets, total=200.0)
        weight = 1 / (n @ p)
        # brute force over the two kinds of documents
        a, b = n[1::2].sum(), n[::2].sum()
        grid = np.linspace(0, 4, 401)
        x, y = np.meshgrid(grid, grid)
        loss = sum(w * (x * a * u + y * b * v - g) ** 2 for w, u, v, g in zip(weight, (0.7, 0.3), (0.2, 0.8), found.targets))
        own = float((weight * (found.totals - found.targets) ** 2).sum())
        assert own <= loss.min() * 1.01 + 1e-2


@pytest.mark.parametrize("leak", [0.01, 0.05])
def test_mixing_lowers_no_rate_below_one(spark, leak):
    share = {"a": 400, "b": 60, "c": 50, "d": 30}
    p = np.repeat(np.eye(4) * (1 - 4 * leak / 3) + leak / 3, list(share.values()), axis=0)
    p[:200] = [1.0, 0.0, 0.0, 0.0]
    rows = spark.createDataFrame([(10.0, x.tolist()) for x in p], "__tokens double, __posterior array<double>").coalesce(1)
    found = mixing.fit(rows, list(share), {"a": 0.4, "b": 0.2, "c": 0.2, "d": 0.2})
    rates = found.rates(p)
    assert rates.min() >= 1 and np.allclose(found.totals, (rates * 10.0) @ p)
    assert np.abs(found.totals - found.targets).sum() <= 1e-3 * found.targets.sum()
    assert found.targets.sum() < 1.2 * 4000 / 0.4


# ------------------------------------------------------------------ op 4

@pytest.mark.parametrize("common", [1, 10, 16])
def test_block_max_search_is_exact(common, monkeypatch):
    monkeypatch.setattr(toxicity, "COMMON", common)   # all terms sparse, some dense, all dense
    rng = np.random.default_rng(4)
    vocabulary = np.arange(1, 41, dtype=np.uint64)
    terms = [np.sort(rng.choice(vocabulary, rng.integers(0, 8), replace=False)) for _ in range(500)]
    counts = [rng.integers(1, 5, len(t)).astype(float) for t in terms]
    labels = [int(t.size > 0 and t[0] < 8) for t in terms]
    index = toxicity.Index(list(range(500)), labels, terms, counts, vocabulary)
    dense = np.zeros((500, 40))
    for i, (t, c) in enumerate(zip(terms, counts)):
        dense[i, t.astype(int) - 1] = (1 + np.log(c)) * index.idf[t.astype(int) - 1]
    dense /= np.maximum(np.sqrt((dense ** 2).sum(1)), 1e-300)[:, None]
    for i in range(0, 500, 7):
        if len(terms[i]):
            best, cosine = (x[0] for x in index.nearest(terms[i].astype(int) - 1, counts[i], np.array([0, len(terms[i])]), np.array([i])))
            best, cosine = best[best >= 0], cosine[best >= 0]
            want = np.round(dense @ dense[i], 12)
            want[i] = 0
            order = np.lexsort((np.arange(500), -want))[:toxicity.K]
            order = order[want[order] > 0]
            assert index.ids[best].tolist() == order.tolist() and np.allclose(cosine, want[order])
    # many queries at once give what each alone gives
    some = [i for i in range(300) if len(terms[i])]
    t, c = np.concatenate([terms[i].astype(int) - 1 for i in some]), np.concatenate([counts[i] for i in some])
    whole = index.nearest(t, c, np.r_[0, np.cumsum([len(terms[i]) for i in some])])
    for k, i in enumerate(some):
        alone = index.nearest(terms[i].astype(int) - 1, counts[i], np.array([0, len(terms[i])]))
        assert (whole[0][k] == alone[0][0]).all() and np.allclose(whole[1][k], alone[1][0])


def test_toxicity_learns_and_handles_edges(spark):
    rng = random.Random(5)
    texts, marks = [], []
    for i in range(240):
        bad = i % 4 == 0
        words = prose(rng, 60).split()
        if bad:
            for w in rng.sample(["badword", "uglyterm", "vileness"], 2):
                words[rng.randrange(60)] = w + ","
        texts.append(" ".join(words))
        marks.append(int(bad))
    table = docs(spark, [*texts, None, "", texts[0]])
    labels = spark.createDataFrame([(i, m) for i, m in enumerate(marks)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    index = toxicity.fit(table, toxicity.training_labels(labels))
    got = {r.doc_id: r.toxicity.score for r in toxicity.score(table, index).collect()}
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum((got[i] >= toxicity.THRESHOLD) == bool(marks[i]) for i in held)
    assert right >= 0.97 * len(held) and 0 <= got[240] < toxicity.THRESHOLD and got[241] == got[240] and got[242] == got[0]
    none = toxicity.fit(table, labels.limit(0))
    assert {r.toxicity.score for r in toxicity.score(table, none).collect()} == {0.0}
    assert toxicity.score(docs(spark, []), index).count() == 0


@pytest.mark.parametrize("n", [24, 160])
def test_toxicity_finds_a_copy_of_an_example_of_rare_words(spark, n):
    rng = random.Random(23)
    rare = lambda: " ".join("".join(rng.choice("ijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(30))
    marks = [int(i % 4 == 0) for i in range(n)]
    texts = [prose(rng, 60) + (" badword uglyterm" if m else "") for m in marks]
    texts[4], texts[5] = rare(), rare()
    table = docs(spark, [*texts, texts[4], texts[5], rare()])
    index = toxicity.fit(table, spark.createDataFrame(list(enumerate(marks)), "doc_id long, toxic int"))
    got = {r.doc_id: r.toxicity for r in toxicity.score(table, index).collect()}
    assert got[n].score >= toxicity.THRESHOLD > max(got[n + 1].score, got[n + 2].score)
    assert got[n].evidence[0] == "4:1:1.0000" and got[n + 1].evidence[0] == "5:0:1.0000"


# ------------------------------------------------------------------ op 5

def repeats(rows, length):
    seen = Counter(t[i:i + length] for t in rows for i in range(len(t) - length + 1))
    out = []
    for t in rows:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot,piece", [(2048, 2 << 20), (1, 700)])
def test_repeats_match_brute_force(spark, monkeypatch, hot, piece):
    monkeypatch.setattr(suffix, "HOT", hot)
    monkeypatch.setattr(suffix, "SLICE_BYTES", piece)
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    line, passage = text(210), text(400)
    texts = [None, "", "short", "z" * 900, text(3000) + passage + text(100), passage, text(50) + passage[:260] + text(50)]
    texts += [text(rng.randint(1, 150)) + line[:205] + text(rng.randint(1, 150)) for _ in range(12)]
    texts += [texts[4], texts[9], text(400), line[:199]]
    got = {r.id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.without_repeats(docs(spark, texts)).collect()}
    want = repeats([(t or "").encode() for t in texts], suffix.LENGTH)
    assert [got[i] for i in range(len(texts))] == want


def test_repeats_of_empty_tables_null_and_repeated_ids(spark):
    assert suffix.without_repeats(docs(spark, [])).count() == 0
    text = prose(random.Random(7), 80)
    got = suffix.without_repeats(docs(spark, [text, text, "other"], ids=[None, None, 3])).collect()
    assert sorted((r.n_removed, r.n_bytes) for r in got) == sorted([(len(text), len(text))] * 2 + [(0, 5)])


def test_run_index_matches_are_longest_matches():
    rng = np.random.default_rng(8)
    segments = [bytes(rng.integers(97, 99, rng.integers(5, 40)).astype(np.uint8)) for _ in range(12)]
    index = suffix.RunIndex(segments)
    places = [(i, j) for i, s in enumerate(segments) for j in range(len(s))]
    for i, j in places[::5]:
        best = 0
        for a, b in places:
            k = 0
            while (a, b) != (i, j) and j + k < len(segments[i]) and b + k < len(segments[a]) and segments[i][j + k] == segments[a][b + k]:
                k += 1
            best = max(best, k)
        assert index.matches[index.starts[i] + j] == best


# ------------------------------------------------------------------ op 6

def test_vector_search_is_exact_at_factor_one(spark):
    rng = np.random.default_rng(9)
    some = rng.normal(size=(900, 8)).astype(np.float32)
    some[100:160] = some[100]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(some)]
    rows += [(900, None, "x"), (920, [0.0] * 8, "x"), (940, [float("nan")] + [1.0] * 7, "x"), (960, [None] + [1.0] * 7, "x"),
             (980, [float("inf")] * 8, "x"), (None, [1.0] * 8, "x"), (20, some[20].tolist(), "x"), (1000, [1.0] * 3, "x"), (1001, [1.0] * 3, "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, vector string")
    usable = vptree.usable(table)
    got = vptree.search(usable, usable.where("id % 20 = 0"), factor=1.0).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    wide = some.astype(float)
    assert set(by) == {*range(0, 900, 20), 1000}
    assert by[1000] == [(1001, 3.0)]
    for q in range(0, 900, 20):
        score = np.einsum("md,d->m", wide, wide[q])
        score[q] = -np.inf
        order = np.lexsort((np.arange(900), -score))[:20]
        assert [x[0] for x in by[q]] == order.tolist() and np.allclose([x[1] for x in by[q]], score[order], rtol=0, atol=1e-12)
    loose = vptree.search(usable, usable.where("id % 20 = 0")).collect()
    exact = {(r.query_id, r.vec_id) for r in got}
    assert len(exact & {(r.query_id, r.vec_id) for r in loose}) >= 0.9 * len(exact)
    assert vptree.search(usable.limit(0), usable.limit(0)).count() == 0


def test_vector_search_scores_few_pairs(monkeypatch):
    """A matrix product rules out most pairs before any is scored on its own."""
    rng, scored, einsum = np.random.default_rng(10), [], np.einsum
    vectors = rng.normal(size=(4096, 16))
    tree = vptree.Tree(np.arange(4096), vectors.copy(), float(np.sqrt((vectors * vectors).sum(1)).max()))
    monkeypatch.setattr(np, "einsum", lambda *a: scored.append(einsum(*a)) or scored[-1])
    best, score = tree.search(np.arange(200), vectors[:200], 20, 1.0)
    want = vectors[:200] @ vectors.T
    want[np.arange(200), np.arange(200)] = -np.inf
    assert best.tolist() == np.argsort(-want, 1)[:, :20].tolist() and np.allclose(score, -np.sort(-want, 1)[:, :20])
    assert sum(x.size for x in scored) < 0.2 * want.size


# ------------------------------------------------------------------ op 7

def shingles(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def linked(texts):
    sets, lead = [shingles(t) for t in texts], list(range(len(texts)))

    def root(i):
        while lead[i] != i:
            i = lead[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                lead[max(a, b)] = min(a, b)
    return sets, [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("block", [512, 3])
def test_near_duplicate_classes_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(10)
    texts = [None, "", " \t\n", "one two", "ONE two", "one  two", "a b c d e", "é É"]
    for _ in range(12):
        base = prose(rng, rng.randint(40, 160)).split()
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 7)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = "changed"
            texts.append((" " if rng.random() < 0.5 else "\n").join(copy))
    common = prose(rng, 70)
    texts += [common + " " + prose(rng, 40) for _ in range(15)]
    sets, want = linked(texts)
    got = {r.id: (r.n_shingles, r.component) for r in minhash.classes(docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == [(len(s), c) for s, c in zip(sets, want)]
    kept = minhash.deduplicated(docs(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want)) and kept.columns == [x.split()[0] for x in DOCS.split(", ")]


def test_members_of_a_large_component_do_not_meet_each_other(spark):
    rows = [(1, i, 0, 1, 0 if i < 90 else i, 100, (90, 0)) for i in range(100)] + [(2, i, 0, 1, i, 3, (1, i)) for i in range(3)]
    rest = spark.createDataFrame(rows, "posting long, id long, j int, prefix long, component long, length long, largest struct<n: long, component: long>")
    got = minhash.dealt(rest, 10).collect()
    groups = {}
    for r in got:
        groups.setdefault((r.posting, r.low, r.high), []).append(r)
    met = Counter((a.posting, *sorted((a.id, b.id))) for g in groups.values() for i, a in enumerate(g) for b in g[:i]
                  if a.component != b.component and (a.low == a.high or a.block != b.block))
    want = {(1, a, b) for a in range(100) for b in range(max(a + 1, 90), 100)} | {(2, 0, 1), (2, 0, 2), (2, 1, 2)}
    assert set(met) == want and set(met.values()) == {1}
    # each member once or, of the few others, once for each block; all pairs of blocks took ten rows each
    assert len([r for r in got if r.posting == 1]) <= 90 + 10 * 10


def test_near_duplicates_of_odd_tables(spark):
    assert minhash.classes(docs(spark, [])).count() == 0
    text = prose(random.Random(11), 50)
    got = minhash.classes(docs(spark, [text, text, text, "x"], ids=[4, 4, None, 7])).collect()
    assert Counter((r.id, r.component) for r in got) == {(4, 4): 2, (None, None): 1, (7, 7): 1}
    assert Counter(r.doc_id for r in minhash.deduplicated(docs(spark, [text, text, text, "x"], ids=[4, 4, None, 7])).collect()) == {4: 1, None: 1, 7: 1}


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}


# ------------------------------------------------------------------ op 8

def test_decontamination_finds_substituted_passages(spark):
    rng = random.Random(12)
    items = [prose(rng, n) for n in (30, 20, 12, 5)]
    tests = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(9, items[0]), (10, None), (None, items[1])], "item_id long, text string")
    swapped = items[0].split()
    swapped[4] = swapped[17] = "zzz"
    texts = [prose(rng, 50) + " " + items[0] + " " + prose(rng, 50), prose(rng, 20) + ". " + " ".join(swapped).upper(),
             items[2], items[3], prose(rng, 200), None, "", " ".join(items[1].split()[:7]) + " " + prose(rng, 30), items[1]]
    table = docs(spark, [*texts, texts[0]])
    got = {r.doc_id: r["items"] for r in decontaminate.report(table, tests).collect()}
    assert got == {0: "0", 1: "0", 2: "2", 8: "1", 9: "0"}
    kept = decontaminate.clean(table, tests)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7] and kept.columns == table.columns
    assert decontaminate.report(table, tests.limit(0)).count() == 0 and decontaminate.clean(docs(spark, []), tests).count() == 0


def test_masks_fit_beside_every_two_substitutions():
    for n in range(decontaminate.SPAN, decontaminate.WINDOW + 1):
        for i in range(n):
            for j in range(i + 1):
                assert any(not {i, j} & {at + k for k, c in enumerate(m) if c == "1"}
                           for m in decontaminate.MASKS for at in range(n - len(m) + 1)), (n, i, j)


def laid(words, item):
    """(start, n_words, n_equal) of every diagonal, without seeds."""
    n, out = min(decontaminate.WINDOW, len(item)), set()
    for g in range(-len(item), len(words)):
        equal = [0 <= g + j < len(words) and words[g + j] == w for j, w in enumerate(item)]
        most, s = max((sum(equal[s:s + n]), -s) for s in range(len(item) - n + 1))
        if 5 * most >= 4 * n:
            out.add((g - s, n, most))
    return out


def test_decontamination_matches_brute_force_without_seeds(spark):
    rng = random.Random(21)
    items = [prose(rng, n).split() for n in (11, 12, 13, 14, 30, 60, 200)]
    texts = []
    for item in items:
        for phase in range(5):  # every fifth word replaced
            texts.append(prose(rng, 9).split() + ["zzz" if i % 5 == phase else w for i, w in enumerate(item)] + prose(rng, 9).split())
        for gone in ([0], [len(item) - 1], [0, 10], [1, 5], [4, 6], [0, 1]):
            texts.append(["zzz" if i in gone else w for i, w in enumerate(item)])
        texts += [item[1:], item[:-1], item[:9], item[2:11], item[:8]]
    for n in (0, 1, 2):  # all pairs of places
        texts += [["zzz" if k in (i, j) else w for k, w in enumerate(items[n])] for i in range(11 + n) for j in range(i)]
    tests = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    table = docs(spark, [" ".join(t) for t in texts])
    got = {(r.doc_id, r.item_id, r.start, r.n_words, r.n_equal) for r in decontaminate.overlaps(table, tests).collect()}
    want = {(d, i, *x) for d, t in enumerate(texts) for i, item in enumerate(items) for x in laid(t, item)}
    assert got == want and len({d for d, *_ in want}) > 200


def test_decontamination_of_short_items(spark):
    rng = random.Random(22)
    items = [prose(rng, n).split() for n in (6, 7, 8, 9, 10, 10)]
    items.append(items[5][:6] + ["other"])
    texts = []
    for item in items[:6]:
        texts += [item, prose(rng, 8).split() + item + prose(rng, 8).split() + item, item[1:], item[:-1], [*item[:-1], "zzz"], ["zzz", *item[1:]]]
    texts += [items[6], [], ["a"]]
    tests = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(20, prose(rng, 30))], "item_id long, text string")
    table = docs(spark, [" ".join(t).upper() for t in texts])
    got = {(r.doc_id, r.item_id, r.start, r.n_words, r.n_equal) for r in decontaminate.overlaps(table, tests).collect()}
    want = {(d, i, s, len(item), len(item)) for d, t in enumerate(texts) for i, item in enumerate(items)
            for s in range(len(t) - len(item) + 1) if t[s:s + len(item)] == item}
    assert got == want and len(want) == 3 * 6 + 1
    bad = {d for d, *_ in want}
    assert {r.doc_id for r in decontaminate.clean(table, tests).collect()} == set(range(len(texts))) - bad


# ------------------------------------------------------------------ op 9

def library():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(tokens.TOKENIZER))


def test_encoding_equals_the_library():
    own, rng = tokens.Encoder(library().to_str(), 2), random.Random(13)
    alphabet = ["'", "s", "t", "re", "ve", "ll", "m", "d", " ", "  ", "\n", "1", "é", "中", "!", "\u00a0", "R", "\u0301", "٣", "\U0001F600", "<|endoftext|>", "\u0378"]
    cases = ["", "it's we're 'll 've''s  's\n's 'S", *["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(1500)]]
    raw = [c.encode() for c in cases]
    ids, lengths = own.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    at = np.cumsum([0, *lengths])
    for i, e in enumerate(library().encode_batch(cases, add_special_tokens=False)):
        assert ids[at[i]:at[i + 1]].tolist() == [*e.ids, 2], cases[i]


def test_new_pieces_reach_the_library_together(monkeypatch):
    own, rng, calls = tokens.Encoder(library().to_str(), 2), random.Random(17), []

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def encode_batch_fast(self, texts, **options):
            calls.append(len(texts))
            return self.inner.encode_batch_fast(texts, **options)

    own.library, own.model = Counted(own.library), Counted(getattr(own, "model", None))
    text = prose(rng, 3000, ["".join(rng.choice("abcdefgh\u00e9") for _ in range(6)) for _ in range(2000)])
    ids, _ = own.encode(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
    assert ids.tolist() == [*library().encode(text, add_special_tokens=False).ids, 2] and calls == [1]


def test_other_tokenizers_get_piece_by_piece():
    import json
    other = json.loads(library().to_str())
    other["model"]["dropout"] = 0.0
    other["normalizer"] = {"type": "NFC"}
    own = tokens.Encoder(json.dumps(other), 2)
    ids, _ = own.encode(np.frombuffer(b"the house's door", np.uint8), np.array([0, 16]))
    assert own.model is None and ids.tolist() == [*library().encode("the house's door", add_special_tokens=False).ids, 2]


def test_wavelet_matrix_access_count_and_occurrences():
    rng = np.random.default_rng(14)
    ids = np.minimum(rng.zipf(1.3, 5000), 50256).astype(np.uint16)
    shard = tokens.Shard(tokens.shard_bytes(ids, [1, None, 3], np.array([1000, 0, 4000]), 16))
    assert np.concatenate(list(shard.tokens())).tolist() == ids.tolist() and shard.doc_ids == [1, None, 3]
    assert [shard.access(i) for i in range(0, 5000, 37)] == ids[::37].tolist()
    for token in (1, 2, int(ids[77]), 50000, 70000):
        assert shard.count(token) == int((ids == token).sum()) and list(shard.occurrences(token)) == np.flatnonzero(ids == token).tolist()
    m = shard.segment(0)
    assert m.count(1, 100, 900) == int((ids[100:900] == 1).sum()) and m.occurrence(1, 10**6) == -1


@pytest.mark.parametrize("shard", [1 << 22, 200])
def test_token_files_round_trip(spark, monkeypatch, shard):
    monkeypatch.setattr(tokens, "SHARD", shard)
    rng = random.Random(15)
    texts = [prose(rng, rng.randint(0, 120)) for _ in range(60)] + [None, "", "same", "same"]
    ids = rng.sample(range(1000), 60) + [2000, 2001, 2002, 2002]
    got = sorted(tokens.tokenize(docs(spark, texts, ids=ids)).collect(), key=lambda r: r.start)
    at, want = 0, []
    for d, t in sorted(zip(ids, [t or "" for t in texts])):
        own = [*library().encode(t, add_special_tokens=False).ids, 2]
        want.append((d, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        at += len(own)
    assert [tuple(r) for r in got] == want
    assert tokens.tokenize(docs(spark, [])).count() == 0


# ------------------------------------------------------------------ op 10

def test_language_codes_and_edges(spark):
    rng = random.Random(16)
    stems = {"en": "the and of with house water", "fr": "les des une maison avec eau", "de": "der die und mit haus wasser", "es": "los una casa con agua para",
             "it": "gli una acqua con per anche", "nl": "het een huis water voor niet"}
    rows = [(prose(rng, 25, w.split()), n) for n, w in stems.items() for _ in range(12)]
    texts, langs = [r[0] for r in rows] + [None, "", "123 %%"], [r[1] for r in rows] + ["en", None, "fr"]
    table = docs(spark, texts, langs)
    model = langid.train(table)
    assert langid.codewords(6).shape[1] >= 15 and {len(set(map(tuple, langid.codewords(k)))) for k in (2, 3, 4, 5)} == {2, 3, 4, 5}
    got = [r.language for r in langid.predict(table, model).orderBy("doc_id").collect()]
    assert [g.lang for g in got[:len(rows)]] == [r[1] for r in rows] and all(0 <= g.score <= 1 for g in got)
    assert [(g.lang, g.score) for g in got[len(rows):]] == [("und", 0.0)] * 3
    assert langid.predict(docs(spark, []), model).count() == 0
    nothing = langid.train(docs(spark, ["a b"]))
    assert langid.predict(table, nothing).select("language.lang").distinct().first().lang == "und"
    one = langid.train(docs(spark, ["a b"], ["xx"]))
    assert {r.lang for r in langid.predict(table, one).select("language.lang").distinct().collect()} == {"xx", "und"}
