"""Conversation repair against a brute-force search over all edit lists and against a
plain dynamic program, on planted and random conversations."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from cuadra.llm import conversations as C

BLANK = " \t\n\x0b\x0c\r"
TABLE = "conv_id long, turn long, role string, text string, pos long, key string, step int, edit string, text2 string"


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        last = text.strip(BLANK)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "none" if last in ".!?" else "truncated")
        seen.add((role, text))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def cheapest(rows):
    """(cost, audit, repaired lines): least (cost, audit) over states, with whole audits compared."""
    found = faults(rows)
    best = {"": (0, "", [])}  # by the last role's initial

    def grow(states):
        for _ in range(2):
            for form, (cost, audit, lines) in list(states.items()):
                role = "assistant" if form == "u" else "user"
                new = role[0]
                made = (cost + 2, audit + "I", [*lines, f"{role}:"])
                if new not in states or made[:2] < states[new][:2]:
                    states[new] = made
        return states

    for (_, role, text), fault in zip(rows, found):
        after = {}

        def offer(form, made):
            if form not in after or made[:2] < after[form][:2]:
                after[form] = made
        for form, (cost, audit, lines) in grow(dict(best)).items():
            offer(form, (cost + 3, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            stay = cost + (fault == "truncated")
            want = "assistant" if form == "u" else "user"
            if role[:1] == want[0] or (role[:1] == "s" and form == ""):
                offer(role[:1], (stay, audit + "K", [*lines, f"{role}:{text}"]))
            offer(want[0], (stay + 2, audit + "R", [*lines, f"{want}:{text}"]))
        best = after
    ends = grow(dict(best))
    return min((ends[f] for f in ("", "a") if f in ends), key=lambda m: m[:2])


def exhaustive(rows):
    """Least (cost, audit) over every list of edits with up to two inserts in a gap."""
    found, best = faults(rows), None
    gaps = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    for filled in itertools.product(gaps, repeat=len(rows) + 1):
        for done in itertools.product("DKRr", repeat=len(rows)):
            if any(f in ("blank", "duplicate") and d != "D" for f, d in zip(found, done)):
                continue
            cost, audit, roles, lines = 0, "", "", []
            for i in range(len(rows) + 1):
                for role in filled[i]:
                    cost, audit, roles, lines = cost + 2, audit + "I", roles + role[0], [*lines, f"{role}:"]
                if i < len(rows):
                    (_, role, text), d = rows[i], done[i]
                    audit += d.upper()
                    if d == "D":
                        cost += 3
                        continue
                    cost += (found[i] == "truncated") + (2 if d in "Rr" else 0)
                    role = {"K": role, "R": "user", "r": "assistant"}[d]
                    roles, lines = roles + role[:1], [*lines, f"{role}:{text}"]
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
    return best


def expected(rows):
    rows = ordered(rows)
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    found = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = cheapest(rows)
    return (gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def frame(spark, by_conv):
    rows = [(c, t, r, x, 5, "n", 1, "K", "z") for c, rows in by_conv.items() for t, r, x in rows]
    return spark.createDataFrame(rows, TABLE)


def test_streamed_edits_equal_an_exhaustive_search():
    rng = random.Random(3)
    texts = ["a.", "b.", "c", "", "d!"]
    for _ in range(150):
        rows = [(i, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(texts)) for i in range(rng.randint(0, 3))]
        ahead, pointers = C.ENDING, C.Backpointers("file:///nowhere")
        for (_, role, _), fault in reversed(list(zip(rows, faults(rows)))):
            ahead, p = C.step(ahead, role[:1], fault)
            pointers.push(p)
        cost, audit, lines = exhaustive(rows)
        got = list(C.follow(pointers.drain()))
        assert (ahead[C.START], "".join(e for _, e, _ in got)) == (cost, audit), rows
        kept = [(new or rows[r - 1][1]) + ":" + (rows[r - 1][2] if r else "") for r, e, new in got if e != "D"]
        assert kept == lines
        assert cheapest(rows) == (cost, audit, lines)


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(7)
    roles, texts = ["system", "user", "assistant", "tool", "", " "], ["yes.", "no", "why?", "", " \n", "é!", "x\x1c", "end.\x0b", "yes."]
    by_conv = {c: [(rng.choice([None, *range(8)]), rng.choice(roles[:4] if c % 3 else roles[:3]), rng.choice(texts) + str(rng.randint(0, 3)) * (c % 2))
                   for _ in range(rng.randint(1, 9))] for c in range(300)}
    by_conv[None] = [(0, "user", "a."), (1, "assistant", "b.")]
    by_conv[1000] = [(None, "user", "u.")] * 3
    by_conv[1001] = [(2**60, "user", "x" * 100000), (-5, "system", "s.")]
    by_conv[1002] = [(i, "user" if i % 2 else "assistant", f"t{i}") for i in range(5000)]
    return by_conv


def test_report_and_repair(spark, planted):
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in C.report(frame(spark, planted)).collect()}
    assert set(got) == set(planted)
    for c, rows in planted.items():
        assert got[c] == expected(rows), (c, rows[:10])
    lines = {}
    for r in C.repair(frame(spark, planted)).orderBy("place").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for c, rows in planted.items():
        assert lines.get(c, []) == cheapest(ordered(rows))[2]


def test_spilled_backpointers(spark, planted):
    rows = C.staged(C.faults(C.keyed(frame(spark, planted), "conv_id", "turn", "role", "text")), "turns")
    order = ["key", "step"]
    assert C.edits(rows, spill=64).orderBy(*order).collect() == C.edits(rows).orderBy(*order).collect()


def test_empty_table(spark):
    assert C.report(frame(spark, {})).collect() == []
    assert C.repair(frame(spark, {})).collect() == []


def test_query_on_damaged_conversations(spark, tmp_path):
    rng = random.Random(11)
    by_conv = {c: [(t, ["user", "assistant"][t % 2], rng.choice(["Hm.", "Why? No.", "so", "!"]) + str(t) * (t % 3 == 0)) for t in range(rng.randint(1, 7))] for c in range(120)}
    by_conv[None] = [(None, None, None), (3, "user", "x.")]
    by_conv[500] = [(t, "user", None) for t in (None, 4)]
    frame(spark, by_conv).write.parquet(f"{tmp_path}/conversations.parquet")

    def damaged(conv, rows):
        out = []
        for turn, role, text in rows:
            role, text = " " if role is None else role, " " if text is None else text
            fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if fate == 0:
                continue
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            out += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
        return out

    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in C.op13_conversations(spark, str(tmp_path)).collect()}
    assert got == {c: expected(damaged(c, rows)) for c, rows in by_conv.items()}
