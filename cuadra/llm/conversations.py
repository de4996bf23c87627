"""Conversations whose turns are missing, blank, repeated, cut off or out of order
are repaired by the cheapest list of edits.

The roles' initials of a repaired conversation have the form ``(s?(ua)+)?``: an
optional system turn, then user and assistant in turns, or nothing at all.  Edits:
Keep (0), Rerole to user or assistant (2), Delete (3, the only choice for a blank or
repeated row), Insert an empty user or assistant turn (2); a truncated row that stays
costs 1 more.  Of the cheapest lists the one whose initials are ASCII-least counts.

Conversations are dealt by id and sorted by falling turn.  ``mapInPandas`` reads a
task's rows once and carries, across Arrow batches, the least cost from the current
row to the conversation's end for each of the four states that the form can be in
(nothing yet, after system, after user, after assistant).  The best edit in each state
is two bits, so a row leaves two bytes (one bit says that it is a system turn); those of a
giant conversation are spilled to the shared folder in chunks.  At the conversation's
first row they are followed from
the start state, which gives the edits in order: the edits so far decide the state, so
the greedy choice of the least initial at each step is the least list.

A conversation is read by one task, as its states follow from each other; that task
holds one batch, four costs and at most SPILL bytes.

Defined results: a null conversation id is an id of its own; null turns come first;
rows of equal turn are ordered by role and text (nulls as one space); a role's initial is
its first character, an empty role has none and can't be kept; a conversation without
rows has no edits; repeated rows beyond the first are faults; an empty table gives no
rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_dir, staged, table

#: Costs of the edits, and the initials that may stand side by side.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
PAIRS = ("su", "ua", "au")
#: Bytes of back-pointers that a task keeps before it spills them.
SPILL = 1 << 22

# White space, and the characters that end a sentence.
SPACES = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")

# states: nothing yet, after system, after user, after assistant
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: State after an element that is not a kept system turn, and that element's role.
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
ROLE = ("user", "user", "assistant", "user")
#: Cost from each state to the end of the conversation when no row is left.
ENDING = (0, 2 * INSERT, INSERT, 0)
#: Letters of the edits in ASCII order; a back-pointer is a place in this string.
EDITS = "DIKR"


def step(ahead: tuple[int, ...], initial: str, fault: str) -> tuple[tuple[int, ...], int]:
    """(costs to the end from each state before a row, its back-pointers), given the
    costs after the row."""
    gone = fault in ("blank", "duplicate")
    stay = TRUNCATED if fault == "truncated" else 0
    costs, edits = [0] * 4, [0] * 4
    for state in range(4):
        best = (ahead[state] + DELETE, 0)
        if not gone:
            onward = NEXT[state]
            if initial == ROLE[state][0]:
                best = min(best, (ahead[onward] + stay, 2))
            elif initial == "s" and state == START:
                best = min(best, (ahead[AFTER_S] + stay, 2))
            best = min(best, (ahead[onward] + stay + REROLE, 3))
        costs[state], edits[state] = best
    # an inserted turn leads to another state before the same row; two in a row never gain more
    for _ in range(2):
        before = list(costs)
        for state in range(4):
            best = min((costs[state], edits[state]), (before[NEXT[state]] + INSERT, 1))
            costs[state], edits[state] = best
    return tuple(costs), edits[0] | edits[1] << 2 | edits[2] << 4 | edits[3] << 6 | (initial == "s") << 8


class Backpointers:
    """Two bytes per row, pushed from the last row to the first and read back from the
    first to the last; beyond ``limit`` bytes chunks go to files in the shared folder."""

    def __init__(self, folder: str, limit: int = SPILL):
        self.folder, self.limit, self.held, self.files = folder, limit, array("H"), []

    def _store(self):
        import pyarrow.fs
        return pyarrow.fs.FileSystem.from_uri(self.folder)

    def push(self, pointer: int) -> None:
        self.held.append(pointer)
        if 2 * len(self.held) >= self.limit:
            store, root = self._store()
            store.create_dir(root, recursive=True)
            path = f"{root}/{uuid.uuid4().hex}"
            with store.open_output_stream(path) as f:
                f.write(self.held.tobytes())
            self.files.append(path)
            self.held = array("H")

    def drain(self) -> Iterator[int]:
        """All pointers, last pushed first; spilled files are removed once read."""
        yield from reversed(self.held)
        self.held = array("H")
        while self.files:
            store, _ = self._store()
            path = self.files.pop()
            with store.open_input_stream(path) as f:
                chunk = array("H", f.read())
            store.delete_file(path)
            yield from reversed(chunk)


def follow(pointers: Iterator[int]) -> Iterator[tuple[int, str, str | None]]:
    """(row from 1, 0 for an inserted turn; edit; new role of a reroled or inserted turn)
    of every edit in order."""
    state, row = START, 0
    for pointer in pointers:
        row += 1
        while True:
            edit = EDITS[pointer >> 2 * state & 3]
            role = ROLE[state] if edit in "IR" else None
            yield (0 if edit == "I" else row), edit, role
            if edit == "K" and state == START and pointer >> 8:
                state = AFTER_S
            elif edit != "D":
                state = NEXT[state]
            if edit != "I":
                break
    while ENDING[state]:
        yield 0, "I", ROLE[state]
        state = NEXT[state]


def keyed(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The columns that count, under names of their own: key (conversation), turn, role, text."""
    name = F.when(F.col(f"`{conv}`").isNull(), "n").otherwise(F.concat(F.lit("v"), F.col(f"`{conv}`").cast("string")))
    return df.select(name.alias("key"), F.col(f"`{turn}`").alias("turn"), *[
        F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")).alias(out) for c, out in ((role, "role"), (text, "text"))])


def conversation_of(kind: str) -> Column:
    """The conversation's id, from its key."""
    return F.when(F.col("key") != "n", F.expr("substring(key, 2)").cast(kind))


def faults(rows: DataFrame) -> DataFrame:
    """``keyed`` rows numbered within their conversation (pos, from 1), with initial,
    fault (blank, duplicate, truncated or none: the first that holds) and illegal (whether
    the pair with the row before may not stand)."""
    order = Window.partitionBy("key").orderBy(F.asc_nulls_first("turn"), "role", "text")
    same = Window.partitionBy("key", "role", "digest").orderBy("pos")
    numbered = (rows.repartition("key").withColumn("initial", F.substring("role", 1, 1)).withColumn("digest", F.sha2("text", 256))
                .withColumn("pos", F.row_number().over(order)).withColumn("before", F.lag("initial").over(order))
                .withColumn("seen", F.row_number().over(same) > 1))
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACES)), -1, 1)
    fault = (F.when(last == "", "blank").when(F.col("seen"), "duplicate").when(~last.isin(*ENDS), "truncated").otherwise("none"))
    illegal = F.coalesce(~F.concat("before", "initial").isin(*PAIRS), F.lit(False))
    return numbered.select("key", F.col("pos").cast("long").alias("pos"), "turn", "role", "text", "initial", fault.alias("fault"), illegal.alias("illegal"))


EDIT_ROWS = "key string, step long, pos long, edit string, new_role string"


def edits(numbered: DataFrame, spill: int = SPILL) -> DataFrame:
    """Each conversation's cheapest edits in order (EDIT_ROWS; pos is null for an inserted
    turn, new_role is null for a turn that goes or keeps its role)."""
    folder = f"{shared_dir(numbered.sparkSession)}/turns-{uuid.uuid4().hex}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ahead, pointers, out = ENDING, Backpointers(folder, spill), []
        for batch in batches:
            for key, pos, initial, fault in zip(batch["key"], batch["pos"], batch["initial"], batch["fault"], strict=True):
                ahead, pointer = step(ahead, initial, fault)
                pointers.push(pointer)
                if pos > 1:
                    continue
                for at, (row, edit, role) in enumerate(follow(pointers.drain())):
                    out.append((key, at, row or None, edit, role))
                    if len(out) == 8192:
                        yield frame(out)
                        out = []
                ahead, pointers = ENDING, Backpointers(folder, spill)
        if out:
            yield frame(out)

    def frame(rows: list) -> pd.DataFrame:
        made = pd.DataFrame(rows, columns=["key", "step", "pos", "edit", "new_role"])
        return made.astype({"pos": "Int64"})

    narrow = numbered.select("key", "pos", "initial", "fault")
    return narrow.repartition("key").sortWithinPartitions("key", F.desc("pos")).mapInPandas(run, EDIT_ROWS)


def edited(numbered: DataFrame, listed: DataFrame) -> DataFrame:
    """Every edit with its row: key, step, edit, turn, fault, role and text after the edit
    (those of a deleted row are its old ones)."""
    old = numbered.select(F.col("key").alias("own"), F.col("pos").alias("at"), "turn", "fault", "role", "text")
    rows = listed.join(old, (F.col("key") == F.col("own")) & (F.col("pos") == F.col("at")), "left")
    return rows.select("key", "step", "edit", "turn", "fault", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired conversations: conversation id, place (from 1), edit (K, R or I), turn
    (null for an inserted one), role, text."""
    kind = df.schema[conv].dataType.simpleString()
    numbered = staged(faults(keyed(df, conv, turn, role, text)), "turns")
    kept = edited(numbered, staged(edits(numbered), "edits")).where(F.col("edit") != "D")
    place = F.row_number().over(Window.partitionBy("key").orderBy("step"))
    return kept.select(conversation_of(kind).alias(conv), place.alias("place"), "edit", "turn", "role", "text")


DIGEST = "key string, cost long, audit string, repaired_sha256 string"


def digest(rows: DataFrame) -> DataFrame:
    """(key, cost, audit, repaired_sha256) of ``edited`` rows: streamed in order, so a long
    conversation's text is hashed turn by turn."""
    price = {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, cost, audit, sha, first = None, 0, [], hashlib.sha256(), True
        for batch in batches:
            done = []
            for key, edit, fault, role, text in zip(batch["key"], batch["edit"], batch["fault"], batch["role"], batch["text"], strict=True):
                if key != now:
                    if now is not None:
                        done.append((now, cost, "".join(audit), sha.hexdigest()))
                    now, cost, audit, sha, first = key, 0, [], hashlib.sha256(), True
                cost += price[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
                audit.append(edit)
                if edit != "D":
                    sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
            yield pd.DataFrame(done, columns=["key", "cost", "audit", "repaired_sha256"])
        if now is not None:
            yield pd.DataFrame([(now, cost, "".join(audit), sha.hexdigest())], columns=["key", "cost", "audit", "repaired_sha256"])

    return rows.repartition("key").sortWithinPartitions("key", "step").mapInPandas(run, DIGEST)


def report(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: its faults, the cheapest cost, the edits and a hash of the
    repaired text."""
    kind = df.schema[conv].dataType.simpleString()
    numbered = staged(faults(keyed(df, conv, turn, role, text)), "turns")
    count = lambda condition: F.count(F.when(condition, 1))
    gaps = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    counted = numbered.groupBy("key").agg(
        F.coalesce(gaps.cast("long"), F.lit(0)).alias("gaps"),
        *[count(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")], count(F.col("illegal")).alias("illegal"))
    repaired = digest(edited(numbered, staged(edits(numbered), "edits")))
    return counted.join(repaired, "key").select(conversation_of(kind).alias(conv), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with planted faults, by crc32 of ``conv_id:turn``: dropped, emptied,
    unended, repeated and reroled rows."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = df.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), fate.alias("fate")).where("fate <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "conversations")
    found = report(damaged(source))
    ids = source.select("conv_id").distinct().withColumnRenamed("conv_id", "own")
    rows = ids.join(found, F.col("own").eqNullSafe(F.col("conv_id")), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return rows.select(F.col("own").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
