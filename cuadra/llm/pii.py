"""Personal data: regular expressions propose spans, checksums confirm them,
nearby context words adjust the score.  DataFrame functions only.

Base kinds, leftmost non-overlapping per kind: email, ip, card, phone.  Added
kinds: iban (mod-97), ssn and local phone numbers (by their context) and bank
routing numbers (weighted mod-10 and context).  An added span that touches a
base span goes.

Defined results: null or empty text has no spans; text of any length is
searched whole (the patterns are possessive or anchored at run starts, so they
neither backtrack over long runs nor recurse); repeated rows are judged one by
one; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


@dataclass(frozen=True)
class Kind:
    """``pattern``: the same language as the plain form, written so that it
    cannot backtrack; ``needs``: a cheap test that skips most texts; ``valid``:
    SQL over the match ``m``; ``context``: words that raise the score."""
    name: str
    pattern: str
    plain: str
    needs: str
    valid: str
    base: bool
    score: float
    context: str


DIGITS = r"regexp_replace(m, '[^0-9]', '')"
LUHN = (f"aggregate(transform(filter(split(reverse({DIGITS}), ''), c -> c <> ''), (c, i) -> if(i % 2 = 1, "
        "int(c) * 2 - if(int(c) > 4, 9, 0), int(c))), 0, (a, x) -> a + x) % 10 = 0")
#: Remainder of the rearranged number; letters count as 10 to 35.
MOD_97 = ("aggregate(filter(split(concat(substring(regexp_replace(m, ' ', ''), 5), substring(m, 1, 4)), ''), c -> c <> ''), 0, "
          "(a, c) -> if(c <= '9', a * 10, a * 100) % 97 + instr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', c) - 1) % 97 = 1")
ROUTING = ("aggregate(transform(filter(split(m, ''), c -> c <> ''), (c, i) -> int(c) * element_at(array(3, 7, 1), int(i % 3) + 1)), "
           "0, (a, x) -> a + x) % 10 = 0")
PART_255 = r"0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"

KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "@", "true", True, 0.9, "mail|contact|write|reply"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", ".",
         rf"m rlike '^{PART_255}([.]{PART_255}){{3}}$'", True, 0.8, "ip|host|server|address"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9]([\x20-]?[0-9])+", "",
         f"length({DIGITS}) between 13 and 19 and {LUHN}", True, 0.9, "card|visa|credit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", "+",
         f"length({DIGITS}) between 9 and 15", True, 0.8, "phone|call|tel|mobile"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?",
         r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?", "",
         MOD_97, False, 0.8, "iban|account|bank|konto|cuenta|compte"),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "-",
         "not (m rlike '^(000|666|9)' or substring(m, 5, 2) = '00' or substring(m, 8) = '0000')", False, 0.4,
         "ssn|social security|taxpayer"),
    Kind("routing", r"[0-9]{9}", r"[0-9]{9}", "", ROUTING, False, 0.3, "routing|aba"),
    Kind("phone_local", r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}", r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}", "",
         "true", False, 0.4, "phone|call|tel|mobile|fax"),
)

#: Added spans of a lower score go; a context word within CONTEXT code points
#: before the span, after the kind's match before it, adds BOOST.
LEAST_SCORE, BOOST, CONTEXT = 0.5, 0.3, 40
#: Matches whose lengths are summed together.
BLOCK = 256


def _proposed(kind: Kind, text: str) -> tuple[Column, Column]:
    """(matches, texts between them), empty where the text cannot hold one."""
    may = f"contains({text}, '{kind.needs}')" if kind.needs else f"{text} rlike '[0-9][ -]?[0-9]'"
    empty = "cast(array() as array<string>)"
    pattern = kind.pattern.replace("\\", "\\\\")
    return (F.expr(f"if({may}, regexp_extract_all({text}, '{pattern}', 0), {empty})"),
            F.expr(f"if({may}, split({text}, '{pattern}', -1), {empty})"))


def find(df: DataFrame, text: str = "text", out: str = "findings") -> DataFrame:
    """``df`` with ``out``: array of (kind, start, end, score, value), by kind as
    listed and start; code points, end exclusive."""
    held = "__pii_text"
    kept = df.columns
    now = df.withColumn(held, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    now = now.select("*", *[c.alias(f"__{part}_{k.name}") for k in KINDS for part, c in zip("mp", _proposed(k, held), strict=True)])
    # lengths of (text before the match + match), then their sums by blocks: a
    # start needs one block and the sums of those before it, never all lengths
    size, zero = BLOCK, "0, (a, x) -> a + x)"
    now = now.select(*[F.col(f"`{c}`") for c in kept], held, *[F.col(f"__{x}_{k.name}") for k in KINDS for x in "mp"], *[
        F.expr(f"transform(__m_{k.name}, (x, i) -> length(x) + length(__p_{k.name}[i]))").alias(f"__n_{k.name}") for k in KINDS])
    now = now.select("*", *[F.expr(f"if(size(__m_{k.name}) = 0, cast(array() as array<int>), transform(sequence(0, int((size(__m_{k.name}) - 1) / {size})), "
                                   f"b -> aggregate(slice(__n_{k.name}, b * {size} + 1, {size}), {zero}))").alias(f"__b_{k.name}") for k in KINDS])
    now = now.select(*[F.col(f"`{c}`") for c in kept], held, *[F.expr(
        f"transform(__m_{k.name}, (m, i) -> named_struct('start', aggregate(slice(__b_{k.name}, 1, int(i / {size})), {zero} + "
        f"aggregate(slice(__n_{k.name}, int(i / {size}) * {size} + 1, i % {size}), {zero} + length(__p_{k.name}[i]), 'm', m, "
        f"'near', lower(right(__p_{k.name}[i], {CONTEXT})), 'prev', right(if(i = 0 or __p_{k.name}[i] <> '', __p_{k.name}[i], __m_{k.name}[i - 1]), 1), "
        f"'next', left(if(__p_{k.name}[i + 1] <> '', __p_{k.name}[i + 1], coalesce(get(__m_{k.name}, i + 1), '')), 1)))"
    ).alias(f"__s_{k.name}") for k in KINDS])
    judged = []
    for k in KINDS:
        score = f"least(1.0D, {k.score}D + if(x.near rlike '{k.context}', {BOOST}D, 0.0D))"
        valid = k.valid.replace("m,", "x.m,").replace("m rlike", "x.m rlike")
        if not k.base:
            valid += " and not x.prev rlike '[A-Za-z0-9+]' and not x.next rlike '[A-Za-z0-9]'"
        ok = f"filter(__s_{k.name}, x -> {valid})"
        row = (f"transform({ok}, x -> named_struct('kind', '{k.name}', 'start', x.start, 'end', x.start + length(x.m), "
               f"'score', {score}, 'value', x.m))")
        if not k.base:
            row = f"filter({row}, x -> x.score >= {LEAST_SCORE}D)"
        judged.append(F.expr(row).alias(f"__f_{k.name}"))
    now = now.select(*[F.col(f"`{c}`") for c in kept], *judged)
    base = ", ".join(f"__f_{k.name}" for k in KINDS if k.base)
    now = now.withColumn("__base", F.expr(f"concat({base})"))
    added = ", ".join(f"filter(__f_{k.name}, x -> not exists(__base, b -> b.start < x.`end` and x.start < b.`end`))" for k in KINDS if not k.base)
    return now.select(*[F.col(f"`{c}`") for c in kept], F.expr(f"concat(__base, {added})").alias(out))


def redact(df: DataFrame, text: str = "text", findings: str = "findings", out: str = "redacted") -> DataFrame:
    """``df`` with ``out``: the text with every found span replaced by <KIND>;
    of overlapping spans the one that starts first (the longer on a tie) stands."""
    ordered = (f"array_sort({findings}, (l, r) -> if(l.start <> r.start, l.start - r.start, r.`end` - l.`end`))")
    step = (f"(a, x) -> if(x.start < a.at, a, named_struct('at', x.`end`, 'out', concat(a.out, substring({text}, a.at + 1, x.start - a.at), "
            "'<', upper(x.kind), '>')))")
    return df.withColumn(out, F.expr(f"aggregate({ordered}, named_struct('at', 0, 'out', ''), {step}, a -> concat(a.out, substring({text}, a.at + 1)))"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs).select("doc_id", "findings")
    line = lambda rows: f"array_join(transform({rows}, x -> concat_ws(':', x.kind, x.start, x.`end`)), ',')"
    names = ", ".join(f"'{k.name}'" for k in KINDS if k.base)
    return found.select(
        "doc_id", *[F.expr(f"cast(size(filter(findings, x -> x.kind = '{k.name}')) as bigint)").alias(f"n_{k.name}") for k in KINDS if k.base],
        F.expr(f"sha2({line(f'filter(findings, x -> x.kind in ({names}))')}, 256)").alias("base_sha256"),
        F.expr(line("findings")).alias("spans"))


def oracle() -> str:
    """The same rows in DuckDB, with the plain patterns."""
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    chars = lambda s: f"list_filter(string_split({s}, ''), lambda c: c <> '')"
    luhn = (f"list_sum(list_transform({chars(f'reverse({digits})')}, lambda c, i: CASE WHEN i % 2 = 0 THEN "
            "c::INT * 2 - CASE WHEN c::INT > 4 THEN 9 ELSE 0 END ELSE c::INT END)) % 10 = 0")
    iban = "replace(m, ' ', '')"
    mod_97 = ("list_reduce(list_prepend(0, list_transform(" + chars(f"{iban}[5:] || m[1:4]") +
              ", lambda c: instr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', c)::INT - 1)), "
              "lambda a, c: (CASE WHEN c < 10 THEN a * 10 ELSE a * 100 END) % 97 + c) % 97 = 1")
    routing = f"list_sum(list_transform({chars('m')}, lambda c, i: c::INT * ([3, 7, 1])[(i - 1) % 3 + 1])) % 10 = 0"
    part = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
    valid = {
        "email": "true", "ip": f"regexp_matches(m, '^{part}([.]{part}){{3}}$')",
        "card": f"length({digits}) BETWEEN 13 AND 19 AND {luhn}", "phone": f"length({digits}) BETWEEN 9 AND 15",
        "iban": mod_97, "ssn": "NOT (regexp_matches(m, '^(000|666|9)') OR m[5:6] = '00' OR m[8:] = '0000')",
        "routing": routing, "phone_local": "true"}
    parts = []
    for i, k in enumerate(KINDS):
        pattern = k.plain.replace("(?:", "(")
        more = "true" if k.base else (
            f"{k.score} + CASE WHEN regexp_matches(lower(right(p, {CONTEXT})), '{k.context}') THEN {BOOST} ELSE 0 END >= {LEAST_SCORE} "
            "AND NOT regexp_matches(right(CASE WHEN p <> '' THEN p ELSE coalesce(m0, '') END, 1), '[A-Za-z0-9+]') "
            "AND NOT regexp_matches(left(CASE WHEN p1 <> '' THEN p1 ELSE coalesce(m1, '') END, 1), '[A-Za-z0-9]')")
        parts.append(f"""s{i} AS (
  SELECT doc_id, {i} AS k, '{k.name}' AS kind, st, m FROM (
    SELECT doc_id, unnest(ms) AS m, unnest(ps[1:len(ms)]) AS p, unnest(ps[2:len(ms) + 1]) AS p1, unnest(list_prepend(NULL, ms[1:len(ms) - 1])) AS m0,
      unnest(list_append(ms[2:], NULL)) AS m1, unnest(list_transform(ms, lambda x, i: list_sum(list_transform(ps[1:i], lambda y: length(y)))
      + coalesce(list_sum(list_transform(ms[1:i - 1], lambda y: length(y))), 0)))::BIGINT AS st
    FROM (SELECT doc_id, t, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS ps FROM d) WHERE len(ms) > 0)
  WHERE ({valid[k.name]}) AND ({more}))""")
    base = [i for i, k in enumerate(KINDS) if k.base]
    rows = " UNION ALL ".join(f"SELECT doc_id, k, kind, st, st + length(m) AS en FROM s{i}" for i in range(len(KINDS)))
    counts = ", ".join(f"count(*) FILTER (kind = '{k.name}') AS n_{k.name}" for k in KINDS if k.base)
    line = "coalesce(string_agg(kind || ':' || st || ':' || en, ',' ORDER BY k, st){}, '')"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), {', '.join(parts)},
a AS ({rows}),
f AS (SELECT * FROM a WHERE k <= {max(base)} OR NOT EXISTS (SELECT 1 FROM a b WHERE b.doc_id = a.doc_id AND b.k <= {max(base)} AND b.st < a.en AND a.st < b.en)),
g AS (SELECT doc_id, {counts}, {line.format(f' FILTER (k <= {max(base)})')} AS bs, {line.format('')} AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, {', '.join(f'coalesce(n_{k.name}, 0)::BIGINT AS n_{k.name}' for k in KINDS if k.base)},
  sha256(coalesce(bs, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON d.doc_id = g.doc_id"""
