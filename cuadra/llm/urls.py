"""URL filter: rules by host and path, then a weighted vocabulary.

The vocabulary is searched with an Aho-Corasick automaton in the whole url, query
string and fragment too; a hit counts if no ASCII letter or digit stands next to
it.  One strict term, or
soft terms whose weights reach the limit (each term once), reject the page.

Defined results: a null url or one without ``://`` has empty host and path and
fits no rule, so its terms alone decide; urls of any length are read whole; repeated rows are
judged one by one; other columns pass through, a column named like the output
is replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: (verdict, host, path): fits the host and its subdomains if the page's path
#: starts with the rule's; the longest rule wins.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: term: weight.  A strict term reaches LIMIT alone.
STRICT = {t: 1.0 for t in ("adult", "casino", "escort", "porn", "spam", "viagra", "warez", "xxx")}
SOFT = {"ads": 0.5, "bet": 0.5, "bets": 0.5, "bonus": 0.5, "cheap": 0.5, "click": 0.5, "deals": 0.5, "free": 0.5, "loans": 0.5,
        "pills": 0.5, "poker": 0.5, "slots": 0.5, "track": 0.5, "win": 0.5}
LIMIT = 1.0

ASCII_LOWER = {i: i + 32 for i in range(65, 91)}
OUT = "host string, path string, rule string, verdict string, n_strict long, n_soft long, weight double"


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): host from the first ``://`` up to ``/``, ``?``, ``#`` or the
    end, path from there up to ``?``, ``#`` or the end."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    rest = rest.partition("?")[0].partition("#")[0]
    host, slash, path = rest.partition("/")
    return host.translate(ASCII_LOWER), slash + path


def judge(df: DataFrame, url: str = "url", out: str = "judged", rules: Iterable[tuple[str, str, str]] = RULES,
          strict: dict[str, float] = STRICT, soft: dict[str, float] = SOFT, limit: float = LIMIT) -> DataFrame:
    """``df`` with ``out``, a struct of OUT."""
    by_host: dict[str, list[tuple[int, str, str, str]]] = {}
    for verdict, host, path in rules:
        by_host.setdefault(host, []).append((len(host) + len(path), path, host + path, verdict))
    terms = [(t, w, True) for t, w in strict.items()] + [(t, w, False) for t, w in soft.items()]

    def verdicts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = ahocorasick.Automaton()
        for term, weight, hard in terms:
            automaton.add_word(term, (term, weight, hard))
        automaton.make_automaton()

        def one(raw: str | None) -> tuple:
            host, path = split_url(raw)
            found, at = [], host
            while at:
                found += [r for r in by_host.get(at, ()) if path.startswith(r[1])]
                at = at.partition(".")[2]
            best = max(found, default=None)
            text, hits = (raw or "").translate(ASCII_LOWER), {}
            for end, (term, weight, hard) in automaton.iter(text):
                begin = end + 1 - len(term)
                before, after = text[begin - 1:begin] if begin else "", text[end + 1:end + 2]
                if not (before.isascii() and before.isalnum() or after.isascii() and after.isalnum()):
                    hits[term] = (weight, hard)
            n_strict = sum(hard for _, hard in hits.values())
            weight = float(sum(w for w, _ in hits.values()))
            own = "block" if n_strict or weight >= limit else "allow"
            return host, path, best and best[2], best[3] if best else own, n_strict, len(hits) - n_strict, weight

        for urls in batches:
            yield pd.DataFrame([one(None if pd.isna(u) else u) for u in urls], columns=[x.split()[0] for x in OUT.split(", ")])

    return df.withColumn(out, F.pandas_udf(verdicts, OUT)(F.col(f"`{url}`").cast("string")))


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict", "judged.n_strict", "judged.n_soft")


def oracle() -> str:
    """The same rows in DuckDB, but for terms outside host and path, which it does not search."""
    fits = [(h + p, v, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')") for v, h, p in RULES]
    fits.sort(key=lambda r: -len(r[0]))
    case = lambda k: " ".join(f"WHEN {r[2]} THEN '{r[k]}'" for r in fits)
    hit = lambda t: f"regexp_matches(translate(host || path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::BIGINT"
    return f"""WITH u AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN regexp_extract(substring(url, instr(url, '://') + 3), '^[^?#]*', 0) ELSE '' END AS r FROM pages),
h AS (SELECT page_id, translate(regexp_extract(r, '^[^/]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  substring(r, length(regexp_extract(r, '^[^/]*', 0)) + 1) AS path FROM u),
n AS (SELECT *, {' + '.join(hit(t) for t in STRICT)} AS n_strict, {' + '.join(hit(t) for t in SOFT)} AS n_soft,
  {' + '.join(f'{w} * {hit(t)}' for t, w in (STRICT | SOFT).items())} AS weight FROM h)
SELECT page_id, host, path, CASE {case(0)} END AS rule,
  CASE {case(1)} WHEN n_strict > 0 OR weight >= {LIMIT} THEN 'block' ELSE 'allow' END AS verdict, n_strict, n_soft FROM n"""
