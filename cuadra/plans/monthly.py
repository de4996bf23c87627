"""The monthly jobs, composed from the operators.

Each job reads the month's raw extracts, checks them, maps them onto the
governed table, checks the table rules and writes only when no ERROR rule
failed.  The batch is staged once and its row rules, foreign keys and counts are
observed while it is written (``operators.observed``); the raw files are read by that one
pass.  Every job keeps its rule results and violating rows in the warehouse's
``quality`` log, and the account jobs append what they changed to a history.  The values
brought to the driver are counts, one a rule.

Differences to the reference's per-bank loop: a job reads every bank of the
month (or of all months of a range) in one distributed scan, checks all of them, and
writes all or none of a month.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cuadra.functions.expressions import period_str, shift_period_str
from cuadra.operators import analytics as A
from cuadra.operators import mapping as M
from cuadra.operators import observed as OB
from cuadra.operators import quality as Q
from cuadra.operators.joins import dealt, key_side
from cuadra.plans import raws as RW
from cuadra.plans import tables as TB
from cuadra.plans.measures import DERIVED, MEASURES
from cuadra.sinks import tables as SK
from cuadra.sources import text as TX
from cuadra.specs import RawSpec, Rule, Severity, TableSpec

AGG_RULES = (
    Rule("sum_act", "sum(eerr_Monto_Act) > 0", level="aggregate", error_code=1),
    Rule("sum_ant", "sum(eerr_Monto_Ant) > 0", level="aggregate", error_code=2),
)
# Rows expected in the two-month comparison.
COMPARE_ROWS = (100, 100000)
PERIOD = A.PERIOD

#: A raw folder, or its listing shared by several jobs.
Root = str | TX.Landing


@dataclasses.dataclass
class JobResult:
    name: str
    period: str
    ok: bool
    summary: DataFrame            # rule results (small)
    written: DataFrame | None     # table as re-read after the write, None if not written
    details: DataFrame | None = None    # violating rows: rule_id and key columns
    rejects: DataFrame | None = None    # lines set aside, if there are any


@dataclasses.dataclass(frozen=True)
class Warehouse:
    """Where governed tables live (one folder per table).

    ``specs``: tables declared otherwise than in ``tables`` in this warehouse, by name."""

    root: str
    specs: Mapping[str, TableSpec] = dataclasses.field(default_factory=dict)

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def spec(self, table: TableSpec) -> TableSpec:
        return self.specs.get(table.name, table)


def landing(spark: SparkSession, root: Root) -> TX.Landing:
    return root if isinstance(root, TX.Landing) else TX.Landing(spark, root)


def _interval_rule(n: int, bounds, rule_id: str) -> tuple:
    """Row count within [lo, hi], as a summary row of a count known on the driver."""
    lo, hi = (bounds.min_rows, bounds.max_rows) if isinstance(bounds, RawSpec) else bounds
    ok = (lo is None or n >= lo) and (hi is None or n <= hi)
    return (rule_id, "row_count", None, 0, None, Severity.ERROR.value, n, 0 if ok else 1, ok)


def _rejected_rule(found: Mapping, raw: RawSpec) -> tuple:
    """Lines that could not be taken: more than the extract allows stop the load."""
    n, bad = found["n_lines"], found["n_rejected"]
    return ("rejected_lines", "raw", None, 0, None, Severity.ERROR.value, n, bad, bad <= raw.max_rejected)


def _params(period: str, **more) -> dict[str, str]:
    return {"YYYY": period[:4], "MM": period[5:7], **more}


@dataclasses.dataclass
class _Read:
    """Rows of a raw extract, and what was observed of them once they were computed."""

    rows: DataFrame
    scan: TX.Scan
    lines: Observation
    counts: Observation

    def rules(self, raw: RawSpec) -> list[tuple]:
        return [_rejected_rule(self.lines.get, raw), _interval_rule(self.counts.get["n"], raw, "rows_in_file")]

    def rejects(self) -> DataFrame | None:
        return self.scan.rejects if self.lines.get["n_rejected"] else None


def _read(spark: SparkSession, root: Root, raw: RawSpec, period: str | None, params: Mapping[str, str],
          metrics: Mapping | None = None, shape=None) -> _Read:
    name = uuid.uuid4().hex[:8]
    lines, counts = Observation(f"lines-{name}"), Observation(f"rows-{name}")
    scan = TX.scan_raw(landing(spark, root), raw, params, None if period is None else F.lit(period), shape, observation=lines)
    rows = scan.data.observe(counts, F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in (metrics or {}).items()])
    return _Read(rows, scan, lines, counts)


def _cap_rule(batch: DataFrame, current: DataFrame, spec: TableSpec) -> list[DataFrame]:
    """The cap on new records, where the table declares one and is not empty."""
    if spec.max_new_records_num is None and spec.max_new_records_share is None:
        return []
    if current.isEmpty():
        return []
    return [Q.new_record_check(batch, current, spec.pk, spec.max_new_records_num, spec.max_new_records_share)]


def _finish(spark: SparkSession, name: str, period: str, wh: Warehouse, spec: TableSpec, summary: DataFrame, details: DataFrame,
            rejects: DataFrame | None, write: Callable[[], DataFrame], run_id: str | None = None) -> JobResult:
    """Keep the results in the quality log, then write if no ERROR rule failed."""
    summary, _ = OB.staged(summary, f"summary-{name}")
    run_id = run_id or f"{name}:{period}:{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:6]}"
    SK.append_quality(summary, details, wh.path("quality"), spec.name, run_id)
    ok = bool(Q.gate(summary).first()["ok"])
    return JobResult(name, period, ok, summary, write() if ok else None, details, rejects)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _save_dimension(spark: SparkSession, spec: TableSpec, path: str, before: DataFrame, after: DataFrame,
                    changed_at: str, changed_by: str) -> DataFrame:
    """Write a new version, and what it changed to the table's history.  A table without
    ``backup`` keeps the version that a reader may still hold, but none before it."""
    SK.save_version(after, spec, path)
    if not spec.backup:
        SK.drop_versions(path, keep=2)
    saved = SK.read_table(spark, spec, path)
    SK.append_history(before, saved, spec, f"{path}_history", changed_at, changed_by)
    return saved


# ------------------------------------------------------------------ H1, H2

def institution(spark: SparkSession, raw_root: Root, wh: Warehouse, year: int, month: int,
                raw: RawSpec = RW.CODIFIS, spec: TableSpec | None = None, run_id: str | None = None) -> JobResult:
    """Institution dimension: upsert the month's institution list."""
    spec, period = spec or wh.spec(TB.INSTITUTION), period_str(year, month)
    read = _read(spark, raw_root, raw, period, _params(period), shape="default")
    res = OB.check_and_stage(M.map_columns(read.rows, spec, {"ins_id": "institucion_id", "ins_nombre": "institucion_nombre"}), spec)
    path = wh.path("institution")
    current = SK.read_table(spark, spec, path)
    summary = _union([res.summary, OB.rule_rows(spark, read.rules(raw)), *_cap_rule(res.marked, current, spec)])

    def write():
        merged = SK.upsert_full(current, res.kept, spec, spec.names, f"{period} 00:00:00", "institution")
        return _save_dimension(spark, spec, path, current, merged, f"{period} 00:00:00", "institution")
    return _finish(spark, "institution", period, wh, spec, summary, res.details, read.rejects(), write, run_id)


def institution_month(spark: SparkSession, raw_root: Root, wh: Warehouse, year: int, month: int,
                      raw: RawSpec = RW.CODIFIS, run_id: str | None = None) -> JobResult:
    """Institutions of the month: partition replace, FK to the dimension."""
    spec, period = wh.spec(TB.INSTITUTION_MONTH), period_str(year, month)
    read = _read(spark, raw_root, raw, period, _params(period), shape="default")
    batch = M.map_columns(read.rows, spec, {"periodo_mes": F.lit(period), "ins_id": "institucion_id", "ins_nombre": "institucion_nombre"})
    res = OB.check_and_stage(batch, spec, {"institution": SK.read_table(spark, TB.INSTITUTION, wh.path("institution"))})
    summary = _union([res.summary, OB.rule_rows(spark, read.rules(raw))])
    return _finish(spark, "institution_month", period, wh, spec, summary, res.details, read.rejects(),
                   lambda: SK.partition_replace(res.kept, spec, wh.path("institution_month")), run_id)


# ------------------------------------------------------------------ H3, H4, H5

def _chart(spark: SparkSession, root: Root, period: str, raw: RawSpec) -> _Read:
    bounds = {f"{f}_{c}": getattr(F, f)(c) for c in ("ano", "mes") for f in ("min", "max")}
    return _read(spark, root, raw, period, _params(period), bounds)


def _chart_period_rule(read: _Read, period: str) -> tuple:
    """Year and month of every row are those of the file: least and greatest agree."""
    seen, want = read.counts.get, {"ano": int(period[:4]), "mes": int(period[5:7])}
    ok = all(seen[f"{f}_{c}"] == v for c, v in want.items() for f in ("min", "max"))
    return ("file_period", "period", "ano,mes", 0, None, Severity.ERROR.value, 1, 0 if ok else 1, ok)


def account(spark: SparkSession, raw_root: Root, wh: Warehouse, year: int, month: int,
            raw: RawSpec = RW.PLAN_CTAS, changed_by: str = "account", spec: TableSpec = TB.ACCOUNT,
            run_id: str | None = None) -> JobResult:
    """Account dimension: upsert id and name from the month's chart."""
    period = period_str(year, month)
    read = _chart(spark, raw_root, period, raw)
    batch = M.map_columns(read.rows, spec, {"planCuenta_id": "planCuenta_id", "planCuenta_Nombre": "planCuenta_Nombre"})
    # product and business line stay null here; the enrichment job checks them
    res = OB.check_and_stage(batch, spec, skip_refs=("negocio", "producto"))
    path = wh.path("account")
    current = SK.read_table(spark, spec, path)
    summary = _union([res.summary, OB.rule_rows(spark, [*read.rules(raw), _chart_period_rule(read, period)]),
                      *_cap_rule(res.marked, current, spec)])

    def write():
        merged = SK.upsert_full(current, res.kept, spec, ["planCuenta_id", "planCuenta_Nombre"], f"{period} 00:00:00", changed_by)
        return _save_dimension(spark, spec, path, current, merged, f"{period} 00:00:00", changed_by)
    return _finish(spark, "account", period, wh, spec, summary, res.details, read.rejects(), write, run_id)


def account_month(spark: SparkSession, raw_root: Root, wh: Warehouse, year: int, month: int,
                  raw: RawSpec = RW.PLAN_CTAS, run_id: str | None = None) -> JobResult:
    """Accounts of the month: distinct chart rows, auto-mapped (ano and mes
    are dropped), FK to the account dimension, partition replace."""
    spec, period = TB.ACCOUNT_MONTH, period_str(year, month)
    read = _chart(spark, raw_root, period, raw)
    snap = read.rows.select(F.make_date("ano", "mes", F.lit(1)).cast("string").alias("periodo_mes"), "ano", "mes",
                            "planCuenta_id", "planCuenta_Nombre").distinct()
    res = OB.check_and_stage(M.auto_map(snap, spec), spec, {"account": SK.read_table(spark, TB.ACCOUNT, wh.path("account"))})
    summary = _union([res.summary, OB.rule_rows(spark, [*read.rules(raw), _chart_period_rule(read, period)])])
    return _finish(spark, "account_month", period, wh, spec, summary, res.details, read.rejects(),
                   lambda: SK.partition_replace(res.kept, spec, wh.path("account_month")), run_id)


def account_enrichment(spark: SparkSession, raw_root: Root, wh: Warehouse, lot: str,
                       masters: dict[str, DataFrame], raw: RawSpec = RW.ASIGNA,
                       changed_by: str = "account_enrichment", changed_at: str | None = None,
                       run_id: str | None = None) -> JobResult:
    """Assign product, business line and concept to existing accounts
    (selective update).  Business lines missing from their master are
    excluded with a warning; unknown products and repeated assignments stop the
    job.  ``lot``: the file's number, '*' for every file.  ``changed_at``: time of the
    change, the run's own by default."""
    spec, path = TB.ACCOUNT, wh.path("account")
    changed_at = changed_at or f"{datetime.now(timezone.utc):%Y-%m-%d %H:%M:%S}"
    read = _read(spark, raw_root, raw, RW.REF_START, {"NUM": lot})
    assigned = ["producto_id", "negocio_id", "planCuenta_Concepto"]
    empty = lambda c: F.nullif(c, F.lit(""))
    src, _ = OB.staged(read.rows.select("planCuenta_id", empty("producto_id").alias("producto_id"), empty("negocio_id").alias("negocio_id"),
                                        empty("concepto").alias("planCuenta_Concepto")), "assignment")
    source_key = Q.pk_check(src, spec.pk, rule_id="assignment_pk")
    known = [OB.rule_rows(spark, read.rules(raw)), source_key]
    if not Q.gate(source_key).first()["ok"]:
        repeated = Q.repeated_rows(src, spec.pk).select(F.lit("assignment_pk").alias("rule_id"), *spec.pk)
        return _finish(spark, "account_enrichment", RW.REF_START, wh, spec, _union(known), repeated, read.rejects(), lambda: None, run_id)
    current = SK.read_table(spark, spec, path)
    updated, unmatched = SK.selective_update(current, src, spec, assigned, changed_at, changed_by)
    unknown = Q.summary_rows(unmatched.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.lit(1)).alias("n_bad")),
                             "unmatched_keys", "info", "planCuenta_id", 0, Severity.WARNING)
    res = OB.check_and_stage(updated, spec, masters)
    # rows that break a WARNING_EXCLUDE rule keep their previous values
    kept_keys = res.kept.select(*spec.pk)
    final = res.kept.unionByName(SK._ordered(current, spec).join(kept_keys, spec.pk, "left_anti"))
    return _finish(spark, "account_enrichment", RW.REF_START, wh, spec, _union([res.summary, *known, unknown]), res.details, read.rejects(),
                   lambda: _save_dimension(spark, spec, path, current, final, changed_at, changed_by), run_id)


# ------------------------------------------------------------------ H6

def file_counts(lines: DataFrame, headers: DataFrame, kind: str = "eerr_origen") -> DataFrame:
    """(_file, period, ins_id, kind, n_rows) of every file with a line, also of one without
    any data row: lines other than the header line."""
    data = TX.drop_header(lines, headers, keys=[TX.FILE]).where(F.length(TX.LINE) > 0)
    counted = data.groupBy(TX.FILE).agg(F.count(F.lit(1)).alias("n_rows"))
    files = headers.select(TX.FILE, TX.file_period().alias(PERIOD), F.col("Cod_Banco").alias("ins_id"), kind)
    return files.join(dealt(counted), TX.FILE, "left").select(TX.FILE, PERIOD, "ins_id", kind, F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def completeness(registered: DataFrame, counts: DataFrame, raws: dict[str, RawSpec]) -> DataFrame:
    """One row for each statement that a registered institution owes: (period if the
    registry has one), ins_id, eerr_origen, n_rows (null: no file), passed (rows within the
    kind's bounds)."""
    by = [c for c in (PERIOD,) if c in registered.columns and c in counts.columns]
    kinds = F.array(*[F.struct(F.lit(o).alias("eerr_origen"), F.lit(r.min_rows).alias("lo"),
                               F.lit(r.max_rows).alias("hi")) for o, r in raws.items()])
    owed = registered.select(*by, "ins_id").distinct().select(*by, "ins_id", F.inline(kinds))
    found = counts.groupBy(*by, "ins_id", "eerr_origen").agg(F.sum("n_rows").alias("n_rows"))
    return (owed.join(dealt(found), [*by, "ins_id", "eerr_origen"], "left")
            .withColumn("passed", F.coalesce(F.col("n_rows").between(F.col("lo"), F.col("hi")), F.lit(False)))
            .select(*by, "ins_id", "eerr_origen", "n_rows", "passed"))


def _bad_by(df: DataFrame, bad, rule_id: str, rule_type: str, column: str | None, tolerance: int | None = None) -> DataFrame:
    """A rule's results by period: rows of ``df`` and how many are bad."""
    counted = df.groupBy(PERIOD).agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(bad, 1)).alias("n_bad"))
    return Q.summary_rows(counted, rule_id, rule_type, column, tolerance_rows=tolerance, by=[PERIOD])


@dataclasses.dataclass
class RangeResult:
    """Several months judged together.  verdicts: a period and a rule a row."""

    verdicts: DataFrame
    details: DataFrame
    rejects: DataFrame
    kept: DataFrame


def judge_statements(spark: SparkSession, raw_root: Root | dict[str, Root], wh: Warehouse, periods: Sequence[str],
                     raws: dict[str, RawSpec] | None = None) -> RangeResult:
    """Every statement of the given months parsed and judged in one pass.

    The raw lines of all kinds and months are staged once, with the kind that their path
    tells; headers, rows per file, completeness, scope and the table's rules are then
    aggregates by period over the staged lines and the staged batch."""
    raws = raws or RW.STATEMENTS
    lands = {}

    def land(origin: str) -> TX.Landing:
        root = raw_root[origin] if isinstance(raw_root, dict) else raw_root
        key = root if isinstance(root, str) else id(root)
        return lands.setdefault(key, landing(spark, root))

    found, _ = OB.staged(_union([TX.raw_lines(land(o), r, periods=periods).withColumn("eerr_origen", F.lit(o)) for o, r in raws.items()]), "lines")
    branches, headers, rejects = [], [], []
    for origin, raw in raws.items():
        scan = TX.scan_lines(found.where(F.col("eerr_origen") == origin).drop("eerr_origen"), raw)
        headers.append(scan.headers.select(TX.FILE, "YYYY", "MM", "Cod_Banco", "_header", "codigo", F.lit(origin).alias("eerr_origen")))
        rejects.append(scan.rejects.withColumn("eerr_origen", F.lit(origin)))
        shaped = scan.data.select(TX.file_period().alias(PERIOD), F.col("Cod_Banco").alias("ins_id"),
                                  *[c for c in scan.data.columns if c == "planCuenta_id" or "_Monto" in c])
        amounts = [c for c in shaped.columns if "_Monto" in c]
        branches.append(A.statement_branch(shaped, origin, components=amounts) if len(amounts) == 4
                        else A.statement_branch(shaped, origin, total=amounts[0]))
    header, _ = OB.staged(_union(headers), "headers")
    rejected, _ = OB.staged(_union(rejects), "rejects")
    counts, _ = OB.staged(file_counts(found, header), "files")
    month = lambda spec, name: SK.read_table(spark, spec, wh.path(name)).where(F.col(PERIOD).isin(list(periods)))
    registered = key_side(month(wh.spec(TB.INSTITUTION_MONTH), "institution_month"))
    in_scope, _ = A.month_scope(A.unify_sources(branches), registered)
    res = OB.check_and_stage(M.auto_map(in_scope, wh.spec(TB.STATEMENT)), wh.spec(TB.STATEMENT),
                             {"institution_month": registered, "account_month": month(TB.ACCOUNT_MONTH, "account_month")})
    # what is registered and not in the staged batch is in no file: the lines are not parsed again
    _, missing = A.month_scope(res.marked, registered)
    in_period = header.withColumn(PERIOD, TX.file_period())
    rules = [OB.results_by(res, PERIOD, wh.spec(TB.STATEMENT)),
             _bad_by(completeness(registered, counts, raws), ~F.col("passed"), "statement_files", "scope", "ins_id,eerr_origen"),
             _bad_by(rejected.withColumn(PERIOD, TX.file_period()), F.lit(True), "rejected_lines", "raw", None,
                     min(r.max_rejected for r in raws.values()))]
    absent = missing.groupBy(PERIOD).agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.lit(1)).alias("n_bad"))
    rules.append(Q.summary_rows(absent, "registered_without_statements", "scope", "ins_id", by=[PERIOD]))
    for origin, raw in raws.items():
        of_kind = F.col("eerr_origen") == origin
        rules.append(_bad_by(in_period.where(of_kind), F.col("codigo") != F.col("Cod_Banco"), f"{origin}:header_code", "header", "codigo"))
        within = F.col("n_rows").between(raw.min_rows, raw.max_rows)
        per_file = counts.where(of_kind).groupBy(PERIOD).agg(F.sum("n_rows").alias("n_rows"), F.count(F.when(~within, 1)).alias("n_bad"))
        rules.append(Q.summary_rows(per_file, f"{origin}:rows_per_file", "row_count", None, by=[PERIOD]))
    verdicts = _union(rules)
    # a month without any row fails: nothing drives its load
    driven = spark.createDataFrame([(p,) for p in periods], f"{PERIOD} string").join(
        res.marked.groupBy(PERIOD).agg(F.count(F.lit(1)).alias("n_rows")), PERIOD, "left").select(
        PERIOD, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.when(F.col("n_rows").isNull(), 1).otherwise(0).alias("n_bad"))
    verdicts = verdicts.unionByName(Q.summary_rows(driven, "month_not_empty", "row_count", PERIOD, by=[PERIOD]))
    return RangeResult(OB.staged(verdicts, "verdicts")[0], res.details, rejected, res.kept)


def statements(spark: SparkSession, raw_root: Root | dict[str, Root], wh: Warehouse, year: int, month: int,
               raws: dict[str, RawSpec] | None = None, run_id: str | None = None) -> JobResult:
    """Statement fact of a month: every bank's four extracts in one scan,
    header code and row-count checks per file, scope to the banks registered
    for the month, unify, table rules, partition replace.

    ``raw_root``: one folder holding every statement kind (the reference's
    layout), or a folder per kind ({'B1': ..., 'R1': ...})."""
    period = period_str(year, month)
    found = judge_statements(spark, raw_root, wh, [period], raws)
    rejects = found.rejects if found.verdicts.where("rule_id = 'rejected_lines'").take(1) else None
    return _finish(spark, "statements", period, wh, wh.spec(TB.STATEMENT), found.verdicts.drop(PERIOD), found.details, rejects,
                   lambda: SK.partition_replace(found.kept, wh.spec(TB.STATEMENT), wh.path("statement")), run_id)


# ------------------------------------------------------------------ H7

def indicators(spark: SparkSession, wh: Warehouse, year: int, month: int,
               compare_rows: tuple[int, int] = COMPARE_ROWS,
               masters: dict[str, DataFrame] | None = None, run_id: str | None = None) -> JobResult:
    """Management indicators of a month from the statement table.

    The comparison is staged once; its row count and aggregate rules are observed
    meanwhile, and the pivot is computed from it.

    ``masters``: product and business-line tables for the foreign keys; those
    of a table that is not given are not checked, which the summary says."""
    period = period_str(year, month)
    fact = SK.read_table(spark, wh.spec(TB.STATEMENT), wh.path("statement"))
    sums = {"n": F.count(F.lit(1)), **{r.rule_id: F.expr(r.expr) for r in AGG_RULES}}
    compared, seen = OB.staged(A.month_compare(fact, ["ins_id", "planCuenta_id"], period=period), "compared", sums)
    passed = {r.rule_id: bool(seen[r.rule_id]) for r in AGG_RULES}
    known = [_interval_rule(seen["n"], compare_rows, "compare_rows")] + [
        (r.rule_id, "aggregate", None, r.error_code, None, r.severity.value, None, 0 if passed[r.rule_id] else 1, passed[r.rule_id]) for r in AGG_RULES]
    accounts = SK.read_table(spark, TB.ACCOUNT, wh.path("account"))
    out = A.indicators_of(compared, accounts, MEASURES, DERIVED)
    refs = {"institution": SK.read_table(spark, wh.spec(TB.INSTITUTION), wh.path("institution")), **(masters or {})} \
        if SK.versions(wh.path("institution")) else dict(masters or {})
    absent = [fk for fk in wh.spec(TB.INDICATORS).foreign_keys if fk.ref not in refs]
    res = OB.check_and_stage(M.auto_map(out, wh.spec(TB.INDICATORS)), wh.spec(TB.INDICATORS), refs, skip_refs=[fk.ref for fk in absent])
    known += [(f"not_checked:{fk.ref}", "info", ",".join(fk.local), 0, None, Severity.WARNING.value, 0, 0, True) for fk in absent]
    result = _finish(spark, "indicators", period, wh, wh.spec(TB.INDICATORS), _union([OB.rule_rows(spark, known), res.summary]), res.details, None,
                     lambda: SK.partition_replace(res.kept, wh.spec(TB.INDICATORS), wh.path("indicators")), run_id)
    # code 1: current month empty, 2: previous month empty
    failed = [r for r in AGG_RULES if not passed[r.rule_id]]
    result.first_error = spark.createDataFrame([(len(AGG_RULES), len(failed), failed[0].error_code if failed else None)],
                                               "n_rules long, n_failed long, error_code int")
    return result


# ------------------------------------------------------------------ H8, H9

def monthly_run(spark: SparkSession, roots: dict[str, object], wh: Warehouse, year: int, month: int,
                raws: dict[str, object] | None = None) -> list[JobResult]:
    """The monthly run in dependency order; a job runs only if the previous
    ones passed.  ``roots``: folders of the 'codifis', 'plan' and 'stmt'
    extracts ('stmt' may map each statement kind to its own folder);
    ``raws`` may override their layouts (keys 'codifis', 'plan', 'stmt').
    Each folder is listed once."""
    raws = raws or {}
    codifis, plan = raws.get("codifis", RW.CODIFIS), raws.get("plan", RW.PLAN_CTAS)
    lands: dict[str, TX.Landing] = {}

    def land(root):
        if isinstance(root, dict):
            return {k: land(v) for k, v in root.items()}
        return lands.setdefault(root, landing(spark, root)) if isinstance(root, str) else root

    steps = [
        lambda: institution(spark, land(roots["codifis"]), wh, year, month, codifis),
        lambda: institution_month(spark, land(roots["codifis"]), wh, year, month, codifis),
        lambda: account(spark, land(roots["plan"]), wh, year, month, plan),
        lambda: account_month(spark, land(roots["plan"]), wh, year, month, plan),
        lambda: statements(spark, land(roots["stmt"]), wh, year, month, raws.get("stmt")),
    ]
    done = []
    for step in steps:
        res = step()
        done.append(res)
        if not res.ok:
            break
    return done


def run_range(job, start: str, n_months: int) -> list[JobResult]:
    """``job(year, month)`` for n months from ``start``, stopping at the first
    month that fails: later months are not touched."""
    done: list[JobResult] = []
    for i in range(n_months):
        period = shift_period_str(start, i)
        done.append(job(int(period[:4]), int(period[5:7])))
        if not done[-1].ok:
            break
    return done


def months_from(start: str, n_months: int) -> list[str]:
    return [shift_period_str(start, i) for i in range(n_months)]


def _write_prefix(spark: SparkSession, name: str, start: str, wh: Warehouse, spec: TableSpec, found: RangeResult, path: str,
                  run_id: str | None = None) -> JobResult:
    """Keep every month's results, then write the months before the first that fails."""
    run_id = run_id or f"{name}:{start}:{uuid.uuid4().hex[:8]}"
    SK.append_quality(found.verdicts.drop(PERIOD), found.details, wh.path("quality"), spec.name, run_id)
    judged = found.verdicts.where(F.col("severity") == Severity.ERROR.value).select(PERIOD, "passed")
    ok = judged.where("NOT passed").isEmpty()
    written = SK.partition_replace(A.month_prefix(found.kept, judged), spec, path)
    return JobResult(name, start, ok, found.verdicts, written, found.details, found.rejects)


def statements_range(spark: SparkSession, raw_root: Root | dict[str, Root], wh: Warehouse, start: str, n_months: int,
                     raws: dict[str, RawSpec] | None = None, run_id: str | None = None) -> JobResult:
    """Statements of n months from ``start``: all months read and judged together, and
    those before the first failing month written by one dynamic partition overwrite."""
    found = judge_statements(spark, raw_root, wh, months_from(start, n_months), raws)
    return _write_prefix(spark, "statements_range", start, wh, wh.spec(TB.STATEMENT), found, wh.path("statement"), run_id)


def _snapshot_range(spark: SparkSession, name: str, root: Root, raw: RawSpec, wh: Warehouse, start: str, n_months: int, spec: TableSpec,
                    batch_of: Callable[[DataFrame], DataFrame], refs: dict[str, DataFrame], shape, file_rules, run_id) -> JobResult:
    """Monthly snapshots of one extract for a range of months in one pass."""
    periods = months_from(start, n_months)
    lines, _ = OB.staged(TX.raw_lines(landing(spark, root), raw, periods=periods), f"lines-{name}")
    scan = TX.scan_lines(lines, raw, shape=shape)
    rows = scan.data.withColumn(PERIOD, TX.file_period())
    res = OB.check_and_stage(batch_of(rows), spec, refs)
    per_file = rows.groupBy(PERIOD).agg(F.count(F.lit(1)).alias("n_rows"))
    months = spark.createDataFrame([(p,) for p in periods], f"{PERIOD} string").join(per_file, PERIOD, "left").select(
        PERIOD, F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
    bounds = months.select(PERIOD, "n_rows", F.when(F.col("n_rows").between(raw.min_rows, raw.max_rows), 0).otherwise(1).alias("n_bad"))
    rules = [OB.results_by(res, PERIOD, spec), Q.summary_rows(bounds, "rows_in_file", "row_count", None, by=[PERIOD]),
             _bad_by(scan.rejects.withColumn(PERIOD, TX.file_period()), F.lit(True), "rejected_lines", "raw", None, raw.max_rejected),
             *file_rules(rows)]
    found = RangeResult(OB.staged(_union(rules), f"verdicts-{name}")[0], res.details, scan.rejects, res.kept)
    return _write_prefix(spark, name, start, wh, spec, found, wh.path(spec.name), run_id)


def institution_month_range(spark: SparkSession, raw_root: Root, wh: Warehouse, start: str, n_months: int,
                            raw: RawSpec = RW.CODIFIS, run_id: str | None = None) -> JobResult:
    """Institutions of n months from ``start`` in one pass."""
    spec = wh.spec(TB.INSTITUTION_MONTH)
    return _snapshot_range(spark, "institution_month_range", raw_root, raw, wh, start, n_months, spec,
                           lambda rows: M.map_columns(rows, spec, {PERIOD: PERIOD, "ins_id": "institucion_id", "ins_nombre": "institucion_nombre"}),
                           {"institution": SK.read_table(spark, wh.spec(TB.INSTITUTION), wh.path("institution"))}, "default", lambda rows: [], run_id)


def account_month_range(spark: SparkSession, raw_root: Root, wh: Warehouse, start: str, n_months: int,
                        raw: RawSpec = RW.PLAN_CTAS, run_id: str | None = None) -> JobResult:
    """Accounts of n months from ``start`` in one pass; each file's year and month must be
    its own."""
    spec = TB.ACCOUNT_MONTH

    def dated(rows: DataFrame) -> list[DataFrame]:
        own = F.make_date("ano", "mes", F.lit(1)).cast("string") == F.col(PERIOD)
        seen = rows.groupBy(PERIOD).agg(F.lit(1).alias("n_rows"), F.when(F.bool_and(F.coalesce(own, F.lit(False))), 0).otherwise(1).alias("n_bad"))
        return [Q.summary_rows(seen, "file_period", "period", "ano,mes", by=[PERIOD])]
    return _snapshot_range(spark, "account_month_range", raw_root, raw, wh, start, n_months, spec,
                           lambda rows: M.auto_map(rows.select(PERIOD, "planCuenta_id", "planCuenta_Nombre").distinct(), spec),
                           {"account": SK.read_table(spark, TB.ACCOUNT, wh.path("account"))}, None, dated, run_id)


def reprocess_indicators(spark: SparkSession, wh: Warehouse, start: str, n_months: int,
                         compare_rows: tuple[int, int] | None = None, masters: dict[str, DataFrame] | None = None,
                         run_id: str | None = None) -> DataFrame:
    """Mass reprocessing of n months from ``start`` in one job: indicators
    and their rules (row count and sums of the comparison, table rules, foreign keys) for
    every month at once, written only for the months before the first month that fails a
    rule (the reference stops there)."""
    periods = months_from(start, n_months)
    fact = SK.read_table(spark, wh.spec(TB.STATEMENT), wh.path("statement")).where(
        F.col(PERIOD).between(shift_period_str(start, -1), periods[-1]))
    compared, _ = OB.staged(A.month_compare(fact, ["ins_id", "planCuenta_id"]).where(F.col(PERIOD) >= start), "compared")
    counted = Q.row_count_interval(compared, *(compare_rows or (1, None)), by=[PERIOD])
    # a month with no statement rows at all fails too
    months = A.month_range(spark, start, n_months).join(counted, PERIOD, "left").select(
        PERIOD, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.when(F.coalesce("passed", F.lit(False)), 0).otherwise(1).alias("n_bad"))
    sums = Q.aggregate_rules(compared, AGG_RULES, by=[PERIOD]).select(
        PERIOD, "rule_id", F.lit("aggregate").alias("rule_type"), F.lit(None).cast("string").alias("column_name"), "error_code",
        F.lit(None).cast("string").alias("external_code"), "severity", F.lit(None).cast("bigint").alias("n_rows"),
        F.when(F.col("passed"), 0).otherwise(1).cast("bigint").alias("n_bad"), "passed")
    refs = dict(masters or {})
    if SK.versions(wh.path("institution")):
        refs["institution"] = SK.read_table(spark, wh.spec(TB.INSTITUTION), wh.path("institution"))
    out = A.indicators_of(compared, SK.read_table(spark, TB.ACCOUNT, wh.path("account")), MEASURES, DERIVED)
    res = OB.check_and_stage(M.auto_map(out, wh.spec(TB.INDICATORS)), wh.spec(TB.INDICATORS), refs,
                             skip_refs=[fk.ref for fk in wh.spec(TB.INDICATORS).foreign_keys if fk.ref not in refs])
    verdicts, _ = OB.staged(_union([OB.results_by(res, PERIOD, wh.spec(TB.INDICATORS)), sums,
                                    Q.summary_rows(months, "compare_rows", "row_count", None, by=[PERIOD])]), "verdicts-indicators")
    found = RangeResult(verdicts, res.details, verdicts.limit(0), res.kept)
    return _write_prefix(spark, "reprocess_indicators", start, wh, wh.spec(TB.INDICATORS), found, wh.path("indicators"), run_id).written
