"""Declarative data-quality rules.

Every rule yields summary rows of one shape::

    rule_id, rule_type, column_name, error_code, severity, n_rows, n_bad, passed

Row-level rules of a table (not-null, lengths, ranges, regular expressions,
SQL predicates) are evaluated together in **one** aggregation pass and
unpivoted with ``stack``.  Key rules (primary key, unique, foreign keys) need
one aggregation or join each; they pre-aggregate to distinct keys with row
counts before any join, so a hot key costs one row per map task.

Violating rows are available as a details DataFrame; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuadra.operators.joins import dealt
from cuadra.specs import ColumnSpec, ForeignKey, Rule, Severity, TableSpec

SUMMARY_COLUMNS = ("rule_id", "rule_type", "column_name", "error_code", "external_code",
                   "severity", "n_rows", "n_bad", "passed")


@dataclass(frozen=True)
class RowCheck:
    """A row rule in evaluable form: ``bad`` is true on violating rows."""

    rule_id: str
    rule_type: str
    column: str | None
    error_code: int
    severity: Severity
    bad: Column
    tolerance_rows: int | None = None
    tolerance_share: float | None = None
    external_code: str | None = None


def _sql_str(v: str | None) -> str:
    return "CAST(NULL AS STRING)" if v is None else "'" + v.replace("'", "\\'") + "'"


def tolerance_passed(n_bad: Column, n_rows: Column, tolerance_rows: int | None,
                     tolerance_share: float | None) -> Column:
    """Without tolerance: no bad row.  With tolerance: fails when the bad rows
    exceed the number or their share exceeds the fraction (10 allows 10)."""
    if tolerance_rows is None and tolerance_share is None:
        return n_bad == 0
    fail = F.lit(False)
    if tolerance_rows is not None:
        fail = fail | (n_bad > F.lit(tolerance_rows))
    if tolerance_share is not None:
        share = F.when(n_rows > 0, n_bad / n_rows).otherwise(F.lit(0.0))
        fail = fail | (share > F.lit(tolerance_share))
    return ~fail


# ------------------------------------------------------------- row rules

def _datetime(value: str, dtype: str) -> Column:
    """A bound literal in the column's own date/time type (no session time
    zone enters the comparison)."""
    kind = dtype.strip().lower()
    return F.lit(value).cast(kind if kind in ("date", "timestamp", "timestamp_ntz") else "timestamp_ntz")


def column_checks(col: ColumnSpec) -> list[RowCheck]:
    """Row checks declared on a column: not-null (unless nullable), length,
    decimal and date-time bounds, regular expression.  Bounds are inclusive;
    a null value only fails the not-null rule."""
    c = F.col(col.name)
    out = []
    if not col.nullable:
        out.append(RowCheck(f"{col.name}:not_null", "not_null", col.name, 0, Severity.ERROR, c.isNull()))
    if col.min_len is not None:
        out.append(RowCheck(f"{col.name}:min_len", "min_len", col.name, 0,
                            Severity.ERROR, F.length(c) < F.lit(col.min_len),
                            external_code=col.min_len_code))
    if col.max_len is not None:
        out.append(RowCheck(f"{col.name}:max_len", "max_len", col.name, 0,
                            Severity.ERROR, F.length(c) > F.lit(col.max_len),
                            external_code=col.max_len_code))
    if col.min_value is not None:
        out.append(RowCheck(f"{col.name}:min_value", "min_value", col.name, 0, Severity.ERROR,
                            c < F.expr(col.min_value)))
    if col.max_value is not None:
        out.append(RowCheck(f"{col.name}:max_value", "max_value", col.name, 0, Severity.ERROR,
                            c > F.expr(col.max_value)))
    if col.min_datetime is not None:
        out.append(RowCheck(f"{col.name}:min_datetime", "min_datetime", col.name, 0, Severity.ERROR,
                            c < _datetime(col.min_datetime, col.dtype)))
    if col.max_datetime is not None:
        out.append(RowCheck(f"{col.name}:max_datetime", "max_datetime", col.name, 0, Severity.ERROR,
                            c > _datetime(col.max_datetime, col.dtype)))
    if col.regex is not None:
        out.append(RowCheck(f"{col.name}:regex", "regex", col.name, 0, Severity.ERROR,
                            ~c.rlike(col.regex)))
    return [RowCheck(r.rule_id, r.rule_type, r.column, r.error_code, r.severity,
                     F.coalesce(r.bad, F.lit(False)), external_code=r.external_code) for r in out]


def sql_check(rule: Rule) -> RowCheck:
    """A row-level SQL predicate stated positively; a null result fails."""
    return RowCheck(rule.rule_id, "row_sql", rule.column, rule.error_code, rule.severity,
                    ~F.coalesce(F.expr(rule.expr), F.lit(False)),
                    rule.tolerance_rows, rule.tolerance_share, rule.external_code)


def row_checks(spec: TableSpec) -> list[RowCheck]:
    checks = [chk for col in spec.columns for chk in column_checks(col)]
    checks += [sql_check(r) for r in spec.rules if r.level == "row"]
    return checks


def evaluate_row_checks(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """All row checks in one aggregation pass, unpivoted to summary rows."""
    if not checks:
        return _empty_summary(df)
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.count(F.when(chk.bad, 1)).alias(f"_b{i}") for i, chk in enumerate(checks)]
    wide = df.agg(*aggs)
    args = []
    for i, chk in enumerate(checks):
        args += [_sql_str(chk.rule_id), _sql_str(chk.rule_type), _sql_str(chk.column),
                 f"CAST({chk.error_code} AS INT)", _sql_str(chk.external_code),
                 _sql_str(chk.severity.value), f"_b{i}"]
    stacked = wide.selectExpr(
        "_n AS n_rows",
        f"stack({len(checks)}, {', '.join(args)}) AS "
        "(rule_id, rule_type, column_name, error_code, external_code, severity, n_bad)")
    passed = None
    for chk in checks:
        p = tolerance_passed(F.col("n_bad"), F.col("n_rows"), chk.tolerance_rows, chk.tolerance_share)
        passed = (F.when(F.col("rule_id") == chk.rule_id, p) if passed is None
                  else passed.when(F.col("rule_id") == chk.rule_id, p))
    return stacked.withColumn("passed", passed).select(*SUMMARY_COLUMNS)


def row_rule_details(df: DataFrame, checks: Sequence[RowCheck], cols: Sequence[str]) -> DataFrame:
    """Violating rows of every row rule in one scan: each row carries the
    ids of the rules it fails, and is emitted once per failed rule."""
    failed = F.array_compact(F.array(*[F.when(chk.bad, F.lit(chk.rule_id)) for chk in checks]))
    return (df.select(*cols, failed.alias("_failed")).where(F.size("_failed") > 0)
            .select(F.explode("_failed").alias("rule_id"), *cols))


def _empty_summary(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [], "rule_id string, rule_type string, column_name string, error_code int, "
            "external_code string, severity string, n_rows bigint, n_bad bigint, passed boolean")


def summary_rows(df: DataFrame, rule_id: str, rule_type: str, column: str | None,
                 error_code: int = 0, severity: Severity = Severity.ERROR, tolerance_rows: int | None = None,
                 tolerance_share: float | None = None, external_code: str | None = None,
                 by: Sequence[str] = ()) -> DataFrame:
    """``df`` has n_rows and n_bad (one row, or one for each value of ``by``); add the
    rule's metadata."""
    n_rows, n_bad = F.col("n_rows").cast("bigint"), F.coalesce(F.col("n_bad"), F.lit(0)).cast("bigint")
    return df.select(
        *by, F.lit(rule_id).alias("rule_id"), F.lit(rule_type).alias("rule_type"),
        F.lit(column).cast("string").alias("column_name"), F.lit(error_code).cast("int").alias("error_code"),
        F.lit(external_code).cast("string").alias("external_code"), F.lit(severity.value).alias("severity"), n_rows.alias("n_rows"), n_bad.alias("n_bad"),
        tolerance_passed(n_bad, n_rows, tolerance_rows, tolerance_share).alias("passed"))


def null_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Null count of every declared column in one pass; the not-null rule
    applies to columns not declared nullable.
    Output: column_name, nullable, n_rows, n_null, passed."""
    cols = list(spec.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.count(F.when(F.col(c.name).isNull(), 1)).alias(f"_z{i}") for i, c in enumerate(cols)])
    args = ", ".join(f"{_sql_str(c.name)}, {str(c.nullable).lower()}, _z{i}" for i, c in enumerate(cols))
    out = wide.selectExpr("_n AS n_rows", f"stack({len(cols)}, {args}) AS (column_name, nullable, n_null)")
    return out.select("column_name", "nullable", "n_rows", "n_null",
                      (F.col("nullable") | (F.col("n_null") == 0)).alias("passed"))


# ------------------------------------------------------------- key rules

def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys with their row counts (partial aggregation first)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], ignore_nulls: bool = False) -> DataFrame:
    """Keys present more than once, with their row counts."""
    if ignore_nulls:
        df = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    return key_counts(df, keys).where(F.col("n_rows") > 1)


def pk_check(df: DataFrame, keys: Sequence[str], rule_id: str = "pk", error_code: int = 0,
             rule_type: str = "pk", ignore_nulls: bool = False,
             severity: Severity = Severity.ERROR, external_code: str | None = None) -> DataFrame:
    """Primary key (or unique) rule: n_bad = rows whose key is repeated."""
    src = df
    if ignore_nulls:
        src = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    counted = key_counts(src, keys)
    agg = counted.agg(F.sum("n_rows").alias("n_rows"),
                      F.sum(F.when(F.col("n_rows") > 1, F.col("n_rows"))).alias("n_bad"))
    if ignore_nulls:  # n_rows counts the rows with a non-null key (0 when none)
        agg = agg.select(F.coalesce(F.col("n_rows"), F.lit(0)).alias("n_rows"), "n_bad")
    return summary_rows(agg.fillna({"n_rows": 0}), rule_id, rule_type, ",".join(keys), error_code,
                        severity, external_code=external_code)


def _ref_keys(ref: DataFrame, fk: ForeignKey) -> DataFrame:
    return ref.select(*[F.col(r).alias(l) for l, r in fk.columns]).distinct()


def fk_violations(df: DataFrame, ref: DataFrame, fk: ForeignKey) -> DataFrame:
    """Rows whose key has no match in ``ref``.

    Non-nullable FK: a null key is a violation (``left_anti`` keeps it).
    Nullable FK: rows with a null key component are not checked."""
    src = df
    if fk.nullable:
        src = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in fk.local]))
    return src.join(_ref_keys(ref, fk), fk.local, "left_anti")


def fk_violation_keys(df: DataFrame, ref: DataFrame, fk: ForeignKey) -> DataFrame:
    """Distinct violating keys with row counts (keys aggregated before the join)."""
    src = df
    if fk.nullable:
        src = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in fk.local]))
    return key_counts(src, fk.local).join(_ref_keys(ref, fk), fk.local, "left_anti")


def fk_check(df: DataFrame, ref: DataFrame, fk: ForeignKey, rule_id: str | None = None) -> DataFrame:
    counted = key_counts(df, fk.local)
    hits = _ref_keys(ref, fk).withColumn("_hit", F.lit(True))
    joined = counted.join(hits, fk.local, "left")
    checked = F.lit(True)
    if fk.nullable:
        checked = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in fk.local])
    agg = joined.agg(F.sum("n_rows").alias("n_rows"),
                     F.sum(F.when(checked & F.col("_hit").isNull(), F.col("n_rows"))).alias("n_bad"))
    rid = rule_id or f"fk:{','.join(fk.local)}->{fk.ref}"
    return summary_rows(agg.fillna({"n_rows": 0}), rid, "fk", ",".join(fk.local), fk.error_code,
                        fk.severity, external_code=fk.external_code)


# ------------------------------------------------------- table-level rules

def aggregate_rules(df: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """Aggregate SQL predicates (e.g. ``sum(x) > 0``), optionally per group.

    Output: *by, rule_id, error_code, severity, rule_order, passed.  A null
    result (empty input) fails."""
    aggs = [F.expr(r.expr).alias(f"_r{i}") for i, r in enumerate(rules)]
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    args = []
    for i, r in enumerate(rules):
        args += [_sql_str(r.rule_id), f"CAST({r.error_code} AS INT)", _sql_str(r.severity.value),
                 f"CAST({i} AS INT)", f"coalesce(CAST(_r{i} AS BOOLEAN), false)"]
    return wide.selectExpr(*by, f"stack({len(rules)}, {', '.join(args)}) AS "
                                "(rule_id, error_code, severity, rule_order, passed)")


def aggregate_summary(df: DataFrame, rule: Rule) -> DataFrame:
    """An aggregate rule's summary row."""
    return aggregate_rules(df, [rule]).select(
        "rule_id", F.lit("aggregate").alias("rule_type"), F.lit(None).cast("string").alias("column_name"),
        "error_code", F.lit(rule.external_code).cast("string").alias("external_code"),
        "severity", F.lit(None).cast("bigint").alias("n_rows"),
        F.when(F.col("passed"), 0).otherwise(1).cast("bigint").alias("n_bad"), "passed")


def first_error(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The code of the first failing ERROR rule (by rule order), per group.

    Output: *by, n_rules, n_failed, error_code (null when all passed)."""
    failing = ~F.col("passed") & (F.col("severity") == Severity.ERROR.value)
    aggs = [F.count(F.lit(1)).alias("n_rules"),
            F.count(F.when(~F.col("passed"), 1)).alias("n_failed"),
            F.min_by(F.when(failing, F.col("error_code")),
                     F.when(failing, F.col("rule_order"))).alias("error_code")]
    return results.groupBy(*by).agg(*aggs) if by else results.agg(*aggs)


def row_count_interval(df: DataFrame, lo: int | None, hi: int | None, by: Sequence[str] = ()
                       ) -> DataFrame:
    """Row count within [lo, hi] (inclusive), for the table or per group
    (e.g. per file).  Output: *by, n_rows, passed."""
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows")) if by else \
        df.agg(F.count(F.lit(1)).alias("n_rows"))
    ok = F.lit(True)
    if lo is not None:
        ok = ok & (F.col("n_rows") >= lo)
    if hi is not None:
        ok = ok & (F.col("n_rows") <= hi)
    return counted.withColumn("passed", ok)


def one_value(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Each column must hold exactly one distinct value in the batch (0 on
    an empty batch fails).  Output: column_name, n_distinct, passed.

    The values are made distinct per column before they meet: one row a value and
    task reaches the shuffle, and no row is multiplied by the number of columns."""
    counted = [df.select(F.col(c).alias("_v")).where("_v IS NOT NULL").distinct()
               .agg(F.count(F.lit(1)).alias("n_distinct")).select(F.lit(c).alias("column_name"), "n_distinct") for c in cols]
    return reduce(lambda a, b: a.unionByName(b), counted).withColumn("passed", F.col("n_distinct") == 1)


def new_record_check(batch: DataFrame, current: DataFrame, keys: Sequence[str],
                     max_num: int | None, max_share: float | None,
                     rule_id: str = "max_new_records") -> DataFrame:
    """Cap on keys of the batch that are new to the current table."""
    bkeys = batch.select(*keys).distinct()
    marked = bkeys.join(current.select(*keys).distinct().withColumn("_old", F.lit(True)),
                        list(keys), "left")
    agg = marked.agg(F.count(F.lit(1)).alias("n_rows"),
                     F.count(F.when(F.col("_old").isNull(), 1)).alias("n_bad"))
    tol_rows = max_num if max_num is not None else (None if max_share is not None else 0)
    return summary_rows(agg, rule_id, "max_new_records", ",".join(keys), 0, Severity.ERROR,
                        tol_rows, max_share)


# ------------------------------------------------------------- whole check

@dataclass
class CheckResult:
    summary: DataFrame      # one row per rule
    details: DataFrame      # rule_id + key columns of violating rows
    kept: DataFrame         # input without WARNING_EXCLUDE violations


def check(df: DataFrame, spec: TableSpec, refs: Mapping[str, DataFrame] | None = None,
          detail_cols: Sequence[str] | None = None, skip_refs: Sequence[str] = ()) -> CheckResult:
    """Run every rule a spec declares; lazy, nothing is collected.

    Every foreign key needs its reference table in ``refs``; a key that is not
    to be checked is named in ``skip_refs``.

    Rules run as: one pass for all row rules, one aggregation for the primary
    key, one for each unique column, one anti-join per foreign key."""
    refs = refs or {}
    detail_cols = list(detail_cols or spec.pk or spec.names)
    checks = row_checks(spec)
    parts = [evaluate_row_checks(df, checks)]
    if spec.pk:
        parts.append(pk_check(df, spec.pk, rule_id="pk", external_code=spec.pk_external_code))
    for col in spec.columns:
        if col.unique:
            parts.append(pk_check(df, [col.name], rule_id=f"{col.name}:unique", rule_type="unique",
                                  ignore_nulls=True))
    absent = [fk.ref for fk in spec.foreign_keys if fk.ref not in refs and fk.ref not in skip_refs]
    if absent:
        raise ValueError(f"{spec.name}: no reference given for {absent}; pass it, or name it in skip_refs")
    for fk in spec.foreign_keys:
        if fk.ref in refs:
            parts.append(fk_check(df, refs[fk.ref], fk))
    for r in spec.rules:
        if r.level == "aggregate":
            parts.append(aggregate_summary(df, r))
    summary = reduce(lambda a, b: a.unionByName(b), parts)

    details = [row_rule_details(df, checks, detail_cols)] if checks else []
    if spec.pk:
        details.append(repeated_rows(df, spec.pk).select(F.lit("pk").alias("rule_id"), *detail_cols))
    for col in spec.columns:
        if col.unique:
            rows = repeated_rows(df.where(F.col(col.name).isNotNull()), [col.name])
            details.append(rows.select(F.lit(f"{col.name}:unique").alias("rule_id"), *detail_cols))
    for fk in spec.foreign_keys:
        if fk.ref in refs:
            rid = f"fk:{','.join(fk.local)}->{fk.ref}"
            details.append(fk_violations(df, refs[fk.ref], fk)
                           .select(F.lit(rid).alias("rule_id"), *detail_cols))
    detail_df = reduce(lambda a, b: a.unionByName(b), details) if details else \
        df.select(F.lit(None).cast("string").alias("rule_id"), *detail_cols).limit(0)

    kept = exclude_warnings(df, spec, refs)
    return CheckResult(summary, detail_df, kept)


def repeated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs more than once; nulls are equal to each other."""
    dup = duplicate_keys(df, keys).select(*[F.col(k).alias(f"_dup_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_dup_{k}")) for k in keys])
    return df.join(dealt(dup), same, "left_semi")


def exclude_warnings(df: DataFrame, spec: TableSpec, refs: Mapping[str, DataFrame] | None = None
                     ) -> DataFrame:
    """Drop rows violating WARNING_EXCLUDE rules (row predicates by filter,
    foreign keys by anti-join on the key); other rows continue."""
    refs = refs or {}
    out = df
    for r in spec.rules:
        if r.level == "row" and r.severity == Severity.WARNING_EXCLUDE:
            out = out.where(F.coalesce(F.expr(r.expr), F.lit(False)))
    for fk in spec.foreign_keys:
        if fk.severity == Severity.WARNING_EXCLUDE and fk.ref in refs:
            keys = _ref_keys(refs[fk.ref], fk)
            if fk.nullable:
                nulls = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in fk.local])
                marked = out.join(keys.withColumn("_hit", F.lit(True)), fk.local, "left")
                out = marked.where(nulls | F.col("_hit").isNotNull()).drop("_hit")
            else:
                out = out.join(keys, fk.local, "left_semi")
    return out


def gate(summary: DataFrame) -> DataFrame:
    """Single-row verdict: ok when no ERROR rule failed."""
    return summary.agg(
        F.count(F.lit(1)).alias("n_rules"),
        F.count(F.when(~F.col("passed"), 1)).alias("n_failed"),
        (F.count(F.when(~F.col("passed") & (F.col("severity") == Severity.ERROR.value), 1)) == 0)
        .alias("ok"))
