"""A batch checked and staged in one pass.

``check_and_stage`` marks every row with the row rules and foreign keys that it breaks,
writes the marked batch once into the shared folder, and counts the marks with
``observe`` while it writes: the rules and the write share one scan of the batch's source.
What needs a shuffle by other keys (primary key, unique columns, aggregate rules) reads
only the columns that it needs from the staged files.  The results have the shape of
``quality.check``: summary, details, kept rows.  Only the counts, one number a rule, reach
the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cuadra.operators import quality as Q
from cuadra.operators.joins import key_side
from cuadra.session import shared_dir
from cuadra.specs import ForeignKey, Severity, TableSpec

MARKS = "_bad"


def fk_rule_id(fk: ForeignKey) -> str:
    return f"fk:{','.join(fk.local)}->{fk.ref}"


@dataclass(frozen=True)
class MarkedBatch:
    """A batch with ``_bad``: the places in ``checks`` of the row and FK rules a row breaks."""

    rows: DataFrame
    checks: list[Q.RowCheck]


def mark(df: DataFrame, spec: TableSpec, refs: Mapping[str, DataFrame], extra: Sequence[Q.RowCheck] = ()) -> MarkedBatch:
    """Foreign keys are looked up by one left join each (the planner may broadcast a
    small parent; AQE splits a hot key); a nullable key with a null part is not checked."""
    checks, out, hits = [*Q.row_checks(spec), *extra], df, []
    for i, fk in enumerate(f for f in spec.foreign_keys if f.ref in refs):
        names = {r: f"_fk{i}_{n}" for n, (_, r) in enumerate(fk.columns)}
        keys = key_side(refs[fk.ref]).select(*[F.col(r).alias(names[r]) for r in fk.remote]).distinct().withColumn(f"_fk{i}", F.lit(True))
        same = reduce(lambda a, b: a & b, [out[local] == keys[names[r]] for local, r in fk.columns])
        out = out.join(keys, same, "left").drop(*names.values())
        bad = F.col(f"_fk{i}").isNull()
        if fk.nullable:
            bad = bad & reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in fk.local])
        checks.append(Q.RowCheck(fk_rule_id(fk), "fk", ",".join(fk.local), fk.error_code, fk.severity, bad, external_code=fk.external_code))
        hits.append(f"_fk{i}")
    marks = F.array_compact(F.array(*[F.when(c.bad, F.lit(i)) for i, c in enumerate(checks)])) if checks else F.array().cast("array<int>")
    return MarkedBatch(out.withColumn(MARKS, marks).drop(*hits), checks)


def rule_rows(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Summary rows from rule results that are known on the driver (one row a rule)."""
    return spark.createDataFrame(rows, "rule_id string, rule_type string, column_name string, error_code int, external_code string, "
                                       "severity string, n_rows long, n_bad long, passed boolean")


def result_row(check: Q.RowCheck, n_rows: int, n_bad: int) -> tuple:
    """A rule's summary row; the tolerance works as in ``quality.tolerance_passed``."""
    if check.tolerance_rows is None and check.tolerance_share is None:
        passed = n_bad == 0
    else:
        share = n_bad / n_rows if n_rows else 0.0
        passed = not ((check.tolerance_rows is not None and n_bad > check.tolerance_rows)
                      or (check.tolerance_share is not None and share > check.tolerance_share))
    return (check.rule_id, check.rule_type, check.column, check.error_code, check.external_code, check.severity.value, n_rows, n_bad, passed)


def staged(df: DataFrame, name: str, metrics: Mapping[str, Column] | None = None) -> tuple[DataFrame, dict]:
    """``df`` written once into the shared folder and read back, and the values of the
    metrics (aggregates) that were observed on the way."""
    spark, path, observation = df.sparkSession, shared_dir(df.sparkSession, name), Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    if metrics:
        df = df.observe(observation, *[c.alias(k) for k, c in metrics.items()])
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), dict(observation.get) if metrics else {}


@dataclass
class Checked:
    summary: DataFrame
    details: DataFrame      # rule_id and the key columns of violating rows
    kept: DataFrame         # without rows that break a WARNING_EXCLUDE rule
    marked: DataFrame       # the staged batch with ``_bad``
    checks: list[Q.RowCheck]
    metrics: dict           # n: rows; further metrics by their names


def check_and_stage(df: DataFrame, spec: TableSpec, refs: Mapping[str, DataFrame] | None = None,
                    skip_refs: Sequence[str] = (), extra: Sequence[Q.RowCheck] = (),
                    metrics: Mapping[str, Column] | None = None) -> Checked:
    """``quality.check`` with the batch's source scanned once.  ``extra``: row rules of the
    load beyond the table's own; ``metrics``: further aggregates to observe."""
    refs = refs or {}
    absent = [fk.ref for fk in spec.foreign_keys if fk.ref not in refs and fk.ref not in skip_refs]
    if absent:
        raise ValueError(f"{spec.name}: no reference given for {absent}; pass it, or name it in skip_refs")
    batch = mark(df, spec, refs, extra)
    counts = {f"b{i}": F.count(F.when(F.array_contains(MARKS, i), 1)) for i in range(len(batch.checks))}
    rows, seen = staged(batch.rows, f"batch-{spec.name}", {"n": F.count(F.lit(1)), **counts, **(metrics or {})})
    spark = df.sparkSession
    parts = [rule_rows(spark, [result_row(c, seen["n"], seen[f"b{i}"]) for i, c in enumerate(batch.checks)])]
    details = [mark_details(rows, batch.checks, spec.pk or spec.names)]
    # the shuffles by key read the staged key columns only
    keys = ([("pk", "pk", spec.pk, False, spec.pk_external_code)] if spec.pk else []) + [
        (f"{c.name}:unique", "unique", [c.name], True, None) for c in spec.columns if c.unique]
    for rule_id, kind, columns, nulls_apart, code in keys:
        parts.append(Q.pk_check(rows, columns, rule_id=rule_id, rule_type=kind, ignore_nulls=nulls_apart, external_code=code))
        source = rows.where(F.col(columns[0]).isNotNull()) if nulls_apart else rows
        details.append(Q.repeated_rows(source, columns).select(F.lit(rule_id).alias("rule_id"), *(spec.pk or spec.names)))
    for r in spec.rules:
        if r.level == "aggregate":
            parts.append(Q.aggregate_summary(rows, r))
    return Checked(reduce(DataFrame.unionByName, parts), reduce(DataFrame.unionByName, details),
                   without_excluded(rows, batch.checks).drop(MARKS), rows, batch.checks, {"n": seen["n"], **{k: seen[k] for k in metrics or {}}})


def mark_details(rows: DataFrame, checks: Sequence[Q.RowCheck], columns: Sequence[str]) -> DataFrame:
    names = F.array(*[F.lit(c.rule_id) for c in checks]) if checks else F.array().cast("array<string>")
    return rows.where(F.size(MARKS) > 0).select(F.explode(MARKS).alias("_i"), *columns).select(
        F.get(names, F.col("_i")).alias("rule_id"), *columns)


def without_excluded(rows: DataFrame, checks: Sequence[Q.RowCheck]) -> DataFrame:
    out = [i for i, c in enumerate(checks) if c.severity == Severity.WARNING_EXCLUDE]
    return rows.where(~F.arrays_overlap(MARKS, F.array(*[F.lit(i) for i in out]))) if out else rows


def results_by(checked: Checked, by: str, spec: TableSpec) -> DataFrame:
    """Summary rows of the row, FK and primary-key rules for each value of ``by`` (a part
    of the key, such as the period).  Marks and keys are counted before the shuffle."""
    rows, checks = checked.marked, checked.checks
    wide = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"), *[
        F.count(F.when(F.array_contains(MARKS, i), 1)).alias(f"b{i}") for i in range(len(checks))])
    rules = F.array(*[F.struct(
        F.lit(c.rule_id).alias("rule_id"), F.lit(c.rule_type).alias("rule_type"), F.lit(c.column).cast("string").alias("column_name"),
        F.lit(c.error_code).alias("error_code"), F.lit(c.external_code).cast("string").alias("external_code"),
        F.lit(c.severity.value).alias("severity"), F.col("n_rows"), F.col(f"b{i}").alias("n_bad"),
        Q.tolerance_passed(F.col(f"b{i}"), F.col("n_rows"), c.tolerance_rows, c.tolerance_share).alias("passed")) for i, c in enumerate(checks)])
    parts = [wide.select(by, F.inline(rules))] if checks else []
    if spec.pk:
        repeated = Q.key_counts(rows, spec.pk).groupBy(by).agg(
            F.sum("n_rows").alias("n_rows"), F.sum(F.when(F.col("n_rows") > 1, F.col("n_rows"))).alias("n_bad"))
        parts.append(Q.summary_rows(repeated, "pk", "pk", ",".join(spec.pk), external_code=spec.pk_external_code, by=[by]))
    return reduce(DataFrame.unionByName, parts).select(by, *Q.SUMMARY_COLUMNS)


__all__ = ["Checked", "check_and_stage", "mark", "result_row", "results_by", "rule_rows", "staged"]
