"""Period analytics: unify statements, current vs previous month, concept
pivot, year-to-date to month, column profiles, month ranges and scopes.

Design notes (scale):

* Current vs previous month is no self-join.  The fact is dealt by its key without the
  period, so all months of a key lie together: they are summed by month there, and each
  month's sum is emitted twice, as *current* for its own month and as *previous* for the
  next.  Narrow fact rows cross the network once, before anything is doubled.  (The key and
  the period are the fact's primary key, so a key has one row a month and summing before
  the shuffle would not save any.)
* Every measure of the pivot is linear in (current, previous), so the pivot is one more
  aggregation of the comparison.  Its narrow rows are shuffled, not the wide sums, which
  have about as many groups.
* Both shuffles are dealt to a number of tasks in proportion to the rows, so a task's
  memory does not grow with the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuadra.functions.expressions import (decimal_comma, scale_millions, shift_period,
                                          shift_period_str, to_amount)
from cuadra.operators.joins import join_dimension, semi_join
from cuadra.specs import Measure

PERIOD = "periodo_mes"


# ---------------------------------------------------------------- unify (D6)

STATEMENT_KEYS = (PERIOD, "ins_id", "planCuenta_id")
COMPONENTS = ("clp", "ipc", "tdc", "tdcb")
AMOUNT_TYPE = "decimal(26,2)"


def _parsed(df: DataFrame, name: str) -> Column:
    """Raw amount as decimal(23,2): decimal-comma text or a number."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return decimal_comma(name, 23, 2)
    return to_amount(name, 23, 2)


def statement_branch(df: DataFrame, origin: str, components: Sequence[str] | None = None,
                     total: str | None = None) -> DataFrame:
    """One statement extract in the shape of the unified fact.

    ``components``: the four amount columns (clp, ipc, tdc, tdcb) of a B1/R1
    style extract; the total is their sum (null if any is null).
    ``total``: the single amount column of a C1/C2 style extract; the
    components are zero.  Amounts are reported in millions.
    """
    zero = F.lit(0).cast("decimal(23,2)")
    if components:
        parts = [scale_millions(_parsed(df, c)) for c in components]
        amount = reduce(lambda a, b: a + b, parts)
    else:
        parts = [zero] * len(COMPONENTS)
        amount = scale_millions(_parsed(df, total))
    cols = [F.col(k) for k in STATEMENT_KEYS] + [F.lit(origin).alias("eerr_origen")]
    cols += [p.try_cast(AMOUNT_TYPE).alias(f"eerr_Monto_{c}") for p, c in zip(parts, COMPONENTS)]
    cols.append(amount.try_cast(AMOUNT_TYPE).alias("eerr_Monto"))
    return df.select(*cols)


def unify_sources(branches: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of statement branches (see ``statement_branch``)."""
    return reduce(lambda a, b: a.unionByName(b), branches)


# ------------------------------------------------- current vs previous (D1)

CUR = "_is_current"
VAL = "_value"


def current_previous_rows(df: DataFrame, value: str, keys: Sequence[str],
                          period: str = PERIOD) -> DataFrame:
    """Each row twice: (its period, value, current) and (next period, value, previous)."""
    v = F.col(value)
    pairs = F.array(
        F.struct(F.col(period).alias(period), v.alias(VAL), F.lit(True).alias(CUR)),
        F.struct(shift_period(period, 1).alias(period), v.alias(VAL), F.lit(False).alias(CUR)),
    )
    return df.select(*keys, F.inline(pairs))


def _restrict_periods(out: DataFrame, source: DataFrame, period_col: str,
                      period: str | None) -> DataFrame:
    """Keep the requested period, or every period present in the source: a subquery of one
    row, as the set of periods is bounded by the calendar."""
    if period is not None:
        return out.where(F.col(period_col) == period)
    periods = source.select(F.collect_set(period_col)).scalar()
    return out.where(F.array_contains(periods, F.col(period_col)))


def _scope_input(df: DataFrame, period_col: str, period: str | None) -> DataFrame:
    if period is None:
        return df
    return df.where(F.col(period_col).isin(period, shift_period_str(period, -1)))


def _zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


#: Rows of a fact that one task compares.
ROWS_A_TASK = 200_000


def tasks_for(df: DataFrame) -> int:
    """Tasks that a comparison of ``df`` is dealt to; two at least of any rows, as one is
    no dealing by key."""
    rows = df.count()
    return max(2 if rows else 1, -(-rows // ROWS_A_TASK))


def _two_months(df: DataFrame, keys: Sequence[str], value: str, period: str | None, period_col: str,
                dealt: bool = False, tasks: int | None = None) -> DataFrame:
    """(period, keys, _act, _ant): the sums of a key in a month and in the one before, null
    where the key has no row; every month that follows a month of the key is there.
    ``dealt``: the table is already laid out by (a part of) the key.  ``tasks``: as
    ``tasks_for`` the rows, where the caller knows it."""
    src = _scope_input(df.select(period_col, *keys, value), period_col, period)
    sums = (src if dealt else src.repartition(tasks or tasks_for(src), *keys)).groupBy(period_col, *keys).agg(F.sum(value).alias("_sum"))
    cur, v = F.col(CUR), F.col(VAL)
    # both aggregations find the key's rows in their partition
    pairs = current_previous_rows(sums, "_sum", keys, period_col).groupBy(period_col, *keys).agg(
        F.max(F.when(cur, v)).alias("_act"), F.max(F.when(~cur, v)).alias("_ant"))
    return _restrict_periods(pairs, src, period_col, period)


def month_compare(df: DataFrame, keys: Sequence[str], value: str = "eerr_Monto",
                  period: str | None = None, period_col: str = PERIOD,
                  act: str = "eerr_Monto_Act", ant: str = "eerr_Monto_Ant", dealt: bool = False,
                  tasks: int | None = None) -> DataFrame:
    """Sum of ``value`` in the current and in the previous month, by key.

    ``period`` given: that month only (input pruned to the two months).
    Otherwise every month present in ``df``.  A key with rows only in the
    previous month appears with a zero current amount.  ``dealt``: the table is laid out
    by a part of ``keys`` (``sinks.bucketed``), so nothing is shuffled.  ``tasks``: as
    ``tasks_for`` the rows, where the caller knows it.
    """
    pairs = _two_months(df, keys, value, period, period_col, dealt, tasks)
    return pairs.select(period_col, *keys, _zero_if_null(F.col("_act")).alias(act), _zero_if_null(F.col("_ant")).alias(ant))


# ------------------------------------------------------ concept pivot (D2)

def _not_january(period_col: str) -> Column:
    return F.substring(F.col(period_col), 6, 2) != F.lit("01")


def measure_expr(m: Measure, period_col: str = PERIOD, concept_col: str = "concept",
                 act: str = "eerr_Monto_Act", ant: str = "eerr_Monto_Ant") -> Column:
    """Conditional sum of one measure over compared months."""
    a, p = F.col(act), F.col(ant)
    if m.formula == "act":
        term = a
    elif m.formula == "act-ant":
        term = a - p
    elif m.formula == "ytd":                        # January: act only
        term = F.when(_not_january(period_col), a - p).otherwise(a)
    else:
        raise ValueError(f"unknown formula {m.formula!r}")
    return _zero_if_null(F.sum(F.when(F.col(concept_col) == F.lit(m.concept), term))).alias(m.name)


def concept_pivot(rows: DataFrame, keys: Sequence[str], measures: Sequence[Measure],
                  concept_col: str = "concept", period_col: str = PERIOD) -> DataFrame:
    """One conditional sum per measure, grouped by ``keys``, over compared months with
    their concept.  Groups whose concept has no measure still appear with zeros, as a SQL
    ``CASE ... ELSE 0`` pivot gives."""
    return rows.groupBy(*keys).agg(*[measure_expr(m, period_col, concept_col) for m in measures])


def indicators_of(compared: DataFrame, accounts: DataFrame, measures: Sequence[Measure],
                  derived: Mapping[str, str], out_type: str = AMOUNT_TYPE, tasks: int | None = None) -> DataFrame:
    """Indicators by (period, institution, product, business line) from ``month_compare``
    by institution and account.

    accounts: planCuenta_id, producto_id, negocio_id, planCuenta_Concepto.
    ``tasks``: as ``tasks_for`` the comparison, where the caller knows it.
    ``derived``: name -> SQL over measure names, evaluated as decimal(20,2).
    """
    acct = (accounts.where(F.col("planCuenta_Concepto").isNotNull())
            .select("planCuenta_id", "producto_id", "negocio_id",
                    F.col("planCuenta_Concepto").alias("concept")))
    group = [PERIOD, "ins_id", "producto_id", "negocio_id"]
    rows = join_dimension(compared, acct, "planCuenta_id").drop("planCuenta_id")
    out = concept_pivot(rows.repartition(tasks or tasks_for(compared), *group), group, measures)
    out = out.withColumns({name: F.expr(f"try_cast({sql} AS decimal(20,2))")
                           for name, sql in derived.items()})
    names = [m.name for m in measures] + list(derived)
    return out.select(*group, *[F.col(n).try_cast(out_type).alias(n) for n in names])


def management_indicators(fact: DataFrame, accounts: DataFrame, measures: Sequence[Measure],
                          derived: Mapping[str, str], period: str | None = None,
                          out_type: str = AMOUNT_TYPE) -> DataFrame:
    """``indicators_of`` the comparison of a fact (periodo_mes, ins_id, planCuenta_id,
    eerr_Monto)."""
    tasks = tasks_for(_scope_input(fact, PERIOD, period))
    compared = month_compare(fact, ["ins_id", "planCuenta_id"], period=period, tasks=tasks)
    # a row of the fact counts in two months
    return indicators_of(compared, accounts, measures, derived, out_type, 2 * tasks)


# --------------------------------------------------- year-to-date to month (D3)

def ytd_to_month(df: DataFrame, keys: Sequence[str], value: str = "eerr_Monto",
                 period: str | None = None, period_col: str = PERIOD,
                 out: str = "monto_mes") -> DataFrame:
    """Turn year-to-date balances into monthly movements.

    Month m: ytd(m) - ytd(m-1), except January where ytd(m) is the month.
    """
    pairs = _two_months(df, keys, value, period, period_col)
    act, ant = _zero_if_null(F.col("_act")), _zero_if_null(F.col("_ant"))
    return pairs.select(period_col, *keys, F.when(_not_january(period_col), act - ant).otherwise(act).alias(out))


# ------------------------------------------------------------ profile (D7/D8)

def profile_columns(df: DataFrame, cols: Sequence[str] | None = None,
                    approx_distinct: bool = True) -> DataFrame:
    """min, max, non-null count (and approximate distinct count) of each
    column, in one aggregation pass, returned in long form
    (column_name, min_value, max_value, n_non_null[, approx_distinct])."""
    cols = list(cols or df.columns)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(c).cast("string").alias(f"mn{i}"), F.max(c).cast("string").alias(f"mx{i}"),
                 F.count(c).alias(f"nn{i}")]
        if approx_distinct:
            aggs.append(F.approx_count_distinct(c).alias(f"ad{i}"))
    wide = df.agg(*aggs)
    fields = ["column_name", "min_value", "max_value", "n_non_null"]
    if approx_distinct:
        fields.append("approx_distinct")
    args = []
    for i, c in enumerate(cols):
        args += [f"'{c}'", f"mn{i}", f"mx{i}", f"nn{i}"] + ([f"ad{i}"] if approx_distinct else [])
    stack = f"stack({len(cols)}, {', '.join(args)}) AS ({', '.join(fields)})"
    return wide.selectExpr(stack)


# ---------------------------------------------------------- months (B16/H9)

def month_range(spark, start: str, n: int, col: str = PERIOD) -> DataFrame:
    """n consecutive periods starting at ``start`` ('yyyy-MM-01')."""
    days = spark.range(1).select(F.explode(F.sequence(
        F.to_date(F.lit(start)), F.add_months(F.to_date(F.lit(start)), n - 1),
        F.expr("INTERVAL 1 MONTH"))).alias("_d"))
    return days.select(F.col("_d").cast("string").alias(col))


def month_scope(fact: DataFrame, registered: DataFrame, on: Sequence[str] = ("ins_id", PERIOD)
                ) -> tuple[DataFrame, DataFrame]:
    """Restrict a fact to the institutions registered for its month.

    Returns (rows in scope, registered keys without any fact row)."""
    keys = registered.select(*on).distinct()
    in_scope = semi_join(fact, keys, list(on))
    fact_keys = fact.select(*on).distinct()
    missing = keys.join(fact_keys, list(on), "left_anti")
    return in_scope, missing


def month_prefix(df: DataFrame, rule_results: DataFrame, period_col: str = PERIOD,
                 passed_col: str = "passed") -> DataFrame:
    """Mass reprocessing: keep the periods before the first failing period.

    ``rule_results`` has one or more rows per period with a boolean
    ``passed``.  The cut-off is a scalar subquery (one global aggregate over
    the bounded rule results), so nothing is collected to the driver."""
    first_fail = (rule_results.where(~F.coalesce(F.col(passed_col), F.lit(False)))
                  .select(F.min(period_col)).scalar())
    return df.where(F.col(period_col) < F.coalesce(first_fail, F.lit("9999-12-31")))
