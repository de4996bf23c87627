"""Registered queries: one per operator of the inventory, each over the
whole fixture tables of ``sf_dir``.  ``oracle.py`` holds the matching SQL."""

from __future__ import annotations

import dataclasses as _dc
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadra.functions.expressions import decimal_comma
from cuadra.operators import analytics as A
from cuadra.operators import mapping as M
from cuadra.operators import profiles as PR
from cuadra.operators import quality as Q
from cuadra.operators.joins import join_dimension
from cuadra.plans import fixtures as X
from cuadra.plans import jobs as JB
from cuadra.plans import raws as RW
from cuadra.plans import staging as ST
from cuadra.plans import tables as TB
from cuadra.plans.measures import DERIVED, MEASURES
from cuadra.session import shared_dir
from cuadra.sinks import bucketed as BK
from cuadra.sinks import tables as SK
from cuadra.sources import layouts as L
from cuadra.sources import text as TX
from cuadra.specs import ColumnSpec, ForeignKey, Rule, Severity

Query = Callable[[SparkSession, str], DataFrame]


def q_mgmt_indicators(spark: SparkSession, sf: str) -> DataFrame:
    fact = X.statement_fact(X.table(spark, sf, "lineitem"))
    accounts = X.accounts(X.table(spark, sf, "part"))
    return A.management_indicators(fact, accounts, MEASURES, DERIVED)


def q_unify_sources(spark: SparkSession, sf: str) -> DataFrame:
    return X.statement_fact_union(X.table(spark, sf, "lineitem"))


def q_month_compare(spark: SparkSession, sf: str) -> DataFrame:
    fact = X.statement_fact(X.table(spark, sf, "lineitem"))
    out = A.month_compare(fact, ["ins_id", "planCuenta_id"])
    return out.select("periodo_mes", "ins_id", "planCuenta_id",
                      F.col("eerr_Monto_Act").try_cast(A.AMOUNT_TYPE).alias("eerr_Monto_Act"),
                      F.col("eerr_Monto_Ant").try_cast(A.AMOUNT_TYPE).alias("eerr_Monto_Ant"))


def q_ytd_to_month(spark: SparkSession, sf: str) -> DataFrame:
    fact = X.statement_fact(X.table(spark, sf, "lineitem"))
    out = A.ytd_to_month(fact, ["ins_id", "planCuenta_id"])
    return out.select("periodo_mes", "ins_id", "planCuenta_id",
                      F.col("monto_mes").try_cast(A.AMOUNT_TYPE).alias("monto_mes"))


QUERIES: dict[str, Query] = {
    "mgmt_indicators": q_mgmt_indicators,
    "unify_sources": q_unify_sources,
    "month_compare": q_month_compare,
    "ytd_to_month": q_ytd_to_month,
}


# ----------------------------------------------------------- data quality


# Test parameters (ours, not reference values): bounds that cut through the
# fixture distributions so that both outcomes occur.
ORDER_RANGES = (
    ColumnSpec("o_totalprice", "double", min_value="0", max_value="450000"),
    ColumnSpec("o_orderdate", "timestamp_ntz", min_datetime="1995-01-01 00:00:00",
               max_datetime="2000-12-31 23:59:59"),
)
CUSTOMER_PATTERNS = (
    ColumnSpec("c_name", regex="^Customer#[0-9]{9}$"),
    ColumnSpec("c_mktsegment", regex="^(AUTOMOBILE|BUILDING|FURNITURE)$"),
)
TOLERANT_RULE = Rule("DQ_CuentaCorta_tol", "length(planCuenta_Nombre) <= 10", severity=Severity.WARNING,
                     error_code=1, column="planCuenta_Nombre", tolerance_rows=10, tolerance_share=0.2)
# Rows per statement file by origin, and the aggregate rules of
# the indicators job (code 1: current month empty, code 2: previous month empty).
FILE_ROWS = {"B1": (10, 1000), "R1": (10, 1000), "C1": (10, 1000), "C2": (1, 1000)}
COMPARE_RULES = (
    Rule("sum_act", "sum(eerr_Monto_Act) > 0", level="aggregate", error_code=1),
    Rule("sum_ant", "sum(eerr_Monto_Ant) > 0", level="aggregate", error_code=2),
)


def _t(spark, sf, name):
    return X.table(spark, sf, name)


def _fact(spark, sf):
    return X.statement_fact(_t(spark, sf, "lineitem"))


def _accounts(spark, sf):
    return TB.governed_accounts(_t(spark, sf, "part"))


def _account_refs(spark, sf):
    part = _t(spark, sf, "part")
    return {"negocio": TB.business_lines(part), "producto": TB.products(part)}


def _labelled(df: DataFrame, table: str) -> DataFrame:
    return df.select(F.lit(table).alias("table_name"), *df.columns)


def q_pk_violations(spark, sf):
    return Q.duplicate_keys(_fact(spark, sf).select(*TB.STATEMENT.pk), TB.STATEMENT.pk)


def q_not_null(spark, sf):
    return Q.null_report(_accounts(spark, sf), TB.ACCOUNT)


def q_len_rule(spark, sf):
    parts = []
    for name, df, spec in (("account", _accounts(spark, sf), TB.ACCOUNT),
                           ("institution", X.institutions(_t(spark, sf, "supplier")), TB.INSTITUTION)):
        checks = [c for col in spec.columns for c in Q.column_checks(col) if c.rule_type in ("min_len", "max_len")]
        parts.append(_labelled(Q.evaluate_row_checks(df, checks), name))
    return parts[0].unionByName(parts[1])


def q_row_rule(spark, sf):
    return Q.evaluate_row_checks(_accounts(spark, sf), [Q.sql_check(r) for r in TB.ACCOUNT.rules])


def q_tolerance(spark, sf):
    return Q.evaluate_row_checks(_accounts(spark, sf), [Q.sql_check(TOLERANT_RULE)])


def q_range_rules(spark, sf):
    checks = [c for col in ORDER_RANGES for c in Q.column_checks(col) if c.rule_type != "not_null"]
    return Q.evaluate_row_checks(_t(spark, sf, "orders"), checks)


def q_regex_rule(spark, sf):
    checks = [c for col in CUSTOMER_PATTERNS for c in Q.column_checks(col) if c.rule_type == "regex"]
    return Q.evaluate_row_checks(_t(spark, sf, "customer"), checks)


def q_unique_rule(spark, sf):
    return Q.pk_check(_t(spark, sf, "part"), ["p_name"], rule_id="p_name:unique", rule_type="unique",
                      ignore_nulls=True, external_code="COD_ERROR")


def q_one_value(spark, sf):
    return Q.one_value(_fact(spark, sf), list(TB.STATEMENT.one_value_partitions))


def q_row_count_interval(spark, sf):
    counted = Q.row_count_interval(_fact(spark, sf), None, None, by=["periodo_mes", "ins_id", "eerr_origen"])
    ok = None
    for origin, (lo, hi) in FILE_ROWS.items():
        cond = F.col("n_rows").between(lo, hi)
        ok = F.when(F.col("eerr_origen") == origin, cond) if ok is None else ok.when(F.col("eerr_origen") == origin, cond)
    return counted.withColumn("passed", ok.otherwise(F.lit(False)))


def _compare(spark, sf):
    return A.month_compare(_fact(spark, sf), ["ins_id", "planCuenta_id"])


def q_agg_rule(spark, sf):
    return Q.aggregate_rules(_compare(spark, sf), COMPARE_RULES, by=["periodo_mes"])


def q_dq_summary(spark, sf):
    return Q.first_error(Q.aggregate_rules(_compare(spark, sf), COMPARE_RULES, by=["periodo_mes"]),
                         by=["periodo_mes"])


def q_dq_details(spark, sf):
    res = Q.check(_accounts(spark, sf), TB.ACCOUNT, _account_refs(spark, sf), detail_cols=["planCuenta_id"])
    return res.details


def q_fk_single(spark, sf):
    fk = ForeignKey("institution", (("ins_id", "ins_id"),))
    return Q.fk_violation_keys(_fact(spark, sf), TB.registered_institutions(_t(spark, sf, "supplier")), fk)


def q_fk_composite(spark, sf):
    fk = TB.STATEMENT.foreign_keys[0]
    reg = TB.institution_month(_t(spark, sf, "lineitem"), _t(spark, sf, "orders"), _t(spark, sf, "supplier"))
    return Q.fk_violation_keys(_fact(spark, sf), reg, fk)


def q_fk_nullable(spark, sf):
    acct, refs = _accounts(spark, sf), _account_refs(spark, sf)
    a, b = [Q.fk_check(acct, refs[fk.ref], fk) for fk in TB.ACCOUNT.foreign_keys]
    return a.unionByName(b)


def q_warning_exclude(spark, sf):
    return Q.exclude_warnings(_accounts(spark, sf), TB.ACCOUNT, _account_refs(spark, sf))


def q_new_record_cap(spark, sf):
    current = TB.accounts_seen_before(_t(spark, sf, "lineitem"), _t(spark, sf, "part"), "1998-01-01")
    return Q.new_record_check(_accounts(spark, sf), current, ["planCuenta_id"], None, 0.2)


QUERIES.update({
    "pk_violations": q_pk_violations,
    "not_null": q_not_null,
    "len_rule": q_len_rule,
    "row_rule": q_row_rule,
    "tolerance": q_tolerance,
    "range_rules": q_range_rules,
    "regex_rule": q_regex_rule,
    "unique_rule": q_unique_rule,
    "one_value": q_one_value,
    "row_count_interval": q_row_count_interval,
    "agg_rule": q_agg_rule,
    "dq_summary": q_dq_summary,
    "dq_details": q_dq_details,
    "fk_single": q_fk_single,
    "fk_composite": q_fk_composite,
    "fk_nullable": q_fk_nullable,
    "warning_exclude": q_warning_exclude,
    "new_record_cap": q_new_record_cap,
})


# ------------------------------------------------------------ text sources


def _land(spark, sf, kind):
    return ST.landing(spark, sf, kind)


def _kinds():
    """The statements' layouts; the staged extract keeps each kind in a folder of its own."""
    return {o: _dc.replace(raw, template=f"{o.lower()}/{raw.template}") for o, raw in RW.STATEMENTS.items()}


def _file_keys(df: DataFrame, origin: str) -> list:
    return [TX.file_period().alias("periodo_mes"), F.col("Cod_Banco").alias("ins_id"),
            F.lit(origin).alias("eerr_origen")]


KEYS_OF_FILE = [TX.FILE, "YYYY", "MM", "Cod_Banco"]


def _headers(spark, sf, origin):
    raw = _kinds()[origin]
    lines = TX.raw_lines(_land(spark, sf, "stmt"), raw)
    return lines, TX.header_records(lines, raw.settings[0].header_fields, keys=KEYS_OF_FILE)


def _all_kinds(part):
    return reduce(lambda a, b: a.unionByName(b), [part(o) for o in RW.STATEMENTS])


def q_decimal_comma(spark, sf):
    return X.statement_fact_union(_t(spark, sf, "lineitem"), as_text=True)


def q_scan_by_template(spark, sf):
    branches = []
    for origin, raw in _kinds().items():
        data = TX.scan_raw(_land(spark, sf, "stmt"), raw).data
        amounts = [c for c in data.columns if "_Monto" in c]
        shaped = data.select(*_file_keys(data, origin)[:2], "planCuenta_id", *amounts)
        branches.append(A.statement_branch(shaped, origin, components=amounts) if len(amounts) == 4
                        else A.statement_branch(shaped, origin, total=amounts[0]))
    return A.unify_sources(branches)


def q_header_records(spark, sf):
    def part(origin):
        _, hdr = _headers(spark, sf, origin)
        return hdr.select(*_file_keys(hdr, origin), "codigo", "banco")
    return _all_kinds(part)


def q_drop_header(spark, sf):
    def part(origin):
        lines, hdr = _headers(spark, sf, origin)
        kept = TX.drop_header(lines, hdr)
        return (kept.groupBy("YYYY", "MM", "Cod_Banco").agg(F.count(F.lit(1)).alias("n_rows"))
                .select(*_file_keys(kept, origin), "n_rows"))
    return _all_kinds(part)


def q_header_code_check(spark, sf):
    def part(origin):
        _, hdr = _headers(spark, sf, origin)
        return hdr.select(*_file_keys(hdr, origin), "codigo", (F.col("codigo") == F.col("Cod_Banco")).alias("passed"))
    return _all_kinds(part)


def q_header_row_count(spark, sf):
    parts = []
    for origin in ("C1", "C2"):
        lines, hdr = _headers(spark, sf, origin)
        counted = TX.drop_header(lines, hdr).groupBy(TX.FILE).agg(F.count(F.lit(1)).alias("actual"))
        joined = hdr.join(counted, TX.FILE, "left")
        declared = F.col("filas").try_cast("bigint")
        parts.append(joined.select(*_file_keys(joined, origin), declared.alias("declared"),
                                   F.coalesce("actual", F.lit(0)).alias("actual"),
                                   F.coalesce(declared == F.col("actual"), F.lit(False)).alias("passed")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def q_row_shape_filter(spark, sf):
    rows = TX.scan_raw(_land(spark, sf, "codifis"), RW.CODIFIS, shape="default").data
    return rows.select(TX.file_period().alias("periodo_mes"), F.col("institucion_id").alias("ins_id"),
                       F.col("institucion_nombre").alias("ins_nombre"))


def q_period_check(spark, sf):
    data = TX.scan_raw(_land(spark, sf, "plan"), RW.PLAN_CTAS).data
    prof = data.groupBy("YYYY", "MM").agg(
        F.min("ano").alias("min_ano"), F.max("ano").alias("max_ano"),
        F.min("mes").alias("min_mes"), F.max("mes").alias("max_mes"), F.count(F.lit(1)).alias("n_rows"))
    y, m = F.col("YYYY").cast("int"), F.col("MM").cast("int")
    ok = (F.col("min_ano") == y) & (F.col("max_ano") == y) & (F.col("min_mes") == m) & (F.col("max_mes") == m)
    return prof.select(TX.file_period().alias("periodo_mes"), "min_ano", "max_ano", "min_mes", "max_mes",
                       "n_rows", F.coalesce(ok, F.lit(False)).alias("passed"))


def q_scan_semicolon(spark, sf):
    data = TX.scan_raw(_land(spark, sf, "asigna"), RW.ASIGNA, period=F.lit(RW.REF_START)).data
    return data.select("planCuenta_id", F.nullif("producto_id", F.lit("")).alias("producto_id"),
                       F.nullif("negocio_id", F.lit("")).alias("negocio_id"),
                       F.nullif("concepto", F.lit("")).alias("planCuenta_Concepto"))


def _orders_from(data: DataFrame) -> DataFrame:
    return data.select("o_orderkey", "o_custkey", "o_orderstatus",
                       decimal_comma("o_totalprice").alias("o_totalprice"), "o_orderdate", "o_orderpriority")


def q_scan_delimited(spark, sf):
    return _orders_from(TX.scan_raw(_land(spark, sf, "orders_tab"), RW.ORDERS).data)


def q_scan_fixed_width(spark, sf):
    return _orders_from(TX.scan_raw(_land(spark, sf, "orders_fixed"), RW.ORDERS_BY_POSITION).data)


def q_settings_as_of(spark, sf):
    files = _fact(spark, sf).select("periodo_mes", "ins_id", "eerr_origen").distinct()
    settings = reduce(lambda a, b: a.unionByName(b),
                       [L.settings_frame(spark, raw) for raw in RW.OVERLAPPING.values()])
    return L.settings_as_of(files, settings, keys=["ins_id", "eerr_origen"], name_col="eerr_origen")


def q_scan_two_layouts(spark, sf):
    """One scan over files whose columns change order and separator on a date."""
    data = TX.scan_raw(_land(spark, sf, "two_layouts"), RW.TWO_LAYOUTS).data
    amounts = [c for c in data.columns if "_Monto" in c]
    shaped = data.select(TX.file_period().alias("periodo_mes"), "ins_id", "planCuenta_id", *amounts)
    return A.statement_branch(shaped, "B1", components=amounts)


def q_rejected_lines(spark, sf):
    """Lines that the orders' layout can't take: short ones, and those of Latin-1 files that
    are no UTF-8; each with its file, line and bytes."""
    rejects = TX.scan_raw(_land(spark, sf, "orders_damaged"), RW.ORDERS).rejects
    return rejects.select(TX.file_period().alias("periodo_mes"), F.col("NUM").alias("lote"), F.col("_line").alias("line"),
                          F.col("_reason").alias("reason"), "content")


def q_file_inventory(spark, sf):
    """Every statement file by kind, month and bank with its size, from one listing."""
    files = TX.inventory(_land(spark, sf, "stmt"), _kinds())
    return files.select(F.col("raw_name").alias("eerr_origen"), TX.file_period().alias("periodo_mes"),
                        F.col("Cod_Banco").alias("ins_id"), F.col("length").alias("n_bytes"))


QUERIES.update({
    "decimal_comma": q_decimal_comma,
    "scan_by_template": q_scan_by_template,
    "header_records": q_header_records,
    "drop_header": q_drop_header,
    "header_code_check": q_header_code_check,
    "header_row_count": q_header_row_count,
    "row_shape_filter": q_row_shape_filter,
    "period_check": q_period_check,
    "scan_semicolon": q_scan_semicolon,
    "scan_delimited": q_scan_delimited,
    "scan_fixed_width": q_scan_fixed_width,
    "settings_as_of": q_settings_as_of,
    "scan_two_layouts": q_scan_two_layouts,
    "rejected_lines": q_rejected_lines,
    "file_inventory": q_file_inventory,
})


# ------------------------------------------------------------ write modes


# Fixed for determinism: when and by whom the loads below ran.
CHANGED_AT = "2024-01-31 00:00:00"
DIM_CUTOFF = "1998-01-01"          # the dimension as loaded before 1998
BATCH_FROM = "1999-01-01"          # statement batch replacing later periods
# The fixture has 100-1000 banks a month; the per-bank second partition level
# of the statement table would make one folder per bank and month, so these
# write queries partition by period only.
STATEMENT_BY_PERIOD = _dc.replace(TB.STATEMENT, partition_cols=("periodo_mes",))


def _accounts_before(spark, sf):
    return TB.accounts_seen_before(_t(spark, sf, "lineitem"), _t(spark, sf, "part"), DIM_CUTOFF)


def _chart_1998(spark, sf):
    """Accounts with statements in 1998, names as that year's chart spells
    them (upper case)."""
    li = _t(spark, sf, "lineitem")
    seen = (li.where((F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
                     & (F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")))
            .select(F.col("l_partkey").alias("p_partkey")).distinct())
    part = _t(spark, sf, "part").join(seen, "p_partkey", "left_semi")
    return part.select(X.padded_code("p_partkey", 7).alias("planCuenta_id"),
                       F.upper("p_name").alias("planCuenta_Nombre"))


def _load_v1(spark, sf, name):
    path = shared_dir(spark, name)
    SK.save_version(_accounts_before(spark, sf), TB.ACCOUNT, path)
    return path, SK.read_table(spark, TB.ACCOUNT, path)


def _upserted(spark, sf):
    path, v1 = _load_v1(spark, sf, "upsert_full")
    merged = SK.upsert_full(v1, _chart_1998(spark, sf), TB.ACCOUNT, ["planCuenta_id", "planCuenta_Nombre"],
                            CHANGED_AT, "upsert_full")
    SK.save_version(merged, TB.ACCOUNT, path)
    return path, v1, SK.read_table(spark, TB.ACCOUNT, path)


def q_partition_replace(spark, sf):
    fact = _fact(spark, sf)
    path = shared_dir(spark, "partition_replace")
    SK.partition_replace(fact.where(F.col("eerr_origen").isin("B1", "R1")), STATEMENT_BY_PERIOD, path)
    batch = fact.where(F.col("eerr_origen").isin("C1", "C2") & (F.col("periodo_mes") >= BATCH_FROM))
    return SK.partition_replace(batch, STATEMENT_BY_PERIOD, path)


def q_upsert_full(spark, sf):
    _, _, v2 = _upserted(spark, sf)
    return v2.select(*TB.ACCOUNT.names)


def q_change_tracking(spark, sf):
    _, _, v2 = _upserted(spark, sf)
    return v2.select(*TB.ACCOUNT.pk, *[n for n, _ in SK.tracking_columns(TB.ACCOUNT)])


def q_change_trace(spark, sf):
    _, v1, v2 = _upserted(spark, sf)
    return SK.change_trace(v1, v2, TB.ACCOUNT, CHANGED_AT, "upsert_full")


def q_backup_versions(spark, sf):
    path, _, _ = _upserted(spark, sf)
    return SK.version_counts(spark, TB.ACCOUNT, path)


def q_selective_update(spark, sf):
    path = shared_dir(spark, "selective_update")
    loaded = _accounts_before(spark, sf).select(
        "planCuenta_id", "planCuenta_Nombre", *[F.lit(None).cast("string").alias(c)
                                                for c in ("negocio_id", "producto_id", "planCuenta_Concepto")])
    SK.save_version(loaded, TB.ACCOUNT, path)
    v1 = SK.read_table(spark, TB.ACCOUNT, path)
    assignment = X.accounts(_t(spark, sf, "part"))
    updated, _ = SK.selective_update(v1, assignment, TB.ACCOUNT,
                                     ["producto_id", "negocio_id", "planCuenta_Concepto"],
                                     CHANGED_AT, "selective_update")
    SK.save_version(updated, TB.ACCOUNT, path)
    return SK.read_table(spark, TB.ACCOUNT, path).select(*TB.ACCOUNT.names)


def q_insert_only(spark, sf):
    path, v1 = _load_v1(spark, sf, "insert_only")
    SK.save_version(SK.insert_only(v1, _accounts(spark, sf), TB.ACCOUNT), TB.ACCOUNT, path)
    return SK.read_table(spark, TB.ACCOUNT, path).select(*TB.ACCOUNT.names)


def q_update_only(spark, sf):
    path, v1 = _load_v1(spark, sf, "update_only")
    renamed = _accounts(spark, sf).select("planCuenta_id", F.upper("planCuenta_Nombre").alias("planCuenta_Nombre"))
    SK.save_version(SK.update_only(v1, renamed, TB.ACCOUNT, ["planCuenta_Nombre"], CHANGED_AT, "update_only"),
                    TB.ACCOUNT, path)
    return SK.read_table(spark, TB.ACCOUNT, path).select(*TB.ACCOUNT.names)


QUERIES.update({
    "partition_replace": q_partition_replace,
    "upsert_full": q_upsert_full,
    "change_tracking": q_change_tracking,
    "change_trace": q_change_trace,
    "backup_versions": q_backup_versions,
    "selective_update": q_selective_update,
    "insert_only": q_insert_only,
    "update_only": q_update_only,
})


# ------------------------------------------------- mapping and analytics


DEFAULTED_ACCOUNT = _dc.replace(TB.ACCOUNT, columns=tuple(
    _dc.replace(c, default={"negocio_id": "'SIN_NEGOCIO'", "producto_id": "'SIN_PRODUCTO'",
                            "planCuenta_Concepto": "'SIN_CONCEPTO'"}.get(c.name))
    for c in TB.ACCOUNT.columns))
# Test parameters (ours): scope of the parameterised SQL query.
SQL_TEXT = """SELECT periodo_mes, eerr_origen, count(*) AS n_rows,
                     CAST(sum(eerr_Monto) AS DECIMAL(26,2)) AS eerr_Monto
              FROM {fact}
              WHERE eerr_Monto >= :min_amount AND eerr_origen IN (:o1, :o2, :o3, :o4)
              GROUP BY periodo_mes, eerr_origen"""
# Test parameter (ours): a month needs this share of the fullest month's rows.
MONTH_SHARE = 0.25


def _raw_institutions(supplier: DataFrame) -> DataFrame:
    """The institution list as read from the raw file: text columns with the
    file's own names."""
    return supplier.select(X.padded_code("s_suppkey", 3).alias("institucion_id"),
                           F.col("s_name").alias("institucion_nombre"), "s_acctbal")


def q_map_columns(spark, sf):
    raw = _raw_institutions(_t(spark, sf, "supplier"))
    return M.map_columns(raw, TB.INSTITUTION, {"ins_id": "institucion_id", "ins_nombre": "institucion_nombre"})


def q_auto_map(spark, sf):
    raw = _raw_institutions(_t(spark, sf, "supplier"))
    src = raw.select(F.col("institucion_id").alias("INS_ID"), F.col("institucion_nombre").alias("Ins_Nombre"),
                     "s_acctbal")
    return M.auto_map(src, TB.INSTITUTION)


def q_default_values(spark, sf):
    acct = _accounts(spark, sf)
    return M.map_columns(acct, DEFAULTED_ACCOUNT, {"planCuenta_id": "planCuenta_id",
                                                   "planCuenta_Nombre": "planCuenta_Nombre",
                                                   "negocio_id": "negocio_id", "producto_id": "producto_id"})


def q_month_snapshot(spark, sf):
    """Accounts per month: the monthly chart (ano, mes, id, name) made
    distinct, with the period built from year and month, auto-mapped."""
    li = _t(spark, sf, "lineitem")
    used = li.select(F.year("l_shipdate").alias("ano"), F.month("l_shipdate").alias("mes"),
                     F.col("l_partkey").alias("p_partkey")).distinct()
    part = _t(spark, sf, "part").select("p_partkey", "p_name")
    chart = join_dimension(used, part, "p_partkey").select(
        "ano", "mes", X.padded_code("p_partkey", 7).alias("planCuenta_id"),
        F.col("p_name").alias("planCuenta_Nombre"))
    snap = chart.select(F.make_date("ano", "mes", F.lit(1)).cast("string").alias("periodo_mes"), "ano", "mes",
                        "planCuenta_id", "planCuenta_Nombre").distinct()
    return M.auto_map(snap, TB.ACCOUNT_MONTH)


def _registry(spark, sf):
    return TB.institution_month(_t(spark, sf, "lineitem"), _t(spark, sf, "orders"), _t(spark, sf, "supplier"))


def q_month_scope(spark, sf):
    in_scope, _ = A.month_scope(_fact(spark, sf), _registry(spark, sf))
    return in_scope


def q_month_scope_missing(spark, sf):
    _, missing = A.month_scope(_fact(spark, sf), _registry(spark, sf))
    return missing


def q_sql_text(spark, sf):
    return spark.sql(SQL_TEXT, args={"min_amount": 0, "o1": "B1", "o2": "R1", "o3": "C1", "o4": "C2"},
                     fact=_fact(spark, sf))


def q_profile_columns(spark, sf):
    return A.profile_columns(_t(spark, sf, "orders"), approx_distinct=False)


def q_month_prefix(spark, sf):
    """Mass reprocessing over every month of orders: keep the months before
    the first month with less than its share of the fullest month's rows."""
    monthly = (_t(spark, sf, "orders").groupBy(X.period_of("o_orderdate").alias("periodo_mes"))
               .agg(F.count(F.lit(1)).alias("n_orders"),
                    F.sum(F.col("o_totalprice").cast("decimal(23,2)")).cast("decimal(26,2)").alias("total")))
    # one row per month: the comparison runs on the bounded aggregate
    fullest = monthly.agg(F.max("n_orders").alias("most"))
    rules = monthly.join(fullest).select("periodo_mes", (F.col("n_orders") >= MONTH_SHARE * F.col("most")).alias("passed"))
    return A.month_prefix(monthly, rules)


QUERIES.update({
    "map_columns": q_map_columns,
    "auto_map": q_auto_map,
    "default_values": q_default_values,
    "month_snapshot": q_month_snapshot,
    "month_scope": q_month_scope,
    "month_scope_missing": q_month_scope_missing,
    "sql_text": q_sql_text,
    "profile_columns": q_profile_columns,
    "month_prefix": q_month_prefix,
})


def _narrow_orders_spec():
    """Test parameter (ours): orders mapped onto a narrower declared price
    type, so that prices of 100000 and more do not fit."""
    from cuadra.specs import TableKind, TableSpec
    return TableSpec("orders_narrow", TableKind.TRANSACTION, (
        ColumnSpec("o_orderkey", "bigint", pk=True), ColumnSpec("o_totalprice", "decimal(7,2)"),
        ColumnSpec("o_orderdate", "date"), ColumnSpec("o_orderpriority")))


def q_lost_in_cast(spark, sf):
    spec = _narrow_orders_spec()
    return M.cast_losses(_t(spark, sf, "orders"), spec, {c.name: c.name for c in spec.columns})


#: Parts of the stored profiles that are written by a second load.
PROFILE_SPLIT = "1998-07-01"
#: Stated errors: of a distinct count (four standard errors), and of a quantile's rank.
DISTINCT_ERROR, RANK_ERROR = 0.032, 0.01


def q_profile_merge(spark, sf):
    """Profiles of orders by month, stored in two loads and merged, beside exact counts: is
    each estimate within its stated error?"""
    orders = _t(spark, sf, "orders").withColumn("periodo_mes", X.period_of("o_orderdate"))
    path = shared_dir(spark, "profiles")
    for part in (orders.where(F.col("periodo_mes") < PROFILE_SPLIT), orders.where(F.col("periodo_mes") >= PROFILE_SPLIT)):
        PR.store_profiles(part, "periodo_mes", path)
    merged = PR.merge_profiles(PR.read_profiles(spark, "periodo_mes", path))
    names = [c for c in orders.columns if c != "periodo_mes"]
    exact = orders.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("_v")) for c in names]))) \
        .distinct().groupBy("column_name").agg(F.count("_v").alias("n_distinct"))
    # where the estimated median stands among the rows
    medians = {c: merged.where(F.col("column_name") == c).select(F.max("approx_q50")).scalar() for c in ("o_totalprice", "o_orderkey")}
    ranks = orders.agg(*[F.avg((F.col(c).cast("double") <= m).cast("double")).alias(c) for c, m in medians.items()])
    rank = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("_rank")) for c in medians]))
    rows = merged.join(exact, "column_name").join(ranks.select(rank), "column_name", "left")
    return rows.select("column_name", "n_rows", "n_non_null", "min_value", "max_value", "n_distinct",
                       (F.abs(F.col("approx_distinct") - F.col("n_distinct")) <= DISTINCT_ERROR * F.col("n_distinct")).alias("distinct_within"),
                       F.coalesce(F.abs(F.col("_rank") - 0.5) <= RANK_ERROR, F.lit(True)).alias("median_within"))


def _bucketed_fact(spark, sf):
    """The statement fact laid out by account, in as many buckets as shuffles have partitions
    or, of a larger fact, as its comparison has tasks."""
    fact = _fact(spark, sf)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), A.tasks_for(fact))
    return BK.read_bucketed(spark, BK.save_bucketed(fact, ["planCuenta_id"], shared_dir(spark, "bucketed"), buckets))


def q_month_compare_bucketed(spark, sf):
    out = A.month_compare(_bucketed_fact(spark, sf), ["ins_id", "planCuenta_id"], dealt=True)
    return out.select("periodo_mes", "ins_id", "planCuenta_id",
                      F.col("eerr_Monto_Act").try_cast(A.AMOUNT_TYPE).alias("eerr_Monto_Act"),
                      F.col("eerr_Monto_Ant").try_cast(A.AMOUNT_TYPE).alias("eerr_Monto_Ant"))


def q_fk_composite_bucketed(spark, sf):
    """Account and month of the bucketed fact against the accounts registered that month
    (planted: accounts ending in 7 are never registered)."""
    reg = (_t(spark, sf, "lineitem").where("l_partkey % 10 <> 7")
           .select(X.period_of("l_shipdate").alias("periodo_mes"), X.padded_code("l_partkey", 7).alias("planCuenta_id")).distinct())
    return Q.fk_violation_keys(_bucketed_fact(spark, sf), reg, TB.STATEMENT.foreign_keys[1])


QUERIES.update({
    "lost_in_cast": q_lost_in_cast,
    "profile_merge": q_profile_merge,
    "month_compare_bucketed": q_month_compare_bucketed,
    "fk_composite_bucketed": q_fk_composite_bucketed,
})

QUERIES.update(JB.QUERIES)
