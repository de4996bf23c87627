"""Independent SQL for every registered query, runnable by DuckDB on the
fixture tables (views ``lineitem``, ``part``, ``supplier``, ...).

The SQL follows the reference's own formulation (UNION ALL of the four
statements, one two-period aggregate per month, CASE pivots), not the
Spark plans, so a match checks the rewrites as well.
"""

from __future__ import annotations

AMT = "DECIMAL(26,2)"

# Fixed values, stated again here so that a wrong declaration in the library shows up as a
# difference: statement kind by return flag and line status, the columns of its amounts,
# the concepts by part size, and the indicators as SQL over the current and previous month.
ORIGINS = (("B1", "A", None), ("R1", "R", None), ("C1", "N", "F"), ("C2", "N", "O"))
COMPONENT_SOURCES = (("clp", "l_extendedprice"), ("ipc", "l_quantity"), ("tdc", "l_discount"), ("tdcb", "l_tax"))
CONCEPTS = ("COLOCACION", "COLOCACION_MORA90", "PROVISION_STOCK", "PROVISION", "CASTIGO", "RECUPERO",
            "INGRESO_INTERES", "GASTO_INTERES", "INGRESO_COMISION", "UTILIDAD_FINANCIERA")
_IN_YEAR = "CASE WHEN month(CAST(e.periodo_mes AS DATE)) > 1 THEN act - ant ELSE act END"
MEASURES = (
    ("gestion_colocacion_mes", "COLOCACION", "act"),
    ("gestion_colocacionMora90_mes", "COLOCACION_MORA90", "act"),
    ("gestion_provision_mes", "PROVISION_STOCK", "act - ant"),
    ("gestion_provision_Ano", "PROVISION", "act"),
    ("gestion_provisionStock", "PROVISION_STOCK", "act"),
    ("gestion_castigo_mes", "CASTIGO", _IN_YEAR),
    ("gestion_castigo_Ano", "CASTIGO", "act"),
    ("gestion_recupero_mes", "RECUPERO", _IN_YEAR),
    ("gestion_recupero_Ano", "RECUPERO", "act"),
    ("gestion_ingresoInteres_mes", "INGRESO_INTERES", "act"),
    ("gestion_gastoInteres_mes", "GASTO_INTERES", "act"),
    ("gestion_ingresoComision_mes", "INGRESO_COMISION", "act"),
    ("gestion_gastoComision_mes", "GASTO_INTERES", "act"),
    ("gestion_utilidadFinanciera_mes", "UTILIDAD_FINANCIERA", "act"),
)
DERIVED = (
    ("gestion_gastoRiesgo_mes", "gestion_provision_mes + gestion_castigo_mes - gestion_recupero_mes"),
    ("gestion_gastoRiesgo_Ano", "gestion_provision_Ano + gestion_castigo_Ano - gestion_recupero_Ano"),
)


def period_sql(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-01')"


def code_sql(c: str, width: int) -> str:
    text = f"CAST({c} AS VARCHAR)"
    return f"(repeat('0', greatest(0, {width} - length({text}))::INT) || {text})"


def prev_period_sql(p: str, months: int = -1) -> str:
    return f"strftime(CAST({p} AS DATE) + INTERVAL ({months}) MONTH, '%Y-%m-%d')"


def concept_sql(size: str = "p_size") -> str:
    whens = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CONCEPTS))
    return f"CASE {size} % 11 {whens} END"


def accounts_sql() -> str:
    return (f"SELECT {code_sql('p_partkey', 7)} AS planCuenta_id, p_name AS planCuenta_Nombre, "
            f"p_type AS negocio_id, p_brand AS producto_id, {concept_sql()} AS planCuenta_Concepto FROM part")


def institutions_sql() -> str:
    return f"SELECT {code_sql('s_suppkey', 3)} AS ins_id, s_name AS ins_nombre FROM supplier"


def _keys_sql() -> str:
    return (f"{period_sql('l_shipdate')} AS periodo_mes, {code_sql('l_suppkey', 3)} AS ins_id, "
            f"{code_sql('l_partkey', 7)} AS planCuenta_id")


def _where(flag: str, status: str | None) -> str:
    w = f"l_returnflag = '{flag}'"
    return w + (f" AND l_linestatus = '{status}'" if status else "")


def fact_sql() -> str:
    """The unified statement fact as the reference writes it: UNION ALL."""
    parts = []
    for code, flag, status in ORIGINS:
        if code in ("B1", "R1"):
            scaled = [f"CAST({src} AS DECIMAL(23,2)) * 1000000" for _, src in COMPONENT_SOURCES]
            comps = [f"CAST({s} AS {AMT}) AS eerr_Monto_{n}" for s, (n, _) in zip(scaled, COMPONENT_SOURCES)]
            total = f"CAST({' + '.join(scaled)} AS {AMT}) AS eerr_Monto"
        else:
            comps = [f"CAST(CAST(0 AS DECIMAL(23,2)) AS {AMT}) AS eerr_Monto_{n}" for n, _ in COMPONENT_SOURCES]
            total = f"CAST(CAST(l_extendedprice AS DECIMAL(23,2)) * 1000000 AS {AMT}) AS eerr_Monto"
        parts.append(f"SELECT {_keys_sql()}, '{code}' AS eerr_origen, {', '.join(comps)}, {total} "
                     f"FROM lineitem WHERE {_where(flag, status)}")
    return "\nUNION ALL\n".join(parts)


def compare_sql(keys: list[str], value: str = "eerr_Monto") -> str:
    """Per period P present in the fact: the reference's two-period aggregate."""
    k = ", ".join(f"f.{c}" for c in keys)
    return f"""
SELECT p.periodo_mes, {k},
       sum(CASE WHEN f.periodo_mes = p.periodo_mes THEN f.{value} ELSE 0 END) AS act,
       sum(CASE WHEN f.periodo_mes = {prev_period_sql('p.periodo_mes')} THEN f.{value} ELSE 0 END) AS ant
FROM (SELECT DISTINCT periodo_mes FROM fact) p
JOIN fact f ON f.periodo_mes IN (p.periodo_mes, {prev_period_sql('p.periodo_mes')})
GROUP BY p.periodo_mes, {k}"""


def mgmt_indicators_sql() -> str:
    measures = ",\n       ".join(f"sum(CASE WHEN a.planCuenta_Concepto = '{concept}' THEN {sql} ELSE 0 END) AS {name}"
                                for name, concept, sql in MEASURES)
    derived = ",\n       ".join(f"CAST(CAST({sql} AS DECIMAL(20,2)) AS {AMT}) AS {name}"
                                for name, sql in DERIVED)
    casts = ", ".join(f"CAST({name} AS {AMT}) AS {name}" for name, _, _ in MEASURES)
    return f"""
WITH fact AS ({fact_sql()}),
eerr AS ({compare_sql(['ins_id', 'planCuenta_id'])}),
acct AS ({accounts_sql()}),
calc AS (
SELECT e.periodo_mes, e.ins_id, a.producto_id, a.negocio_id,
       {measures}
FROM eerr e JOIN acct a ON e.planCuenta_id = a.planCuenta_id
WHERE a.planCuenta_Concepto IS NOT NULL
GROUP BY e.periodo_mes, e.ins_id, a.producto_id, a.negocio_id)
SELECT periodo_mes, ins_id, producto_id, negocio_id, {casts},
       {derived}
FROM calc"""


def unify_sources_sql() -> str:
    return fact_sql()


def month_compare_sql() -> str:
    return f"""
WITH fact AS ({fact_sql()}), c AS ({compare_sql(['ins_id', 'planCuenta_id'])})
SELECT periodo_mes, ins_id, planCuenta_id, CAST(act AS {AMT}) AS eerr_Monto_Act,
       CAST(ant AS {AMT}) AS eerr_Monto_Ant FROM c"""


def ytd_to_month_sql() -> str:
    return f"""
WITH fact AS ({fact_sql()}), c AS ({compare_sql(['ins_id', 'planCuenta_id'])})
SELECT periodo_mes, ins_id, planCuenta_id,
       CAST(CASE WHEN month(CAST(periodo_mes AS DATE)) > 1 THEN act - ant ELSE act END AS {AMT}) AS monto_mes
FROM c"""


# ----------------------------------------------------------- data quality

def _q(v):
    return "CAST(NULL AS VARCHAR)" if v is None else "'" + v + "'"


def _passed_sql(tol_rows=None, tol_share=None) -> str:
    if tol_rows is None and tol_share is None:
        return "n_bad = 0"
    fail = []
    if tol_rows is not None:
        fail.append(f"n_bad > {tol_rows}")
    if tol_share is not None:
        fail.append(f"(CASE WHEN n_rows > 0 THEN n_bad / n_rows ELSE 0.0 END) > {tol_share}")
    return "NOT (" + " OR ".join(fail) + ")"


def rules_sql(source: str, rules: list[tuple]) -> str:
    """rules: (rule_id, rule_type, column, error_code, external_code, severity,
    bad_predicate, tol_rows, tol_share) evaluated over ``source``."""
    parts = []
    for rid, rtype, col, code, ext, sev, bad, tr, ts in rules:
        parts.append(f"""SELECT {_q(rid)} AS rule_id, {_q(rtype)} AS rule_type, {_q(col)} AS column_name,
       CAST({code} AS INTEGER) AS error_code, {_q(ext)} AS external_code, {_q(sev)} AS severity,
       n_rows, n_bad, {_passed_sql(tr, ts)} AS passed
FROM (SELECT count(*) AS n_rows, count(*) FILTER (WHERE coalesce({bad}, false)) AS n_bad FROM ({source}))""")
    return "\nUNION ALL\n".join(parts)


def column_rules_sql(spec, types=None) -> list[tuple]:
    out = []
    for c in spec.columns:
        n = c.name
        cand = []
        if not c.nullable:
            cand.append((f"{n}:not_null", "not_null", None, f"{n} IS NULL"))
        if c.min_len is not None:
            cand.append((f"{n}:min_len", "min_len", c.min_len_code, f"length({n}) < {c.min_len}"))
        if c.max_len is not None:
            cand.append((f"{n}:max_len", "max_len", c.max_len_code, f"length({n}) > {c.max_len}"))
        if c.min_value is not None:
            cand.append((f"{n}:min_value", "min_value", None, f"{n} < {c.min_value}"))
        if c.max_value is not None:
            cand.append((f"{n}:max_value", "max_value", None, f"{n} > {c.max_value}"))
        if c.min_datetime is not None:
            cand.append((f"{n}:min_datetime", "min_datetime", None, f"{n} < TIMESTAMP '{c.min_datetime}'"))
        if c.max_datetime is not None:
            cand.append((f"{n}:max_datetime", "max_datetime", None, f"{n} > TIMESTAMP '{c.max_datetime}'"))
        if c.regex is not None:
            cand.append((f"{n}:regex", "regex", None, f"NOT regexp_matches({n}, '{c.regex}')"))
        for rid, rtype, ext, bad in cand:
            if types is None or rtype in types:
                out.append((rid, rtype, n, 0, ext, "ERROR", bad, None, None))
    return out


def sql_rule(r) -> tuple:
    return (r.rule_id, "row_sql", r.column, r.error_code, r.external_code, r.severity.value,
            f"NOT coalesce({r.expr}, false)", r.tolerance_rows, r.tolerance_share)


def governed_accounts_sql() -> str:
    return (f"SELECT planCuenta_id, planCuenta_Nombre, "
            f"CASE WHEN planCuenta_Concepto IS NOT NULL THEN negocio_id END AS negocio_id, "
            f"CASE WHEN planCuenta_Concepto IS NOT NULL THEN producto_id END AS producto_id, "
            f"planCuenta_Concepto FROM ({accounts_sql()})")


def _reg():
    from cuadra.plans import registry as R
    from cuadra.plans import tables as TB
    return R, TB


def pk_violations_sql() -> str:
    return f"""WITH fact AS ({fact_sql()})
SELECT periodo_mes, ins_id, planCuenta_id, count(*) AS n_rows FROM fact
GROUP BY periodo_mes, ins_id, planCuenta_id HAVING count(*) > 1"""


def not_null_sql() -> str:
    _, TB = _reg()
    parts = [f"SELECT '{c.name}' AS column_name, {str(c.nullable).lower()} AS nullable, count(*) AS n_rows, "
             f"count(*) FILTER (WHERE {c.name} IS NULL) AS n_null FROM acct" for c in TB.ACCOUNT.columns]
    return (f"WITH acct AS ({governed_accounts_sql()}), r AS ({' UNION ALL '.join(parts)}) "
            "SELECT column_name, nullable, n_rows, n_null, nullable OR n_null = 0 AS passed FROM r")


def len_rule_sql() -> str:
    _, TB = _reg()
    a = rules_sql(governed_accounts_sql(), column_rules_sql(TB.ACCOUNT, {"min_len", "max_len"}))
    i = rules_sql(institutions_sql(), column_rules_sql(TB.INSTITUTION, {"min_len", "max_len"}))
    return f"SELECT 'account' AS table_name, * FROM ({a}) UNION ALL SELECT 'institution' AS table_name, * FROM ({i})"


def row_rule_sql() -> str:
    _, TB = _reg()
    return rules_sql(governed_accounts_sql(), [sql_rule(r) for r in TB.ACCOUNT.rules])


def tolerance_sql() -> str:
    R, _ = _reg()
    return rules_sql(governed_accounts_sql(), [sql_rule(R.TOLERANT_RULE)])


def range_rules_sql() -> str:
    from cuadra.specs import TableKind, TableSpec
    R, _ = _reg()
    spec = TableSpec("orders", TableKind.REFERENCE, R.ORDER_RANGES)
    rules = [r for r in column_rules_sql(spec) if r[1] != "not_null"]
    return rules_sql("SELECT * FROM orders", rules)


def regex_rule_sql() -> str:
    from cuadra.specs import TableKind, TableSpec
    R, _ = _reg()
    spec = TableSpec("customer", TableKind.REFERENCE, R.CUSTOMER_PATTERNS)
    return rules_sql("SELECT * FROM customer", column_rules_sql(spec, {"regex"}))


def unique_rule_sql() -> str:
    return """SELECT 'p_name:unique' AS rule_id, 'unique' AS rule_type, 'p_name' AS column_name,
       CAST(0 AS INTEGER) AS error_code, 'COD_ERROR' AS external_code, 'ERROR' AS severity,
       n_rows, n_bad, n_bad = 0 AS passed
FROM (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows,
             CAST(coalesce(sum(CASE WHEN n > 1 THEN n ELSE 0 END), 0) AS BIGINT) AS n_bad
      FROM (SELECT p_name, count(*) AS n FROM part WHERE p_name IS NOT NULL GROUP BY p_name))"""


def one_value_sql() -> str:
    return f"""WITH fact AS ({fact_sql()})
SELECT 'periodo_mes' AS column_name, count(DISTINCT periodo_mes) AS n_distinct,
       count(DISTINCT periodo_mes) = 1 AS passed FROM fact
UNION ALL
SELECT 'ins_id', count(DISTINCT ins_id), count(DISTINCT ins_id) = 1 FROM fact"""


def row_count_interval_sql() -> str:
    R, _ = _reg()
    whens = " ".join(f"WHEN eerr_origen = '{o}' THEN n_rows BETWEEN {lo} AND {hi}"
                     for o, (lo, hi) in R.FILE_ROWS.items())
    return f"""WITH fact AS ({fact_sql()})
SELECT periodo_mes, ins_id, eerr_origen, n_rows, CASE {whens} ELSE false END AS passed
FROM (SELECT periodo_mes, ins_id, eerr_origen, count(*) AS n_rows FROM fact GROUP BY ALL)"""


def _agg_rules_sql() -> str:
    return f"""WITH fact AS ({fact_sql()}), eerr AS ({compare_sql(['ins_id', 'planCuenta_id'])}),
per AS (SELECT periodo_mes, sum(act) > 0 AS r1, sum(ant) > 0 AS r2 FROM eerr GROUP BY periodo_mes),
res AS (
SELECT periodo_mes, 'sum_act' AS rule_id, CAST(1 AS INTEGER) AS error_code, 'ERROR' AS severity,
       CAST(0 AS INTEGER) AS rule_order, coalesce(r1, false) AS passed FROM per
UNION ALL
SELECT periodo_mes, 'sum_ant', CAST(2 AS INTEGER), 'ERROR', CAST(1 AS INTEGER), coalesce(r2, false) FROM per)"""


def agg_rule_sql() -> str:
    return _agg_rules_sql() + "\nSELECT * FROM res"


def dq_summary_sql() -> str:
    return _agg_rules_sql() + """
SELECT periodo_mes, count(*) AS n_rules, count(*) FILTER (WHERE NOT passed) AS n_failed,
       arg_min(CASE WHEN NOT passed AND severity = 'ERROR' THEN error_code END,
               CASE WHEN NOT passed AND severity = 'ERROR' THEN rule_order END) AS error_code
FROM res GROUP BY periodo_mes"""


def dq_details_sql() -> str:
    _, TB = _reg()
    checks = column_rules_sql(TB.ACCOUNT) + [sql_rule(r) for r in TB.ACCOUNT.rules]
    parts = [f"SELECT '{r[0]}' AS rule_id, planCuenta_id FROM acct WHERE coalesce({r[6]}, false)" for r in checks]
    parts.append("SELECT 'pk' AS rule_id, planCuenta_id FROM acct WHERE planCuenta_id IN "
                 "(SELECT planCuenta_id FROM acct GROUP BY planCuenta_id HAVING count(*) > 1)")
    parts.append("SELECT 'fk:negocio_id->negocio', planCuenta_id FROM acct WHERE negocio_id IS NOT NULL "
                 "AND negocio_id NOT IN (SELECT p_type FROM part WHERE p_type <> 'PROMO')")
    parts.append("SELECT 'fk:producto_id->producto', planCuenta_id FROM acct WHERE producto_id IS NOT NULL "
                 "AND producto_id NOT IN (SELECT p_brand FROM part)")
    return f"WITH acct AS ({governed_accounts_sql()})\n" + "\nUNION ALL\n".join(parts)


def fk_single_sql() -> str:
    return f"""WITH fact AS ({fact_sql()})
SELECT ins_id, count(*) AS n_rows FROM fact
WHERE ins_id NOT IN (SELECT {code_sql('s_suppkey', 3)} FROM supplier WHERE s_acctbal >= 0)
GROUP BY ins_id"""


def fk_composite_sql() -> str:
    return f"""WITH fact AS ({fact_sql()}),
reg AS (SELECT DISTINCT {period_sql('o.o_orderdate')} AS periodo_mes, {code_sql('l.l_suppkey', 3)} AS ins_id
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT f.ins_id, f.periodo_mes, count(*) AS n_rows FROM fact f
WHERE NOT EXISTS (SELECT 1 FROM reg r WHERE r.ins_id = f.ins_id AND r.periodo_mes = f.periodo_mes)
GROUP BY f.ins_id, f.periodo_mes"""


def fk_nullable_sql() -> str:
    return f"""WITH acct AS ({governed_accounts_sql()})
SELECT 'fk:negocio_id->negocio' AS rule_id, 'fk' AS rule_type, 'negocio_id' AS column_name,
       CAST(0 AS INTEGER) AS error_code, 'ERROR_FK_NEGOCIO' AS external_code, 'WARNING_EXCLUDE' AS severity,
       count(*) AS n_rows,
       count(*) FILTER (WHERE negocio_id IS NOT NULL AND negocio_id NOT IN
                        (SELECT p_type FROM part WHERE p_type <> 'PROMO')) AS n_bad,
       n_bad = 0 AS passed
FROM acct
UNION ALL
SELECT 'fk:producto_id->producto', 'fk', 'producto_id', CAST(0 AS INTEGER), 'ERROR_FK_PRODUCTO', 'ERROR',
       count(*), count(*) FILTER (WHERE producto_id IS NOT NULL AND producto_id NOT IN (SELECT p_brand FROM part)),
       count(*) FILTER (WHERE producto_id IS NOT NULL AND producto_id NOT IN (SELECT p_brand FROM part)) = 0
FROM acct"""


def warning_exclude_sql() -> str:
    return f"""WITH acct AS ({governed_accounts_sql()})
SELECT * FROM acct
WHERE negocio_id IS NULL OR negocio_id IN (SELECT p_type FROM part WHERE p_type <> 'PROMO')"""


def new_record_cap_sql() -> str:
    return f"""WITH acct AS ({governed_accounts_sql()}),
seen AS (SELECT DISTINCT {code_sql('l_partkey', 7)} AS planCuenta_id FROM lineitem
         WHERE l_shipdate < TIMESTAMP '1998-01-01'),
b AS (SELECT DISTINCT planCuenta_id FROM acct),
c AS (SELECT count(*) AS n_rows,
             count(*) FILTER (WHERE planCuenta_id NOT IN (SELECT planCuenta_id FROM seen)) AS n_bad FROM b)
SELECT 'max_new_records' AS rule_id, 'max_new_records' AS rule_type, 'planCuenta_id' AS column_name,
       CAST(0 AS INTEGER) AS error_code, CAST(NULL AS VARCHAR) AS external_code, 'ERROR' AS severity,
       n_rows, n_bad, {_passed_sql(None, 0.2)} AS passed FROM c"""


# ------------------------------------------------------------ text sources

def _file_rows_sql() -> str:
    """(period, bank, origin) of every statement line, with the bank row."""
    origin = " ".join(f"WHEN {_where(f, st)} THEN '{c}'" for c, f, st in ORIGINS)
    return (f"SELECT {period_sql('l_shipdate')} AS periodo_mes, {code_sql('l_suppkey', 3)} AS ins_id, "
            f"CASE {origin} END AS eerr_origen, l_suppkey FROM lineitem")


def _header_code_sql() -> str:
    return "CASE WHEN s.s_acctbal < 0 THEN reverse(f.ins_id) ELSE f.ins_id END"


def decimal_comma_sql() -> str:
    return fact_sql()


def scan_by_template_sql() -> str:
    return fact_sql()


def header_records_sql() -> str:
    return f"""SELECT DISTINCT f.periodo_mes, f.ins_id, f.eerr_origen, {_header_code_sql()} AS codigo,
       s.s_name AS banco
FROM ({_file_rows_sql()}) f JOIN supplier s ON s.s_suppkey = f.l_suppkey WHERE f.eerr_origen IS NOT NULL"""


def drop_header_sql() -> str:
    return f"""SELECT periodo_mes, ins_id, eerr_origen, count(*) AS n_rows
FROM ({_file_rows_sql()}) WHERE eerr_origen IS NOT NULL GROUP BY ALL"""


def header_code_check_sql() -> str:
    return f"""SELECT DISTINCT f.periodo_mes, f.ins_id, f.eerr_origen, {_header_code_sql()} AS codigo,
       {_header_code_sql()} = f.ins_id AS passed
FROM ({_file_rows_sql()}) f JOIN supplier s ON s.s_suppkey = f.l_suppkey WHERE f.eerr_origen IS NOT NULL"""


def header_row_count_sql() -> str:
    return f"""SELECT periodo_mes, ins_id, eerr_origen, count(*) AS declared, count(*) AS actual, true AS passed
FROM ({_file_rows_sql()}) WHERE eerr_origen IN ('C1', 'C2') GROUP BY ALL"""


def row_shape_filter_sql() -> str:
    return f"""SELECT DISTINCT {period_sql('l.l_shipdate')} AS periodo_mes, {code_sql('l.l_suppkey', 3)} AS ins_id,
       s.s_name AS ins_nombre
FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey"""


def period_check_sql() -> str:
    return f"""WITH used AS (SELECT DISTINCT {period_sql('l_shipdate')} AS periodo_mes, l_partkey FROM lineitem),
rows AS (SELECT u.periodo_mes, CAST(year(CAST(u.periodo_mes AS DATE)) AS INTEGER) AS ano,
                CAST(month(CAST(u.periodo_mes AS DATE)) AS INTEGER) AS mes
         FROM used u JOIN part p ON p.p_partkey = u.l_partkey)
SELECT periodo_mes, min(ano) AS min_ano, max(ano) AS max_ano, min(mes) AS min_mes, max(mes) AS max_mes,
       count(*) AS n_rows,
       coalesce(min(ano) = year(CAST(periodo_mes AS DATE)) AND max(ano) = year(CAST(periodo_mes AS DATE))
                AND min(mes) = month(CAST(periodo_mes AS DATE)) AND max(mes) = month(CAST(periodo_mes AS DATE)),
                false) AS passed
FROM rows GROUP BY periodo_mes"""


def scan_semicolon_sql() -> str:
    return f"SELECT planCuenta_id, producto_id, negocio_id, planCuenta_Concepto FROM ({accounts_sql()})"


def _orders_sql() -> str:
    return ("SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(23,2)) AS o_totalprice, "
            "CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders")


def scan_delimited_sql() -> str:
    return _orders_sql()


def scan_fixed_width_sql() -> str:
    return _orders_sql()


def settings_as_of_sql() -> str:
    from cuadra.plans import raws as RW
    vals = ", ".join(f"('{raw.name}', {i}, '{st.start}', '{st.end}')"
                     for raw in RW.OVERLAPPING.values() for i, st in enumerate(raw.settings))
    return f"""WITH files AS (SELECT DISTINCT periodo_mes, ins_id, eerr_origen FROM ({_file_rows_sql()})
                WHERE eerr_origen IS NOT NULL),
settings(raw_name, setting_id, valid_from, valid_to) AS (VALUES {vals}),
m AS (SELECT f.periodo_mes, f.ins_id, f.eerr_origen, count(s.setting_id) AS n_settings,
             min(s.setting_id) AS first_id
      FROM files f LEFT JOIN settings s
        ON s.raw_name = f.eerr_origen AND f.periodo_mes BETWEEN s.valid_from AND s.valid_to
      GROUP BY ALL)
SELECT periodo_mes, ins_id, eerr_origen, CAST(CASE WHEN n_settings = 1 THEN first_id END AS INTEGER) AS setting_id,
       n_settings FROM m"""


def scan_two_layouts_sql() -> str:
    return f"SELECT * FROM ({fact_sql()}) WHERE eerr_origen = 'B1'"


def rejected_lines_sql() -> str:
    return """WITH l AS (
  SELECT *, strftime(o_orderdate, '%Y-%m-01') AS periodo_mes, substr(o_orderpriority, 1, 1) AS lote,
         o_orderkey || chr(9) || o_custkey || chr(9) || o_orderstatus || chr(9)
         || replace(CAST(CAST(o_totalprice AS DECIMAL(23,2)) AS VARCHAR), '.', ',') || chr(9) || strftime(o_orderdate, '%Y-%m-%d') AS five,
         o_orderkey % 97 = 0 AS short, o_orderpriority = '2-HIGH' AND o_custkey % 3 = 0 AS accent FROM orders),
n AS (SELECT *, row_number() OVER (PARTITION BY periodo_mes, lote ORDER BY o_orderkey) AS line FROM l)
SELECT periodo_mes, lote, line, CASE WHEN short THEN 'fields' ELSE 'encoding' END AS reason,
       base64(CASE WHEN short THEN encode(five) ELSE encode(five || chr(9) || o_orderpriority) || '\\xE9'::BLOB END) AS content
FROM n WHERE short OR accent"""


def file_inventory_sql() -> str:
    origin = " ".join(f"WHEN {_where(f, st)} THEN '{c}'" for c, f, st in ORIGINS)
    money = lambda c: f"length(CAST(CAST({c} AS DECIMAL(23,2)) AS VARCHAR))"
    return f"""WITH rows AS (
  SELECT {period_sql('l_shipdate')} AS periodo_mes, l_suppkey, CASE {origin} END AS eerr_origen,
         length({code_sql('l_partkey', 7)}) AS code, {money('l_extendedprice')} AS m1, {money('l_quantity')} AS m2,
         {money('l_discount')} AS m3, {money('l_tax')} AS m4 FROM lineitem),
files AS (SELECT eerr_origen, periodo_mes, l_suppkey, count(*) AS n,
                 sum(CASE WHEN eerr_origen IN ('B1', 'R1') THEN code + m1 + m2 + m3 + m4 + 5 ELSE code + m1 + 2 END) AS body
          FROM rows WHERE eerr_origen IS NOT NULL GROUP BY ALL)
SELECT f.eerr_origen, f.periodo_mes, {code_sql('f.l_suppkey', 3)} AS ins_id,
       CAST(body + length({code_sql('f.l_suppkey', 3)}) + length(s_name) + 2
            + CASE WHEN f.eerr_origen IN ('B1', 'R1') THEN 0 ELSE 1 + length(CAST(n AS VARCHAR)) END AS BIGINT) AS n_bytes
FROM files f JOIN supplier ON s_suppkey = f.l_suppkey"""


# ------------------------------------------------------------ write modes

_AT = "TIMESTAMP '2024-01-31 00:00:00'"


def _before_sql() -> str:
    return f"""SELECT * FROM ({governed_accounts_sql()}) WHERE planCuenta_id IN
  (SELECT {code_sql('l_partkey', 7)} FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01')"""


def _chart_1998_sql() -> str:
    return f"""SELECT {code_sql('p_partkey', 7)} AS planCuenta_id, upper(p_name) AS planCuenta_Nombre FROM part
WHERE p_partkey IN (SELECT l_partkey FROM lineitem
                    WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01')"""


def _upsert_sql() -> str:
    changed = ("t.planCuenta_id IS NOT NULL AND s.planCuenta_id IS NOT NULL "
               "AND s.planCuenta_Nombre IS DISTINCT FROM t.planCuenta_Nombre")
    return f"""WITH t AS ({_before_sql()}), s AS ({_chart_1998_sql()})
SELECT coalesce(t.planCuenta_id, s.planCuenta_id) AS planCuenta_id,
       CASE WHEN s.planCuenta_id IS NOT NULL THEN s.planCuenta_Nombre ELSE t.planCuenta_Nombre END AS planCuenta_Nombre,
       t.negocio_id, t.producto_id, t.planCuenta_Concepto,
       CASE WHEN {changed} THEN t.planCuenta_Nombre END AS planCuenta_Nombre_old,
       CASE WHEN {changed} THEN {_AT} END AS planCuenta_Nombre_changed_at,
       CASE WHEN {changed} THEN 'upsert_full' END AS planCuenta_Nombre_changed_by
FROM t FULL OUTER JOIN s ON t.planCuenta_id = s.planCuenta_id"""


def _null_tracking(cols) -> str:
    out = []
    for c in cols:
        out += [f"CAST(NULL AS VARCHAR) AS {c}_old", f"CAST(NULL AS TIMESTAMP) AS {c}_changed_at",
                f"CAST(NULL AS VARCHAR) AS {c}_changed_by"]
    return ", ".join(out)


def partition_replace_sql() -> str:
    return f"""WITH fact AS ({fact_sql()}),
batch AS (SELECT * FROM fact WHERE eerr_origen IN ('C1', 'C2') AND periodo_mes >= '1999-01-01')
SELECT * FROM fact WHERE eerr_origen IN ('B1', 'R1')
  AND periodo_mes NOT IN (SELECT DISTINCT periodo_mes FROM batch)
UNION ALL SELECT * FROM batch"""


def upsert_full_sql() -> str:
    return (f"SELECT planCuenta_id, planCuenta_Nombre, negocio_id, producto_id, planCuenta_Concepto "
            f"FROM ({_upsert_sql()})")


def change_tracking_sql() -> str:
    return (f"SELECT planCuenta_id, planCuenta_Nombre_old, planCuenta_Nombre_changed_at, "
            f"planCuenta_Nombre_changed_by, "
            f"{_null_tracking(['negocio_id', 'producto_id', 'planCuenta_Concepto'])} FROM ({_upsert_sql()})")


def change_trace_sql() -> str:
    return f"""WITH t AS ({_before_sql()}), u AS ({_upsert_sql()})
SELECT u.planCuenta_id, 'planCuenta_Nombre' AS column_name, t.planCuenta_Nombre AS old_value,
       u.planCuenta_Nombre AS new_value, {_AT} AS changed_at, 'upsert_full' AS changed_by
FROM u LEFT JOIN t ON u.planCuenta_id = t.planCuenta_id
WHERE u.planCuenta_Nombre IS DISTINCT FROM t.planCuenta_Nombre
UNION ALL
SELECT u.planCuenta_id, c.name, NULL, c.val, {_AT}, 'upsert_full'
FROM u LEFT JOIN t ON u.planCuenta_id = t.planCuenta_id,
     LATERAL (VALUES ('negocio_id', u.negocio_id), ('producto_id', u.producto_id),
                     ('planCuenta_Concepto', u.planCuenta_Concepto)) AS c(name, val)
WHERE t.planCuenta_id IS NULL AND c.val IS NOT NULL"""


def backup_versions_sql() -> str:
    return f"""SELECT 1 AS version, count(*) AS n_rows FROM ({_before_sql()})
UNION ALL SELECT 2, count(*) FROM ({_upsert_sql()})"""


def selective_update_sql() -> str:
    return f"""WITH t AS ({_before_sql()}), a AS ({accounts_sql()})
SELECT t.planCuenta_id, t.planCuenta_Nombre, a.negocio_id, a.producto_id, a.planCuenta_Concepto
FROM t JOIN a ON t.planCuenta_id = a.planCuenta_id"""


def insert_only_sql() -> str:
    return f"""WITH t AS ({_before_sql()})
SELECT * FROM t UNION ALL
SELECT * FROM ({governed_accounts_sql()}) WHERE planCuenta_id NOT IN (SELECT planCuenta_id FROM t)"""


def update_only_sql() -> str:
    return (f"SELECT planCuenta_id, upper(planCuenta_Nombre) AS planCuenta_Nombre, negocio_id, producto_id, "
            f"planCuenta_Concepto FROM ({_before_sql()})")


# ------------------------------------------------- mapping and analytics

def map_columns_sql() -> str:
    return institutions_sql()


def auto_map_sql() -> str:
    return institutions_sql()


def default_values_sql() -> str:
    return f"""SELECT planCuenta_id, planCuenta_Nombre, coalesce(negocio_id, 'SIN_NEGOCIO') AS negocio_id,
       coalesce(producto_id, 'SIN_PRODUCTO') AS producto_id, 'SIN_CONCEPTO' AS planCuenta_Concepto
FROM ({governed_accounts_sql()})"""


def month_snapshot_sql() -> str:
    return f"""SELECT DISTINCT {period_sql('l.l_shipdate')} AS periodo_mes, {code_sql('p.p_partkey', 7)} AS planCuenta_id,
       p.p_name AS planCuenta_Nombre
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey"""


def _registry_sql() -> str:
    return (f"SELECT DISTINCT {period_sql('o.o_orderdate')} AS periodo_mes, {code_sql('l.l_suppkey', 3)} AS ins_id "
            f"FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey")


def month_scope_sql() -> str:
    return f"""WITH fact AS ({fact_sql()}), reg AS ({_registry_sql()})
SELECT f.* FROM fact f
WHERE EXISTS (SELECT 1 FROM reg r WHERE r.ins_id = f.ins_id AND r.periodo_mes = f.periodo_mes)"""


def month_scope_missing_sql() -> str:
    return f"""WITH fact AS ({fact_sql()}), reg AS ({_registry_sql()})
SELECT r.ins_id, r.periodo_mes FROM reg r
WHERE NOT EXISTS (SELECT 1 FROM fact f WHERE r.ins_id = f.ins_id AND r.periodo_mes = f.periodo_mes)"""


def sql_text_sql() -> str:
    return f"""WITH fact AS ({fact_sql()})
SELECT periodo_mes, eerr_origen, count(*) AS n_rows, CAST(sum(eerr_Monto) AS DECIMAL(26,2)) AS eerr_Monto
FROM fact WHERE eerr_Monto >= 0 AND eerr_origen IN ('B1', 'R1', 'C1', 'C2')
GROUP BY periodo_mes, eerr_origen"""


def profile_columns_sql() -> str:
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, "
        f"count({c}) AS n_non_null FROM orders" for c in cols)


def month_prefix_sql() -> str:
    return f"""WITH m AS (SELECT {period_sql('o_orderdate')} AS periodo_mes, count(*) AS n_orders,
                  CAST(sum(CAST(o_totalprice AS DECIMAL(23,2))) AS DECIMAL(26,2)) AS total
           FROM orders GROUP BY 1),
bad AS (SELECT min(periodo_mes) AS first_fail FROM m WHERE n_orders < 0.25 * (SELECT max(n_orders) FROM m))
SELECT m.* FROM m, bad WHERE m.periodo_mes < coalesce(bad.first_fail, '9999-12-31')"""


def lost_in_cast_sql() -> str:
    parts = [("o_orderkey", "false"), ("o_totalprice", "o_totalprice >= 100000"),
             ("o_orderdate", "false"), ("o_orderpriority", "false")]
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE {bad}) AS n_lost, "
        f"count(*) FILTER (WHERE {bad}) = 0 AS passed FROM orders" for c, bad in parts)


def profile_merge_sql() -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_non_null, CAST(min({c}) AS VARCHAR) AS min_value,
       CAST(max({c}) AS VARCHAR) AS max_value, count(DISTINCT {c}) AS n_distinct, true AS distinct_within, true AS median_within FROM orders"""
        for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"))


def month_compare_bucketed_sql() -> str:
    return month_compare_sql()


def fk_composite_bucketed_sql() -> str:
    return f"""WITH fact AS ({fact_sql()})
SELECT planCuenta_id, periodo_mes, count(*) AS n_rows FROM fact WHERE planCuenta_id LIKE '%7' GROUP BY ALL"""


# ------------------------------------------------------------ monthly jobs

MARCH = "l_shipdate >= DATE '1998-03-01' AND l_shipdate < DATE '1998-04-01'"


def institution_job_sql() -> str:
    return (f"SELECT DISTINCT {code_sql('s_suppkey', 3)} AS ins_id, s_name AS ins_nombre "
            f"FROM supplier JOIN lineitem ON s_suppkey = l_suppkey WHERE {MARCH}")


def institution_month_job_sql() -> str:
    return f"SELECT '1998-03-01' AS periodo_mes, * FROM ({institution_job_sql()})"


def account_job_sql(months: str = MARCH) -> str:
    return (f"SELECT DISTINCT {code_sql('p_partkey', 7)} AS planCuenta_id, p_name AS planCuenta_Nombre "
            f"FROM part JOIN lineitem ON p_partkey = l_partkey WHERE {months}")


def account_month_job_sql() -> str:
    return f"SELECT '1998-03-01' AS periodo_mes, * FROM ({account_job_sql()})"


def account_range_job_sql() -> str:
    return account_job_sql("l_shipdate >= DATE '1998-01-01' AND l_shipdate < DATE '1998-04-01'")


ORIGIN = ("CASE WHEN l_returnflag = 'A' THEN 'B1' WHEN l_returnflag = 'R' THEN 'R1' "
          "WHEN l_linestatus = 'F' THEN 'C1' WHEN l_linestatus = 'O' THEN 'C2' END")


def statement_completeness_sql() -> str:
    return f"""
WITH n AS (SELECT l_suppkey AS s_suppkey, {ORIGIN} AS eerr_origen,
                  count(*) FILTER (NOT (l_suppkey % 10 = 4 AND {ORIGIN} = 'C1')) AS n_rows
           FROM lineitem WHERE {MARCH} AND NOT (l_suppkey % 10 = 3 AND {ORIGIN} = 'C2') GROUP BY 1, 2)
SELECT {code_sql('s_suppkey', 3)} AS ins_id, eerr_origen, n_rows, coalesce(n_rows >= 1, false) AS passed
FROM (SELECT s_suppkey, unnest(['B1', 'R1', 'C1', 'C2']) AS eerr_origen FROM supplier) LEFT JOIN n USING (s_suppkey, eerr_origen)"""


def statements_job_sql() -> str:
    return f"""
WITH once AS (SELECT l_suppkey, l_partkey FROM lineitem WHERE {MARCH} GROUP BY ALL HAVING count(*) = 1),
m AS (SELECT * FROM lineitem JOIN once USING (l_suppkey, l_partkey) WHERE {MARCH}),
clean AS (SELECT * FROM m WHERE l_suppkey IN (
  SELECT l_suppkey FROM m JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal >= 0
  GROUP BY l_suppkey HAVING count(DISTINCT {ORIGIN}) = 4))
{fact_sql().replace('FROM lineitem', 'FROM clean')}"""


def indicators_job_sql() -> str:
    return f"SELECT * FROM ({mgmt_indicators_sql()}) WHERE periodo_mes = '1998-03-01'"


def _months(*periods: str) -> str:
    return "strftime(l_shipdate, '%Y-%m-01') IN (" + ", ".join(f"'{p}'" for p in periods) + ")"


def _assigned_sql(accounts: str) -> str:
    """Accounts with their assignment; those of a business line without a master have none."""
    return f"""SELECT a.planCuenta_id, a.planCuenta_Nombre, CASE WHEN p.negocio_id <> 'PROMO' THEN p.negocio_id END AS negocio_id,
       CASE WHEN p.negocio_id <> 'PROMO' THEN p.producto_id END AS producto_id,
       CASE WHEN p.negocio_id <> 'PROMO' THEN p.planCuenta_Concepto END AS planCuenta_Concepto
FROM ({accounts}) a JOIN ({accounts_sql()}) p ON p.planCuenta_id = a.planCuenta_id"""


def enrichment_job_sql() -> str:
    return _assigned_sql(account_job_sql())


def account_as_of_sql() -> str:
    none = "CAST(NULL AS VARCHAR)"
    plain = f"planCuenta_id, planCuenta_Nombre, {none} AS negocio_id, {none} AS producto_id, {none} AS planCuenta_Concepto"
    both = account_job_sql(_months("1998-03-01", "1998-04-01"))
    return f"""SELECT '1998-03-01 00:00:00' AS at, {plain} FROM ({account_job_sql()})
UNION ALL SELECT '1998-04-20 00:00:00', {plain} FROM ({both})
UNION ALL SELECT '1998-05-15 12:00:00', * FROM ({_assigned_sql(both)})"""


def account_intervals_sql() -> str:
    seen = lambda p: f"SELECT DISTINCT {code_sql('l_partkey', 7)} FROM lineitem WHERE {_months(p)}"
    return f"""
WITH names AS (SELECT {code_sql('p_partkey', 7)} AS planCuenta_id, p_name AS lower_name, upper(p_name) AS upper_name FROM part),
loads AS (
  SELECT planCuenta_id, DATE '1998-01-01' AS since, lower_name AS name FROM names WHERE planCuenta_id IN ({seen('1998-01-01')})
  UNION ALL SELECT planCuenta_id, DATE '1998-02-01', upper_name FROM names WHERE planCuenta_id IN ({seen('1998-02-01')})
  UNION ALL SELECT planCuenta_id, DATE '1998-03-01', lower_name FROM names WHERE planCuenta_id IN ({seen('1998-03-01')})),
changes AS (SELECT * FROM (SELECT *, lag(name) OVER (PARTITION BY planCuenta_id ORDER BY since) AS former FROM loads)
            WHERE former IS DISTINCT FROM name)
SELECT planCuenta_id, 'planCuenta_Nombre' AS column_name, name AS value, CAST(since AS TIMESTAMP) AS valid_from,
       CAST(lead(since) OVER (PARTITION BY planCuenta_id ORDER BY since) AS TIMESTAMP) AS valid_to FROM changes"""


def job_quality_log_sql() -> str:
    """The rules of the two jobs, written out; only the short names can be violated."""
    name, rows = "length(planCuenta_Nombre)", "(SELECT count(*) FROM acct)"

    def rule(table, run, rid, kind, bad="0", severity="ERROR", n=rows, counted=True):
        details = bad if counted else "0"
        return (f"SELECT '{table}' AS table_name, '{run}' AS run_id, '{rid}' AS rule_id, '{kind}' AS rule_type, '{severity}' AS severity, "
                f"{n} AS n_rows, {bad} AS n_bad, {bad} = 0 AS passed, {details} AS n_details")

    def columns(table, run):
        bad = {"min_len": f"(SELECT count(*) FROM acct WHERE {name} < 5)", "max_len": f"(SELECT count(*) FROM acct WHERE {name} > 100)"}
        return [rule(table, run, f"{c}:{k}", k, bad[k] if c == "planCuenta_Nombre" and k in bad else "0")
                for c in ("planCuenta_id", "planCuenta_Nombre") for k in ("not_null", "min_len", "max_len")]

    files = lambda table, run: [rule(table, run, "rejected_lines", "raw"), rule(table, run, "rows_in_file", "row_count"),
                                rule(table, run, "file_period", "period", n="1"), rule(table, run, "pk", "pk")]
    parts = columns("account", "run-1") + files("account", "run-1") + [
        rule("account", "run-1", "DQ_CuentaCorta", "row_sql", f"(SELECT count(*) FROM acct WHERE NOT {name} <= 10)", "WARNING")]
    parts += columns("account_month", "run-2") + files("account_month", "run-2") + [
        rule("account_month", "run-2", "periodo_mes:not_null", "not_null"), rule("account_month", "run-2", "fk:planCuenta_id->account", "fk")]
    return f"WITH acct AS ({account_job_sql()})\n" + "\nUNION ALL\n".join(parts)


def _clean_sql(periods: list[str]) -> str:
    return f"""
dated AS (SELECT *, strftime(l_shipdate, '%Y-%m-01') AS m FROM lineitem WHERE {_months(*periods)}),
once AS (SELECT m, l_suppkey, l_partkey FROM dated GROUP BY ALL HAVING count(*) = 1),
single AS (SELECT * FROM dated JOIN once USING (m, l_suppkey, l_partkey)),
whole AS (SELECT m, l_suppkey FROM single JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal >= 0
          GROUP BY ALL HAVING count(DISTINCT {ORIGIN}) = 4),
clean AS (SELECT * FROM single JOIN whole USING (m, l_suppkey))"""


def monthly_run_job_sql() -> str:
    counts = {"institution": "count(DISTINCT l_suppkey)", "institution_month": "count(DISTINCT l_suppkey)",
              "account": "count(DISTINCT l_partkey)", "account_month": "count(DISTINCT l_partkey)", "statements": "count(*)"}
    return f"WITH {_clean_sql(['1998-03-01'])}\n" + "\nUNION ALL\n".join(
        f"SELECT '{job}' AS job, {n} AS n_rows FROM clean" for job, n in counts.items())


def statements_range_job_sql() -> str:
    return f"""WITH {_clean_sql(['1998-01-01', '1998-02-01'])}
{fact_sql().replace('FROM lineitem', 'FROM clean')}"""


def statements_verdict_sql() -> str:
    """Scope, keys, files and headers of March 1998 as it stands."""
    bank = code_sql("l_suppkey", 3)
    per_kind = "\nUNION ALL\n".join(
        f"""SELECT '{k}:header_code' AS rule_id, count(*) AS n_rows, count(*) FILTER (code <> ins_id) AS n_bad FROM files WHERE kind = '{k}'
UNION ALL SELECT '{k}:rows_per_file', sum(n)::BIGINT, 0 FROM files WHERE kind = '{k}'""" for k in ("B1", "R1", "C1", "C2"))
    return f"""
WITH rows AS (SELECT *, {bank} AS ins_id, {ORIGIN} AS kind FROM lineitem WHERE {MARCH}),
files AS (SELECT kind, ins_id, CASE WHEN s_acctbal < 0 THEN reverse(ins_id) ELSE ins_id END AS code, count(*) AS n
          FROM rows JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL),
registered AS (SELECT {code_sql('s_suppkey', 3)} AS ins_id FROM supplier WHERE s_acctbal >= 0),
scope AS (SELECT * FROM rows WHERE ins_id IN (SELECT ins_id FROM registered)),
keys AS (SELECT ins_id, l_partkey, count(*) AS n FROM scope GROUP BY ALL),
owed AS (SELECT ins_id, unnest(['B1', 'R1', 'C1', 'C2']) AS kind FROM registered),
absent AS (SELECT count(*) AS n FROM registered WHERE ins_id NOT IN (SELECT ins_id FROM scope)),
verdicts AS (
{per_kind}
UNION ALL SELECT 'pk', sum(n)::BIGINT, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT FROM keys
UNION ALL SELECT 'fk:ins_id,periodo_mes->institution_month', count(*), 0 FROM scope
UNION ALL SELECT 'fk:planCuenta_id,periodo_mes->account_month', count(*), count(*) FILTER (l_partkey % 10 = 7) FROM scope
UNION ALL SELECT 'statement_files', count(*), count(*) FILTER (f.n IS NULL) FROM owed LEFT JOIN files f USING (ins_id, kind)
UNION ALL SELECT 'registered_without_statements', n, n FROM absent WHERE n > 0)
SELECT rule_id, n_rows, n_bad, n_bad = 0 AS passed FROM verdicts"""


def institution_range_job_sql() -> str:
    return institution_job_sql().replace(MARCH, "l_shipdate >= DATE '1998-01-01' AND l_shipdate < DATE '1998-04-01'")


def institution_month_range_job_sql() -> str:
    return (f"SELECT DISTINCT {period_sql('l_shipdate')} AS periodo_mes, {code_sql('s_suppkey', 3)} AS ins_id, s_name AS ins_nombre "
            "FROM supplier JOIN lineitem ON s_suppkey = l_suppkey WHERE l_shipdate >= DATE '1998-01-01' AND l_shipdate < DATE '1998-04-01'")


def account_month_range_job_sql() -> str:
    """March is left out if it has an account that did not report before."""
    return f"""WITH m AS (SELECT DISTINCT {period_sql('l_shipdate')} AS periodo_mes, l_partkey FROM lineitem
           WHERE {_months('1998-01-01', '1998-02-01', '1998-03-01')}),
late AS (SELECT count(*) AS n FROM m WHERE periodo_mes = '1998-03-01' AND l_partkey NOT IN
         (SELECT l_partkey FROM m WHERE periodo_mes < '1998-03-01'))
SELECT periodo_mes, {code_sql('p_partkey', 7)} AS planCuenta_id, p_name AS planCuenta_Nombre
FROM m JOIN part ON p_partkey = l_partkey WHERE periodo_mes < '1998-03-01' OR (SELECT n FROM late) = 0"""


def indicators_range_job_sql() -> str:
    kept = f"(SELECT * FROM lineitem WHERE {_months('1998-01-01', '1998-02-01', '1998-03-01')}) AS lineitem"
    return f"SELECT * FROM ({mgmt_indicators_sql().replace('FROM lineitem', 'FROM ' + kept)}) WHERE periodo_mes >= '1998-02-01' AND negocio_id IS NOT NULL"


ORACLES = {
    "mgmt_indicators": mgmt_indicators_sql,
    "unify_sources": unify_sources_sql,
    "month_compare": month_compare_sql,
    "ytd_to_month": ytd_to_month_sql,
    "pk_violations": pk_violations_sql,
    "not_null": not_null_sql,
    "len_rule": len_rule_sql,
    "row_rule": row_rule_sql,
    "tolerance": tolerance_sql,
    "range_rules": range_rules_sql,
    "regex_rule": regex_rule_sql,
    "unique_rule": unique_rule_sql,
    "one_value": one_value_sql,
    "row_count_interval": row_count_interval_sql,
    "agg_rule": agg_rule_sql,
    "dq_summary": dq_summary_sql,
    "dq_details": dq_details_sql,
    "fk_single": fk_single_sql,
    "fk_composite": fk_composite_sql,
    "fk_nullable": fk_nullable_sql,
    "warning_exclude": warning_exclude_sql,
    "new_record_cap": new_record_cap_sql,
    "decimal_comma": decimal_comma_sql,
    "scan_by_template": scan_by_template_sql,
    "header_records": header_records_sql,
    "drop_header": drop_header_sql,
    "header_code_check": header_code_check_sql,
    "header_row_count": header_row_count_sql,
    "row_shape_filter": row_shape_filter_sql,
    "period_check": period_check_sql,
    "scan_semicolon": scan_semicolon_sql,
    "scan_delimited": scan_delimited_sql,
    "scan_fixed_width": scan_fixed_width_sql,
    "settings_as_of": settings_as_of_sql,
    "scan_two_layouts": scan_two_layouts_sql,
    "rejected_lines": rejected_lines_sql,
    "file_inventory": file_inventory_sql,
    "partition_replace": partition_replace_sql,
    "upsert_full": upsert_full_sql,
    "change_tracking": change_tracking_sql,
    "change_trace": change_trace_sql,
    "backup_versions": backup_versions_sql,
    "selective_update": selective_update_sql,
    "insert_only": insert_only_sql,
    "update_only": update_only_sql,
    "map_columns": map_columns_sql,
    "auto_map": auto_map_sql,
    "default_values": default_values_sql,
    "month_snapshot": month_snapshot_sql,
    "month_scope": month_scope_sql,
    "month_scope_missing": month_scope_missing_sql,
    "sql_text": sql_text_sql,
    "profile_columns": profile_columns_sql,
    "month_prefix": month_prefix_sql,
    "lost_in_cast": lost_in_cast_sql,
    "profile_merge": profile_merge_sql,
    "month_compare_bucketed": month_compare_bucketed_sql,
    "fk_composite_bucketed": fk_composite_bucketed_sql,
    "institution_job": institution_job_sql,
    "institution_month_job": institution_month_job_sql,
    "account_job": account_job_sql,
    "account_month_job": account_month_job_sql,
    "account_range_job": account_range_job_sql,
    "statement_completeness": statement_completeness_sql,
    "statements_job": statements_job_sql,
    "indicators_job": indicators_job_sql,
    "enrichment_job": enrichment_job_sql,
    "account_as_of": account_as_of_sql,
    "account_intervals": account_intervals_sql,
    "job_quality_log": job_quality_log_sql,
    "monthly_run_job": monthly_run_job_sql,
    "statements_range_job": statements_range_job_sql,
    "statements_verdict": statements_verdict_sql,
    "institution_range_job": institution_range_job_sql,
    "institution_month_range_job": institution_month_range_job_sql,
    "account_month_range_job": account_month_range_job_sql,
    "indicators_range_job": indicators_range_job_sql,
}


def oracle_sql() -> dict[str, str]:
    return {k: f() for k, f in ORACLES.items()}
