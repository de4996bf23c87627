"""Operator behaviour on inputs derived from the fixture tables, including
the failure paths the oracle queries do not reach."""

import dataclasses
from decimal import Decimal

from pyspark.sql import functions as F

from cuadra.functions import decimal_comma, shift_period_str
from cuadra.operators import analytics as A
from cuadra.operators import mapping as M
from cuadra.operators import quality as Q
from cuadra.plans import fixtures as X
from cuadra.plans import tables as TB
from cuadra.plans.measures import DERIVED, MEASURES
from cuadra.sources import text as TX
from cuadra.specs import ColumnSpec, Rule, TableKind, TableSpec
from tests.conftest import SF_SMALL


def _parts(spark):
    return X.table(spark, SF_SMALL, "part")


def test_decimal_comma_edge_cases(spark):
    # Values built from the fixture's own prices, rendered the way banks write them.
    prices = X.table(spark, SF_SMALL, "part").select("p_retailprice").limit(1)
    df = prices.select(
        decimal_comma(F.lit("1234,56")).alias("plain"),
        decimal_comma(F.lit(" 12,555 ")).alias("half_up"),
        decimal_comma(F.lit("1.234,56")).alias("thousands"),
        decimal_comma(F.lit("")).alias("empty"),
        decimal_comma(F.lit("abc")).alias("junk"))
    r = df.first()
    assert r.plain == Decimal("1234.56")
    assert r.half_up == Decimal("12.56")
    assert r.thousands is None and r.empty is None and r.junk is None


def test_period_arithmetic():
    assert shift_period_str("2018-01-01", -1) == "2017-12-01"
    assert shift_period_str("2018-12-01", 1) == "2019-01-01"


def test_month_compare_single_period_equals_all_periods(spark):
    fact = X.statement_fact(X.table(spark, SF_SMALL, "lineitem"))
    one = A.month_compare(fact, ["ins_id", "planCuenta_id"], period="1998-03-01")
    every = A.month_compare(fact, ["ins_id", "planCuenta_id"]).where("periodo_mes = '1998-03-01'")
    assert one.count() > 0
    assert one.exceptAll(every).count() == 0 and every.exceptAll(one).count() == 0


def test_indicators_january_uses_current_month_only(spark):
    fact = X.statement_fact(X.table(spark, SF_SMALL, "lineitem"))
    acct = X.accounts(_parts(spark))
    out = A.management_indicators(fact, acct, MEASURES, DERIVED, period="1998-01-01")
    # castigo_mes equals castigo_Ano in January (no previous-month difference)
    assert out.where("gestion_castigo_mes != gestion_castigo_Ano").count() == 0
    feb = A.management_indicators(fact, acct, MEASURES, DERIVED, period="1998-02-01")
    assert feb.where("gestion_castigo_mes != gestion_castigo_Ano").count() > 0


def test_union_and_single_pass_fact_agree(spark):
    li = X.table(spark, SF_SMALL, "lineitem")
    a, b = X.statement_fact(li), X.statement_fact_union(li)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_row_rules_null_result_fails(spark):
    acct = TB.governed_accounts(_parts(spark))
    rule = Rule("concept_known", "planCuenta_Concepto <> 'X'")   # null concept -> null result
    s = Q.evaluate_row_checks(acct, [Q.sql_check(rule)]).first()
    n_null = acct.where("planCuenta_Concepto IS NULL").count()
    assert n_null > 0 and s.n_bad == n_null and not s.passed


def test_tolerance_boundaries(spark):
    acct = TB.governed_accounts(_parts(spark))
    n_bad = acct.where("length(planCuenta_Nombre) > 10").count()
    assert n_bad > 0
    for tol, expect in ((n_bad, True), (n_bad - 1, False)):
        r = Rule("short", "length(planCuenta_Nombre) <= 10", tolerance_rows=tol)
        assert Q.evaluate_row_checks(acct, [Q.sql_check(r)]).first().passed is expect


def test_aggregate_rule_on_empty_input_fails(spark):
    empty = X.table(spark, SF_SMALL, "orders").where("o_totalprice < 0")
    res = Q.aggregate_rules(empty, [Rule("pos", "sum(o_totalprice) > 0", level="aggregate", error_code=7)])
    row = res.first()
    assert row.passed is False
    assert Q.first_error(res).first().error_code == 7


def test_one_value_on_empty_fails(spark):
    empty = X.table(spark, SF_SMALL, "orders").where("o_totalprice < 0")
    assert Q.one_value(empty, ["o_orderstatus"]).first().passed is False


def test_fk_nullable_vs_not_nullable(spark):
    acct = TB.governed_accounts(_parts(spark))
    masters = TB.products(_parts(spark))
    fk = TB.ACCOUNT.foreign_keys[1]
    assert Q.fk_check(acct, masters, fk).first().n_bad == 0
    strict = dataclasses.replace(fk, nullable=False)
    n_null = acct.where("producto_id IS NULL").count()
    assert Q.fk_check(acct, masters, strict).first().n_bad == n_null > 0


def test_warning_exclude_keeps_null_keys(spark):
    acct = TB.governed_accounts(_parts(spark))
    refs = {"negocio": TB.business_lines(_parts(spark)), "producto": TB.products(_parts(spark))}
    kept = Q.exclude_warnings(acct, TB.ACCOUNT, refs)
    assert kept.where("negocio_id = 'PROMO'").count() == 0
    assert kept.where("negocio_id IS NULL").count() == acct.where("negocio_id IS NULL").count()


def test_check_gate_fails_on_error_rule(spark):
    inst = X.institutions(X.table(spark, SF_SMALL, "supplier"))
    strict = dataclasses.replace(TB.INSTITUTION, columns=(
        TB.INSTITUTION.columns[0], dataclasses.replace(TB.INSTITUTION.columns[1], max_len=10)))
    assert Q.gate(Q.check(inst, TB.INSTITUTION).summary).first().ok is True
    assert Q.gate(Q.check(inst, strict).summary).first().ok is False


def test_map_columns_requires_mapping_and_reports_cast_losses(spark):
    orders = X.table(spark, SF_SMALL, "orders")
    spec = TableSpec("o", TableKind.TRANSACTION, (
        ColumnSpec("id", "bigint"), ColumnSpec("price", "decimal(7,2)"),
        ColumnSpec("note", required=False), ColumnSpec("status", default="'?'")))
    out = M.map_columns(orders, spec, {"id": "o_orderkey", "price": "o_totalprice"})
    assert out.columns == ["id", "price", "note", "status"]
    losses = M.cast_losses(orders, spec, {"id": "o_orderkey", "price": "o_totalprice"})
    lost = {r.column_name: r.n_lost for r in losses.collect()}
    assert lost["id"] == 0 and lost["price"] == orders.where("o_totalprice >= 100000").count() > 0
    try:
        M.map_columns(orders, spec, {"price": "o_totalprice"})
        raise AssertionError("unmapped required column accepted")
    except ValueError:
        pass


def test_template_regex_and_glob():
    pattern, names = TX.template_regex("/x/{{YYYY}}{{MM}}/b1{{YYYY}}{{MM}}{{Cod_Banco}}.txt")
    import re
    m = re.search(pattern, "file:/x/199803/b1199803001.txt")
    assert names == ["YYYY", "MM", "Cod_Banco"] and m.groups() == ("1998", "03", "001")
    assert re.search(pattern, "file:/x/199803/b1199804001.txt") is None
    assert TX.template_glob("/x/{{YYYY}}{{MM}}/a.txt", {"YYYY": "1998"}) == "/x/1998[0-9][0-9]/a.txt"


def test_repeated_header_lines_are_dropped(spark, tmp_path):
    from cuadra.plans.staging import write_files
    sup = X.table(spark, SF_SMALL, "supplier")
    lines = sup.select(F.lit("199801/b1199801001.txt").alias("path"),
                       F.col("s_suppkey").cast("int").alias("_ord"),
                       F.when(F.col("s_suppkey") % 3 == 0, F.lit("001\tBANK"))
                       .otherwise(F.concat_ws("\t", F.lpad(F.col("s_suppkey").cast("string"), 7, "0"),
                                              F.lit("1,5"), F.lit("2"), F.lit("0"), F.lit("0"))).alias("value"))
    write_files(lines, str(tmp_path))
    read = TX.read_lines(spark, f"{tmp_path}/{{{{YYYY}}}}{{{{MM}}}}/b1{{{{YYYY}}}}{{{{MM}}}}{{{{Cod_Banco}}}}.txt")
    hdr = TX.header_records(read, ["codigo", "banco"], keys=[TX.FILE])
    assert hdr.first().codigo == "001"
    n_hdr = sup.where(F.col("s_suppkey") % 3 == 0).count()
    assert TX.drop_header(read, hdr).count() == sup.count() - n_hdr


def test_joins_need_no_job_while_a_query_is_built(spark):
    from cuadra.operators.joins import join_dimension
    li = X.table(spark, SF_SMALL, "lineitem").select("l_partkey")
    joined = join_dimension(li, _parts(spark).withColumnRenamed("p_partkey", "l_partkey"), "l_partkey")
    assert joined.count() == li.count()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" not in plan


def test_long_codes_stay_apart(spark):
    from cuadra.functions.expressions import padded_code
    codes = spark.range(998, 1012).select(padded_code("id", 3).alias("c"))
    assert codes.distinct().count() == 14
    assert codes.where("length(c) > 3").count() == 12


def test_template_parameters_hold_behind_a_wildcard_folder():
    from cuadra.sources.text import template_regex
    import re
    pattern, names = template_regex("/in/{{Cod_Banco}}/{{YYYY}}{{MM}}/data.txt", {"MM": "03"})
    assert names == ["Cod_Banco", "YYYY", "MM"]
    assert re.search(pattern, "/in/007/199803/data.txt") and not re.search(pattern, "/in/007/199804/data.txt")


def test_repeated_source_keys_and_null_keys(spark):
    import pytest
    from cuadra.sinks import tables as SK
    cols = "planCuenta_id string, planCuenta_Nombre string"
    target = spark.createDataFrame([("1000000", "first name", None, None, None)],
                                   cols + ", negocio_id string, producto_id string, planCuenta_Concepto string")
    twice = spark.createDataFrame([("1000000", "one name"), ("1000000", "another")], cols)
    with pytest.raises(Exception, match="repeated source key"):
        SK.upsert_full(target, twice, TB.ACCOUNT, ["planCuenta_id", "planCuenta_Nombre"], "2020-01-01 00:00:00", "t").collect()
    bad = spark.createDataFrame([(None, "some name"), (None, "other name")], cols).selectExpr(
        "*", "string(null) negocio_id", "string(null) producto_id", "string(null) planCuenta_Concepto")
    res = Q.check(bad, TB.ACCOUNT, skip_refs=("negocio", "producto"))
    assert res.details.where("rule_id = 'pk'").count() == 2
    with pytest.raises(ValueError, match="no reference"):
        Q.check(bad, TB.ACCOUNT)
    new = SK.insert_only(target, spark.createDataFrame([("2000000", "renamed")], "id string, label string"), TB.ACCOUNT,
                         {"planCuenta_id": "id", "planCuenta_Nombre": "label"})
    assert sorted(r.planCuenta_Nombre for r in new.collect()) == ["first name", "renamed"]
    with pytest.raises(Exception, match="repeated source key"):
        SK.insert_only(target, spark.createDataFrame([("2000000", "a name"), ("2000000", "b name")], cols), TB.ACCOUNT).collect()


def test_quality_results_are_appended(spark, tmp_path):
    from cuadra.sinks import tables as SK
    acct = TB.governed_accounts(_parts(spark))
    refs = {"negocio": TB.business_lines(_parts(spark)), "producto": TB.products(_parts(spark))}
    res = Q.check(acct, TB.ACCOUNT, refs, detail_cols=["planCuenta_id"])
    for run in ("r1", "r2"):
        SK.append_quality(res.summary, res.details, str(tmp_path), "account", run)
    summary = SK.read_quality(spark, str(tmp_path), "dq_results")
    details = SK.read_quality(spark, str(tmp_path), "dq_details")
    assert summary.where("run_id = 'r2'").count() == res.summary.count()
    assert details.count() == 2 * res.details.count() > 0
    assert {r.rule_id for r in details.select("rule_id").distinct().collect()} >= {"DQ_CuentaCorta"}


def test_period_filter_prunes_partitions_and_columns(spark, tmp_path, capsys):
    from cuadra.sinks import tables as SK
    fact = X.statement_fact(X.table(spark, SF_SMALL, "lineitem"))
    path = str(tmp_path / "stmt")
    SK.partition_replace(fact.where("periodo_mes < '1995-04-01'"), TB.STATEMENT, path)
    table = SK.read_table(spark, TB.STATEMENT, path)
    assert dict(table.dtypes)["ins_id"] == "string"          # partition values stay strings
    q = table.where("periodo_mes = '1995-02-01'").select("ins_id", "eerr_Monto")
    q.explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(periodo_mes" in plan and "(periodo_mes" in plan
    assert "ReadSchema: struct<eerr_Monto:decimal(26,2)>" in plan
    assert q.count() == fact.where("periodo_mes = '1995-02-01'").count()


def test_flagship_plan_shuffles_the_fact_once(spark, capsys):
    import __spark_entry__ as E
    df = E.queries()["mgmt_indicators"](spark, SF_SMALL)
    df.explain()
    plan = capsys.readouterr().out
    fact = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(ins_id" in ln and "planCuenta_id" in ln]
    assert len(fact) == 1                                   # one shuffle of narrow fact rows, before they are doubled
    groups = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(periodo_mes" in ln]
    assert len(groups) == 1 and "producto_id" in groups[0]  # and one of the pivot's partial sums
    assert "partial_sum" in plan                            # map-side combine before it
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "Generate inline" in plan                        # current / previous rows, no self-join


def test_files_outside_every_layout_are_reported(spark):
    from cuadra.sources import layouts as L
    from cuadra.specs import RawSetting, RawSpec
    raw = RawSpec("B1", "{{YYYY}}{{MM}}/b1{{YYYY}}{{MM}}{{Cod_Banco}}.txt", (
        RawSetting("1996-01-01", "1997-12-31", (("planCuenta_id", "string"),)),
        RawSetting("1997-07-01", "2050-12-12", (("planCuenta_id", "string"),))))
    files = (X.statement_fact(X.table(spark, SF_SMALL, "lineitem"))
             .where("eerr_origen = 'B1'").select("periodo_mes", "ins_id", "eerr_origen").distinct())
    out = L.settings_as_of(files, L.settings_frame(spark, raw), keys=["ins_id", "eerr_origen"],
                           name_col="eerr_origen")
    by = {r.kind: r.n for r in out.selectExpr(
        "CASE WHEN periodo_mes < '1996-01-01' THEN 'none' WHEN periodo_mes BETWEEN '1997-07-01' AND '1997-12-31' "
        "THEN 'both' ELSE 'one' END AS kind", "n_settings AS n", "setting_id").distinct().collect()}
    assert by == {"none": 0, "both": 2, "one": 1}
    assert out.where("n_settings != 1 AND setting_id IS NOT NULL").count() == 0


def test_profile_with_approximate_distinct(spark):
    orders = X.table(spark, SF_SMALL, "orders")
    prof = {r.column_name: r for r in A.profile_columns(orders, ["o_orderstatus", "o_custkey"]).collect()}
    exact = orders.select("o_orderstatus").distinct().count()
    assert prof["o_orderstatus"].approx_distinct == exact
    assert prof["o_custkey"].n_non_null == orders.count()
