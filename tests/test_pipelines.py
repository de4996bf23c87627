"""The monthly run end to end on staged extracts of the smallest fixture."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from cuadra.plans import monthly as P
from cuadra.plans import raws as RW
from cuadra.plans import staging as ST
from cuadra.plans import tables as TB
from cuadra.session import shared_dir
from tests.conftest import SF_SMALL

# The reference's per-file row bounds do not fit months of the smallest
# fixture (a handful of rows per bank); the pipeline tests relax them.
RELAXED = {
    "codifis": dataclasses.replace(RW.CODIFIS, min_rows=1, max_rows=100000),
    "plan": dataclasses.replace(RW.PLAN_CTAS, min_rows=1, max_rows=100000),
    "stmt": {k: dataclasses.replace(v, min_rows=1, max_rows=100000) for k, v in RW.STATEMENTS.items()},
}


@pytest.fixture(scope="module")
def roots(spark):
    out = {k: ST.stage(spark, SF_SMALL, k) for k in ("codifis", "plan", "stmt", "asigna")}
    # the staged statements keep each kind in its own folder
    out["stmt"] = {o: f"{out['stmt']}/{o.lower()}" for o in RW.STATEMENTS}
    return out


def test_monthly_run_writes_all_tables(spark, roots):
    wh = P.Warehouse(shared_dir(spark, "wh"))
    done = P.monthly_run(spark, roots, wh, 1998, 3, RELAXED)
    assert [r.name for r in done] == ["institution", "institution_month", "account", "account_month",
                                      "statements"]
    failed = {r.name: [x.asDict() for x in r.summary.where("NOT passed").collect()] for r in done if not r.ok}
    # The fixture has planted header errors (banks with a negative balance)
    # and real primary-key duplicates: the statement job must stop.
    assert list(failed) == ["statements"]
    rules = {x["rule_id"] for x in failed["statements"]}
    assert "pk" in rules
    # header codes fail exactly when a bank with a negative balance reported
    negative = spark.read.parquet(f"{SF_SMALL}/supplier.parquet").where("s_acctbal < 0").count()
    header_failed = any(r.endswith(":header_code") for r in rules)
    assert negative > 0 or not header_failed
    all_rules = {x.rule_id for x in done[-1].summary.collect()}
    assert {f"{o}:header_code" for o in RW.STATEMENTS} <= all_rules
    assert done[-1].written is None
    inst = done[0].written
    assert inst.count() == inst.select("ins_id").distinct().count() > 0


def test_rerun_keeps_versions_and_tracks_nothing_new(spark, roots):
    wh = P.Warehouse(shared_dir(spark, "wh2"))
    first = P.account(spark, roots["plan"], wh, 1998, 3, RELAXED["plan"])
    second = P.account(spark, roots["plan"], wh, 1998, 4, RELAXED["plan"])
    assert first.ok and second.ok
    from cuadra.sinks import tables as SK
    assert SK.versions(wh.path("account")) == [1, 2]
    # names do not change between months: no tracked change
    assert second.written.where("planCuenta_Nombre_old IS NOT NULL").count() == 0
    n3, n4 = first.written.count(), second.written.count()
    assert n4 >= n3


def test_enrichment_excludes_unknown_business_lines(spark, roots):
    wh = P.Warehouse(shared_dir(spark, "wh3"))
    assert P.account(spark, roots["plan"], wh, 1998, 3, RELAXED["plan"]).ok
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    masters = {"negocio": TB.business_lines(part), "producto": TB.products(part)}
    res = P.account_enrichment(spark, roots["asigna"], wh, "*", masters,
                               dataclasses.replace(RW.ASIGNA, min_rows=1, max_rows=100000))
    assert res.ok, [r.asDict() for r in res.summary.collect()]
    out = res.written
    assert out.where("negocio_id = 'PROMO'").count() == 0
    assert out.where("negocio_id IS NOT NULL").count() > 0


def test_indicators_job_and_first_error(spark, roots):
    from cuadra.plans import fixtures as X
    from cuadra.sinks import tables as SK
    wh = P.Warehouse(shared_dir(spark, "wh4"))
    li = X.table(spark, SF_SMALL, "lineitem")
    fact = X.statement_fact(li).where(F.col("periodo_mes").isin("1998-02-01", "1998-03-01"))
    SK.partition_replace(fact, TB.STATEMENT, wh.path("statement"))
    SK.save_version(TB.governed_accounts(X.table(spark, SF_SMALL, "part")), TB.ACCOUNT, wh.path("account"))
    ok = P.indicators(spark, wh, 1998, 3, compare_rows=(1, 100000))
    assert ok.ok and ok.written.count() > 0
    jan = P.indicators(spark, wh, 1998, 2, compare_rows=(1, 100000))
    assert not jan.ok and jan.first_error.first().error_code == 2   # previous month empty


def test_reprocess_writes_months_before_first_failure(spark):
    from cuadra.operators import analytics as A
    from cuadra.plans import fixtures as X
    from cuadra.plans.measures import DERIVED, MEASURES
    from cuadra.sinks import tables as SK
    wh = P.Warehouse(shared_dir(spark, "wh5"))
    li = X.table(spark, SF_SMALL, "lineitem")
    # statements loaded for 1998-01 .. 1998-06 except April: May and June
    # must not be written (the run stops at the first failing month)
    fact = X.statement_fact(li).where(F.col("periodo_mes").between("1998-01-01", "1998-06-01")
                                      & (F.col("periodo_mes") != "1998-04-01"))
    SK.partition_replace(fact, TB.STATEMENT, wh.path("statement"))
    accounts = TB.governed_accounts(X.table(spark, SF_SMALL, "part"))
    SK.save_version(accounts, TB.ACCOUNT, wh.path("account"))
    out = P.reprocess_indicators(spark, wh, "1998-02-01", 5)
    months = sorted(r.periodo_mes for r in out.select("periodo_mes").distinct().collect())
    assert months == ["1998-02-01", "1998-03-01"]
    want = A.management_indicators(fact, accounts, MEASURES, DERIVED, period="1998-03-01")
    got = out.where("periodo_mes = '1998-03-01'").select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_statements_from_one_shared_folder(spark):
    """The reference's layout: every statement kind in the month's folder."""
    from cuadra.plans import fixtures as X
    from cuadra.sinks import tables as SK
    root = shared_dir(spark, "shared-layout")
    lines = ST.statement_lines(X.table(spark, SF_SMALL, "lineitem"), X.table(spark, SF_SMALL, "supplier"))
    ST.write_files(lines.withColumn("path", F.regexp_replace("path", "^[a-z0-9]+/", "")), root)
    wh = P.Warehouse(shared_dir(spark, "wh6"))
    fact = X.statement_fact(X.table(spark, SF_SMALL, "lineitem")).where("periodo_mes = '1998-03-01'")
    registered = fact.select("periodo_mes", "ins_id", F.lit("x").alias("ins_nombre")).distinct()
    SK.partition_replace(registered, TB.INSTITUTION_MONTH, wh.path("institution_month"))
    months = fact.select("periodo_mes", "planCuenta_id", F.lit("name").alias("planCuenta_Nombre")).distinct()
    SK.partition_replace(months, TB.ACCOUNT_MONTH, wh.path("account_month"))
    res = P.statements(spark, root, wh, 1998, 3, RELAXED["stmt"])
    rules = {r.rule_id: r.n_rows for r in res.summary.collect()}
    # every kind was found in the shared folder: each file rule saw that kind's rows
    for origin in RW.STATEMENTS:
        want = fact.where(F.col("eerr_origen") == origin).count()
        assert rules[f"{origin}:rows_per_file"] == want > 0


def test_statement_completeness_sees_absent_and_empty_files(spark):
    """Every registered institution owes every kind; no file and a file with
    only its header both fail, and nothing is written."""
    root = shared_dir(spark, "incomplete")
    banks, kinds = ["001", "002", "003"], list(RW.STATEMENTS)
    rows = []
    for bank in banks:
        for kind in kinds:
            if (bank, kind) == ("002", "C2"):
                continue                                    # no file at all
            path = f"199803/{kind.lower()}199803{bank}.txt"
            rows.append((path, 0, f"{bank}\tBANK {bank}"))
            if (bank, kind) == ("003", "C1"):
                continue                                    # header only
            amounts = ["1,5"] * (4 if kind in ("B1", "R1") else 1)
            account = str(1000000 + kinds.index(kind))
            rows.append((path, 1, "\t".join([account, *amounts])))
    from cuadra.sinks import tables as SK

    def run(path_rows, name):
        folder = shared_dir(spark, name)
        ST.write_files(spark.createDataFrame(path_rows, "path string, _ord int, value string"), folder)
        wh = P.Warehouse(shared_dir(spark, f"wh-{name}"))
        SK.partition_replace(spark.createDataFrame([("1998-03-01", b, f"BANK {b}") for b in banks],
                                                   "periodo_mes string, ins_id string, ins_nombre string"),
                             TB.INSTITUTION_MONTH, wh.path("institution_month"))
        SK.partition_replace(spark.createDataFrame([("1998-03-01", str(1000000 + i), "an account") for i in range(4)],
                                                   "periodo_mes string, planCuenta_id string, planCuenta_Nombre string"),
                             TB.ACCOUNT_MONTH, wh.path("account_month"))
        return P.statements(spark, folder, wh, 1998, 3, RELAXED["stmt"]), wh

    res, wh = run(rows, "incomplete")
    failed = {r.rule_id: r.n_bad for r in res.summary.where("NOT passed").collect()}
    assert not res.ok and res.written is None and failed["statement_files"] == 2
    assert not SK.exists(wh.path("statement"))
    whole = [*rows, ("199803/c2199803002.txt", 0, "002\tBANK 002"), ("199803/c2199803002.txt", 1, "1000003\t1,5"),
             ("199803/c1199803003.txt", 1, "1000002\t1,5")]
    res, wh = run(whole, "complete")
    assert res.ok, [r.asDict() for r in res.summary.where("NOT passed").collect()]
    assert res.written.count() == 12


def test_enrichment_stops_on_repeated_assignments(spark):
    from cuadra.sinks import tables as SK
    wh = P.Warehouse(shared_dir(spark, "wh7"))
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    accounts = TB.governed_accounts(part)
    SK.save_version(accounts, TB.ACCOUNT, wh.path("account"))
    one = accounts.first()
    root = shared_dir(spark, "twice")
    raw = dataclasses.replace(RW.ASIGNA, min_rows=1, max_rows=100000)
    path = RW.ASIGNA.template.replace("{{NUM}}", "1")
    lines = [(path, i, f"{one.planCuenta_id};{one.producto_id};{one.negocio_id};x") for i in range(2)]
    ST.write_files(spark.createDataFrame(lines, "path string, _ord int, value string"), root)
    masters = {"negocio": TB.business_lines(part), "producto": TB.products(part)}
    res = P.account_enrichment(spark, root, wh, "1", masters, raw)
    assert not res.ok and res.written is None and SK.versions(wh.path("account")) == [1]


def test_a_range_stops_at_the_first_failing_month(spark, roots):
    wh = P.Warehouse(shared_dir(spark, "wh8"))
    strict = dataclasses.replace(RELAXED["plan"], min_rows=10**6, max_rows=10**7)
    seen = []

    def job(year, month):
        seen.append((year, month))
        return P.account(spark, roots["plan"], wh, year, month, strict if month == 1 else RELAXED["plan"])
    done = P.run_range(job, "1997-12-01", 4)
    assert [r.ok for r in done] == [True, False] and seen == [(1997, 12), (1998, 1)]
