"""Checks observed in one pass, the quality log, history, ranges, caps and profiles."""

import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from cuadra.operators import analytics as A
from cuadra.operators import observed as OB
from cuadra.operators import profiles as PR
from cuadra.operators import quality as Q
from cuadra.plans import fixtures as X
from cuadra.plans import monthly as P
from cuadra.plans import raws as RW
from cuadra.plans import tables as TB
from cuadra.plans.staging import write_files
from cuadra.session import shared_dir
from cuadra.sinks import bucketed as BK
from cuadra.sinks import tables as SK
from cuadra.specs import ColumnSpec, ForeignKey, Rule, Severity, TableKind, TableSpec
from tests.conftest import SF_SMALL

SPEC = TableSpec("t", TableKind.REFERENCE, (
    ColumnSpec("id", pk=True, min_len=2), ColumnSpec("code", nullable=True, unique=True),
    ColumnSpec("ref", nullable=True), ColumnSpec("n", "int", min_value="0")),
    foreign_keys=(ForeignKey("r", (("ref", "key"),), nullable=True, severity=Severity.WARNING_EXCLUDE),),
    rules=(Rule("small", "n < 100", tolerance_rows=1), Rule("total", "sum(n) > 0", level="aggregate")))
ROWS = [("aa", "x", "k", 1), ("aa", "y", None, 5), ("b", "x", "z", 200), ("cc", None, "k", -1), (None, None, "z", None), ("dd", "w", "k", 300)]


def batch(spark, rows=ROWS):
    return (spark.createDataFrame(rows, "id string, code string, ref string, n int"),
            {"r": spark.createDataFrame([("k",), ("k",), ("m",)], "key string")})


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], []])
def test_one_pass_gives_what_the_separate_rules_give(spark, rows):
    df, refs = batch(spark, rows)
    plain, one = Q.check(df, SPEC, refs), OB.check_and_stage(df, SPEC, refs)
    assert rows_of(one.summary.select(*Q.SUMMARY_COLUMNS)) == rows_of(plain.summary.select(*Q.SUMMARY_COLUMNS))
    assert rows_of(one.details) == rows_of(plain.details)
    assert rows_of(one.kept) == rows_of(plain.kept.select(*one.kept.columns))
    assert one.metrics["n"] == len(rows)
    with pytest.raises(ValueError, match="no reference"):
        OB.check_and_stage(df, SPEC)


def test_the_source_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(it):
        for pdf in it:
            seen.add(len(pdf))
            yield pdf
    df, refs = batch(spark)
    source = df.mapInPandas(count, df.schema)
    res = OB.check_and_stage(source, SPEC, refs)
    res.summary.collect(), res.details.collect(), res.kept.collect()
    assert seen.value == len(ROWS)


def test_results_by_period_equal_those_of_each_period_alone(spark):
    fact = X.statement_fact(X.table(spark, SF_SMALL, "lineitem")).where(F.col("periodo_mes").isin("1998-03-01", "1998-04-01"))
    fact = fact.unionByName(fact.where("ins_id = '003'"))
    refs = {"institution_month": fact.where("ins_id <> '005'").select("ins_id", "periodo_mes"), "account_month": fact.select("planCuenta_id", "periodo_mes")}
    both = OB.check_and_stage(fact, TB.STATEMENT, refs)
    by = OB.results_by(both, "periodo_mes", TB.STATEMENT)
    for period in ("1998-03-01", "1998-04-01"):
        alone = Q.check(fact.where(F.col("periodo_mes") == period), TB.STATEMENT, refs)
        got = by.where(F.col("periodo_mes") == period).select(*Q.SUMMARY_COLUMNS)
        assert rows_of(got) == rows_of(alone.summary.select(*Q.SUMMARY_COLUMNS))
    assert by.where("rule_id = 'pk' AND NOT passed").count() == 2


# ------------------------------------------------------------------ jobs

def chart(spark, rows, period="1998-03-01"):
    """A folder with one chart of accounts: (account, name) or a raw line."""
    root, month = shared_dir(spark, "chart"), period[:7].replace("-", "")
    lines = [(f"{month}/PLAN-CTAS.TXT", i, r if isinstance(r, str) else "\t".join([period[:4], str(int(period[5:7])), *r])) for i, r in enumerate(rows)]
    write_files(spark.createDataFrame(lines, "path string, _ord int, value string"), root)
    return root


def warehouse(spark):
    return P.Warehouse(shared_dir(spark, "wh"))


RAW = dataclasses.replace(RW.PLAN_CTAS, min_rows=1, max_rows=100)


def test_a_failing_job_writes_nothing_but_its_log(spark):
    wh = warehouse(spark)
    root = chart(spark, [("1000000", "first name"), ("1000000", "second name"), ("20", "third name")])
    res = P.account(spark, root, wh, 1998, 3, RAW, run_id="r")
    assert not res.ok and res.written is None and SK.versions(wh.path("account")) == []
    log = {r.rule_id: (r.n_bad, r.passed) for r in SK.read_quality(spark, wh.path("quality"), "dq_results").where("run_id = 'r'").collect()}
    assert log["pk"] == (2, False) and log["planCuenta_id:min_len"] == (1, False) and log["rejected_lines"] == (0, True)
    keys = sorted(r.row_key for r in SK.read_quality(spark, wh.path("quality"), "dq_details").where("rule_id = 'pk'").collect())
    assert keys == ['{"planCuenta_id":"1000000"}'] * 2


def test_rejected_lines_stop_a_load_unless_they_are_allowed(spark):
    rows = [("1000000", "first name"), "1998\t3\t2000000"]
    strict = P.account(spark, chart(spark, rows), warehouse(spark), 1998, 3, RAW)
    assert not strict.ok and strict.rejects.count() == 1
    loose = P.account(spark, chart(spark, rows), warehouse(spark), 1998, 3, dataclasses.replace(RAW, max_rejected=1))
    assert loose.ok and loose.written.count() == 1


def test_year_month_and_row_count_of_a_file(spark):
    other = P.account(spark, chart(spark, ["1998\t4\t1000000\tfirst name"]), warehouse(spark), 1998, 3, RAW)
    assert {r.rule_id for r in other.summary.where("NOT passed").collect()} == {"file_period"}
    few = P.account(spark, chart(spark, [("1000000", "first name")]), warehouse(spark), 1998, 3, dataclasses.replace(RAW, min_rows=2))
    assert {r.rule_id for r in few.summary.where("NOT passed").collect()} == {"rows_in_file"}
    none = P.account(spark, chart(spark, [("1000000", "first name")], "1998-05-01"), warehouse(spark), 1998, 3, RAW)
    assert {r.rule_id for r in none.summary.where("NOT passed").collect()} == {"rows_in_file", "file_period"}


def test_the_cap_on_new_records_stops_a_load(spark):
    wh, capped = warehouse(spark), dataclasses.replace(TB.ACCOUNT, max_new_records_num=1)
    first = [("1000000", "first name"), ("2000000", "second name")]
    assert P.account(spark, chart(spark, first), wh, 1998, 3, RAW, spec=capped).ok            # an empty table takes any number
    assert P.account(spark, chart(spark, [*first, ("3000000", "third name")]), wh, 1998, 3, RAW, spec=capped).ok
    two = P.account(spark, chart(spark, [("4000000", "4th name"), ("5000000", "fifth name")]), wh, 1998, 3, RAW, spec=capped)
    assert not two.ok and {r.rule_id for r in two.summary.where("NOT passed").collect()} == {"max_new_records"}


def test_history_rebuilds_the_table_at_any_time(spark):
    wh = warehouse(spark)
    P.account(spark, chart(spark, [("1000000", "first name"), ("2000000", "second name")]), wh, 1998, 3, RAW)
    P.account(spark, chart(spark, [("1000000", "FIRST NAME")], "1998-04-01"), wh, 1998, 4, RAW)
    P.account(spark, chart(spark, [("1000000", "FIRST NAME")], "1998-05-01"), wh, 1998, 5, RAW)      # changes nothing
    history = SK.read_history(spark, TB.ACCOUNT, wh.path("account_history"))
    at = lambda t: {r.planCuenta_id: r.planCuenta_Nombre for r in SK.as_of(history, TB.ACCOUNT, t).collect()}
    assert at("1998-02-28 00:00:00") == {}
    assert at("1998-03-31 23:59:59") == {"1000000": "first name", "2000000": "second name"}
    assert at("1998-04-01 00:00:00") == {"1000000": "FIRST NAME", "2000000": "second name"} == at("2020-01-01 00:00:00")
    now = SK.read_table(spark, TB.ACCOUNT, wh.path("account")).select(*TB.ACCOUNT.names)
    assert rows_of(SK.as_of(history, TB.ACCOUNT, "2020-01-01 00:00:00")) == rows_of(now)
    spans = {(r.planCuenta_id, r.value): (str(r.valid_from), str(r.valid_to)) for r in SK.intervals(history, TB.ACCOUNT).collect()}
    assert spans[("1000000", "first name")] == ("1998-03-01 00:00:00", "1998-04-01 00:00:00")
    assert spans[("1000000", "FIRST NAME")] == ("1998-04-01 00:00:00", "None")


def test_of_two_loads_at_one_time_the_later_counts(spark, tmp_path):
    path = f"file://{tmp_path}/h"
    empty = SK.read_table(spark, TB.ACCOUNT, f"{path}-none")
    one = spark.createDataFrame([("1000000", "first name", None, None, None)], ", ".join(f"{c.name} string" for c in TB.ACCOUNT.columns))
    two = one.withColumn("planCuenta_Nombre", F.lit("other name"))
    for before, after in ((empty, one), (one, two)):
        SK.append_history(before, after, TB.ACCOUNT, path, "2000-01-01 00:00:00", "t")
    history = SK.read_history(spark, TB.ACCOUNT, path)
    assert SK.as_of(history, TB.ACCOUNT, "2000-01-01 00:00:00").first().planCuenta_Nombre == "other name"
    assert [r.value for r in SK.intervals(history, TB.ACCOUNT).collect()] == ["other name"]


def test_tables_without_backup_keep_two_versions(spark):
    wh, plain = warehouse(spark), dataclasses.replace(TB.ACCOUNT, backup=False)
    for month in (3, 4, 5):
        assert P.account(spark, chart(spark, [("1000000", "first name")], f"1998-0{month}-01"), wh, 1998, month, RAW, spec=plain).ok
    assert SK.versions(wh.path("account")) == [2, 3]


@pytest.mark.parametrize("n", [1, 3])
def test_small_tables_have_the_declared_number_of_files(spark, tmp_path, n):
    rows = spark.range(400).select(F.when(F.col("id") < 200, "1998-03-01").otherwise("1998-04-01").alias("periodo_mes"),
                                   F.lpad(F.col("id").cast("string"), 7, "0").alias("planCuenta_id"), F.lit("some name").alias("planCuenta_Nombre"))
    spec = dataclasses.replace(TB.ACCOUNT_MONTH, num_partitions=n)
    SK.partition_replace(rows.repartition(7), spec, f"{tmp_path}/t")
    for period in ("1998-03-01", "1998-04-01"):
        files = [f for f in os.listdir(f"{tmp_path}/t/periodo_mes={period}") if f.endswith(".parquet")]
        assert len(files) == n
    dim = dataclasses.replace(TB.INSTITUTION, num_partitions=n)
    SK.save_version(rows.selectExpr("substring(planCuenta_id, 5) ins_id", "planCuenta_Nombre ins_nombre").repartition(7), dim, f"{tmp_path}/d")
    assert len([f for f in os.listdir(f"{tmp_path}/d/v=1") if f.endswith(".parquet")]) == n


# ------------------------------------------------------------------ layout and profiles

def test_bucketed_facts_are_compared_without_a_shuffle(spark):
    fact = X.statement_fact(X.table(spark, SF_SMALL, "lineitem"))
    name = BK.save_bucketed(fact, ["planCuenta_id"], shared_dir(spark, "bucketed"), 4)
    keys = ["ins_id", "planCuenta_id"]
    made = A.month_compare(BK.read_bucketed(spark, name), keys, dealt=True, period="1998-03-01")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Bucketed: true" in plan
    assert rows_of(made) == rows_of(A.month_compare(fact, keys, period="1998-03-01"))
    counts = Q.key_counts(BK.read_bucketed(spark, name), ["planCuenta_id", "periodo_mes"])
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()


def test_profiles_of_parts_merge_and_replace(spark, tmp_path):
    orders = X.table(spark, SF_SMALL, "orders").withColumn("m", X.period_of("o_orderdate")).withColumn("empty", F.lit(None).cast("int"))
    cols = ["o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate", "empty"]
    for _ in range(2):                                             # a repeated load replaces its parts
        PR.store_profiles(orders, "m", str(tmp_path / "p"), cols)
    got = {r.column_name: r for r in PR.merge_profiles(PR.read_profiles(spark, "m", str(tmp_path / "p")), (0.25, 0.5)).collect()}
    n = orders.count()
    assert {r.n_rows for r in got.values()} == {n} and got["empty"].n_non_null == 0 and got["empty"].approx_distinct == 0
    assert got["o_orderpriority"].approx_distinct == 5 and got["o_orderpriority"].approx_q50 is None
    low = orders.where(F.col("o_totalprice") <= got["o_totalprice"].approx_q25).count()
    assert abs(low / n - 0.25) < 0.02
    assert float(got["o_custkey"].min_value) == orders.agg(F.min("o_custkey")).first()[0]


# ------------------------------------------------------------------ ranges

def test_a_range_writes_the_months_before_the_first_failure(spark):
    root = shared_dir(spark, "range")
    lines = []
    for month, rows in (("199801", ["0000001\tA name", "0000002\tB name"]), ("199802", ["0000001\tA name"]), ("199803", ["0000001\tA name", "0000009\tnew name"]),
                        ("199804", ["0000001\tA name"])):
        lines += [(f"{month}/PLAN-CTAS.TXT", i, f"{month[:4]}\t{int(month[4:])}\t{r}") for i, r in enumerate(rows)]
    write_files(spark.createDataFrame(lines, "path string, _ord int, value string"), root)
    wh = warehouse(spark)
    known = spark.createDataFrame([("0000001", "A name", None, None, None), ("0000002", "B name", None, None, None)],
                                  ", ".join(f"{c.name} string" for c in TB.ACCOUNT.columns))
    SK.save_version(known, TB.ACCOUNT, wh.path("account"))
    res = P.account_month_range(spark, root, wh, "1998-01-01", 4, RAW)
    assert not res.ok
    assert sorted((r.periodo_mes, r.planCuenta_id) for r in res.written.collect()) == [
        ("1998-01-01", "0000001"), ("1998-01-01", "0000002"), ("1998-02-01", "0000001")]
    bad = {(r.periodo_mes, r.rule_id) for r in res.summary.where("NOT passed").collect()}
    assert bad == {("1998-03-01", "fk:planCuenta_id->account")}
    # a month without a file fails as well
    gap = P.account_month_range(spark, root, warehouse(spark), "1998-04-01", 2, RAW)
    assert ("1998-05-01", "rows_in_file") in {(r.periodo_mes, r.rule_id) for r in gap.summary.where("NOT passed").collect()}
