"""Statements of many institutions: packed files, shared folders, and no broadcast of what grows with the tables."""

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from cuadra.operators import analytics as A
from cuadra.operators import joins as JN
from cuadra.operators import observed as OB
from cuadra.operators import quality as Q
from cuadra.plans import jobs as J
from cuadra.plans import monthly as P
from cuadra.plans import oracle
from cuadra.plans import raws as RW
from cuadra.plans import staging as ST
from cuadra.plans import tables as TB
from cuadra.sinks import tables as SK
from cuadra.specs import ColumnSpec, TableKind, TableSpec
from tools.compare import rows_of

PLAIN = TableSpec("t", TableKind.TRANSACTION, (ColumnSpec("periodo_mes", pk=True), ColumnSpec("ins_id", pk=True), ColumnSpec("n", "int")),
                  partition_cols=("periodo_mes", "ins_id"), rebalance=True)
SHARED = TableSpec("t", TableKind.TRANSACTION, PLAIN.columns, partition_cols=PLAIN.partition_cols, rebalance=True, partition_groups=3)


def _local(path):
    return path.replace("file://", "")


@pytest.fixture(scope="module")
def banks(tmp_path_factory):
    """Suppliers 995 to 1004 report every statement kind from January to April 1998."""
    root, con = tmp_path_factory.mktemp("banks"), duckdb.connect()
    tables = {
        "supplier": "SELECT 995 + i AS s_suppkey, 'Supplier ' || i AS s_name, 1 AS s_nationkey, 10.0::DOUBLE AS s_acctbal FROM range(10) r(i)",
        "part": "SELECT i AS p_partkey, 'some part ' || i AS p_name, 'Brand#1' AS p_brand, 'LARGE' AS p_type, 1 AS p_size, 1.0::DOUBLE AS p_retailprice FROM range(16) r(i)",
        "lineitem": "SELECT i AS l_orderkey, i % 16 AS l_partkey, 995 + (i // 16) % 10 AS l_suppkey, 1 AS l_linenumber, 3.0::DOUBLE AS l_quantity, "
                    "(100 + i)::DOUBLE AS l_extendedprice, 0.05::DOUBLE AS l_discount, 0.02::DOUBLE AS l_tax, "
                    "['A', 'R', 'N', 'N'][1 + i % 4] AS l_returnflag, ['F', 'F', 'F', 'O'][1 + i % 4] AS l_linestatus, "
                    "TIMESTAMP '1998-01-10' + to_months((i // 160)::INTEGER) AS l_shipdate FROM range(640) r(i)",
    }
    for name, sql in tables.items():
        con.execute(f"COPY ({sql}) TO '{root}/{name}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return str(root), con


def test_a_range_of_many_institutions_takes_few_files_and_folders(spark, banks, monkeypatch):
    root, con = banks
    monkeypatch.setattr(J, "INSTITUTIONS_A_FOLDER", 4)
    files, made, write, warehouse = [], [], ST.write_files, J._warehouse
    monkeypatch.setattr(ST, "write_files", lambda *a, **k: (files.append(write(*a, **k)), files[-1])[1])
    monkeypatch.setattr(J, "_warehouse", lambda *a, **k: (made.append(warehouse(*a, **k)), made[-1])[1])
    df = J.q_statements_range_job(spark, root)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(oracle.oracle_sql()["statements_range_job"])
    cols = [d[0] for d in res.description]
    assert len(got) == 320 and rows_of(df.columns, got) == rows_of(cols, res.fetchall())
    # institution lists and charts of four months; the 160 statement files are packed
    assert sum(files) == 8
    table = _local(made[0].path("statement"))
    assert len(glob.glob(f"{table}/periodo_mes=*")) == 2 and len(glob.glob(f"{table}/*/*")) <= 2 * 3 and not glob.glob(f"{table}/*/ins_id=*")


def test_few_institutions_keep_a_folder_each(spark, banks):
    assert J._warehouse(spark, banks[0], shared_folders=True).spec(TB.STATEMENT).partition_groups is None


def test_partitions_that_share_folders_are_replaced_apart(spark, tmp_path):
    loads = [[("1998-01-01", f"{i:03d}", k) for i in range(20) for k in range(2)] + [("1998-02-01", "001", 1), ("1998-02-01", None, 2)],
             [("1998-01-01", "003", 7), ("1998-01-01", "003", 7), ("1998-01-01", "900", 8)],       # one partition of many, and a new one
             [("1998-02-01", None, 9)],
             [],
             [("1998-03-01", "001", 1)]]
    for rows in loads:
        batch = spark.createDataFrame(rows, "periodo_mes string, ins_id string, n int")
        plain, shared = [SK.partition_replace(batch, s, str(tmp_path / k)) for s, k in ((PLAIN, "plain"), (SHARED, "shared"))]
        found = [sorted((tuple(r) for r in df.select("periodo_mes", "ins_id", "n").collect()), key=repr) for df in (plain, shared)]
        assert found[0] == found[1] and set(shared.columns) == set(PLAIN.names)
    assert len(found[0]) == 44
    assert len(glob.glob(f"{tmp_path}/plain/*/*")) == 24 and len(glob.glob(f"{tmp_path}/shared/*/*")) <= 3 * 3
    # a replace of what was read from the table itself
    twice = SK.partition_replace(SK.read_table(spark, SHARED, str(tmp_path / "shared")).withColumn("n", F.col("n") + 1), SHARED, str(tmp_path / "shared"))
    assert twice.agg(F.sum("n")).first()[0] == sum(r[2] + 1 for r in found[1])
    assert os.path.isdir(tmp_path / "shared" / "periodo_mes=1998-03-01")


def test_sides_that_grow_with_the_tables_are_not_broadcast(spark, monkeypatch):
    frame = lambda cols: spark.range(3).selectExpr(*cols)
    fact = frame(["'1998-01-01' AS periodo_mes", "lpad(id, 3, '0') AS ins_id", "lpad(id, 7, '0') AS planCuenta_id"])
    account = frame(["lpad(id, 7, '0') AS planCuenta_id", "'name of it' AS planCuenta_Nombre", *[f"CAST(NULL AS STRING) AS {c}" for c in ("negocio_id", "producto_id", "planCuenta_Concepto")]])
    counts = fact.selectExpr("periodo_mes", "ins_id", "'B1' AS eerr_origen", "1L AS n_rows")
    marked = lambda: OB.mark(fact.withColumn("planCuenta_Nombre", F.lit("name")), TB.ACCOUNT_MONTH, {"account": account}).rows
    small = marked()
    monkeypatch.setattr(JN, "BROADCAST_KEYS", 2)
    in_scope, missing = A.month_scope(fact, JN.key_side(fact.select("periodo_mes", "ins_id")))
    plans = {
        "mark": marked(),
        "history": SK.history_events(account, account, TB.ACCOUNT, "1998-01-01 00:00:00", "chart"),
        "scope": in_scope, "missing": missing, "repeated": Q.repeated_rows(fact, ["ins_id"]),
        "completeness": P.completeness(fact, counts, RW.STATEMENTS),
    }
    plan_of = lambda df: (df.collect(), df._jdf.queryExecution().executedPlan().toString())[1]
    for name, df in plans.items():
        assert "SortMergeJoin" in plan_of(df) and "BroadcastHashJoin" not in plan_of(df), name
    assert "BroadcastHashJoin" in plan_of(small)
