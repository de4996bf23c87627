"""Splittable, layout-driven scans: blocks, headers, dates, wildcards, rejected lines."""

import base64
import dataclasses
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from cuadra.sources import text as TX
from cuadra.specs import RawSetting, RawSpec

COLUMNS = (("cuenta", "string"), ("monto", "int"))
RAW = RawSpec("x", "{{YYYY}}{{MM}}/x{{YYYY}}{{MM}}{{Cod_Banco}}.txt", (
    RawSetting("2000-01-01", "2000-06-30", COLUMNS, header_fields=("codigo", "banco")),
    RawSetting("2000-07-01", "2000-12-31", tuple(reversed(COLUMNS)), sep=";", header_fields=("codigo", "banco")),
    RawSetting("2001-01-01", "2001-12-31", COLUMNS, header_fields=("codigo", "banco")),
    RawSetting("2001-06-01", "2001-12-31", COLUMNS, header_fields=("codigo", "banco"))))


def put(root, path, content):
    full = f"{root}/{path}"
    os.makedirs(os.path.dirname(full), exist_ok=True)
    with open(full, "wb") as f:
        f.write(content if isinstance(content, bytes) else content.encode())


@pytest.fixture
def small_splits(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path, small_splits):
    """The header is the first line of the first block; repeated headers go wherever they stand."""
    rows = [f"{i:07d}\t{i}" for i in range(2000)]
    for at in (0, 700, 1500):
        rows.insert(at, "001\tBANK")
    put(tmp_path, "200003/x200003001.txt", "\n".join(rows) + "\n")
    put(tmp_path, "200003/x200003002.txt", "002\tOTHER\n0000001\t5\n")
    put(tmp_path, "200003/x200003003.txt", "003\tEMPTY\n")
    put(tmp_path, "200003/x200003004.txt", "")
    scan = TX.scan_raw(TX.Landing(spark, str(tmp_path)), RAW)
    assert scan.data.rdd.getNumPartitions() > 1
    blocks = TX.raw_lines(TX.Landing(spark, str(tmp_path)), RAW).select(TX.FILE, "_block").distinct()
    assert blocks.groupBy(TX.FILE).count().agg(F.max("count")).first()[0] > 5
    assert sorted((r.codigo, r.banco) for r in scan.headers.collect()) == [("001", "BANK"), ("002", "OTHER"), ("003", "EMPTY")]
    got = sorted((r.Cod_Banco, r.cuenta, r.monto) for r in scan.data.collect())
    assert got == sorted([("001", f"{i:07d}", i) for i in range(2000)] + [("002", "0000001", 5)])
    assert scan.rejects.count() == 0
    plan = scan.data._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan


def test_the_layout_of_a_file_is_that_of_its_date(spark, tmp_path):
    put(tmp_path, "200006/x200006001.txt", "001\tA\n0000001\t5\n")
    put(tmp_path, "200007/x200007001.txt", "001\tA\n6;0000001\n")
    put(tmp_path, "200101/x200101001.txt", "001\tA\n0000001\t7\n")
    put(tmp_path, "200107/x200107001.txt", "001\tA\n0000001\t8\n")          # two layouts
    put(tmp_path, "199912/x199912001.txt", "001\tA\n0000001\t9\n")          # none
    scan = TX.scan_raw(TX.Landing(spark, str(tmp_path)), RAW)
    got = {f"{r.YYYY}{r.MM}": (r.cuenta, r.monto) for r in scan.data.collect()}
    assert got == {"200006": ("0000001", 5), "200007": ("0000001", 6), "200101": ("0000001", 7)}
    assert sorted((r.YYYY + r.MM, r._line, r._reason) for r in scan.rejects.collect()) == [("199912", 2, "layout"), ("200107", 2, "layout")]


def test_lines_that_cannot_be_taken_are_kept_aside_and_counted(spark, tmp_path):
    put(tmp_path, "200001/x200001001.txt", b"001\tA\n0000001\t5\n0000002\n\n0000003\t6\t7\n\xe9000004\t8\n0000005\tno\n")
    seen = Observation("seen")
    scan = TX.scan_raw(TX.Landing(spark, str(tmp_path)), RAW, observation=seen)
    assert sorted((r.cuenta, r.monto) for r in scan.data.collect()) == [("0000001", 5), ("0000005", None)]
    assert seen.get == {"n_lines": 5, "n_rejected": 3}
    got = sorted((r._line, r._reason, base64.b64decode(r.content)) for r in scan.rejects.collect())
    assert got == [(3, "fields", b"0000002"), (5, "fields", b"0000003\t6\t7"), (6, "encoding", b"\xe9000004\t8")]


@pytest.mark.parametrize("params,banks", [({}, ["001", "012"]), ({"Cod_Banco": "*"}, ["001", "012"]), ({"Cod_Banco": "0*2"}, ["012"]),
                                          ({"Cod_Banco": "001"}, ["001"]), ({"Cod_Banco": "0.1"}, [])])
def test_parameters_literal_and_wildcard(spark, tmp_path, params, banks):
    for bank in ("001", "012"):
        put(tmp_path, f"200001/x200001{bank}.txt", f"{bank}\tA\n0000001\t5\n")
    put(tmp_path, "200001/sub/x200001099.txt", "099\tA\n0000001\t5\n")
    lines = TX.raw_lines(TX.Landing(spark, str(tmp_path)), RAW, params)
    assert sorted(r.Cod_Banco for r in lines.select("Cod_Banco").distinct().collect()) == banks


def test_a_scan_opens_only_the_files_of_its_template_and_months(spark, tmp_path):
    for month in ("01", "02", "03"):
        put(tmp_path, f"2000{month}/x2000{month}001.txt", "001\tA\n0000001\t5\n")
        put(tmp_path, f"2000{month}/OTHER.TXT", "none of ours\n" * 50)
    land = TX.Landing(spark, str(tmp_path))
    lines = TX.raw_lines(land, RAW, periods=["2000-02-01"])
    assert {r.MM for r in lines.collect()} == {"02"}
    scan = lines._jdf.queryExecution().executedPlan().toString()
    assert "file_path" in scan
    assert TX.inventory(land, {"x": RAW}).where("length = 16").count() == 3


def test_latin1_layouts_are_decoded(spark, tmp_path):
    raw = dataclasses.replace(RAW, settings=tuple(dataclasses.replace(s, encoding="ISO-8859-1") for s in RAW.settings))
    put(tmp_path, "200001/x200001001.txt", "001\tA\nñ\t5\n".encode("latin-1"))
    scan = TX.scan_raw(TX.Landing(spark, str(tmp_path)), raw)
    assert [(r.cuenta, r.monto) for r in scan.data.collect()] == [("ñ", 5)]


def test_a_column_may_not_change_its_type_between_layouts(spark, tmp_path):
    put(tmp_path, "200001/x200001001.txt", "a\n")
    raw = RawSpec("x", RAW.template, (RawSetting("2000-01-01", "2000-06-30", (("a", "int"),)), RawSetting("2000-07-01", "2000-12-31", (("a", "string"),))))
    with pytest.raises(ValueError, match="in one layout"):
        TX.scan_raw(TX.Landing(spark, str(tmp_path)), raw)
