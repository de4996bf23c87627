"""A bundle gives the lines, headers and inventory of the files that are packed in it."""

import glob

import pytest
from pyspark.sql import functions as F

from cuadra.plans import raws as RW
from cuadra.plans import staging as ST
from cuadra.sources import text as TX

RAW = RW.C1
KEYS = [TX.FILE, "YYYY", "MM", "Cod_Banco"]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("piece", [1 << 20, 64])
def test_bundle_equals_files(spark, tmp_path, monkeypatch, piece):
    monkeypatch.setattr(ST, "PIECE", piece)
    lines = spark.range(60).select(
        F.format_string("199803/c1199803%03d.txt", F.col("id") % 3).alias("path"), F.col("id").cast("int").alias("_ord"),
        F.when(F.col("id") < 3, F.format_string("%03d\tBank é\t19", F.col("id"))).when(F.col("id") == 30, "")
        .otherwise(F.format_string("%07d\t%d,50", "id", "id")).alias("value"))
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    ST.write_files(lines, plain)
    ST.bundle_files(lines, packed)
    files, bundle = TX.Landing(spark, plain), TX.Bundle(spark, packed)
    assert bundle.whole == (piece > 1000)
    for land_rows in (
        lambda la: TX.raw_lines(la, RAW).select("Cod_Banco", TX.LINE),
        lambda la: TX.raw_lines(la, RAW, periods=["1998-04-01"]).select("Cod_Banco", TX.LINE),
        lambda la: TX.header_records(TX.raw_lines(la, RAW), ("codigo", "banco", "filas"), keys=KEYS).drop(TX.FILE),
        lambda la: TX.scan_raw(la, RAW).data.drop(TX.FILE),
        lambda la: TX.inventory(la, {"C1": RAW}).select("raw_name", "YYYY", "MM", "Cod_Banco", "length"),
    ):
        assert _rows(land_rows(bundle)) == _rows(land_rows(files))


def test_many_statement_files_take_few_files(spark, tmp_path):
    lines = spark.range(2000).select(F.format_string("199803/c1199803%04d.txt", "id").alias("path"), F.lit(0).alias("_ord"), F.lit("a\tb\t0").alias("value"))
    ST.bundle_files(lines, str(tmp_path / "packed"))
    assert len(glob.glob(f"{tmp_path}/packed/*.parquet")) <= 8
    assert TX.inventory(TX.Bundle(spark, str(tmp_path / "packed")), {"C1": RAW}).count() == 2000
