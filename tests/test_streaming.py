"""The streaming ingest produces the batch job's rows."""

from pyspark.sql import functions as F

from cuadra.plans import fixtures as X
from cuadra.plans import raws as RW
from cuadra.plans import staging as ST
from cuadra.plans import tables as TB
from cuadra.session import shared_dir
from cuadra.sinks import tables as SK
from cuadra.streaming import start_statement_stream
from tests.conftest import SF_SMALL


def test_stream_equals_batch(spark):
    root = ST.stage(spark, SF_SMALL, "stmt")
    out = shared_dir(spark, "stream-table")
    for origin in ("B1", "C2"):
        q = start_statement_stream(spark, f"{root}/{origin.lower()}", RW.STATEMENTS[origin], origin,
                                   TB.STATEMENT, out, available_now=True, max_files=200)
        q.awaitTermination(600)
        assert q.exception() is None
    got = SK.read_table(spark, TB.STATEMENT, out)
    want = X.statement_fact(X.table(spark, SF_SMALL, "lineitem")).where(F.col("eerr_origen").isin("B1", "C2"))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0
