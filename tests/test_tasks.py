"""A comparison is dealt to tasks in proportion to its rows."""

from pyspark.sql import functions as F

from cuadra.operators import analytics as A


def _most_in_a_task(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_rows_a_task_do_not_grow_with_the_fact(spark, monkeypatch):
    monkeypatch.setattr(A, "ROWS_A_TASK", 500)
    for n in (5_000, 20_000):
        fact = spark.range(n).select(F.lit("1998-03-01").alias("periodo_mes"), F.col("id").cast("string").alias("ins_id"),
                                     (F.col("id") % 7).cast("string").alias("planCuenta_id"), F.lit(1).cast("decimal(26,2)").alias("eerr_Monto"))
        assert A.tasks_for(fact) == n // 500
        for made in (A.month_compare(fact, ["ins_id", "planCuenta_id"]), A.ytd_to_month(fact, ["ins_id", "planCuenta_id"])):
            assert made.count() == n
            assert _most_in_a_task(made) < 2 * 500


def test_an_empty_fact_has_one_task(spark):
    assert A.tasks_for(spark.range(0)) == 1
