"""Map the driver's TPC-H style tables onto the governed entities.

institution  <- supplier   ins_id = s_suppkey zero-padded to 3, ins_nombre = s_name
account      <- part       planCuenta_id = p_partkey zero-padded to 7, name = p_name,
                           negocio_id = p_type, producto_id = p_brand,
                           concept = CONCEPTS[p_size % 11] (10 -> null)
statement    <- lineitem   period = month of l_shipdate, bank = supplier, account = part;
                           origin by (l_returnflag, l_linestatus):
                           A -> B1, R -> R1, N/F -> C1, N/O -> C2;
                           B1/R1 components clp, ipc, tdc, tdcb = extendedprice,
                           quantity, discount, tax; C1/C2 amount = extendedprice.

Every function returns a lazy DataFrame over the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadra.functions.expressions import padded_code, period_of
from cuadra.operators.analytics import statement_branch, unify_sources
from cuadra.plans.measures import CONCEPTS

# Origin code by (return flag, line status); None = any status.
ORIGINS = (
    ("B1", "A", None),
    ("R1", "R", None),
    ("C1", "N", "F"),
    ("C2", "N", "O"),
)
COMPONENT_SOURCES = (("clp", "l_extendedprice"), ("ipc", "l_quantity"),
                     ("tdc", "l_discount"), ("tdcb", "l_tax"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def institutions(supplier: DataFrame) -> DataFrame:
    return supplier.select(padded_code("s_suppkey", 3).alias("ins_id"),
                           F.col("s_name").alias("ins_nombre"))


def concept_of(size: Column) -> Column:
    idx = size % 11
    names = F.array(*[F.lit(c) for c in CONCEPTS])
    return F.when(idx < len(CONCEPTS), F.element_at(names, (idx + 1).cast("int")))


def accounts(part: DataFrame) -> DataFrame:
    return part.select(
        padded_code("p_partkey", 7).alias("planCuenta_id"),
        F.col("p_name").alias("planCuenta_Nombre"),
        F.col("p_type").alias("negocio_id"),
        F.col("p_brand").alias("producto_id"),
        concept_of(F.col("p_size")).alias("planCuenta_Concepto"),
    )


def origin_condition(flag: str, status: str | None) -> Column:
    cond = F.col("l_returnflag") == flag
    return cond & (F.col("l_linestatus") == status) if status else cond


def origin_of() -> Column:
    expr = None
    for code, flag, status in ORIGINS:
        expr = (F.when(origin_condition(flag, status), code) if expr is None
                else expr.when(origin_condition(flag, status), code))
    return expr


def _keys() -> list[Column]:
    return [period_of("l_shipdate").alias("periodo_mes"),
            padded_code("l_suppkey", 3).alias("ins_id"),
            padded_code("l_partkey", 7).alias("planCuenta_id")]


def _amount(c: str, as_text: bool) -> Column:
    dec = F.col(c).cast("decimal(23,2)")
    return F.translate(dec.cast("string"), ".", ",") if as_text else dec


def statement_extracts(lineitem: DataFrame, as_text: bool = False) -> dict[str, DataFrame]:
    """The four raw statements (B1, R1, C1, C2) as the banks report them.

    ``as_text``: amounts as decimal-comma strings, like the files."""
    out = {}
    for code, flag, status in ORIGINS:
        part = lineitem.where(origin_condition(flag, status))
        if code in ("B1", "R1"):
            amounts = [_amount(src, as_text).alias(name) for name, src in COMPONENT_SOURCES]
        else:
            amounts = [_amount("l_extendedprice", as_text).alias("monto")]
        out[code] = part.select(*_keys(), *amounts)
    return out


def statement_fact_union(lineitem: DataFrame, as_text: bool = False) -> DataFrame:
    """Unified fact built like the reference job: one branch per statement,
    UNION ALL (each branch scans its own extract)."""
    branches = []
    for code, df in statement_extracts(lineitem, as_text).items():
        if code in ("B1", "R1"):
            branches.append(statement_branch(df, code, components=[n for n, _ in COMPONENT_SOURCES]))
        else:
            branches.append(statement_branch(df, code, total="monto"))
    return unify_sources(branches)


def statement_fact(lineitem: DataFrame) -> DataFrame:
    """Same rows as ``statement_fact_union`` in one pass over lineitem.

    The fixture stores the four statements in one table, so the union of four
    filtered scans is a single projection with the origin as a CASE."""
    origin = origin_of()
    keyed = (lineitem.select(*_keys(), origin.alias("eerr_origen"),
                             *[F.col(src) for _, src in COMPONENT_SOURCES])
             .where(F.col("eerr_origen").isNotNull()))
    detailed = F.col("eerr_origen").isin("B1", "R1")
    zero = F.lit(0).cast("decimal(23,2)")
    comps = {name: F.when(detailed, F.col(src).cast("decimal(23,2)") * F.lit(1000000))
             .otherwise(zero * F.lit(1000000)) for name, src in COMPONENT_SOURCES}
    total_detailed = None
    for name, _ in COMPONENT_SOURCES:
        c = F.col(dict(COMPONENT_SOURCES)[name]).cast("decimal(23,2)") * F.lit(1000000)
        total_detailed = c if total_detailed is None else total_detailed + c
    total = F.when(detailed, total_detailed).otherwise(
        F.col("l_extendedprice").cast("decimal(23,2)") * F.lit(1000000))
    return keyed.select(
        "periodo_mes", "ins_id", "planCuenta_id", "eerr_origen",
        *[comps[name].try_cast("decimal(26,2)").alias(f"eerr_Monto_{name}") for name, _ in COMPONENT_SOURCES],
        total.try_cast("decimal(26,2)").alias("eerr_Monto"),
    )
