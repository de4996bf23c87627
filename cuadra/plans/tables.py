"""Governed tables of the monthly bank-statement mart, and the fixture
derivations that feed them.

Fixed values: column names, keys, length bounds, external codes, severities
and partition settings below must equal the reference's declarations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadra.functions.expressions import padded_code, period_of
from cuadra.plans import fixtures as X
from cuadra.specs import ColumnSpec as C
from cuadra.specs import ForeignKey, Rule, Severity, TableKind, TableSpec

AMT = "decimal(26,2)"

# Institution dimension.
INSTITUTION = TableSpec(
    name="institution", kind=TableKind.REFERENCE, backup=True, num_partitions=1,
    pk_external_code="COD_ERROR",
    columns=(
        C("ins_id", pk=True, min_len=3, max_len=3, min_len_code="ERR_01", max_len_code="ERR_01",
          description="institution code"),
        C("ins_nombre", min_len=5, max_len=100, min_len_code="ERR_02", max_len_code="ERR_02",
          description="institution name"),
    ),
)

# Institutions registered per month.
INSTITUTION_MONTH = TableSpec(
    name="institution_month", kind=TableKind.TRANSACTION, num_partitions=1,
    pk_external_code="COD_ERROR", partition_cols=("periodo_mes",),
    columns=(
        C("periodo_mes", pk=True, description="period"),
        C("ins_id", pk=True, min_len=3, max_len=3, min_len_code="ins_id_ERROR_LEN",
          max_len_code="ins_id_ERROR_LEN", description="institution code"),
        C("ins_nombre", description="institution name"),
    ),
    foreign_keys=(ForeignKey("institution", (("ins_id", "ins_id"),)),),
)

# Chart-of-accounts dimension with change tracking.
ACCOUNT = TableSpec(
    name="account", kind=TableKind.REFERENCE, backup=True, num_partitions=1, pk_external_code="COD_ERROR",
    columns=(
        C("planCuenta_id", pk=True, min_len=7, max_len=7, min_len_code="ERROR_01",
          max_len_code="ERROR_01", description="account code"),
        C("planCuenta_Nombre", min_len=5, max_len=100, min_len_code="ERROR_02", max_len_code="ERROR_02",
          track_old=True, track_at=True, track_by=True, description="account name"),
        C("negocio_id", nullable=True, required=False, track_old=True, track_at=True, track_by=True,
          description="business line of the account"),
        C("producto_id", nullable=True, required=False, track_old=True, track_at=True, track_by=True,
          description="product of the account"),
        C("planCuenta_Concepto", nullable=True, required=False, track_old=True, track_at=True,
          track_by=True, description="concept the account feeds (placement, provision, ...)"),
    ),
    foreign_keys=(
        ForeignKey("negocio", (("negocio_id", "negocio_id"),), nullable=True,
                   severity=Severity.WARNING_EXCLUDE, external_code="ERROR_FK_NEGOCIO"),
        ForeignKey("producto", (("producto_id", "producto_id"),), nullable=True,
                   severity=Severity.ERROR, external_code="ERROR_FK_PRODUCTO"),
    ),
    rules=(Rule("DQ_CuentaCorta", "length(planCuenta_Nombre) <= 10", severity=Severity.WARNING,
                error_code=1, column="planCuenta_Nombre", description="short account name"),),
)

# Accounts per month.
ACCOUNT_MONTH = TableSpec(
    name="account_month", kind=TableKind.TRANSACTION, num_partitions=1,
    pk_external_code="COD_ERROR", partition_cols=("periodo_mes",),
    columns=(
        C("periodo_mes", pk=True, description="period"),
        C("planCuenta_id", pk=True, min_len=7, max_len=7, min_len_code="ERROR_01",
          max_len_code="ERROR_01", description="account code"),
        C("planCuenta_Nombre", min_len=5, max_len=100, min_len_code="ERROR_02",
          max_len_code="ERROR_02", description="account name"),
    ),
    foreign_keys=(ForeignKey("account", (("planCuenta_id", "planCuenta_id"),)),),
)

# Unified statement fact, partitioned by period and institution.
STATEMENT = TableSpec(
    name="statement", kind=TableKind.TRANSACTION, num_partitions=1, rebalance=True, pk_external_code="COD_ERROR",
    partition_cols=("periodo_mes", "ins_id"), one_value_partitions=("periodo_mes", "ins_id"),
    columns=(
        C("periodo_mes", pk=True, description="period"),
        C("ins_id", pk=True, min_len=3, max_len=3, min_len_code="ERROR_01", max_len_code="ERROR_02",
          description="institution code"),
        C("planCuenta_id", pk=True, min_len=7, max_len=7, min_len_code="ERROR_03",
          max_len_code="ERROR_04", description="account code"),
        C("eerr_origen", description="source statement (B1, R1, C1, C2)"),
        C("eerr_Monto_clp", AMT, description="amount, non-indexed local currency"),
        C("eerr_Monto_ipc", AMT, description="amount, inflation-indexed"),
        C("eerr_Monto_tdc", AMT, description="amount, indexed by exchange rate"),
        C("eerr_Monto_tdcb", AMT, description="amount, foreign currency"),
        C("eerr_Monto", AMT, description="total amount"),
    ),
    foreign_keys=(
        ForeignKey("institution_month", (("ins_id", "ins_id"), ("periodo_mes", "periodo_mes"))),
        ForeignKey("account_month", (("planCuenta_id", "planCuenta_id"), ("periodo_mes", "periodo_mes"))),
    ),
)

# Management indicators.
_INDICATOR_MEASURES = (
    "gestion_colocacion_mes", "gestion_colocacionMora90_mes", "gestion_provision_mes",
    "gestion_provision_Ano", "gestion_provisionStock", "gestion_castigo_mes", "gestion_castigo_Ano",
    "gestion_recupero_mes", "gestion_recupero_Ano", "gestion_gastoRiesgo_mes",
    "gestion_gastoRiesgo_Ano", "gestion_ingresoInteres_mes", "gestion_gastoInteres_mes",
    "gestion_ingresoComision_mes", "gestion_gastoComision_mes", "gestion_utilidadFinanciera_mes",
)
INDICATORS = TableSpec(
    name="indicators", kind=TableKind.TRANSACTION, num_partitions=1, rebalance=True,
    pk_external_code="COD_ERROR", partition_cols=("periodo_mes",),
    columns=(
        C("periodo_mes", pk=True),
        C("ins_id", pk=True, min_len=3, max_len=3, min_len_code="ERROR_01", max_len_code="ERROR_01"),
        C("producto_id", pk=True),
        C("negocio_id", pk=True),
        *[C(m, AMT) for m in _INDICATOR_MEASURES],
    ),
    foreign_keys=(
        ForeignKey("institution", (("ins_id", "ins_id"),)),
        ForeignKey("negocio", (("negocio_id", "negocio_id"),)),
        ForeignKey("producto", (("producto_id", "producto_id"),)),
    ),
)


# ------------------------------------------------- fixture-derived inputs

def governed_accounts(part: DataFrame) -> DataFrame:
    """Account dimension after enrichment: accounts without a concept are
    not assigned to a product or business line (derived null cases)."""
    acct = X.accounts(part)
    assigned = F.col("planCuenta_Concepto").isNotNull()
    return acct.select(
        "planCuenta_id", "planCuenta_Nombre",
        F.when(assigned, F.col("negocio_id")).alias("negocio_id"),
        F.when(assigned, F.col("producto_id")).alias("producto_id"),
        "planCuenta_Concepto")


def business_lines(part: DataFrame) -> DataFrame:
    """Business-line master: promotional lines are not registered."""
    return part.where(F.col("p_type") != "PROMO").select(F.col("p_type").alias("negocio_id")).distinct()


def products(part: DataFrame) -> DataFrame:
    """Product master: every brand."""
    return part.select(F.col("p_brand").alias("producto_id")).distinct()


def registered_institutions(supplier: DataFrame) -> DataFrame:
    """Institution dimension: banks with a negative balance are not
    registered (their statements become orphans)."""
    return X.institutions(supplier.where(F.col("s_acctbal") >= 0))


def institution_month(lineitem: DataFrame, orders: DataFrame, supplier: DataFrame) -> DataFrame:
    """Banks registered per month: (order month, supplier) of every line.

    Narrow projections are joined on the order key, then reduced to
    distinct (month, bank): partial aggregation dedups map-side, where the
    few (month, bank) pairs collapse most rows."""
    lines = lineitem.select("l_orderkey", "l_suppkey")
    months = orders.select(F.col("o_orderkey").alias("l_orderkey"), period_of("o_orderdate").alias("periodo_mes"))
    keyed = (lines.join(months, "l_orderkey")
             .select("periodo_mes", padded_code("l_suppkey", 3).alias("ins_id")).distinct())
    return keyed.join(X.institutions(supplier), "ins_id", "left").select("periodo_mes", "ins_id", "ins_nombre")


def accounts_seen_before(lineitem: DataFrame, part: DataFrame, period: str) -> DataFrame:
    """Accounts with statements before ``period`` (the dimension as it was)."""
    seen = (lineitem.where(F.col("l_shipdate") < F.lit(period).cast("timestamp_ntz"))
            .select(padded_code("l_partkey", 7).alias("planCuenta_id")).distinct())
    return governed_accounts(part).join(seen, "planCuenta_id", "left_semi")
