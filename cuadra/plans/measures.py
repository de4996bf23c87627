"""The indicator measure table: the only business logic of the indicators job.

Fixed values: concept names, measure names and formulas must equal the
reference's for equal results.  ``gestion_gastoComision_mes`` reads the
GASTO_INTERES concept, as the reference does (no GASTO_COMISION concept
exists); correct it here if wanted, in this one place.
"""

from __future__ import annotations

from cuadra.specs import Measure

# The ten account concepts, in order of first appearance.
CONCEPTS = (
    "COLOCACION",
    "COLOCACION_MORA90",
    "PROVISION_STOCK",
    "PROVISION",
    "CASTIGO",
    "RECUPERO",
    "INGRESO_INTERES",
    "GASTO_INTERES",
    "INGRESO_COMISION",
    "UTILIDAD_FINANCIERA",
)

# Fixed values: (measure, concept, formula); formulas: act, act-ant, ytd.
MEASURES = (
    Measure("gestion_colocacion_mes", "COLOCACION", "act"),
    Measure("gestion_colocacionMora90_mes", "COLOCACION_MORA90", "act"),
    Measure("gestion_provision_mes", "PROVISION_STOCK", "act-ant"),
    Measure("gestion_provision_Ano", "PROVISION", "act"),
    Measure("gestion_provisionStock", "PROVISION_STOCK", "act"),
    Measure("gestion_castigo_mes", "CASTIGO", "ytd"),
    Measure("gestion_castigo_Ano", "CASTIGO", "act"),
    Measure("gestion_recupero_mes", "RECUPERO", "ytd"),
    Measure("gestion_recupero_Ano", "RECUPERO", "act"),
    Measure("gestion_ingresoInteres_mes", "INGRESO_INTERES", "act"),
    Measure("gestion_gastoInteres_mes", "GASTO_INTERES", "act"),
    Measure("gestion_ingresoComision_mes", "INGRESO_COMISION", "act"),
    Measure("gestion_gastoComision_mes", "GASTO_INTERES", "act"),
    Measure("gestion_utilidadFinanciera_mes", "UTILIDAD_FINANCIERA", "act"),
)

# Derived risk cost, evaluated as decimal(20,2).
DERIVED = {
    "gestion_gastoRiesgo_mes": "gestion_provision_mes + gestion_castigo_mes - gestion_recupero_mes",
    "gestion_gastoRiesgo_Ano": "gestion_provision_Ano + gestion_castigo_Ano - gestion_recupero_Ano",
}
