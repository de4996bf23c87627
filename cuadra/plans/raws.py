"""Raw extracts of the monthly job: layouts and path templates.

Fixed values: file templates, separators, column names and header fields
must equal the reference's declarations.  The validity windows are ours
where noted: the reference declares one layout valid from 2010-01-01, while
the fixtures span 1995-2001, so earlier layouts (same columns) are declared
for them.  Each file is parsed by the layout valid at its date.
"""

from __future__ import annotations

from dataclasses import replace

from cuadra.specs import RawSetting, RawSpec

# The reference's layout validity.
REF_START, REF_END = "2010-01-01", "2050-12-12"
# Ours: layouts for the fixture years, and the same with a deliberate overlap
# (1999-07 .. 1999-12) for the check of the declarations.
FIXTURE_WINDOWS = (("1990-01-01", "1999-06-30"), ("1999-07-01", "2009-12-31"))
OVERLAPPING_WINDOWS = (("1990-01-01", "1999-12-31"), ("1999-07-01", "2009-12-31"))


def _versions(columns, windows=FIXTURE_WINDOWS, **kw) -> tuple[RawSetting, ...]:
    windows = (*windows, (REF_START, REF_END))
    return tuple(RawSetting(start, end, columns, **kw) for start, end in windows)


def _amounts(prefix: str) -> tuple[tuple[str, str], ...]:
    return (("planCuenta_id", "string"), (f"{prefix}_Monto_clp", "string"), (f"{prefix}_Monto_ipc", "string"),
            (f"{prefix}_Monto_tdc", "string"), (f"{prefix}_Monto_tdcb", "string"))


def _single(prefix: str) -> tuple[tuple[str, str], ...]:
    return (("planCuenta_id", "string"), (f"{prefix}_Monto", "string"))


# Statement extracts (amounts are text with a decimal comma).
B1 = RawSpec("B1", "{{YYYY}}{{MM}}/b1{{YYYY}}{{MM}}{{Cod_Banco}}.txt",
             _versions(_amounts("b1"), header_fields=("codigo", "banco")), 10, 1000)
R1 = RawSpec("R1", "{{YYYY}}{{MM}}/r1{{YYYY}}{{MM}}{{Cod_Banco}}.txt",
             _versions(_amounts("r1"), header_fields=("codigo", "banco")), 10, 1000)
# C1/C2 staged headers also carry the declared row count ("filas", ours).
C1 = RawSpec("C1", "{{YYYY}}{{MM}}/c1{{YYYY}}{{MM}}{{Cod_Banco}}.txt",
             _versions(_single("c1"), header_fields=("codigo", "banco", "filas")), 10, 1000)
C2 = RawSpec("C2", "{{YYYY}}{{MM}}/c2{{YYYY}}{{MM}}{{Cod_Banco}}.txt",
             _versions(_single("c2"), header_fields=("codigo", "banco", "filas")), 1, 1000)
STATEMENTS = {"B1": B1, "R1": R1, "C1": C1, "C2": C2}
#: The statements as they would be declared with overlapping layouts (``settings_as_of``).
OVERLAPPING = {k: replace(r, settings=tuple(replace(s, start=a, end=b) for s, (a, b) in zip(r.settings, (*OVERLAPPING_WINDOWS, (REF_START, REF_END)))))
               for k, r in STATEMENTS.items()}

# Ours: detailed statements of all banks whose columns change order, separator and
# decimals' place on one date.
TWO_LAYOUTS_FROM = "1998-07-01"
_BANKED = (("ins_id", "string"), *_amounts("b1"))
TWO_LAYOUTS = RawSpec("B1", "{{YYYY}}{{MM}}/banks{{YYYY}}{{MM}}_{{NUM}}.txt", (
    RawSetting("1990-01-01", "1998-06-30", _BANKED, header_fields=("grupo", "filas")),
    RawSetting(TWO_LAYOUTS_FROM, "2009-12-31", tuple(reversed(_BANKED)), sep=";", header_fields=("grupo", "filas"))))

# Institution list, chart of accounts, account assignment.
CODIFIS = RawSpec("institucion", "{{YYYY}}{{MM}}/Instrucciones/CODIFIS.TXT",
                  _versions(RawSpec.columns_from_names("institucion_id;institucion_nombre")), 10, 100)
PLAN_CTAS = RawSpec("planCuenta", "{{YYYY}}{{MM}}/PLAN-CTAS.TXT",
                    _versions((("ano", "int"), ("mes", "int"), ("planCuenta_id", "string"),
                               ("planCuenta_Nombre", "string"))), 300, 1000)
ASIGNA = RawSpec("planCuentaAsigna", "PLANCUENTA_GESTION_{{NUM}}.txt",
                 _versions(RawSpec.columns_from_names("planCuenta_id;producto_id;negocio_id;concepto"),
                           sep=";"), 1, 1000)

# Ours: orders as delimited and fixed-width extracts (test inputs).
ORDERS_COLUMNS = (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                  ("o_totalprice", "string"), ("o_orderdate", "date"), ("o_orderpriority", "string"))
ORDERS_TAB = RawSetting("1990-01-01", REF_END, ORDERS_COLUMNS)
ORDERS_FIXED = RawSetting("1990-01-01", REF_END, ORDERS_COLUMNS, widths=(12, 12, 1, 15, 10, 15))
ORDERS_TEMPLATE = "{{YYYY}}{{MM}}/orders{{YYYY}}{{MM}}_{{NUM}}.txt"
ORDERS = RawSpec("orders", ORDERS_TEMPLATE, (ORDERS_TAB,))
ORDERS_BY_POSITION = RawSpec("orders", ORDERS_TEMPLATE, (ORDERS_FIXED,))
