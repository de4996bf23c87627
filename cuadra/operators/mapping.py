"""Map a source DataFrame onto a governed table's columns.

The result has exactly the spec's columns, in spec order and type.  Casts use
``try_cast``: a value that does not fit the declared type becomes null and is
reported by ``cast_losses`` (and by the not-null rule), instead of aborting
the job under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuadra.specs import TableSpec


def _source(df: DataFrame, src: str | Column) -> Column:
    return df[src] if isinstance(src, str) else src


def mapped_columns(df: DataFrame, spec: TableSpec, mapping: Mapping[str, str | Column]
                   ) -> dict[str, Column | None]:
    """Source expression per target column (None: unmapped)."""
    lower = {k.lower(): v for k, v in mapping.items()}
    out = {}
    for col in spec.columns:
        src = lower.get(col.name.lower())
        out[col.name] = None if src is None else _source(df, src)
    return out


def map_columns(df: DataFrame, spec: TableSpec, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Explicit mapping target -> source column (or expression), with rename
    and typed cast.  Unmapped columns take their default, or null when not
    required; an unmapped required column without default is an error."""
    exprs = []
    for col, src in zip(spec.columns, mapped_columns(df, spec, mapping).values()):
        if src is None:
            if col.default is not None:
                src = F.expr(col.default)
            elif col.required:
                raise ValueError(f"{spec.name}.{col.name}: required column has no mapping")
            else:
                src = F.lit(None)
        elif col.default is not None:
            src = F.coalesce(src, F.expr(col.default))
        exprs.append(src.try_cast(col.dtype).alias(col.name))
    return df.select(*exprs)


def auto_mapping(df: DataFrame, spec: TableSpec) -> dict[str, str]:
    """Target -> source by case-insensitive name; source columns that are
    not in the target are dropped."""
    by_lower = {c.lower(): c for c in df.columns}
    return {col.name: by_lower[col.name.lower()] for col in spec.columns if col.name.lower() in by_lower}


def auto_map(df: DataFrame, spec: TableSpec) -> DataFrame:
    return map_columns(df, spec, auto_mapping(df, spec))


def cast_losses(df: DataFrame, spec: TableSpec, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Values present in the source and lost by the cast to the declared
    type, per target column, in one pass.
    Output: column_name, n_rows, n_lost, passed."""
    pairs = [(col, src) for col, src in zip(spec.columns, mapped_columns(df, spec, mapping).values())
             if src is not None]
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.count(F.when(src.isNotNull() & src.try_cast(col.dtype).isNull(), 1)).alias(f"_l{i}")
             for i, (col, src) in enumerate(pairs)]
    wide = df.agg(*aggs)
    args = ", ".join(f"'{col.name}', _l{i}" for i, (col, _) in enumerate(pairs))
    return (wide.selectExpr("_n AS n_rows", f"stack({len(pairs)}, {args}) AS (column_name, n_lost)")
            .select("column_name", "n_rows", "n_lost", (F.col("n_lost") == 0).alias("passed")))

