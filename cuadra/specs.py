"""Declarative descriptions of governed tables, raw extracts and rules.

A ``TableSpec`` is the single place where a table's columns, keys, foreign
keys, rules and storage layout are declared.  Operators read it; nothing is
inferred from data.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import Enum

import re

from pyspark.sql import types as T

_SIMPLE_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "integer": T.IntegerType(),
    "bigint": T.LongType(), "long": T.LongType(), "double": T.DoubleType(),
    "date": T.DateType(), "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(), "boolean": T.BooleanType(),
}


def spark_type(name: str) -> T.DataType:
    """Spark type for the type strings used in specs."""
    key = name.strip().lower()
    if key in _SIMPLE_TYPES:
        return _SIMPLE_TYPES[key]
    m = re.fullmatch(r"decimal\((\d+)\s*,\s*(\d+)\)", key)
    if m:
        return T.DecimalType(int(m.group(1)), int(m.group(2)))
    raise ValueError(f"unsupported type {name!r}")


class Severity(str, Enum):
    """What a failing rule does to the load."""

    ERROR = "ERROR"                      # stop: nothing is written
    WARNING = "WARNING"                  # report, keep the rows
    WARNING_EXCLUDE = "WARNING_EXCLUDE"  # report, drop the violating rows, continue


class TableKind(str, Enum):
    REFERENCE = "reference"      # keyed catalogue, no period partition, upsert
    MASTER = "master"            # same behaviour as reference
    TRANSACTION = "transaction"  # period-partitioned, partition replace


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: str = "string"              # Spark SQL type string
    nullable: bool = False             # not-null is the default rule
    required: bool = True              # a mapping must be supplied on load
    pk: bool = False
    unique: bool = False
    min_len: int | None = None
    max_len: int | None = None
    min_len_code: str | None = None    # external code reported by the length rules
    max_len_code: str | None = None
    min_value: str | None = None       # SQL literal, inclusive
    max_value: str | None = None
    min_datetime: str | None = None
    max_datetime: str | None = None
    regex: str | None = None
    default: str | None = None         # SQL expression used where unmapped or null
    track_old: bool = False            # keep <name>_old on change
    track_at: bool = False             # keep <name>_changed_at on change
    track_by: bool = False             # keep <name>_changed_by on change
    description: str = ""

    def field(self) -> T.StructField:
        meta = {"comment": self.description} if self.description else {}
        return T.StructField(self.name, spark_type(self.dtype), True, meta)


@dataclass(frozen=True)
class ForeignKey:
    """``columns`` pairs (local column, column of the referenced table)."""

    ref: str
    columns: tuple[tuple[str, str], ...]
    nullable: bool = False
    severity: Severity = Severity.ERROR
    external_code: str | None = None
    error_code: int = 0

    @property
    def local(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def remote(self) -> list[str]:
        return [c for _, c in self.columns]


@dataclass(frozen=True)
class Rule:
    """A SQL predicate stated positively: rows (or the table) must satisfy it.

    ``level`` is ``"row"`` (evaluated per row, a null result fails) or
    ``"aggregate"`` (one boolean over the whole input, null fails).
    ``tolerance_rows`` / ``tolerance_share``: the rule fails only when the
    number of bad rows exceeds the first or their share exceeds the second.
    """

    rule_id: str
    expr: str
    level: str = "row"
    severity: Severity = Severity.ERROR
    error_code: int = 0
    column: str | None = None
    tolerance_rows: int | None = None
    tolerance_share: float | None = None
    external_code: str | None = None
    description: str = ""


@dataclass(frozen=True)
class TableSpec:
    name: str
    kind: TableKind
    columns: tuple[ColumnSpec, ...]
    partition_cols: tuple[str, ...] = ()
    partition_groups: int | None = None          # folders that the last partition column's values share; None: one a value
    one_value_partitions: tuple[str, ...] = ()   # one distinct value per load
    foreign_keys: tuple[ForeignKey, ...] = ()
    rules: tuple[Rule, ...] = ()
    backup: bool = False                         # keep former versions (reference tables)
    num_partitions: int | None = None            # output files per table partition, of small tables
    rebalance: bool = False                      # a large table: files by size instead of by number
    pk_external_code: str | None = None
    max_new_records_num: int | None = None
    max_new_records_share: float | None = None
    description: str = ""

    @property
    def schema(self) -> T.StructType:
        return T.StructType([c.field() for c in self.columns])

    @property
    def pk(self) -> list[str]:
        return [c.name for c in self.columns if c.pk]

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name.lower() == name.lower():
                return c
        raise KeyError(f"{self.name} has no column {name}")


@dataclass(frozen=True)
class RawSetting:
    """Layout of a raw extract valid for files dated in [start, end]."""

    start: str                                   # 'yyyy-MM-dd', inclusive
    end: str                                     # 'yyyy-MM-dd', inclusive
    columns: tuple[tuple[str, str], ...]         # (name, type) in file order
    sep: str = "\t"
    header_fields: tuple[str, ...] | None = None  # None: header-less file
    header_sep: str = "\t"
    widths: tuple[int, ...] | None = None        # fixed-position mode
    encoding: str = "UTF-8"


@dataclass(frozen=True)
class RawSpec:
    name: str
    template: str                                # path with {{YYYY}} {{MM}} {{Cod_Banco}} ...
    settings: tuple[RawSetting, ...] = field(default_factory=tuple)
    min_rows: int | None = None
    max_rows: int | None = None
    max_rejected: int = 0                        # lines that may be set aside before a load stops

    @staticmethod
    def columns_from_names(names: str, sep: str = ";") -> tuple[tuple[str, str], ...]:
        """Shorthand layout ``"a;b"``: every column a string."""
        return tuple((n.strip(), "string") for n in names.split(sep) if n.strip())

    def setting(self, period: str) -> RawSetting:
        """Driver-side pick for a single period (the batch form is
        ``sources.settings_as_of``)."""
        hits = [s for s in self.settings if s.start <= period <= s.end]
        if len(hits) != 1:
            raise ValueError(f"{self.name}: {len(hits)} settings valid at {period}")
        return hits[0]

    def schema(self, period: str | None = None) -> T.StructType:
        setting = self.setting(period) if period else self.settings[-1]
        return T.StructType([T.StructField(n, spark_type(t), True)
                             for n, t in setting.columns])


@dataclass(frozen=True)
class Measure:
    """One pivoted indicator: sum of ``formula`` over rows of ``concept``.

    formula: ``act`` (current month), ``act-ant`` (change vs previous month),
    ``ytd`` (year-to-date turned into the month: act-ant, January act).
    """

    name: str
    concept: str
    formula: str
