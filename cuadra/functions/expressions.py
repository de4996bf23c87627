"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen.  Conversions that may fail use ``try_cast``: under ANSI mode a plain
cast would abort the job, while governed loads want the bad value reported by
a rule (not-null, lost-in-cast) instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Periods are stored as 'yyyy-MM-dd' strings (first day of the month).
PERIOD_FORMAT = "yyyy-MM-dd"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_cast(c: ColumnOrName, dtype: str) -> Column:
    """Cast that yields null instead of failing the job."""
    return _col(c).try_cast(dtype)


def decimal_comma(c: ColumnOrName, precision: int = 23, scale: int = 2) -> Column:
    """Parse text with a decimal comma ('1234,56') into a decimal.

    Thousands separators are not accepted ('1.234,56' gives null); surrounding
    blanks are; an empty string gives null.  Rounding is half-up.
    """
    text = F.translate(_col(c), ",", ".")
    return text.try_cast(f"decimal({precision},{scale})")


def to_amount(c: ColumnOrName, precision: int = 23, scale: int = 2) -> Column:
    """A raw amount as decimal: text goes through ``decimal_comma``, numbers
    are cast.  Used when the same unify step reads text extracts or typed
    tables."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def period_of(ts: ColumnOrName) -> Column:
    """'yyyy-MM-01' of a date or timestamp."""
    return F.trunc(F.to_date(_col(ts)), "MM").cast("string")


def period_literal(year: int, month: int) -> Column:
    """Period for a year and month, as the stored string."""
    return F.make_date(F.lit(year), F.lit(month), F.lit(1)).cast("string")


def period_str(year: int, month: int) -> str:
    return f"{year:04d}-{month:02d}-01"


def shift_period(period: ColumnOrName, months: int) -> Column:
    """Period ``months`` later (negative: earlier), as the stored string."""
    return F.add_months(F.to_date(_col(period)), months).cast("string")


def shift_period_str(period: str, months: int) -> str:
    y, m = int(period[:4]), int(period[5:7])
    idx = y * 12 + (m - 1) + months
    return period_str(idx // 12, idx % 12 + 1)


def scale_millions(c: ColumnOrName) -> Column:
    """Amounts reported in millions, scaled to units."""
    return _col(c) * F.lit(1000000)


def lost_in_cast(source: ColumnOrName, target: ColumnOrName) -> Column:
    """True where a value was present before a conversion and is gone after."""
    return _col(source).isNotNull() & _col(target).isNull()


def padded_code(c: ColumnOrName, width: int) -> Column:
    """Zero-padded code of at least ``width`` characters (e.g. institution 7 ->
    '007').  A longer code stays whole, so that no two codes merge; the length
    rules report it."""
    text = _col(c).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))
