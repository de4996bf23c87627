from cuadra.functions.expressions import (
    decimal_comma,
    lost_in_cast,
    padded_code,
    period_literal,
    period_of,
    period_str,
    scale_millions,
    shift_period,
    shift_period_str,
    to_amount,
    try_cast,
)

__all__ = [
    "decimal_comma", "lost_in_cast", "padded_code", "period_literal", "period_of",
    "period_str", "scale_millions", "shift_period", "shift_period_str", "to_amount",
    "try_cast",
]
