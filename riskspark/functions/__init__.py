"""Column functions with the domain's rules for missing values, months, rounding and logarithms."""

from .semantics import (
    FILL,
    MISSING_AT,
    MissingPolicy,
    divide,
    ln_ratio,
    missing,
    month_key,
    np_round,
    number,
    total,
)

__all__ = ["FILL", "MISSING_AT", "MissingPolicy", "divide", "ln_ratio", "missing", "month_key", "np_round", "number", "total"]
