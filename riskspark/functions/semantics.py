"""Missing values, months, rounding and safe arithmetic as Spark columns."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A numeric value at or below MISSING_AT is missing; FILL is what missing values are filled with.
MISSING_AT = -99999.0
FILL = -999999.0
#: Trimmed texts that mean missing.
MISSING_TEXTS = ("", "nan", "NaN")


@dataclass(frozen=True)
class MissingPolicy:
    """at: numbers up to it are missing; None: only null, NaN and missing texts."""

    at: float | None = MISSING_AT
    texts: tuple[str, ...] = MISSING_TEXTS

    def holds(self, column: Column, kind: str) -> Column:
        """Whether a column of Spark type name kind is missing; never null."""
        tests = [column.isNull()]
        value = column
        if kind == "string":
            tests.append(F.trim(column).isin(*self.texts))
            value = number(column)
        if kind in ("double", "float"):
            tests.append(F.isnan(column))
        if self.at is not None and kind not in ("date", "timestamp", "boolean"):
            tests.append(value <= F.lit(self.at))
        return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def number(column: Column) -> Column:
    """A text as a double; null where it is none."""
    return column.try_cast("double")


def missing(column: Column, kind: str = "double", policy: MissingPolicy = MissingPolicy()) -> Column:
    return policy.holds(column, kind)


def month_key(column: Column, kind: str = "timestamp") -> Column:
    """yyyyMM as int of a date, timestamp, or leniently parsed text such as 2025-1-6 or 20250106; null where it is no date."""
    if kind == "string":
        text = F.trim(column)
        day = F.coalesce(text.try_cast("date"), F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date"))
        return F.date_format(day, "yyyyMM").cast("int")
    return (F.year(column) * 100 + F.month(column)).cast("int")


def np_round(column: Column, digits: int) -> Column:
    """numpy's rounding: half to even on the scaled double."""
    scale = F.lit(float(10**digits))
    return F.rint(column.cast("double") * scale) / scale


def divide(a: Column, b: Column, zero: float | None = None) -> Column:
    """a / b as doubles; zero (or null) where b is zero or null."""
    out = F.try_divide(a.cast("double"), b.cast("double"))
    return out if zero is None else F.coalesce(out, F.lit(float(zero)))


def ln_ratio(a: Column, b: Column, floor: float = 1e-10) -> Column:
    """ln(a / b) with both shares held up to a floor."""
    return F.ln(F.greatest(a, F.lit(floor)) / F.greatest(b, F.lit(floor)))


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)
