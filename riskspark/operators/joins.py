"""Joins of a sample with variable tables: semi reduction, keyed, hashed, shifted, as-of and interval joins."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import month_key


def semi(table: DataFrame, key: str, sample: DataFrame, sample_key: str) -> DataFrame:
    """Rows of the table whose key is in the sample."""
    keys = sample.select(F.col(sample_key).alias("_key")).distinct()
    return table.join(keys, F.col(key) == F.col("_key"), "left_semi")


def md5_key(column: Column) -> Column:
    return F.md5(column.cast("string"))


def shifted_day(column: Column, days: int, pattern: str = "yyyyMMdd", parsed: bool = False) -> Column:
    """The day `days` later, as an int yyyyMMdd; parsed: the column is a date or timestamp already."""
    day = column.cast("date") if parsed else F.try_to_timestamp(column.cast("string"), F.lit(pattern)).cast("date")
    return F.date_format(F.date_add(day, days), "yyyyMMdd").cast("int")


def shifted_month(column: Column, months: int, kind: str = "date") -> Column:
    """The month `months` later, as an int yyyyMM."""
    return month_key(F.add_months(column.cast("date"), months), "date") if kind != "int" else month_key(
        F.add_months(F.to_date(column.cast("string"), "yyyyMM"), months), "date"
    )


def keyed(sample: DataFrame, table: DataFrame, on: list[tuple[Column | str, Column | str]], variables: dict[str, str], how: str = "left") -> DataFrame:
    """sample with variables (new name: table column), joined on pairs of sample and table columns or expressions.

    Table expressions are projected first, so that the join stays one on equal keys.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    names = [f"_k{i}" for i in range(len(on))]
    side = table.select(*(col(t).alias(n) for n, (_, t) in zip(names, on, strict=True)), *(F.col(c).alias(f"_v_{n}") for n, c in variables.items()))
    left = sample.withColumns({f"_l{i}": col(s) for i, (s, _) in enumerate(on)})
    cond = reduce(lambda a, b: a & b, (F.col(f"_l{i}") == F.col(n) for i, n in enumerate(names)))
    return left.join(side, cond, how).select(*(F.col(c) for c in sample.columns), *(F.col(f"_v_{n}").alias(n) for n in variables))


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first in the order, which must be total for a repeatable result."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def as_of(
    sample: DataFrame, history: DataFrame, key: tuple[str, str], time: tuple[str, str], values: list[str], days: int | None = None,
    tie: Iterable[str] = (), strict: bool = False, prefix: str = "", unit: str = "days", stretch: str = "month",
) -> DataFrame:
    """sample with the values, and time, of the latest history row of its key not after its own time (strict: before it).

    days (or months, by unit) bounds how old that row may be. Both sides are laid out by key and time and the last history row is
    carried forward, so a key with many rows costs its rows and not their pairs. A task holds one stretch of time of a key, and the
    last row of the stretches before it is handed in, so a key with a third of all rows is spread. Ties in time go to the largest `tie`.
    Sample rows without a key or a time see nothing and go round the windows.
    """
    left_key, right_key = key
    left_time, right_time = time
    tie = list(tie)
    payload = F.struct(F.col(right_time).cast("timestamp").alias("t"), *(F.col(v).alias(f"v_{i}") for i, v in enumerate(values)))
    own = F.struct(*(F.col(c).alias(f"c_{i}") for i, c in enumerate(sample.columns)))
    timed = F.col(left_key).isNotNull() & F.col(left_time).cast("timestamp").isNotNull()
    a = sample.where(timed).select(F.col(left_key).alias("k"), F.col(left_time).cast("timestamp").alias("t"), F.lit(0 if strict else 1).alias("side"), own.alias("row"))
    b = history.where(F.col(right_key).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(right_key).alias("k"), F.col(right_time).cast("timestamp").alias("t"), F.lit(1 if strict else 0).alias("side"), payload.alias("seen"),
        F.struct(*map(F.col, tie), F.lit(0)).alias("tie"),
    )
    both = a.unionByName(b, allowMissingColumns=True)
    both = both.withColumn("stretch", F.date_trunc(stretch, "t"))
    newest = F.max_by("seen", F.when(F.col("seen").isNotNull(), F.struct("t", "tie")))
    before = Window.partitionBy("hk").orderBy("hs").rowsBetween(Window.unboundedPreceding, -1)
    heads = both.groupBy(F.col("k").alias("hk"), F.col("stretch").alias("hs")).agg(newest.alias("newest"))
    heads = heads.select("hk", "hs", F.last("newest", ignorenulls=True).over(before).alias("handed"))
    both = both.join(heads, (F.col("k") == F.col("hk")) & (F.col("stretch") == F.col("hs")), "left")
    w = Window.partitionBy("k", "stretch").orderBy("t", "side", F.asc_nulls_first("tie")).rowsBetween(Window.unboundedPreceding, 0)
    x = both.withColumn("last", F.coalesce(F.last("seen", ignorenulls=True).over(w), "handed")).where("row IS NOT NULL")
    ok = F.col("last").isNotNull()
    if days is not None:
        ok &= distance(F.col("t"), F.col("last.t"), unit) <= days
    kept = x.select("row", F.when(ok, F.col("last")).alias("last"))
    kept = kept.unionByName(sample.where(~timed).select(own.alias("row")), allowMissingColumns=True)
    return kept.select(
        *(F.col(f"row.c_{i}").alias(c) for i, c in enumerate(sample.columns)), F.col("last.t").alias(f"{prefix}{right_time}"),
        *(F.col(f"last.v_{i}").alias(f"{prefix}{v}") for i, v in enumerate(values)),
    )


def distance(later: Column, earlier: Column, unit: str) -> Column:
    """Days, or months with their fraction, from earlier to later."""
    return F.months_between(later, earlier) if unit == "months" else F.datediff(later, earlier)


def interval(
    sample: DataFrame, table: DataFrame, key: tuple[str, str], time: tuple[str, str], values: list[str], window: int, unit: str = "days",
    direction: str = "<=", how: str = "left", keep: list[str] | None = None, tie: Iterable[str] = (),
) -> DataFrame:
    """sample joined with the table's rows of its key whose time lies within `window` units of the sample's.

    direction `<=`: not after the sample; `>=`: not before it; `between`: from the sample's time to window units before.
    keep: the sample's key columns; then one row stays for each, the one nearest in time, ties to the largest `tie`.
    With `<=` and days, use as_of() instead: it does not form the pairs.
    """
    (lk, rk), (lt, rt) = key, time
    side = table.select(F.col(rk).alias("_k"), F.col(rt).alias("_t"), *(F.col(v).alias(f"_v_{v}") for v in values), *(F.col(c).alias(f"_o_{c}") for c in tie))
    s, t = F.col(lt), F.col("_t")
    gap = distance(s, t, unit) if direction != ">=" else distance(t, s, unit)
    inside = (gap >= 0) & (gap <= window)
    if direction == "<=":
        inside &= t <= s
    elif direction == ">=":
        inside &= t >= s
    elif direction != "between":
        raise ValueError(f"unknown direction {direction}")
    x = sample.join(side, (F.col(lk) == F.col("_k")) & inside, how)
    if keep:
        x = latest(x, keep, [F.asc_nulls_last(F.abs(distance(s, t, "days"))), F.desc_nulls_last("_t"), *(F.desc_nulls_last(f"_o_{c}") for c in tie)])
    return x.select(*sample.columns, F.col("_t").alias(rt), *(F.col(f"_v_{v}").alias(v) for v in values))


def merge_all(base: DataFrame, parts: list[tuple[DataFrame, str]]) -> DataFrame:
    """Left joins of parts that are unique by a key of the base; the key is not repeated."""
    for part, key in parts:
        side = part.withColumnRenamed(key, f"_{key}")
        base = base.join(side, F.col(key) == F.col(f"_{key}"), "left").drop(f"_{key}")
    return base
