"""Filling missing values: by dictionary, and by the type of a column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampType

from ..functions import FILL


def fill(df: DataFrame, fills: dict[str, float], before: dict[str, float] | None = None) -> DataFrame:
    """df with null and NaN replaced by the feature's fill value; values equal to an earlier fill become the new one."""
    kinds = dict(df.dtypes)

    def one(name: str, value: float):
        x = F.col(name)
        gone = x.isNull() | (F.isnan(x) if kinds[name] in ("double", "float") else F.lit(False))
        if before and name in before:
            gone = gone | (x == F.lit(before[name]))
        return F.when(gone, F.lit(value).cast(kinds[name])).otherwise(x)

    return df.withColumns({n: one(n, v) for n, v in fills.items() if n in kinds})


def fill_by_type(df: DataFrame, columns: list[str] | None = None, number: float = FILL) -> DataFrame:
    """Numbers get `number`, texts their most frequent value (the smallest of equals), dates their latest; what is filled in is found in
    one pass for the dates and one for the texts."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    numbers = [f.name for f in fields if isinstance(f.dataType, NumericType)]
    dates = [f.name for f in fields if isinstance(f.dataType, (DateType, TimestampType))]
    texts = [f.name for f in fields if isinstance(f.dataType, StringType)]
    out = fill(df, dict.fromkeys(numbers, number))
    if dates:
        last = df.agg(*(F.max(d).alias(d) for d in dates)).first()
        out = out.withColumns({d: F.coalesce(F.col(d), F.lit(last[d])) for d in dates if last[d] is not None})
    if texts:
        # all texts in one pass: counts by column and value, of which each column's first is kept
        long = df.select(*texts).unpivot([], texts, "_c", "_v").where("_v IS NOT NULL").groupBy("_c", "_v").agg(F.count("*").alias("_n"))
        best = long.groupBy("_c").agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col("_v").alias("v"))).alias("best"))
        out = out.withColumns({r["_c"]: F.coalesce(F.col(r["_c"]), F.lit(r["best"]["v"])) for r in best.collect()})
    return out
