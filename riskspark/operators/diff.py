"""Online against offline values: type-aware comparison, match rates, drill-up by source, and anomalies."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import missing, np_round, number

ONLINE, OFFLINE = "_online", "_offline"
#: Kinds of anomaly: which side is null.
KINDS = ("online_null", "offline_null", "differ")
SCORE_TOLERANCE = 1e-3


@dataclass(frozen=True)
class Variable:
    """precision None: inferred; kind: numeric or enum."""

    name: str
    source: str = "unknown"
    precision: int | None = None
    kind: str = "numeric"


@dataclass(frozen=True)
class DiffSpec:
    keys: list[str]
    score: str
    variables: list[Variable] = field(default_factory=list)

    def sources(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for v in self.variables:
            out.setdefault(v.source, []).append(v.name)
        return out


def merge(online: DataFrame, offline: DataFrame, keys: list[str], offline_score: str | None = None, score: str | None = None) -> DataFrame:
    """Inner join on the keys, null keys alike; names in lower case, all others with the side's suffix."""
    a, b = (df.toDF(*(c.lower() for c in df.columns)) for df in (online, offline))
    if offline_score and score and offline_score != score:
        b = b.withColumnRenamed(offline_score.lower(), score.lower())
    keys = [k.lower() for k in keys]
    absent = [k for k in keys if k not in a.columns or k not in b.columns]
    if absent:
        raise ValueError(f"keys not on both sides: {absent}")
    a = a.select(*keys, *(F.col(c).alias(c + ONLINE) for c in a.columns if c not in keys))
    b = b.select(*(F.col(k).alias(f"_{k}") for k in keys), *(F.col(c).alias(c + OFFLINE) for c in b.columns if c not in keys))
    return a.join(b, reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))).drop(*(f"_{k}" for k in keys))


def _number(df: DataFrame, column: str) -> Column:
    return number(F.col(column)) if dict(df.dtypes)[column] == "string" else F.col(column).cast("double")


def _null(df: DataFrame, column: str) -> Column:
    return missing(F.col(column), dict(df.dtypes)[column])


def decimals(column: Column) -> Column:
    """Decimal places of a double as it is written in full, one at least; null for null and NaN."""
    text = F.abs(column).cast("string")
    mantissa = F.substring_index(text, "E", 1)
    power = F.when(F.contains(text, F.lit("E")), F.substring_index(text, "E", -1).try_cast("int")).otherwise(0)
    digits = F.length(F.regexp_replace(F.substring_index(mantissa, ".", -1), "0+$", ""))
    return F.when(column.isNotNull() & ~F.isnan(column) & F.contains(text, F.lit(".")), F.greatest(digits - power, F.lit(1)))


def precisions(merged: DataFrame, variables: list[Variable]) -> dict[str, int]:
    """The largest number of decimals on either side, for variables without a given one: one pass, one row."""
    open_ = [v for v in variables if v.kind == "numeric" and v.precision is None]
    if not open_:
        return {}
    r = merged.agg(*(F.max(F.greatest(decimals(_number(merged, v.name + ONLINE)), decimals(_number(merged, v.name + OFFLINE)))).alias(v.name) for v in open_)).first()
    return {v.name: r[v.name] or 0 for v in open_}


def compare(merged: DataFrame, spec: DiffSpec) -> DataFrame:
    """merged with m_score and m_<variable>: both null, or equal within the variable's precision (the score: within 0.001)."""
    known = precisions(merged, spec.variables)

    def match(name: str, equal: Column) -> Column:
        a, b = _null(merged, name + ONLINE), _null(merged, name + OFFLINE)
        return (a & b) | (~a & ~b & F.coalesce(equal, F.lit(False)))

    out = {}
    s = [_number(merged, spec.score + side) for side in (ONLINE, OFFLINE)]
    out["m_score"] = match(spec.score, F.abs(s[0] - s[1]) < SCORE_TOLERANCE)
    for v in spec.variables:
        if v.kind == "enum":
            equal = F.trim(F.col(v.name + ONLINE).cast("string")) == F.trim(F.col(v.name + OFFLINE).cast("string"))
        else:
            p = v.precision if v.precision is not None else known[v.name]
            equal = np_round(_number(merged, v.name + ONLINE), p) == np_round(_number(merged, v.name + OFFLINE), p)
        out[f"m_{v.name}"] = match(v.name, equal)
    return merged.withColumns(out)


def match_rates(compared: DataFrame, spec: DiffSpec) -> DataFrame:
    """name, source, match_count, total, match_rate, source_rate of the score and all variables, in one pass."""
    names = ["score", *(v.name for v in spec.variables)]
    strict = {s: reduce(lambda a, b: a & b, (F.col(f"m_{n}") for n in own)) for s, own in spec.sources().items()}
    r = compared.agg(
        F.count("*").alias("total"), *(F.sum(F.col(f"m_{n}").cast("long")).alias(f"c_{n}") for n in names),
        *(F.avg(c.cast("double")).alias(f"s_{i}") for i, c in enumerate(strict.values())),
    )
    at = {s: i for i, s in enumerate(strict)}
    source = {v.name: v.source for v in spec.variables}
    rows = F.array(*(
        F.struct(
            F.lit(n).alias("name"), F.lit(source.get(n, "score")).alias("source"), F.coalesce(F.col(f"c_{n}"), F.lit(0)).alias("match_count"),
            (F.col(f"s_{at[source[n]]}") if n in source else F.lit(None).cast("double")).alias("source_rate"),
        )
        for n in names
    ))
    return r.select("total", F.inline(rows)).select("name", "source", "match_count", "total", F.expr("try_divide(match_count, total)").alias("match_rate"), "source_rate")


def drill_up(compared: DataFrame, spec: DiffSpec) -> DataFrame:
    """source, var_count, strict, match_75, match_50, match_25, loose: the share of rows with at least so many of the source's variables alike."""
    own = spec.sources()
    levels = {"strict": 1.0, "match_75": 0.75, "match_50": 0.5, "match_25": 0.25}
    columns, rows = [], []
    for i, (source, names) in enumerate(own.items()):
        hits = reduce(lambda a, b: a + b, (F.col(f"m_{n}").cast("int") for n in names))
        need = {k: math.ceil(len(names) * p) for k, p in levels.items()} | {"loose": 1}
        columns += [F.avg((hits >= n).cast("double")).alias(f"{k}_{i}") for k, n in need.items()]
        rows.append(F.struct(F.lit(source).alias("source"), F.lit(len(names)).alias("var_count"), *(F.col(f"{k}_{i}").alias(k) for k in need)))
    return compared.agg(*columns).select(F.inline(F.array(*rows)))


def _anomalies(compared: DataFrame, spec: DiffSpec) -> DataFrame:
    """name, kind, online, offline (texts) and the keys: one row for each variable that does not match."""
    rows = []
    for v in spec.variables:
        a, b = _null(compared, v.name + ONLINE), _null(compared, v.name + OFFLINE)
        kind = F.when(a & ~b, KINDS[0]).when(~a & b, KINDS[1]).when(~a & ~b & ~F.col(f"m_{v.name}"), KINDS[2])
        rows.append(F.struct(F.lit(v.name).alias("name"), kind.alias("kind"), F.col(v.name + ONLINE).cast("string").alias("online"), F.col(v.name + OFFLINE).cast("string").alias("offline")))
    return compared.select(*spec.keys, F.inline(F.array(*rows))).where("kind IS NOT NULL")


def anomalies(compared: DataFrame, spec: DiffSpec) -> DataFrame:
    """name, kind, n, pct of all merged rows."""
    total = compared.agg(F.count("*").alias("total"))
    counts = _anomalies(compared, spec).groupBy("name", "kind").agg(F.count("*").alias("n"))
    return counts.crossJoin(F.broadcast(total)).select("name", "kind", "n", (F.col("n") / F.col("total")).alias("pct"))


def top_pairs(compared: DataFrame, spec: DiffSpec, most: int = 3) -> DataFrame:
    """name, kind, rank, online, offline, n: the most frequent pairs of values, ties in order of the values."""
    counts = _anomalies(compared, spec).groupBy("name", "kind", "online", "offline").agg(F.count("*").alias("n"))
    w = Window.partitionBy("name", "kind").orderBy(F.desc("n"), F.asc_nulls_first("online"), F.asc_nulls_first("offline"))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def sample_rows(compared: DataFrame, spec: DiffSpec, most: int = 3) -> DataFrame:
    """name, kind, keys, online, offline of the first rows, in order of the keys, of each kind of anomaly."""
    w = Window.partitionBy("name", "kind").orderBy(*spec.keys, "online", "offline")
    return _anomalies(compared, spec).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def overview(online: DataFrame, offline: DataFrame, merged: DataFrame) -> DataFrame:
    """side, rows, columns of both inputs and the join."""
    parts = [df.agg(F.lit(n).alias("side"), F.count("*").alias("rows"), F.lit(len(df.columns)).alias("columns")) for n, df in (("online", online), ("offline", offline), ("merged", merged))]
    return reduce(DataFrame.unionByName, parts)


def null_rates(df: DataFrame, side: str) -> DataFrame:
    """side, column, null_rate (null and NaN only), missing_rate (the rule for missing values)."""
    kinds = dict(df.dtypes)
    plain = lambda c: F.col(c).isNull() | (F.isnan(c) if kinds[c] in ("double", "float") else F.lit(False))
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"p_{c}").alias("null_rate"), F.col(f"m_{c}").alias("missing_rate")) for c in df.columns))
    rates = df.agg(*(F.avg(plain(c).cast("double")).alias(f"p_{c}") for c in df.columns), *(F.avg(_null(df, c).cast("double")).alias(f"m_{c}") for c in df.columns))
    return rates.select(F.lit(side).alias("side"), F.inline(rows))
