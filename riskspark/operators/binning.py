"""Bins: edges, assignment with either closure, fine and coarse numeric bins, and monotonic merging of micro bins."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import missing
from .running import quantiles, rank_sql

INF = float("inf")


def _array(edges: list[float]) -> str:
    return "array(" + ", ".join(f"CAST('{e!r}' AS DOUBLE)" for e in edges) + ")" if edges else "CAST(array() AS ARRAY<DOUBLE>)"


def right_closed(column: str, interior: list[float]) -> Column:
    """The bin 0, 1, ... of (a, b] bins: the number of interior edges below the value; null for null."""
    return F.expr(f"CASE WHEN `{column}` IS NOT NULL THEN {rank_sql(f'`{column}`', sorted(interior))} END")


def left_closed(column: str, interior: list[float]) -> Column:
    """The bin of [a, b) bins: the number of interior edges not above the value; null for null."""
    return F.expr(f"CASE WHEN `{column}` IS NOT NULL THEN {rank_sql(f'`{column}`', sorted(interior), '>=')} END")


def long(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """keep, feature, value (double): one row for each row and feature."""
    wide = df.select(*keep, *(F.col(f).cast("double").alias(f) for f in features))
    return wide.unpivot(keep, features, "feature", "value") if keep else wide.unpivot([], features, "feature", "value")


def quantile_edges(df: DataFrame, features: list[str], parts: int) -> dict[str, list[float]]:
    """Distinct equal-frequency edges, the ends included; what is collected is features times parts numbers."""
    rows = quantiles(long(df, features, []).where("NOT isnan(value)"), ["feature"], "value", [k / parts for k in range(parts + 1)])
    found: dict[str, set[float]] = {f: set() for f in features}
    for r in rows.collect():
        found[r["feature"]].add(r["quantile"])
    return {f: sorted(v) for f, v in found.items()}


def equal_width_edges(df: DataFrame, column: str, parts: int) -> list[float]:
    """Edges of equally wide bins; the lowest is lowered by 0.1 % of the range, and a single value gets a range around it."""
    r = df.agg(F.min(column).cast("double").alias("a"), F.max(column).cast("double").alias("b")).first()
    if r.a is None:
        return []
    a, b = r.a, r.b
    if a == b:
        pad = 0.001 * abs(a) if a else 0.001
        return [a - pad + 2 * pad * k / parts for k in range(parts + 1)]
    edges = [a + (b - a) * k / parts for k in range(parts)] + [b]
    return [a - 0.001 * (b - a), *edges[1:]]


def fine_edges(df: DataFrame, features: list[str], fill: dict[str, float] | None = None, parts: int = 20) -> dict[str, list[float]]:
    """Edges of fine bins with open ends: quantiles rounded to 3 places, and a bin (fill - 0.001, fill] of its own for a fill value.

    A feature with one value has no bins and is left out.
    """
    out = {}
    for f, edges in quantile_edges(df, features, parts).items():
        if len(edges) < 2:
            continue
        inner = {round(e, 3) for e in edges[1:-1]}
        if fill and f in fill:
            inner |= {fill[f] - 1e-3, fill[f]}
        out[f] = [-INF, *sorted(inner), INF]
    return out


@dataclass
class Bin:
    """Counts of rows between two edges."""

    low: float
    high: float
    good: int
    bad: int

    @property
    def total(self) -> int:
        return self.good + self.bad

    def with_next(self, other: Bin) -> Bin:
        return Bin(self.low, other.high, self.good + other.good, self.bad + other.bad)


@dataclass(frozen=True)
class Monotonic:
    """How micro bins are merged. most: the largest number of bins, or None; digits: places that WOE is compared at, or None."""

    min_share: float = 0.03
    max_share: float = 0.5
    increasing: bool = True
    most: int | None = 6
    digits: int | None = 4
    passes: int = 10


REPORT = Monotonic()
LIBRARY = Monotonic(min_share=0.05, most=None, digits=None)


def woe(b: Bin, goods: int, bads: int, digits: int | None = None) -> float:
    """ln of the bin's share of bads over its share of goods."""
    value = math.log(max(b.bad / bads if bads else 0, 1e-10) / max(b.good / goods if goods else 0, 1e-10))
    return value if digits is None else round(value, digits)


def by_share(micro: list[Bin], total: int, rule: Monotonic) -> list[Bin]:
    """Neighbours joined until each bin has the least share; a bin that would pass the largest one is closed before."""
    out: list[Bin] = []
    held: Bin | None = None
    for b in micro:
        grown = held.with_next(b) if held else b
        if grown.total > rule.max_share * total:
            out.append(held or b)
            held = b if held else None
        elif grown.total >= rule.min_share * total:
            out.append(grown)
            held = None
        else:
            held = grown
    if held:
        if out and held.total < rule.min_share * total:
            out[-1] = out[-1].with_next(held)
        else:
            out.append(held)
    return out


def monotonic(bins: list[Bin], goods: int, bads: int, rule: Monotonic = REPORT) -> list[Bin]:
    """Bins merged until their WOE runs one way, then to the largest number by the least gap, then until it runs one way again."""
    bins = list(bins)
    sign = 1 if rule.increasing else -1

    def join(i: int) -> None:
        bins[i : i + 2] = [bins[i].with_next(bins[i + 1])]

    def values() -> list[float]:
        return [sign * woe(b, goods, bads, rule.digits) for b in bins]

    def first_fall() -> int | None:
        v = values()
        return next((i for i in range(len(v) - 1) if v[i] > v[i + 1]), None)

    def straighten(times: int) -> None:
        for _ in range(times):
            at = first_fall() if len(bins) > 1 else None
            if at is None:
                return
            join(at)

    straighten(rule.passes)
    while rule.most and len(bins) > rule.most:
        v = values()
        join(min(range(len(v) - 1), key=lambda i: abs(v[i] - v[i + 1])))
        straighten(1)
    straighten(rule.passes)
    return bins


def label_counts(df: DataFrame, features: list[str], target: str) -> tuple[int, int, dict[str, tuple[int, int, int]]]:
    """(goods, bads, by feature: rows that are not missing, goods and bads among the missing), in one pass over the rows."""
    wanted = [F.count("*").alias("n"), F.sum(F.col(target).cast("long")).alias("b")]
    for i, f in enumerate(features):
        gone = missing(F.col(f).cast("double"))
        wanted += [F.sum((~gone).cast("long")).alias(f"k{i}"), F.sum((gone & (F.col(target) == 0)).cast("long")).alias(f"g{i}"), F.sum((gone & (F.col(target) == 1)).cast("long")).alias(f"d{i}")]
    r = df.where(F.col(target).isin(0, 1)).agg(*wanted).first()
    n, bads = r.n or 0, r.b or 0
    return n - bads, bads, {f: (r[f"k{i}"] or 0, r[f"g{i}"] or 0, r[f"d{i}"] or 0) for i, f in enumerate(features)}


def micro_bins(df: DataFrame, features: list[str], target: str, parts: int = 20, sizes: dict[str, int] | None = None) -> DataFrame:
    """feature, idx, low, high, good, bad of [a, b) bins between percentiles of the values that are not missing.

    Fewer parts for a feature with under 10 values for each: a tenth of its values, 5 at least. Empty bins are left out.
    sizes holds the rows that are not missing, by feature, where they are known.
    """
    rows = long(df.where(F.col(target).isin(0, 1)), features, [target]).where(~missing(F.col("value")))
    if sizes is None:
        sizes = {f: known for f, (known, _, _) in label_counts(df, features, target)[2].items()}
    by_parts: dict[int, list[str]] = {}
    for f, n in sizes.items():
        if not n:
            continue
        by_parts.setdefault(parts if n >= 10 * parts else max(5, n // 10), []).append(f)
    cuts: dict[str, list[float]] = {}
    for k, own in by_parts.items():
        got = quantiles(rows.where(F.col("feature").isin(own)), ["feature"], "value", [i / k for i in range(1, k)]).collect()
        for r in got:
            cuts.setdefault(r["feature"], []).append(r["quantile"])
    table = [(f, [-INF, *sorted(set(v)), INF]) for f, v in cuts.items()]
    edges = df.sparkSession.createDataFrame(table, "feature string, edges array<double>")
    placed = rows.join(F.broadcast(edges), "feature").withColumn("idx", F.expr("size(filter(edges, e -> value >= e)) - 1"))
    return placed.groupBy("feature", "idx").agg(
        F.first(F.expr("get(edges, idx)")).alias("low"), F.first(F.expr("get(edges, idx + 1)")).alias("high"),
        F.sum((F.col(target) == 0).cast("long")).alias("good"), F.sum((F.col(target) == 1).cast("long")).alias("bad"),
    )


MERGED = "feature string, bin int, low double, high double, good long, bad long"


def merged_bins(df: DataFrame, features: list[str], target: str, rule: Monotonic, counts: tuple | None = None) -> list[tuple]:
    """(feature, bin, low, high, good, bad) after merging: micro bins, 20 rows for a feature, are collected once and merged here."""
    goods, bads, own = counts or label_counts(df, features, target)
    n, held, out = goods + bads, {}, []
    if not n:
        return out
    for r in micro_bins(df, features, target, sizes={f: k for f, (k, _, _) in own.items()}).collect():
        held.setdefault(r["feature"], []).append((r["idx"], Bin(r["low"], r["high"], r["good"], r["bad"])))
    for name, micro in held.items():
        bins = by_share([b for _, b in sorted(micro, key=lambda x: x[0])], n, rule)
        bins = monotonic(bins, goods, bads, rule) if len(bins) > 1 else []
        out += [(name, i, b.low, b.high, b.good, b.bad) for i, b in enumerate(bins)]
    return out


def monotonic_bins(df: DataFrame, features: list[str], target: str, rule: Monotonic = REPORT) -> DataFrame:
    """feature, bin, low, high, good, bad after merging. Only micro bins, 20 rows for a feature, reach Python.

    Shares are of all labelled rows, WOE is of all their goods and bads, as the missing ones are a bin as well.
    Features that end in fewer than two bins are left out.
    """
    return df.sparkSession.createDataFrame(merged_bins(df, features, target, rule), MERGED)


def hull_edges(edges: list[float], good: list[int], bad: list[int]) -> list[float]:
    """Coarse edges: those where the convex hull of the cumulative (bad, good) shares turns, on the side of the larger area.

    edges bounds the bins, len(good) + 1 of them. With one class only, the edges are kept.
    """
    goods, bads = sum(good), sum(bad)
    if not goods or not bads:
        return list(edges)
    points, x, y = [(0.0, 0.0)], 0, 0
    for g, b in zip(good, bad, strict=True):
        x, y = x + b, y + g
        points.append((x / bads, y / goods))

    def hull(side: int) -> list[int]:
        kept: list[int] = []
        for i, p in enumerate(points):
            while len(kept) > 1:
                (ax, ay), (bx, by) = points[kept[-2]], points[kept[-1]]
                if side * ((bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax)) < 0:
                    break
                kept.pop()
            kept.append(i)
        return kept

    def area(kept: list[int]) -> float:
        own = [points[i] for i in kept]
        return abs(sum(a[0] * b[1] - a[1] * b[0] for a, b in zip(own, own[1:] + own[:1], strict=True))) / 2

    turns = max(hull(1), hull(-1), key=area)
    return [edges[i] for i in turns]


def joined_edges(edges: list[float], runs: list[tuple[int, int]]) -> list[float]:
    """Edges after the bins of each (first, last) are merged; overlapping or unknown runs are refused."""
    bins = len(edges) - 1
    inside: set[int] = set()
    for first, last in runs:
        if not 0 <= first <= last < bins:
            raise ValueError(f"no bins {first} to {last}")
        gone = set(range(first + 1, last + 1))
        if gone & inside or (first in inside):
            raise ValueError("runs of bins overlap")
        inside |= gone
    return [e for i, e in enumerate(edges) if i not in inside]


def cut_points(points: list[float]) -> list[float]:
    """Edges with open ends from cut points, which must be finite and rise."""
    if any(not math.isfinite(p) for p in points) or any(a >= b for a, b in zip(points, points[1:], strict=False)):
        raise ValueError("cut points must be finite and rise")
    return [-INF, *points, INF]


def woe_frame(df: DataFrame, tables: dict[str, tuple[list[float], list[float]]], keep: list[str], missing_woe: float = 0.0) -> DataFrame:
    """keep and, for each feature, the WOE of its (a, b] bin: tables holds interior edges and a value for each bin. One projection."""

    def value(name: str, interior: list[float], values: list[float]) -> Column:
        return F.coalesce(F.get(F.expr(_array(values)), right_closed(name, interior)), F.lit(missing_woe)).alias(name)

    return df.select(*keep, *(value(n, e, v) for n, (e, v) in tables.items()))


def edges_from_texts(texts: list[str]) -> list[float]:
    """Sorted distinct edges from texts: inf and -inf are read, `missing` is skipped, and the lowest edge is open."""
    out = sorted({float(t) for t in texts if t != "missing"})
    return out if out and out[0] == -INF else [-INF, *out]
