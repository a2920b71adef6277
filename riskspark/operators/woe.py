"""Weight of evidence, information value and two-sample KS, by variable."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import divide, ln_ratio, missing
from .binning import LIBRARY, REPORT, Monotonic, label_counts, long, merged_bins, monotonic_bins, quantile_edges
from .running import running


def rates(bins: DataFrame, goods: int, bads: int, by: list[str], digits: int | None = 4) -> DataFrame:
    """Adds total, good_prop, bad_prop, bad_rate, woe (ln of bad over good share), iv, ks and lift to rows of good and bad."""
    shown = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    overall = bads / (goods + bads) if goods + bads else 0.0
    x = bins.withColumns(
        {
            "total": F.col("good") + F.col("bad"),
            "good_prop": F.col("good") / F.lit(float(goods)) if goods else F.lit(0.0),
            "bad_prop": F.col("bad") / F.lit(float(bads)) if bads else F.lit(0.0),
        }
    )
    w = ln_ratio(F.col("bad_prop"), F.col("good_prop"))
    gap = F.col("bad_prop") - F.col("good_prop")
    rate = divide(F.col("bad"), F.col("total"), 0)
    return x.withColumns(
        {"bad_rate": shown(rate), "woe": shown(w), "iv": shown(gap * w), "ks": shown(F.abs(gap)), "lift": shown(rate / overall) if overall else F.lit(0.0)}
    )


def totals(df: DataFrame, target: str) -> tuple[int, int]:
    r = df.where(F.col(target).isin(0, 1)).agg(F.count("*").alias("n"), F.sum(F.col(target).cast("long")).alias("b")).first()
    return (r.n or 0) - (r.b or 0), r.b or 0


def categorical_table(df: DataFrame, column: str, target: str) -> DataFrame:
    """bin, good, bad and rates: one bin for each value as text (null: `missing`), worst first, ALL last (place tells the order)."""
    goods, bads = totals(df, target)
    rows = df.where(F.col(target).isin(0, 1)).groupBy(F.coalesce(F.col(column).cast("string"), F.lit("missing")).alias("bin"))
    bins = rates(rows.agg(F.sum((F.col(target) == 0).cast("long")).alias("good"), F.sum((F.col(target) == 1).cast("long")).alias("bad")), goods, bads, [])
    # as many rows as the column has values
    bins = bins.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("bad_rate"), "bin")))
    return with_total(bins, goods, bads)


def with_total(bins: DataFrame, goods: int, bads: int) -> DataFrame:
    overall = bads / (goods + bads) if goods + bads else 0.0
    last = bins.agg(
        F.lit("ALL").alias("bin"), F.lit(goods).cast("long").alias("good"), F.lit(bads).cast("long").alias("bad"), F.lit(goods + bads).cast("long").alias("total"),
        F.lit(1.0).alias("good_prop"), F.lit(1.0).alias("bad_prop"), F.lit(overall).alias("bad_rate"), F.lit(0.0).alias("woe"),
        F.coalesce(F.sum("iv"), F.lit(0.0)).alias("iv"), F.lit(0.0).alias("ks"), F.lit(1.0).alias("lift"), (F.coalesce(F.max("place"), F.lit(0)) + 1).alias("place"),
    )
    return bins.unionByName(last)


def quantile_table(df: DataFrame, features: list[str], target: str, parts: int = 5, sums: tuple[int, int] | None = None) -> DataFrame:
    """feature, bin, good, bad and rates on (a, b] equal-frequency bins; missing values are left out of bins, not of totals (sums, if known)."""
    goods, bads = sums or totals(df, target)
    # a missing value is null from here on
    known = df.where(F.col(target).isin(0, 1)).select(target, *(F.when(~missing(F.col(f).cast("double")), F.col(f).cast("double")).alias(f) for f in features))
    edges = quantile_edges(known, features, parts)
    table = df.sparkSession.createDataFrame([(f, e[1:-1]) for f, e in edges.items()], "feature string, edges array<double>")
    placed = long(known, features, [target]).where("value IS NOT NULL").join(F.broadcast(table), "feature")
    bins = placed.groupBy("feature", F.expr("size(filter(edges, e -> value > e))").alias("bin")).agg(
        F.sum((F.col(target) == 0).cast("long")).alias("good"), F.sum((F.col(target) == 1).cast("long")).alias("bad")
    )
    return rates(bins, goods, bads, ["feature"])


def missing_bins(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """feature, good, bad of the rows where the feature is missing."""
    rows = long(df.where(F.col(target).isin(0, 1)), features, [target]).where(missing(F.col("value")))
    return rows.groupBy("feature").agg(F.sum((F.col(target) == 0).cast("long")).alias("good"), F.sum((F.col(target) == 1).cast("long")).alias("bad"))


def monotonic_table(df: DataFrame, features: list[str], target: str, rule: Monotonic = REPORT) -> DataFrame:
    """feature, place, low, high (null for missing), good, bad and rates; the missing bin has place 0. Features whose merge
    fails get five quantile bins instead."""
    spark, nothing = df.sparkSession, F.lit(None).cast("double")
    counts = label_counts(df, features, target)
    goods, bads, own = counts
    bins = merged_bins(df, features, target, rule, counts)
    rows = [(f, i + 1, low, high, good, bad) for f, i, low, high, good, bad in bins]
    rows += [(f, 0, None, None, g, d) for f, (_, g, d) in own.items() if g + d]
    merged = spark.createDataFrame(rows, "feature string, place int, low double, high double, good long, bad long")
    rest = [f for f in features if f not in {r[0] for r in bins}]
    if rest:
        backup = quantile_table(df, rest, target, sums=(goods, bads)).select("feature", (F.col("bin") + 1).alias("place"), nothing.alias("low"), nothing.alias("high"), "good", "bad")
        merged = merged.unionByName(backup)
    return rates(merged, goods, bads, ["feature"], rule.digits)


def library_table(df: DataFrame, feature: str, target: str, increasing: bool = True) -> DataFrame:
    """The monotonic table without a largest number of bins and without rounding; fewer than two bins are an error."""
    rule = Monotonic(LIBRARY.min_share, LIBRARY.max_share, increasing, None, None)
    if monotonic_bins(df, [feature], target, rule).isEmpty():
        raise ValueError(f"{feature}: fewer than two bins")
    return monotonic_table(df, [feature], target, rule)


def information_value(df: DataFrame, features: list[str], target: str, parts: int = 10) -> DataFrame:
    """feature, iv on equal-frequency bins with the missing rows as a bin of their own."""
    goods, bads, own = label_counts(df, features, target)
    known = quantile_table(df, features, target, parts, (goods, bads)).select("feature", "good", "bad")
    gone = df.sparkSession.createDataFrame([(f, g, d) for f, (_, g, d) in own.items() if g + d], "feature string, good long, bad long")
    both = rates(known.unionByName(gone), goods, bads, ["feature"], None)
    return both.groupBy("feature").agg(F.sum("iv").alias("iv"))


def two_sample_ks(df: DataFrame, features: list[str], target: str, least: int = 2) -> DataFrame:
    """feature, ks, at (the smallest value of the largest gap), goods, bads, missing_rate for all features in one pass.

    Missing values do not count; ks is 0 where a class has fewer than `least` values.
    """
    rows = long(df.where(F.col(target).isin(0, 1)), features, [target]).withColumn("gone", missing(F.col("value")))
    rate = rows.groupBy("feature").agg(F.avg(F.col("gone").cast("double")).alias("missing_rate"))
    tally = rows.where("NOT gone").groupBy("feature", "value").agg(
        F.sum((F.col(target) == 0).cast("long")).alias("good"), F.sum((F.col(target) == 1).cast("long")).alias("bad")
    )
    run = running(tally, ["feature"], ["value"], {"below_good": "good", "below_bad": "bad"})
    sums = tally.groupBy("feature").agg(F.sum("good").alias("goods"), F.sum("bad").alias("bads"))
    gap = F.abs(divide(F.col("below_bad") + F.col("bad"), F.col("bads"), 0) - divide(F.col("below_good") + F.col("good"), F.col("goods"), 0))
    found = run.join(sums, "feature").groupBy("feature").agg(
        F.max(gap).alias("gap"), F.max_by(-F.col("value"), F.struct(gap.alias("g"), (-F.col("value")).alias("v"))).alias("minus"), F.first("goods").alias("goods"), F.first("bads").alias("bads")
    )
    enough = (F.col("goods") >= least) & (F.col("bads") >= least)
    return rate.join(found, "feature", "left").select(
        "feature", F.when(enough, F.col("gap")).otherwise(0.0).alias("ks"), F.when(enough, -F.col("minus")).alias("at"),
        F.coalesce("goods", F.lit(0)).alias("goods"), F.coalesce("bads", F.lit(0)).alias("bads"), "missing_rate",
    )


def ks_table(df: DataFrame, features: list[str], target: str, least: int = 2) -> DataFrame:
    """two_sample_ks() with p_value, the asymptotic two-sided one as a column, and the largest KS first."""
    x = two_sample_ks(df, features, target, least)
    at = F.col("ks") * F.sqrt(divide(F.col("goods") * F.col("bads"), F.col("goods") + F.col("bads"), 0))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), lambda s, k: s + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * at * at)
    )
    p = F.when(at < 0.2, 1.0).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))
    return x.withColumn("p_value", p).orderBy(F.desc("ks"), "feature")


def kolmogorov_p(ks: float, goods: int, bads: int) -> float:
    """The asymptotic two-sided p-value of a two-sample KS statistic."""
    if not goods or not bads:
        return 1.0
    x = ks * math.sqrt(goods * bads / (goods + bads))
    if x < 0.2:
        return 1.0
    return min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101))))


def binned_ks(df: DataFrame, column: str, target: str, parts: int = 10) -> DataFrame:
    """bin, good, bad, cum_good, cum_bad, ks on equal-frequency bins."""
    goods, bads = totals(df.where(F.col(column).isNotNull()), target)
    bins = quantile_table(df, [column], target, parts).select("bin", "good", "bad")
    # as many rows as there are bins
    w = Window.partitionBy(F.lit(0)).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    x = bins.withColumns({"cum_good": F.sum("good").over(w) / F.lit(float(max(goods, 1))), "cum_bad": F.sum("bad").over(w) / F.lit(float(max(bads, 1)))})
    return x.withColumn("ks", F.abs(F.col("cum_bad") - F.col("cum_good")))


def binner_table(df: DataFrame, bin_column: str, target: str, weight: str | None = None) -> DataFrame:
    """bin, good, bad, total, pct_good, pct_bad, pct_total, woe (ln of good over bad share, infinities 0), iv, bad_rate, lift, max_share."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.where(F.col(target).isin(0, 1)).groupBy(F.col(bin_column).alias("bin")).pivot(target, [0, 1]).agg(F.sum(w))
    x = rows.select("bin", F.coalesce("0", F.lit(0.0)).alias("good"), F.coalesce("1", F.lit(0.0)).alias("bad"))
    sums = x.agg(F.sum("good").alias("g"), F.sum("bad").alias("b"))
    x = x.crossJoin(F.broadcast(sums)).withColumn("total", F.col("good") + F.col("bad"))
    x = x.withColumns({"pct_good": divide(F.col("good"), F.col("g"), 0), "pct_bad": divide(F.col("bad"), F.col("b"), 0), "pct_total": divide(F.col("total"), F.col("g") + F.col("b"), 0)})
    woe = F.when((F.col("pct_good") > 0) & (F.col("pct_bad") > 0), F.ln(F.col("pct_good") / F.col("pct_bad"))).otherwise(0.0)
    x = x.withColumns({"woe": woe, "iv": (F.col("pct_good") - F.col("pct_bad")) * woe, "bad_rate": divide(F.col("bad"), F.col("total"), 0)})
    overall = F.col("b") / (F.col("g") + F.col("b"))
    x = x.withColumn("lift", divide(F.col("bad_rate"), overall, 0))
    return x.withColumn("max_share", F.max("pct_total").over(Window.partitionBy(F.lit(0)))).drop("g", "b")


def drop_list(stats: DataFrame, iv: float = 0.02, share: float = 0.98) -> DataFrame:
    """Of rows of feature, iv and max_share: the features that are too weak or too concentrated, with the reason."""
    weak, dense = F.col("iv") < iv, F.col("max_share") > share
    return stats.where(weak | dense).select("feature", F.when(weak, "iv").otherwise("share").alias("reason"))
