"""Checks of an output table against its sample: counts, missing values, distributions, keys, scores, coverage."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import FILL, divide, np_round
from .running import quantiles


def gone(column: str, fill: float = FILL) -> Column:
    """Null or the fill value."""
    return F.col(column).isNull() | (F.col(column) == F.lit(fill))


def sample_count(sample: DataFrame, output: DataFrame, month: str) -> DataFrame:
    """month, sample_cnt, output_cnt, diff_cnt, diff_pct; a month of one side only is kept."""
    a = sample.groupBy(month).agg(F.count("*").alias("sample_cnt"))
    b = output.groupBy(month).agg(F.count("*").alias("output_cnt"))
    both = a.join(b, month, "full_outer")
    diff = F.coalesce("output_cnt", F.lit(0)) - F.coalesce("sample_cnt", F.lit(0))
    return both.select(month, "sample_cnt", "output_cnt", diff.alias("diff_cnt"), F.round(divide(diff * 100, F.col("sample_cnt")), 4).alias("diff_pct"))


def missing_rates(df: DataFrame, month: str, features: list[str]) -> DataFrame:
    """month, total_cnt, <feature>_missing_pct."""
    parts = [F.round(F.avg(gone(f).cast("double")) * 100, 4).alias(f"{f}_missing_pct") for f in features]
    return df.groupBy(month).agg(F.count("*").alias("total_cnt"), *parts)


def high_missing(df: DataFrame, features: list[str], threshold: float = 50.0) -> DataFrame:
    """variable_name, total_cnt, null_cnt, missing_pct of the variables at or above the threshold, in one pass."""
    counts = df.agg(F.count("*").alias("total_cnt"), *(F.sum(gone(f).cast("long")).alias(f"_{f}") for f in features))
    rows = F.array(*(F.struct(F.lit(f).alias("variable_name"), F.col(f"_{f}").alias("null_cnt")) for f in features))
    x = counts.select("total_cnt", F.inline(rows)).withColumn("missing_pct", F.round(divide(F.col("null_cnt") * 100, F.col("total_cnt")), 4))
    return x.where(F.col("missing_pct") >= threshold).select("variable_name", "total_cnt", "null_cnt", "missing_pct")


def coverage(df: DataFrame, month: str, features: list[str]) -> DataFrame:
    """month, feature, n, filled, coverage: the share of rows that are not missing."""
    counts = df.groupBy(month).agg(F.count("*").alias("n"), *(F.sum((~gone(f)).cast("long")).alias(f) for f in features))
    long = counts.unpivot([month, "n"], features, "feature", "filled")
    return long.withColumn("coverage", F.round(F.col("filled") / F.col("n"), 4))


def distribution(df: DataFrame, month: str, features: list[str], exact: bool = True) -> DataFrame:
    """month, cnt and <feature>_avg, _std, _min, _max, _median; the median is exact, or approximate in the same pass."""
    stats = []
    for f in features:
        c = F.col(f).cast("double")
        stats += [F.round(F.avg(c), 6).alias(f"{f}_avg"), F.round(F.stddev_pop(c), 6).alias(f"{f}_std"), F.min(c).alias(f"{f}_min"), F.max(c).alias(f"{f}_max")]
        if not exact:
            stats.append(F.round(F.percentile_approx(c, 0.5), 6).alias(f"{f}_median"))
    out = df.groupBy(month).agg(F.count("*").alias("cnt"), *stats)
    if exact:
        rows = df.select(month, *(F.col(f).cast("double").alias(f) for f in features)).unpivot([month], features, "feature", "value")
        medians = quantiles(rows, [month, "feature"], "value", [0.5]).groupBy(month).pivot("feature", features).agg(F.first("quantile"))
        out = out.join(medians.select(month, *(F.round(F.col(f), 6).alias(f"{f}_median") for f in features)), month, "left")
    return out


def month_over_month(df: DataFrame, month: str, features: list[str]) -> DataFrame:
    """month, <feature>_avg, <feature>_mom_pct: the change of the monthly mean against the month before."""
    means = df.groupBy(month).agg(*(F.round(F.avg(F.col(f).cast("double")), 6).alias(f"{f}_avg") for f in features))
    # months are few
    w = Window.partitionBy(F.lit(0)).orderBy(month)
    change = lambda f: F.round(divide((F.col(f"{f}_avg") - F.lag(f"{f}_avg").over(w)) * 100, F.lag(f"{f}_avg").over(w)), 4)
    return means.select(month, *(x for f in features for x in (F.col(f"{f}_avg"), change(f).alias(f"{f}_mom_pct"))))


def key_uniqueness(df: DataFrame, keys: list[str]) -> DataFrame:
    """metric, value: rows, distinct keys, keys that occur more than once. A key is grouped once; nulls are a value."""
    per = df.groupBy(*keys).agg(F.count("*").alias("n"))
    sums = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_cnt"), F.count("*").alias("distinct_cnt"), F.coalesce(F.sum((F.col("n") > 1).cast("long")), F.lit(0)).alias("duplicate_keys"))
    return sums.unpivot([], ["total_cnt", "distinct_cnt", "duplicate_keys"], "metric", "value")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def score_distribution(df: DataFrame, month: str, score: str, exact: bool = True, digits: int = 4) -> DataFrame:
    """month, cnt, avg, std, min, max, p05, p25, p50, p75, p95, invalid_pct (share of the fill value or null)."""
    c = F.col(score).cast("double")
    shares = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
    valid = df.where(~gone(score))
    own = [F.count("*").alias("cnt"), F.round(F.avg(F.when(~gone(score), c)), digits).alias("avg"), F.round(F.stddev_pop(F.when(~gone(score), c)), digits).alias("std"),
           F.min(F.when(~gone(score), c)).alias("min"), F.max(F.when(~gone(score), c)).alias("max"), F.round(F.avg(gone(score).cast("double")) * 100, digits).alias("invalid_pct")]
    out = df.groupBy(month).agg(*own)
    if exact:
        q = quantiles(valid.select(month, c.alias("value")), [month], "value", list(shares.values()))
        wide = q.groupBy(month).pivot("share", list(shares.values())).agg(F.first("quantile"))
        wide = wide.select(month, *(F.round(F.col(f"`{p}`"), digits).alias(n) for n, p in shares.items()))
    else:
        got = valid.groupBy(month).agg(F.percentile_approx(c, F.array(*map(F.lit, shares.values()))).alias("q"))
        wide = got.select(month, *(F.round(F.get("q", F.lit(i)), digits).alias(n) for i, n in enumerate(shares)))
    return out.join(wide, month, "left")


#: Upper bounds and names of the score ranges.
RANGES = ((0, "01: <0"), (400, "02: [0,400)"), (500, "03: [400,500)"), (600, "04: [500,600)"), (700, "05: [600,700)"), (800, "06: [700,800)"))
LAST_RANGE = "07: >=800"


def score_ranges(df: DataFrame, month: str, score: str, ranges=RANGES, last: str = LAST_RANGE) -> DataFrame:
    """month, score_bucket, cnt, pct within the month; a null score falls in the last range."""
    bucket = None
    for high, name in ranges:
        test = F.col(score) < high
        bucket = F.when(test, name) if bucket is None else bucket.when(test, name)
    counts = df.groupBy(month, bucket.otherwise(last).alias("score_bucket")).agg(F.count("*").alias("cnt"))
    return counts.withColumn("pct", F.round(F.col("cnt") * 100.0 / F.sum("cnt").over(Window.partitionBy(month)), 4))


@dataclass(frozen=True)
class Check:
    """One check: its rows and what to look for."""

    name: str
    rows: DataFrame
    hint: str


@dataclass
class Validator:
    """All checks of an output table, lazily."""

    output: DataFrame
    sample: DataFrame
    features: list[str]
    month: str
    score: str
    keys: list[str] = field(default_factory=lambda: ["apply_no"])

    def all_checks(self, top: int = 20, key_features: int = 10) -> list[Check]:
        key = self.features[:key_features]
        return [
            Check("sample_count", sample_count(self.sample, self.output, self.month), "diff_pct within 0.1"),
            Check("missing_rate", missing_rates(self.output, self.month, self.features[:top]), "below 50, core variables below 10"),
            Check("high_missing", high_missing(self.output, self.features), "variables to look at"),
            Check("distribution", distribution(self.output, self.month, key), "means within 20 % of each other"),
            Check("month_over_month", month_over_month(self.output, self.month, key), "within 20"),
            Check("key_unique", key_uniqueness(self.output, self.keys), "no duplicate keys"),
            Check("score_distribution", score_distribution(self.output, self.month, self.score), "stable percentiles"),
            Check("score_ranges", score_ranges(self.output, self.month, self.score), "shares within 5"),
            Check("coverage", coverage(self.output, self.month, self.features), "core variables above 0.9"),
        ]


def missing_summary(df: DataFrame, features: list[str], at: float = -99999.0) -> DataFrame:
    """feature, n, missing, missing_rate by the rule for missing values, in one pass."""
    from ..functions import MissingPolicy

    kinds = dict(df.dtypes)
    policy = MissingPolicy(at)
    counts = df.agg(F.count("*").alias("n"), *(F.sum(policy.holds(F.col(f), kinds[f]).cast("long")).alias(f) for f in features))
    long = counts.unpivot(["n"], features, "feature", "missing")
    return long.select("feature", "n", F.coalesce("missing", F.lit(0)).alias("missing"), np_round(divide(F.col("missing"), F.col("n"), 0), 6).alias("missing_rate"))


def feature_filter(stats: DataFrame, missing_at_most: float = 1.0, iv_at_least: float = 0.0, psi_at_most: float = 1.0) -> DataFrame:
    """Rows of feature, missing_rate, iv, psi that pass all three thresholds."""
    return stats.where((F.col("missing_rate") <= missing_at_most) & (F.col("iv") >= iv_at_least) & (F.col("psi") <= psi_at_most))
