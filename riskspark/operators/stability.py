"""Population stability: of scores and variables, on quantile, equally wide or given bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ln_ratio
from .binning import equal_width_edges, long, quantile_edges, right_closed

FLOOR = 1e-10


def _psi(expected: DataFrame, actual: DataFrame, by: list[str]) -> DataFrame:
    """by, bin, expected and actual shares and the bin's part; bins of one side only have share 0 on the other, held up to FLOOR."""

    def shares(df: DataFrame, name: str) -> DataFrame:
        sums = df.groupBy(*by).agg(F.sum("n").alias("_all")) if by else df.agg(F.sum("n").alias("_all"))
        joined = df.join(sums, by) if by else df.crossJoin(F.broadcast(sums))
        return joined.select(*by, "bin", F.col("n").alias(f"n_{name}"), (F.col("n") / F.col("_all")).alias(name))

    both = shares(expected, "expected").join(shares(actual, "actual"), [*by, "bin"], "full_outer")
    both = both.fillna(0, ["n_expected", "n_actual"]).fillna(0.0, ["expected", "actual"])
    e, a = F.greatest("expected", F.lit(FLOOR)), F.greatest("actual", F.lit(FLOOR))
    return both.withColumn("part", (a - e) * ln_ratio(a, e, FLOOR))


def score_psi_bins(df: DataFrame, score: str, expected: Column, actual: Column, parts: int = 10) -> DataFrame:
    """bin, n_expected, n_actual, expected, actual, part on equal-frequency bins of the expected rows, open at the ends."""
    edges = quantile_edges(df.where(expected), [score], parts)[score]
    placed = df.where(F.col(score).isNotNull()).withColumn("bin", right_closed(score, edges[1:-1]))
    count = lambda rows: placed.where(rows).groupBy("bin").agg(F.count("*").alias("n"))
    return _psi(count(expected), count(actual), [])


def total_psi(bins: DataFrame, by: list[str] | None = None) -> DataFrame:
    """by, psi: the sum of the parts, 0 at least."""
    value = F.greatest(F.coalesce(F.sum("part"), F.lit(0.0)), F.lit(0.0)).alias("psi")
    return bins.groupBy(*by).agg(value) if by else bins.agg(value)


def variable_psi(df: DataFrame, features: list[str], expected: Column, actual: Column, parts: int = 10) -> DataFrame:
    """feature, psi for all features in one pass over the rows; nulls do not count."""
    rows = df.select(*features, expected.alias("_e"), actual.alias("_a")).where("_e OR _a")
    edges = quantile_edges(rows.where("_e"), features, parts)
    table = df.sparkSession.createDataFrame([(f, e[1:-1]) for f, e in edges.items()], "feature string, edges array<double>")
    placed = long(rows, features, ["_e", "_a"]).where("value IS NOT NULL AND NOT isnan(value)").join(F.broadcast(table), "feature")
    placed = placed.withColumn("bin", F.expr("size(filter(edges, e -> value > e))"))
    counts = placed.groupBy("feature", "bin").agg(F.sum(F.col("_e").cast("long")).alias("ne"), F.sum(F.col("_a").cast("long")).alias("na"))
    pick = lambda c: counts.where(F.col(c) > 0).select("feature", "bin", F.col(c).alias("n"))
    got = total_psi(_psi(pick("ne"), pick("na"), ["feature"]), ["feature"])
    names = df.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return names.join(got, "feature", "left").fillna(0.0, ["psi"])


def equal_width_psi(df: DataFrame, score: str, expected: Column, actual: Column, parts: int = 10) -> DataFrame:
    """bin, low, high, n_expected, n_actual, expected, actual, part; smoothed within the logarithm only."""
    both = df.where(expected | actual)
    edges = equal_width_edges(both, score, parts)
    placed = both.withColumn("bin", right_closed(score, edges[1:-1])).where("bin IS NOT NULL")
    counts = placed.groupBy("bin").agg(F.sum(expected.cast("long")).alias("n_expected"), F.sum(actual.cast("long")).alias("n_actual"))
    sums = counts.agg(F.sum("n_expected").alias("se"), F.sum("n_actual").alias("sa"))
    x = counts.crossJoin(F.broadcast(sums))
    x = x.withColumns({"expected": F.expr("try_divide(n_expected, se)"), "actual": F.expr("try_divide(n_actual, sa)")})
    grid = df.sparkSession.createDataFrame(list(zip(range(parts), edges[:-1], edges[1:], strict=True)), "bin int, low double, high double")
    part = (F.col("actual") - F.col("expected")) * F.ln((F.col("actual") + FLOOR) / (F.col("expected") + FLOOR))
    return F.broadcast(grid).join(x.drop("se", "sa").withColumn("part", part), "bin")


def fitted_psi(train: DataFrame, other: DataFrame, column: str, interior: list[float]) -> DataFrame:
    """bin (text, null bin included, TOTAL last), train, other, psi on fitted bins."""
    place = lambda df: df.select(F.coalesce(right_closed(column, interior).cast("string"), F.lit("null")).alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))
    bins = _psi(place(other), place(train), []).select("bin", F.col("actual").alias("train"), F.col("expected").alias("other"), F.col("part").alias("psi"))
    return bins.unionByName(bins.agg(F.lit("TOTAL").alias("bin"), *(F.sum(c).alias(c) for c in ("train", "other", "psi"))))
