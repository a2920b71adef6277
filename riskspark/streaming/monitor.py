"""Windowed counts of a score stream, and their drift against a fixed base. The same functions take a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.binning import right_closed


def daily_counts(events: DataFrame, time: str, score: str, interior: list[float], late: str = "2 days", window: str = "1 day") -> DataFrame:
    """window start, bin, n of an event stream; rows later than `late` are dropped by the watermark."""
    binned = events.where(F.col(score).isNotNull()).withColumn("bin", right_closed(score, interior))
    return binned.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), "bin").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "bin", "n")


def score_drift(counts: DataFrame, base: dict[int, float]) -> DataFrame:
    """start, psi of each window's counts against base shares by bin; to be run on the closed windows of daily_counts()."""
    wide = counts.groupBy("start").agg(F.sum("n").alias("all"), *(F.sum(F.when(F.col("bin") == b, F.col("n")).otherwise(0)).alias(f"b{b}") for b in base))
    psi = F.lit(0.0)
    for b, share in base.items():
        a = F.greatest(F.col(f"b{b}") / F.col("all"), F.lit(1e-10))
        psi = psi + (a - max(share, 1e-10)) * F.ln(a / max(share, 1e-10))
    return wide.select("start", F.greatest(psi, F.lit(0.0)).alias("psi"))
