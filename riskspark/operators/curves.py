"""AUC and KS of scores, weighted or not, overall and by group.

The positive class is the good one (target 0) and a higher score is safer, so AUC is the chance that a good row scores
above a bad one, ties counting half, and KS is the largest lead of the goods' over the bads' share from the top.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import divide
from .running import running

ALL = "all"


def tallies(df: DataFrame, by: list[str], score: str, target: str, weight: str | None = None) -> DataFrame:
    """by, s, good, bad: weights of goods and bads at each distinct score; null scores and targets do not count."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.where(F.col(score).isNotNull() & F.col(target).isin(0, 1))
    return rows.groupBy(*by, F.col(score).cast("double").alias("s")).agg(
        F.sum(F.when(F.col(target) == 0, w).otherwise(0.0)).alias("good"), F.sum(F.when(F.col(target) == 1, w).otherwise(0.0)).alias("bad")
    )


def joint_tallies(df: DataFrame, by: list[str], score: str, target: str, weight: str | None = None) -> DataFrame:
    """tallies() of rows and, with a weight, of weights (w_good, w_bad) side by side."""
    rows = df.where(F.col(score).isNotNull() & F.col(target).isin(0, 1))
    one = lambda t, w: F.sum(F.when(F.col(target) == t, w).otherwise(0.0))
    w = [one(0, F.col(weight).cast("double")).alias("w_good"), one(1, F.col(weight).cast("double")).alias("w_bad")] if weight else []
    return rows.groupBy(*by, F.col(score).cast("double").alias("s")).agg(one(0, F.lit(1.0)).alias("good"), one(1, F.lit(1.0)).alias("bad"), *w)


def rankings(tally: DataFrame, by: list[str], pairs: dict[str, tuple[str, str]], shares: tuple[int, ...] = (), source: DataFrame | None = None) -> DataFrame:
    """by and, for each prefix: (good, bad) of pairs, <prefix>auc and <prefix>ks, null where a group lacks one class; with shares also lift_<p>,
    the bad rate of the lowest p % of the first pair's rows over that of all. All of it from one pass along the scores."""
    names = {c for pair in pairs.values() for c in pair}
    run = running(tally, by, ["s"], {f"above_{c}": c for c in names}, descending=True, totals={f"all_{c}": c for c in names}, source=source)
    aggregates, shown = [], []
    for prefix, (good, bad) in pairs.items():
        goods, bads = F.col(f"all_{good}"), F.col(f"all_{bad}")
        lead = divide(F.col(f"above_{good}") + F.col(good), goods) - divide(F.col(f"above_{bad}") + F.col(bad), bads)
        area = F.col(bad) * (F.col(f"above_{good}") + F.col(good) / 2)
        aggregates += [
            divide(F.sum(area), F.first(goods) * F.first(bads)).alias(f"{prefix}auc"), F.greatest(F.max(lead), F.lit(0.0)).alias(f"{prefix}ks"),
            ((F.first(goods) > 0) & (F.first(bads) > 0)).alias(f"{prefix}both"),
        ]
        shown += [F.when(F.col(f"{prefix}both"), F.col(f"{prefix}{m}")).alias(f"{prefix}{m}") for m in ("auc", "ks")]
    if shares:
        good, bad = next(iter(pairs.values()))
        n = F.col(f"all_{good}") + F.col(f"all_{bad}")
        rate = divide(F.first(f"all_{bad}"), F.first(n))
        # within a score the good rows come first
        before = n - F.col(f"above_{good}") - F.col(f"above_{bad}") - F.col(bad)
        for p in shares:
            top = F.floor(n * p / 100)
            taken = F.sum(F.greatest(F.lit(0.0), F.least(F.col(bad), top - before)))
            aggregates.append(F.coalesce(divide(divide(taken, F.first(top)), rate), F.lit(0.0)).alias(f"lift_{p}"))
        shown += [F.col(f"lift_{p}") for p in shares]
    out = run.groupBy(*by).agg(*aggregates) if by else run.agg(*aggregates)
    return out.select(*by, *shown)


def auc_ks(tally: DataFrame, by: list[str]) -> DataFrame:
    """by, auc, ks: null where a group lacks one class."""
    return rankings(tally, by, {"": ("good", "bad")})


def with_all(tally: DataFrame, group: str) -> DataFrame:
    """The tally by group, as text, with the rows of the group `all` added: the second sum runs over distinct scores only."""
    own = tally.withColumn(group, F.col(group).cast("string"))
    whole = own.groupBy("s").agg(*(F.sum(c).alias(c) for c in own.columns if c not in (group, "s"))).withColumn(group, F.lit(ALL))
    return own.unionByName(whole)


def group_metrics(df: DataFrame, group: str, score: str, target: str, amount: str | None = None) -> DataFrame:
    """group, total, good, bad, bad_rate, auc, ks and, with an amount, amt_auc and amt_ks; one row for each group and one for all."""
    rows = df.where(F.col(group).isNotNull())
    tally = with_all(joint_tallies(rows, [group], score, target, amount), group)
    pairs = {"": ("good", "bad")} | ({"amt_": ("w_good", "w_bad")} if amount else {})
    out = rankings(tally, [group], pairs, source=rows.select(F.col(score).cast("double").alias("s")))
    out = out.select(group, *(F.round(c, 4).alias(c) for c in out.columns if c != group))
    counted = rows.groupBy(F.col(group).cast("string").alias(group)).agg(F.count("*").alias("total"), F.sum(F.col(target).cast("long")).alias("bad"))
    whole = counted.agg(F.sum("total").alias("total"), F.sum("bad").alias("bad")).withColumn(group, F.lit(ALL))
    counted = counted.unionByName(whole.select(counted.columns)).where("total > 0")
    counted = counted.select(group, "total", (F.col("total") - F.col("bad")).alias("good"), "bad", F.round(divide(F.col("bad"), F.col("total")), 4).alias("bad_rate"))
    return counted.join(out, group, "left")
