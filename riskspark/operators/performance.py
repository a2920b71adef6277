"""How a score ranks risk: lift, bins, amounts, crossed scores, segments and risk classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import divide
from .binning import quantile_edges, right_closed
from .curves import joint_tallies, rankings, with_all
from .running import quantiles, running

SHARES = (10, 5, 2, 1)


def lift(df: DataFrame, score: str, target: str, by: list[str] | None = None, shares: tuple[int, ...] = SHARES, lower_is_riskier: bool = True) -> DataFrame:
    """by, n, lift_<p>: the bad rate of the riskiest p % of the rows over that of all; 0 if p % is less than one row.

    Rows are ranked by (score, target); they are counted first, so the ranking costs the distinct scores.
    """
    by = by or []
    rows = df.where(F.col(target).isin(0, 1) & F.col(score).isNotNull())
    counts = rows.groupBy(*by, F.col(score).cast("double").alias("s"), F.col(target).cast("long").alias("t")).agg(F.count("*").alias("c"))
    counts = counts.withColumns({"s": F.col("s") if lower_is_riskier else -F.col("s"), "d": F.col("c") * F.col("t")})
    x = running(counts, by, ["s", "t"], {"before": "c"}, totals={"n": "c", "b": "d"})
    top = lambda p: F.floor(F.col("n") * p / 100)
    taken = lambda p: F.greatest(F.lit(0), F.least(F.col("c"), top(p) - F.col("before")))
    got = x.groupBy(*by, "n", "b").agg(*(F.sum(taken(p) * F.col("t")).alias(f"_{p}") for p in shares))
    rate = divide(F.col("b"), F.col("n"))
    return got.select(*by, "n", *(F.coalesce(divide(divide(F.col(f"_{p}"), top(p)), rate), F.lit(0.0)).alias(f"lift_{p}") for p in shares))


def monthly_lift(df: DataFrame, month: str, score: str, target: str, shares: tuple[int, ...] = SHARES) -> DataFrame:
    """lift() for each month, as text, and for all, from one tally of the scores."""
    rows = df.where(F.col(target).isin(0, 1) & F.col(score).isNotNull())
    tally = with_all(joint_tallies(rows, [month], score, target), month)
    sizes = tally.groupBy(month).agg(F.sum(F.col("good") + F.col("bad")).cast("long").alias("n"))
    ranked = rankings(tally, [month], {"": ("good", "bad")}, shares, rows.select(F.col(score).cast("double").alias("s")))
    lifts = ranked.select(F.col(month).alias("_m"), *(f"lift_{p}" for p in shares))
    return sizes.join(lifts, F.col(month).eqNullSafe(F.col("_m"))).select(month, "n", *(f"lift_{p}" for p in shares))


def monthly_report(metrics: DataFrame, lifts: DataFrame, month: str) -> DataFrame:
    """Monthly metrics and lift, by month."""
    return metrics.join(lifts.drop("n"), month)


def binned(bins: DataFrame, by: list[str], goods_bads: DataFrame | None = None, descending: bool = False) -> DataFrame:
    """Adds rates, cumulative rates, ks, lift and cum_lift, rounded to 4 places, to rows of by, bin, good, bad."""
    sums = goods_bads or bins.groupBy(*by).agg(F.sum("good").alias("goods"), F.sum("bad").alias("bads"))
    x = (bins.join(sums, by) if by else bins.crossJoin(F.broadcast(sums))).withColumn("total", F.col("good") + F.col("bad"))
    # bins are few
    w = Window.partitionBy(*by, *([] if by else [F.lit(0)])).orderBy(F.desc("bin") if descending else F.asc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumns({"cg": F.sum("good").over(w), "cb": F.sum("bad").over(w)})
    overall = F.col("bads") / (F.col("goods") + F.col("bads"))
    rate, cum = divide(F.col("bad"), F.col("total"), 0), divide(F.col("cb"), F.col("cb") + F.col("cg"), 0)
    ks = F.abs(divide(F.col("cb"), F.col("bads"), 0) - divide(F.col("cg"), F.col("goods"), 0))
    both = (F.col("goods") > 0) & (F.col("bads") > 0)
    shown = {
        "bad_rate": rate, "cum_bad_rate": cum, "cum_bads_prop": divide(F.col("cb"), F.col("bads"), 0), "ks": F.when(both, ks).otherwise(0.0),
        "lift": divide(rate, overall, 0), "cum_lift": divide(cum, overall, 0),
    }
    return x.select(*by, "bin", F.col("bad").alias("bads"), F.col("good").alias("goods"), "total", *(F.round(c, 4).alias(n) for n, c in shown.items()))


def _counted(df: DataFrame, by: list[str], target: str) -> DataFrame:
    return df.groupBy(*by, "bin").agg(F.sum((F.col(target) == 0).cast("long")).alias("good"), F.sum((F.col(target) == 1).cast("long")).alias("bad"))


def bin_metrics(df: DataFrame, score: str, target: str, parts: int = 10, by: list[str] | None = None, least: int = 0, base: Column | None = None) -> DataFrame:
    """binned() on equal-frequency bins of the score: (a, b], the first one closed on both sides.

    Edges are those of all rows (or of those where base holds); with by, groups of fewer than `least` rows are skipped.
    """
    by = by or []
    rows = df.where(F.col(target).isin(0, 1) & F.col(score).isNotNull())
    edges = quantile_edges(rows if base is None else rows.where(base), [score], parts)[score]
    placed = rows.withColumn("bin", right_closed(score, edges[1:-1]))
    counts = _counted(placed, by, target)
    if least:
        big = counts.groupBy(*by).agg(F.sum(F.col("good") + F.col("bad")).alias("n")).where(F.col("n") >= least).drop("n")
        counts = counts.join(big, by, "left_semi")
    return binned(counts, by)


def amount_metrics(df: DataFrame, score: str, target: str, overdue: str, loan: str, parts: int = 100) -> DataFrame:
    """By quantile bin of the score: counts, shares, bad and amount rates, cumulative ones, and their lifts. A good row's overdue is 0."""
    rows = df.where(F.col(target).isin(0, 1) & F.col(score).isNotNull())
    edges = quantile_edges(rows, [score], parts)[score]
    placed = rows.withColumn("bin", right_closed(score, edges[1:-1]))
    x = placed.groupBy("bin").agg(
        F.count("*").alias("cnt"), F.sum(F.col(target).cast("long")).alias("bad_cnt"), F.sum(F.col(loan).cast("double")).alias("loan"),
        F.sum(F.when(F.col(target) == 1, F.col(overdue).cast("double")).otherwise(0.0)).alias("overdue"),
    )
    own = ["cnt", "bad_cnt", "loan", "overdue"]
    whole, upto = Window.partitionBy(F.lit(0)), Window.partitionBy(F.lit(0)).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumns({f"all_{c}": F.sum(c).over(whole) for c in own} | {f"cum_{c}": F.sum(c).over(upto) for c in own})
    c = F.col
    rate, amount_rate = divide(c("all_bad_cnt"), c("all_cnt")), divide(c("all_overdue"), c("all_loan"))
    return x.select(
        "bin", "cnt", "bad_cnt", divide(c("bad_cnt"), c("all_bad_cnt")).alias("bad_share"), divide(c("cum_bad_cnt"), c("all_bad_cnt")).alias("cum_bad_share"),
        divide(c("bad_cnt"), c("cnt")).alias("bad_rate"), divide(c("cum_bad_cnt"), c("cum_cnt")).alias("cum_bad_rate"),
        divide(divide(c("bad_cnt"), c("cnt")), rate).alias("bad_lift"), divide(divide(c("cum_bad_cnt"), c("cum_cnt")), rate).alias("cum_bad_lift"),
        divide(c("loan"), c("all_loan")).alias("loan_share"), divide(c("overdue"), c("all_overdue")).alias("overdue_share"),
        divide(c("cum_overdue"), c("all_overdue")).alias("cum_overdue_share"), divide(c("overdue"), c("loan")).alias("amount_rate"),
        divide(c("cum_overdue"), c("cum_loan")).alias("cum_amount_rate"), divide(divide(c("overdue"), c("loan")), amount_rate).alias("amount_lift"),
        divide(divide(c("cum_overdue"), c("cum_loan")), amount_rate).alias("cum_amount_lift"),
    )


def crossed(df: DataFrame, new: str, old: str, target: str, overdue: str, loan: str, parts: int = 10) -> DataFrame:
    """By pair of quantile bins of two scores: counts, bad rate, lift, amount rate and its lift, with the bins' edges."""
    rows = df.where(F.col(target).isNotNull() & F.col(new).isNotNull() & F.col(old).isNotNull())
    edges = quantile_edges(rows, [new, old], parts)
    placed = rows.withColumns({"new_bin": right_closed(new, edges[new][1:-1]), "old_bin": right_closed(old, edges[old][1:-1])})
    x = placed.groupBy("new_bin", "old_bin").agg(
        F.count("*").alias("n"), F.sum(F.col(target).cast("long")).alias("bads"), F.sum(F.col(loan).cast("double")).alias("l"), F.sum(F.col(overdue).cast("double")).alias("o")
    )
    sums = x.agg(*(F.sum(c).alias(f"all_{c}") for c in ("n", "bads", "l", "o")))
    x = x.crossJoin(F.broadcast(sums))
    c = F.col
    rate, amount = divide(c("bads"), c("n")), divide(c("o"), c("l"))

    def bound(name: str, at: str, step: int) -> Column:
        listed = F.array(*map(F.lit, edges[name]))
        return F.get(listed, F.col(at) + step)

    return x.select(
        "new_bin", bound(new, "new_bin", 0).alias("new_low"), bound(new, "new_bin", 1).alias("new_high"),
        "old_bin", bound(old, "old_bin", 0).alias("old_low"), bound(old, "old_bin", 1).alias("old_high"),
        "n", "bads", rate.alias("bad_rate"), divide(rate, divide(c("all_bads"), c("all_n"))).alias("lift"),
        amount.alias("amount_rate"), divide(amount, divide(c("all_o"), c("all_l"))).alias("amount_lift"),
    )


def segments(df: DataFrame, segment: str, order: str, target: str) -> DataFrame:
    """By segment, ordered by its smallest `order`: counts, shares, cumulative shares, rates, ks, lift, odds, and the parts of
    AUC and Gini (trapezoids over cumulative shares)."""
    rows = df.where(F.col(target).isin(0, 1)).groupBy(F.col(segment).alias("segment")).agg(
        F.min(order).alias("low"), F.max(order).alias("high"),
        F.sum((F.col(target) == 0).cast("long")).alias("good"), F.sum((F.col(target) == 1).cast("long")).alias("bad"),
    )
    # segments are few
    one = Window.partitionBy(F.lit(0))
    way = one.orderBy("low", "segment")
    upto = way.rowsBetween(Window.unboundedPreceding, 0)
    c = F.col
    x = rows.withColumns({"goods": F.sum("good").over(one), "bads": F.sum("bad").over(one), "cg": F.sum("good").over(upto), "cb": F.sum("bad").over(upto)})
    x = x.withColumns({"cum_good": F.round(divide(c("cg"), c("goods"), 0), 4), "cum_bad": F.round(divide(c("cb"), c("bads"), 0), 4)})
    x = x.withColumns({"lag_good": F.lag("cum_good", 1, 0.0).over(way), "lag_bad": F.lag("cum_bad", 1, 0.0).over(way)})
    n = c("good") + c("bad")
    rate, cum, overall = divide(c("bad"), n, 0), divide(c("cb"), c("cb") + c("cg"), 0), divide(c("bads"), c("goods") + c("bads"), 0)
    return x.select(
        "segment", "low", "high", n.alias("n"), "good", "bad", F.round(divide(c("good"), c("goods"), 0), 4).alias("good_share"), "cum_good",
        F.round(divide(c("bad"), c("bads"), 0), 4).alias("bad_share"), "cum_bad", F.round(rate, 4).alias("bad_rate"), F.round(cum, 4).alias("cum_bad_rate"),
        F.round(divide(c("cb") + c("cg"), c("goods") + c("bads"), 0), 3).alias("cum_total"),
        F.round(F.abs(divide(c("cb"), c("bads"), 0) - divide(c("cg"), c("goods"), 0)), 4).alias("ks"),
        F.round(divide(rate, overall, 0), 1).alias("lift"), F.round(divide(cum, overall, 0), 1).alias("cum_lift"), F.round(divide(c("good"), c("bad"), 0), 1).alias("odds"),
        F.round(divide(n, c("goods") + c("bads"), 0), 3).alias("share"),
        ((c("cum_good") - c("lag_good")) * (c("cum_bad") + c("lag_bad")) / 2).alias("auc_part"),
        ((c("cum_bad") - c("lag_bad")) * (c("cum_good") + c("lag_good")) / 2).alias("gini_part"),
    )


def segment_totals(rows: DataFrame) -> DataFrame:
    """n, good, bad, bad_rate, ks, auc, gini of a segments() report."""
    return rows.agg(
        F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.round(divide(F.sum("bad"), F.sum("n"), 0), 4).alias("bad_rate"),
        F.max("ks").alias("ks"), F.round(F.sum("auc_part"), 4).alias("auc"), F.round(F.abs(1 - 2 * F.sum("gini_part")), 4).alias("gini"),
    )


def risk_division(rows: DataFrame) -> DataFrame:
    return rows.select("segment", "n", "bad", "bad_rate", "share", "lift")


#: Risk classes from the highest scores to the lowest, and their target shares.
CLASSES = {"A": 0.30, "B": 0.20, "C": 0.40, "D": 0.08, "E": 0.02}


def class_sizes(n: int, shares: dict[str, float]) -> list[int]:
    """Rounded sizes that sum to n; what rounding leaves over or lacks is spread from the last class upwards."""
    if abs(sum(shares.values()) - 1) > 1e-6:
        raise ValueError("shares must sum to 1")
    sizes = [round(p * n) for p in shares.values()]
    at = len(sizes) - 1
    while (rest := n - sum(sizes)) != 0:
        if rest > 0 or sizes[at] > 0:
            sizes[at] += 1 if rest > 0 else -1
        at = (at - 1) % len(sizes)
    return sizes


def risk_classes(df: DataFrame, score: str, target: str, shares: dict[str, float] | None = None, parts: int = 100) -> DataFrame:
    """class, low, high, n, share, bad, bad_rate: whole quantile bins, from the lowest score, fill the classes from the last.

    Only the bins, `parts` of them at most, reach the driver.
    """
    shares = shares or CLASSES
    names = list(shares)
    rows = df.where(F.col(target).isin(0, 1) & F.col(score).isNotNull())
    edges = quantile_edges(rows, [score], parts)[score]
    placed = rows.withColumn("bin", right_closed(score, edges[1:-1]))
    bins = placed.groupBy("bin").agg(F.count("*").alias("n")).orderBy("bin").collect()
    sizes = class_sizes(sum(b.n for b in bins), shares)
    level, held, of = len(names) - 1, 0, []
    for b in bins:
        if level > 0 and held >= sizes[level]:
            level, held = level - 1, 0
        of.append((b.bin, names[level]))
        held += b.n
    table = df.sparkSession.createDataFrame(of, "bin int, class string")
    got = placed.join(F.broadcast(table), "bin").groupBy("class").agg(
        F.min(score).alias("low"), F.max(score).alias("high"), F.count("*").alias("n"), F.sum(F.col(target).cast("long")).alias("bad")
    )
    whole = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return got.select("class", "low", "high", "n", F.round(F.col("n") / whole, 3).alias("share"), "bad", F.round(F.col("bad") / F.col("n"), 4).alias("bad_rate"))


def set_effects(df: DataFrame, group: str, score: str, target: str, train: Column, oot: Column | None = None, amount: str | None = None) -> DataFrame:
    """By value of group: n, bad, bad_rate, auc, ks, lifts, PSI against the train and (if given) the oot rows, and weighted auc and ks."""
    rows = df.where(F.col(target).isin(0, 1))
    out = rows.groupBy(group).agg(F.count("*").alias("n"), F.sum(F.col(target).cast("long")).alias("bad"))
    out = out.withColumn("bad_rate", F.round(F.col("bad") / F.col("n"), 4))
    pairs = {"": ("good", "bad")} | ({"amt_": ("w_good", "w_bad")} if amount else {})
    # one pass along the scores for all curves and lifts, one over the rows for all PSI
    ranked = rankings(joint_tallies(rows, [group], score, target, amount), [group], pairs, SHARES, rows.select(F.col(score).cast("double").alias("s")))
    out = out.join(ranked, group, "left")
    bases = {"psi_train": train} | ({"psi_oot": oot} if oot is not None else {})
    return out.join(psi_by_group(rows, group, score, bases), group, "left")


def psi_by_group(df: DataFrame, group: str, score: str, bases: dict[str, Column], parts: int = 10) -> DataFrame:
    """group and, by the names of bases, the psi of each group's scores against the base rows, on the base rows' quantile bins."""
    known = df.where(F.col(score).isNotNull()).select(F.col(group).alias("_g"), F.col(score).cast("double").alias("_s"), *(F.coalesce(c, F.lit(False)).alias(n) for n, c in bases.items()))
    of = known.select("_s", F.explode(F.array(*(F.when(F.col(n), F.lit(n)) for n in bases))).alias("base")).where("base IS NOT NULL AND NOT isnan(_s)")
    edges: dict[str, set[float]] = {n: set() for n in bases}
    for r in quantiles(of, ["base"], "_s", [k / parts for k in range(parts + 1)]).collect():
        edges[r["base"]].add(r["quantile"])
    counts = known.groupBy("_g", *bases, *(right_closed("_s", sorted(e)[1:-1]).alias(f"bin_{n}") for n, e in edges.items())).agg(F.count("*").alias("n"))
    out = None
    for name, own in edges.items():
        # as many bins as parts
        expected = counts.where(name).groupBy(F.col(f"bin_{name}").alias("bin")).agg(F.sum("n").alias("e"))
        sums = expected.agg(F.sum("e").alias("es"))
        grid = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(max(0, len(own) - 2)))).alias("bin"))
        groups = counts.groupBy("_g").agg(F.sum("n").alias("as"))
        seen = counts.groupBy("_g", F.col(f"bin_{name}").alias("bin")).agg(F.sum("n").alias("a"))
        x = groups.crossJoin(F.broadcast(grid)).join(seen, ["_g", "bin"], "left").join(F.broadcast(expected), "bin", "left").crossJoin(F.broadcast(sums))
        a = F.greatest(F.coalesce("a", F.lit(0)) / F.col("as"), F.lit(1e-10))
        e = F.greatest(F.coalesce("e", F.lit(0)) / F.col("es"), F.lit(1e-10))
        psi = x.groupBy("_g").agg(F.greatest(F.sum((a - e) * F.ln(a / e)), F.lit(0.0)).alias(name))
        out = psi if out is None else out.join(psi, "_g", "left")
    return out.withColumnRenamed("_g", group)
