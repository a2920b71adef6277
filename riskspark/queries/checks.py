"""Filters, transforms and fitted models, held against SQL by what must hold of their results."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import missing
from ..operators import binning, features, quality, scorecard, woe
from ..plans import metadata as md
from ..plans import planner
from ..reports.model_report import ReportConfig, check_input
from ..sources.model_text import parse_text
from .common import FEATURES, SAMPLE_SQL, query, sample, table
from .files import _values
from .modelling import MODEL, _woe
from .reporting import iv_sql


@query("row_filters", f"""WITH {SAMPLE_SQL} SELECT 'flag' AS rule, count(*) AS n FROM sample WHERE data_flag = 'oot' UNION ALL SELECT 'flags', count(*) FROM sample WHERE data_flag IN ('train', 'test')
UNION ALL SELECT 'month', count(*) FROM sample WHERE month = 199605 UNION ALL SELECT 'window', count(*) FROM sample WHERE loan_date BETWEEN DATE '1997-01-01' AND DATE '1998-06-30' UNION ALL SELECT 'known', count(*) FROM sample WHERE bad >= 0""")
def row_filters(spark, sf_dir):
    x = sample(spark, sf_dir)
    rules = {
        "flag": F.col("data_flag") == "oot", "flags": F.col("data_flag").isin("train", "test"), "month": F.col("month") == 199605,
        "window": F.col("loan_date").between(F.lit("1997-01-01").cast("date"), F.lit("1998-06-30").cast("date")), "known": F.col("bad") >= 0,
    }
    got = x.agg(*(F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(n) for n, c in rules.items()))
    return got.unpivot([], list(rules), "rule", "n")


@query("drop_variables", f"""WITH {SAMPLE_SQL}, n AS ({iv_sql()}), t AS (SELECT count(*) FILTER (bad = 0) AS tg, count(*) FILTER (bad = 1) AS tb FROM sample),
s AS (SELECT feature, sum((bad / tb - good / tg) * ln(greatest(bad / tb, 1e-10) / greatest(good / tg, 1e-10))) AS iv, max((good + bad) / (tg + tb)) AS share FROM n, t GROUP BY 1)
SELECT feature, CASE WHEN iv < 0.02 THEN 'iv' ELSE 'share' END AS reason FROM s WHERE iv < 0.02 OR share > 0.98""")
def drop_variables(spark, sf_dir):
    x = sample(spark, sf_dir)
    iv = woe.information_value(x, FEATURES, "bad")
    bins = woe.quantile_table(x, FEATURES, "bad", 10).select("feature", "good", "bad").unionByName(woe.missing_bins(x, FEATURES, "bad"))
    goods, bads = woe.totals(x, "bad")
    share = bins.groupBy("feature").agg((F.max(F.col("good") + F.col("bad")) / F.lit(max(1, goods + bads))).alias("max_share"))
    return woe.drop_list(iv.join(share, "feature"))


@query("importance_filter", _values([("f_quantity", True, False), ("f_price", True, True), ("f_discount", True, False), ("f_tax", True, False), ("f_unused", False, False)], "feature, used, blacklisted"))
def importance_filter(spark, sf_dir):
    """Features of no gain are left out; those on the blacklist are reported."""
    model = parse_text(MODEL.replace("f_discount f_tax", "f_discount f_tax f_unused"))
    listed = md.blacklisted(model.features, ["F_PRICE", "other"])
    return spark.createDataFrame([(f, f in model.valid_features(), f in listed) for f in model.features], "feature string, used boolean, blacklisted boolean")


@query("input_validation", _values([("as it is", False), ("no target", True), ("target of three", True), ("no train rows", True), ("no score", True)], "input, refused"))
def input_validation(spark, sf_dir):
    x, own = sample(spark, sf_dir), ReportConfig(target="bad", date="loan_date", flag="data_flag", scores=("score",))
    cases = {
        "as it is": x, "no target": x.drop("bad"), "target of three": x.withColumn("bad", F.when(F.col("line") == 1, 2).otherwise(F.col("bad"))),
        "no train rows": x.where("data_flag <> 'train'"), "no score": x.drop("score"),
    }

    def refused(df) -> bool:
        try:
            check_input(df, own)
        except ValueError:
            return True
        return False

    return spark.createDataFrame([(n, refused(df)) for n, df in cases.items()], "input string, refused boolean")


@query("feature_roles", _values([("feature", "f_discount"), ("feature", "f_price"), ("feature", "f_quantity"), ("feature", "f_tax"), ("feature", "overdue"), ("score", "score2"), ("fallback", "score")], "role, name"))
def feature_roles(spark, sf_dir):
    """Features are the numeric columns without a role; the score is the first of a list that is there."""
    x = sample(spark, sf_dir)
    c = ReportConfig(target="bad", key="key", part="month", scores=("score2", "score"), card_scores=("card", "score"), amount="amount", exclude=("line",))
    rows = [("feature", f) for f in c.features(x)] + [("score", c.score(x)), ("fallback", c.score(x, c.card_scores))]
    return spark.createDataFrame(rows, "role string, name string")


@query("woe_transform", f"""WITH {SAMPLE_SQL} SELECT key, line, CAST(CASE WHEN f_quantity <= 10 THEN -0.25 WHEN f_quantity <= 30 THEN 0.5 ELSE 0.125 END AS DOUBLE) AS f_quantity, CAST(CASE WHEN f_tax IS NULL THEN 9.0 WHEN f_tax <= 0.03 THEN -1.0 ELSE 1.0 END AS DOUBLE) AS f_tax FROM sample""")
def woe_transform(spark, sf_dir):
    """Values replaced by the weight of their bin, edges read from texts."""
    edges = binning.edges_from_texts(["30", "missing", "inf", "10", "-inf"])
    tables = {"f_quantity": (edges[1:-1], [-0.25, 0.5, 0.125]), "f_tax": (binning.cut_points([0.03])[1:-1], [-1.0, 1.0])}
    return binning.woe_frame(sample(spark, sf_dir), tables, ["key", "line"], 9.0).withColumn("f_quantity", F.col("f_quantity").cast("double"))


@query("missing_fill", f"""WITH {SAMPLE_SQL} SELECT key, line, CASE WHEN f_discount = -999999 THEN -1.0 ELSE f_discount END AS f_discount, coalesce(f_tax, -2.0) AS f_tax FROM sample""")
def missing_fill(spark, sf_dir):
    return features.fill(sample(spark, sf_dir).select("key", "line", "f_discount", "f_tax"), {"f_discount": -1.0, "f_tax": -2.0}, {"f_discount": -999999.0})


@query("custom_on_join", """SELECT o.o_orderkey AS apply_no, c.c_acctbal AS acctbal FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey AND c.c_acctbal > 0""")
def custom_on_join(spark, sf_dir):
    """A table joined by a condition of its own, which goes before all other rules."""
    meta = md.from_rows([{"name": "acctbal", "db": "wdyy", "table": "t_ccr_customer"}])
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("apply_no"), F.col("o_custkey").alias("cust_no"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cust_no"), F.col("c_acctbal").alias("acctbal"))
    config = planner.Config(custom={"wdyy.t_ccr_customer": planner.CustomJoin(join_key="cust_no", on="t.cust_no = s.cust_no AND t.acctbal > 0")})
    wide = planner.lower(planner.plan(meta, ["acctbal"], config), meta, o, planner.from_frames({"wdyy.t_ccr_customer": c}), config)
    return wide.select("apply_no", "acctbal")


_COUNTED = "(SELECT count(*) FROM sample) AS n, (SELECT CAST(sum(bad) AS BIGINT) FROM sample) AS bads"


@query("woe_monotonic_holds", f"WITH {SAMPLE_SQL} SELECT f AS feature, {_COUNTED}, TRUE AS rises, TRUE AS agrees FROM (VALUES {', '.join(f'({f!r})' for f in FEATURES)}) v(f)")
def woe_monotonic_holds(spark, sf_dir):
    """What must hold of monotonic bins: they hold all rows, WOE rises, and rows counted anew by the bins' edges agree."""
    x = sample(spark, sf_dir)
    rows = woe.monotonic_table(x, FEATURES, "bad").collect()
    out = []
    for f in FEATURES:
        own = sorted((r for r in rows if r["feature"] == f), key=lambda r: r["place"])
        bins = [r for r in own if r["place"] > 0]
        agrees, rises = True, all(a["woe"] <= b["woe"] for a, b in zip(bins, bins[1:], strict=False))
        # without a merge that ends in two bins there are quantile bins, which have no edges and need not rise
        if bins and bins[0]["low"] is not None:
            known = x.where(~missing(F.col(f)))
            again = {r.b: (r.g, r.d) for r in known.groupBy(binning.left_closed(f, [r["low"] for r in bins[1:]]).alias("b")).agg(F.sum((F.col("bad") == 0).cast("long")).alias("g"), F.sum(F.col("bad").cast("long")).alias("d")).collect()}
            agrees = [again.get(i) for i in range(len(bins))] == [(r["good"], r["bad"]) for r in bins]
        else:
            rises = True
        out.append((f, sum(r["good"] + r["bad"] for r in own), sum(r["bad"] for r in own), rises, agrees))
    return spark.createDataFrame(out, "feature string, n long, bads long, rises boolean, agrees boolean")


@query("coarse_bins_hold", f"WITH {SAMPLE_SQL} SELECT f AS feature, {_COUNTED}, TRUE AS hull, TRUE AS fewer FROM (VALUES ('f_price'), ('f_quantity')) v(f)")
def coarse_bins_hold(spark, sf_dir):
    """What must hold of bins by the convex hull: they hold all rows, their edges are fine edges, and good over bad changes in one direction."""
    x, out = sample(spark, sf_dir), []
    for f, e in binning.fine_edges(x, ["f_price", "f_quantity"]).items():
        def counted(edges, name=f):
            got = {r.b: (r.g, r.d) for r in x.groupBy(binning.right_closed(name, edges[1:-1]).alias("b")).agg(F.sum((F.col("bad") == 0).cast("long")).alias("g"), F.sum(F.col("bad").cast("long")).alias("d")).collect()}
            return [got.get(i, (0, 0)) for i in range(len(edges) - 1)]

        fine = counted(e)
        coarse = binning.hull_edges(e, [g for g, _ in fine], [d for _, d in fine])
        bins = counted(coarse)
        turns = [a[0] * b[1] - a[1] * b[0] for a, b in zip(bins, bins[1:], strict=False)]
        out.append((f, sum(map(sum, bins)), sum(d for _, d in bins), all(t >= 0 for t in turns) or all(t <= 0 for t in turns), set(coarse) <= set(e)))
    return spark.createDataFrame(out, "feature string, n long, bads long, hull boolean, fewer boolean")


def _gradients(wide, names, estimates):
    """The score equations at the estimates, as shares of what each term sums to: they are zero at the likelihood's maximum."""
    term = lambda n: F.lit(1.0) if n == scorecard.INTERCEPT else F.col(n)
    eta = F.lit(0.0)
    for n, b in zip(names, estimates, strict=True):
        eta = eta + F.lit(float(b)) * term(n)
    left = F.col("bad") - 1 / (1 + F.exp(-eta))
    r = wide.agg(*(F.abs(F.sum(left * term(n)) / F.sum(F.abs(term(n)))).alias(f"g{i}") for i, n in enumerate(names))).first()
    return [round(float(v or 0.0), 6) for v in r]


WOES = [scorecard.INTERCEPT, "w_f_quantity", "w_f_price", "w_f_discount"]


@query("glm_holds", _values([(n, 0.0, True, True) for n in WOES], "parameter, gradient, tested, spread").replace("0.0,", "CAST(0 AS DOUBLE),"))
def glm_holds(spark, sf_dir):
    """What must hold of a fit: score equations of zero, squared ratio of estimate and error as test, and its p-value of the normal law."""
    wide, _, _ = _woe(spark, sf_dir)
    model = scorecard.fit(wide, "bad", WOES)
    rows = {r.parameter: r for r in scorecard.wald(wide, model)}
    near = lambda a, b: abs(a - b) <= 1e-9 + 1e-6 * abs(b)
    out = []
    for n, g in zip(model.names, _gradients(wide, model.names, model.estimates), strict=True):
        r = rows[n]
        tested = near(r.chi2, (r.estimate / r.error) ** 2) and near(r.p, math.erfc(math.sqrt(r.chi2 / 2)))
        sd = 0.0 if n == scorecard.INTERCEPT else wide.agg(F.stddev_samp(n)).first()[0]
        out.append((n, g, tested, near(r.std_estimate, r.estimate * sd * math.sqrt(3) / math.pi)))
    return spark.createDataFrame(out, "parameter string, gradient double, tested boolean, spread boolean")


@query("stepwise_holds", _values([(True, True, True)], "solved, negative, within"))
def stepwise_holds(spark, sf_dir):
    """What must hold of a stepwise model: score equations of zero, no estimate of the wrong sign, and all tests within the bound."""
    wide, _, _ = _woe(spark, sf_dir)
    run = scorecard.Stepwise(p_most=0.5)
    model = run.run(wide, "bad", WOES[1:])
    own = [(n, b) for n, b in zip(model.names, model.estimates, strict=True) if n != scorecard.INTERCEPT]
    p = {r.parameter: r.p for r in scorecard.wald(wide, model)}
    solved = all(g == 0 for g in _gradients(wide, model.names, model.estimates))
    return spark.createDataFrame([(solved, all(b < 0 for _, b in own), all(p[n] <= 0.5 for n, _ in own))], "solved boolean, negative boolean, within boolean")


@query("scorecard_points_hold", _values([(True, True, True)], "odds, lowest, monotone"))
def scorecard_points_hold(spark, sf_dir):
    """What must hold of points: summed over a row they give its log odds on the scale of the card to the rounding, each variable's lowest bin
    has none, and points fall where the odds of bad rise."""
    wide, edges, tables = _woe(spark, sf_dir)
    model = scorecard.fit(wide, "bad", WOES)
    bins = {f"w_{f}": list(zip(edges[f], edges[f][1:], tables[f], strict=False)) for f in tables}
    rows = scorecard.points(model, bins)
    by = {n: [r.score for r in rows if r.name == n] for n in model.names}
    factor, b = 50 / math.log(2), dict(zip(model.names, model.estimates.tolist(), strict=True))
    base = by[scorecard.INTERCEPT][0]
    odds, monotone = True, True
    for pick in (min, max):
        chosen = {n: pick(range(len(w)), key=lambda i, w=w: w[i][2]) for n, w in bins.items()}
        eta = b[scorecard.INTERCEPT] + sum(b[n] * bins[n][i][2] for n, i in chosen.items())
        odds &= abs(base + sum(by[n][i] for n, i in chosen.items()) - (600 - factor * math.log(20) - factor * eta)) <= 0.5 * len(model.names)
    for n, w in bins.items():
        order = sorted(range(len(w)), key=lambda i: b[n] * w[i][2])
        monotone &= all(by[n][i] >= by[n][j] for i, j in zip(order, order[1:], strict=False))
    return spark.createDataFrame([(odds, all(min(by[n]) == 0 for n in bins), monotone)], "odds boolean, lowest boolean, monotone boolean")


@query("approximate_medians_hold", f"WITH {SAMPLE_SQL} SELECT month, TRUE AS near FROM sample GROUP BY 1")
def approximate_medians_hold(spark, sf_dir):
    """The approximate distribution check in one pass: at least 45 % of the rows are not above its medians, and as many not below."""
    x = sample(spark, sf_dir)
    rough = quality.distribution(x, "month", ["f_quantity", "f_price"], exact=False)
    column = next(c for c in rough.columns if "f_price" in c and "med" in c)
    both = x.select("month", "f_price").join(rough.select("month", F.col(column).alias("median")), "month")
    share = lambda test: F.avg(test.cast("double")) >= 0.45
    value = F.round("f_price", 4)
    return both.groupBy("month").agg((share(value <= F.col("median") + 1e-4) & share(value >= F.col("median") - 1e-4)).alias("near"))

