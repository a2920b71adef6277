"""Scoring by trees, and scorecards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import binning, scorecard, scoring
from ..sources.model_text import parse_text
from .common import FEATURES, SAMPLE_SQL, query, rounded, sample

#: A small ensemble over the sample's features, in the public text form.
MODEL = """tree
version=v4
num_class=1
objective=binary sigmoid:1
max_feature_idx=3
feature_names=f_quantity f_price f_discount f_tax

Tree=0
num_leaves=4
split_feature=1 0 2
split_gain=120.5 40.25 12
threshold=30000.5 24.5 0.045
decision_type=2 2 2
left_child=1 -1 -2
right_child=2 -3 -4
leaf_value=-0.21 0.13 0.07 0.34

Tree=1
num_leaves=3
split_feature=3 0
split_gain=31 9.5
threshold=0.035 10.5
decision_type=2 0
left_child=-1 -2
right_child=1 -3
leaf_value=-0.05 0.11 -0.17

Tree=2
num_leaves=2
split_feature=2
split_gain=3.5
threshold=-1000
decision_type=2
left_child=-1
right_child=-2
leaf_value=0.4 -0.02

end of trees
"""


@query("tree_score", f"WITH {SAMPLE_SQL}, x AS ({scoring.full_sql(parse_text(MODEL), 'sample', ['key', 'line'])}) SELECT key, line, round(score, 6) AS score, all_null_flag FROM x")
def tree_score(spark, sf_dir):
    return rounded(scoring.score(sample(spark, sf_dir), parse_text(MODEL), ["key", "line"]).select("key", "line", "score", "all_null_flag"))


#: A tree that splits on sets of categories: 3, 4, 33 and 40, then 1, 2 and 50; features are spelled in another case than the columns.
CATEGORICAL = """tree
num_class=1
num_tree_per_iteration=1
objective=binary sigmoid:0.5
feature_names=F_Quantity F_Price

Tree=0
num_leaves=4
num_cat=2
split_feature=0 1 0
split_gain=10 6 4
threshold=0 40000 1
decision_type=1 2 1
cat_boundaries=0 2 4
cat_threshold=24 258 6 262144
left_child=-1 2 -2
right_child=1 -4 -3
leaf_value=1.5 -0.75 0.25 -2

end of trees
"""


@query("tree_score_categorical", f"""WITH {SAMPLE_SQL} SELECT key, line, round(1 / (1 + exp(-0.5 * CASE WHEN f_quantity IN (3, 4, 33, 40) THEN 1.5 WHEN f_price <= 40000 THEN CASE WHEN f_quantity IN (1, 2, 50) THEN -0.75 ELSE 0.25 END ELSE -2 END)), 6) AS score FROM sample""")
def tree_score_categorical(spark, sf_dir):
    return rounded(scoring.score(sample(spark, sf_dir), parse_text(CATEGORICAL), ["key", "line"]).select("key", "line", "score"))


@query("scorecard_map", f"""WITH {SAMPLE_SQL}, x AS ({scoring.full_sql(parse_text(MODEL), 'sample', ['month'])}) SELECT month, count(*) AS n, round(avg(score_card), 1) AS card, round(min(score_card), 1) AS low, round(max(score_card), 1) AS high FROM x GROUP BY 1""")
def scorecard_map(spark, sf_dir):
    x = scoring.score(sample(spark, sf_dir), parse_text(MODEL), ["month"])
    return x.groupBy("month").agg(F.count("*").alias("n"), F.round(F.avg("score_card"), 1).alias("card"), F.round(F.min("score_card"), 1).alias("low"), F.round(F.max("score_card"), 1).alias("high"))


def _woe(spark, sf_dir):
    """The sample with w_<feature>: WOE, good over bad, of five quantile bins; missing values are a bin at 0."""
    from ..operators import woe

    x = sample(spark, sf_dir)
    kept = ["f_quantity", "f_price", "f_discount"]
    goods, bads = woe.totals(x, "bad")
    known = x.select("bad", *(F.when(F.col(f) > -99999, F.col(f)).alias(f) for f in kept))
    edges = binning.quantile_edges(known, kept, 5)
    tables = {}
    for f in kept:
        counts = {r.b: (r.g, r.d) for r in known.where(F.col(f).isNotNull()).withColumn("b", binning.right_closed(f, edges[f][1:-1])).groupBy("b").agg(F.sum((F.col("bad") == 0).cast("long")).alias("g"), F.sum("bad").alias("d")).collect()}
        bins = [binning.Bin(0, 0, *counts.get(i, (0, 0))) for i in range(len(edges[f]) - 1)]
        tables[f] = [-binning.woe(b, goods, bads) for b in bins]
    wide = known.select("bad", *(F.coalesce(scorecard.woe_column(f, edges[f][1:-1], tables[f]), F.lit(0.0)).alias(f"w_{f}") for f in kept))
    return wide, edges, tables


@query("glm_wald")
def glm_wald(spark, sf_dir):
    """Estimates, errors and tests of a logistic model on WOE columns; tests hold the fit against numpy."""
    wide, _, _ = _woe(spark, sf_dir)
    names = [c for c in wide.columns if c != "bad"]
    rows = scorecard.wald(wide, scorecard.fit(wide, "bad", [scorecard.INTERCEPT, *names]))
    return spark.createDataFrame([(r.parameter, r.estimate, r.error, r.chi2, r.p, r.std, r.std_estimate, r.vif) for r in rows], "parameter string, estimate double, error double, chi2 double, p double, std double, std_estimate double, vif double")


@query("stepwise")
def stepwise(spark, sf_dir):
    wide, _, _ = _woe(spark, sf_dir)
    run = scorecard.Stepwise(p_most=0.5)
    model = run.run(wide, "bad", [c for c in wide.columns if c != "bad"])
    return spark.createDataFrame([(n, float(b)) for n, b in zip(model.names, model.estimates, strict=True)], "parameter string, estimate double")


@query("scorecard_points")
def scorecard_points(spark, sf_dir):
    wide, edges, tables = _woe(spark, sf_dir)
    names = [c for c in wide.columns if c != "bad"]
    model = scorecard.fit(wide, "bad", [scorecard.INTERCEPT, *names])
    bins = {f"w_{f}": list(zip(edges[f], edges[f][1:], tables[f], strict=False)) for f in tables}
    return spark.createDataFrame([(p.name, p.left, p.right, p.score) for p in scorecard.points(model, bins)], "name string, left double, right double, score double")


@query("correlation", f"WITH {SAMPLE_SQL} SELECT round(corr(f_quantity, f_price), 6) AS quantity_price, round(corr(f_quantity, f_discount), 6) AS quantity_discount FROM sample")
def correlation(spark, sf_dir):
    c = scorecard.correlations(sample(spark, sf_dir), FEATURES[:3])
    return rounded(spark.createDataFrame([(float(c[0, 1]), float(c[0, 2]))], "quantity_price double, quantity_discount double"))


@query("split_flags", f"""WITH {SAMPLE_SQL}, d AS (SELECT month, bad, CAST('0x' || substr(md5('2025:' || bad || ':' || key), 1, 8) AS BIGINT) % 1000000 / 1000000 AS draw FROM sample)
SELECT CASE WHEN month >= 200001 THEN 'oot' WHEN draw < 0.8 THEN 'train' ELSE 'test' END AS data_flag, bad, count(*) AS n FROM d GROUP BY 1, 2""")
def split_flags(spark, sf_dir):
    x = scorecard.split(sample(spark, sf_dir), "bad", "month", 200001, key="key")
    return x.groupBy("data_flag", "bad").agg(F.count("*").alias("n"))
