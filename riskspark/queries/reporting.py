"""Model and variable reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import missing
from ..operators import binning, curves, performance, quality, stability, woe
from .common import FEATURES, SAMPLE_SQL, query, rounded, sample, table, unpivoted


def auc_ks_sql(group: str, weight: str = "1.0", source: str = "sample") -> str:
    """CTEs ending in curve(g, auc, ks) of a source by a group expression."""
    return f"""
t AS (SELECT {group} AS g, score AS s, sum(CASE WHEN bad = 0 THEN {weight} ELSE 0 END) AS good, sum(CASE WHEN bad = 1 THEN {weight} ELSE 0 END) AS bad FROM {source} GROUP BY 1, 2),
c AS (SELECT *, sum(good) OVER w AS cg, sum(bad) OVER w AS cb, sum(good) OVER (PARTITION BY g) AS tg, sum(bad) OVER (PARTITION BY g) AS tb FROM t
  WINDOW w AS (PARTITION BY g ORDER BY s DESC ROWS UNBOUNDED PRECEDING)),
curve AS (SELECT g, sum(bad * (cg - good / 2)) / (max(tg) * max(tb)) AS auc, greatest(max(cg / tg - cb / tb), 0) AS ks FROM c GROUP BY g HAVING max(tg) > 0 AND max(tb) > 0)"""


BOTH = "(SELECT CAST(month AS VARCHAR) AS gg, * FROM sample UNION ALL SELECT 'all' AS gg, * FROM sample)"


@query("monthly_auc_ks", f"""WITH {SAMPLE_SQL}, {auc_ks_sql('gg', source=BOTH)},
n AS (SELECT gg AS month, count(*) AS total, CAST(sum(bad) AS BIGINT) AS bad FROM {BOTH} GROUP BY 1)
SELECT month, total, total - bad AS good, bad, round(bad / total, 4) AS bad_rate, round(auc, 4) AS auc, round(ks, 4) AS ks FROM n LEFT JOIN curve ON g = month""")
def monthly_auc_ks(spark, sf_dir) -> DataFrame:
    return curves.group_metrics(sample(spark, sf_dir), "month", "score", "bad").select("month", "total", "good", "bad", "bad_rate", "auc", "ks")


@query("weighted_auc_ks", f"""WITH {SAMPLE_SQL}, {auc_ks_sql('data_flag', 'amount')} SELECT g AS data_flag, round(auc, 6) AS auc, round(ks, 6) AS ks FROM curve""")
def weighted_auc_ks(spark, sf_dir):
    return rounded(curves.auc_ks(curves.tallies(sample(spark, sf_dir), ["data_flag"], "score", "bad", "amount"), ["data_flag"]))


@query("auc_ks_by_flag", f"""WITH {SAMPLE_SQL}, {auc_ks_sql('data_flag')} SELECT g AS data_flag, round(auc, 6) AS auc, round(ks, 6) AS ks FROM curve""")
def auc_ks_by_flag(spark, sf_dir):
    return rounded(curves.auc_ks(curves.tallies(sample(spark, sf_dir), ["data_flag"], "score", "bad"), ["data_flag"]))


def lift_sql(group: str, source: str) -> str:
    cols = ", ".join(f"round(coalesce(avg(CASE WHEN r <= floor(n * {p} / 100) THEN bad END) / max(b), 0), 6) AS lift_{p}" for p in (10, 5, 2, 1))
    return f"""SELECT g AS month, max(n) AS n, {cols} FROM (SELECT {group} AS g, bad, row_number() OVER (PARTITION BY {group} ORDER BY score, bad) AS r,
  count(*) OVER (PARTITION BY {group}) AS n, avg(bad) OVER (PARTITION BY {group}) AS b FROM {source}) GROUP BY g"""


@query("lift_by_month", f"WITH {SAMPLE_SQL} {lift_sql('gg', BOTH)}")
def lift_by_month(spark, sf_dir):
    return rounded(performance.monthly_lift(sample(spark, sf_dir), "month", "score", "bad"))


@query("lift_top_pct", f"WITH {SAMPLE_SQL} SELECT n, lift_10, lift_5, lift_2, lift_1 FROM ({lift_sql('1', 'sample')})")
def lift_top_pct(spark, sf_dir):
    return rounded(performance.lift(sample(spark, sf_dir), "score", "bad"))


@query("monthly_report", f"""WITH {SAMPLE_SQL}, {auc_ks_sql('gg', source=BOTH)}, l AS ({lift_sql('gg', BOTH)}),
n AS (SELECT gg AS month, count(*) AS total, CAST(sum(bad) AS BIGINT) AS bad FROM {BOTH} GROUP BY 1)
SELECT month, total, total - bad AS good, bad, round(bad / total, 4) AS bad_rate, round(auc, 4) AS auc, round(ks, 4) AS ks, lift_10, lift_5, lift_2, lift_1
FROM n JOIN l USING (month) LEFT JOIN curve ON g = month""")
def monthly_report(spark, sf_dir):
    x = sample(spark, sf_dir)
    return rounded(performance.monthly_report(curves.group_metrics(x, "month", "score", "bad"), performance.monthly_lift(x, "month", "score", "bad"), "month"))


def edges_sql(expr: str, where: str, parts: int, source: str = "sample") -> str:
    shares = ", ".join(str(k / parts) for k in range(parts + 1))
    return f"(SELECT list_sort(list_distinct(quantile_cont({expr}, [{shares}]))) FROM {source} WHERE {where})"


def bin_sql(expr: str, edges: str) -> str:
    """The (a, b] bin of a value among edges whose ends are open."""
    return f"len(list_filter({edges}[2:len({edges}) - 1], lambda e: {expr} > e))"


def psi_parts(e: str, a: str) -> str:
    return f"(greatest({a}, 1e-10) - greatest({e}, 1e-10)) * ln(greatest({a}, 1e-10) / greatest({e}, 1e-10))"


@query("score_psi_train_oot", f"""WITH {SAMPLE_SQL}, q AS (SELECT {edges_sql('score', "data_flag = 'train'", 10)} AS e),
b AS (SELECT {bin_sql('score', 'e')} AS bin, data_flag FROM sample, q WHERE data_flag IN ('train', 'oot')),
n AS (SELECT CAST(bin AS INTEGER) AS bin, count(*) FILTER (data_flag = 'train') AS n_expected, count(*) FILTER (data_flag = 'oot') AS n_actual FROM b GROUP BY 1),
s AS (SELECT *, n_expected / sum(n_expected) OVER () AS e, n_actual / sum(n_actual) OVER () AS a FROM n)
SELECT bin, n_expected, n_actual, round(e, 6) AS expected, round(a, 6) AS actual, round({psi_parts('e', 'a')}, 6) AS part FROM s""")
def score_psi_train_oot(spark, sf_dir):
    x = sample(spark, sf_dir)
    return rounded(stability.score_psi_bins(x, "score", F.col("data_flag") == "train", F.col("data_flag") == "oot"))


_var_psi = " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, round(greatest(sum({psi_parts('e', 'a')}), 0), 6) AS psi FROM (
  SELECT count(*) FILTER (data_flag = 'train') / sum(count(*) FILTER (data_flag = 'train')) OVER () AS e,
         count(*) FILTER (data_flag = 'oot') / sum(count(*) FILTER (data_flag = 'oot')) OVER () AS a
  FROM (SELECT {bin_sql(f, 'e')} AS bin, data_flag FROM sample, (SELECT {edges_sql(f, f"data_flag = 'train' AND {f} IS NOT NULL", 10)} AS e) WHERE data_flag IN ('train', 'oot') AND {f} IS NOT NULL) GROUP BY bin)"""
    for f in FEATURES
)


@query("var_psi_all", f"WITH {SAMPLE_SQL} {_var_psi}")
def var_psi_all(spark, sf_dir):
    return rounded(stability.variable_psi(sample(spark, sf_dir), FEATURES, F.col("data_flag") == "train", F.col("data_flag") == "oot"))


@query("psi_equal_width", f"""WITH {SAMPLE_SQL}, r AS (SELECT min(score) AS a, max(score) AS b FROM sample WHERE data_flag IN ('train', 'test', 'oot')),
g AS (SELECT CAST(i AS INTEGER) AS bin, CASE WHEN i = 0 THEN a - 0.001 * (b - a) ELSE a + (b - a) * i / 10 END AS low, CASE WHEN i = 9 THEN b ELSE a + (b - a) * (i + 1) / 10 END AS high FROM r, range(10) t(i)),
n AS (SELECT bin, round(low, 4) AS low, round(high, 4) AS high, count(*) FILTER (data_flag IN ('train', 'test')) AS n_expected, count(*) FILTER (data_flag = 'oot') AS n_actual
  FROM g JOIN sample ON score > g.low AND score <= g.high WHERE data_flag IN ('train', 'test', 'oot') GROUP BY ALL),
s AS (SELECT *, n_expected / sum(n_expected) OVER () AS e, n_actual / sum(n_actual) OVER () AS a FROM n)
SELECT bin, low, high, n_expected, n_actual, round(e, 4) AS expected, round(a, 4) AS actual, round((a - e) * ln((a + 1e-10) / (e + 1e-10)), 4) AS part FROM s""")
def psi_equal_width(spark, sf_dir):
    flag = F.col("data_flag")
    return rounded(stability.equal_width_psi(sample(spark, sf_dir), "score", flag.isin("train", "test"), flag == "oot"), 4)


@query("psi_fitted_bins", f"""WITH {SAMPLE_SQL}, b AS (SELECT coalesce(CAST(CASE WHEN f_tax IS NOT NULL THEN (f_tax > 0.02)::INT + (f_tax > 0.04)::INT + (f_tax > 0.06)::INT END AS VARCHAR), 'null') AS bin, data_flag FROM sample),
n AS (SELECT bin, count(*) FILTER (data_flag = 'train') / sum(count(*) FILTER (data_flag = 'train')) OVER () AS a, count(*) FILTER (data_flag = 'oot') / sum(count(*) FILTER (data_flag = 'oot')) OVER () AS e FROM b GROUP BY bin),
p AS (SELECT bin, a AS train, e AS other, {psi_parts('e', 'a')} AS psi FROM n)
SELECT bin, round(train, 6) AS train, round(other, 6) AS other, round(psi, 6) AS psi FROM (SELECT * FROM p UNION ALL SELECT 'TOTAL', sum(train), sum(other), sum(psi) FROM p)""")
def psi_fitted_bins(spark, sf_dir):
    x = sample(spark, sf_dir)
    return rounded(stability.fitted_psi(x.where("data_flag = 'train'"), x.where("data_flag = 'oot'"), "f_tax", [0.02, 0.04, 0.06]))


def binned_sql(by: str, counts: str, own: str) -> str:
    """binned() over a relation of by, bin, good, bad."""
    part = f"PARTITION BY {by}" if by else ""
    keys = f"{by}, " if by else ""
    return f"""SELECT {keys}bin, bad AS bads, good AS goods, good + bad AS total, round(bad / (good + bad), 4) AS bad_rate, round(cb / (cb + cg), 4) AS cum_bad_rate,
  round(CASE WHEN tb > 0 THEN cb / tb ELSE 0 END, 4) AS cum_bads_prop, round(CASE WHEN tb > 0 AND tg > 0 THEN abs(cb / tb - cg / tg) ELSE 0 END, 4) AS ks,
  round(CASE WHEN tb > 0 THEN bad / (good + bad) / (tb / (tb + tg)) ELSE 0 END, 4) AS lift, round(CASE WHEN tb > 0 THEN cb / (cb + cg) / (tb / (tb + tg)) ELSE 0 END, 4) AS cum_lift
  FROM (SELECT *, sum(good) OVER ({part} ORDER BY bin) AS cg, sum(bad) OVER ({part} ORDER BY bin) AS cb, sum(good) OVER ({part}) AS tg, sum(bad) OVER ({part}) AS tb FROM {counts}) {own}"""


@query("decile_performance", f"""WITH {SAMPLE_SQL}, q AS (SELECT {edges_sql('score', 'TRUE', 10)} AS e),
n AS (SELECT data_flag, CAST({bin_sql('score', 'e')} AS INTEGER) AS bin, count(*) FILTER (bad = 0) AS good, count(*) FILTER (bad = 1) AS bad FROM sample, q GROUP BY 1, 2) {binned_sql('data_flag', 'n', '')}""")
def decile_performance(spark, sf_dir):
    return performance.bin_metrics(sample(spark, sf_dir), "score", "bad", 10, ["data_flag"], least=20)


@query("decile_by_month", f"""WITH {SAMPLE_SQL}, q AS (SELECT {edges_sql('score', 'TRUE', 10)} AS e), big AS (SELECT month FROM sample GROUP BY 1 HAVING count(*) >= 20),
n AS (SELECT month, CAST({bin_sql('score', 'e')} AS INTEGER) AS bin, count(*) FILTER (bad = 0) AS good, count(*) FILTER (bad = 1) AS bad FROM sample JOIN big USING (month), q GROUP BY 1, 2) {binned_sql('month', 'n', '')}""")
def decile_by_month(spark, sf_dir):
    return performance.bin_metrics(sample(spark, sf_dir), "score", "bad", 10, ["month"], least=20)


@query("binned_ks", f"""WITH {SAMPLE_SQL}, q AS (SELECT {edges_sql('f_price', 'TRUE', 10)} AS e),
n AS (SELECT CAST({bin_sql('f_price', 'e')} AS INTEGER) AS bin, count(*) FILTER (bad = 0) AS good, count(*) FILTER (bad = 1) AS bad FROM sample, q GROUP BY 1)
SELECT bin, good, bad, round(cg, 6) AS cum_good, round(cb, 6) AS cum_bad, round(abs(cb - cg), 6) AS ks FROM (
  SELECT *, sum(good) OVER (ORDER BY bin) / sum(good) OVER () AS cg, sum(bad) OVER (ORDER BY bin) / sum(bad) OVER () AS cb FROM n)""")
def binned_ks(spark, sf_dir):
    return rounded(woe.binned_ks(sample(spark, sf_dir), "f_price", "bad"))


_GONE = "(value IS NULL OR isnan(value) OR value <= -99999)"


@query("ks_two_sample", f"""WITH {SAMPLE_SQL}, u AS ({unpivoted(FEATURES)}),
t AS (SELECT feature, value, count(*) FILTER (bad = 0) AS g, count(*) FILTER (bad = 1) AS b FROM u WHERE NOT {_GONE} GROUP BY 1, 2),
c AS (SELECT *, sum(g) OVER w AS cg, sum(b) OVER w AS cb, sum(g) OVER (PARTITION BY feature) AS tg, sum(b) OVER (PARTITION BY feature) AS tb FROM t WINDOW w AS (PARTITION BY feature ORDER BY value)),
k AS (SELECT feature, max(abs(cb / tb - cg / tg)) AS ks, CAST(max(tg) AS BIGINT) AS goods, CAST(max(tb) AS BIGINT) AS bads FROM c GROUP BY 1),
m AS (SELECT feature, avg({_GONE}::INT) AS missing_rate FROM u GROUP BY 1)
SELECT feature, round(ks, 6) AS ks, goods, bads, round(missing_rate, 6) AS missing_rate FROM m JOIN k USING (feature)""")
def ks_two_sample(spark, sf_dir):
    return rounded(woe.two_sample_ks(sample(spark, sf_dir), FEATURES, "bad").drop("at"))


_WOE = """round(bad / (good + bad), 4) AS bad_rate, round(ln(greatest(bad / tb, 1e-10) / greatest(good / tg, 1e-10)), 4) AS woe,
  round((bad / tb - good / tg) * ln(greatest(bad / tb, 1e-10) / greatest(good / tg, 1e-10)), 4) AS iv, round(abs(bad / tb - good / tg), 4) AS ks, round(bad / (good + bad) / (tb / (tb + tg)), 4) AS lift"""


@query("woe_categorical", f"""WITH {SAMPLE_SQL}, n AS (SELECT CAST(month % 100 AS VARCHAR) AS bin, count(*) FILTER (bad = 0) AS good, count(*) FILTER (bad = 1) AS bad FROM sample GROUP BY 1),
w AS (SELECT bin, good, bad, good + bad AS total, good / tg AS good_prop, bad / tb AS bad_prop, {_WOE} FROM (SELECT *, sum(good) OVER () AS tg, sum(bad) OVER () AS tb FROM n)),
a AS (SELECT *, row_number() OVER (ORDER BY bad_rate DESC, bin) AS place FROM w)
SELECT bin, good, bad, total, round(good_prop, 6) AS good_prop, round(bad_prop, 6) AS bad_prop, bad_rate, woe, iv, ks, lift, CAST(place AS INTEGER) AS place FROM a
UNION ALL SELECT 'ALL', CAST(sum(good) AS BIGINT), CAST(sum(bad) AS BIGINT), CAST(sum(total) AS BIGINT), 1.0, 1.0, round(sum(bad) / sum(total), 6), 0.0, round(sum(iv), 6), 0.0, 1.0, CAST(max(place) + 1 AS INTEGER) FROM a""")
def woe_categorical(spark, sf_dir):
    x = sample(spark, sf_dir).withColumn("m", F.col("month") % 100)
    return rounded(woe.categorical_table(x, "m", "bad"))


_woe_quantile = " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, CAST({bin_sql(f, 'e')} AS INTEGER) AS bin, count(*) FILTER (bad = 0) AS good, count(*) FILTER (bad = 1) AS bad
  FROM sample, (SELECT {edges_sql(f, f"{f} > -99999", 5)} AS e) WHERE {f} > -99999 GROUP BY 2""" for f in FEATURES
)


@query("woe_quantile", f"""WITH {SAMPLE_SQL}, n AS ({_woe_quantile}), t AS (SELECT count(*) FILTER (bad = 0) AS tg, count(*) FILTER (bad = 1) AS tb FROM sample)
SELECT feature, bin, good, bad, good + bad AS total, round(good / tg, 6) AS good_prop, round(bad / tb, 6) AS bad_prop, {_WOE} FROM n, t""")
def woe_quantile(spark, sf_dir):
    return rounded(woe.quantile_table(sample(spark, sf_dir), FEATURES, "bad", 5))


def iv_sql(source: str = "sample") -> str:
    """feature, good, bad of ten quantile bins and of missing values."""
    return " UNION ALL ".join(
        f"""SELECT '{f}' AS feature, count(*) FILTER (bad = 0) AS good, count(*) FILTER (bad = 1) AS bad FROM {source}, (SELECT {edges_sql(f, f"{f} > -99999", 10, source)} AS e)
  GROUP BY CASE WHEN {f} > -99999 THEN {bin_sql(f, 'e')} ELSE -1 END""" for f in FEATURES
    )


_iv = iv_sql()


@query("iv_all_features", f"""WITH {SAMPLE_SQL}, n AS ({_iv}), t AS (SELECT count(*) FILTER (bad = 0) AS tg, count(*) FILTER (bad = 1) AS tb FROM sample)
SELECT feature, round(sum((bad / tb - good / tg) * ln(greatest(bad / tb, 1e-10) / greatest(good / tg, 1e-10))), 6) AS iv FROM n, t GROUP BY 1""")
def iv_all_features(spark, sf_dir):
    return rounded(woe.information_value(sample(spark, sf_dir), FEATURES, "bad"))


@query("woe_binner", f"""WITH {SAMPLE_SQL}, n AS (SELECT CAST((f_quantity > 10)::INT + (f_quantity > 20)::INT + (f_quantity > 30)::INT + (f_quantity > 40)::INT AS INTEGER) AS bin,
  sum(CASE WHEN bad = 0 THEN amount ELSE 0 END) AS good, sum(CASE WHEN bad = 1 THEN amount ELSE 0 END) AS bad FROM sample GROUP BY 1),
s AS (SELECT *, good + bad AS total, good / sum(good) OVER () AS pg, bad / sum(bad) OVER () AS pb, sum(bad) OVER () / sum(good + bad) OVER () AS o, (good + bad) / sum(good + bad) OVER () AS pt FROM n)
SELECT bin, round(good, 4) AS good, round(bad, 4) AS bad, round(total, 4) AS total, round(pg, 4) AS pct_good, round(pb, 4) AS pct_bad, round(pt, 4) AS pct_total, round(ln(pg / pb), 4) AS woe,
  round((pg - pb) * ln(pg / pb), 4) AS iv, round(bad / total, 4) AS bad_rate, round(bad / total / o, 4) AS lift, round(max(pt) OVER (), 4) AS max_share FROM s""")
def woe_binner(spark, sf_dir):
    x = sample(spark, sf_dir).withColumn("b", binning.right_closed("f_quantity", [10.0, 20.0, 30.0, 40.0]))
    return rounded(woe.binner_table(x, "b", "bad", "amount"), 4)


@query("woe_monotonic")
def woe_monotonic(spark, sf_dir):
    """Merging is iterative; tests hold it against a plain pandas version."""
    return woe.monotonic_table(sample(spark, sf_dir), FEATURES, "bad")


@query("micro_bins", f"""WITH {SAMPLE_SQL}, q AS (SELECT list_sort(list_distinct(quantile_cont(f_price, [{', '.join(str(k / 20) for k in range(1, 20))}]))) AS e FROM sample)
SELECT 'f_price' AS feature, CAST(len(list_filter(e, lambda x: f_price >= x)) AS INTEGER) AS idx, count(*) FILTER (bad = 0) AS good, count(*) FILTER (bad = 1) AS bad FROM sample, q GROUP BY 2""")
def micro_bins(spark, sf_dir):
    return binning.micro_bins(sample(spark, sf_dir), ["f_price"], "bad").select("feature", "idx", "good", "bad")


@query("coarse_bins")
def coarse_bins(spark, sf_dir):
    """feature, low, high of bins whose edges are turns of the convex hull of cumulative shares of 20 fine bins."""
    x = sample(spark, sf_dir)
    out = []
    edges = binning.fine_edges(x.where(~missing(F.col("f_discount"))), ["f_price", "f_quantity"])
    for f, e in edges.items():
        placed = x.where(F.col(f).isNotNull()).withColumn("b", binning.right_closed(f, e[1:-1]))
        counts = {r.b: (r.g, r.d) for r in placed.groupBy("b").agg(F.sum((F.col("bad") == 0).cast("long")).alias("g"), F.sum("bad").alias("d")).collect()}
        own = [counts.get(i, (0, 0)) for i in range(len(e) - 1)]
        coarse = binning.hull_edges(e, [g for g, _ in own], [d for _, d in own])
        out += [(f, a, b) for a, b in zip(coarse, coarse[1:], strict=False)]
    return spark.createDataFrame(out, "feature string, low double, high double")


@query("modelling_summary", f"""WITH {SAMPLE_SQL}, x AS (SELECT data_flag, count(*) AS total, CAST(sum(bad) AS BIGINT) AS bad FROM sample GROUP BY 1)
SELECT data_flag, total, bad, total - bad AS good, round(bad / total, 6) AS bad_rate FROM (SELECT * FROM x UNION ALL SELECT 'total', CAST(sum(total) AS BIGINT), CAST(sum(bad) AS BIGINT) FROM x)""")
def modelling_summary(spark, sf_dir):
    x = sample(spark, sf_dir).groupBy("data_flag").agg(F.count("*").alias("total"), F.sum(F.col("bad").cast("long")).alias("bad"))
    x = x.unionByName(x.agg(F.lit("total").alias("data_flag"), F.sum("total").alias("total"), F.sum("bad").alias("bad")))
    return rounded(x.select("data_flag", "total", "bad", (F.col("total") - F.col("bad")).alias("good"), (F.col("bad") / F.col("total")).alias("bad_rate")))


@query("partition_distribution", f"""WITH {SAMPLE_SQL}, n AS (SELECT month, data_flag, count(*) AS total, CAST(sum(bad) AS BIGINT) AS bad FROM sample GROUP BY 1, 2),
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY month ORDER BY total DESC, data_flag) AS r FROM n) WHERE r = 1)
SELECT CAST(month AS VARCHAR) AS month, data_flag, total, bad, round(bad / total, 6) AS bad_rate FROM d
UNION ALL SELECT 'total', '', CAST(sum(total) AS BIGINT), CAST(sum(bad) AS BIGINT), round(sum(bad) / sum(total), 6) FROM d""")
def partition_distribution(spark, sf_dir):
    """Each month's dominant flag, its rows only, and a total row."""
    n = sample(spark, sf_dir).groupBy("month", "data_flag").agg(F.count("*").alias("total"), F.sum(F.col("bad").cast("long")).alias("bad"))
    w = Window.partitionBy("month").orderBy(F.desc("total"), "data_flag")
    d = n.withColumn("r", F.row_number().over(w)).where("r = 1").select(F.col("month").cast("string").alias("month"), "data_flag", "total", "bad")
    d = d.unionByName(d.agg(F.lit("total").alias("month"), F.lit("").alias("data_flag"), F.sum("total").alias("total"), F.sum("bad").alias("bad")))
    return rounded(d.withColumn("bad_rate", F.col("bad") / F.col("total")))


_missing = " UNION ALL ".join(f"SELECT '{f}' AS feature, count(*) AS n, CAST(coalesce(sum(({f} IS NULL OR {f} <= -99999)::INT), 0) AS BIGINT) AS missing FROM sample" for f in FEATURES)


@query("missing_rate", f"WITH {SAMPLE_SQL} SELECT feature, n, missing, round_even(missing / n, 6) AS missing_rate FROM ({_missing})")
def missing_rate(spark, sf_dir):
    return quality.missing_summary(sample(spark, sf_dir), FEATURES)


@query("feature_filter", f"""WITH {SAMPLE_SQL}, m AS (SELECT feature, missing / n AS missing_rate FROM ({_missing})), p AS ({_var_psi}), n AS ({_iv}),
t AS (SELECT count(*) FILTER (bad = 0) AS tg, count(*) FILTER (bad = 1) AS tb FROM sample),
i AS (SELECT feature, sum((bad / tb - good / tg) * ln(greatest(bad / tb, 1e-10) / greatest(good / tg, 1e-10))) AS iv FROM n, t GROUP BY 1)
SELECT feature, round(missing_rate, 6) AS missing_rate, round(iv, 6) AS iv, round(psi, 6) AS psi FROM m JOIN p USING (feature) JOIN i USING (feature) WHERE missing_rate <= 0.05 AND iv >= 0 AND psi <= 1""")
def feature_filter(spark, sf_dir):
    x = sample(spark, sf_dir)
    psi = stability.variable_psi(x, FEATURES, F.col("data_flag") == "train", F.col("data_flag") == "oot")
    stats = quality.missing_summary(x, FEATURES).select("feature", "missing_rate").join(woe.information_value(x, FEATURES, "bad"), "feature").join(psi, "feature")
    return rounded(quality.feature_filter(stats, 0.05, 0, 1))


@query("variable_overview", f"""WITH {SAMPLE_SQL}, train AS (SELECT * FROM sample WHERE data_flag = 'train'), u AS ({unpivoted(FEATURES, 'train')}), p AS ({_var_psi}), n AS ({iv_sql('train')}),
t AS (SELECT count(*) FILTER (bad = 0) AS tg, count(*) FILTER (bad = 1) AS tb FROM train),
i AS (SELECT feature, sum((bad / tb - good / tg) * ln(greatest(bad / tb, 1e-10) / greatest(good / tg, 1e-10))) AS iv FROM n, t GROUP BY 1),
x AS (SELECT feature, value, count(*) FILTER (bad = 0) AS g, count(*) FILTER (bad = 1) AS b FROM u WHERE NOT {_GONE} GROUP BY 1, 2),
c AS (SELECT *, sum(g) OVER w AS cg, sum(b) OVER w AS cb, sum(g) OVER (PARTITION BY feature) AS tg, sum(b) OVER (PARTITION BY feature) AS tb FROM x WINDOW w AS (PARTITION BY feature ORDER BY value)),
k AS (SELECT feature, max(abs(cb / tb - cg / tg)) AS ks FROM c GROUP BY 1), m AS (SELECT feature, avg({_GONE}::INT) AS missing_rate FROM u GROUP BY 1)
SELECT feature, round(missing_rate, 6) AS missing_rate, round(iv, 6) AS iv, round(ks, 6) AS ks, psi FROM m JOIN i USING (feature) JOIN k USING (feature) JOIN p USING (feature)""")
def variable_overview(spark, sf_dir):
    """feature, missing_rate, iv, ks, psi, ordered by iv."""
    x = sample(spark, sf_dir)
    train = x.where("data_flag = 'train'")
    psi = stability.variable_psi(x, FEATURES, F.col("data_flag") == "train", F.col("data_flag") == "oot")
    out = quality.missing_summary(train, FEATURES).select("feature", "missing_rate")
    for part in (woe.information_value(train, FEATURES, "bad"), woe.two_sample_ks(train, FEATURES, "bad").select("feature", "ks"), psi):
        out = out.join(part, "feature")
    return rounded(out).orderBy(F.desc("iv"), "feature")


@query("monthly_coverage", f"""WITH {SAMPLE_SQL}, u AS ({unpivoted(FEATURES, keep='month')})
SELECT month, count(*) AS n, feature, CAST(sum((value IS NOT NULL AND value <> -999999)::INT) AS BIGINT) AS filled, round(avg((value IS NOT NULL AND value <> -999999)::INT), 4) AS coverage FROM u GROUP BY month, feature""")
def monthly_coverage(spark, sf_dir):
    return quality.coverage(sample(spark, sf_dir), "month", FEATURES)


@query("amount_metrics", f"""WITH {SAMPLE_SQL}, q AS (SELECT {edges_sql('score', 'TRUE', 20)} AS e),
n AS (SELECT CAST({bin_sql('score', 'e')} AS INTEGER) AS bin, count(*) AS cnt, CAST(sum(bad) AS BIGINT) AS bad_cnt, sum(amount) AS l, sum(CASE WHEN bad = 1 THEN overdue ELSE 0 END) AS o FROM sample, q GROUP BY 1),
c AS (SELECT *, sum(cnt) OVER () AS tc, sum(bad_cnt) OVER () AS tb, sum(l) OVER () AS tl, sum(o) OVER () AS tao, sum(cnt) OVER w AS cc, sum(bad_cnt) OVER w AS cb, sum(l) OVER w AS cl, sum(o) OVER w AS co FROM n WINDOW w AS (ORDER BY bin))
SELECT bin, cnt, bad_cnt, round(bad_cnt / tb, 6) AS bad_share, round(cb / tb, 6) AS cum_bad_share, round(bad_cnt / cnt, 6) AS bad_rate, round(cb / cc, 6) AS cum_bad_rate,
  round(bad_cnt / cnt / (tb / tc), 6) AS bad_lift, round(cb / cc / (tb / tc), 6) AS cum_bad_lift, round(l / tl, 6) AS loan_share, round(o / tao, 6) AS overdue_share, round(co / tao, 6) AS cum_overdue_share,
  round(o / l, 6) AS amount_rate, round(co / cl, 6) AS cum_amount_rate, round(o / l / (tao / tl), 6) AS amount_lift, round(co / cl / (tao / tl), 6) AS cum_amount_lift FROM c""")
def amount_metrics(spark, sf_dir):
    return rounded(performance.amount_metrics(sample(spark, sf_dir), "score", "bad", "overdue", "amount", 20))


@query("cross_bins", f"""WITH {SAMPLE_SQL}, q AS (SELECT {edges_sql('score', 'TRUE', 10)} AS e), q2 AS (SELECT {edges_sql('score2', 'TRUE', 10)} AS e2),
n AS (SELECT CAST({bin_sql('score', 'e')} AS INTEGER) AS new_bin, CAST({bin_sql('score2', 'e2')} AS INTEGER) AS old_bin, count(*) AS n, CAST(sum(bad) AS BIGINT) AS bads, sum(amount) AS l, sum(overdue) AS o FROM sample, q, q2 GROUP BY 1, 2),
t AS (SELECT *, sum(bads) OVER () / sum(n) OVER () AS r, sum(o) OVER () / sum(l) OVER () AS ar FROM n)
SELECT new_bin, round(e[new_bin + 1], 4) AS new_low, round(e[new_bin + 2], 4) AS new_high, old_bin, round(e2[old_bin + 1], 4) AS old_low, round(e2[old_bin + 2], 4) AS old_high, n, bads,
  round(bads / n, 4) AS bad_rate, round(bads / n / r, 4) AS lift, round(o / l, 4) AS amount_rate, round(o / l / ar, 4) AS amount_lift FROM t, q, q2""")
def cross_bins(spark, sf_dir):
    return rounded(performance.crossed(sample(spark, sf_dir), "score", "score2", "bad", "overdue", "amount", 10), 4)


_SEG = """SELECT CAST(floor(score / 20000) AS INTEGER) AS segment, min(score) AS low, max(score) AS high, count(*) FILTER (bad = 0) AS good, count(*) FILTER (bad = 1) AS bad FROM sample GROUP BY 1"""
_SEGMENTS = f"""n AS ({_SEG}), c AS (SELECT *, sum(good) OVER () AS tg, sum(bad) OVER () AS tb, sum(good) OVER w AS cg, sum(bad) OVER w AS cb FROM n WINDOW w AS (ORDER BY low, segment)),
r AS (SELECT *, round(cg / tg, 4) AS cum_good, round(cb / tb, 4) AS cum_bad FROM c),
g AS (SELECT *, coalesce(lag(cum_good) OVER (ORDER BY low, segment), 0) AS lg, coalesce(lag(cum_bad) OVER (ORDER BY low, segment), 0) AS lb FROM r),
seg AS (SELECT segment, low, high, good + bad AS n, good, bad, round(good / tg, 4) AS good_share, cum_good, round(bad / tb, 4) AS bad_share, cum_bad, round(bad / (good + bad), 4) AS bad_rate,
  round(cb / (cb + cg), 4) AS cum_bad_rate, round((cb + cg) / (tb + tg), 3) AS cum_total, round(abs(cb / tb - cg / tg), 4) AS ks, round(bad / (good + bad) / (tb / (tb + tg)), 1) AS lift,
  round(cb / (cb + cg) / (tb / (tb + tg)), 1) AS cum_lift, round(CASE WHEN bad > 0 THEN good / bad ELSE 0 END, 1) AS odds, round((good + bad) / (tg + tb), 3) AS share,
  (cum_good - lg) * (cum_bad + lb) / 2 AS auc_part, (cum_bad - lb) * (cum_good + lg) / 2 AS gini_part FROM g)"""


def _segmented(spark, sf_dir):
    x = sample(spark, sf_dir).withColumn("seg", F.floor(F.col("score") / 20000).cast("int"))
    return performance.segments(x, "seg", "score", "bad")


@query("segment_report", f"WITH {SAMPLE_SQL}, {_SEGMENTS} SELECT * REPLACE (round(auc_part, 6) AS auc_part, round(gini_part, 6) AS gini_part) FROM seg")
def segment_report(spark, sf_dir):
    return rounded(_segmented(spark, sf_dir))


@query("segment_gini", f"""WITH {SAMPLE_SQL}, {_SEGMENTS} SELECT CAST(sum(n) AS BIGINT) AS n, CAST(sum(good) AS BIGINT) AS good, CAST(sum(bad) AS BIGINT) AS bad, round(sum(bad) / sum(n), 4) AS bad_rate, max(ks) AS ks,
  round(sum(auc_part), 4) AS auc, round(abs(1 - 2 * sum(gini_part)), 4) AS gini FROM seg""")
def segment_gini(spark, sf_dir):
    return performance.segment_totals(_segmented(spark, sf_dir))


@query("risk_division", f"WITH {SAMPLE_SQL}, {_SEGMENTS} SELECT segment, n, bad, bad_rate, share, lift FROM seg")
def risk_division(spark, sf_dir):
    return performance.risk_division(_segmented(spark, sf_dir))


@query("risk_classes", f"""WITH RECURSIVE {SAMPLE_SQL}, q AS (SELECT {edges_sql('score', 'TRUE', 100)} AS e), p AS (SELECT {bin_sql('score', 'e')} AS bin, score, bad FROM sample, q),
b AS (SELECT bin, count(*) AS n, row_number() OVER (ORDER BY bin) AS i FROM p GROUP BY 1), whole AS (SELECT CAST(sum(n) AS BIGINT) AS n FROM b),
raw AS (SELECT n, list_transform([0.3::DOUBLE, 0.2, 0.4, 0.08, 0.02], lambda s: CAST(round_even(s * n, 0) AS BIGINT)) AS sizes FROM whole),
sized AS (SELECT list_transform(sizes, lambda s, k: s + CASE WHEN n - list_sum(sizes) >= 6 - k THEN 1 WHEN list_sum(sizes) - n >= 6 - k THEN -1 ELSE 0 END) AS sizes FROM raw),
walk AS (SELECT CAST(0 AS BIGINT) AS i, 5 AS level, CAST(0 AS BIGINT) AS held UNION ALL
  SELECT b.i, CASE WHEN level > 1 AND held >= sizes[level] THEN level - 1 ELSE level END, CASE WHEN level > 1 AND held >= sizes[level] THEN 0 ELSE held END + b.n FROM walk JOIN b ON b.i = walk.i + 1, sized),
c AS (SELECT ['A', 'B', 'C', 'D', 'E'][level] AS class, score, bad FROM p JOIN b USING (bin) JOIN walk USING (i))
SELECT class, min(score) AS low, max(score) AS high, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 3) AS share, CAST(sum(bad) AS BIGINT) AS bad, round(avg(bad), 4) AS bad_rate FROM c GROUP BY class""")
def risk_classes(spark, sf_dir):
    return performance.risk_classes(sample(spark, sf_dir), "score", "bad")


def _set_psi(base: str, group: str = "data_flag") -> str:
    return f"""(SELECT {group}, greatest(sum({psi_parts('x', 'y')}), 0) AS psi FROM (SELECT f.{group}, coalesce(b.c, 0) / (SELECT count(*) FROM sample WHERE {base}) AS x, coalesce(a.c, 0) / f.c AS y
  FROM (SELECT {group}, count(*) AS c FROM sample GROUP BY 1) f CROSS JOIN range(10) r(i)
  LEFT JOIN (SELECT {group}, {bin_sql('score', 'e')} AS bin, count(*) AS c FROM sample, (SELECT {edges_sql('score', base, 10)} AS e) GROUP BY 1, 2) a ON a.{group} = f.{group} AND a.bin = i
  LEFT JOIN (SELECT {bin_sql('score', 'e')} AS bin, count(*) AS c FROM sample, (SELECT {edges_sql('score', base, 10)} AS e) WHERE {base} GROUP BY 1) b ON b.bin = i) GROUP BY 1)"""


@query("sample_effect", f"""WITH {SAMPLE_SQL}, {auc_ks_sql('data_flag')}, l AS ({lift_sql('data_flag', 'sample')}), n AS (SELECT data_flag, count(*) AS n, CAST(sum(bad) AS BIGINT) AS bad FROM sample GROUP BY 1)
SELECT n.data_flag, n.n, n.bad, round(n.bad / n.n, 4) AS bad_rate, round(auc, 6) AS auc, round(ks, 6) AS ks, lift_10, lift_5, lift_2, lift_1,
  round(p.psi, 6) AS psi_train, round(o.psi, 6) AS psi_oot FROM n LEFT JOIN curve ON g = n.data_flag LEFT JOIN l ON l.month = n.data_flag
  LEFT JOIN {_set_psi("data_flag = 'train'")} p ON p.data_flag = n.data_flag LEFT JOIN {_set_psi("data_flag = 'oot'")} o ON o.data_flag = n.data_flag""")
def sample_effect(spark, sf_dir):
    x = sample(spark, sf_dir)
    return rounded(performance.set_effects(x, "data_flag", "score", "bad", F.col("data_flag") == "train", F.col("data_flag") == "oot"), 6)


@query("backtest_effect", f"""WITH {SAMPLE_SQL}, {auc_ks_sql('month')}, l AS ({lift_sql('month', 'sample')}), n AS (SELECT month, count(*) AS n, CAST(sum(bad) AS BIGINT) AS bad FROM sample GROUP BY 1)
SELECT n.month, n.n, n.bad, round(n.bad / n.n, 4) AS bad_rate, round(auc, 6) AS auc, round(ks, 6) AS ks, lift_10, lift_5, lift_2, lift_1,
  round(p.psi, 6) AS psi_train, round(o.psi, 6) AS psi_oot FROM n LEFT JOIN curve ON g = n.month LEFT JOIN l ON l.month = n.month
  LEFT JOIN {_set_psi("month = (SELECT min(month) FROM sample)", "month")} p ON p.month = n.month LEFT JOIN {_set_psi("month = (SELECT max(month) FROM sample)", "month")} o ON o.month = n.month""")
def backtest_effect(spark, sf_dir):
    """By month: counts, rates, AUC, KS, lift, and PSI against the first and the last month."""
    x = sample(spark, sf_dir)
    r = x.agg(F.min("month").alias("a"), F.max("month").alias("b")).first()
    return rounded(performance.set_effects(x, "month", "score", "bad", F.col("month") == (r.a or 0), F.col("month") == (r.b or 0)), 6)


@query("date_range", f"WITH {SAMPLE_SQL} SELECT data_flag, min(month) || '-' || max(month) AS range FROM sample GROUP BY 1")
def date_range(spark, sf_dir):
    return sample(spark, sf_dir).groupBy("data_flag").agg(F.concat(F.min("month").cast("string"), F.lit("-"), F.max("month").cast("string")).alias("range"))


@query("toxicity_by_language", """WITH n AS (SELECT lang AS bin, count(*) FILTER (toxic = 0) AS good, count(*) FILTER (toxic = 1) AS bad FROM documents JOIN labels USING (doc_id) GROUP BY 1)
SELECT bin, good, bad, round(bad / (good + bad), 4) AS bad_rate FROM n""")
def toxicity_by_language(spark, sf_dir):
    x = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id")
    return woe.categorical_table(x, "lang", "toxic").where("bin <> 'ALL'").select("bin", "good", "bad", "bad_rate")
