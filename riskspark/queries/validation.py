"""Checks of an output table against its sample."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality
from .common import FEATURES, SAMPLE_SQL, query, rounded, sample

_GONE = "({0} IS NULL OR {0} = -999999)"


@query("quality_sample_count", f"""WITH {SAMPLE_SQL}, a AS (SELECT month, count(*) AS sample_cnt FROM sample WHERE month < 200106 GROUP BY 1),
b AS (SELECT month, count(*) AS output_cnt FROM sample WHERE line <> 3 AND month > 199502 GROUP BY 1)
SELECT month, sample_cnt, output_cnt, coalesce(output_cnt, 0) - coalesce(sample_cnt, 0) AS diff_cnt, round((coalesce(output_cnt, 0) - coalesce(sample_cnt, 0)) * 100 / sample_cnt, 4) AS diff_pct
FROM a FULL JOIN b USING (month)""")
def quality_sample_count(spark, sf_dir):
    x = sample(spark, sf_dir)
    return quality.sample_count(x.where("month < 200106"), x.where("line <> 3 AND month > 199502"), "month")


@query("quality_missing", f"""WITH {SAMPLE_SQL} SELECT month, count(*) AS total_cnt,
{', '.join(f"round(avg({_GONE.format(f)}::INT) * 100, 4) AS {f}_missing_pct" for f in FEATURES)} FROM sample GROUP BY 1""")
def quality_missing(spark, sf_dir):
    return quality.missing_rates(sample(spark, sf_dir), "month", FEATURES)


@query("quality_high_missing", f"""WITH {SAMPLE_SQL}, m AS ({' UNION ALL '.join(f"SELECT '{f}' AS variable_name, count(*) AS total_cnt, CAST(sum({_GONE.format(f)}::INT) AS BIGINT) AS null_cnt FROM sample" for f in FEATURES)})
SELECT *, round(null_cnt * 100 / total_cnt, 4) AS missing_pct FROM m WHERE round(null_cnt * 100 / total_cnt, 4) >= 5""")
def quality_high_missing(spark, sf_dir):
    return quality.high_missing(sample(spark, sf_dir), FEATURES, 5.0)


_DIST = ", ".join(
    f"round(avg({f}), 6) AS {f}_avg, round(stddev_pop({f}), 6) AS {f}_std, min({f}) AS {f}_min, max({f}) AS {f}_max, round(median({f}), 6) AS {f}_median" for f in ("f_quantity", "f_price", "f_tax")
)


@query("quality_distribution", f"WITH {SAMPLE_SQL} SELECT month, count(*) AS cnt, {_DIST} FROM sample GROUP BY 1")
def quality_distribution(spark, sf_dir):
    return quality.distribution(sample(spark, sf_dir), "month", ["f_quantity", "f_price", "f_tax"])


@query("quality_month_over_month", f"""WITH {SAMPLE_SQL}, a AS (SELECT month, round(avg(f_quantity), 6) AS q, round(avg(f_price), 6) AS p FROM sample GROUP BY 1)
SELECT month, q AS f_quantity_avg, round((q - lag(q) OVER w) * 100 / lag(q) OVER w, 4) AS f_quantity_mom_pct, p AS f_price_avg, round((p - lag(p) OVER w) * 100 / lag(p) OVER w, 4) AS f_price_mom_pct
FROM a WINDOW w AS (ORDER BY month)""")
def quality_month_over_month(spark, sf_dir):
    return quality.month_over_month(sample(spark, sf_dir), "month", ["f_quantity", "f_price"])


@query("quality_key_unique", f"""WITH {SAMPLE_SQL}, k AS (SELECT key, line, count(*) AS n FROM sample GROUP BY 1, 2)
SELECT 'total_cnt' AS metric, CAST(sum(n) AS BIGINT) AS value FROM k UNION ALL SELECT 'distinct_cnt', count(*) FROM k UNION ALL SELECT 'duplicate_keys', count(*) FROM k WHERE n > 1""")
def quality_key_unique(spark, sf_dir):
    return quality.key_uniqueness(sample(spark, sf_dir), ["key", "line"])


@query("quality_duplicate_keys", f"WITH {SAMPLE_SQL} SELECT key, line, count(*) AS n FROM sample GROUP BY 1, 2 HAVING count(*) > 1")
def quality_duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(sample(spark, sf_dir), ["key", "line"])


_SCORED = "scored AS (SELECT month, CASE WHEN key % 19 = 0 THEN -999999 ELSE score / 100 END AS score_card FROM sample)"


def _scored(spark, sf_dir):
    return sample(spark, sf_dir).select("month", F.when(F.col("key") % 19 == 0, -999999.0).otherwise(F.col("score") / 100).alias("score_card"))


_SHARES = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}


@query("quality_score_dist", f"""WITH {SAMPLE_SQL}, {_SCORED} SELECT month, count(*) AS cnt, round(avg(v), 8) AS avg, round(stddev_pop(v), 8) AS std, round(min(v), 8) AS min, round(max(v), 8) AS max, round(avg((v IS NULL)::INT) * 100, 8) AS invalid_pct,
{', '.join(f"round(quantile_cont(v, {p}), 8) AS {n}" for n, p in _SHARES.items())} FROM (SELECT month, nullif(score_card, -999999) AS v FROM scored) GROUP BY 1""")
def quality_score_dist(spark, sf_dir):
    return rounded(quality.score_distribution(_scored(spark, sf_dir), "month", "score_card", digits=8), 8)


@query("quality_score_range", f"""WITH {SAMPLE_SQL}, {_SCORED}, n AS (SELECT month, CASE {' '.join(f"WHEN score_card < {h} THEN '{n}'" for h, n in quality.RANGES)} ELSE '{quality.LAST_RANGE}' END AS score_bucket, count(*) AS cnt FROM scored GROUP BY 1, 2)
SELECT *, round(cnt * 100 / sum(cnt) OVER (PARTITION BY month), 4) AS pct FROM n""")
def quality_score_range(spark, sf_dir):
    return quality.score_ranges(_scored(spark, sf_dir), "month", "score_card")


@query("quality_approximate")
def quality_approximate(spark, sf_dir):
    """The distribution check in one pass, with approximate medians."""
    return quality.distribution(sample(spark, sf_dir), "month", ["f_quantity", "f_price"], exact=False)
