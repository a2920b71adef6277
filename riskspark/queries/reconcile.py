"""Online against offline values: orders against a disturbed copy."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import diff
from .common import query, rounded, table

SPEC = diff.DiffSpec(
    ["key"], "score",
    [diff.Variable("price", "core"), diff.Variable("cust", "core", 0), diff.Variable("status", "labels", kind="enum"), diff.Variable("priority", "labels", kind="enum")],
)


def _sides(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    common = [k.alias("KEY"), F.col("o_custkey").alias("cust")]
    online = o.select(*common, F.col("o_totalprice").alias("score"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    price = F.when(k % 13 == 0, F.col("o_totalprice") + 1).when(k % 31 == 0, -999999.0).when(k % 29 != 0, F.col("o_totalprice"))
    offline = o.where(k % 101 != 0).select(
        *common, (F.col("o_totalprice") + F.when(k % 7 == 0, 0.5).otherwise(0.0001)).alias("score_card"), price.alias("price"),
        F.when(k % 11 == 0, "X").otherwise(F.concat(F.col("o_orderstatus"), F.lit(" "))).alias("status"), F.when(k % 17 != 0, F.col("o_orderpriority")).alias("priority"),
    )
    return online, offline


def _compared(spark, sf_dir):
    return diff.compare(diff.merge(*_sides(spark, sf_dir), SPEC.keys, "score_card", "score"), SPEC)


_MERGED = """m AS (SELECT o_orderkey AS key, o_totalprice AS price_online,
    CASE WHEN o_orderkey % 13 = 0 THEN o_totalprice + 1 WHEN o_orderkey % 31 = 0 THEN -999999 WHEN o_orderkey % 29 <> 0 THEN o_totalprice END AS price_offline,
    o_custkey AS cust_online, o_custkey AS cust_offline, o_orderstatus AS status_online, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus || ' ' END AS status_offline,
    o_orderpriority AS priority_online, CASE WHEN o_orderkey % 17 <> 0 THEN o_orderpriority END AS priority_offline, o_totalprice AS score_online,
    o_totalprice + CASE WHEN o_orderkey % 7 = 0 THEN 0.5 ELSE 0.0001 END AS score_offline FROM orders WHERE o_orderkey % 101 <> 0),
n AS (SELECT *, (price_online IS NULL OR price_online <= -99999) AS pa, (price_offline IS NULL OR price_offline <= -99999) AS pb, (status_offline IS NULL) AS sb, (priority_offline IS NULL) AS rb FROM m),
c AS (SELECT *, abs(score_online - score_offline) < 0.001 AS m_score, (pa AND pb) OR (NOT pa AND NOT pb AND coalesce(round_even(price_online * 100, 0) / 100 = round_even(price_offline * 100, 0) / 100, FALSE)) AS m_price, TRUE AS m_cust,
    trim(status_online) = trim(status_offline) AS m_status, NOT rb AND coalesce(trim(priority_online) = trim(priority_offline), FALSE) AS m_priority FROM n)"""


@query("diff_match_rates", f"""WITH {_MERGED}, r AS (SELECT avg((m_price AND m_cust)::INT) AS core, avg((m_status AND m_priority)::INT) AS labels FROM c)
SELECT * REPLACE (round(match_rate, 6) AS match_rate, round(source_rate, 6) AS source_rate) FROM (
{' UNION ALL '.join(f"SELECT '{n}' AS name, '{s}' AS source, CAST(sum(m_{n}::INT) AS BIGINT) AS match_count, count(*) AS total, avg(m_{n}::INT) AS match_rate, {r} AS source_rate FROM c" for n, s, r in (('score', 'score', 'CAST(NULL AS DOUBLE)'), ('price', 'core', '(SELECT core FROM r)'), ('cust', 'core', '(SELECT core FROM r)'), ('status', 'labels', '(SELECT labels FROM r)'), ('priority', 'labels', '(SELECT labels FROM r)')))})""")
def diff_match_rates(spark, sf_dir):
    return rounded(diff.match_rates(_compared(spark, sf_dir), SPEC))


_LEVELS = lambda a, b: f"""CAST(2 AS INTEGER) AS var_count, round(avg((h >= 2)::INT), 6) AS strict, round(avg((h >= 2)::INT), 6) AS match_75, round(avg((h >= 1)::INT), 6) AS match_50, round(avg((h >= 1)::INT), 6) AS match_25, round(avg((h >= 1)::INT), 6) AS loose FROM (SELECT {a}::INT + {b}::INT AS h FROM c)"""


@query("diff_drill_up", f"WITH {_MERGED} SELECT 'core' AS source, {_LEVELS('m_price', 'm_cust')} UNION ALL SELECT 'labels' AS source, {_LEVELS('m_status', 'm_priority')}")
def diff_drill_up(spark, sf_dir):
    return rounded(diff.drill_up(_compared(spark, sf_dir), SPEC))


_ANOMALIES = """a AS (
  SELECT 'price' AS name, CASE WHEN pa AND NOT pb THEN 'online_null' WHEN NOT pa AND pb THEN 'offline_null' ELSE 'differ' END AS kind, printf('%.2f', price_online) AS online, printf('%.2f', price_offline) AS offline, key FROM c WHERE NOT m_price
  UNION ALL SELECT 'status', 'differ', status_online, status_offline, key FROM c WHERE NOT m_status
  UNION ALL SELECT 'priority', 'offline_null', priority_online, priority_offline, key FROM c WHERE NOT m_priority)"""


@query("diff_anomalies", f"WITH {_MERGED}, {_ANOMALIES} SELECT name, kind, count(*) AS n, round(count(*) / (SELECT count(*) FROM c), 6) AS pct FROM a GROUP BY 1, 2")
def diff_anomalies(spark, sf_dir):
    return rounded(diff.anomalies(_compared(spark, sf_dir), SPEC))


@query("diff_top_pairs", f"""WITH {_MERGED}, {_ANOMALIES}, pairs AS (SELECT name, kind, online, offline, count(*) AS n FROM a WHERE name <> 'price' GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY name, kind ORDER BY n DESC, online NULLS FIRST, offline NULLS FIRST) AS INTEGER) AS rank FROM pairs) SELECT name, kind, online, offline, n, rank FROM r WHERE rank <= 3""")
def diff_top_pairs(spark, sf_dir):
    spec = diff.DiffSpec(SPEC.keys, SPEC.score, [v for v in SPEC.variables if v.name != "price"])
    return diff.top_pairs(_compared(spark, sf_dir), spec)


@query("diff_samples", f"""WITH {_MERGED}, {_ANOMALIES}, r AS (SELECT key, name, kind, online, offline, CAST(row_number() OVER (PARTITION BY name, kind ORDER BY key) AS INTEGER) AS rank FROM a WHERE name <> 'price') SELECT * FROM r WHERE rank <= 3""")
def diff_samples(spark, sf_dir):
    spec = diff.DiffSpec(SPEC.keys, SPEC.score, [v for v in SPEC.variables if v.name != "price"])
    return diff.sample_rows(_compared(spark, sf_dir), spec)


@query("diff_overview", f"""WITH {_MERGED} SELECT 'online' AS side, count(*) AS rows, CAST(6 AS INTEGER) AS columns FROM orders UNION ALL SELECT 'offline', count(*), 6 FROM orders WHERE o_orderkey % 101 <> 0 UNION ALL SELECT 'merged', count(*), 11 FROM m""")
def diff_overview(spark, sf_dir):
    a, b = _sides(spark, sf_dir)
    return diff.overview(a, b, diff.merge(a, b, SPEC.keys, "score_card", "score"))


@query("diff_null_rates", f"""WITH {_MERGED}, p AS (SELECT * FROM n) SELECT 'offline' AS side, 'price' AS "column", round(avg((price_offline IS NULL)::INT), 6) AS null_rate, round(avg(pb::INT), 6) AS missing_rate FROM p
UNION ALL SELECT 'offline', 'priority', round(avg(rb::INT), 6), round(avg(rb::INT), 6) FROM p""")
def diff_null_rates(spark, sf_dir):
    _, b = _sides(spark, sf_dir)
    return rounded(diff.null_rates(b.select("price", "priority"), "offline"))
