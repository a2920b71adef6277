"""Joins of a sample with variable tables, the wide-table plan, and metadata."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..operators import joins
from ..plans import metadata as md
from ..plans import planner, rules
from ..plans.sql_text import wide_sql
from .common import query, rounded, table


@query("asof_latest_90d", """WITH p AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'), e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'),
j AS (SELECT e.event_id, e.user_id, p.value, row_number() OVER (PARTITION BY e.event_id ORDER BY p.ts DESC NULLS LAST, p.event_id DESC) AS r FROM e LEFT JOIN p ON p.user_id = e.user_id AND p.ts <= e.ts AND date_diff('day', CAST(p.ts AS DATE), CAST(e.ts AS DATE)) <= 90)
SELECT event_id, user_id, round(value, 6) AS value FROM j WHERE r = 1""")
def asof_latest_90d(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    errors = e.where("event_type = 'error'").select("event_id", "user_id", "ts")
    bought = e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("bought"), "value", F.col("event_id").alias("purchase"))
    return rounded(joins.as_of(errors, bought, ("user_id", "user_id"), ("ts", "bought"), ["value"], 90, ["purchase"]).select("event_id", "user_id", "value"))


@query("asof_orders_90d", """WITH j AS (SELECT a.o_orderkey, b.o_totalprice AS previous, row_number() OVER (PARTITION BY a.o_orderkey ORDER BY b.o_orderdate DESC NULLS LAST, b.o_orderkey DESC) AS r
FROM orders a LEFT JOIN orders b ON b.o_custkey = a.o_custkey AND b.o_orderdate < a.o_orderdate AND date_diff('day', CAST(b.o_orderdate AS DATE), CAST(a.o_orderdate AS DATE)) <= 90)
SELECT o_orderkey, round(previous, 2) AS previous FROM j WHERE r = 1""")
def asof_orders_90d(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    past = o.select(F.col("o_custkey").alias("c"), F.col("o_orderdate").alias("past"), F.col("o_totalprice").alias("previous"), F.col("o_orderkey").alias("k"))
    got = joins.as_of(o.select("o_orderkey", "o_custkey", "o_orderdate"), past, ("o_custkey", "c"), ("o_orderdate", "past"), ["previous"], 90, ["k"], strict=True)
    return rounded(got.select("o_orderkey", "previous"), 2)


@query("range_join_dedup", """WITH j AS (SELECT a.o_orderkey, b.o_orderkey AS other, row_number() OVER (PARTITION BY a.o_orderkey ORDER BY abs(date_diff('day', CAST(b.o_orderdate AS DATE), CAST(a.o_orderdate AS DATE))) NULLS LAST, b.o_orderdate DESC NULLS LAST, b.o_orderkey DESC NULLS LAST) AS r
FROM orders a LEFT JOIN orders b ON b.o_custkey = a.o_custkey AND b.o_orderdate <= a.o_orderdate AND date_diff('day', CAST(b.o_orderdate AS DATE), CAST(a.o_orderdate AS DATE)) BETWEEN 0 AND 60 AND b.o_orderstatus = 'F' WHERE a.o_orderstatus = 'O')
SELECT o_orderkey, other FROM j WHERE r = 1""")
def range_join_dedup(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    s = o.where("o_orderstatus = 'O'").select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("issued"))
    t = o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c"), "o_orderdate", F.col("o_orderkey").alias("other"))
    return joins.interval(s, t, ("o_custkey", "c"), ("issued", "o_orderdate"), ["other"], 60, "days", "<=", "left", ["o_orderkey"], ["other"]).select("o_orderkey", "other")


@query("between_join", """SELECT a.o_orderkey, count(b.o_orderkey) AS n FROM orders a LEFT JOIN orders b ON b.o_custkey = a.o_custkey AND date_diff('day', CAST(b.o_orderdate AS DATE), CAST(a.o_orderdate AS DATE)) BETWEEN 0 AND 30 GROUP BY 1""")
def between_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    t = o.select(F.col("o_custkey").alias("c"), F.col("o_orderdate").alias("d"), F.col("o_orderkey").alias("k"))
    got = joins.interval(o.select("o_orderkey", "o_custkey", "o_orderdate"), t, ("o_custkey", "c"), ("o_orderdate", "d"), ["k"], 30, "days", "between")
    return got.groupBy("o_orderkey").agg(F.count("k").alias("n"))


@query("month_equality_join", """WITH v AS (SELECT o_custkey, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS m, sum(o_totalprice) AS spent FROM orders GROUP BY 1, 2)
SELECT a.o_orderkey, round(v.spent, 2) AS spent FROM orders a LEFT JOIN v ON v.o_custkey = a.o_custkey AND CAST(strftime(strptime(CAST(v.m AS VARCHAR) || '01', '%Y%m%d') + INTERVAL 1 MONTH, '%Y%m') AS INTEGER) = CAST(strftime(a.o_orderdate, '%Y%m') AS INTEGER)""")
def month_equality_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    v = o.groupBy("o_custkey", F.date_format("o_orderdate", "yyyyMM").cast("int").alias("m")).agg(F.sum("o_totalprice").alias("spent"))
    got = joins.keyed(o, v, [("o_custkey", "o_custkey"), (F.date_format("o_orderdate", "yyyyMM").cast("int"), joins.shifted_month(F.col("m"), 1, "int"))], {"spent": "spent"})
    return rounded(got.select("o_orderkey", "spent"), 2)


@query("offset_join", """WITH v AS (SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS data_dt, count(*) AS n FROM orders GROUP BY 1)
SELECT a.o_orderkey, v.n AS n_before FROM orders a LEFT JOIN v ON v.data_dt = CAST(strftime(CAST(a.o_orderdate AS DATE) - INTERVAL 2 DAY, '%Y%m%d') AS INTEGER)""")
def offset_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    v = o.groupBy(F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("data_dt")).agg(F.count("*").alias("n"))
    return joins.keyed(o, v, [(joins.shifted_day(F.col("o_orderdate"), -2, parsed=True), "data_dt")], {"n_before": "n"}).select("o_orderkey", "n_before")


@query("md5_join", """SELECT o_orderkey, c_acctbal FROM (SELECT o_orderkey, md5(CAST(o_custkey AS VARCHAR)) AS h FROM orders) o JOIN customer c ON md5(CAST(c.c_custkey AS VARCHAR)) = o.h""")
def md5_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.md5(F.col("o_custkey").cast("string")).alias("h"))
    return joins.keyed(o, table(spark, sf_dir, "customer"), [("h", joins.md5_key(F.col("c_custkey")))], {"c_acctbal": "c_acctbal"}, "inner").select("o_orderkey", "c_acctbal")


@query("semi_filter", """SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def semi_filter(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    return joins.semi(table(spark, sf_dir, "customer"), "c_custkey", urgent, "o_custkey").select("c_custkey", "c_name")


def metadata() -> md.Metadata:
    """Variables over tables named as the rules know them."""
    rows = [
        {"name": "acctbal", "db": "wdyy", "table": "t_ccr_customer"}, {"name": "segment", "db": "wdyy", "table": "t_ccr_customer"},
        {"name": "spent", "db": "ads", "table": "ads_risk_month"}, {"name": "acctbal", "db": "ads", "table": "ads_risk_month"},
        {"name": "last_price", "db": "wdyy", "table": "t_zxysblhs_orders"}, {"name": "n_day", "db": "edap", "table": "v_br_day"}, {"name": "cust_no", "db": "edap", "table": "v_br_day"},
        {"name": "near_price", "db": "ed0223", "table": "near"}, {"name": "model_score", "db": "sykj1", "table": "model_a"},
    ]
    return md.from_rows(rows)


def _wide(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    sample = o.select(
        F.col("o_orderkey").alias("apply_no"), F.col("o_custkey").alias("cust_no"), F.md5(F.col("o_custkey").cast("string")).alias("cert_no"), F.date_format("o_orderdate", "yyyyMMdd").alias("issue_time")
    )
    history = o
    frames = {
        "wdyy.t_ccr_customer": c.select(F.col("c_custkey").alias("cust_no"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"), F.lit("20240101").alias("dt")),
        "ads.ads_risk_month": history.groupBy(F.col("o_custkey").alias("cust_no"), F.date_format("o_orderdate", "yyyyMM").alias("part_id")).agg(F.sum("o_totalprice").alias("spent")),
        "reports": history.select(F.col("o_custkey").cast("string").alias("person"), F.col("o_orderkey").cast("string").alias("ci_rpt_id"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("rpt_tm")),
        "wdyy.t_zxysblhs_orders": history.select(F.col("o_orderkey").cast("string").alias("ci_rpt_id"), F.col("o_totalprice").alias("last_price")),
        "edap.v_br_day": history.groupBy(F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("data_dt"), F.col("o_custkey").cast("string").alias("cert_no")).agg(F.count("*").alias("n_day")),
        "ed0223.near": history.select(F.col("o_custkey").alias("cust_no"), F.date_format("o_orderdate", "yyyyMMdd").alias("score_date"), F.col("o_totalprice").alias("near_price"), F.col("o_orderkey").alias("k")),
    }
    config = planner.Config(
        biz_date="20240101", target_platform="", priority=["贷中行为变量-新底座"], sample_keys={"cust_no": "cust_no", "cert_no": "cert_no"},
        bridge=planner.CreditBridge("reports", "person", "ci_rpt_id", "rpt_tm", "cert_no", "issue_time"),
        custom={"edap.v_br_day": planner.CustomJoin(md5=True, time_field="data_dt", sample_time="issue_time", days=-2), "ed0223.near": planner.CustomJoin(join_key="cust_no")},
        time_ranges={
            "ads.ads_risk_month": planner.TimeRange("equality", "part_id", "issue_time", offset=1),
            "ed0223.near": planner.TimeRange("range", "score_date", "issue_time", 30, "days", tie=("k",)),
        },
        extra_where={"by_table": {"ed0223.near": ["near_price > 1000"]}},
    )
    return sample, frames, config


WIDE = ["segment", "spent", "last_price", "n_day", "near_price", "nowhere"]


WIDE_SQL = """WITH s AS (SELECT o_orderkey AS apply_no, o_custkey AS cust_no, CAST(o_orderdate AS DATE) AS issue FROM orders), h AS (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders),
m AS (SELECT o_custkey, strftime(d, '%Y%m') AS m, sum(o_totalprice) AS spent FROM h GROUP BY 1, 2), v AS (SELECT o_custkey, d, count(*) AS n_day FROM h GROUP BY 1, 2),
r AS (SELECT apply_no, h.o_totalprice AS last_price, row_number() OVER (PARTITION BY apply_no ORDER BY h.o_orderdate DESC NULLS LAST, CAST(h.o_orderkey AS VARCHAR) DESC) AS n FROM s LEFT JOIN h ON h.o_custkey = s.cust_no AND h.o_orderdate <= issue AND date_diff('day', h.d, issue) <= 90),
x AS (SELECT apply_no, h.o_totalprice AS near_price, row_number() OVER (PARTITION BY apply_no ORDER BY h.d DESC NULLS LAST, h.o_orderkey DESC) AS n FROM s LEFT JOIN h ON h.o_custkey = s.cust_no AND h.d <= issue AND date_diff('day', h.d, issue) <= 30 AND h.o_totalprice > 1000)
SELECT apply_no, cust_no, c_mktsegment AS segment, round(spent, 2) AS spent, last_price, n_day, near_price FROM s LEFT JOIN customer ON c_custkey = cust_no
LEFT JOIN m ON m.o_custkey = cust_no AND strftime(strptime(m.m || '01', '%Y%m%d') + INTERVAL 1 MONTH, '%Y%m') = strftime(issue, '%Y%m') LEFT JOIN v ON v.o_custkey = cust_no AND v.d = issue - 2
JOIN r USING (apply_no) JOIN x USING (apply_no) WHERE r.n = 1 AND x.n = 1"""


def _wide_table(spark, sf_dir, cut_every=0):
    sample, frames, config = _wide(spark, sf_dir)
    config.cut_every = cut_every
    meta = metadata()
    wide = planner.lower(planner.plan(meta, WIDE, config), meta, sample, planner.from_frames(frames), config)
    return rounded(wide.select("apply_no", "cust_no", "segment", "spent", "last_price", "n_day", "near_price"), 2)


@query("wide_table", WIDE_SQL)
def wide_table(spark, sf_dir):
    return _wide_table(spark, sf_dir)


@query("wide_table_cut", WIDE_SQL)
def wide_table_cut(spark, sf_dir):
    """The same, written and read again after every two joined tables."""
    return _wide_table(spark, sf_dir, 2)


@query("wide_table_as_sql", WIDE_SQL)
def wide_table_as_sql(spark, sf_dir):
    """The same from the plan's SQL text, over views of the same tables."""
    sample, frames, config = _wide(spark, sf_dir)
    meta, names = metadata(), {}
    sample.createOrReplaceTempView("wide_sample")
    for name, frame in frames.items():
        names[name] = "wide_" + name.replace(".", "_")
        frame.createOrReplaceTempView(names[name])
    text = wide_sql(planner.plan(meta, WIDE, config), meta, "wide_sample", sample.columns, config, columns_of={n: f.columns for n, f in frames.items()})
    for name in sorted(names, key=len, reverse=True):
        text = re.sub(rf"(FROM|JOIN) {re.escape(name)}\b", rf"\1 {names[name]}", text)
    return rounded(spark.sql(text).select("apply_no", "cust_no", "segment", "spent", "last_price", "n_day", "near_price"), 2)



_ROWS = "(VALUES ('acctbal', 'wdyy.t_ccr_customer'), ('segment', 'wdyy.t_ccr_customer'), ('spent', 'ads.ads_risk_month'), ('acctbal', 'ads.ads_risk_month'), ('last_price', 'wdyy.t_zxysblhs_orders'), ('n_day', 'edap.v_br_day'), ('cust_no', 'edap.v_br_day'), ('near_price', 'ed0223.near'), ('model_score', 'sykj1.model_a')) v(name, \"table\")"


@query("metadata_ambiguity", f"""SELECT name, count(DISTINCT "table") AS tables FROM {_ROWS} GROUP BY 1 HAVING count(DISTINCT "table") > 1""")
def metadata_ambiguity(spark, sf_dir):
    x = metadata().frame(spark)
    return x.groupBy("name").agg(F.countDistinct("table").alias("tables")).where("tables > 1")


_CATEGORY = """CASE WHEN starts_with("table", 'wdyy.t_ccr') OR starts_with("table", 'ads.ads_risk_') THEN '行为变量' WHEN starts_with("table", 'wdyy.t_zxysblhs') THEN '征信变量' WHEN starts_with("table", 'sykj1.model') THEN '模型分' ELSE '外部数据' END"""


@query("metadata_stats", f"SELECT {_CATEGORY} AS category, count(*) AS variables, count(DISTINCT \"table\") AS tables FROM {_ROWS} GROUP BY 1")
def metadata_stats(spark, sf_dir):
    return metadata().frame(spark).groupBy("category").agg(F.count("*").alias("variables"), F.countDistinct("table").alias("tables"))


@query("classify_tables", f"""SELECT DISTINCT "table", {_CATEGORY} AS category, CASE WHEN starts_with("table", 'ads.ads_risk_') THEN '贷中行为变量-新底座' WHEN starts_with("table", 'wdyy.t_zxysblhs') THEN '征信变量-消金' WHEN starts_with("table", 'sykj1.model') THEN '模型分'
 WHEN starts_with("table", 'edap.v_br') THEN '百融' WHEN starts_with("table", 'ed0223') THEN '度小满' ELSE '' END AS platform FROM {_ROWS}""")
def classify_tables(spark, sf_dir):
    own = [(t, *rules.classify(t)) for t in metadata().tables]
    return spark.createDataFrame(own, "table string, category string, platform string")


@query("feature_status", f"""SELECT f.name, CASE WHEN f.name = 'segment' THEN 'OVERRIDE' WHEN count(v.name) = 0 THEN 'NOT_FOUND' WHEN count(v.name) = 1 THEN 'OK' ELSE 'AMBIGUOUS' END AS status
FROM (VALUES ('acctbal'), ('segment'), ('spent'), ('nowhere')) f(name) LEFT JOIN {_ROWS} ON v.name = f.name GROUP BY 1""")
def feature_status(spark, sf_dir):
    got = md.feature_status(["acctbal", "segment", "spent", "nowhere"], metadata(), {"segment": "other"})
    return spark.createDataFrame([(r["name"], r["status"]) for r in got], "name string, status string")
