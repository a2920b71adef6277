import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskspark.operators import diff, joins, scorecard, scoring
from riskspark.plans import metadata as md
from riskspark.plans import planner, rules
from riskspark.queries.assembly import metadata
from riskspark.queries.modelling import MODEL
from riskspark.reports import diff_report, model_report, plan_report, sinks
from riskspark.sources import model_text, readers
from riskspark.sources.scorecards import StoredScorecard


def test_as_of_edges(spark):
    s = spark.createDataFrame([(1, "a", "2024-04-01"), (2, "a", "2024-06-29"), (3, "a", "2024-06-30"), (4, "b", "2024-04-01"), (5, None, "2024-04-01")], "id int, k string, t string").withColumn("t", F.to_timestamp("t"))
    h = spark.createDataFrame([("a", "2024-03-31", 1), ("a", "2024-03-31", 2), ("a", "2024-04-02", 3), (None, "2024-01-01", 9)], "k string, at string, v int").withColumn("at", F.to_timestamp("at"))
    got = {r.id: r.v for r in joins.as_of(s, h, ("k", "k"), ("t", "at"), ["v"], 88, ["v"]).collect()}
    assert got == {1: 2, 2: 3, 3: None, 4: None, 5: None}


def test_as_of_strict(spark):
    s = spark.createDataFrame([(1, 5)], "k int, t int").withColumn("t", F.timestamp_seconds("t"))
    h = spark.createDataFrame([(1, 5, 7), (1, 4, 6)], "k int, at int, v int").withColumn("at", F.timestamp_seconds("at"))
    assert joins.as_of(s, h, ("k", "k"), ("t", "at"), ["v"], strict=True).first().v == 6
    assert joins.as_of(s, h, ("k", "k"), ("t", "at"), ["v"]).first().v == 7


@pytest.mark.parametrize("direction,want", [("<=", {1, 2}), (">=", {2, 3}), ("between", {1, 2})])
def test_interval_directions(spark, direction, want):
    s = spark.createDataFrame([(1, "2024-02-10")], "k int, t string").withColumn("t", F.to_date("t"))
    t = spark.createDataFrame([(1, "2024-01-31", 1), (1, "2024-02-10", 2), (1, "2024-02-15", 3), (1, "2024-03-30", 4)], "k int, at string, v int").withColumn("at", F.to_date("at"))
    assert {r.v for r in joins.interval(s, t, ("k", "k"), ("t", "at"), ["v"], 10, "days", direction).collect()} == want
    kept = joins.interval(s, t, ("k", "k"), ("t", "at"), ["v"], 10, "days", direction, keep=["k"]).collect()
    assert [r.v for r in kept] == [2]


def test_rules():
    assert rules.classify("wdyy.T_CCR_x") == (rules.BEHAVIOUR, "")
    assert rules.classify("度小满") == (rules.EXTERNAL, "度小满")
    assert rules.classify("wdyy.t_ccrbt_y") == (rules.BEHAVIOUR, "京东白条")
    assert rules.classify("nothing") == (rules.UNKNOWN, "")
    assert rules.classify(None) == (rules.UNKNOWN, "")
    assert rules.join_keys("t_pbci_a", rules.CREDIT).primary == "report_no"
    assert rules.join_keys("wdyy.t_zxysblhs", rules.CREDIT).primary == "ci_rpt_id"
    assert rules.join_keys("京东", rules.EXTERNAL).primary == "apply_no"
    assert rules.likely_key("CUST_ID") and not rules.likely_key("age")
    assert rules.excel_category("x", "征信") == rules.CREDIT


def test_plan_resolution_and_split():
    meta = metadata()
    plan = planner.plan(meta, ["acctbal", "spent", "nowhere"], planner.Config(priority=["贷中行为变量-新底座"]))
    assert plan.resolved == {"acctbal": "ads.ads_risk_month"} and plan.unknown == ("nowhere",)
    assert planner.plan(meta, ["acctbal"], planner.Config()).resolved == {"acctbal": "wdyy.t_ccr_customer"}
    with pytest.raises(ValueError):
        planner.plan(meta, ["nowhere"], planner.Config(strict=True))
    assert [len(p) for p in planner.parts(list("abcdefg"), 3)] == [3, 2, 2]
    assert [len(p) for p in planner.parts(list("abcdefg"), 3, "sequential")] == [3, 3, 1]
    assert planner.parts([], 3) == []


def test_overrides_and_status():
    meta = metadata().with_overrides({"spent": "wdyy.t_ccr_customer", "new": "ed_x"}, {"wdyy.t_ccr_customer": "id"}, {"segment": "seg_col"})
    assert meta.get("spent").table == "wdyy.t_ccr_customer" and meta.get("spent").join_key == "id"
    assert meta.get("segment").physical == "seg_col" and meta.get("new").category == rules.EXTERNAL
    assert metadata().get("spent").table == "ads.ads_risk_month"
    assert md.blacklisted(["A", "b"], ["a"]) == ["A"]


def test_metadata_round_trip(tmp_path):
    meta = metadata()
    for name in ("m.yaml", "m.json"):
        md.save(meta, str(tmp_path / name))
        assert md.load(str(tmp_path / name)) == md.load(str(tmp_path / name))
        assert md.load(str(tmp_path / name)).statistics() == meta.statistics()
    filled = md.Metadata.from_dict({"tables": [{"name": "t", "category": "c", "variables": ["v"]}], "variables": [{"name": "W", "table": "t"}]})
    assert filled.get("w").category == "c" and filled.get("v").table == "t"


def test_config_policies():
    c = planner.Config(partition_control={"default": {"a": 1, "b": 2}, "table:t": {"b": 3}}, extra_where={"by_platform": {"p": ["x > 1"]}}, join_types={"p": "inner"})
    assert c.partition_policy("t", "p", "c") == {"a": 1, "b": 3} and c.conditions("t", "p", "c") == ["x > 1"]
    assert c.join_type("p", "c") == "inner" and c.join_type("q", "c") == "left"


def test_wide_table_filters_and_fill(spark):
    meta = md.from_rows([{"name": "x", "db": "d", "table": "ed_a"}, {"name": "y", "db": "d", "table": "ed_a"}])
    table = spark.createDataFrame([("1", 5.0, 1.0, "20240101"), ("1", 6.0, 2.0, "20240102"), ("9", 7.0, 3.0, "20240102")], "cert_no string, x double, y double, dt string")
    sample = spark.createDataFrame([("1", "1", 0.5), ("2", "2", 0.5)], "apply_no string, cert_no string, x double")
    config = planner.Config(biz_date="20240102", fill=-999999.0, sample_keys={"cert_no": "cert_no"})
    got = planner.lower(planner.plan(meta, ["x", "y"], config), meta, sample, planner.from_frames({"d.ed_a": table}), config)
    rows = {r.apply_no: (r.x, r.g1_x, r.y) for r in got.collect()}
    assert rows == {"1": (0.5, 6.0, 2.0), "2": (0.5, -999999.0, -999999.0)}


def test_model_text_and_score(spark):
    model = model_text.parse_text(MODEL)
    assert model.features == ["f_quantity", "f_price", "f_discount", "f_tax"] and len(model.trees) == 3
    assert model.importance()["f_price"] == 120.5 and "f_tax" in model.valid_features()
    assert model_text.parse_json(json.dumps(model.dump())).trees[0].left.feature == model.trees[0].left.feature
    rows = [(1, 24.5, 30000.5, 0.04, 0.035), (2, None, None, None, None), (3, 30.0, 40000.0, -999999.0, 0.5)]
    df = spark.createDataFrame(rows, "id int, f_quantity double, f_price double, f_discount double, f_tax double")

    def walk(node, x):
        while node.feature is not None:
            node = node.left if x[node.feature] <= node.threshold else node.right
        return node.value

    for r in scoring.score(df, model, ["id"], output_variables=True, top=2).collect():
        x = [-999999.0 if v is None else v for v in rows[r.id - 1][1:]]
        p = 1 / (1 + math.exp(-sum(walk(t, x) for t in model.trees)))
        assert r.score == pytest.approx(p) and r.all_null_flag == int(r.id == 2)
        want = -999999.0 if r.id == 2 else 533.903595 - 72.134752 * math.log(np.float32(p) / (np.float32(1) - np.float32(p)))
        assert r.score_card == pytest.approx(want, abs=0.011)
        assert "f_price" in r.asDict()


def test_pickles_are_refused(tmp_path):
    with pytest.raises(ValueError):
        model_text.load_model(str(tmp_path / "m.pkl"))
    with pytest.raises(ValueError):
        StoredScorecard.load(str(tmp_path / "m.pkl"))
    with pytest.raises(ValueError):
        model_text.parse_text("nothing")


def test_pmml_keeps_all_fields():
    text = '<PMML xmlns="http://www.dmg.org/PMML-4_4"><M><MiningSchema><MiningField name="a"/><MiningField name="b"/><MiningField name="_target" usageType="target"/></MiningSchema></M></PMML>'
    assert model_text.pmml_fields(text) == ["a", "b"]


def woe_frame(spark, n=4000):
    draw = np.random.default_rng(7)
    a, b = draw.normal(size=n), draw.normal(size=n)
    y = (draw.random(n) < 1 / (1 + np.exp(1 + a + 0.5 * b))).astype(int)
    return spark.createDataFrame(pd.DataFrame({"a": a, "b": b, "c": a + 0.01 * draw.normal(size=n), "bad": y})).cache(), a, b, y


def test_logistic_fit_against_numpy(spark):
    df, a, b, y = woe_frame(spark)
    x = np.column_stack([np.ones(len(a)), a, b])
    beta = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ beta))
        hessian = x.T @ (x * (p * (1 - p))[:, None])
        beta += np.linalg.solve(hessian, x.T @ (y - p))
    model = scorecard.fit(df, "bad", ["intercept", "a", "b"])
    assert model.estimates == pytest.approx(beta, abs=1e-8)
    assert np.sqrt(np.diag(model.covariance)) == pytest.approx(np.sqrt(np.diag(np.linalg.inv(hessian))), rel=1e-6)
    rows = {r.parameter: r for r in scorecard.wald(df, model)}
    assert rows["a"].p < 1e-6 and rows["a"].vif == pytest.approx(1, abs=0.3)
    base = scorecard.fit(df, "bad", ["intercept"])
    tests = scorecard.score_tests(df, "bad", base, ["a", "b"])
    assert tests["a"][0] > tests["b"][0] > 0


def test_stepwise_refuses_the_twin(spark):
    df, *_ = woe_frame(spark)
    run = scorecard.Stepwise()
    model = run.run(df, "bad", ["a", "b", "c"])
    assert "b" in model.names and len({"a", "c"} & set(model.names)) == 1


def test_points_and_their_application(spark):
    model = scorecard.Fit(["intercept", "x"], np.array([-1.0, -0.8]), np.eye(2), 0.0, 1)
    rows = scorecard.points(model, {"x": [(-math.inf, 1.0, -0.5), (1.0, math.inf, 0.7)]}, missing={"x": -999999.0})
    own = [r for r in rows if r.name == "x"]
    assert own[0].left is None and min(r.score for r in own) == 0 and rows[-1].name == "intercept"
    df = spark.createDataFrame([(0.0,), (5.0,), (None,)], "x double")
    got = [r.scorecard_score for r in scorecard.apply_points(df, rows).collect()]
    assert got[1] > got[0] == got[2]
    assert "missing" in scorecard.readable(rows)


def test_split_keeps_shares(spark):
    df = spark.range(4000).select(F.col("id"), (F.col("id") % 4 == 0).cast("int").alias("bad"), F.when(F.col("id") < 3000, 202401).otherwise(202402).alias("m"))
    n = {r.data_flag: r["count"] for r in scorecard.split(df, "bad", "m", 202402, key="id").groupBy("data_flag").count().collect()}
    assert n["oot"] == 1000 and abs(n["train"] - 2400) < 120


def pair(spark):
    a = spark.createDataFrame([("1", 1.23, "x ", 0.5), ("2", None, "y", 0.1), (None, 5.0, "z", 0.2), ("4", 7.001, None, 0.3)], "ID string, v double, s string, score double")
    b = spark.createDataFrame([("1", 1.2300001, "x", 0.5004), ("2", -999999.0, "w", 0.2), (None, 5.1, "z", 0.2), ("5", 1.0, "q", 0.1)], "id string, v double, s string, other double")
    return a, b


SPEC = diff.DiffSpec(["id"], "score", [diff.Variable("v", "one", 2), diff.Variable("s", "two", kind="enum")])


def test_diff(spark):
    a, b = pair(spark)
    merged = diff.merge(a, b, ["id"], "other", "score")
    assert merged.count() == 3
    got = {r.id: (r.m_score, r.m_v, r.m_s) for r in diff.compare(merged, SPEC).collect()}
    assert got == {"1": (True, True, True), "2": (False, True, False), None: (True, False, True)}
    text = diff_report.markdown(a, b, SPEC, "other")
    assert "SELECT id, v" in text and "## variables" in text
    with pytest.raises(ValueError):
        diff_report.markdown(a, b.where("id = '5'"), SPEC, "other")


def test_precision_is_inferred(spark):
    df = spark.createDataFrame([(1.5, 1.0), (0.00025, 1e8)], "a_online double, a_offline double")
    assert diff.precisions(df, [diff.Variable("a")]) == {"a": 5}


def test_workbook_round_trip(spark, tmp_path):
    path = str(tmp_path / "r.xlsx")
    df = spark.createDataFrame([("甲 & <b>", 0.25, 3), (None, float("nan"), 4)], "name string, bad_rate double, n int")
    sinks.write_xlsx(path, {"one": {"first": df, "none": None}, "two": {"parts": [("p", df)]}})
    rows = readers.xlsx_rows(path, "one")
    assert rows[0] == ["first"] and rows[1] == ["name", "bad_rate", "n"] and rows[2] == ["甲 & <b>", 0.25, 3.0]
    assert len(readers.xlsx_rows(path, 1)) > 3


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A\tB\n1\tx,y\n")
    assert readers.read_csv(spark, str(tmp_path / "a.csv")).columns == ["a", "b"]
    (tmp_path / "d.tsv").write_text("字段名\t字段含义\t库名\t表名\t表描述\nAge\tyears\twdyy\tt_ccr_a\tpeople\n")
    rows = readers.dictionary_rows(spark, str(tmp_path / "d.tsv"))
    assert rows[0]["name"] == "age" and rows[0]["source"] == "wdyy.t_ccr_a"
    assert readers.metadata_dict(spark, str(tmp_path / "d.tsv"))["age"]["category"] == rules.BEHAVIOUR
    (tmp_path / "v.txt").write_text("# all\nAge # one\n\nage\nB\n")
    assert readers.variable_list(str(tmp_path / "v.txt")) == ["age", "b"]
    (tmp_path / "c.yaml").write_text("project: {work_no: w1}\ntable: t_${work_no}_${other}\nblacklist_file: v.txt\nn: {a: 1, b: 2}\n")
    (tmp_path / "m.yaml").write_text("n: {b: 3}\nblacklist_vars: [Z]\n")
    c = readers.load_config(str(tmp_path / "c.yaml"), str(tmp_path / "m.yaml"))
    assert c["table"] == "t_w1_${other}" and c["n"] == {"a": 1, "b": 3} and c["blacklist_vars"] == ["z", "age", "b"]
    (tmp_path / "d.json").write_text(json.dumps({"primary_keys": ["ID"], "score_column": "S", "variables": [{"name": "V", "data_source": "x", "precision": 2}]}))
    assert readers.load_diff_config(str(tmp_path / "d.json")).variables == [diff.Variable("v", "x", 2)]


def test_model_report(spark, tmp_path):
    draw = np.random.default_rng(2)
    n = 1500
    x = draw.normal(size=n)
    pdf = pd.DataFrame({
        "loan_date": np.where(np.arange(n) % 3 == 0, "2025-1-6", "2025-02-07"), "mob6_30": (draw.random(n) < 1 / (1 + np.exp(1 - x))).astype(int),
        "data_flag": np.where(np.arange(n) % 5 == 0, "oot", "train"), "score": 600 - 50 * x, "f": x, "g": draw.normal(size=n),
    })
    df = spark.createDataFrame(pdf)
    made = model_report.ReportGenerator(model_report.ReportConfig(scores=("score",), card_scores=("score",)))
    made.to_excel(df, str(tmp_path / "r.xlsx"))
    assert (tmp_path / "r.xlsx").stat().st_size > 3000
    assert "## woe" in made.to_markdown(df)
    with pytest.raises(ValueError):
        made.generate(df.withColumn("mob6_30", F.lit(2)))
    with pytest.raises(ValueError):
        made.generate(df.where("data_flag = 'oot'"))
    with pytest.raises(ValueError):
        made.generate(df.drop("loan_date"))


def test_plan_report():
    meta = metadata()
    text = plan_report.markdown(planner.plan(meta, ["spent", "nowhere"], planner.Config()), meta, ["spent", "nowhere"], None, model_text.parse_text(MODEL), ["spent"])
    assert "NOT_FOUND" in text and "120.5" in text


def test_stored_scorecard(tmp_path):
    card = StoredScorecard({"x": [{"good": 8, "bad": 2, "iv": 0.1, "low": None, "high": 1}, {"good": 2, "bad": 8, "iv": 0.2, "low": 1, "high": None}]}, [{"parameter": "x", "chi2": 3.0}], [scorecard.Points("x", None, 1.0, 5.0)])
    card.save(str(tmp_path / "c.json"))
    back = StoredScorecard.load(str(tmp_path / "c.json"))
    assert back.ks("x") == pytest.approx(0.6) and back.iv("x") == pytest.approx(0.3) and back.wald_order() == ["x"]


def test_command_line(spark, tmp_path):
    from riskspark.__main__ import main

    for name, value in (("a", "1.0"), ("b", "2.0")):
        (tmp_path / f"{name}.csv").write_text(f"id,v,score\n1,{value},0.5\n")
    (tmp_path / "v.txt").write_text("v\n")
    args = ["diff", "--var-list", str(tmp_path / "v.txt"), "--online", str(tmp_path / "a.csv"), "--offline", str(tmp_path / "b.csv"), "--pk", "id", "-o", str(tmp_path / "o.md")]
    assert main(args) == 2
    assert main([*args, "--score", "score"]) == 0 and "differ" in (tmp_path / "o.md").read_text()


def test_streaming_counts(spark, tmp_path):
    from riskspark.streaming import daily_counts, score_drift

    spark.createDataFrame([("2024-01-01 01:00:00", 1.0), ("2024-01-01 02:00:00", 3.0), ("2024-01-02 01:00:00", 3.0)], "t string, s double").withColumn("t", F.to_timestamp("t")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("t timestamp, s double").parquet(str(tmp_path / "in"))
    q = daily_counts(stream, "t", "s", [2.0]).writeStream.outputMode("complete").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    got = {(str(r.start)[:10], r.bin): r.n for r in spark.table("counts").collect()}
    assert got == {("2024-01-01", 0): 1, ("2024-01-01", 1): 1, ("2024-01-02", 1): 1}
    drift = {str(r.start)[:10]: r.psi for r in score_drift(spark.table("counts"), {0: 0.5, 1: 0.5}).collect()}
    assert drift["2024-01-01"] == pytest.approx(0) and drift["2024-01-02"] > 1
