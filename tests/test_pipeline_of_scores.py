import json

import pytest
from pyspark.sql import functions as F

from riskspark.operators import binning, features, woe
from riskspark.pipeline import ScoringPipeline
from riskspark.plans import metadata as md
from riskspark.plans import planner
from riskspark.plans.sql_text import wide_sql
from riskspark.queries import assembly
from riskspark.queries.common import rounded, sample
from riskspark.sources.model_text import Node, TreeModel


def test_sql_text_gives_the_lowered_rows(spark, sf_dir):
    base, frames, config = assembly._wide(spark, sf_dir)
    meta = assembly.metadata()
    plan = planner.plan(meta, assembly.WIDE, config)
    # a business date and no policy: tables that have their partition column are read by it, in both forms
    text = wide_sql(plan, meta, "wide_sample", base.columns, config, columns_of={n: f.columns for n, f in frames.items()})
    assert text.count("dt = '20240101'") == 1
    customer = frames["wdyy.t_ccr_customer"]
    frames["wdyy.t_ccr_customer"] = customer.unionByName(customer.withColumn("dt", F.lit("20231201")).withColumn("segment", F.lit("old")))
    base.createOrReplaceTempView("wide_sample")
    for name, df in frames.items():
        safe = name.replace(".", "__")
        df.createOrReplaceTempView(safe)
        text = text.replace(f"FROM {name}", f"FROM {safe}").replace(f"JOIN {name} ", f"JOIN {safe} ")
    columns = ["apply_no", "segment", "spent", "last_price", "n_day", "near_price"]
    a = rounded(spark.sql(text).select(columns), 2).collect()
    b = rounded(planner.lower(plan, meta, base, planner.from_frames(frames), config).select(columns), 2).collect()
    assert len(a) > 50 and sorted(map(repr, a)) == sorted(map(repr, b))


def setting(spark):
    model = TreeModel(["x", "y"], [Node(feature=0, threshold=1.0, gain=2.0, left=Node(0.5), right=Node(feature=1, threshold=0.0, gain=1.0, left=Node(-0.5), right=Node(0.1)))])
    meta = md.from_rows([{"name": "x", "db": "d", "table": "ed_a"}, {"name": "y", "db": "d", "table": "ed_b"}])
    config = {
        "sample": {"key": "apply_no", "keys": {"cert_no": "cert_no"}}, "output": {"keep_columns": ["apply_no"], "variable_output": {"enabled": True, "top_n": 1}},
        "time_range_joins": {"d.ed_b, d.other": {"match_mode": "range", "time_field": "dt", "sample_time_field": "issue", "time_function": "MONTHS_BETWEEN", "window": 2}},
        "blacklist_vars": ["y"],
    }
    frames = {
        "d.ed_a": spark.createDataFrame([("1", 0.5), ("2", 3.0)], "cert_no string, x double"),
        "d.ed_b": spark.createDataFrame([("2", 7.0, "20240101"), ("2", -7.0, "20240301"), ("2", 9.0, "20240601")], "cert_no string, y double, dt string"),
    }
    rows = spark.createDataFrame([("a", "1", "20240310"), ("b", "2", "20240310"), ("c", "3", "20240310"), ("d", "2", "20240901")], "apply_no string, cert_no string, issue string")
    return ScoringPipeline(model, meta, config), rows, frames


def test_scoring_pipeline(spark, tmp_path):
    made, rows, frames = setting(spark)
    wide = {r.apply_no: (r.x, r.y) for r in made.wide(rows, planner.from_frames(frames)).collect()}
    assert wide == {"a": (0.5, None), "b": (3.0, -7.0), "c": (None, None), "d": (3.0, None)}
    got = {r.apply_no: r for r in made.run(rows, planner.from_frames(frames)).collect()}
    assert got["c"].all_null_flag == 1 and got["c"].score_card == -999999
    assert got["b"].score < 0.5 < got["a"].score and "x" in got["a"].asDict()
    assert "blacklisted" in made.report()
    made.save_sql(str(tmp_path / "x.sql"), "smp", rows.columns)
    assert "CREATE TABLE wide_table" in (tmp_path / "x.sql").read_text()


def test_partition_rule():
    c = planner.Config(biz_date="20240101")
    assert c.partition("t", "p", "c", "dt") == ("dt", "=", "20240101")
    assert planner.Config().partition("t", "p", "c", "dt") is None
    c.partition_control = {"default": {"enabled": False}, "platform:p": {"min_partition": "2023", "partition_field": "pt"}}
    assert c.partition("t", "q", "c", "dt") is None and c.partition("t", "p", "c", "dt") == ("pt", ">=", "2023")
    c = planner.Config(biz_date="20240101", time_ranges={"t": planner.TimeRange()})
    assert c.partition("t", "p", "c", "dt") is None


def test_names_in_another_case(spark):
    """A model's features in capitals, from metadata to the scored table."""
    made, rows, frames = setting(spark)
    upper = TreeModel(["X", "Y"], made.model.trees)
    got = ScoringPipeline(upper, made.metadata, made.config).run(rows, planner.from_frames(frames)).collect()
    want = made.run(rows, planner.from_frames(frames)).collect()
    pick = lambda rs: sorted((r.apply_no, r.score, r.all_null_flag, r.score_card) for r in rs)
    assert pick(got) == pick(want)


def test_categories_of_the_text_format(spark):
    from riskspark.operators import scoring
    from riskspark.queries.modelling import CATEGORICAL
    from riskspark.sources.model_text import parse_json, parse_text

    model = parse_text(CATEGORICAL)
    assert model.trees[0].categories == (3, 4, 33, 40) and model.steepness() == 0.5
    again = parse_json(json.dumps(model.dump()))
    assert again.dump() == model.dump()
    df = spark.createDataFrame([(0.0, 1.0), (3.0, 1.0), (40.0, 9e9), (2.0, 1.0), (7.0, 1.0), (None, 5e4)], "f_quantity double, f_price double")
    raw = [r.tree_0_score for r in scoring.tree_scores(df, again).collect()]
    assert raw == [0.25, 1.5, 1.5, -0.75, 0.25, -2.0]
    with pytest.raises(ValueError, match="categories"):
        parse_text(CATEGORICAL.replace("cat_threshold", "other"))


@pytest.mark.parametrize("change", [("num_class=1", "num_class=3"), ("objective=binary sigmoid:0.5", "objective=regression")])
def test_models_without_one_probability_are_refused(spark, change):
    from riskspark.operators import scoring
    from riskspark.queries.modelling import CATEGORICAL
    from riskspark.sources.model_text import parse_text

    model = parse_text(CATEGORICAL.replace(*change))
    with pytest.raises(ValueError, match="probability"):
        scoring.score(spark.createDataFrame([(1.0, 2.0)], "f_quantity double, f_price double"), model, [])


def test_cuts_of_a_wide_table(spark, sf_dir):
    base, frames, config = assembly._wide(spark, sf_dir)
    meta = assembly.metadata()
    config.cut_every, made = 2, []
    cut = planner.Cuts(spark)
    planner.lower(planner.plan(meta, assembly.WIDE, config), meta, base, planner.from_frames(frames), config, lambda df: made.append(df) or cut(df))
    assert len(made) == 2
    cut.clear()


def test_as_of_rows_without_key_or_time(spark):
    from riskspark.operators import joins

    s = spark.createDataFrame([(1, "a", "2024-01-10"), (2, None, "2024-01-10"), (3, "a", None), (4, "b", "2024-01-10")], "id int, k string, t string").withColumn("t", F.to_date("t"))
    h = spark.createDataFrame([("a", "2024-01-05", 7), (None, "2024-01-05", 8)], "hk string, ht string, v int").withColumn("ht", F.to_date("ht"))
    got = {r.id: r.v for r in joins.as_of(s, h, ("k", "hk"), ("t", "ht"), ["v"], 30).collect()}
    assert got == {1: 7, 2: None, 3: None, 4: None}


def test_run_command(spark, tmp_path):
    from riskspark.__main__ import main

    made, rows, frames = setting(spark)
    args = []
    for name, df in frames.items():
        df.write.parquet(str(tmp_path / name))
        args += ["--table", f"{name}={tmp_path / name}"]
    rows.write.parquet(str(tmp_path / "s.parquet"))
    (tmp_path / "c.yaml").write_text(json.dumps(made.config))
    (tmp_path / "m.json").write_text(json.dumps(made.model.dump()))
    md.save(made.metadata, str(tmp_path / "meta.json"))
    p = lambda n: str(tmp_path / n)
    assert main(["run", "--config", p("c.yaml"), "--model", p("m.json"), "--metadata", p("meta.json"), "--sample", p("s.parquet"), *args, "-o", p("out"), "--report", p("r.md"), "--sql", p("q.sql")]) == 0
    assert spark.read.parquet(p("out")).count() == 4 and "# wide table" in (tmp_path / "r.md").read_text()


def test_scorecards_and_models_in_memory(tmp_path):
    import pandas as pd

    from riskspark.queries.modelling import MODEL
    from riskspark.sources import model_text
    from riskspark.sources.scorecards import StoredScorecard

    class Plain:
        pass

    binner = Plain()
    binner.varlist, binner.ivtable = ["a"], pd.Series([0.4], index=["a"])
    binner.bins = {"a": pd.Series([pd.Interval(-float("inf"), 2.0), pd.Interval(2.0, float("inf"))])}
    binner.woetables = {"a": pd.DataFrame({"Good": [10, 5], "Bad": [1, 4], "WoE": [-0.5, 0.7], "IV": [0.1, 0.2]})}
    alone = StoredScorecard.from_object(binner)
    assert alone.features() == ["a"] and not alone.has_model() and alone.iv("a") == 0.4 and alone.bins("a") == [(-float("inf"), 2.0), (2.0, float("inf"))]
    card = Plain()
    card.binner, card.score_card_result = binner, pd.DataFrame({"name": ["a", "a"], "left": [-float("inf"), 2.0], "right": [2.0, float("inf")], "score": [5, 0]}).set_index("name")
    card.show_model_result = lambda: pd.DataFrame({"Parameter": ["intercept", "a"], "Estimate": [-4.0, -0.8], "Wald-Chi2": [600.0, 18.0], "P-value": ["<.0001", "<.0001"]})
    StoredScorecard.from_object(card).save(str(tmp_path / "s.json"))
    back = StoredScorecard.load(str(tmp_path / "s.json"))
    assert back == StoredScorecard.from_object(card) and back.wald_order() == ["a"] and back.has_model() and [p.score for p in back.points()] == [5.0, 0.0]
    with pytest.raises(ValueError, match="Scorecard"):
        StoredScorecard.from_object({"not": "a scorecard"})
    booster, wrapper = Plain(), Plain()
    booster.model_to_string = lambda: MODEL
    wrapper.booster_ = booster
    assert model_text.from_object(wrapper).dump() == model_text.from_object(booster).dump() == model_text.parse_text(MODEL).dump()
    with pytest.raises(ValueError):
        model_text.from_object(Plain())


def test_ks_table(spark, sf_dir):
    got = woe.ks_table(sample(spark, sf_dir), ["f_price", "f_tax"], "bad").collect()
    for r in got:
        assert r.p_value == pytest.approx(woe.kolmogorov_p(r.ks, r.goods, r.bads), abs=1e-9)
    assert got[0].ks >= got[1].ks


def test_fill(spark):
    df = spark.createDataFrame([(1.0, "b", "2024-01-02", 3), (float("nan"), None, None, None), (None, "a", "2024-01-01", 5), (-1.0, "b", None, 7)], "x double, s string, d string, n int").withColumn("d", F.to_date("d"))
    got = features.fill(df, {"x": -9.0}, {"x": -1.0}).collect()
    assert [r.x for r in got] == [1.0, -9.0, -9.0, -9.0]
    got = features.fill_by_type(df).collect()
    assert got[1].x == -999999 and got[1].s == "b" and str(got[1].d) == "2024-01-02" and got[1].n == -999999


def test_cut_points_and_woe_frame(spark):
    assert binning.cut_points([1, 2])[1:3] == [1, 2]
    with pytest.raises(ValueError):
        binning.cut_points([2, 1])
    df = spark.createDataFrame([(1, 0.5), (2, 1.5), (3, None)], "id int, x double")
    got = [r.x for r in binning.woe_frame(df, {"x": ([1.0], [0.3, -0.4])}, ["id"]).orderBy("id").collect()]
    assert got == [0.3, -0.4, 0.0]
