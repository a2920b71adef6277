import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskspark.functions import missing, month_key, np_round
from riskspark.operators import binning, curves, performance, quality, running, stability, woe


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def auc_ks(spark, rows):
    df = frame(spark, rows, "bad int, score double, w double")
    return curves.auc_ks(curves.tallies(df, [], "score", "bad", "w"), []).first()


def test_perfect_separation(spark):
    r = auc_ks(spark, [(1, 1.0, 1.0), (1, 2.0, 1.0), (0, 3.0, 1.0), (0, 4.0, 1.0)])
    assert (r.auc, r.ks) == (1.0, 1.0)


def test_reversed_score_has_no_lead(spark):
    r = auc_ks(spark, [(0, 1.0, 1.0), (1, 2.0, 1.0)])
    assert (r.auc, r.ks) == (0.0, 0.0)


def test_one_class_has_no_curve(spark):
    r = auc_ks(spark, [(0, 1.0, 1.0), (0, 2.0, 1.0), (None, 3.0, 1.0)])
    assert r.auc is None and r.ks is None


def test_auc_with_ties_and_weights(spark):
    draw = random.Random(1)
    rows = [(draw.randint(0, 1), float(draw.randint(0, 9)), float(draw.randint(1, 5))) for _ in range(200)]
    good, bad = [r for r in rows if r[0] == 0], [r for r in rows if r[0] == 1]
    pairs = sum(g[2] * b[2] * ((g[1] > b[1]) + 0.5 * (g[1] == b[1])) for g in good for b in bad)
    want = pairs / sum(g[2] for g in good) / sum(b[2] for b in bad)
    lead = max(sum(g[2] for g in good if g[1] >= t) / sum(g[2] for g in good) - sum(b[2] for b in bad if b[1] >= t) / sum(b[2] for b in bad) for t in range(10))
    r = auc_ks(spark, rows)
    assert r.auc == pytest.approx(want) and r.ks == pytest.approx(max(lead, 0))


def test_quantiles_interpolate(spark):
    df = frame(spark, [("a", 1.0), ("a", 2.0), ("a", 10.0), ("b", 5.0), ("b", None)], "g string, v double")
    got = {(r.g, r.share): r.quantile for r in running.quantiles(df, ["g"], "v", [0.05, 0.5, 1.0]).collect()}
    assert got[("a", 0.05)] == pytest.approx(1.1) and got[("a", 1.0)] == 10 and got[("b", 0.5)] == 5


def test_quantiles_equal_numpy(spark):
    values = np.random.default_rng(0).integers(0, 500, 5000).astype(float) / 7
    shares = [k / 20 for k in range(21)]
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    got = {r.share: r["quantile"] for r in running.quantiles(df, [], "v", shares).collect()}
    assert [got[s] for s in shares] == pytest.approx(np.quantile(values, shares).tolist())


def test_running_sum_over_buckets(spark):
    df = frame(spark, [(i % 7, float(i), 1) for i in range(1000)], "g int, v double, n int")
    got = {(r.g, r.v): r.before for r in running.running(df, ["g"], ["v"], {"before": "n"}, buckets=8).collect()}
    assert all(b == int(v) // 7 for (_, v), b in got.items())


def test_right_and_left_closed(spark):
    df = frame(spark, [(0.0,), (1.0,), (1.5,), (2.0,), (None,)], "x double")
    got = df.select(binning.right_closed("x", [1.0, 2.0]).alias("r"), binning.left_closed("x", [1.0, 2.0]).alias("l")).collect()
    assert [r.r for r in got] == [0, 0, 1, 1, None] and [r.l for r in got] == [0, 1, 1, 2, None]


def test_equal_width_edges(spark):
    df = frame(spark, [(0.0,), (10.0,)], "x double")
    assert binning.equal_width_edges(df, "x", 5) == pytest.approx(pd.cut([0.0, 10.0], 5, retbins=True)[1].tolist())


def test_missing_rule(spark):
    df = frame(spark, [(1.0, "a"), (-99999.0, " "), (float("nan"), "nan"), (None, None), (-99998.0, "-999999")], "x double, s string")
    got = df.select(missing(F.col("x"), "double").alias("x"), missing(F.col("s"), "string").alias("s")).collect()
    assert [r.x for r in got] == [False, True, True, True, False]
    assert [r.s for r in got] == [False, True, True, True, True]


def test_month_and_rounding(spark):
    df = frame(spark, [("2025-1-6", 1.015), ("20250106", 0.125), ("none", 2.5)], "d string, x double")
    got = df.select(month_key(F.col("d"), "string").alias("m"), np_round(F.col("x"), 2).alias("r")).collect()
    assert [r.m for r in got] == [202501, 202501, None]
    assert [r.r for r in got] == [np.round(1.015, 2), np.round(0.125, 2), 2.5]


def test_psi_of_equal_distributions_is_zero(spark):
    df = frame(spark, [(float(i % 50), f) for i in range(500) for f in ("train", "oot")], "score double, flag string")
    bins = stability.score_psi_bins(df, "score", F.col("flag") == "train", F.col("flag") == "oot")
    assert stability.total_psi(bins).first().psi == pytest.approx(0)


def test_psi_with_an_empty_bin_is_finite(spark):
    df = frame(spark, [(float(i), "train") for i in range(100)] + [(1.0, "oot")] * 10, "score double, flag string")
    psi = stability.total_psi(stability.score_psi_bins(df, "score", F.col("flag") == "train", F.col("flag") == "oot")).first().psi
    assert math.isfinite(psi) and psi > 1


def test_lift(spark):
    df = frame(spark, [(float(i), int(i < 10)) for i in range(100)], "s double, bad int")
    r = performance.lift(df, "s", "bad").first()
    assert (r.n, r.lift_10, r.lift_5) == (100, 10, 10)
    r = performance.lift(df.limit(30), "s", "bad").first()
    assert r.lift_1 == 0


def test_last_cumulative_share_is_one(spark):
    df = frame(spark, [(float(i % 37), i % 3 // 2) for i in range(400)], "s double, bad int")
    rows = performance.bin_metrics(df, "s", "bad", 10).orderBy("bin").collect()
    assert rows[-1].cum_bads_prop == 1 and sum(r.total for r in rows) == 400


def test_class_sizes_sum():
    assert sum(performance.class_sizes(997, performance.CLASSES)) == 997
    with pytest.raises(ValueError):
        performance.class_sizes(10, {"A": 0.5})


def test_risk_classes_keep_bins_whole(spark):
    draw = random.Random(3)
    rows = [(float(draw.randint(300, 900)), int(draw.random() < 0.1)) for _ in range(3000)]
    got = {r["class"]: r for r in performance.risk_classes(frame(spark, rows, "s double, bad int"), "s", "bad").collect()}
    ordered = [got[c] for c in "ABCDE"]
    assert sum(r.n for r in ordered) == 3000
    assert all(a.low > b.high for a, b in zip(ordered, ordered[1:], strict=False))


def test_two_sample_ks(spark):
    rows = [(0, float(i)) for i in range(50)] + [(1, float(i + 25)) for i in range(50)] + [(1, -999999.0)]
    r = woe.two_sample_ks(frame(spark, rows, "bad int, x double"), ["x"], "bad").first()
    assert r.ks == pytest.approx(0.5) and r.missing_rate == pytest.approx(1 / 101)
    assert 0 < woe.kolmogorov_p(r.ks, r.goods, r.bads) < 0.001


def plain_monotonic(x, y, parts=20):
    """The report's merge, written with lists, to hold the operator against."""
    n, bads = len(x), sum(y)
    valid = [(v, t) for v, t in zip(x, y, strict=True) if v > -99999]
    k = parts if len(valid) >= parts * 10 else max(5, len(valid) // 10)
    cuts = np.unique(np.percentile([v for v, _ in valid], np.linspace(0, 100, k + 1)[1:-1]))
    idx = np.digitize([v for v, _ in valid], cuts)
    micro = [[sum(1 for i, (_, t) in zip(idx, valid, strict=True) if i == b and t == c) for c in (0, 1)] for b in range(len(cuts) + 1)]
    micro = [m for m in micro if sum(m)]
    bins, cur = [], [0, 0]
    for m in micro:
        nxt = [cur[0] + m[0], cur[1] + m[1]]
        if sum(nxt) / n > 0.5:
            bins.append(cur if sum(cur) else m)
            cur = m if sum(cur) else [0, 0]
        elif sum(nxt) / n >= 0.03:
            bins.append(nxt)
            cur = [0, 0]
        else:
            cur = nxt
    if sum(cur):
        if sum(cur) / n < 0.03 and bins:
            bins[-1] = [bins[-1][0] + cur[0], bins[-1][1] + cur[1]]
        else:
            bins.append(cur)
    value = lambda b: round(math.log(max(b[1] / bads, 1e-10) / max(b[0] / (n - bads), 1e-10)), 4)

    def merge(i):
        bins[i : i + 2] = [[bins[i][0] + bins[i + 1][0], bins[i][1] + bins[i + 1][1]]]

    def fall():
        return next((i for i in range(len(bins) - 1) if value(bins[i]) > value(bins[i + 1])), None)

    for _ in range(10):
        if (i := fall()) is None:
            break
        merge(i)
    while len(bins) > 6:
        merge(min(range(len(bins) - 1), key=lambda i: abs(value(bins[i]) - value(bins[i + 1]))))
        if (i := fall()) is not None:
            merge(i)
    for _ in range(10):
        if (i := fall()) is None:
            break
        merge(i)
    return bins


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_monotonic_bins_against_plain_version(spark, seed):
    draw = np.random.default_rng(seed)
    x = np.where(draw.random(2000) < 0.1, -999999.0, draw.normal(size=2000).round(2))
    y = (draw.random(2000) < 1 / (1 + np.exp(2 - x.clip(-3, 3) * (1 if seed != 2 else 0.1)))).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "bad": y}))
    got = [[r.good, r.bad] for r in binning.monotonic_bins(df, ["x"], "bad").orderBy("bin").collect()]
    assert got == plain_monotonic(x.tolist(), y.tolist())
    table = woe.monotonic_table(df, ["x"], "bad").orderBy("place").collect()
    assert sum(r.total for r in table) == 2000 and table[0].place == 0
    values = [r.woe for r in table if r.place]
    assert len(values) <= 6 and values == sorted(values)


def test_library_binning_can_fall(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=1000)
    y = (draw.random(1000) < 1 / (1 + np.exp(1 + x))).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "bad": y}))
    values = [r.woe for r in woe.library_table(df, "x", "bad", increasing=False).where("place > 0").orderBy("place").collect()]
    assert len(values) > 1 and values == sorted(values, reverse=True)
    with pytest.raises(ValueError):
        woe.library_table(df.withColumn("x", F.lit(1.0)), "x", "bad")


def test_hull_and_joined_edges():
    edges = binning.hull_edges([0, 1, 2, 3, 4], [10, 20, 30, 40], [40, 30, 20, 10])
    assert edges == [0, 1, 2, 3, 4]
    assert binning.hull_edges([0, 1, 2, 3], [10, 10, 10], [10, 10, 10])[0] == 0
    assert binning.joined_edges([0, 1, 2, 3, 4], [(1, 2)]) == [0, 1, 3, 4]
    with pytest.raises(ValueError):
        binning.joined_edges([0, 1, 2, 3, 4], [(0, 2), (1, 3)])
    assert binning.edges_from_texts(["missing", "2", "inf", "1"]) == [-math.inf, 1, 2, math.inf]


def test_fine_edges_isolate_the_fill(spark):
    df = frame(spark, [(float(i), -999.0 if i % 10 == 0 else i / 3) for i in range(200)], "a double, b double")
    edges = binning.fine_edges(df.withColumn("c", F.lit(1.0)), ["a", "b", "c"], {"b": -999.0})
    assert "c" not in edges and {-999.001, -999.0} <= set(edges["b"]) and edges["a"][0] == -math.inf


def test_validator_builds_all_checks(spark):
    df = frame(spark, [(202401, 1, 500.0, 1.0), (202402, 2, None, None)], "m int, apply_no int, score_card double, x double")
    checks = quality.Validator(df, df, ["x"], "m", "score_card").all_checks()
    assert len(checks) == 9 and all(c.rows.collect() is not None for c in checks)


def test_empty_sample(spark):
    empty = frame(spark, [], "bad int, score double, m int, w double")
    assert curves.group_metrics(empty, "m", "score", "bad", "w").count() == 0
    assert performance.lift(empty, "score", "bad", ["m"]).count() == 0
    assert binning.monotonic_bins(empty, ["score"], "bad").count() == 0
