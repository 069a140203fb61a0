from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellpulse.config import GridConfig
from cellpulse.functions import parsing, scores
from cellpulse.operators import classification, dashboard, ensemble, fairness, histograms, predictions, profile, report, summaries


def test_risk_rules_at_their_edges(spark):
    values = [-0.1, 0.0, 0.5, 1.0, 3.0, 3.1, 100.0, 101.0]
    config = GridConfig()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i")
    made = df.select(
        scores.bounded_risk(F.col("v"), config.bounded_risk_edges).alias("b"),
        scores.open_risk(F.col("v"), config.open_risk_edges).alias("o"),
    ).collect()
    assert [r.b for r in made] == [None, None, "Low", "Low", "Medium", "High", "High", None]
    assert [r.o for r in made] == ["Low", "Low", "Low", "Low", "Medium", "High", "High", "High"]


def test_parsing_turns_unreadable_text_into_null(spark):
    texts = ["03/18/2015 07:44:00 PM", "2024-02-29 01:02:03", "2023-02-29", "2024-05-06T07:08:09", "soon", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    made = [str(r[0]) for r in df.select(parsing.parse_timestamp(F.col("t"))).collect()]
    assert made == ["2015-03-18 19:44:00", "2024-02-29 01:02:03", "None", "2024-05-06 07:08:09", "None", "None", "None"]
    numbers = spark.createDataFrame([(" 4.5 ",), ("x",), (None,)], "t string")
    assert [r[0] for r in numbers.select(parsing.parse_number(F.col("t"))).collect()] == [4.5, None, None]


@pytest.fixture(scope="module")
def scored(spark):
    chance = np.random.default_rng(9)
    frame = pd.DataFrame(
        {
            "cell_id": [f"c{i % 30}" for i in range(300)],
            "time_window": pd.Timestamp("2024-01-01") + pd.to_timedelta(6 * (np.arange(300) // 30), unit="h"),
            "target": chance.integers(0, 7, 300).astype(float),
            "ultra_predicted": chance.gamma(2.0, size=300),
        }
    )
    frame["ultra_error"] = (frame.target - frame.ultra_predicted).abs()
    return frame, spark.createDataFrame(frame)


def test_accuracy_equals_numpy(scored):
    frame, df = scored
    made = report.accuracy(df).first()
    error = frame.target - frame.ultra_predicted
    assert made.rmse == pytest.approx(np.sqrt((error**2).mean()))
    assert made.median_error == pytest.approx(error.abs().median())
    assert made.r2 == pytest.approx(1 - (error**2).sum() / ((frame.target - frame.target.mean()) ** 2).sum())
    assert made.mape == pytest.approx((error / (frame.target + 1)).abs().mean() * 100)


def test_r2_of_a_constant_target_is_zero(spark):
    df = spark.createDataFrame([(2.0, 1.0, 1.0), (2.0, 3.0, 1.0)], "target double, ultra_predicted double, ultra_error double")
    assert report.accuracy(df).first().r2 == 0.0


def test_concentration_equals_pandas(scored):
    frame, df = scored
    totals = frame.groupby("cell_id").ultra_predicted.sum().sort_values(ascending=False)
    made = report.concentration(df).first()
    assert made.top_hotspot_id == totals.index[0]
    assert made.top_10_share == pytest.approx(totals.head(10).sum() / totals.sum() * 100)
    assert made.top_20_share == pytest.approx(totals.head(20).sum() / totals.sum() * 100)


def test_qq_points_equal_numpy(scored):
    frame, df = scored
    made = report.qq_points(predictions.residuals(df)).orderBy("probability").toPandas()
    np.testing.assert_allclose(made.observed, np.quantile(frame.target - frame.ultra_predicted, made.probability))
    np.testing.assert_allclose(made.theoretical, [NormalDist().inv_cdf(p) for p in made.probability])


def test_tall_report_keeps_numbers_and_texts(spark):
    one = spark.createDataFrame([(1, "a", 2.5)], "x int, y string, z double")
    made = {(r.section, r.metric): (r.number, r.text) for r in report.tall({"s": one, "t": one.select("y")}).collect()}
    assert made == {("s", "x"): (1.0, None), ("s", "y"): (None, "a"), ("s", "z"): (2.5, None), ("t", "y"): (None, "a")}


def test_recent_rows_and_map_sample(spark, scored):
    _, df = scored
    recent = predictions.recent_rows(df, 45)
    assert recent.count() == 45 and recent.agg(F.min("time_window")).first()[0] == pd.Timestamp("2024-01-03 00:00:00")
    full = predictions.with_open_risk(df, GridConfig()).withColumns(
        {"cell_center_lat": F.lit(41.7), "cell_center_lon": F.lit(-87.7)}
    )
    cut = dashboard.map_layer(full, sample=7)
    assert cut.count() == 7
    assert {r.cell_id for r in cut.collect()} == {r.cell_id for r in dashboard.map_layer(full.repartition(9), sample=7).collect()}


def test_hex_density_counts_every_point(scored):
    _, df = scored
    made = histograms.hex_density(df, "target", "ultra_predicted").toPandas()
    assert made.n.sum() == 300 and (made.n >= 1).all()


def test_weights_equal_direct_search(spark):
    chance = np.random.default_rng(12)
    y = chance.random(200)
    frame = pd.DataFrame({"target": y, **{f"m{i}": y + chance.normal(size=200) * s for i, s in enumerate((0.3, 0.2, 0.5, 0.1))}})
    names = ["m0", "m1", "m2", "m3"]
    df = spark.createDataFrame(frame)
    assert ensemble.weight_grid(df, names).count() == 1771
    best, found = math.inf, None
    for a in range(21):
        for b in range(21 - a):
            for c in range(21 - a - b):
                w = np.array([a, b, c, 20 - a - b - c]) / 20
                loss = np.sqrt(((y - frame[names].to_numpy() @ w) ** 2).mean())
                if loss < best - 1e-15:
                    best, found = loss, w
    made = ensemble.best_weights(df, names).first()
    assert [made.w0, made.w1, made.w2, made.w3] == list(found)
    assert made.rmse == pytest.approx(best)


def test_weights_tie_goes_to_the_first_combination(spark):
    df = spark.createDataFrame([(1.0, 2.0, 2.0), (3.0, 1.0, 1.0)], "target double, a double, b double")
    made = ensemble.best_weights(df, ["a", "b"]).first()
    assert (made.w0, made.w1) == (0.0, 1.0)


def test_class_metrics_with_an_unpredicted_class(spark):
    pairs = [(0, 0), (0, 0), (1, 0), (2, 0), (2, 2)]
    df = spark.createDataFrame(pairs, "y int, p int")
    made = classification.class_metrics(df, "y", "p").first()
    assert made.accuracy == pytest.approx(0.6)
    assert made.precision == pytest.approx((2 * 2 / 4 + 0 + 2 * 1.0) / 5)
    assert made.recall == pytest.approx((2 * 1.0 + 0 + 2 * 0.5) / 5)
    assert made.f1 == pytest.approx((2 * (4 / 6) + 0 + 2 * (2 / 3)) / 5)
    dense = {(r.actual, r.predicted): r.n for r in classification.confusion(df, "y", "p", dense=True).collect()}
    assert len(dense) == 9 and dense[0, 1] == 0 and dense[2, 0] == 1


def test_auc_counts_pairs(spark):
    chance = np.random.default_rng(3)
    frame = pd.DataFrame({"y": chance.integers(0, 2, 80), "s": chance.integers(0, 9, 80).astype(float)})
    pos, neg = frame[frame.y == 1].s.to_numpy(), frame[frame.y == 0].s.to_numpy()
    wins = (pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean()
    df = spark.createDataFrame(frame)
    assert classification.roc_auc(df, "y", "s").first().auc == pytest.approx(wins)
    curve = classification.roc_points(df, "y", "s").orderBy(F.desc_nulls_first("threshold")).toPandas()
    assert curve.fpr.is_monotonic_increasing and curve.tpr.is_monotonic_increasing
    assert tuple(curve.iloc[-1][["fpr", "tpr"]]) == (1.0, 1.0)


def test_auc_needs_two_classes(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.5)], "y int, s double")
    assert classification.roc_auc(df, "y", "s").first().auc is None


def test_fairness_edges(spark):
    schema = "y int, p int, g string"
    single = spark.createDataFrame([(1, 1, "a"), (0, 0, "a")], schema)
    assert fairness.disparate_impact(single, "y", "p", "g").first().disparate_impact is None
    none = spark.createDataFrame([(1, 0, "a"), (0, 0, "b")], schema)
    made = fairness.fairness_report(none, "y", "p", "g").first()
    assert (made.disparate_impact, made.demographic_parity, made.equal_opportunity) == (0.0, 0.0, 0.0)
    assert (made.impact_passes, made.parity_passes) == (False, True)
    groups = {r.group: r.true_positive_rate for r in fairness.group_rates(none, "y", "p", "g").collect()}
    assert groups == {"a": 0.0, "b": 0.0}


def test_roles_are_checked_by_value(spark):
    df = spark.createDataFrame(
        [("2024-01-01", 7.0, 41.9, -87.6, "a")], "`Date Reported` string, Platform double, Latitude double, Longitude double, `Primary Type` string"
    )
    made = {r.role: r.column for r in profile.detect_roles(df).collect()}
    assert made == {"date": "Date Reported", "latitude": "Latitude", "longitude": "Longitude", "category": "Primary Type"}
    far = df.withColumn("Latitude", F.lit(10.0))
    assert {r.role: r.column for r in profile.detect_roles(far).collect()}["latitude"] is None
    assert profile.detect_roles_by_name(df)["latitude"] == "Platform"


def test_null_category_never_ranks(spark):
    df = spark.createDataFrame([(c,) for c in [None] * 5 + ["a"] * 2 + ["b"]], "category string")
    made = profile.top_categories(df, k=5).orderBy("n").collect()
    assert [(r.category, r.n, r.distinct_categories) for r in made] == [("b", 1, 2), ("a", 2, 2)]
    assert made[1].share_pct == pytest.approx(25.0)


def test_correlation_skips_incomplete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 7.0), (4.0, 1.0)], "a double, b double")
    made = {(r.column_a, r.column_b): r.r for r in summaries.corr_matrix(df, ["a", "b"]).collect()}
    expected = pd.DataFrame({"a": [1, 3, 4], "b": [2, 7, 1]}).corr().loc["a", "b"]
    assert made["a", "b"] == pytest.approx(expected) and made["b", "a"] == made["a", "b"] and made["a", "a"] == 1.0


def test_density_pivot_equals_long_form(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (0, 2), (3, 2)], "grid_lat_idx int, grid_lon_idx int")
    wide = {r.grid_lat_idx: (r["0"], r["2"]) for r in summaries.density_pivot(df, [0, 2]).collect()}
    assert wide == {0: (2, 1), 3: (0, 1)}
    long = {(r.grid_lat_idx, r.grid_lon_idx): r.n for r in summaries.density_matrix(df, dense=True).collect()}
    assert long == {(0, 0): 2, (0, 2): 1, (3, 0): 0, (3, 2): 1}


def test_empty_predictions_do_not_fail(spark, scored):
    _, df = scored
    none = predictions.with_open_risk(df.where("false"), GridConfig()).withColumns({"hour": F.lit(1.0), "is_weekend": F.lit(0)})
    for build in (report.accuracy, report.tiers, report.prediction_figures, report.risk_distribution, report.concentration,
                  report.baseline, report.hours, report.error_percentiles, dashboard.metrics, dashboard.overview):
        build(none).collect()
    assert report.preventable(none, GridConfig()).first()[0] is None


def test_correlations_do_not_depend_on_the_number_of_scans(spark):
    chance = np.random.default_rng(5)
    names = list("abcde")
    frame = pd.DataFrame(chance.normal(size=(60, 5)), columns=names)
    df = spark.createDataFrame(frame)
    for pairs in (200, 3):
        made = summaries.corr_matrix(df, names, pairs_per_scan=pairs).toPandas()
        wide = made.pivot(index="column_a", columns="column_b", values="r").loc[names, names]
        np.testing.assert_allclose(wide, frame.corr())


def test_recent_rows_equal_a_sort(scored):
    _, df = scored
    for n in (1, 17, 299, 300, 1000):
        expected = df.orderBy(F.desc("time_window"), F.desc("cell_id")).limit(n)
        assert predictions.recent_rows(df, n).exceptAll(expected).isEmpty()
        assert predictions.recent_rows(df, n).count() == min(n, 300)
