from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellpulse.operators import models

INPUTS = ["a", "b", "c"]
FOREST = models.ForestParams(trees=5, depth=4)
BOOST = models.BoostParams(rounds=4, depth=3, step=0.3)


@pytest.fixture(scope="module")
def rows(spark):
    chance = np.random.default_rng(21)
    frame = pd.DataFrame(chance.normal(size=(240, 3)), columns=INPUTS)
    frame["target"] = np.maximum(0, 3 * frame.a - 2 * frame.b + chance.normal(size=240) * 0.2 + 4)
    frame["time_window"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(6 * (np.arange(240) // 12), unit="h")
    frame["grid_lat_idx"], frame["grid_lon_idx"] = np.arange(240) % 12, 0
    return spark.createDataFrame(frame).cache()


def baseline(df):
    return df.agg(F.stddev_pop("target")).first()[0]


def test_regressors_beat_the_mean(rows):
    fitted = models.fit_all(models.regressors(FOREST, BOOST, BOOST), models.with_weight(rows), INPUTS)
    scored = models.score(fitted, rows)
    for name in fitted:
        assert models.rmse(scored, name) < baseline(rows), name


def test_fits_are_repeatable(rows):
    made = [
        models.score({"m": models.fit(models.forest(FOREST), rows, INPUTS)}, rows).agg(F.sum("m")).first()[0]
        for _ in range(2)
    ]
    assert made[0] == made[1]


def test_saved_model_predicts_the_same(rows, tmp_path):
    model = models.fit(models.boosted(BOOST), rows, INPUTS)
    models.save_model(model, str(tmp_path / "m"))
    both = models.score({"old": model, "new": models.load_model(str(tmp_path / "m"))}, rows)
    assert both.where("old <> new").isEmpty()


def test_settings_roundtrip(spark, tmp_path):
    settings = {"weights": [0.5, 0.5], "features": INPUTS}
    models.save_settings(spark, settings, str(tmp_path / "s"))
    assert models.load_settings(spark, str(tmp_path / "s")) == settings


def test_ridge_equals_closed_form(rows):
    frame = rows.select(*INPUTS, "target").toPandas()
    x = frame[INPUTS] - frame[INPUTS].mean()
    y = frame.target - frame.target.mean()
    expected = np.linalg.solve(x.T @ x + np.eye(3), x.T @ y)
    made = models.ridge(rows, INPUTS).stages[-1]
    np.testing.assert_allclose(made.coefficients.toArray(), expected, rtol=1e-8)
    assert made.intercept == pytest.approx(frame.target.mean() - frame[INPUTS].mean() @ expected)


def test_stack(rows):
    learners = {"forest": models.forest(FOREST), "boosted": models.boosted(BOOST)}
    stacked = models.fit_stack(learners, rows, INPUTS).apply(rows)
    assert models.rmse(stacked, "stacked") < baseline(rows)
    assert {"forest", "boosted", "stacked"} <= set(stacked.columns)


def test_tuning_is_seeded_and_sorted(rows):
    drawn = models.draw_trials(models.BoostParams(rounds=2), 3)
    assert drawn == models.draw_trials(models.BoostParams(rounds=2), 3)
    assert all(6 <= p.depth <= 12 and 0.01 <= p.step <= 0.1 for p in drawn)
    ranked = models.tune(drawn[:2], rows, rows, INPUTS).toPandas()
    assert ranked.rmse.is_monotonic_increasing and len(ranked) == 2


def test_importance_prefers_what_matters(rows):
    fitted = {"forest": models.fit(models.forest(FOREST), rows, INPUTS)}
    made = {r.feature: r.importance for r in models.importance(fitted, INPUTS, {"forest": 1.0}).collect()}
    assert made["c"] < made["a"] and sum(made.values()) == pytest.approx(1.0)


@pytest.mark.parametrize("classes", [2, 3])
def test_classifiers(rows, classes):
    labelled = rows.withColumn("label", F.least(F.floor(F.col("target") / 4), F.lit(classes - 1)).cast("int"))
    learners = models.classifiers("label", classes, trees=3, depth=3)
    made = models.classify(models.fit_all(learners, labelled, INPUTS), labelled)
    common = labelled.groupBy("label").count().agg(F.max("count")).first()[0] / labelled.count()
    for name in learners:
        assert made.where(F.col(name) == F.col("label")).count() / 240 > common, name
    assert made.where(~F.col("forest_confidence").between(0, 1)).isEmpty()


def test_a_task_of_a_fit_holds_few_rows(rows, monkeypatch):
    one = rows.coalesce(1)
    learner = models.forest(FOREST)
    assert models.dealt(one, learner, 3) is one
    each = 8 * 3 + 4 * FOREST.trees + models.ROW_BYTES
    spread = models.dealt(one, learner, 3, 20 * each)
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    # Each of the eight partitions that are dealt out can add a row to the even share of 20.
    assert sum(sizes) == 240 and max(sizes) <= 28
    assert spread.exceptAll(rows).isEmpty()
    held = []
    monkeypatch.setattr(models, "dealt", lambda train, *args: held.append(args) or spread)
    fitted = models.fit(learner, one, INPUTS)
    assert held == [(learner, 3)]
    assert models.rmse(models.score({"m": fitted}, rows), "m") < baseline(rows)


def test_a_fit_of_no_rows_is_not_dealt(rows):
    none = rows.limit(0)
    assert models.dealt(none, models.forest(FOREST), 3, 1) is none
