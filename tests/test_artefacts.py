"""Bundles, trial ledgers, segmented boosting, roles by evidence, weightings of many models."""

from __future__ import annotations

import itertools
import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellpulse.operators import boosting, ensemble, ledger, models, profile, scaling
from cellpulse.sources import artefacts

INPUTS = ["x_scaled", "kind_code"]


@pytest.fixture(scope="module")
def fitted(spark):
    chance = np.random.default_rng(1)
    frame = pd.DataFrame({"x": chance.normal(5, 2, 200), "kind": chance.choice(["a", "b", "c"], 200)})
    frame["target"] = 2 * frame.x + (frame.kind == "b") * 3.0
    df = spark.createDataFrame(frame)
    codes = scaling.fit_codes(df, "kind")
    scaler = scaling.fit_standard(df, ["x"])
    ready = scaler.apply(scaling.encode(df, codes), "_scaled")
    made = {"tree": models.fit(models.forest(models.ForestParams(trees=5, depth=4)), ready, INPUTS), "line": models.ridge(ready, INPUTS)}
    importance = spark.createDataFrame([("x", 0.75), ("kind", 0.25)], "feature string, importance double")
    grid = spark.createDataFrame([(0.05, 10)], "cell_size_degrees double, total_cells long")
    return df, ready, artefacts.Bundle(made, INPUTS, {"tree": 0.25, "line": 0.75}, scaler, codes, grid, importance)


def test_a_loaded_bundle_scores_alike(spark, fitted, tmp_path):
    df, ready, bundle = fitted
    path = str(tmp_path / "b")
    bundle.save(spark, path)
    loaded = artefacts.Bundle.load(spark, path)
    want = models.score(bundle.models, ready).select("x", (F.col("tree") * 0.25 + F.col("line") * 0.75).alias("predicted"))
    got = loaded.score(df.drop("target")).select("x", "predicted")
    a, b = (sorted(map(tuple, d.collect())) for d in (want, got))
    np.testing.assert_allclose(a, b)
    assert loaded.importance.count() == 2 and loaded.grid.first().total_cells == 10


def test_unseen_texts_and_absent_inputs(spark, fitted, tmp_path):
    _, _, bundle = fitted
    bundle.save(spark, str(tmp_path / "b"))
    loaded = artefacts.Bundle.load(spark, str(tmp_path / "b"))
    new = spark.createDataFrame([("b", 5.0), ("new", 5.0), (None, 5.0)], "kind string, x double")
    found = {r.kind: r.predicted for r in loaded.score(new).collect()}
    assert found["new"] == found[None] != found["b"]
    assert loaded.score(new.drop("x")).where("predicted is null").count() == 0


def test_a_broken_bundle_is_refused(spark, fitted, tmp_path):
    df, _, bundle = fitted
    path = str(tmp_path / "b")
    with pytest.raises(ValueError, match="manifest"):
        artefacts.Bundle.load(spark, path)
    bundle.save(spark, path)
    settings = json.loads(spark.read.text(f"{path}/manifest").first()[0])

    def refused(change: dict, match: str):
        models.save_settings(spark, {**settings, **change}, f"{path}/manifest")
        with pytest.raises(ValueError, match=match):
            artefacts.Bundle.load(spark, path)

    refused({"version": 99}, "version")
    refused({"inputs": INPUTS[::-1]}, "other inputs")
    refused({"weights": {"gone": 1.0}}, "weights")
    refused({"models": ["tree", "gone"], "weights": {}}, "gone")
    refused({"parts": {**settings["parts"], "codes/kind": 99}}, "99")
    refused({"parts": {**settings["parts"], "absent": 1}}, "absent")
    refused({"scaler": {"columns": ["x"], "centers": [], "scales": []}}, "differ")
    models.save_settings(spark, settings, f"{path}/manifest")
    assert artefacts.Bundle.load(spark, path).score(df).count() == 200


def test_first_stored_importances(spark, tmp_path):
    df = spark.createDataFrame([("x", 0.5), ("y", 0.25)], "feature string, importance double")
    df.write.option("header", True).csv(str(tmp_path / "csv"))
    spark.createDataFrame([(1,)], "other int").write.parquet(str(tmp_path / "useless"))
    paths = [str(tmp_path / n) for n in ("absent", "useless", "csv")]
    assert artefacts.first_importance(spark, paths).exceptAll(df).isEmpty()
    with pytest.raises(FileNotFoundError):
        artefacts.first_importance(spark, paths[:2])


# --- ledger ------------------------------------------------------------------------------------------


def losses(learner, params):
    return round(params.step * 100 + params.depth / 100, 6)


def test_a_stopped_search_goes_on(spark, tmp_path):
    table = ledger.TrialLedger(spark, str(tmp_path / "l"))
    calls = []

    def failing(learner, params):
        calls.append((learner, params))
        if len(calls) == 4:
            raise RuntimeError("stopped")
        return losses(learner, params)

    with pytest.raises(RuntimeError):
        ledger.search(table, None, None, [], trials=5, parallelism=1, loss=failing)
    before = table.rows().count()
    assert 0 < before < 10
    again = []
    best = ledger.search(table, None, None, [], trials=5, loss=lambda n, p: again.append(n) or losses(n, p))
    assert len(again) == 10 - before and table.rows().count() == 10
    for learner, params in best.items():
        drawn = ledger.SPACES[learner](ledger.BASES[learner], 5, 42)
        assert losses(learner, params) == min(losses(learner, p) for p in drawn)
    assert ledger.search(table, None, None, [], trials=5, loss=None) == best
    assert [r.position for r in table.ranking().where("learner = 'boosted'").orderBy("rmse").collect()] == [1, 2, 3, 4, 5]


def test_two_searches_share_a_table(spark, tmp_path):
    table = ledger.TrialLedger(spark, str(tmp_path / "l"))
    params = ledger.BASES["boosted"]
    for loss in (2.0, 1.5):
        table.append("boosted", 0, params, loss)
    assert [tuple(r)[-1] for r in table.rows().collect()] == [1.5] and table.best("boosted") == params
    assert table.best("leafwise") is None


def test_drawn_settings_stay_in_their_ranges():
    for p in ledger.draw_leafwise(ledger.BASES["leafwise"], 50):
        assert 5 <= p.depth <= 8 and 0.01 <= p.step <= 0.1 and 0.6 <= p.subsample <= 0.95 and 10 <= p.min_leaf <= 50


def test_best_settings_of_fitted_trials(spark, tmp_path):
    chance = np.random.default_rng(2)
    frame = pd.DataFrame({"x": chance.normal(size=120)})
    frame["target"] = frame.x**2
    df = spark.createDataFrame(frame)
    table = ledger.TrialLedger(spark, str(tmp_path / "l"))
    bases = {"boosted": models.BoostParams(rounds=2, subset="all")}
    best = ledger.search(table, df, df, ["x"], trials=2, bases=bases)
    assert best["boosted"].rounds == 2 and table.rows().where("rmse > 0").count() == 2


# --- boosting ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def curve(spark):
    chance = np.random.default_rng(3)
    frame = pd.DataFrame({"x": chance.uniform(-3, 3, 300), "z": chance.normal(size=300)})
    frame["target"] = np.sin(frame.x) * 4 + 10
    return spark.createDataFrame(frame)


PARAMS = models.BoostParams(rounds=7, depth=3, step=0.5, subsample=1.0, subset="all", min_leaf=1)


def test_segments_add_up_to_one_model(spark, curve, tmp_path):
    run = boosting.SegmentedBoosting(spark, str(tmp_path / "a"), PARAMS, segment=3)
    model = run.fit(curve, ["x", "z"])
    assert run.finished() == 3 and len(model.stages[-1].trees) == 7
    assert list(model.stages[-1].treeWeights) == [0.5] * 7
    assert models.rmse(model.transform(curve), "prediction") < 0.6
    whole = boosting.SegmentedBoosting(spark, str(tmp_path / "b"), PARAMS, segment=7).fit(curve, ["x", "z"])
    a, b = (sorted(r[0] for r in m.transform(curve).select("prediction").collect()) for m in (model, whole))
    np.testing.assert_allclose(a, b, rtol=1e-6)
    models.save_model(model, str(tmp_path / "m"))
    assert models.load_model(str(tmp_path / "m")).stages[-1].getNumTrees == 7


def test_a_stopped_run_goes_on_where_it_was(spark, curve, tmp_path):
    run = boosting.SegmentedBoosting(spark, str(tmp_path / "a"), PARAMS, segment=3)
    assert run.fit(curve, ["x", "z"], stop_after=1) is None and run.finished() == 1
    again = boosting.SegmentedBoosting(spark, str(tmp_path / "a"), PARAMS, segment=3)
    model = again.fit(curve, ["x", "z"])
    straight = boosting.SegmentedBoosting(spark, str(tmp_path / "b"), PARAMS, segment=3).fit(curve, ["x", "z"])
    a, b = (sorted(r[0] for r in m.transform(curve).select("prediction").collect()) for m in (model, straight))
    np.testing.assert_allclose(a, b, rtol=1e-9)
    with pytest.raises(ValueError, match="other settings"):
        boosting.SegmentedBoosting(spark, str(tmp_path / "a"), PARAMS, segment=4).fit(curve, ["x", "z"])


# --- roles and weightings ----------------------------------------------------------------------------


def test_values_decide_over_names(spark):
    rows = [(f"0{1 + i % 9}/02/2024 03:04:05 PM", "2024-13-99", 41.7, -87.6, 3.0, "THEFT" if i % 2 else "ARSON", f"free text {i}") for i in range(60)]
    df = spark.createDataFrame(rows, "noted string, `Date` string, a double, b double, latitude double, sort string, description string")
    assert {r.role: r.column for r in profile.detect_roles_by_evidence(df).collect()} == {
        "date": "noted", "latitude": "a", "longitude": "b", "category": "sort",
    }
    none = profile.detect_roles_by_evidence(df.select("latitude", "description").where("latitude < 0"))
    assert [r.column for r in none.collect()] == [None] * 4


def test_names_decide_between_equal_columns(spark):
    df = spark.createDataFrame([("2024-01-02", "2024-01-03", 41.7, 41.8)], "first string, `Date` string, q double, lat double")
    found = {r.role: r.column for r in profile.detect_roles_by_evidence(df).collect()}
    assert (found["date"], found["latitude"], found["longitude"]) == ("Date", "lat", None)


def test_weightings_are_those_that_add_up(spark):
    chance = np.random.default_rng(4)
    frame = pd.DataFrame(chance.normal(size=(50, 6)), columns=["target", *"abcde"])
    made = ensemble.weight_grid(spark.createDataFrame(frame), list("abcde"), steps=4).toPandas()
    wanted = [w for w in itertools.product(range(5), repeat=5) if sum(w) == 4]
    assert len(made) == len(wanted) == math.comb(8, 4)
    assert {tuple((4 * r).round().astype(int)) for r in made[[f"w{i}" for i in range(5)]].to_numpy()} == set(wanted)
    best = ensemble.best_weights(spark.createDataFrame(frame), list("abcde"), steps=4).first()
    errors = {w: np.sqrt(((frame.target - frame[list("abcde")].to_numpy() @ np.array(w) / 4) ** 2).mean()) for w in wanted}
    least = min(errors, key=lambda w: (round(errors[w], 12), w))
    assert tuple(round(4 * best[f"w{i}"]) for i in range(5)) == least
