from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellpulse.config import GridConfig
from cellpulse.operators import ewma, features, history, lookup, slots
from helpers import panel_rows, random_panel, sorted_pandas, to_spark

KEYS = ("cell_id", "time_window")


def expected_history(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(list(KEYS)).reset_index(drop=True)
    grouped = frame.groupby("cell_id")["incident_count"]
    for n in (1, 3, 7, 14):
        frame[f"lag_{n}"] = grouped.shift(n).fillna(0)
        for kind in ("mean", "max", "std"):
            rolled = grouped.transform(lambda x: getattr(x.rolling(n, min_periods=1), kind)().shift(1))
            frame[f"rolling_{kind}_{n}"] = rolled.fillna(0)
    frame["target"] = grouped.shift(-1)
    frame["momentum"] = grouped.diff(1).fillna(0)
    frame["acceleration"] = frame.groupby("cell_id")["momentum"].diff(1).fillna(0)
    for span in (3, 7):
        frame[f"ewma_{span}"] = grouped.transform(lambda x: x.ewm(span=span, adjust=False).mean().shift(1)).fillna(0)
    return frame


@pytest.mark.parametrize("seed", [1, 2])
def test_history_equals_pandas(spark, seed):
    frame = random_panel(seed)
    expected = expected_history(frame)
    df = to_spark(spark, frame)
    made = sorted_pandas(
        df.withColumns({**history.lag_columns(), **history.momentum_columns(), **history.target_columns()}), *KEYS
    )
    for name in made.columns:
        if name in expected.columns and name not in KEYS and made[name].dtype != object:
            np.testing.assert_allclose(made[name].astype(float), expected[name].astype(float), atol=1e-12, err_msg=name)


@pytest.mark.parametrize("length", [1, 2, 319, 320, 321, 900])
def test_ewma_equals_pandas_across_blocks(spark, length):
    chance = np.random.default_rng(length)
    frame = panel_rows({"0_0": list(chance.integers(1, 50, length)), "0_1": [3]})
    expected = expected_history(frame)
    made = sorted_pandas(ewma.ewma_features(to_spark(spark, frame)), *KEYS)
    for name in ("ewma_3", "ewma_7"):
        np.testing.assert_allclose(made[name], expected[name], rtol=1e-12)


def test_ewma_long_span(spark):
    chance = np.random.default_rng(5)
    frame = panel_rows({"0_0": list(chance.integers(1, 9, 3000))})
    made = sorted_pandas(ewma.ewma_features(to_spark(spark, frame), [60]), *KEYS)
    expected = frame["incident_count"].ewm(span=60, adjust=False).mean().shift(1).fillna(0)
    np.testing.assert_allclose(made["ewma_60"], expected, rtol=1e-12)


def test_ewma_of_spans_far_apart(spark):
    frame = panel_rows({"0_0": [3, 1, 4, 1, 5, 9, 2, 6] * 30})
    made = sorted_pandas(ewma.ewma_features(to_spark(spark, frame), [2, 30, 500]), *KEYS)
    for span in (2, 30, 500):
        expected = frame.incident_count.ewm(span=span, adjust=False).mean().shift(1).fillna(0)
        np.testing.assert_allclose(made[f"ewma_{span}"], expected, rtol=1e-12)


def test_rank_share_averages_ties(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (3, 1, 1, 2, 5)], "cell_id string, lag_1 double")
    made = {(r.lag_1, round(r.lag1_percentile, 9)) for r in history.rank_share(df).collect()}
    assert made == {(3.0, 0.8), (1.0, 0.3), (2.0, 0.6), (5.0, 1.0)}


def test_one_and_two_row_cells(spark):
    df = to_spark(spark, panel_rows({"0_0": [4], "3_3": [2, 5]}))
    rows = {(r.cell_id, r.incident_count): r for r in features.advanced_matrix(df, GridConfig()).collect()}
    assert list(rows) == [("3_3", 2)]
    row = rows["3_3", 2]
    assert (row.target, row.target_binary, row.lag_1, row.ewma_3, row.acceleration) == (5.0, 1, 0.0, 0.0, 0.0)
    assert row.cell_total_incidents == 7 and row.lag1_percentile == 1.0


def test_feature_names_complete(spark):
    df = features.advanced_matrix(to_spark(spark, random_panel(3)), GridConfig())
    names = features.feature_columns(df)
    assert len(names) == 62 and len(set(names)) == 62
    assert names[-21:] == list(features.ADVANCED)


def test_advanced_matrix_contains_base(spark):
    df = to_spark(spark, random_panel(7))
    base = features.feature_matrix(df, GridConfig())
    wide = features.advanced_matrix(df, GridConfig()).select(*base.columns)
    pd.testing.assert_frame_equal(sorted_pandas(base, *KEYS), sorted_pandas(wide, *KEYS))


def test_slot_lookup_is_the_same_with_and_without_frequent_hours(spark):
    df = to_spark(spark, random_panel(11))
    one, many = (sorted_pandas(slots.slot_features(df, frequent=n), *KEYS) for n in (1, 100))
    pd.testing.assert_frame_equal(one, many)
    expected = df.toPandas().groupby("hour")["incident_count"].mean()
    np.testing.assert_allclose(one["hour_avg_incidents"], one["hour"].map(expected))


def test_null_calendar_parts_get_defaults(spark):
    df = to_spark(spark, panel_rows({"0_0": [1, 2]}))
    first = F.col("incident_count") == 1
    holed = df.withColumns({c: F.when(~first, F.col(c)) for c in ("hour", "day_of_week", "is_weekend")})
    made = features.temporal_features(holed).orderBy("time_window").first()
    assert (made.hour, made.day_of_week, made.is_weekend) == (12.0, 0, 0)


def test_align_features_fills_and_orders(spark):
    df = spark.createDataFrame([("k", 1.0, 2.0)], "cell_id string, b double, a double")
    made = features.align_features(df, ["a", "missing", "b"])
    assert made.columns == ["cell_id", "a", "missing", "b"]
    assert tuple(made.first()) == ("k", 2.0, 0.0, 1.0)


def test_spread_lookup_with_a_key_that_holds_most_rows(spark):
    frame = pd.DataFrame({"id": range(3000), "k": [0 if i % 3 else i % 700 for i in range(3000)]})
    df = spark.createDataFrame(frame).withColumn("k", F.when(F.col("id") != 5, F.col("k")))
    values = df.where("k is not null").groupBy("k").agg(F.sum("id").alias("total"), F.count("*").alias("_rows"))
    made = lookup.spread_lookup(df, values, "k", "_rows", ["id"], frequent=4)
    assert made.columns == ["id", "k", "total"]
    frame.loc[5, "k"] = None
    expected = frame["k"].map(frame.groupby("k")["id"].sum())
    found = sorted_pandas(made, "id")["total"]
    np.testing.assert_array_equal(found.isna(), expected.isna())
    np.testing.assert_allclose(found.fillna(-1), expected.fillna(-1))
