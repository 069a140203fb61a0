"""The filled panel and the features that don't see their future."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellpulse.config import GridConfig
from cellpulse.operators import asof, history, regular
from helpers import panel_rows, random_panel, sorted_pandas, to_spark

CONFIG = GridConfig()


def test_every_window_between_first_and_last_is_there(spark):
    frame = random_panel(5, cells=9, windows=25)
    made = sorted_pandas(regular.densify(to_spark(spark, frame), CONFIG), "cell_id", "time_window")
    assert list(made.columns) == list(frame.columns)
    for cell, own in frame.groupby("cell_id"):
        filled = made[made.cell_id == cell].reset_index(drop=True)
        assert list(filled.time_window) == list(pd.date_range(own.time_window.min(), own.time_window.max(), freq="6h"))
        assert filled.incident_count.sum() == own.incident_count.sum()
        assert filled.cell_center_lat.nunique() == 1 and filled.grid_lon_idx.isna().sum() == 0
    merged = made.merge(frame, on=["cell_id", "time_window"], how="left", suffixes=("", "_seen"))
    seen = merged.incident_count_seen.notna()
    for c in ("incident_count", "hour", "day_of_week", "is_weekend", "time_slot"):
        assert (merged.loc[seen, c] == merged.loc[seen, f"{c}_seen"]).all()
    gap = merged[~seen]
    assert (gap.incident_count == 0).all() and (gap.hour == gap.time_window.dt.hour).all()
    assert (gap.day_of_week == gap.time_window.dt.dayofweek).all()
    assert (gap.is_weekend == (gap.time_window.dt.dayofweek >= 5)).all() and gap.time_slot.notna().all()


def test_long_histories_are_cut_into_slices(spark, monkeypatch):
    frame = panel_rows({"1_1": [1] * 3})
    frame.loc[2, "time_window"] = frame.time_window[0] + pd.Timedelta(hours=6 * 1300)
    for size in (1, 7, 512, 5000):
        monkeypatch.setattr(regular, "SLICE", size)
        made = regular.densify(to_spark(spark, frame), CONFIG)
        assert made.count() == made.select("time_window").distinct().count() == 1301
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_filling_to_a_common_end_and_other_columns(spark):
    df = to_spark(spark, panel_rows({"1_1": [2, 3], "2_2": [1]})).withColumn("note", F.lit("x")).withColumn("rate", F.lit(1.5))
    until = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    made = regular.densify(df, CONFIG, fill={"rate": F.lit(0.0)}, until=until)
    assert {r.cell_id: r.n for r in made.groupBy("cell_id").agg(F.count("*").alias("n")).collect()} == {"1_1": 5, "2_2": 5}
    gap = made.where("incident_count = 0").select("note", "rate").distinct().collect()
    assert [tuple(r) for r in gap] == [(None, 0.0)]
    assert regular.densify(df.limit(0), CONFIG).count() == 0


def test_targets_of_a_filled_panel_are_sometimes_zero(spark):
    df = to_spark(spark, random_panel(8))
    dense = history.target_feature(regular.densify(df, CONFIG)).where("target is not null")
    assert {r[0] for r in dense.select("target_binary").distinct().collect()} == {0, 1}


def pandas_before(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["cell_id", "time_window"]).reset_index(drop=True)
    own = frame.groupby("cell_id").incident_count
    out = frame[["cell_id", "time_window"]].copy()
    grown = lambda f: own.transform(lambda s: getattr(s.expanding(), f)().shift(1)).fillna(0)
    out["cell_avg_before"], out["cell_std_before"] = grown("mean"), grown("std")
    out["cell_max_before"], out["cell_total_before"] = grown("max"), grown("sum")
    for key, name in ((frame.day_of_week, "dow_avg_before"), (frame.time_window.dt.hour, "hour_avg_before"), (frame.is_weekend, "weekend_avg_before")):
        out[name] = [
            frame.incident_count[(key == k) & (frame.time_window < t)].mean() for k, t in zip(key, frame.time_window)
        ]
    out["lag1_percentile_before"] = [
        (lambda s: ((s < v).sum() + ((s == v).sum() + 1) / 2) / len(s))(frame.incident_count[(frame.cell_id == c) & (frame.time_window <= t)])
        for c, t, v in zip(frame.cell_id, frame.time_window, frame.incident_count)
    ]
    return out


def features_before(df):
    found = asof.slot_features_before(asof.cell_statistics_before(df))
    return asof.rank_share_before(found, "incident_count")


NAMES = [*asof.CELL, "dow_avg_before", "hour_avg_before", "weekend_avg_before", "lag1_percentile_before"]


@pytest.mark.parametrize("seed", [1, 2])
def test_features_before_equal_pandas(spark, seed):
    frame = random_panel(seed, cells=8, windows=30)
    made = sorted_pandas(features_before(to_spark(spark, frame)), "cell_id", "time_window")
    want = pandas_before(frame)
    for name in NAMES:
        np.testing.assert_allclose(made[name].astype(float), want[name].astype(float), rtol=1e-9, atol=1e-9, err_msg=name)


def test_deleting_later_rows_changes_no_feature(spark):
    frame = random_panel(3, cells=8, windows=30)
    cut = frame.time_window.quantile(0.6)
    whole = sorted_pandas(features_before(to_spark(spark, frame)), "cell_id", "time_window")
    early = sorted_pandas(features_before(to_spark(spark, frame[frame.time_window <= cut])), "cell_id", "time_window")
    kept = whole[whole.time_window <= cut].reset_index(drop=True)
    pd.testing.assert_frame_equal(kept[NAMES], early[NAMES])


def test_nulls_have_no_rank_and_no_slot(spark):
    df = to_spark(spark, panel_rows({"1_1": [3, 1, 2]})).withColumn("lag_1", F.when(F.col("incident_count") != 1, F.col("incident_count")))
    made = {r.incident_count: r.lag1_percentile_before for r in asof.rank_share_before(df).collect()}
    assert made == {3: 1.0, 1: None, 2: 0.5}
    unknown = df.withColumn("day_of_week", F.lit(None).cast("int"))
    assert asof.slot_average_before(unknown, "day_of_week", "m").where("m is not null").count() == 0
