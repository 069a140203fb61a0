from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cellpulse.operators import split
from helpers import random_panel, to_spark

ORDER = list(split.ORDER)


def expected_labels(frame, shares):
    ordered = frame.sort_values(ORDER).reset_index(drop=True)
    first, second = (int(len(ordered) * s) for s in shares)
    labels = ["train"] * first + ["val"] * (second - first) + ["test"] * (len(ordered) - second)
    return dict(zip(zip(ordered.cell_id, ordered.time_window), labels))


@pytest.mark.parametrize("seed,shares", [(1, (0.7, 0.85)), (2, (0.33, 0.5)), (3, (0.01, 0.99))])
def test_time_split_is_by_position(spark, seed, shares):
    frame = random_panel(seed)
    df = to_spark(spark, frame)
    fitted = split.time_split(df, shares)
    made = {(r.cell_id, r.time_window): r.split for r in fitted.assign(df).collect()}
    assert made == expected_labels(frame, shares)
    for name in fitted.names:
        rows = {(r.cell_id, r.time_window) for r in fitted.part(df, name).collect()}
        assert rows == {key for key, label in made.items() if label == name}


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_split_does_not_depend_on_the_time_zone(spark, kind):
    frame = random_panel(6)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        df = to_spark(spark, frame).withColumn("time_window", F.col("time_window").cast(kind))
        fitted = split.time_split(df)
        sizes = [fitted.part(df, name).count() for name in fitted.names]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    ends = [int(len(frame) * s) for s in (0.7, 0.85)] + [len(frame)]
    assert sizes == [ends[0], ends[1] - ends[0], ends[2] - ends[1]]


def test_applying_a_split_moves_no_row(spark, tmp_path):
    df = to_spark(spark, random_panel(5))
    df.write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    plan = split.time_split(stored).part(stored, "test")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "GreaterThanOrEqual(time_window" in plan


def test_folds_are_consecutive_and_even(spark):
    frame = random_panel(8)
    df = to_spark(spark, frame)
    folds = split.contiguous_folds(df, 3)
    sizes = [folds.part(df, name).count() for name in folds.names]
    assert sum(sizes) == len(frame) and max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)
    ends = [folds.part(df, name).agg(F.min("time_window"), F.max("time_window")).first() for name in folds.names]
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))


def test_position_outside(spark):
    with pytest.raises(ValueError):
        split.keys_at(to_spark(spark, random_panel(1)), [10**6])


def test_hashed_split_is_stable_and_near_the_share(spark):
    df = spark.range(20000)
    label = split.hashed_split(df, "id")
    first = df.withColumn("s", label).where("s = 'test'")
    again = df.repartition(7).withColumn("s", label).where("s = 'test'")
    assert first.select("id").exceptAll(again.select("id")).isEmpty()
    assert abs(first.count() / 20000 - 0.2) < 0.02


def test_random_split_is_seeded(spark):
    df = spark.range(1000)
    train, test = split.random_split(df)
    assert train.count() + test.count() == 1000
    assert {r.id for r in test.collect()} == {r.id for r in split.random_split(df)[1].collect()}
