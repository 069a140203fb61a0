from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellpulse.operators import histograms, ordered, scaling
from cellpulse.operators.ordered import quantiles, running_totals
from cellpulse.staging import written
from helpers import settings

SHARES = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


def samples(seed: int, kind: str) -> np.ndarray:
    chance = np.random.default_rng(seed)
    values = {
        "spread": chance.normal(size=501) * 10.0 ** chance.integers(-3, 6, 501),
        "hot": np.where(chance.random(600) < 0.4, 7.0, chance.integers(0, 50, 600).astype(float)),
        "constant": np.full(31, 2.5),
        "single": np.array([4.25]),
        "two": np.array([1.0, 2.0]),
    }[kind]
    return values


@pytest.mark.parametrize("kind", ["spread", "hot", "constant", "single", "two"])
def test_quantiles_equal_numpy(spark, kind):
    values = samples(3, kind)
    df = spark.createDataFrame(pd.DataFrame({"x": values})).repartition(5)
    made = {r.probability: r.value for r in quantiles(df, ["x"], SHARES).collect()}
    np.testing.assert_allclose([made[p] for p in SHARES], np.quantile(values, SHARES), rtol=1e-12)


def test_quantiles_of_several_columns_ignore_nulls(spark):
    chance = np.random.default_rng(1)
    frame = pd.DataFrame({"a": chance.normal(size=300), "b": chance.integers(0, 4, 300).astype(float)})
    frame.loc[::7, "a"] = np.nan
    df = spark.createDataFrame(frame).withColumn("a", F.when(~F.isnan("a"), F.col("a")))
    made = quantiles(df, ["a", "b"], [0.25, 0.5]).collect()
    found = {(r.column, r.probability): r.value for r in made}
    for c in ("a", "b"):
        np.testing.assert_allclose([found[c, p] for p in (0.25, 0.5)], frame[c].dropna().quantile([0.25, 0.5]))


def test_sketched_quantiles_are_close(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    made = {r.probability: r.value for r in quantiles(df, ["x"], [0.5, 0.9], exact=False).collect()}
    assert abs(made[0.5] - 500) <= 1 and abs(made[0.9] - 900) <= 1


def test_only_a_sliver_is_ordered(spark, monkeypatch):
    """Of many distinct values few are dealt to ranges, and the figures are exact."""
    chance = np.random.default_rng(8)
    frame = pd.DataFrame({"a": chance.normal(size=60_000), "b": np.sort(chance.normal(size=60_000)), "c": chance.integers(0, 3, 60_000) * 1.0})
    ordered_rows = []

    def counted(df, name):
        table = written(df, name)
        ordered_rows.append(table.count())
        return table

    monkeypatch.setattr(ordered, "written", counted)
    made = {(r.column, r.probability): r.value for r in quantiles(spark.createDataFrame(frame).repartition(8), list("abc"), SHARES).collect()}
    for c in "abc":
        np.testing.assert_allclose([made[c, p] for p in SHARES], np.quantile(frame[c], SHARES), rtol=1e-12)
    assert len(ordered_rows) == 1 and ordered_rows[0] < 0.04 * 180_000


@pytest.mark.parametrize("wrong", [(1e9, 2e9), (-2e9, -1e9), (0.4, 0.41)])
def test_a_sketch_that_misses_costs_another_scan_and_nothing_else(spark, monkeypatch, wrong):
    values = np.random.default_rng(9).random(5000)
    right, calls = ordered._brackets, []

    def missing(df, columns, probabilities, width):
        calls.append(width)
        if len(calls) == 1:
            return {c: (5000, [wrong for _ in probabilities]) for c in columns}
        return right(df, columns, probabilities, width)

    monkeypatch.setattr(ordered, "_brackets", missing)
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    made = {r.probability: r.value for r in quantiles(df, ["x"], [0.1, 0.9]).collect()}
    np.testing.assert_allclose([made[0.1], made[0.9]], np.quantile(values, [0.1, 0.9]))
    assert len(calls) == 2 and calls[1] > calls[0]


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([(None, float("nan"), 1.0), (None, 2.0, 3.0)], "a double, b double, c double")
    made = {(r.column, r.probability): r.value for r in quantiles(df, ["a", "b", "c"], [0.5]).collect()}
    assert made == {("b", 0.5): 2.0, ("c", 0.5): 2.0}
    assert quantiles(df.limit(0), ["c"], [0.5]).count() == 0
    assert df.select(ordered.median(df, "a").alias("m")).first().m is None


@pytest.mark.parametrize("ranges", [1, 7])
def test_running_totals_of_texts_within_groups(spark, ranges):
    frame = pd.DataFrame({"g": ["a", "b"] * 200, "k": [f"{i:03d}" for i in range(400)], "n": range(400)})
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": str(ranges)}):
        made = running_totals(spark.createDataFrame(frame), "k", ["n"], by=["g"]).toPandas()
    frame["n_upto"] = frame.sort_values("k").groupby("g")["n"].cumsum()
    merged = made.merge(frame, on=["g", "k"])
    assert (merged.n_upto_x == merged.n_upto_y).all() and len(merged) == 400


def test_ranges_follow_the_data(spark):
    """One exchange deals the rows to ranges; no search among splitters, no window over all rows."""
    df = spark.range(40_000).selectExpr("id * 7 % 40009 as id", "1L as n")
    sizes = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "60"}
    with settings(spark, sizes):
        found = running_totals(df, "id", ["n"])
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.agg(F.max("n_upto")).first()[0] == found.count() == 40_000
    specs = {re.sub(r"#\d+L?", "", line.split("windowspecdefinition(")[1].split(", specified")[0]) for line in plan.split("\n") if "Window [" in line}
    # Values run inside a range; only the totals of the ranges are ordered as a whole.
    assert specs == {"_range, id ASC NULLS FIRST", "_range ASC NULLS FIRST"}
    assert "filter(" not in plan and "NestedLoop" not in plan


def test_label_codes_are_positions_in_sorted_order(spark):
    words = ["pear", "apple", "fig", "apple", "Zebra", "fig", "apple"]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)] + [(99, None)], "id int, w string")
    made = {r.id: r.w_code for r in scaling.label_encode(df, "w").collect()}
    order = sorted(set(words))
    assert made == {**{i: order.index(w) for i, w in enumerate(words)}, 99: None}


def test_scalers(spark):
    chance = np.random.default_rng(2)
    frame = pd.DataFrame({"x": chance.normal(size=101), "c": 3.0, "mostly": [0.0] * 100 + [9.0]})
    df = spark.createDataFrame(frame)
    columns = list(frame.columns)
    robust = scaling.fit_robust(df, columns).apply(df).toPandas()
    spread = frame.x.quantile(0.75) - frame.x.quantile(0.25)
    np.testing.assert_allclose(sorted(robust.x), sorted((frame.x - frame.x.median()) / spread))
    assert set(robust.c) == {0.0} and set(robust.mostly) == {0.0, 9.0}
    standard = scaling.fit_standard(df, columns).apply(df).toPandas()
    np.testing.assert_allclose(sorted(standard.x), sorted((frame.x - frame.x.mean()) / frame.x.std(ddof=0)))
    assert set(standard.c) == {0.0}


def test_scaler_ignores_rows_outside_training(spark):
    df = spark.createDataFrame(pd.DataFrame({"x": [1.0, 2.0, 3.0, 1000.0]}))
    made = scaling.fit_robust(df.where("x < 10"), ["x"])
    assert made.centers == (2.0,) and made.scales == (1.0,)


def test_equal_width_counts_everything(spark):
    chance = np.random.default_rng(4)
    values = chance.gamma(2.0, size=700)
    made = histograms.equal_width(spark.createDataFrame(pd.DataFrame({"x": values})), "x", 20).orderBy("bin").toPandas()
    counts, edges = np.histogram(values, 20)
    assert list(made.n) == list(counts)
    np.testing.assert_allclose(made.low, edges[:-1])


def test_equal_width_of_a_constant(spark):
    made = histograms.equal_width(spark.createDataFrame([(2.0,)] * 5, "x double"), "x", 4).toPandas()
    assert made.n.sum() == 5


def test_error_by_prediction_equals_pandas(spark):
    chance = np.random.default_rng(6)
    frame = pd.DataFrame({"p": chance.integers(0, 6, 400).astype(float), "e": chance.random(400)})
    frame["b"] = pd.qcut(frame.p, 10, duplicates="drop", labels=False)
    expected = frame.groupby("b")["e"].agg(["size", "mean", "std"])
    made = histograms.error_by_prediction(spark.createDataFrame(frame[["p", "e"]]), "p", "e").orderBy("bin").toPandas()
    assert list(made.n) == list(expected["size"])
    np.testing.assert_allclose(made[["mean_error", "std_error"]], expected[["mean", "std"]])


def test_label_encode_reads_its_input_once_per_use(spark):
    """Two encoded columns: one scan of the input, one of each written code table and its frequent part."""
    df = spark.range(500).select("id", F.concat(F.lit("a"), F.col("id") % 7).alias("x"), F.concat(F.lit("b"), F.col("id") % 3).alias("y"))
    coded = scaling.label_encode(df, "x", "y")
    plan = coded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 500") == 1
    rows = coded.collect()
    assert all((r.x_code, r.y_code) == (r.id % 7, r.id % 3) for r in rows) and len(rows) == 500
