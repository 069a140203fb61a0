from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cellpulse import staging
from cellpulse.config import GridConfig
from cellpulse.operators.clean import keep_columns
from cellpulse.sources import sample, tables
from helpers import random_panel, to_spark


def test_csv_scan_is_tolerant(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(
        "Date,Primary Type,Latitude,Longitude,Arrest,Domestic,District,Beat,Description\n"
        "01/02/2024 03:04:05 PM,THEFT,41.8,-87.6,true,false,4,411,text\n"
        "never,THEFT,high,-87.6,,,,,\n"
    )
    df = tables.standard_incidents(tables.read_csv(spark, str(path), tables.INCIDENT_SCHEMA))
    rows = df.orderBy(F.col("ts").isNull()).collect()
    assert str(rows[0].ts) == "2024-01-02 15:04:05" and rows[0].Arrest is True and rows[0].District == 4
    assert rows[1].ts is None and rows[1].lat is None and rows[1].lon == -87.6
    assert tables.read_csv(spark, str(path), tables.INCIDENT_SCHEMA, rows=1).count() == 1
    assert keep_columns(df, ["ts", "lat", "lon", "category"]).columns[4:] == list(("Arrest", "Domestic", "District", "Beat", "Description"))
    assert tables.read_any_csv(spark, str(path)).columns[0] == "Date"


def test_panel_roundtrip_prunes_months(spark, tmp_path):
    df = to_spark(spark, random_panel(4))
    tables.write_panel(df, str(tmp_path / "p"))
    back = tables.read_panel(spark, str(tmp_path / "p"), df.schema)
    assert back.drop("window_month").exceptAll(df).isEmpty() and back.count() == df.count()
    plan = back.where("window_month = '2024-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_month" in plan


def test_predictions_come_from_the_first_usable_path(spark, tmp_path):
    old = spark.createDataFrame([(2.0, 1.5)], "target double, predicted_incidents double")
    useless = spark.createDataFrame([(1,)], "x int")
    old.write.parquet(str(tmp_path / "old"))
    useless.write.parquet(str(tmp_path / "useless"))
    paths = [str(tmp_path / name) for name in ("absent", "useless", "old")]
    row = tables.load_predictions(spark, paths, GridConfig()).first()
    assert (row.ultra_predicted, row.ultra_error, row.risk_level) == (1.5, 0.5, "Medium")
    with pytest.raises(FileNotFoundError):
        tables.load_predictions(spark, paths[:2], GridConfig())


def test_sample_incidents(spark):
    df = sample.sample_incidents(spark, 20000).cache()
    assert df.count() == 20000
    shares = {r.category: r["count"] / 20000 for r in df.groupBy("category").count().collect()}
    for name, weight in sample.CATEGORY_WEIGHTS:
        assert abs(shares[name] - weight) < 0.02
    row = df.agg(F.avg("lat"), F.stddev("lon"), F.min("district"), F.max("district"), F.avg("resolved"), F.min("ts"), F.max("ts")).first()
    assert abs(row[0] - sample.CENTER[0]) < 0.01 and abs(row[1] - sample.SPREAD) < 0.005
    assert (row[2], row[3]) == (1, 10) and abs(row[4] - 0.6) < 0.02
    assert str(row[5]) >= "2023-01-01" and str(row[6]) < "2024-01-01"
    assert sample.sample_incidents(spark, 50).exceptAll(sample.sample_incidents(spark, 50)).isEmpty()


def test_written_tables_live_in_the_shared_folder(spark):
    assert staging.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df = staging.written(spark.range(5), "numbers")
    assert staging.shared_folder(spark) in df.inputFiles()[0] and df.count() == 5
