"""Figures of the statistics report over a table of predictions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from cellpulse.config import GridConfig, RISK_LABELS, WEEKDAY_NAMES
from cellpulse.operators.ordered import median, quantiles
from cellpulse.operators.panel import whole_days
from cellpulse.operators.summaries import cell_risk

P, E = "ultra_predicted", "ultra_error"


def percent(condition: Column) -> Column:
    return F.avg(condition.cast("double")) * 100


def dataset(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_predictions"),
        F.count_distinct("cell_id").alias("unique_locations"),
        F.to_date(F.min("time_window")).alias("date_range_start"),
        F.to_date(F.max("time_window")).alias("date_range_end"),
        whole_days("time_window").alias("total_days"),
        F.count_distinct("time_window").alias("unique_time_windows"),
    )


def error_metrics(predicted: str = P) -> dict[str, Column]:
    """RMSE, MAE, R2 and MAPE as aggregates.

    The total sum of squares is count * population variance, which Spark merges from partial means: one
    pass, without the cancellation of summed squares.
    """
    error = F.col("target") - F.col(predicted)
    total = F.var_pop("target") * F.count("target")
    return {
        "rmse": F.sqrt(F.avg(error * error)),
        "mae": F.avg(F.abs(error)),
        "r2": F.when(total != 0, F.lit(1.0) - F.sum(error * error) / total).otherwise(F.lit(0.0)),
        "mape": F.avg(F.abs(F.try_divide(error, F.col("target") + 1))) * 100,
    }


def accuracy(df: DataFrame, exact: bool = True) -> DataFrame:
    figures = df.agg(*[c.alias(name) for name, c in error_metrics().items()])
    return figures.withColumn("median_error", median(df, E, exact))


def tiers(df: DataFrame) -> DataFrame:
    error = F.col(E)
    return df.agg(
        percent(error < 0.5).alias("within_05"),
        percent(error < 1.0).alias("within_10"),
        percent(error < 2.0).alias("within_20"),
        F.count_if(error == 0).alias("perfect"),
        percent(error == 0).alias("perfect_pct"),
    )


def prediction_figures(df: DataFrame, exact: bool = True) -> DataFrame:
    return df.agg(
        F.avg(P).alias("avg_prediction"),
        F.max(P).alias("max_prediction"),
        F.min(P).alias("min_prediction"),
        F.stddev_samp(P).alias("std_prediction"),
        F.avg("target").alias("avg_actual"),
        F.sum("target").cast("long").alias("total_actual"),
        F.sum(P).cast("long").alias("total_predicted"),
    ).withColumn("median_prediction", median(df, P, exact))


def risk_distribution(df: DataFrame) -> DataFrame:
    """Count and percentage per level; rows without a level stay in the denominator."""
    counts = df.agg(
        F.count("*").alias("rows"), *[F.count_if(F.col("risk_level") == level).alias(level) for level in RISK_LABELS]
    )
    levels = [
        F.struct(
            F.lit(level).alias("risk_level"),
            F.col(level).alias("n"),
            F.try_divide(F.col(level) * F.lit(100.0), F.col("rows")).alias("pct"),
        )
        for level in RISK_LABELS
    ]
    return counts.select(F.explode(F.array(*levels)).alias("level")).select("level.*")


def _extremes(df: DataFrame, key: str) -> DataFrame:
    """Groups with the largest and the smallest mean prediction; the smallest key on a tie."""
    means = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(P).alias("risk"))
    return means.agg(
        F.max_by(F.col(key), F.struct("risk", -F.col(key))).alias("peak"),
        F.max("risk").alias("peak_risk"),
        F.min_by(F.col(key), F.struct("risk", key)).alias("lowest"),
        F.min("risk").alias("lowest_risk"),
    )


def hours(df: DataFrame) -> DataFrame:
    return _extremes(df, "hour").select(
        F.col("peak").cast("int").alias("peak_hour"),
        "peak_risk",
        F.col("lowest").cast("int").alias("lowest_hour"),
        "lowest_risk",
    )


def days(df: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(name) for name in WEEKDAY_NAMES])
    found = _extremes(df, "day_of_week")
    return found.select(
        F.element_at(names, F.col("peak") + 1).alias("highest_risk_day"),
        F.element_at(names, F.col("lowest") + 1).alias("lowest_risk_day"),
    )


def weekend(df: DataFrame) -> DataFrame:
    means = df.agg(
        F.avg(F.when(F.col("is_weekend") == 1, F.col(P))).alias("weekend_avg_risk"),
        F.avg(F.when(F.col("is_weekend") == 0, F.col(P))).alias("weekday_avg_risk"),
    )
    return means.withColumn("weekend_higher", F.col("weekend_avg_risk") > F.col("weekday_avg_risk"))


def concentration(df: DataFrame) -> DataFrame:
    """Leading cell and the share of the 10 and 20 leading cells; 20 rows reach the last window."""
    cells = cell_risk(df).select("cell_id", "total_risk", "mean_risk")
    everything = cells.agg(F.sum("total_risk")).scalar()
    ranked = Window.orderBy(F.desc("total_risk"), "cell_id")
    leaders = cells.orderBy(F.desc("total_risk"), "cell_id").limit(20).withColumn("_rank", F.row_number().over(ranked))
    top = F.when(F.col("_rank") == 1, True)
    return (
        leaders.agg(
            F.max(F.when(top, F.col("cell_id"))).alias("top_hotspot_id"),
            F.max(F.when(top, F.col("total_risk"))).alias("top_hotspot_total_risk"),
            F.max(F.when(top, F.col("mean_risk"))).alias("top_hotspot_avg_risk"),
            F.sum(F.when(F.col("_rank") <= 10, F.col("total_risk"))).alias("_top_10"),
            F.sum("total_risk").alias("_top_20"),
        )
        .withColumn("_all", everything)
        .select(
            "top_hotspot_id",
            "top_hotspot_total_risk",
            "top_hotspot_avg_risk",
            (F.try_divide("_top_10", "_all") * 100).alias("top_10_share"),
            (F.try_divide("_top_20", "_all") * 100).alias("top_20_share"),
        )
    )


def operations(df: DataFrame, config: GridConfig) -> DataFrame:
    predicted, actual = F.col(P), F.col("target")
    flagged = predicted >= config.detection_level
    over, under = percent(predicted > actual + 1), percent(predicted < actual - 1)
    return df.agg(
        F.count_if(predicted >= config.attention_level).alias("cells_needing_attention"),
        percent(predicted >= config.attention_level).alias("cells_needing_attention_pct"),
        percent((flagged & (actual > 0)) | (~flagged & (actual == 0))).alias("correct_detection_rate"),
        over.alias("over_prediction_rate"),
        under.alias("under_prediction_rate"),
        (F.lit(100.0) - over - under).alias("accurate_prediction_rate"),
    )


def preventable(df: DataFrame, config: GridConfig) -> DataFrame:
    mean = F.try_divide(F.sum("target"), F.count("*"))
    return df.agg(
        (mean * F.count_distinct("time_window") * config.preventable_share).cast("long").alias("preventable_incidents")
    )


def baseline(df: DataFrame) -> DataFrame:
    """RMSE of always predicting the mean, and the improvement over it in percent."""
    figures = df.agg(F.stddev_pop("target").alias("baseline_rmse"), error_metrics()["rmse"].alias("rmse"))
    return figures.withColumn(
        "improvement_pct", F.try_divide(F.col("baseline_rmse") - F.col("rmse"), F.col("baseline_rmse")) * 100
    )


def error_percentiles(df: DataFrame, exact: bool = True) -> DataFrame:
    found = quantiles(df, [E], [0.5, 0.95], exact)
    at = {p: F.max(F.when(F.col("probability") == p, F.col("value"))) for p in (0.5, 0.95)}
    return found.agg(at[0.5].alias("median_error"), at[0.95].alias("p95_error")).withColumn(
        "mean_error", df.agg(F.avg(E)).scalar()
    )


def qq_points(residuals: DataFrame, column: str = "residual", points: int = 99, exact: bool = True) -> DataFrame:
    """Quantiles of the residuals beside those of the standard normal distribution."""
    shares = [i / (points + 1) for i in range(1, points + 1)]
    normal = NormalDist()
    theory = F.create_map(*[F.lit(x) for p in shares for x in (p, normal.inv_cdf(p))])
    return quantiles(residuals, [column], shares, exact).select(
        "probability", theory[F.col("probability")].alias("theoretical"), F.col("value").alias("observed")
    )


def model_ranking(df: DataFrame, models: Sequence[str]) -> DataFrame:
    """RMSE, MAE, R2 and MAPE of every prediction column and of the mean, best first; one aggregation.

    Each row is unfolded once per model and folded again before the shuffle.
    """
    mean = F.lit("mean").alias("model"), F.col("_mean").alias(P)
    entries = [F.struct(F.lit(m).alias("model"), F.col(m).cast("double").alias(P)) for m in models]
    tall = df.select("target", *models).withColumn("_mean", df.agg(F.avg("target")).scalar()).select(
        "target", F.explode(F.array(*entries, F.struct(*mean))).alias("m")
    ).select("target", "m.*")
    figures = tall.groupBy("model").agg(*[c.alias(name) for name, c in error_metrics().items()])
    best = Window.orderBy("rmse", "model")
    return (
        figures.withColumn("_baseline", df.agg(F.stddev_pop("target")).scalar())
        .withColumn("improvement_pct", (F.lit(1.0) - F.try_divide("rmse", "_baseline")) * 100)
        .withColumn("position", F.row_number().over(best))
        .select("model", "rmse", "mae", "r2", "mape", "improvement_pct", "position")
    )


def risk_figures(df: DataFrame) -> DataFrame:
    """Rows and share of every risk level as one row."""
    rows = [F.count_if(F.col("risk_level") == level).alias(f"{level.lower()}_n") for level in RISK_LABELS]
    shares = [
        (F.avg(F.coalesce(F.col("risk_level") == level, F.lit(False)).cast("double")) * 100).alias(f"{level.lower()}_pct")
        for level in RISK_LABELS
    ]
    return df.agg(*rows, *shares)


def full(df: DataFrame, config: GridConfig) -> DataFrame:
    """All sections of the report as rows (section, metric, number, text)."""
    return tall(
        {
            "dataset": dataset(df), "accuracy": accuracy(df), "tiers": tiers(df), "predictions": prediction_figures(df),
            "risk": risk_figures(df), "hours": hours(df), "days": days(df), "weekend": weekend(df),
            "concentration": concentration(df), "operations": operations(df, config),
            "preventable": preventable(df, config), "baseline": baseline(df),
        }
    )


def tall(sections: dict[str, DataFrame]) -> DataFrame:
    """One-row tables as rows (section, metric, number, text), ready for a sink."""
    parts = []
    for section, table in sections.items():
        cells = []
        for field in table.schema.fields:
            numeric = isinstance(field.dataType, T.NumericType)
            value = F.col(field.name)
            cells.append(
                F.struct(
                    F.lit(field.name).alias("metric"),
                    (value if numeric else F.lit(None)).cast("double").alias("number"),
                    (F.lit(None) if numeric else value).cast("string").alias("text"),
                )
            )
        parts.append(
            table.select(F.lit(section).alias("section"), F.explode(F.array(*cells)).alias("m")).select("section", "m.*")
        )
    return reduce(DataFrame.unionByName, parts)
