"""Group fairness of binary predictions; one aggregation by group carries every figure."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def group_rates(df: DataFrame, actual: str, predicted: str, group: str) -> DataFrame:
    """Selection rate and true positive rate of every group; 0 where a group has no positives."""
    positives = F.count_if(F.col(actual) == 1)
    found = F.count_if((F.col(actual) == 1) & (F.col(predicted) == 1))
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(F.col(group).alias("group"))
        .agg(
            F.count("*").alias("n"),
            F.avg(F.col(predicted).cast("double")).alias("selection_rate"),
            F.when(positives > 0, found / positives).otherwise(F.lit(0.0)).alias("true_positive_rate"),
        )
    )


def fairness_metrics(df: DataFrame, actual: str, predicted: str, group: str) -> DataFrame:
    """One row: groups, average rate, disparate impact, parity and opportunity differences."""
    rate, tpr = "selection_rate", "true_positive_rate"
    ratio = F.when(F.max(rate) > 0, F.min(rate) / F.max(rate)).otherwise(F.lit(0.0))
    return group_rates(df, actual, predicted, group).agg(
        F.count("*").alias("n_groups"),
        F.avg(rate).alias("avg_selection_rate"),
        F.when(F.count("*") >= 2, ratio).alias("disparate_impact"),
        (F.max(rate) - F.min(rate)).alias("demographic_parity"),
        F.coalesce(F.max(tpr) - F.min(tpr), F.lit(0.0)).alias("equal_opportunity"),
    )


def disparate_impact(df: DataFrame, actual: str, predicted: str, group: str) -> DataFrame:
    return fairness_metrics(df, actual, predicted, group).select("n_groups", "disparate_impact")


def demographic_parity(df: DataFrame, actual: str, predicted: str, group: str) -> DataFrame:
    return fairness_metrics(df, actual, predicted, group).select("demographic_parity")


def equal_opportunity(df: DataFrame, actual: str, predicted: str, group: str) -> DataFrame:
    return fairness_metrics(df, actual, predicted, group).select("equal_opportunity")


def fairness_report(
    df: DataFrame, actual: str, predicted: str, group: str,
    min_impact: float = 0.8, max_parity: float = 0.1, max_opportunity: float = 0.1,
) -> DataFrame:
    """Every figure with its threshold verdict."""
    return fairness_metrics(df, actual, predicted, group).withColumns(
        {
            "impact_passes": F.col("disparate_impact") >= min_impact,
            "parity_passes": F.col("demographic_parity") <= max_parity,
            "opportunity_passes": F.col("equal_opportunity") <= max_opportunity,
        }
    )
