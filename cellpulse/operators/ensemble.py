"""Weighted combination of prediction columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, functions as F


def error_moments(df: DataFrame, models: Sequence[str], target: str = "target") -> DataFrame:
    """One row: the mean product of the errors of every two models."""
    error = {m: F.col(target) - F.col(m) for m in models}
    return df.agg(
        *[
            F.avg(error[a] * error[b]).alias(f"m_{i}_{j}")
            for i, a in enumerate(models) for j, b in enumerate(models) if i <= j
        ]
    )


def weight_grid(df: DataFrame, models: Sequence[str], target: str = "target", steps: int = 20) -> DataFrame:
    """RMSE of every weighting in multiples of 1/steps that adds up to 1.

    The weights add up to 1, so the error of a mixture is the mixture of the errors and its mean square
    is a quadratic form of the moments: the data is aggregated once, whatever the number of weightings.
    """
    k = len(models)
    moments = error_moments(df, models, target)
    names = [f"w{i}" for i in range(k)]
    # Every weight is unfolded up to what the ones before it leave, so only weightings that add up are made: 53,130 of
    # six models, not the 86 million places of the full grid. Ids number them in nested order.
    grid = df.sparkSession.range(1).select(F.lit(0).cast("long").alias("id"), F.lit(steps).alias("_left"))
    for i, n in enumerate(names):
        weight = F.explode(F.sequence(F.lit(0), F.col("_left"))) if i < k - 1 else F.col("_left")
        grid = grid.select("*", weight.alias(n)).withColumns(
            {"id": F.col("id") * (steps + 1) + F.col(n), "_left": F.col("_left") - F.col(n)}
        )
    grid = grid.drop("_left").withColumn("_m", moments.select(F.struct("*")).scalar())
    terms = []
    for i in range(k):
        for j in range(i, k):
            product = F.col(f"w{i}") * F.col(f"w{j}") * F.col(f"_m.m_{i}_{j}")
            terms.append(product if i == j else product * 2)
    rmse = F.sqrt(F.greatest(reduce(add, terms), F.lit(0.0))) / steps
    return grid.select(
        F.col("id").alias("combination"), *[(F.col(n) / steps).alias(n) for n in names], rmse.alias("rmse")
    )


def best_weights(df: DataFrame, models: Sequence[str], target: str = "target", steps: int = 20) -> DataFrame:
    """The weighting with the smallest RMSE, the first in nested order on a tie."""
    grid = weight_grid(df, models, target, steps)
    names = [f"w{i}" for i in range(len(models))]
    best = grid.agg(F.min_by(F.struct(*names, "rmse"), F.struct("rmse", "combination")).alias("best"))
    return best.select("best.*")


def mix(df: DataFrame, models: Sequence[str], weights: Sequence[float], name: str) -> DataFrame:
    return df.withColumn(name, reduce(add, [F.col(m) * F.lit(float(w)) for m, w in zip(models, weights)]))
