"""Scalar rules on predictions: error and risk level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from cellpulse.config import RISK_LABELS


def absolute_error(actual: Column, predicted: Column) -> Column:
    return F.abs(actual - predicted)


def bounded_risk(score: Column, edges: Sequence[float]) -> Column:
    """Level of half-open ranges (edge, next edge]; null outside of all of them."""
    level = F.when(score <= edges[0], None)
    for upper, label in zip(edges[1:], RISK_LABELS):
        level = level.when(score <= upper, label)
    return level


def open_risk(score: Column, edges: Sequence[float]) -> Column:
    """Like `bounded_risk` but the first and the last range have no outer edge."""
    low, high = edges
    return F.when(score <= low, RISK_LABELS[0]).when(score <= high, RISK_LABELS[1]).when(score > high, RISK_LABELS[2])
