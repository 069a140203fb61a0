"""Scalers and encoders: fitted once on the training rows, applied as plain expressions."""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cellpulse.operators.lookup import spread_lookup
from cellpulse.operators.ordered import quantiles, running_totals
from cellpulse.staging import written

# Ten times the spacing of doubles at 1.
CONSTANT = 10 * sys.float_info.epsilon


@dataclass(frozen=True)
class Scaler:
    """(x - center) / scale per column; a scale that is only rounding noise counts as 1."""

    columns: tuple[str, ...]
    centers: tuple[float, ...]
    scales: tuple[float, ...]

    def apply(self, df: DataFrame, suffix: str = "") -> DataFrame:
        """Scaled columns in place of the originals, or beside them under a suffix."""
        fitted = zip(self.columns, self.centers, self.scales)
        return df.withColumns(
            {
                f"{c}{suffix}": (F.col(c) - F.lit(center)) / F.lit(scale if abs(scale) >= CONSTANT else 1.0)
                for c, center, scale in fitted
            }
        )


def robust_statistics(train: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Rows (column, median, iqr), all columns in one shuffle."""
    found = quantiles(train, columns, [0.25, 0.5, 0.75], exact)
    at = {p: F.max(F.when(F.col("probability") == p, F.col("value"))) for p in (0.25, 0.5, 0.75)}
    return found.groupBy("column").agg(at[0.5].alias("median"), (at[0.75] - at[0.25]).alias("iqr"))


def fit_robust(train: DataFrame, columns: Sequence[str], exact: bool = True) -> Scaler:
    rows = {r["column"]: r for r in robust_statistics(train, columns, exact).collect()}
    return Scaler(
        tuple(columns), tuple(rows[c]["median"] for c in columns), tuple(rows[c]["iqr"] for c in columns)
    )


def fit_standard(train: DataFrame, columns: Sequence[str]) -> Scaler:
    """Mean and population deviation, one aggregation."""
    row = train.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns], *[F.stddev_pop(c).alias(f"{c}_std") for c in columns]
    ).first()
    return Scaler(
        tuple(columns), tuple(row[f"{c}_mean"] for c in columns), tuple(row[f"{c}_std"] for c in columns)
    )


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, rows, code): 0-based position of each distinct text in sorted order, numbered without one
    task seeing all of them."""
    distinct = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count("*").alias("rows"), F.lit(1).cast("long").alias("one"))
    )
    numbered = running_totals(distinct, "value", ["rows", "one"])
    return numbered.select("value", "rows", (F.col("one_upto") - 1).cast("int").alias("code"))


def fit_codes(df: DataFrame, *columns: str) -> dict[str, DataFrame]:
    """The written code tables of text columns, by column."""
    return {c: written(label_codes(df, c), "label-codes") for c in columns}


def encode(df: DataFrame, codes: Mapping[str, DataFrame], names: Mapping[str, str] | None = None) -> DataFrame:
    """Adds the codes of text columns from fitted tables, `<column>_code` unless named; nothing is fitted.

    A text that the tables don't know, and a null, has no code. A frequent text is looked up in place.
    """
    coded = df
    for column, table in codes.items():
        name = (names or {}).get(column, f"{column}_code")
        table = table.withColumnsRenamed({"value": "_text", "rows": "_rows", "code": "_code"})
        before = coded.columns
        keyed = coded.withColumn("_text", F.col(column).cast("string"))
        found = spread_lookup(keyed, table, "_text", "_rows", df.columns)
        coded = found.select(*before, F.col("_code").alias(name))
    return coded


def label_encode(df: DataFrame, *columns: str, names: Sequence[str] = ()) -> DataFrame:
    """Adds the codes of text columns, `<column>_code` unless named.

    The code tables are built from `df` as it is and written once, so encoding another column repeats no work
    of the first.
    """
    return encode(df, fit_codes(df, *columns), dict(zip(columns, names)))
