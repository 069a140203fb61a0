"""Splits into training, validation and test rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F

ORDER = ("time_window", "grid_lat_idx", "grid_lon_idx")


def keys_at(df: DataFrame, positions: Sequence[int], order: Sequence[str] = ORDER) -> list[tuple]:
    """The order keys of the rows at 0-based positions, as text.

    Text that is cast back by the session keeps a timestamp free of the time zone of the Python process.

    One job per key column for all positions together: rows are counted per value of the column within
    the values already found, and the value that covers the position is kept. No step sorts rows; what is
    ordered are windows, then the grid rows of one window, then the grid columns of one grid row.
    """
    types = {name: df.schema[name].dataType for name in order}
    found: list[tuple] = [()] * len(positions)
    rest = list(positions)
    for depth, name in enumerate(order):
        prefix = list(order[:depth])

        def inside(key: tuple) -> Column:
            return reduce(and_, [F.col(c) == F.lit(v).cast(types[c]) for c, v in zip(prefix, key)], F.lit(True))

        level = df.where(reduce(or_, [inside(key) for key in found])) if prefix else df
        running = Window.partitionBy(*prefix).orderBy(name).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counted = level.groupBy(*prefix, name).agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(running))
        covers = [
            inside(key) & (F.col("upto") > at) & (F.col("upto") - F.col("n") <= at) for key, at in zip(found, rest)
        ]
        rows = (
            counted.where(reduce(or_, covers))
            .select(F.col(name).cast("string"), "n", "upto", *[c.alias(f"_hit{i}") for i, c in enumerate(covers)])
            .collect()
        )
        for i in range(len(found)):
            hit = next((r for r in rows if r[f"_hit{i}"]), None)
            if hit is None:
                raise ValueError(f"position {positions[i]} lies outside of the table")
            found[i] = (*found[i], hit[name])
            rest[i] -= hit["upto"] - hit["n"]
    return found


@dataclass(frozen=True)
class OrderedSplit:
    """Boundaries of a split by position; applying it compares keys and moves no row."""

    names: tuple[str, ...]
    boundaries: tuple[tuple, ...]
    order: tuple[str, ...]
    types: tuple[str, ...]

    def _value(self, boundary: tuple, place: int) -> Column:
        return F.lit(boundary[place]).cast(self.types[place])

    def _before(self, boundary: tuple) -> Column:
        condition = F.lit(False)
        for place in reversed(range(len(self.order))):
            column, value = F.col(self.order[place]), self._value(boundary, place)
            condition = (column < value) | ((column == value) & condition)
        return condition

    def label(self) -> Column:
        label = F.when(self._before(self.boundaries[0]), self.names[0])
        for name, boundary in zip(self.names[1:], self.boundaries[1:]):
            label = label.when(self._before(boundary), name)
        return label.otherwise(self.names[-1])

    def assign(self, df: DataFrame, name: str = "split") -> DataFrame:
        return df.withColumn(name, self.label())

    def part(self, df: DataFrame, name: str) -> DataFrame:
        position = self.names.index(name)
        kept = df
        # The comparisons of the leading key are implied; alone they reach the Parquet scan.
        if position:
            first = self.boundaries[position - 1]
            kept = kept.where((F.col(self.order[0]) >= self._value(first, 0)) & ~self._before(first))
        if position < len(self.boundaries):
            last = self.boundaries[position]
            kept = kept.where((F.col(self.order[0]) <= self._value(last, 0)) & self._before(last))
        return kept


def split_at(df: DataFrame, positions: Sequence[int], names: Sequence[str], order: Sequence[str] = ORDER) -> OrderedSplit:
    """Boundaries before the given 0-based positions, which lie inside the table."""
    types = tuple(df.schema[name].dataType.simpleString() for name in order)
    return OrderedSplit(tuple(names), tuple(keys_at(df, positions, order)), tuple(order), types)


def time_split(df: DataFrame, shares: Sequence[float] = (0.70, 0.85), order: Sequence[str] = ORDER) -> OrderedSplit:
    """Train, validation and test by position in time; a boundary may cut through a window."""
    rows = df.count()
    return split_at(df, [int(rows * share) for share in shares], ("train", "val", "test"), order)


def contiguous_folds(df: DataFrame, folds: int = 3, order: Sequence[str] = ORDER) -> OrderedSplit:
    """`folds` consecutive parts whose sizes differ by one row at most."""
    rows = df.count()
    small, extra = divmod(rows, folds)
    ends, end = [], 0
    for i in range(folds - 1):
        end += small + (1 if i < extra else 0)
        ends.append(end)
    return split_at(df, ends, [f"fold{i}" for i in range(folds)], order)


def split_summary(assigned: DataFrame, time: str = "time_window") -> DataFrame:
    return assigned.groupBy("split").agg(
        F.count("*").alias("n"),
        F.to_date(F.min(time)).alias("first_date"),
        F.to_date(F.max(time)).alias("last_date"),
    )


def random_split(df: DataFrame, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([1.0 - test_share, test_share], seed)
    return train, test


def hashed_split(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42) -> Column:
    """A random split that a recomputed task cannot change: the digest of the key alone decides.

    The first eight hex digits are compared as text with those of the share.
    """
    digest = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), 1, 8)
    return F.when(digest < f"{int(test_share * 2**32):08x}", "test").otherwise("train")
