"""Joining a table to a value per key when some keys may hold a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# A key with more than 1 % of the rows is always among the 100 most frequent ones.
FREQUENT = 100


def spread_lookup(
    df: DataFrame, values: DataFrame, key: str, rows: str, spread_by: Sequence[str], frequent: int = FREQUENT
) -> DataFrame:
    """Left join of `values` (unique by `key`) that looks frequent keys up in place.

    `values` carries in `rows` how many rows of `df` have the key. The `frequent` keys with most rows are read
    with their values as a map, so their rows need no partner in the join; these rows, and those without a key,
    are dealt out by the hash of `spread_by` instead of by the key. No hint is given: run-time sizes decide
    whether the lookup is broadcast.
    """
    added = [c for c in values.columns if c not in (key, rows)]
    # Both readers of `counted` need all of its columns, which lets them share one exchange.
    counted = values.where(F.col(rows) > 0)
    entry = F.struct(F.col(key).alias("key"), F.struct(*added).alias("value"))
    known = counted.orderBy(F.desc(rows), key, *added).limit(frequent).agg(F.map_from_entries(F.collect_list(entry))).scalar()
    alone = F.col("_here").isNotNull() | F.col(key).isNull()
    placed = df.withColumn("_map", known).withColumn("_here", F.try_element_at("_map", F.col(key))).withColumns(
        {
            "_key": F.when(~alone, F.col(key)),
            "_deal": F.when(alone, F.xxhash64(*spread_by)).otherwise(F.lit(0).cast("long")),
        }
    )
    # Always 0, but not a constant: a constant would leave the key alone to deal the rows, and rows without one would
    # share a task.
    nothing = F.pmod(F.xxhash64(key), F.lit(1)).cast("long")
    others = counted.select(F.col(key).alias("_key"), nothing.alias("_deal"), F.struct(*added).alias("_there"))
    return placed.drop("_map").join(others, ["_key", "_deal"], "left").select(
        *df.columns, *[F.coalesce(F.col("_here")[c], F.col("_there")[c]).alias(c) for c in added]
    )
