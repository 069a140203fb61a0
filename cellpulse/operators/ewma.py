"""Exponentially weighted means of earlier observations."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

# A weight of exp(-NEGLIGIBLE) cannot move a double, and exp(+LIFT_LIMIT) still fits into one.
NEGLIGIBLE = 92.0
LIFT_LIMIT = 320.0


def ewma_features(
    df: DataFrame,
    spans: Sequence[int] = (3, 7),
    value: str = "incident_count",
    cell: str = "cell_id",
    order: str = "time_window",
) -> DataFrame:
    """Adds `ewma_<span>`: the recursive mean with weight 2/(span+1), up to the row before; 0 at first.

    The recursion is a sum of terms weighted with decay^age. Within a block of rows it is a running sum
    of terms lifted by decay^-position, which Spark extends by one addition per row; the block before
    contributes one more sum; older blocks weigh less than a double can hold. The cost per row does not
    depend on the span or on the length of the history, and all sorts share the exchange by cell.
    """
    decays = {span: 1.0 - 2.0 / (span + 1.0) for span in spans}
    steep, flat = min(decays.values()), max(decays.values())
    block = math.ceil(NEGLIGIBLE / -math.log(flat))
    if block * -math.log(steep) > LIFT_LIMIT:
        # No block length suits both ends: the steeper half gets shorter blocks of its own.
        ordered = sorted(decays, key=decays.get)
        half = len(ordered) // 2
        return ewma_features(ewma_features(df, ordered[:half], value, cell, order), ordered[half:], value, cell, order)

    in_cell = Window.partitionBy(cell).orderBy(order)
    in_block = (
        Window.partitionBy(cell, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    block_before = Window.partitionBy(cell).orderBy("_block").rangeBetween(-1, -1)
    by_block = Window.partitionBy(cell).orderBy("_block", order)

    row = F.row_number().over(in_cell) - 1
    positioned = df.withColumn("_row", row).withColumns(
        {"_block": F.floor(F.col("_row") / block), "_place": F.col("_row") % block}
    )
    lifted, current, levels, shifted = {}, {}, {}, {}
    for span, decay in decays.items():
        base, place = F.lit(decay), F.col("_place")
        weight = F.when(F.col("_row") == 0, F.lit(1.0)).otherwise(F.lit(1.0 - decay))
        lifted[f"_lifted_{span}"] = F.col(value) * weight * F.pow(base, -place)
        current[f"_current_{span}"] = F.sum(f"_lifted_{span}").over(in_block)
        # The last row of a full block holds the total of the block.
        total = F.when(place == block - 1, F.col(f"_current_{span}"))
        earlier = F.coalesce(F.sum(total).over(block_before), F.lit(0.0))
        levels[f"_level_{span}"] = F.pow(base, place) * F.col(f"_current_{span}") + F.pow(base, place + block) * earlier
        shifted[f"ewma_{span}"] = F.coalesce(F.lag(f"_level_{span}", 1).over(by_block), F.lit(0.0))
    helpers = ["_row", "_block", "_place", *lifted, *current, *levels]
    # The later steps read the running sums, so these come first, and their order (cell, block, time)
    # serves every step: two sorts in all.
    summed = positioned.withColumns(lifted).withColumns(current)
    return summed.withColumns(levels).withColumns(shifted).drop(*helpers)
