"""Running totals and exact quantiles over one global order, without a single-task window.

Rows are first folded to one row per distinct value, so a value held by a third of all rows is one row. The
distinct values are dealt to ranges by one exchange and written with the number of their range; totals run inside a
range and are shifted by the total of the ranges before. The number of ranges follows the data: adaptive execution
merges small ones, and `spark.sql.shuffle.partitions` is the most there are.

Quantiles need the order of a sliver of the rows only: sketches bracket every wanted rank, a second scan counts what
lies between the brackets and folds what lies inside them, and exact ranks are taken from that sliver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cellpulse.staging import written

#: Accuracy of the sketches that bracket a rank: they are off by at most this share of the rows ...
SKETCH = 2000
#: ... and brackets are so many such shares wide to either side, so that they hold the rank.
MARGIN = 2


def running_totals(folded: DataFrame, key: str, measures: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Adds `<measure>_upto`: the total over all rows of the same `by` with a key up to this one.

    `folded` has one row per (`by`, `key`). It is written once, dealt to ranges: a second range exchange of the same
    rows could draw other boundaries.
    """
    ranged = written(
        folded.repartitionByRange(*by, key).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per range and `by` value that has rows in it.
    offsets = ranged.groupBy(*by, "_range").agg(*[F.sum(m).alias(m) for m in measures]).select(
        *by, "_range", *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_before_{m}") for m in measures]
    )
    inside = Window.partitionBy(*by, "_range").orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = ranged.withColumns({f"_inside_{m}": F.sum(m).over(inside) for m in measures})
    return totals.join(offsets, [*by, "_range"]).select(
        *folded.columns, *[(F.col(f"_inside_{m}") + F.col(f"_before_{m}")).alias(f"{m}_upto") for m in measures]
    )


def _brackets(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], width: float) -> dict[str, tuple[int, list]]:
    """Values that a column has, and for each probability two values between which its rank lies (null: no bound)."""
    edges = [p + side * width for p in probabilities for side in (-1, 1)]
    shares = F.array(*[F.lit(min(1.0, max(0.0, e))) for e in edges])
    counted = [F.count(c).alias(f"n{i}") for i, c in enumerate(columns)]
    sketched = [F.percentile_approx(c, shares, SKETCH).alias(f"s{i}") for i, c in enumerate(columns)]
    row = df.agg(*counted, *sketched).first()
    found = {}
    for i, c in enumerate(columns):
        known = [None if e <= 0 or e >= 1 else v for e, v in zip(edges, row[f"s{i}"] or [None] * len(edges))]
        found[c] = row[f"n{i}"], list(zip(known[::2], known[1::2]))
    return found


def _zones(df: DataFrame, columns: Sequence[str], brackets: dict[str, list]) -> DataFrame:
    """(column, zone, n): the values inside a bracket one by one, those between brackets as one zone. `zone` is
    (lower bounds up to the value, whether it is outside, the value inside), which sorts as the values do."""
    cells = []
    for i, c in enumerate(columns):
        value = F.col(c)
        below = sum(((F.lit(True) if low is None else value >= low).cast("int") for low, _ in brackets[c]), F.lit(0))
        inside = F.lit(False)
        for low, high in brackets[c]:
            here = F.lit(True) if low is None else value >= low
            inside = inside | (here if high is None else here & (value <= high))
        zone = F.struct(below.alias("below"), (~inside).alias("outside"), F.when(inside, value).alias("value"))
        cells.append(F.when(value.isNotNull(), F.struct(F.lit(i).alias("column"), zone.alias("zone"))))
    tall = df.select(F.explode(F.array(*cells)).alias("_cell")).where("_cell is not null")
    return tall.groupBy("_cell.column", "_cell.zone").agg(F.count("*").alias("n"))


def quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], exact: bool = True) -> DataFrame:
    """Rows (column, probability, value), linear between neighbouring ranks; nulls and NaN are ignored, a column
    without values has no rows.

    Two scans of `df` at the call, whose result has one row per column and probability. `exact=False` takes one scan
    with mergeable sketches.
    """
    number = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    names = [f"c{i}" for i in range(len(columns))]
    numbers = df.select(*[number(c).alias(n) for n, c in zip(names, columns)])
    session, schema = df.sparkSession, "column string, probability double, value double"
    if not exact:
        shares = F.array(*[F.lit(float(p)) for p in probabilities])
        row = numbers.agg(*[F.percentile_approx(n, shares, 100_000).alias(n) for n in names]).first()
        rows = [(c, float(p), v) for n, c in zip(names, columns) for p, v in zip(probabilities, row[n] or [])]
        return session.createDataFrame(rows, schema)

    found: dict[tuple[str, float], float] = {}
    width, waiting = MARGIN / SKETCH, list(zip(names, columns))
    while waiting:
        known = _brackets(numbers, [n for n, _ in waiting], probabilities, width)
        waiting = [(n, c) for n, c in waiting if known[n][0]]
        if not waiting:
            break
        asked = [n for n, _ in waiting]
        ranked = running_totals(_zones(numbers, asked, {n: known[n][1] for n in asked}), "zone", ["n"], by=["column"])
        # Each zone answers the ranks it covers: at most two zones per probability, so their number is that of the
        # wanted rows, whatever the data.
        ranks = {
            (i, side, p): side(p * (known[n][0] - 1)) for i, n in enumerate(asked) for p in probabilities
            for side in (math.floor, math.ceil)
        }
        hits = F.create_map(*[
            x for i in range(len(asked))
            for x in (F.lit(i), F.array(*[F.lit(r).cast("long") for r in sorted({r for k, r in ranks.items() if k[0] == i})]))
        ])
        first = F.col("n_upto") - F.col("n")
        covered = ranked.withColumn(
            "ranks", F.filter(hits[F.col("column")], lambda r: (r >= first) & (r < F.col("n_upto")))
        ).where(F.size("ranks") > 0).select("column", "ranks", "zone.outside", "zone.value").collect()
        at = {(row["column"], r): None if row["outside"] else row["value"] for row in covered for r in row["ranks"]}
        missed = []
        for i, (n, c) in enumerate(waiting):
            for p in probabilities:
                low, high = (at[i, ranks[i, side, p]] for side in (math.floor, math.ceil))
                if low is None or high is None:
                    missed.append((n, c))  # the sketch was off by more than it promises: once more, with wider brackets
                    break
                share = p * (known[n][0] - 1)
                found[c, p] = low + (high - low) * (share - math.floor(share)) if high != low else low
        waiting, width = missed, 8 * width
    rows = [(c, float(p), found[c, p]) for c in columns for p in probabilities if (c, p) in found]
    return session.createDataFrame(rows, schema)


def quantile(df: DataFrame, column: str, probability: float, exact: bool = True) -> Column:
    """One quantile as a literal; null if the column has no values."""
    row = quantiles(df, [column], [probability], exact).first()
    return F.lit(row["value"] if row else None).cast("double")


def median(df: DataFrame, column: str, exact: bool = True) -> Column:
    return quantile(df, column, 0.5, exact)
