"""Profiling of a table before it enters the pipeline."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cellpulse.config import KM_PER_DEGREE_LAT, KM_PER_DEGREE_LON
from cellpulse.functions import calendar, parsing
from cellpulse.operators.panel import whole_days


def _rows(table: DataFrame, rows: Sequence[Column]) -> DataFrame:
    """One-row `table` turned into the given structs."""
    return table.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing count and percentage of every column; one aggregation."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return _rows(
        counts,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"`{c}`").alias("missing"),
                F.try_divide(F.col(f"`{c}`") * F.lit(100.0), F.col("_rows")).alias("percentage"),
            )
            for c in df.columns
        ],
    )


def column_profile(df: DataFrame, sample_length: int = 30) -> DataFrame:
    """Position, type and a sample value (the smallest, shortened for display) of every column."""
    samples = df.agg(*[F.min(F.col(f"`{c}`")).cast("string").alias(c) for c in df.columns])
    return _rows(
        samples,
        [
            F.struct(
                F.lit(i).alias("position"),
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.substring(F.coalesce(F.col(f"`{field.name}`"), F.lit("N/A")), 1, sample_length).alias("sample"),
            )
            for i, field in enumerate(df.schema.fields, 1)
        ],
    )


def first_rows(df: DataFrame, key: str, n: int = 3) -> DataFrame:
    return df.orderBy(key).limit(n)


@dataclass(frozen=True)
class RoleRules:
    """How a column name and its mean give away its role."""

    date_words: tuple[str, ...] = ("date",)
    date_not: tuple[str, ...] = ("update",)
    lat_words: tuple[str, ...] = ("lat",)
    lat_names: tuple[str, ...] = ("y coordinate",)
    lat_mean: tuple[float, float] = (41.0, 42.0)
    lon_words: tuple[str, ...] = ("lon", "long")
    lon_names: tuple[str, ...] = ("x coordinate",)
    lon_mean: tuple[float, float] = (-88.0, -87.0)
    category_words: tuple[str, ...] = ("primary type", "crime type")


# The loose rules, which look at names only.
NAME_RULES = {
    "date": (("date", "time", "datetime", "occurred", "reported"), ()),
    "latitude": (("lat", "latitude", "y"), ("location",)),
    "longitude": (("lon", "long", "longitude", "x"), ("location",)),
    "category": (("type", "category", "primary", "description", "offense"), ()),
}


def detect_roles(df: DataFrame, rules: RoleRules = RoleRules()) -> DataFrame:
    """Rows (role, column): names propose candidates, one aggregation checks their mean."""

    def named(words, names=(), without=()):
        return [
            c for c in df.columns
            if (any(w in c.lower() for w in words) or c.lower() in names) and not any(w in c.lower() for w in without)
        ]

    fields = {f.name: f.dataType for f in df.schema.fields}
    numeric = {c for c, t in fields.items() if isinstance(t, T.NumericType)}
    lat = [c for c in named(rules.lat_words, rules.lat_names) if c in numeric]
    lon = [c for c in named(rules.lon_words, rules.lon_names) if c in numeric]
    means = df.agg(F.count("*").alias("_rows"), *[F.avg(f"`{c}`").alias(c) for c in dict.fromkeys(lat + lon)])

    def first(candidates: list[str], within: tuple[float, float] | None = None) -> Column:
        if within is None:
            return F.lit(candidates[0] if candidates else None).cast("string")
        passed = [F.when(F.col(f"`{c}`").between(*within), F.lit(c)) for c in candidates]
        return F.coalesce(*passed, F.lit(None).cast("string"))

    text = [c for c in named(rules.category_words) if isinstance(fields[c], T.StringType)]
    found = {
        "date": first(named(rules.date_words, without=rules.date_not)),
        "latitude": first(lat, rules.lat_mean),
        "longitude": first(lon, rules.lon_mean),
        "category": first(text),
    }
    return _rows(means, [F.struct(F.lit(role).alias("role"), c.alias("column")) for role, c in found.items()])


def detect_roles_by_name(df: DataFrame) -> dict[str, str | None]:
    """The loose variant: the first column whose name has one of the words of a role."""
    found = {}
    for role, (words, without) in NAME_RULES.items():
        found[role] = next(
            (
                f.name for f in df.schema.fields
                if any(w in f.name.lower() for w in words)
                and not any(w in f.name.lower() for w in without)
                and (role != "category" or isinstance(f.dataType, T.StringType))
            ),
            None,
        )
    return found


@dataclass(frozen=True)
class EvidenceRules:
    """Layouts of dates, ranges of coordinates, and the least share of the filled values that must agree."""

    formats: tuple[str, ...] = parsing.TIMESTAMP_FORMATS
    lat_range: tuple[float, float] = (41.6, 42.1)
    lon_range: tuple[float, float] = (-88.0, -87.5)
    least: float = 0.5
    #: Most distinct values of a category, as a share of the filled ones.
    category_share: float = 0.05


def role_evidence(df: DataFrame, rules: EvidenceRules = EvidenceRules()) -> DataFrame:
    """One row per column: position, column, filled, `date_share` (best layout, 1 for dates and timestamps), `layout`,
    `lat_share`, `lon_share` and `distinct_share` of the filled values; null where a column's type rules it out.

    One aggregation over all columns; distinct values are estimated by a sketch.
    """
    counted, rows = [], []
    for i, f in enumerate(df.schema.fields):
        value = F.col(f"`{f.name}`")
        text, number = isinstance(f.dataType, T.StringType), isinstance(f.dataType, T.NumericType)
        counted += [F.count(value).alias(f"n{i}"), F.approx_count_distinct(value, 0.01).alias(f"d{i}")]
        for k, layout in enumerate(rules.formats if text else ()):
            counted.append(F.count(F.try_to_timestamp(value, F.lit(layout))).alias(f"t{i}_{k}"))
        if number:
            counted += [F.count_if(value.between(*rules.lat_range)).alias(f"y{i}"), F.count_if(value.between(*rules.lon_range)).alias(f"x{i}")]
        share = lambda c, i=i: F.try_divide(F.col(c), F.col(f"n{i}"))
        none = F.lit(None).cast("double")
        layouts = [F.struct(share(f"t{i}_{k}").alias("share"), F.lit(-k).alias("k"), F.lit(x).alias("layout")) for k, x in enumerate(rules.formats if text else ())]
        best = F.array_max(F.array(*layouts)) if layouts else None
        dated = isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
        rows.append(F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.col(f"n{i}").alias("filled"),
            (best["share"] if text else F.when(F.col(f"n{i}") > 0, F.lit(1.0)) if dated else none).alias("date_share"),
            (F.when(best["share"] > 0, best["layout"]) if text else F.lit(None).cast("string")).alias("layout"),
            (share(f"y{i}") if number else none).alias("lat_share"), (share(f"x{i}") if number else none).alias("lon_share"),
            (F.least(share(f"d{i}"), F.lit(1.0)) if text else none).alias("distinct_share"),
        ))
    return _rows(df.agg(*counted), rows)


def detect_roles_by_evidence(df: DataFrame, rules: EvidenceRules = EvidenceRules(), hints: RoleRules = RoleRules()) -> DataFrame:
    """Rows (role, column, share): values decide, names only between columns that agree equally.

    A column whose values don't agree isn't taken, whatever its name; a role that no column can have is null.
    """
    def named(words, names=(), without=()) -> Column:
        low = F.lower("column")
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(low, F.lit(w))
        for n in names:
            hit = hit | (low == n)
        for w in without:
            hit = hit & ~F.contains(low, F.lit(w))
        return hit.cast("int")

    found = role_evidence(df, rules)
    few = (F.lit(1.0) - F.col("distinct_share"))
    several = F.col("distinct_share") * F.col("filled") > 1.5  # a single value names no categories
    category = F.when(several & (F.col("distinct_share") <= rules.category_share) & (F.col("date_share") < rules.least), few)
    roles = {
        "date": (F.col("date_share"), named(hints.date_words, without=hints.date_not)),
        "latitude": (F.col("lat_share"), named(hints.lat_words, hints.lat_names)),
        "longitude": (F.col("lon_share"), named(hints.lon_words, hints.lon_names)),
        "category": (category, named(hints.category_words)),
    }
    best = []
    for role, (share, hint) in roles.items():
        # A category's share only says that it is one: names, then the fewest values decide.
        rank = F.struct(hint, share, -F.col("position")) if role == "category" else F.struct(share, hint, -F.col("position"))
        fits = share >= rules.least
        best.append(F.max_by(F.when(fits, F.struct("column", share.alias("share"))), F.when(fits, rank)).alias(role))
    picked = found.agg(*best)
    return _rows(picked, [F.struct(F.lit(r).alias("role"), F.col(r)["column"].alias("column"), F.col(r)["share"].alias("share")) for r in roles])


def name_roles(df: DataFrame) -> DataFrame:
    """The loose variant as rows (role, column)."""
    return df.sparkSession.createDataFrame(list(detect_roles_by_name(df).items()), "role string, column string")


def date_coverage(df: DataFrame, ts: str = "ts") -> DataFrame:
    """One row: extent, span, distinct dates and years, share of readable timestamps."""
    return df.agg(
        F.count(ts).alias("valid"),
        F.try_divide(F.count(ts) * F.lit(100.0), F.count("*")).alias("valid_pct"),
        F.min(ts).alias("earliest"),
        F.max(ts).alias("latest"),
        whole_days(ts).alias("span_days"),
        (whole_days(ts) / F.lit(365.25)).alias("span_years"),
        F.count_distinct(F.to_date(ts)).alias("distinct_dates"),
        F.array_join(F.sort_array(F.collect_set(F.year(ts))).cast("array<string>"), ",").alias("years"),
    )


def coord_coverage(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """One row: share of complete positions, bounding box, approximate area in km2."""
    both = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    y, x = F.when(both, F.col(lat)), F.when(both, F.col(lon))
    height, width = F.max(y) - F.min(y), F.max(x) - F.min(x)
    return df.agg(
        F.count_if(both).alias("valid"),
        F.try_divide(F.count_if(both) * F.lit(100.0), F.count("*")).alias("valid_pct"),
        F.min(y).alias("lat_min"),
        F.max(y).alias("lat_max"),
        F.min(x).alias("lon_min"),
        F.max(x).alias("lon_max"),
        (height * F.lit(KM_PER_DEGREE_LAT) * width * F.lit(KM_PER_DEGREE_LON)).alias("area_km2"),
    )


def category_counts(df: DataFrame, column: str = "category") -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def top_categories(df: DataFrame, column: str = "category", k: int = 15) -> DataFrame:
    """The k most frequent values with their share of all rows and the number of distinct values."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    overall = counts.agg(F.struct(F.sum("n").alias("rows"), F.count(column).alias("distinct"))).scalar()
    # The null group sorts last and is dropped after the limit, so both branches read one exchange.
    return (
        counts.orderBy(F.col(column).isNull(), F.desc("n"), column)
        .limit(k)
        .where(F.col(column).isNotNull())
        .withColumn("_all", overall)
        .select(
            column,
            "n",
            (F.col("n") * F.lit(100.0) / F.col("_all.rows")).alias("share_pct"),
            F.col("_all.distinct").alias("distinct_categories"),
        )
    )


def calendar_histograms(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Counts by year, month, hour and weekday as (part, value, n); one scan, one shuffle."""
    parts = {"year": F.year(ts), "month": F.month(ts), "hour": F.hour(ts), "weekday": calendar.monday_weekday(ts)}
    folded = df.where(F.col(ts).isNotNull()).groupBy(*[c.alias(name) for name, c in parts.items()]).agg(
        F.count("*").alias("n")
    )
    return (
        folded.select(
            "n",
            F.explode(F.array(*[F.struct(F.lit(p).alias("part"), F.col(p).alias("value")) for p in parts])).alias("p"),
        )
        .groupBy("p.part", "p.value")
        .agg(F.sum("n").alias("n"))
    )


def filled_calendar_histograms(df: DataFrame, ts: str = "ts") -> DataFrame:
    """The 24 hours, 7 weekdays and 12 months, absent ones 0; derived from one folded count."""
    folded = df.where(F.col(ts).isNotNull()).groupBy(
        F.hour(ts).alias("hour"), calendar.monday_weekday(ts).alias("weekday"), F.month(ts).alias("month")
    ).agg(F.count("*").alias("n"))
    tall = folded.select(
        "n",
        F.explode(
            F.array(*[F.struct(F.lit(p).alias("part"), F.col(p).alias("value")) for p in ("hour", "weekday", "month")])
        ).alias("p"),
    ).groupBy(F.col("p.part").alias("part"), F.col("p.value").alias("value")).agg(F.sum("n").alias("n"))
    slots = df.sparkSession.range(24 + 7 + 12).select(
        F.when(F.col("id") < 24, "hour").when(F.col("id") < 31, "weekday").otherwise("month").alias("part"),
        F.when(F.col("id") < 24, F.col("id")).when(F.col("id") < 31, F.col("id") - 24).otherwise(F.col("id") - 30)
        .cast("int").alias("value"),
    )
    # `tall` has at most 43 rows.
    filled = slots.join(F.broadcast(tall), ["part", "value"], "left").select(
        "part", "value", F.coalesce("n", F.lit(0)).alias("n")
    )
    largest = tall.groupBy("part").agg(F.max("n").alias("largest"))
    return filled.join(F.broadcast(largest), "part", "left").select(
        "part",
        "value",
        "n",
        F.coalesce(F.floor(F.col("n") / F.col("largest") * 40), F.lit(0)).cast("int").alias("bar"),
    )


def weekend_counts(df: DataFrame, ts: str = "ts") -> DataFrame:
    flag = calendar.weekend_flag(calendar.monday_weekday(ts))
    return df.where(F.col(ts).isNotNull()).groupBy(flag.alias("is_weekend")).agg(F.count("*").alias("n"))
