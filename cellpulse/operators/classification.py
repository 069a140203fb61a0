"""Quality of class predictions from folded confusion counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cellpulse.operators.ordered import running_totals


def counts(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return (
        df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
        .groupBy(*by, F.col(actual).alias("actual"), F.col(predicted).alias("predicted"))
        .agg(F.count("*").alias("n"))
    )


def confusion(df: DataFrame, actual: str, predicted: str, dense: bool = False) -> DataFrame:
    """Counts of the pairs of classes that occur, in long form; `dense` adds the absent pairs with 0, for class
    lists short enough for a square table."""
    found = counts(df, actual, predicted)
    if not dense:
        return found
    classes = found.agg(F.sort_array(F.array_union(F.collect_set("actual"), F.collect_set("predicted")))).scalar()
    pairs = (
        found.agg(F.count("*").alias("_n"))
        .select(F.explode(classes).alias("actual"))
        .withColumn("predicted", F.explode(classes))
    )
    return pairs.join(found, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("n", F.lit(0)).alias("n")
    )


def class_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1; a division by zero counts as 0."""
    found = counts(df, actual, predicted, by)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    nothing = F.lit(0).cast("long")
    roles = F.array(
        F.struct(F.col("actual").alias("cls"), F.col("n").alias("support"), nothing.alias("claimed"), hit.alias("hits")),
        F.struct(F.col("predicted").alias("cls"), nothing.alias("support"), F.col("n").alias("claimed"), nothing.alias("hits")),
    )
    per_class = (
        found.select(*by, F.explode(roles).alias("r"))
        .groupBy(*by, "r.cls")
        .agg(F.sum("r.support").alias("support"), F.sum("r.claimed").alias("claimed"), F.sum("r.hits").alias("hits"))
    )

    def share(part: str, whole):
        return F.when(whole > 0, F.col(part) / whole).otherwise(F.lit(0.0))

    scored = per_class.select(
        *by,
        "support",
        "hits",
        share("hits", F.col("claimed")).alias("precision"),
        share("hits", F.col("support")).alias("recall"),
        share("hits", (F.col("claimed") + F.col("support")) / 2).alias("f1"),
    )
    total = F.sum("support")
    weighted = [F.try_divide(F.sum(F.col(m) * F.col("support")), total).alias(m) for m in ("precision", "recall", "f1")]
    return scored.groupBy(*by).agg(F.try_divide(F.sum("hits"), total).alias("accuracy"), *weighted)


def model_comparison(df: DataFrame, actual: str, models: Sequence[str]) -> DataFrame:
    """`class_metrics` of every prediction column; rows are unfolded and folded before the shuffle."""
    tall = df.select(
        F.col(actual).alias("actual"),
        F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("guess")) for m in models])).alias("m"),
    ).select("actual", "m.*")
    return class_metrics(tall, "actual", "guess", by=["model"])


def roc_curve(df: DataFrame, actual: str, score: str) -> DataFrame:
    """False and true positive rate at every distinct score and at the origin (null threshold)."""
    hits, misses = F.count_if(F.col(actual) == 1), F.count_if(F.col(actual) != 1)
    folded = (
        df.where(F.col(actual).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.negate(F.col(score).cast("double")).alias("key"))
        .agg(hits.alias("pos"), misses.alias("neg"))
    )
    whole = folded.agg(F.struct(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))).scalar()
    points = running_totals(folded, "key", ["pos", "neg"]).withColumn("_all", whole).select(
        F.negate("key").alias("threshold"),
        F.try_divide("neg_upto", "_all.neg").alias("fpr"),
        F.try_divide("pos_upto", "_all.pos").alias("tpr"),
        F.try_divide("neg", "_all.neg").alias("_width"),
        F.try_divide("pos", "_all.pos").alias("_rise"),
    )
    zero = F.lit(0.0)
    origin = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), zero.alias("fpr"), zero.alias("tpr"), zero.alias("_width"), zero.alias("_rise")
    )
    return points.unionByName(origin)


def roc_points(df: DataFrame, actual: str, score: str) -> DataFrame:
    return roc_curve(df, actual, score).select("threshold", "fpr", "tpr")


def roc_auc(df: DataFrame, actual: str, score: str) -> DataFrame:
    """Area under the curve by trapezoids; null unless both classes occur."""
    area = F.sum(F.col("_width") * (F.col("tpr") - F.col("_rise") / 2))
    return roc_curve(df, actual, score).agg(F.when(F.max("fpr") + F.max("tpr") >= 2, area).alias("auc"))


def prediction_distribution(df: DataFrame, predicted: str, confidence: str | None = None) -> DataFrame:
    """Rows, share and mean confidence of every predicted class."""
    rows = df.agg(F.count("*")).scalar()
    extra = [F.avg(confidence).alias("mean_confidence")] if confidence else []
    return (
        df.groupBy(F.col(predicted).alias("predicted"))
        .agg(F.count("*").alias("n"), *extra)
        .withColumn("share_pct", F.col("n") * F.lit(100.0) / rows)
    )
