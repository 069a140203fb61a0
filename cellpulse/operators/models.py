"""Training, tuning, stacking and scoring with `pyspark.ml`.

Inputs are scaled by plain expressions, assembled into one vector and handed to distributed tree or linear
learners; only fitted models and per-model figures reach the driver.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from cellpulse.operators.split import contiguous_folds
from cellpulse.staging import shared_folder


@dataclass(frozen=True)
class ForestParams:
    trees: int = 300
    depth: int = 25
    min_leaf: int = 1
    subset: str = "sqrt"
    seed: int = 42


@dataclass(frozen=True)
class BoostParams:
    rounds: int = 500
    depth: int = 8
    step: float = 0.05
    subsample: float = 0.8
    subset: str = "0.8"
    min_leaf: int = 3
    seed: int = 42


# A stand-in for a leaf-wise learner: deeper trees, a slower rate, larger leaves.
LEAFWISE = BoostParams(depth=10, step=0.03, min_leaf=20)


def forest(params: ForestParams, label: str = "target") -> Estimator:
    return RandomForestRegressor(
        featuresCol="features", labelCol=label, numTrees=params.trees, maxDepth=params.depth,
        featureSubsetStrategy=params.subset, minInstancesPerNode=params.min_leaf, seed=params.seed,
    )


def boosted(params: BoostParams, label: str = "target", weight: str | None = None) -> Estimator:
    learner = GBTRegressor(
        featuresCol="features", labelCol=label, maxIter=params.rounds, maxDepth=params.depth,
        stepSize=params.step, subsamplingRate=params.subsample, featureSubsetStrategy=params.subset,
        minInstancesPerNode=params.min_leaf, seed=params.seed,
    )
    return learner.setWeightCol(weight) if weight else learner


def rare_event_weight(label: str = "target"):
    """Larger counts weigh more: 1 + ln(1 + count)."""
    return F.lit(1.0) + F.log1p(F.col(label))


#: Bytes of rows that a task of a fit holds, and what a row has there besides its inputs and its counts by tree.
TASK_BYTES, ROW_BYTES = 1 << 27, 256


def dealt(train: DataFrame, learner: Estimator, inputs: int, task_bytes: int = TASK_BYTES) -> DataFrame:
    """`train` in partitions that a task of a fit can hold.

    Learners keep the rows of a partition unpacked and read them again in every round, and a small compressed file
    can hold very many. Rows are counted by partition; they are dealt out evenly only if a partition has too many.
    """
    trees = learner.getOrDefault("numTrees") if learner.hasParam("numTrees") else 1
    most = max(1, task_bytes // (8 * inputs + 4 * trees + ROW_BYTES))
    found = train.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    if (found[0] or 0) <= most:
        return train
    return train.repartition(max(math.ceil(found[1] / most), train.sparkSession.sparkContext.defaultParallelism))


def fit(learner: Estimator, train: DataFrame, features: Sequence[str]) -> PipelineModel:
    context = train.sparkSession.sparkContext
    if context.getCheckpointDir() is None:  # boosting cuts its lineage there every few rounds
        context.setCheckpointDir(shared_folder(train.sparkSession))
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return Pipeline(stages=[assembler, learner]).fit(dealt(train, learner, len(features)))


def regressors(forest_params: ForestParams, boost: BoostParams, leafwise: BoostParams) -> dict[str, Estimator]:
    return {
        "forest": forest(forest_params),
        "boosted": boosted(boost),
        "leafwise": boosted(leafwise),
        "weighted": boosted(boost, weight="event_weight"),
    }


def fit_together(fits: Sequence[tuple[Estimator, DataFrame]], features: Sequence[str], parallelism: int = 4) -> list[PipelineModel]:
    """Several fits at a time: the short jobs of one tree level fill the gaps of the others."""
    with ThreadPool(min(parallelism, len(fits))) as pool:
        return pool.map(lambda job: fit(job[0], job[1], features), fits)


def fit_all(learners: Mapping[str, Estimator], train: DataFrame, features: Sequence[str]) -> dict[str, PipelineModel]:
    """Every learner on the same rows."""
    return dict(zip(learners, fit_together([(learner, train) for learner in learners.values()], features)))


def with_weight(train: DataFrame) -> DataFrame:
    """Training rows with the weight the `weighted` regressor reads."""
    return train.withColumn("event_weight", rare_event_weight())


def score(models: Mapping[str, PipelineModel], df: DataFrame) -> DataFrame:
    """Adds one prediction column per model, named after it."""
    scored = df
    for name, model in models.items():
        scored = model.transform(scored).withColumnRenamed("prediction", name).drop("features", "rawPrediction", "probability")
    return scored


def rmse(df: DataFrame, predicted: str, label: str = "target") -> float:
    error = F.col(label) - F.col(predicted)
    return df.agg(F.sqrt(F.avg(error * error))).first()[0]


def draw_trials(base: BoostParams, trials: int, seed: int = 42) -> list[BoostParams]:
    """Seeded random settings. Depth 6-12, rate 0.01-0.1 on a log scale, both shares 0.6-0.95, leaf 1-7."""
    chance = random.Random(seed)
    return [
        replace(
            base,
            depth=chance.randint(6, 12),
            step=math.exp(chance.uniform(math.log(0.01), math.log(0.1))),
            subsample=chance.uniform(0.6, 0.95),
            subset=f"{chance.uniform(0.6, 0.95):.3f}",
            min_leaf=chance.randint(1, 7),
        )
        for _ in range(trials)
    ]


def tune(
    settings: Iterable[BoostParams], train: DataFrame, validation: DataFrame, features: Sequence[str], parallelism: int = 2
) -> DataFrame:
    """Validation RMSE of every setting, best first."""
    settings = list(settings)

    def trial(params: BoostParams) -> float:
        return rmse(fit(boosted(params), train, features).transform(validation), "prediction")

    with ThreadPool(parallelism) as pool:
        losses = pool.map(trial, settings)
    rows = [
        (i, p.depth, p.step, p.subsample, p.subset, p.min_leaf, loss)
        for i, (p, loss) in enumerate(zip(settings, losses))
    ]
    schema = "trial int, depth int, step double, subsample double, subset string, min_leaf int, rmse double"
    return train.sparkSession.createDataFrame(rows, schema).orderBy("rmse", "trial")


def ridge(df: DataFrame, features: Sequence[str], label: str = "target", alpha: float = 1.0) -> PipelineModel:
    """Least squares with `alpha` times the squared norm of the coefficients and a free intercept."""
    stats = df.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("spread")).first()
    learner = LinearRegression(
        featuresCol="features", labelCol=label, solver="normal", elasticNetParam=0.0, standardization=False,
        regParam=alpha * (stats["spread"] or 1.0) / stats["n"],
    )
    return fit(learner, df, features)


@dataclass(frozen=True)
class Stack:
    models: dict[str, PipelineModel]
    meta: PipelineModel

    def apply(self, df: DataFrame, name: str = "stacked") -> DataFrame:
        return score({name: self.meta}, score(self.models, df))


def fit_stack(
    learners: Mapping[str, Estimator], train: DataFrame, features: Sequence[str], folds: int = 3, alpha: float = 1.0
) -> Stack:
    """Out-of-fold predictions of every learner over consecutive folds feed a ridge; the learners are
    then fitted again on all training rows."""
    split = contiguous_folds(train, folds)
    rows = split.assign(train, "_fold")
    others = {name: rows.where(F.col("_fold") != name).drop("_fold") for name in split.names}
    # The last entry of `sources` is the final fit on all rows; everything is fitted in one pool.
    sources = [*others.values(), train]
    fitted = iter(fit_together([(learner, source) for source in sources for learner in learners.values()], features))
    rounds = [{name: next(fitted) for name in learners} for _ in sources]
    parts = [
        score(models, split.part(train, name)).select("target", *learners) for name, models in zip(split.names, rounds)
    ]
    meta = ridge(reduce(DataFrame.unionByName, parts), list(learners), alpha=alpha)
    return Stack(rounds[-1], meta)


def importance(models: Mapping[str, PipelineModel], features: Sequence[str], weights: Mapping[str, float]) -> DataFrame:
    """Weighted sum of the normalised importances of the fitted tree models, one row per feature."""
    total = [0.0] * len(features)
    for name, model in models.items():
        values = model.stages[-1].featureImportances.toArray()
        total = [t + weights.get(name, 0.0) * float(v) for t, v in zip(total, values)]
    return SparkSession.active().createDataFrame(list(zip(features, total)), "feature string, importance double")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_settings(spark: SparkSession, settings: dict, path: str) -> None:
    """Feature names, scaler figures and ensemble weights as one JSON row."""
    spark.createDataFrame([(json.dumps(settings, sort_keys=True),)], "settings string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def load_settings(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def classifiers(label: str, classes: int = 2, trees: int = 100, depth: int = 10) -> dict[str, Estimator]:
    """Forest, two boosted learners and logistic regression; boosting is one-against-rest beyond two classes."""
    common = dict(featuresCol="features", labelCol=label)
    boosted_a = GBTClassifier(maxIter=trees, maxDepth=6, stepSize=0.3, seed=42, **common)
    boosted_b = GBTClassifier(maxIter=trees, maxDepth=3, stepSize=0.1, seed=42, **common)
    if classes > 2:
        boosted_a, boosted_b = (OneVsRest(classifier=b, parallelism=2, **common) for b in (boosted_a, boosted_b))
    return {
        "forest": RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=42, **common),
        "boosted": boosted_a,
        "gradient": boosted_b,
        "logistic": LogisticRegression(maxIter=1000, **common),
    }


def classify(models: Mapping[str, PipelineModel], df: DataFrame) -> DataFrame:
    """Adds `<model>` with the class and, where the model has one, `<model>_confidence`."""
    scored = df
    for name, model in models.items():
        out = model.transform(scored)
        if "probability" in out.columns:
            out = out.withColumn(f"{name}_confidence", F.array_max(vector_to_array("probability")))
        scored = out.withColumnRenamed("prediction", name).drop("features", "rawPrediction", "probability")
    return scored
