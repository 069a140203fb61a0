"""Gradient boosting in segments that a stopped run goes on from.

A segment is a number of rounds. Its residuals are a written table, its trees a saved model, so after a lost driver the
last finished segment is read and the next one starts from there; the plan of a round never holds more than the trees
of its own segment. The trees of all segments make one `GBTRegressionModel`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from cellpulse.operators.models import BoostParams, dealt, load_settings, save_settings
from cellpulse.staging import discarded, written

SEGMENT = 25


def _model(trees: Sequence[DecisionTreeRegressionModel], step: float, features: int) -> GBTRegressionModel:
    """One boosted model of trees that count `step` each."""
    gateway = trees[0]._java_obj
    context = SparkSession.active().sparkContext
    array = context._gateway.new_array(context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = context._gateway.new_array(context._jvm.double, len(trees))
    for i, tree in enumerate(trees):
        array[i], weights[i] = tree._java_obj, float(step)
    made = context._jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"gbtr_{gateway.uid()}", array, weights)
    return GBTRegressionModel(made)


def _fitted_tree(rows: DataFrame, inputs: int, params: BoostParams, seed: int) -> DecisionTreeRegressionModel:
    """One tree on the residuals; a forest of one without bootstrap has the shares of rows and columns."""
    learner = RandomForestRegressor(
        featuresCol="features", labelCol="_residual", numTrees=1, bootstrap=False, maxDepth=params.depth,
        subsamplingRate=params.subsample, featureSubsetStrategy=params.subset, minInstancesPerNode=params.min_leaf, seed=seed,
    )
    return learner.fit(dealt(rows, learner, inputs)).trees[0]


class SegmentedBoosting:
    """A run of boosting whose segments are below `path`."""

    def __init__(self, spark: SparkSession, path: str, params: BoostParams, segment: int = SEGMENT):
        self.spark, self.path, self.params, self.segment = spark, path, params, segment

    def finished(self) -> int:
        """Segments that are whole: a segment's note is written after its model."""
        n = 0
        while self._note(n) is not None:
            n += 1
        return n

    def _note(self, n: int) -> dict | None:
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/segment-{n}/note/_SUCCESS")
        if not place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            return None
        return load_settings(self.spark, f"{self.path}/segment-{n}/note")

    def _trees(self, n: int) -> list[DecisionTreeRegressionModel]:
        return list(GBTRegressionModel.load(f"{self.path}/segment-{n}/model").trees)

    def fit(self, train: DataFrame, features: Sequence[str], label: str = "target", stop_after: int | None = None) -> PipelineModel | None:
        """Goes on from the last finished segment to `params.rounds`; None if stopped after `stop_after` segments.

        The first prediction is 0, each tree counts `params.step`. A run that goes on with other settings or inputs
        than it began with raises.
        """
        assembler = VectorAssembler(inputCols=list(features), outputCol="features")
        rows = assembler.transform(train).select("features", F.col(label).cast("double").alias("_residual"))
        wanted = {**asdict(self.params), "inputs": list(features), "segment": self.segment}
        done, trees = self.finished(), []
        for n in range(done):
            note = self._note(n)
            if {k: note[k] for k in wanted} != wanted:
                raise ValueError(f"segment {n} of {self.path} was fitted with other settings")
            trees += self._trees(n)
        residuals = None
        if trees:
            residuals = written(self._less(rows, trees), "residuals")
        total = -(-self.params.rounds // self.segment)
        for n in range(done, total):
            if stop_after is not None and n >= stop_after:
                return None
            now = written(rows, "residuals") if residuals is None else residuals
            made: list[DecisionTreeRegressionModel] = []
            for r in range(n * self.segment, min(self.params.rounds, (n + 1) * self.segment)):
                made.append(_fitted_tree(self._less(now, made), len(features), self.params, self.params.seed + r))
            _model(made, self.params.step, len(features)).write().overwrite().save(f"{self.path}/segment-{n}/model")
            save_settings(self.spark, {**wanted, "trees": len(made)}, f"{self.path}/segment-{n}/note")
            trees += made
            residuals = written(self._less(now, made), "residuals")
            discarded(now)
        return PipelineModel([assembler, _model(trees, self.params.step, len(features))])

    def _less(self, rows: DataFrame, trees: Sequence[DecisionTreeRegressionModel]) -> DataFrame:
        """The residuals after some more trees."""
        if not trees:
            return rows
        told = _model(trees, self.params.step, 0).setPredictionCol("_told").transform(rows)
        return told.select("features", (F.col("_residual") - F.col("_told")).alias("_residual"))
