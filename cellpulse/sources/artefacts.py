"""Everything that scoring needs, stored as one versioned bundle.

A bundle holds a fitted model, the scaler, the order of the inputs, the code tables of text columns, the weights of an
ensemble, the grid and the importances. Its manifest is written last and lists every part with its size, so a bundle
that is incomplete, of another version, or whose parts don't fit each other is refused when it is loaded and not
when it scores.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from cellpulse.operators import models, scaling

#: Version of the layout; bundles of another one are refused.
VERSION = 1


@dataclass(frozen=True)
class Bundle:
    """Parts of a scoring run. `inputs` is the order in which the model wants them; `codes` has a table (value, rows,
    code) per text column, `models` the fitted pipelines by name and `weights` their shares."""

    models: Mapping[str, PipelineModel]
    inputs: Sequence[str]
    weights: Mapping[str, float] = field(default_factory=dict)
    scaler: scaling.Scaler | None = None
    codes: Mapping[str, DataFrame] = field(default_factory=dict)
    grid: DataFrame | None = None
    importance: DataFrame | None = None

    def save(self, spark: SparkSession, path: str) -> None:
        """Writes the parts, then the manifest. Overwrites a bundle at `path`."""
        _delete(spark, f"{path}/manifest")
        parts = {}
        for name, model in self.models.items():
            models.save_model(model, f"{path}/models/{name}")
        tables = {**{f"codes/{c}": t for c, t in self.codes.items()}, "grid": self.grid, "importance": self.importance}
        for name, table in tables.items():
            if table is not None:
                table.write.mode("overwrite").parquet(f"{path}/{name}")
                parts[name] = spark.read.parquet(f"{path}/{name}").count()
        settings = {
            "version": VERSION, "models": list(self.models), "inputs": list(self.inputs), "weights": dict(self.weights),
            "scaler": None if self.scaler is None else asdict(self.scaler), "codes": list(self.codes), "parts": parts,
        }
        _checked(settings)
        models.save_settings(spark, settings, f"{path}/manifest")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Bundle:
        """Reads and checks a bundle; raises ValueError with what is wrong."""
        try:
            settings = json.loads("\n".join(r[0] for r in spark.read.text(f"{path}/manifest").collect()))
        except Exception as error:
            raise ValueError(f"{path} has no manifest: the bundle was not written to its end") from error
        if settings.get("version") != VERSION:
            raise ValueError(f"the bundle has version {settings.get('version')}, this library reads {VERSION}")
        _checked(settings)
        tables = {}
        for name, rows in settings["parts"].items():
            try:
                tables[name] = spark.read.parquet(f"{path}/{name}")
                found = tables[name].count()
            except Exception as error:
                raise ValueError(f"{name} is missing") from error
            if found != rows:
                raise ValueError(f"{name} has {found} rows, the manifest says {rows}")
        loaded = {}
        for name in settings["models"]:
            try:
                loaded[name] = models.load_model(f"{path}/models/{name}")
            except Exception as error:
                raise ValueError(f"model {name} is missing") from error
            wanted = loaded[name].stages[0].getInputCols()
            if list(wanted) != settings["inputs"]:
                raise ValueError(f"model {name} wants other inputs than the manifest lists")
        scaler = settings["scaler"] and scaling.Scaler(*(tuple(settings["scaler"][k]) for k in ("columns", "centers", "scales")))
        return Bundle(
            loaded, settings["inputs"], settings["weights"], scaler, {c: tables[f"codes/{c}"] for c in settings["codes"]},
            tables.get("grid"), tables.get("importance"),
        )

    def score(self, df: DataFrame, name: str = "predicted", suffix: str = "_scaled") -> DataFrame:
        """`df` with a column per model and `name`, their weighted sum (with one model, that one).

        Text columns are encoded by the stored tables (unknown texts count as -1), inputs scaled as they were in
        training, absent inputs are 0. Nothing is fitted and no row moves but for the lookup of rare texts.
        """
        encoded = scaling.encode(df, self.codes)
        encoded = encoded.withColumns({f"{c}_code": F.coalesce(F.col(f"{c}_code"), F.lit(-1)) for c in self.codes})
        scaled = encoded
        if self.scaler is not None:
            absent = [c for c in self.scaler.columns if c not in encoded.columns]
            scaled = self.scaler.apply(encoded.withColumns({c: F.lit(0.0) for c in absent}), suffix)
        scaled = scaled.withColumns({c: F.lit(0.0) for c in self.inputs if c not in scaled.columns})
        scored = models.score(self.models, scaled)
        weights = self.weights or {m: 1.0 for m in list(self.models)[:1]}
        mixed = sum((F.col(m) * F.lit(float(w)) for m, w in weights.items()), F.lit(0.0))
        return scored.withColumn(name, mixed).select(*df.columns, *self.models, name)


def _checked(settings: dict) -> None:
    if not settings["models"]:
        raise ValueError("a bundle needs a model")
    unknown = set(settings["weights"]) - set(settings["models"])
    if unknown:
        raise ValueError(f"weights of models that aren't in the bundle: {sorted(unknown)}")
    scaler = settings["scaler"]
    if scaler and not len(scaler["columns"]) == len(scaler["centers"]) == len(scaler["scales"]):
        raise ValueError("the scaler's columns, centres and scales differ in number")
    if len(set(settings["inputs"])) != len(settings["inputs"]):
        raise ValueError("an input is listed twice")


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def write_grid(metadata: DataFrame, path: str) -> None:
    """The row that describes a grid, as JSON."""
    metadata.coalesce(1).write.mode("overwrite").json(path)


def read_grid(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def first_importance(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(feature, importance) of the first stored table that has both, Parquet or CSV with a header. Raises if none has."""
    for path in paths:
        for read in (spark.read.parquet, spark.read.option("header", True).csv):
            try:
                df = read(path)
            except Exception:
                continue
            if {"feature", "importance"} <= set(df.columns):
                return df.select(F.col("feature").cast("string"), F.col("importance").try_cast("double").alias("importance"))
    raise FileNotFoundError(f"no importances in any of {list(paths)}")
