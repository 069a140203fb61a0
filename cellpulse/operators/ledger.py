"""Tuning that can be stopped: every finished trial is a row of an append-only table.

Trials are drawn from a seed, so a search that starts again draws the same ones, finds the finished ones in the table
and goes on with the rest; several searches can write into one table.
"""

from __future__ import annotations

import hashlib
import json
import math
import random
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, replace
from multiprocessing.pool import ThreadPool

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cellpulse.operators.models import LEAFWISE, BoostParams, boosted, draw_trials, fit, rmse

SCHEMA = "learner string, trial int, key string, settings string, rmse double"


def draw_leafwise(base: BoostParams, trials: int, seed: int = 42) -> list[BoostParams]:
    """Seeded random settings of the leaf-wise learner. 20 to 150 leaves, which a tree of depth
    ceil(log2) holds, rate 0.01-0.1 on a log scale, both shares 0.6-0.95, leaf 10-50."""
    chance = random.Random(seed)
    return [
        replace(
            base,
            depth=math.ceil(math.log2(chance.randint(20, 150))),
            step=math.exp(chance.uniform(math.log(0.01), math.log(0.1))),
            subsample=chance.uniform(0.6, 0.95),
            subset=f"{chance.uniform(0.6, 0.95):.3f}",
            min_leaf=chance.randint(10, 50),
        )
        for _ in range(trials)
    ]


SPACES: dict[str, Callable[[BoostParams, int, int], list[BoostParams]]] = {"boosted": draw_trials, "leafwise": draw_leafwise}
BASES = {"boosted": BoostParams(), "leafwise": LEAFWISE}


@dataclass(frozen=True)
class TrialLedger:
    """The table of finished trials below `path`."""

    spark: SparkSession
    path: str

    def append(self, learner: str, trial: int, params: BoostParams, loss: float) -> None:
        row = (learner, trial, trial_key(learner, params), json.dumps(asdict(params), sort_keys=True), float(loss))
        # A folder of its own: two trials that end together don't commit into one.
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.json(f"{self.path}/{learner}-{trial}-{uuid.uuid4().hex}")

    def rows(self) -> DataFrame:
        """Finished trials; one that two searches finished counts once."""
        try:
            found = self.spark.read.schema(SCHEMA).json(f"{self.path}/*")
        except AnalysisException:
            return self.spark.createDataFrame([], SCHEMA)
        return found.groupBy("learner", "key").agg(
            F.min("trial").alias("trial"), F.min("settings").alias("settings"), F.min("rmse").alias("rmse")
        ).select(*[c.split()[0] for c in SCHEMA.split(", ")])

    def finished(self) -> set[str]:
        return {r["key"] for r in self.rows().select("key").collect()}

    def best(self, learner: str) -> BoostParams | None:
        row = self.rows().where(F.col("learner") == learner).orderBy("rmse", "trial", "key").first()
        return BoostParams(**json.loads(row["settings"])) if row else None

    def ranking(self) -> DataFrame:
        """Trials with their position within the learner, best first."""
        order = Window.partitionBy("learner").orderBy("rmse", "trial", "key")
        return self.rows().withColumn("position", F.row_number().over(order))


def trial_key(learner: str, params: BoostParams) -> str:
    return hashlib.sha256(f"{learner} {json.dumps(asdict(params), sort_keys=True)}".encode()).hexdigest()[:24]


def search(
    ledger: TrialLedger, train: DataFrame, validation: DataFrame, features: Sequence[str], trials: int = 20,
    bases: Mapping[str, BoostParams] | None = None, parallelism: int = 2, seed: int = 42,
    loss: Callable[[str, BoostParams], float] | None = None,
) -> dict[str, BoostParams]:
    """Runs the trials that the ledger lacks, `trials` per learner, and returns the best settings by learner.

    A trial is written when it ends, so a search that is stopped loses at most those under way.
    """
    def measured(learner: str, params: BoostParams) -> float:
        return rmse(fit(boosted(params), train, features).transform(validation), "prediction")

    loss = loss or measured
    bases = bases or BASES
    done = ledger.finished()
    waiting = [
        (learner, n, params)
        for learner, base in bases.items() for n, params in enumerate(SPACES[learner](base, trials, seed))
        if trial_key(learner, params) not in done
    ]

    def run(job):
        ledger.append(*job, loss(job[0], job[2]))

    if waiting:
        with ThreadPool(min(parallelism, len(waiting))) as pool:
            pool.map(run, waiting, chunksize=1)
    return {learner: ledger.best(learner) for learner in bases}
