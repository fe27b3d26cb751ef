"""What a training run leaves behind as it goes: checkpoints and metrics.

A checkpoint holds everything the next step depends on: the weights, the
optimiser's moments and step count, and the number of steps done. Batches follow
from the seed and the epoch alone, so a run that goes on from a checkpoint takes
the same steps as one that was never stopped.

Metrics are written step by step, keyed by run and step. A step that is taken
again after a restart replaces what it wrote before, so none is missing or twice.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.versions import Versions

#: Checkpoints kept beside the newest one.
KEPT = 3


class Checkpoints:
    """Checkpoints of one training run in a folder; the version is the number of steps done."""

    def __init__(self, spark: SparkSession, path: str, kept: int = KEPT):
        self.spark, self.kept = spark, kept
        self.versions = Versions(spark, path)

    def save(self, step: int, arrays: dict[str, np.ndarray], about: dict) -> None:
        """Commit flat arrays and a description as the state after ``step`` steps."""
        rows = [(name, i, float(v)) for name, a in arrays.items() for i, v in enumerate(np.asarray(a, np.float64).ravel())]
        values = self.spark.createDataFrame(rows, "name string, place bigint, value double")
        info = self.spark.createDataFrame([(json.dumps(about, sort_keys=True),)], "about string")
        self.versions.write(step, arrays=values.coalesce(1), about=info.coalesce(1))
        self.versions.keep_last(self.kept)

    def load(self) -> tuple[int, dict[str, np.ndarray], dict] | None:
        """Step, arrays and description of the newest complete checkpoint, if there is one."""
        step = self.versions.latest()
        if step is None:
            return None
        table = self.versions.read(step, "arrays").toArrow()  # model-sized
        names, places, values = (table.column(c).to_numpy() for c in ("name", "place", "value"))
        arrays = {}
        for name in dict.fromkeys(names.tolist()):
            mine = names == name
            arrays[name] = np.zeros(int(mine.sum()))
            arrays[name][places[mine]] = values[mine]
        return step, arrays, json.loads(self.versions.read(step, "about").first()["about"])


class MetricLog:
    """Metrics of a run, readable while it goes on and by any other session."""

    def __init__(self, spark: SparkSession, path: str, run: str = "run"):
        if not run or "/" in run:
            raise ValueError(f"not a run name: {run!r}")
        self.spark, self.path, self.run = spark, path.rstrip("/"), run
        self.versions = Versions(spark, f"{self.path}/run={run}")

    def write(self, step: int, values: dict[str, float]) -> None:
        """Commit a step's metrics, in place of what an earlier attempt wrote."""
        rows = [(step, name, float(v)) for name, v in values.items()]
        self.versions.write(step, metrics=self.spark.createDataFrame(rows, "step bigint, metric string, value double").coalesce(1))

    def read(self) -> DataFrame:
        """``(run, step, metric, value)`` of the steps committed so far."""
        paths = [self.versions.table_path(v, "metrics") for v in self.versions.complete()]
        schema = "step bigint, metric string, value double"
        rows = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return rows.select(F.lit(self.run).alias("run"), "step", "metric", "value")
