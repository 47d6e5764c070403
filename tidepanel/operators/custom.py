"""Plug in a model that is fitted by partial states: user code on Arrow partitions, merged in a tree."""

import pickle
from collections.abc import Iterator
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.config import TARGET
from tidepanel.operators.trained import Learner, Scorer
from tidepanel.session import settle

FAN_IN = 16  # states that a task merges


class PartialModel(Protocol):
    """A model whose fit is a sum of parts. States are pickled between tasks; merge must not care about the order."""

    def init(self) -> Any:
        """The state of no rows."""

    def update(self, state: Any, x: np.ndarray, y: np.ndarray) -> Any:
        """The state with some more rows: a column of ``x`` per feature."""

    def merge(self, a: Any, b: Any) -> Any:
        """The state of the rows of both."""

    def finish(self, state: Any) -> Any:
        """What ``predict`` needs."""

    def predict(self, fitted: Any, x: np.ndarray) -> np.ndarray:
        """A value per row."""


class LinearModel:
    """Least squares with an intercept and a penalty on the squared coefficients, from its normal equations."""

    def __init__(self, penalty: float = 0.0):
        self.penalty = penalty

    def init(self):
        return 0.0, 0.0

    def update(self, state, x, y):
        x = np.column_stack([np.ones(len(x)), x])
        return state[0] + x.T @ x, state[1] + x.T @ y

    def merge(self, a, b):
        return a[0] + b[0], a[1] + b[1]

    def finish(self, state):
        if np.ndim(state[0]) == 0:
            return None  # no rows
        fit = state[0] + self.penalty * np.diag([0.0, *[1.0] * (len(state[1]) - 1)])
        return np.linalg.lstsq(fit, state[1], rcond=None)[0]

    def predict(self, fitted, x):
        return np.full(len(x), np.nan) if fitted is None else fitted[0] + x @ fitted[1:]


def _numbers(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.column_stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in names])


def merged_state(matrix: DataFrame, features: list[str], model: PartialModel, fan_in: int = FAN_IN) -> Any:
    """The model's state of all rows with a known target.

    A task reduces its partition to one state, batch by batch; then tasks merge ``fan_in`` states each, level by level,
    so one state reaches the driver. How large a state is, is up to the model; rows never leave their task.
    """

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = model.init()
        for batch in batches:
            if batch.num_rows:
                state = model.update(state, _numbers(batch, features), _numbers(batch, [TARGET])[:, 0])
        yield pa.RecordBatch.from_pydict({"state": pa.array([pickle.dumps(state)], pa.binary())})

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by("slot")
        state = model.init()
        for data in table.column("state").to_pylist():
            state = model.merge(state, pickle.loads(data))
        return pa.table({
            "slot": pa.array([table.column("slot")[0].as_py() // fan_in], pa.int64()),
            "state": pa.array([pickle.dumps(state)], pa.binary()),
        })

    rows = matrix.select(*features, TARGET).filter(F.col(TARGET).isNotNull())
    states = rows.mapInArrow(update, "state binary").withColumn("slot", F.spark_partition_id().cast("long"))
    states = settle(states, "states")  # one row per partition
    largest = states.agg(F.max("slot")).first()[0]
    while largest is not None and largest > 0:
        grouped = states.groupBy(F.floor(F.col("slot") / fan_in).alias("_group"))
        states = grouped.applyInArrow(merge, "slot long, state binary")
        largest //= fan_in
    found = states.select("state").collect()
    return pickle.loads(found[0][0]) if found else model.init()


def custom_learner(model: PartialModel, fan_in: int = FAN_IN) -> Learner:
    """A learner for any forecaster of this package; label columns are left to the model's features."""

    def learn(matrix: DataFrame, features: list[str], labels: list[str]) -> Scorer:
        if labels:
            raise ValueError(f"a partial model takes numbers, not the labels {labels}")
        fitted = model.finish(merged_state(matrix, features, model, fan_in))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                y = np.asarray(model.predict(fitted, _numbers(batch, features)), float)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(y, from_pandas=True)], names=[*batch.schema.names, "y_hat"]
                )

        def scorer(rows: DataFrame) -> DataFrame:
            kinds = ", ".join(f"`{c}` {kind}" for c, kind in rows.dtypes)
            return rows.mapInArrow(score, f"{kinds}, y_hat double")

        return scorer

    return learn
