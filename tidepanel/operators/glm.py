"""Tweedie models with a log link for many groups at once, by sums that Spark aggregates.

A group is a category of series, or a candidate of a search, or both. Each step of iteratively reweighted least
squares is one aggregation over all rows: the weighted normal equations of every group, some dozens of sums. The
small systems are solved per group inside tasks, so neither rows nor groups pass through the driver.

The training rows are stored packed, some to a binary value, as tasks make them. So a step moves bytes to the tasks'
numpy instead of fields, and its sums are products of small matrices. Candidates of a search are few and each has some
dozens of numbers, so their systems are solved by the driver.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.config import DAY, KEY, TARGET
from tidepanel.operators.features import BASE, Calendar, Spec, lagged, reach, training_batches
from tidepanel.operators.folds import Folds, fold_context, unpack
from tidepanel.operators.trained import Scorer, recursive_forecast
from tidepanel.session import settle

STEPS = 8
LARGEST = 50.0  # most that the linear predictor may reach either way, so that no step leaves the numbers
PIECE = 64  # training rows in a binary value, feature by feature; a reader of the table holds thousands of values at once
CHUNK = 8_192  # training rows whose sums are formed at once
MEANS = np.log([1e-16, np.finfo(float).max])  # bounds of the logarithm of a mean, those of MLlib's estimator


def logged(rows: DataFrame, features: list[str]) -> DataFrame:
    """Features as logarithms: with a log link the mean is a product of their powers."""
    return rows.withColumns({f"_log_{f}": F.signum(f) * F.log1p(F.abs(f)) for f in features})


def _linear(features: list[str]) -> Column:
    total = F.get("_beta", F.lit(0))
    for i, name in enumerate(features):
        total = total + F.get("_beta", F.lit(i + 1)) * F.col(name)
    # NULL stays NULL, which the bounds alone would replace
    return F.when(total.isNotNull(), F.least(F.greatest(total, F.lit(-LARGEST)), F.lit(LARGEST)))


def _packed(features: list[str], groups: list[str], sets: list[list[str]], logs: bool = False
            ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches to PIECE rows of a group at a time, all targets first, then feature by feature, as ``_rows``, with the
    group's columns. Rows in which each of the sets has an unknown feature, or without a target, are left out."""
    within = [[1 + features.index(name) for name in names] for names in sets]

    def into(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in (TARGET, *features)]
            if logs:
                numbers[1:] = [np.sign(v) * np.log1p(np.abs(v)) for v in numbers[1:]]
            rows = np.column_stack(numbers)
            known = ~np.isnan(rows)
            keep = known[:, 0] & np.logical_or.reduce([known[:, own].all(axis=1) for own in within])
            if not keep.any():
                continue
            rows, batch = rows[keep], batch.select(groups).filter(pa.array(keep))
            codes = np.zeros(len(rows), np.int64)
            for c in groups:
                ids = batch.column(c).dictionary_encode(null_encoding="encode")
                codes = codes * len(ids.dictionary) + ids.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(codes, kind="stable")
            opens = np.flatnonzero(np.diff(codes[order], prepend=-1))
            rows, starts, parts = rows[order], [], []
            for i, j in zip(opens, [*opens[1:], len(rows)]):
                whole = j - (j - i) % PIECE
                starts += range(i, j, PIECE)
                parts += [rows[i:whole].reshape(-1, PIECE, rows.shape[1]).transpose(0, 2, 1).ravel(), rows[whole:j].T.ravel()]
            ends = (np.append(starts, len(rows)) * rows.shape[1] * 8).astype(np.int32)
            buffers = [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate(parts))]
            pieces = pa.Array.from_buffers(pa.binary(), len(starts), buffers)
            own = [batch.column(c).take(pa.array(order[starts])) for c in groups]
            yield pa.RecordBatch.from_arrays([*own, pieces], [*groups, "_rows"])

    return into


def _kinds(table: DataFrame, names: list[str]) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in table.schema}
    return "".join(f"`{name}` {kinds[name]}, " for name in names)


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of binary values, and at which of them each value begins, with the end."""
    column = column.cast(pa.binary())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(np.float64), (ends - ends[0]) // 8


def _chunks(numbers: np.ndarray, at: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(targets, an intercept's ones and the features, a line each) of neighbouring pieces, at most CHUNK rows."""
    sizes = np.diff(at)
    opens = np.flatnonzero(np.diff(sizes, prepend=-1))
    for i, j in zip(opens, [*opens[1:], len(sizes)]):
        for k in range(i, j, CHUNK // PIECE):
            end = min(j, k + CHUNK // PIECE)
            part = numbers[at[k] : at[end]].reshape(end - k, width, -1).transpose(1, 0, 2).reshape(width, -1).copy()
            y = part[0].copy()
            part[0] = 1.0
            yield y, part


def _products(x: np.ndarray, weight: np.ndarray | None, z: np.ndarray) -> np.ndarray:
    """Sums of weight * a * b for all pairs of the columns x and z."""
    every = np.vstack([x, z])
    return (every if weight is None else every * weight) @ every.T


def _equations(blocks: DataFrame, groups: list[str], width: int, first: bool) -> DataFrame:
    """Per group the sums of weight * x_i * x_j and weight * x_i * response, as two arrays, and the penalty.

    ``width`` counts the features and the intercept. Apart from the first step, ``blocks`` have their group's ``_beta``.
    """
    upper = np.triu_indices(width)
    n = len(upper[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers, at = _unpacked(batch.column("_rows"))
            changes = np.zeros(batch.num_rows, bool)
            changes[0] = True
            for c in groups:
                codes = batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                changes[1:] |= codes[1:] != codes[:-1]
            opens = np.flatnonzero(changes)
            found = []
            for i, j in zip(opens, [*opens[1:], batch.num_rows]):
                power = batch.column("_power")[i].as_py()
                beta = None if first else np.array(batch.column("_beta")[i].as_py())
                sums = np.zeros((width + 1, width + 1))
                for y, x in _chunks(numbers, at[i : j + 1], width):
                    eta = np.log(np.where(y > 0, y, 0.1)) if first else np.clip(beta @ x, -LARGEST, LARGEST)
                    mean = np.exp(eta)
                    sums += _products(x, np.exp((2 - power) * eta), eta + (y - mean) / mean)
                found.append([*sums[:width, :width][upper], *sums[:width, width]])
            own = batch.select([*groups, "_penalty"]).take(pa.array(opens))
            sums = [pa.array(v) for v in np.array(found).T]
            yield pa.RecordBatch.from_arrays([*own.columns, *sums], [*own.schema.names, *[f"_s{i}" for i in range(len(sums))]])

    names = [f"_s{i}" for i in range(n + width)]
    schema = _kinds(blocks, [*groups, "_penalty"]) + ", ".join(f"{s} double" for s in names)
    return blocks.mapInArrow(run, schema).groupBy(*groups).agg(
        F.array(*[F.sum(s) for s in names[:n]]).alias("_squares"), F.array(*[F.sum(s) for s in names[n:]]).alias("_right"),
        F.first("_penalty").alias("_penalty"),
    )


def _solved(equations: DataFrame, width: int) -> DataFrame:
    """Groups with ``_beta``. The penalty is a share of the weight; the intercept has none. A singular system gets the
    least-squares solution of least size."""
    upper = np.triu_indices(width)
    kinds = [(f.name, f.dataType.simpleString()) for f in equations.schema if not f.name.startswith("_")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            betas = []
            for squares, right, share in zip(*(batch.column(c).to_pylist() for c in ("_squares", "_right", "_penalty"))):
                a = np.zeros((width, width))
                a[upper] = squares
                a = a + np.triu(a, 1).T
                a[range(1, width), range(1, width)] += share * a[0, 0]
                betas.append(np.linalg.lstsq(a, np.array(right), rcond=1e-13)[0].tolist())
            columns = {name: batch.column(name) for name, _ in kinds}
            yield pa.RecordBatch.from_pydict(columns | {"_beta": pa.array(betas, pa.list_(pa.float64()))})

    schema = ", ".join(f"`{name}` {kind}" for name, kind in kinds)
    return equations.mapInArrow(run, f"{schema}, _beta array<double>")


def _settings(power: Column | float, penalty: Column | float) -> dict[str, Column]:
    both = {"_power": power, "_penalty": penalty}
    return {n: (F.lit(float(v)) if isinstance(v, (int, float)) else v).cast("double") for n, v in both.items()}


def coefficients(rows: DataFrame, features: list[str], groups: list[str], power: Column | float = 1.5,
                 penalty: Column | float = 0.0, steps: int = STEPS) -> DataFrame:
    """(groups…, _beta): intercept and a coefficient per feature after so many steps, from the target itself on.

    ``power`` and ``penalty`` may be expressions of the group's columns. Variance is the mean to the power. Rows are
    stored once; a group of any size is a partial aggregation. The first step takes a zero target as 0.1.
    """
    own = rows.select(*groups, *[c.alias(n) for n, c in _settings(power, penalty).items()], TARGET, *features)
    keys = [*groups, "_power", "_penalty"]
    blocks = own.mapInArrow(_packed(features, keys, [features]), _kinds(own, keys) + "_rows binary")
    return _fitted(settle(blocks, "matrix"), groups, len(features) + 1, steps)


def _fitted(blocks: DataFrame, groups: list[str], width: int, steps: int) -> DataFrame:
    beta = settle(_solved(_equations(blocks, groups, width, True), width), "beta")
    for _ in range(steps - 1):
        known = blocks.join(beta, groups)
        beta = settle(_solved(_equations(known, groups, width, False), width), "beta")
    return beta


def glm_scorer(beta: DataFrame, features: list[str], groups: list[str]) -> Scorer:
    """Rows of a group that was not fitted have no forecast. Spark decides by its size how ``beta`` is joined."""

    def scorer(rows: DataFrame) -> DataFrame:
        names = [f"_log_{f}" for f in features]
        known = logged(rows, features).join(beta, groups, "left")
        return known.withColumn("y_hat", F.exp(_linear(names))).drop("_beta", *names)

    return scorer


def per_category_glm(of: Column, power: float = 1.5, specs: list[Spec] = BASE, penalty: float = 1e-6,
                     steps: int = STEPS):
    """One tweedie model per category on a shared set of features; all categories are fitted together.

    ``of`` gives a series' category. The forecast rows carry it as ``category``.
    """
    names = [s.name for s in specs]

    def forecaster(panel: DataFrame, folds: Folds) -> DataFrame:
        kinds = _kinds(panel.select(of.alias("category")), ["category"])
        blocks = training_batches(panel, [specs], folds.first, {"category": of}, _packed(names, ["category"], [names], True),
                                  kinds + "_rows binary")
        return _recursed(blocks, of, panel, folds, power, specs, penalty, steps).withColumn("category", of)

    forecaster.fitted = True
    return forecaster


def _recursed(blocks: DataFrame, of: Column, panel: DataFrame, folds: Folds, power: float, specs: list[Spec],
              penalty: float, steps: int) -> DataFrame:
    names = [s.name for s in specs]
    blocks = settle(blocks.withColumns(_settings(power, penalty)), "matrix")
    beta = _fitted(blocks, ["category"], len(names) + 1, steps)
    return recursive_forecast(glm_scorer(beta, names, ["category"]), panel, folds, specs, {"category": of})


def tweedie_glm(power: float = 1.5, specs: list[Spec] = BASE, penalty: float = 1e-6, steps: int = STEPS):
    """One tweedie model of all series, by the same sums."""
    names, one = [s.name for s in specs], F.lit("all")

    def forecaster(panel: DataFrame, folds: Folds) -> DataFrame:
        blocks = training_batches(panel, [specs], folds.first, {}, _packed(names, [], [names], True), "_rows binary")
        return _recursed(blocks.withColumn("category", one), one, panel, folds, power, specs, penalty, steps)

    forecaster.fitted = True
    return forecaster


@dataclass(frozen=True)
class Tweedie:
    """A candidate of a search: what MLlib's estimator is given, and the features."""

    specs: tuple[Spec, ...]
    power: float
    penalty: float
    max_iter: int = 25
    tol: float = 1e-4


def _solution(sums: np.ndarray, penalty: float, first: bool) -> np.ndarray:
    """Intercept and coefficients of MLlib's weighted least squares, from the sums of all products of the columns.

    The penalty is a share of the weight; in the first step it is one of the scaled features and target. A feature
    that has one value only gets no coefficient, and neither do all features of a target that has one value only.
    """
    width, mean = len(sums) - 1, sums / sums[0, 0]
    spread = np.sqrt(np.maximum(np.diag(mean) - mean[0] ** 2, 0.0))  # of the intercept 0, of the response the last one
    beta = np.zeros(width)
    if spread[-1] == 0:
        beta[0] = mean[0, -1]
        return beta
    kept = np.flatnonzero(np.append(True, spread[1:-1] != 0))
    ridge = np.full(width, penalty) if not first else penalty / spread[-1] * spread[:-1] ** 2
    ridge[0] = 0.0
    a, right = (mean[:width, :width] + np.diag(ridge))[np.ix_(kept, kept)], mean[kept, -1]
    try:
        beta[kept] = np.linalg.solve(a, right)
    except np.linalg.LinAlgError:
        beta[kept] = np.linalg.lstsq(a, right, rcond=None)[0]
    return beta


def _candidate_sums(blocks: DataFrame, models: dict[int, tuple[Tweedie, list[int]]], betas: dict[int, np.ndarray],
                    width: int) -> dict[int, np.ndarray]:
    """Per candidate the sums of weight * a * b for all columns a and b: the intercept, all features, the response.

    A candidate without coefficients starts from the target itself. Features of others are 0 in its sums.
    """
    upper = np.triu_indices(width + 1)
    names = [f"_s{i}" for i in range(len(upper[0]))]

    def response(model: Tweedie, y: np.ndarray, x: np.ndarray, beta: np.ndarray | None):
        if beta is None:
            return None, np.log(np.maximum(y, 0.1) if model.power == 1 else np.where(y == 0, 0.1, y))
        eta = beta @ x
        bounded = np.clip(eta, *MEANS)
        mean = np.exp(bounded)
        return np.exp((2 - model.power) * bounded), eta + (y - mean) / mean

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sums = {t: np.zeros((width + 1, width + 1)) for t in models}
            for y, x in _chunks(*_unpacked(batch.column("_rows")), width):
                if (y < 0).any():
                    raise ValueError("the target of a tweedie model is below zero")
                unknown = np.isnan(x).any()
                for t, (model, lines) in models.items():
                    own, target = x[lines], y
                    if unknown:
                        known = ~np.isnan(own).any(axis=0)
                        own, target = own[:, known], y[known]
                    weight, z = response(model, target, own, betas.get(t))
                    sums[t][np.ix_([*lines, width], [*lines, width])] += _products(own, weight, z)
            found = np.array([v[upper] for v in sums.values()]).T
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), *map(pa.array, found)], ["trial", *names])

    each = blocks.mapInArrow(run, "trial long, " + ", ".join(f"{s} double" for s in names))
    out = {}
    for row in each.groupBy("trial").agg(*[F.sum(s).alias(s) for s in names]).collect():
        whole = np.zeros((width + 1, width + 1))
        whole[upper] = row[1:]
        lines = [*models[row[0]][1], width]
        out[row[0]] = (whole + np.triu(whole, 1).T)[np.ix_(lines, lines)]
    return out


def fitted_candidates(panel: DataFrame, candidates: dict[int, Tweedie], cutoff) -> dict[int, np.ndarray]:
    """Intercept and coefficients of each candidate, by the steps of MLlib's estimator and its rule to end them.

    All candidates read one stored table of training rows, and each step is one pass over it for all that go on.
    """
    sets = list(dict.fromkeys(c.specs for c in candidates.values()))
    names = list(dict.fromkeys(s.name for own in sets for s in own))
    into = _packed(names, [], [[s.name for s in own] for own in sets], True)
    blocks = settle(training_batches(panel, [list(own) for own in sets], cutoff, {}, into, "_rows binary"), "matrix")
    models = {t: (c, [0, *[1 + names.index(s.name) for s in c.specs]]) for t, c in candidates.items()}
    betas: dict[int, np.ndarray] = {}
    going, step = dict(models), 0
    while going:
        sums = _candidate_sums(blocks, going, betas, len(names) + 1)
        for t, (c, _) in list(going.items()):
            if t not in sums or not sums[t][0, 0]:
                raise ValueError("there are no training rows")
            beta = _solution(sums[t], c.penalty, step == 0)
            if step and np.abs(beta - betas[t]).max() < c.tol or step == c.max_iter:
                del going[t]
            betas[t] = beta
        step += 1
    return betas


def candidate_forecasts(panel: DataFrame, candidates: dict[int, Tweedie], folds: Folds) -> DataFrame:
    """Forecasts of the folds once per candidate: (unique_id, ds, cutoff, h, y, y_hat, trial), fitted at the first cutoff.

    Tasks walk the horizon on batches of contexts, which are made once for all candidates.
    """
    betas, horizon = fitted_candidates(panel, candidates, folds.first), folds.horizon
    far = max(reach(list(c.specs)) for c in candidates.values())
    days = F.sequence(F.lit(1), F.lit(horizon))
    calendars = {s.name: s for c in candidates.values() for s in c.specs if isinstance(s, Calendar)}

    def by_step(spec: Calendar) -> Column:
        return F.transform(days, lambda i: spec.of(F.date_add("cutoff", i)).cast("double"))

    contexts = fold_context(panel, folds, far).withColumns({name: by_step(s) for name, s in calendars.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue

            def table(column: str) -> np.ndarray:
                return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)

            past, later = table("past"), {name: table(name) for name in calendars}
            for t, c in candidates.items():
                seen = np.column_stack([past, np.full((n, horizon), np.nan)])
                known = np.empty((n, horizon), bool)
                for h in range(horizon):
                    x = np.array([later[s.name][:, h] if isinstance(s, Calendar) else s.last(seen[:, h : h + far])
                                  for s in c.specs])
                    known[:, h] = ~np.isnan(x).any(axis=0)  # a series too short for a feature gets no forecast
                    eta = betas[t][0] + betas[t][1:] @ (np.sign(x) * np.log1p(np.abs(x)))
                    seen[:, far + h] = np.exp(np.clip(eta, *MEANS))
                flat = pa.array(seen[:, far:].ravel(), mask=~known.ravel())
                ends = pa.array(np.arange(0, n * horizon + 1, horizon, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*batch.select([KEY, "cutoff", "future"]).columns, pa.ListArray.from_arrays(ends, flat),
                     pa.array([t] * n, pa.int64())], [KEY, "cutoff", "future", "path", "trial"])

    paths = contexts.mapInArrow(run, f"{KEY} string, cutoff date, future array<double>, path array<double>, trial long")
    out = unpack(paths, folds, lambda h: F.get("path", h - 1), {"trial": F.col("trial")})
    return out.filter(F.col("y_hat").isNotNull())
