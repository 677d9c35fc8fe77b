"""Spark's multilayer perceptron, fitted in arrays where a table is large.

The loss, the first weights and the steps (L-BFGS with a search for the strong Wolfe conditions) are those of Spark's trainer, and the
fitted model is Spark's. Equal rows, such as the copies that balance classes, are passed once with their number. A step
costs a job only where its work is worth one; smaller fits run their steps in one task.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.common import _java2py, _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession, functions as F

from modrisk.functions.tasks import tasks_for

SPARKS_ROWS = 1_000  # up to so many rows Spark's trainer has one task a step
ROWS_PER_TASK = 1_000
ONE_TASK_WORK = 150_000_000  # rows times weights: some 60 ms a pass
BLOCK_ROWS = 512
MEMORY = 10
LONGEST_SEARCH = 10
DECREASE, CURVATURE = 1e-4, 0.9

Evaluate = Callable[[np.ndarray], tuple[float, np.ndarray]]


class SearchFailed(ArithmeticError):
    pass


def _between(low: tuple, high: tuple) -> float:
    """Minimum of the cubic through two points (t, value, slope), not too near to either."""
    (t, v, s), (u, w, r) = sorted((low, high))
    with np.errstate(all="ignore"):
        d1 = s + r - 3 * (v - w) / (t - u)
        d2 = np.sqrt(d1 * d1 - s * r)
        x = u - (u - t) * (r + d2 - d1) / (r - s + 2 * d2)
    least, most = t + 0.1 * (u - t), t + 0.9 * (u - t)
    return least if x < least else most if x > most else x


def _searched(evaluate: Evaluate, x: np.ndarray, value: float, slope: float, direction: np.ndarray, t: float) -> tuple:
    """(step, x, value, gradient) along a direction, by the strong Wolfe conditions; ``t`` is tried first."""
    if slope > 0:
        raise SearchFailed("no descent")
    last = None

    def at(t: float) -> tuple:
        nonlocal last
        moved = x + direction * t
        found, gradient = evaluate(moved)
        last = t, moved, found, gradient
        return t, found, float(gradient @ direction)

    def zoom(low: tuple, high: tuple) -> tuple:
        for _ in range(LONGEST_SEARCH):
            c = at(_between(low, high))
            if not (c[1] <= value + DECREASE * c[0] * slope and c[1] < low[1]):
                high = c
                continue
            if abs(c[2]) <= CURVATURE * abs(slope):
                return last
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise SearchFailed("no step between")

    low = 0.0, value, slope
    for i in range(LONGEST_SEARCH):
        c = at(t)
        if not np.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > value + DECREASE * t * slope or (i and c[1] >= low[1]):
            return zoom(low, c)
        if abs(c[2]) <= CURVATURE * abs(slope):
            return last
        if c[2] >= 0:
            return zoom(c, low)
        low, t = c, t * 1.5
    raise SearchFailed("no step")


def minimised(evaluate: Evaluate, x: np.ndarray, most: int, tolerance: float) -> np.ndarray:
    """L-BFGS as Spark runs it: at most ``most`` steps, until the value or the gradient hardly changes."""
    value, gradient = evaluate(x)
    start, recent = value, deque([np.inf], 20)
    steps: deque = deque(maxlen=MEMORY)  # newest first: step, change of the gradient, and their product
    done, failed = 0, False
    while done < most:
        if len(recent) >= 2 and abs(value - max(recent)) <= tolerance * start:
            break
        if np.linalg.norm(gradient) <= max(tolerance * value, 1e-8):
            break
        try:
            direction, parts = gradient.copy(), []
            for s, y, sy in steps:
                parts.append(s @ direction / sy if sy else np.nan)
                direction -= parts[-1] * y
            if steps:
                _, y, sy = steps[0]
                if not sy >= 0 or np.isnan(parts).any():
                    raise SearchFailed("no curvature")
                direction *= sy / (y @ y)
            for (s, y, sy), part in zip(reversed(steps), reversed(parts)):
                direction += (part - y @ direction / sy) * s
            direction *= -1
            try_first = 1.0 if done else 1.0 / float(np.linalg.norm(direction))
            t, moved, found, changed = _searched(evaluate, x, value, float(gradient @ direction), direction, try_first)
            if t * np.linalg.norm(gradient) < 1e-10:
                raise SearchFailed("step too small")
        except SearchFailed:
            if failed:
                break
            failed = True
            steps.clear()
            continue
        failed, done = False, done + 1
        steps.appendleft((moved - x, changed - gradient, float((moved - x) @ (changed - gradient))))
        x, value, gradient = moved, found, changed
        recent.append(value)
    return x


def passed(blocks: list[tuple], layers: list[int], weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Sums of cross-entropy and of its gradient over blocks (x, class, number of such rows)."""
    loss, sums = 0.0, np.zeros_like(weights)
    views, slopes, at = [], [], 0
    for n, m in zip(layers, layers[1:]):
        for into, flat in ((views, weights), (slopes, sums)):
            into.append((flat[at : at + n * m].reshape(n, m), flat[at + n * m : at + n * m + m]))
        at += n * m + m
    with np.errstate(over="ignore"):
        for x, y, times in blocks:
            outputs = [x]
            for i, (matrix, shift) in enumerate(views):
                z = outputs[-1] @ matrix
                z += shift
                if i < len(views) - 1:
                    np.negative(z, out=z)
                    np.exp(z, out=z)
                    z += 1
                    np.reciprocal(z, out=z)
                outputs.append(z)
            z = outputs.pop()
            z -= z.max(axis=1, keepdims=True)
            rows = np.arange(len(y))
            own = z[rows, y].copy()
            np.exp(z, out=z)
            total = z.sum(axis=1)
            loss += float(times @ (np.log(total) - own))
            delta = z / total[:, None]
            delta[rows, y] -= 1
            delta *= times[:, None]
            for i in range(len(views) - 1, -1, -1):
                below = outputs[i]
                slopes[i][0][...] += below.T @ delta
                slopes[i][1][...] += delta.sum(axis=0)
                if i:
                    delta = delta @ views[i][0].T
                    delta *= below
                    delta *= 1 - below
    return loss, sums


_BLOCK = pa.schema([("x", pa.binary()), ("y", pa.binary()), ("n", pa.binary())])


def _packed(batches: Iterator[pa.RecordBatch], layers: list[int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        y = batch.column(1).to_numpy(zero_copy_only=False)
        if batch.column(1).null_count or not np.isin(y, np.arange(layers[-1])).all():
            raise ValueError(f"classes are to be 0 to {layers[-1] - 1}")
        x = np.array(batch.column(0).flatten(), float).reshape(batch.num_rows, layers[0])
        n = batch.column(2).to_numpy().astype(float)
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            some = slice(at, at + BLOCK_ROWS)
            yield pa.RecordBatch.from_pydict(
                {"x": [x[some].tobytes()], "y": [y[some].astype(np.int64).tobytes()], "n": [n[some].tobytes()]}, schema=_BLOCK
            )


def _block(row, width: int) -> tuple:
    return np.frombuffer(row[0]).reshape(-1, width), np.frombuffer(row[1], np.int64), np.frombuffer(row[2])


def fitted_weights(rows: DataFrame, layers: list[int], first: np.ndarray, most: int, tolerance: float) -> np.ndarray:
    """Weights of a network for rows (x: array of numbers, y: class)."""
    spark = rows.sparkSession
    distinct = rows.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).persist()
    size = distinct.agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("rows")).first()
    alone = size["kinds"] * len(first) <= ONE_TASK_WORK
    tasks = 1 if alone else tasks_for(size["kinds"], spark.sparkContext.defaultParallelism, ROWS_PER_TASK)
    packed = distinct.repartition(tasks).mapInArrow(partial(_packed, layers=layers), "x binary, y binary, n binary")
    blocks = packed.rdd.map(partial(_block, width=layers[0])).persist(StorageLevel.MEMORY_AND_DISK)

    def average(parts: list[tuple]) -> tuple[float, np.ndarray]:
        # In the order of the parts, so that the same parts have the same sum.
        return sum(p[0] for p in parts) / size["rows"], sum(p[1] for p in parts) / size["rows"]

    try:
        if alone:
            total = size["rows"]

            def fit(some: Iterator[tuple]) -> list[np.ndarray]:
                held = list(some)

                def evaluate(w: np.ndarray) -> tuple[float, np.ndarray]:
                    loss, sums = passed(held, layers, w)
                    return loss / total, sums / total

                return [minimised(evaluate, first, most, tolerance)]

            return blocks.mapPartitions(fit).collect()[0]
        return minimised(
            lambda w: average(blocks.mapPartitions(lambda some: [passed(some, layers, w)]).collect()), first, most, tolerance
        )
    finally:
        blocks.unpersist()
        distinct.unpersist()


class Network(MultilayerPerceptronClassifier):
    """The multilayer perceptron with a trainer for many rows; parameters and fitted models are Spark's."""

    def _fit(self, dataset: DataFrame) -> MultilayerPerceptronClassificationModel:
        if self.getSolver() != "l-bfgs" or dataset.count() <= SPARKS_ROWS:
            return super()._fit(dataset)
        spark: SparkSession = dataset.sparkSession
        sc, layers = spark.sparkContext, list(self.getLayers())
        rows = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        if self.isSet(self.initialWeights):
            first = self.getInitialWeights()
        else:
            sizes = sc._gateway.new_array(sc._jvm.int, len(layers))
            for i, n in enumerate(layers):
                sizes[i] = n
            topology = sc._jvm.org.apache.spark.ml.ann.FeedForwardTopology.multiLayerPerceptron(sizes, True)
            first = _java2py(sc, topology.model(self.getSeed()).weights())
        found = fitted_weights(rows, layers, np.array(first.toArray()), self.getMaxIter(), self.getTol())
        made = sc._jvm.org.apache.spark.ml.classification.MultilayerPerceptronClassificationModel(
            self.uid, _py2java(sc, DenseVector(found))
        )
        model = self._copyValues(MultilayerPerceptronClassificationModel(made))
        model._transfer_params_to_java()
        return model
