"""A random forest of two classes for large tables, of which only the importance of its columns is asked.

Spark's forest visits each node of each tree for a row by itself. Here a task holds its rows as blocks of small integers, the
number of a value's bin, column by column, and a level of a tree is a few array operations over a block. What is grown is
the same: bootstraps by Poisson draws, a draw of columns for each node, Gini gain over at most 32 bins, leaves of
one class, and twin leaves of the same class merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from modrisk.functions.ordered import SKETCH_ACCURACY
from modrisk.operators.cleaning import col

BINS = 32
MARKS = 1024  # points of a column's sketch that bins are made of
BLOCK_ROWS = 32_768
TASKS_PER_CORE, MOST_ROWS_PER_TASK = 2, 2_000_000

# A draw of 16 bits to a Poisson count of mean 1.
_COUNTS = np.searchsorted(
    np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]), (np.arange(65536) + 0.5) / 65536
).astype(np.uint8)


def cuts_between(values: list[float], weights: list[float], most: int = BINS - 1) -> np.ndarray:
    """Cuts half-way between values, all of them or those at about equal steps of the weight (as Spark's trees choose them)."""
    points, place = np.unique(np.asarray(values, float), return_inverse=True)
    weight = np.bincount(place, weights=weights) if len(points) else np.zeros(0)
    with np.errstate(over="ignore", invalid="ignore"):
        middle = np.where(np.isfinite(points[1:] + points[:-1]), (points[1:] + points[:-1]) / 2, points[:-1])
    if len(middle) <= most:
        return middle
    step, cuts = weight.sum() / (most + 1), []
    upto, target = np.cumsum(weight), step
    for i in range(1, len(points)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            cuts.append(middle[i - 1])
            target += step
    return np.array(cuts[:most])


def _cuts(rows: DataFrame, names: list[str], label: str, weights: tuple[float, float]) -> list[np.ndarray]:
    """Of each column, from one sketch a class; a class counts by the weight of all its rows."""
    marks = F.array(*[F.lit((i + 0.5) / MARKS) for i in range(MARKS)])
    row = rows.agg(
        *[
            F.percentile_approx(F.when(col(label) == c, col(n)), marks, F.lit(SKETCH_ACCURACY)).alias(f"{n}_{c}")
            for n in names for c in (0, 1)
        ],
        *[F.count_if(col(label) == c).alias(f"n{c}") for c in (0, 1)],
    ).first()
    found = []
    for n in names:
        points = [list(row[f"{n}_{c}"] or []) for c in (0, 1)]
        each = [row[f"n{c}"] * weights[c] / MARKS for c in (0, 1)]
        found.append(cuts_between(points[0] + points[1], [each[0]] * len(points[0]) + [each[1]] * len(points[1])))
    return found


def _blocks(batches: Iterator[pa.RecordBatch], cuts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(block, rows, bins, y): rows of a task, BLOCK_ROWS at a time, as a byte for each value, column by column."""
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    held, count, made = [], 0, 0

    def block(parts: list[np.ndarray], n: int) -> pa.RecordBatch:
        whole = np.concatenate(parts, axis=1)
        return pa.RecordBatch.from_pydict(
            {"task": [task], "block": [made], "n": [n], "bins": [whole[:-1].tobytes()], "y": [whole[-1].tobytes()]}, schema=_BLOCK
        )

    for batch in batches:
        part = np.empty((len(cuts) + 1, batch.num_rows), np.uint8)
        for i, points in enumerate(cuts):
            values = batch.column(i).to_numpy(zero_copy_only=False)
            if np.isnan(values).any():
                raise ValueError("a value is not a number")
            part[i] = np.searchsorted(points, values, "left")
        part[-1] = batch.column(len(cuts)).to_numpy(zero_copy_only=False)
        at = 0
        while at < batch.num_rows:
            piece = part[:, at : at + BLOCK_ROWS - count]
            held.append(piece)
            count, at = count + piece.shape[1], at + piece.shape[1]
            if count == BLOCK_ROWS:
                yield block(held, count)
                held, count, made = [], 0, made + 1
    if count:
        yield block(held, count)


_BLOCK = pa.schema([("task", pa.int32()), ("block", pa.int32()), ("n", pa.int32()), ("bins", pa.binary()), ("y", pa.binary())])
_BLOCK_DDL = "task int, block int, n int, bins binary, y binary"


@dataclass
class Grown:
    """A forest so far. Level by level and tree by tree: the column and the last bin that goes left, at the level's nodes.

    What is no split sends all rows left, to a node that is not asked.
    """

    columns: list[np.ndarray] = field(default_factory=list)
    last_left: list[np.ndarray] = field(default_factory=list)


def _counted(batches: Iterator[pa.RecordBatch], grown: Grown, drawn: np.ndarray, seed: int) -> Iterator[pa.RecordBatch]:
    """(tree, counts): how often rows of each class fall into each bin of the columns drawn at each node of the next level.

    ``drawn`` (tree, place, node): the columns.
    """
    trees, places, nodes = drawn.shape
    sums = np.zeros((trees, places, nodes * BINS * 2), np.int64)
    for batch in batches:
        for task, number, n, bins, y in zip(*(c.to_pylist() for c in batch.columns)):
            bins, y = np.frombuffer(bins, np.uint8), np.frombuffer(y, np.uint8).astype(np.intp)
            for t in range(trees):
                random = np.random.Generator(np.random.SFC64([seed, t, task, number]))
                times = _COUNTS[np.frombuffer(random.bytes(2 * n), np.uint16)]
                rows = np.flatnonzero(times)
                node = np.zeros(len(rows), np.intp)
                for columns, last in zip(grown.columns, grown.last_left):
                    right = bins.take(columns[t].take(node) * n + rows) > last[t].take(node)
                    node += node
                    node += right
                times, base = times.take(rows).astype(float), node * (BINS * 2) + y.take(rows)
                for p in range(places):
                    key = bins.take(drawn[t, p].take(node) * n + rows).astype(np.intp)
                    key += key
                    key += base
                    sums[t, p] += np.bincount(key, times, minlength=sums.shape[2]).astype(np.int64)
    for t in range(trees):
        yield pa.RecordBatch.from_pydict({"tree": [t], "counts": [sums[t].tobytes()]}, schema=_COUNTED)


_COUNTED = pa.schema([("tree", pa.int32()), ("counts", pa.binary())])


def best_splits(counts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """From counts (place, node, bin, class), of each node: gain, place, last bin that goes left, and the class weights left and right.

    The gain is 0 where no split leaves rows on both sides.
    """
    nodes = counts.shape[1]
    left = counts.cumsum(axis=2)
    whole = left[:, :, -1:]
    right = whole - left

    def gini(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        heavy = rows * weights
        total = heavy.sum(axis=-1)
        share = heavy / np.maximum(total, 1e-300)[..., None]
        return np.where(total > 0, 1 - (share**2).sum(axis=-1), 0.0), total

    (own, total), (low, on_left), (high, on_right) = gini(whole), gini(left), gini(right)
    gain = own - (on_left * low + on_right * high) / np.maximum(total, 1e-300)
    gain = np.where((left.sum(axis=-1) > 0) & (right.sum(axis=-1) > 0), gain, 0.0)
    flat = gain.transpose(1, 0, 2).reshape(nodes, -1)
    best = flat.argmax(axis=1)
    place, last = best // BINS, best % BINS
    at = np.arange(nodes)
    return flat[at, best], place, last, left[place, at, last] * weights, right[place, at, last] * weights


def _splitting(places: int, nodes: int, weights: np.ndarray):
    def split(table: pa.Table) -> pa.Table:
        """The best splits of a tree's level, from the counts of all tasks."""
        sums = np.zeros(places * nodes * BINS * 2, np.int64)
        for counts in table.column("counts"):
            sums += np.frombuffer(counts.as_buffer(), np.int64)
        gain, place, last, left, right = best_splits(sums.reshape(places, nodes, BINS, 2), weights)
        return pa.table(
            {
                "tree": pa.array([table.column("tree")[0].as_py()] * nodes, pa.int32()), "node": pa.array(range(nodes), pa.int32()),
                "gain": gain, "place": place.astype(np.int32), "last": last.astype(np.int32),
                "l0": left[:, 0], "l1": left[:, 1], "r0": right[:, 0], "r1": right[:, 1],
            }
        )

    return split


_SPLIT_DDL = "tree int, node int, gain double, place int, last int, l0 double, l1 double, r0 double, r1 double"


def _importance(levels: list[dict], trees: int, features: int) -> np.ndarray:
    """Gain times weight, summed by column; shares within a tree, then of the forest. Twin leaves of one class count as merged."""
    found = np.zeros((trees, features))
    below = None  # of the level under this one: whether a node is a leaf, and its class
    for level in reversed(levels):
        # Of two classes of equal weight the first is the answer.
        left, right = level["left"][..., 1] > level["left"][..., 0], level["right"][..., 1] > level["right"][..., 0]
        if below is None:
            leaves = np.ones((*left.shape, 2), bool)
        else:
            leaves = below.reshape(*left.shape, 2)
        merged = leaves.all(axis=2) & (left == right)
        split = level["split"] & ~merged
        weight = (level["left"] + level["right"]).sum(axis=2)
        for f in range(features):
            found[:, f] += np.where(split & (level["column"] == f), level["gain"] * weight, 0.0).sum(axis=1)
        below = ~split
    shares = found / np.maximum(found.sum(axis=1, keepdims=True), 1e-300)
    total = shares.sum(axis=0)
    return total / total.sum() if total.sum() > 0 else total


def importance(
    rows: DataFrame, names: list[str], label: str, weights: tuple[float, float], number: int, trees: int, depth: int, seed: int
) -> list[float]:
    """Importance of plain columns of numbers; ``label`` has 0 and 1, whose rows weigh ``weights``; ``number`` of rows.

    A row is a byte a column in the cached blocks. A level is a pass over the blocks; the counts of its nodes are summed tree by tree
    in tasks, and the driver gets the best split of each node.
    """
    spark, features = rows.sparkSession, len(names)
    cuts = _cuts(rows, names, label, weights)
    plain = rows.select(*[col(n) for n in names], col(label).cast("byte").alias("_y"))
    even = plain.repartition(max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, math.ceil(number / MOST_ROWS_PER_TASK)))
    blocks = even.mapInArrow(partial(_blocks, cuts=cuts), _BLOCK_DDL).persist()
    by_class, places = np.array(weights, float), math.ceil(math.sqrt(features))
    random = np.random.default_rng([seed, trees, features])
    grown, levels = Grown(), []
    open_ = np.ones((trees, 1), bool)
    try:
        for level in range(depth):
            nodes = 2**level
            drawn = random.permuted(np.broadcast_to(np.arange(features), (trees, nodes, features)), axis=2)
            drawn = drawn[:, :, :places].transpose(0, 2, 1).copy()
            counted = blocks.mapInArrow(partial(_counted, grown=grown, drawn=drawn, seed=seed), "tree int, counts binary")
            splits = counted.groupBy("tree").applyInArrow(_splitting(places, nodes, by_class), _SPLIT_DDL).toArrow()
            at = splits["tree"].to_numpy(), splits["node"].to_numpy()
            gain, left, right = np.zeros((trees, nodes)), np.zeros((trees, nodes, 2)), np.zeros((trees, nodes, 2))
            place, last = np.zeros((trees, nodes), int), np.zeros((trees, nodes), int)
            gain[at], place[at], last[at] = splits["gain"].to_numpy(), splits["place"].to_numpy(), splits["last"].to_numpy()
            for c in (0, 1):
                left[(*at, c)], right[(*at, c)] = splits[f"l{c}"].to_numpy(), splits[f"r{c}"].to_numpy()
            split = open_ & (gain > 0)
            column = np.take_along_axis(drawn, place[:, None], axis=1)[:, 0]
            levels.append({"split": split, "gain": gain, "column": column, "left": left, "right": right})
            if not split.any():
                break
            grown.columns.append(np.where(split, column, 0))
            grown.last_left.append(np.where(split, last, BINS).astype(np.uint8))
            # A child of one class is a leaf.
            mixed = [split & (side > 0).all(axis=2) for side in (left, right)]
            open_ = np.stack(mixed, axis=2).reshape(trees, 2 * nodes)
    finally:
        blocks.unpersist()
    return _importance(levels, trees, features).tolist()
