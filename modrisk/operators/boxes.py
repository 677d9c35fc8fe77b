"""A forest as boxes, for sums over many variants of a row.

A leaf of a tree is a box of the feature space, and the probability of a row is the sum of the shares of the boxes that
hold it. A variant of a row keeps the row's own value in some features and has fixed values in the others. It lies in a
box when its own values do and its fixed ones do, so a sum over all variants asks for each box only which of the row's
features lie in it: what the variants add up to is looked up, not scored variant by variant.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import SparkSession

from modrisk.session import checkpoint_dir

MOST_ENTRIES = 1_000_000  # of a table of sums: 2 ** features x nodes, or 100 x nodes with few features
ROWS_AT_ONCE = 128


@dataclass
class Boxes:
    """``share`` a box; a feature's thresholds in order, and whether each stretch between them lies in each box."""

    share: np.ndarray
    thresholds: list[np.ndarray]
    inside: list[np.ndarray]

    def holding(self, values: np.ndarray) -> np.ndarray:
        """Row by row and box by box, the features that lie in it, as bits. Values at a threshold go left, NaN goes right."""
        bits = np.zeros((len(values), len(self.share)), np.int32)
        for j, (points, inside) in enumerate(zip(self.thresholds, self.inside)):
            bits |= inside[np.searchsorted(points, values[:, j], "left")].astype(np.int32) << j
        return bits

    def table(self, own: np.ndarray, fixed: np.ndarray, times: np.ndarray, factors: np.ndarray) -> np.ndarray:
        """(sum, features that lie in a box, box): shares of the variants that lie in it.

        A variant keeps the features of ``own`` (bits), has those of ``fixed`` (as from ``holding``) in a box with its
        other values, and counts ``times``, and in each sum by the factor of its ``own``.
        """
        k = len(self.thresholds)
        order = np.argsort(own, kind="stable")
        in_box = (fixed[order] | own[order, None]) == 2**k - 1
        kinds, starts = np.unique(own[order], return_index=True)
        reached = np.zeros((2**k, len(self.share)))
        reached[kinds] = np.add.reduceat(in_box * times[order, None], starts, axis=0)
        sums = factors.T[:, :, None] * (reached * self.share)
        for j in range(k):  # a variant lies in the box as soon as all features that it keeps do
            halves = sums.reshape(len(sums), -1, 2, 2**j, len(self.share))
            halves[:, :, 1] += halves[:, :, 0]
        return sums

    def sums(self, values: np.ndarray, table: np.ndarray) -> np.ndarray:
        """(row, sum) of rows that share a table."""
        found, box = np.empty((len(values), len(table))), np.arange(len(self.share), dtype=np.int32)
        flat = table.reshape(len(table), -1)
        for at in range(0, len(values), ROWS_AT_ONCE):
            place = self.holding(values[at : at + ROWS_AT_ONCE]) * np.int32(len(self.share)) + box
            for i, entries in enumerate(flat):
                found[at : at + ROWS_AT_ONCE, i] = entries[place].sum(axis=1)
        return found


def boxes(spark: SparkSession, model, features: int) -> Boxes | None:
    """The boxes of a forest of two classes that has cut numbers only; none for other models, and where tables grow too large."""
    if not isinstance(model, RandomForestClassificationModel) or model.numClasses != 2:
        return None
    if max(2**features, 100) * model.totalNumNodes > MOST_ENTRIES:
        return None
    path = f"{checkpoint_dir(spark).rstrip('/')}/forest-{uuid.uuid4().hex}"
    model.write().save(path)
    trees = defaultdict(dict)  # as bounded as the model, which the driver holds
    for r in spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect():
        trees[r["treeID"]][r["id"]] = r
    share, low, high = [], [], []
    for nodes in trees.values():
        open_ = [(nodes[0], np.full(features, -np.inf), np.full(features, np.inf))]
        while open_:
            node, above, upto = open_.pop()
            if node["leftChild"] < 0:
                stats = node["impurityStats"]
                if not sum(stats):  # such a tree has no vote
                    return None
                share.append(stats[1] / sum(stats))
                low.append(above)
                high.append(upto)
                continue
            j, limits, categories = node["split"]
            if categories >= 0:
                return None
            less, more = upto.copy(), above.copy()
            less[j], more[j] = min(upto[j], limits[0]), max(above[j], limits[0])
            open_ += [(nodes[node["leftChild"]], above, less), (nodes[node["rightChild"]], more, upto)]
    low, high = np.array(low), np.array(high)
    thresholds = [np.unique(np.concatenate([x[:, j][np.isfinite(x[:, j])] for x in (low, high)])) for j in range(features)]
    inside = []
    for j, points in enumerate(thresholds):
        # Stretch i lies above threshold i - 1, up to threshold i.
        begin, end = np.append(-np.inf, points), np.append(points, np.inf)
        inside.append((begin[:, None] >= low[:, j]) & (end[:, None] <= high[:, j]))
    return Boxes(np.array(share) / len(trees), thresholds, inside)
