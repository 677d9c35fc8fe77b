"""Document quality by histogram gradient-boosted trees over document statistics.

1. Every whole text becomes a row of statistics (``STATISTICS``): lengths, kinds of characters, how often words, word pairs
   and lines repeat, how well it compresses. One pass in Arrow batches, written as a small table.
2. The trees learn from at most ``sample_rows`` labelled rows, those with the smallest hash of their id (a documented bound;
   at 40 numbers a row the largest sample is some megabytes). Values are put into ``bins`` quantile bins; a tree grows
   level by level from histograms of gradients and curvatures by (node, statistic, bin).
3. The forest is flattened into arrays, and every row goes down all trees at once: a gather and a comparison a level.

Labels, language, source and id are never inputs of a score: statistics are made from the text alone. Ids with
crc32(id as text) mod 5 = 0 are held out: they are taken from the labelled rows before the sample is drawn.

Defined results: a null, empty or blank text has statistics of zero and a score like any other. A row without an id has no
label and is not held out. Where labels of one id differ the smallest counts; null labels and labels of unknown ids
count nothing. Without labelled rows every score is 0.5; with one class only, near its share. Rows that repeat are each scored; an
empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from modrisk.llm.shared import work_folder, written

SAMPLE_ROWS = 20_000
TREES = 60
DEPTH = 4
BINS = 64
RATE = 0.15
SHRINK = 1.0  # added to the curvature of a leaf
LEAST = 3.0  # curvature of a leaf, times four
CUTOFF = 0.3
ROWS_AT_ONCE = 256

_SIGNS = b"#*$%&|<>!?.,;:@/\\=_{}()[]\"'-+~^"
STATISTICS = [
    "log_words", "log_bytes", "word_mean", "word_spread", "word_longest", "one_letter", "long_words", "upper", "lower", "digits",
    "high_bytes", "blanks", "control", "entropy", "unique_words", "top_word", "top_five", "word_repeat", "stutter", "unique_pairs",
    "log_lines", "line_mean", "repeated_lines", "empty_lines", "squeezed", "shouted", "plain_words", *[f"sign_{c:02x}" for c in _SIGNS],
]


def statistics(data: bytes) -> list[float]:
    """The statistics of a text in UTF-8; words are what stands between blanks."""
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size = len(data)
    share = seen[seen > 0] / size
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    top = sorted(counts.values(), reverse=True)[:5]
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = data.split(b"\n")
    full = [line for line in lines if line.strip()]
    return [
        math.log1p(n), math.log1p(size), float(lengths.mean()), float(lengths.std()), math.log1p(int(lengths.max())),
        float((lengths == 1).mean()), float((lengths > 20).mean()), seen[65:91].sum() / size, seen[97:123].sum() / size,
        seen[48:58].sum() / size, seen[128:].sum() / size, seen[[9, 10, 11, 12, 13, 32]].sum() / size, seen[:32].sum() / size,
        float(-(share * np.log2(share)).sum()), len(counts) / n, top[0] / n, sum(top) / n,
        sum(c * c for c in counts.values()) / (n * n), sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        pairs / max(1, n - 1), math.log1p(len(full)), math.log1p(size / max(1, len(full))), 1 - len(set(full)) / len(full),
        1 - len(full) / len(lines), len(zlib.compress(data, 1)) / size, sum(w.isupper() for w in words) / n, sum(w.isalpha() for w in words) / n,
        *[seen[c] / n for c in _SIGNS],
    ]


def statistics_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, x): the statistics of each row's text."""
    kind = dict(docs.select(F.col(id_col).alias("id")).dtypes)["id"]
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                found = np.array([statistics(t.as_py()) for t in batch.column(1)], np.float32).reshape(-1, len(STATISTICS))
                offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * len(STATISTICS))
                lists = pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["id", "x"])

    return rows.mapInArrow(run, f"id {kind}, x array<float>")


@dataclass
class Forest:
    """All trees in one set of arrays; a leaf leads to itself. A score is the logistic of base plus the leaves' values."""

    base: float
    depth: int
    roots: np.ndarray
    statistic: np.ndarray
    limit: np.ndarray
    low: np.ndarray
    high: np.ndarray
    value: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if len(self.roots):
            node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
            row = np.arange(len(x))[:, None]
            for _ in range(self.depth):
                node = np.where(x[row, self.statistic[node]] <= self.limit[node], self.low[node], self.high[node])
            total = total + self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Upper ends of the bins of each statistic, the last bin open; values of the sample, so equal values share a bin."""
    marks = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(column, marks, method="lower")) for column in x.T]


def fitted(
    x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE, shrink: float = SHRINK,
    least: float = LEAST,
) -> Forest:
    """Boosted trees for labels 0 and 1; the same rows in the same order give the same forest."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = math.log(share / (1 - share))
    nodes: list[list[float]] = []  # statistic, limit, low, high, value
    roots = []
    if len(y) and 0 < y.sum() < len(y):
        edges = _edges(x, bins)
        binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
        slots = binned + np.arange(x.shape[1]) * bins
        total = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-total))
            roots.append(len(nodes))
            total += _grown(nodes, binned, slots, edges, y - p, p * (1 - p), depth, bins, rate, shrink, least)
    columns = zip(*nodes, strict=True) if nodes else [[]] * 5
    kinds = (np.int64, np.float64, np.int64, np.int64, np.float64)
    return Forest(base, depth, np.array(roots, np.int64), *[np.array(c, t) for c, t in zip(columns, kinds, strict=True)])


def _grown(nodes, binned, slots, edges, slope, curve, depth, bins, rate, shrink, least) -> np.ndarray:
    """Appends a tree to ``nodes``; the value that it gives each row."""
    width, out = binned.shape[1] * bins, np.zeros(len(slope))
    rows, at, level = np.arange(len(slope)), np.zeros(len(slope), np.int64), [len(nodes)]  # rows still on the way, their node
    nodes.append([0, math.inf, 0, 0, 0.0])
    for step in range(depth + 1):
        n = len(level)
        g, h = np.bincount(at, slope[rows], n), np.bincount(at, curve[rows], n)
        values = rate * g / (h + shrink)
        spot = (slots[rows] + at[:, None] * width).ravel()
        left_g, left_h = (
            np.bincount(spot, np.repeat(w[rows], binned.shape[1]), n * width).reshape(n, -1, bins).cumsum(axis=2) for w in (slope, curve)
        )
        right_g, right_h = g[:, None, None] - left_g, h[:, None, None] - left_h
        gain = left_g**2 / (left_h + shrink) + right_g**2 / (right_h + shrink) - (g**2 / (h + shrink))[:, None, None]
        gain[(left_h < least / 4) | (right_h < least / 4)] = -1
        gain = gain.reshape(n, -1)
        best = gain.argmax(axis=1)
        statistic, cut = best // bins, best % bins
        split = (gain[np.arange(n), best] > 1e-9) & (step < depth)
        below: list[int] = []
        first = np.zeros(n, np.int64)
        for k, node in enumerate(level):
            nodes[node] = [0, math.inf, node, node, float(values[k])]
            if split[k]:
                first[k] = len(below)
                nodes[node] = [int(statistic[k]), float(edges[statistic[k]][cut[k]]), len(nodes), len(nodes) + 1, 0.0]
                below += [len(nodes), len(nodes) + 1]
                nodes += [[0, math.inf, 0, 0, 0.0], [0, math.inf, 0, 0, 0.0]]
        stays = ~split[at]
        out[rows[stays]] = values[at[stays]]
        rows, at = rows[~stays], at[~stays]
        if not len(below):
            break
        at = first[at] + (binned[rows, statistic[at]] > cut[at])
        level = below
    return out


def learned(
    table: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS, **options
) -> Forest:
    """A forest from the statistics (id, x) of labelled rows that are not held out; see the module for the bound."""
    known = labels.groupBy(F.col(id_col).alias("label_id")).agg(F.min(label_col).cast("double").alias("y")).filter("y is not null")
    rows = table.join(known, F.col("id") == F.col("label_id")).filter(~held_out(F.col("id")))
    drawn = rows.select("x", "y", F.xxhash64(F.lit("sample"), "id").alias("draw"), "id").orderBy("draw", "id", "x").limit(sample_rows).toArrow()
    x = np.array(drawn.column("x").combine_chunks().flatten(), np.float32).reshape(-1, len(STATISTICS))
    return fitted(x, np.array(drawn.column("y"), np.float64), **options)


def held_out(ident: Column) -> Column:
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % F.lit(5) == 0, F.lit(False))


def scored(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    cutoff: float = CUTOFF, sample_rows: int = SAMPLE_ROWS, **options,
) -> DataFrame:
    """One row per input row: id, held_out, score (0 to 1, higher: label 1 likelier), predicted (1 from ``cutoff`` on)."""
    folder = work_folder(docs.sparkSession, "quality")
    table = written(statistics_table(docs, id_col, text_col), f"{folder}/statistics")
    forest = learned(table, labels, id_col, label_col, sample_rows, **options)
    kind = dict(table.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(STATISTICS))
            scores = [forest.scores(x[at : at + 1024]) for at in range(0, len(x), 1024)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=["id", "score"])

    found = table.mapInArrow(run, f"id {kind}, score double")
    return found.select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= F.lit(cutoff)).cast("int").alias("predicted"),
    )
