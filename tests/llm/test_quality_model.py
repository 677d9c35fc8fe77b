"""The quality model: held-out accuracy, traversal and histograms against plain versions."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from modrisk.llm import quality_model
from modrisk.llm.queries import op12_quality_model


def area(score, y):
    """Share of (good, junk) pairs in the right order; ties count half."""
    good, junk = score[y == 1], score[y == 0]
    return ((good[:, None] > junk[None, :]).mean() + 0.5 * (good[:, None] == junk[None, :]).mean())


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op12_quality_model(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    out = [(r["score"], labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    score, y, predicted = (np.array(c) for c in zip(*out, strict=True))
    assert len(y) > 50 and 0 < y.sum() < len(y)
    assert area(score, y) >= 0.97
    assert (predicted == y).mean() >= 0.95


def slow_scores(forest, x):
    out = []
    for row in x:
        total = forest.base
        for node in forest.roots:
            while forest.low[node] != node:
                node = forest.low[node] if row[forest.statistic[node]] <= forest.limit[node] else forest.high[node]
            total += forest.value[node]
        out.append(1 / (1 + np.exp(-total)))
    return np.array(out)


def test_flat_arrays_walk_like_a_tree():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(400, 6)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    forest = quality_model.fitted(x, y)
    assert np.allclose(forest.scores(x), slow_scores(forest, x))
    assert ((forest.scores(x) > 0.5) == y).mean() > 0.97


def test_first_split_is_the_best_of_all():
    """One tree of one level against every possible cut."""
    draw = np.random.default_rng(2)
    x = draw.integers(0, 9, size=(200, 3)).astype(np.float32)
    y = (x[:, 1] + draw.normal(size=200) > 4).astype(float)
    forest = quality_model.fitted(x, y, trees=1, depth=1, least=0.0)
    share = (y.sum() + 0.5) / (len(y) + 1)
    slope, curve = y - share, np.full(len(y), share * (1 - share))

    def gain(statistic, cut):
        side = x[:, statistic] <= cut
        return sum(slope[s].sum() ** 2 / (curve[s].sum() + 1) for s in (side, ~side))

    best = max(gain(f, c) for f in range(3) for c in range(9))
    assert gain(forest.statistic[0], forest.limit[0]) == pytest.approx(best)
    assert forest.statistic[0] == 1


def test_only_texts_and_free_labels_count(spark, documents, sf):
    """Held-out labels, ids, sources and languages change no score."""
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality_model.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = documents.withColumns({"source": F.lit("x"), "lang": F.lit("y"), "score": F.lit(3), "x": F.lit(1), "y": F.lit(0)})
    a = quality_model.scored(documents, labels, trees=5).collect()
    assert sorted(a) == sorted(quality_model.scored(other, turned, trees=5).collect())


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame(
        [(1, 0), (1, 1), (3, 1), (None, 0), (7, None), (99, 1), (9, 0), (4, 1)], "doc_id long, quality int"
    )
    rows = quality_model.scored(odd.withColumnRenamed("text_sha256", "held_out"), labels, trees=3).collect()
    assert len(rows) == odd.count()
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 12)}) == 1
    assert {r["held_out"] for r in rows if r["doc_id"] is None} == {False}
    assert {r["score"] for r in quality_model.scored(odd, labels.limit(0)).collect()} == {0.5}
    assert quality_model.scored(nothing, labels).count() == 0
