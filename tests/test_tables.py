"""Cleaning, features, order statistics, splits, neighbours and oversampling."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from modrisk.functions import ordered
from modrisk.functions.bands import band
from modrisk.functions.scores import halstead
from modrisk.operators import cleaning, evaluation, features, models, neighbours, sampling


def test_bands_at_their_edges(spark):
    edges = [0.0, 0.3, 0.33, 0.4, 0.5, 0.67, 0.7, 1.0, 1.01]
    rows = spark.createDataFrame([(e,) for e in edges], "s double")
    got = {
        scale: [r[0] for r in rows.select(band(F.col("s"), scale)).collect()]
        for scale in ("analysis", "review", "heatmap", "dashboard")
    }
    low, med, high = "LOW", "MED", "HIGH"
    assert got["analysis"] == [low, med, med, med, high, high, high, high, high]
    assert got["review"] == [low, low, "MEDIUM", "MEDIUM", "MEDIUM", high, high, high, high]
    assert got["heatmap"] == ["Low Risk"] * 3 + ["Medium Risk"] * 3 + ["High Risk"] * 3
    assert got["dashboard"] == [None, "Low", "Low", "Medium", "Medium", "Medium", "High", "High", None]


def test_exact_quantiles_by_narrowing(spark):
    rng = random.Random(3)
    a = [rng.gauss(0, 100) for _ in range(3000)]
    b = [float(rng.randint(0, 5)) for _ in range(3000)]
    rows = spark.createDataFrame(
        [(x, y if i % 7 else None) for i, (x, y) in enumerate(zip(a, b))], "a double, `b(x)` double"
    ).repartition(4)
    probabilities = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = ordered.exact_quantiles(rows, ["a", "b(x)"], probabilities, small=50)
    kept = [y for i, y in enumerate(b) if i % 7]
    assert got["a"] == pytest.approx(list(np.quantile(a, probabilities)))
    assert got["b(x)"] == pytest.approx(list(np.quantile(kept, probabilities)))
    assert ordered.exact_quantiles(rows, ["a"], probabilities)["a"] == pytest.approx(got["a"])


def test_exact_quantiles_of_ties_and_ends(spark):
    """Equal neighbours give the value itself; infinite values, NaN, neighbouring doubles, one row and none."""
    two = float(np.nextafter(0.02, 1))
    data = [(0.02 if i % 2 else 0.0, [-np.inf, 1.0, np.inf, np.nan][i % 4], 0.02 if i % 3 else two, None) for i in range(400)]
    rows = spark.createDataFrame([tuple(None if v is None else float(v) for v in d) for d in data], "a double, b double, c double, d double")
    for small in (1, 10**6):
        got = ordered.exact_quantiles(rows, list("abcd"), [0.0, 0.6, 0.7, 1.0], small)
        assert got["a"] == [0.0, 0.02, 0.02, 0.02]
        assert got["b"][0] == -np.inf and got["b"][1] == got["b"][2] == np.inf and np.isnan(got["b"][3])
        assert got["c"] == [0.02, 0.02, two, two]
        assert got["d"] == [None] * 4
    assert ordered.exact_quantiles(rows.limit(1), ["a"], [0.3]) == {"a": [0.0]}
    assert ordered.exact_quantiles(rows.limit(0), ["a"], [0.3]) == {"a": [None]}
    assert ordered.exact_quantiles(rows, [], [0.3]) == {}


def test_running_totals_over_many_ranges(spark):
    rng = random.Random(4)
    data = [(m, rng.randint(0, 40) / 10, i) for m in "ab" for i in range(300)]
    rows = spark.createDataFrame(data, "m string, v double, id long")
    got = ordered.ranked(rows, ["m"], "v", ["id"], "r", descending=True, rows_per_range=20)
    for m in "ab":
        expected = sorted([d for d in data if d[0] == m], key=lambda d: (-d[1], d[2]))
        actual = [tuple(r)[:3] for r in got.filter(F.col("m") == m).orderBy("r").collect()]
        assert actual == expected
    assert got.agg(F.max("r")).first()[0] == 300


@pytest.mark.parametrize("max_ranges", [3, 8, 1024])
def test_ranges_split_frequent_values(spark, max_ranges):
    """A value that most rows share, by one and by two levels of split points."""
    rng = random.Random(5)
    data = [(m, 0.5 if rng.random() < 0.7 else rng.randint(0, 9) / 10, rng.random(), i) for m in "ab" for i in range(900)]
    data += [("c", None, rng.random(), i) for i in range(30)]
    rows = spark.createDataFrame(data, "m string, v double, u double, id long")
    got = ordered.ranked(rows, ["m"], "v", ["u", "id"], "r", rows_per_range=100, spread="u", max_ranges=max_ranges).collect()
    for m in "abc":
        want = sorted((d for d in data if d[0] == m), key=lambda d: (d[1] is not None, d[1] or 0.0, d[2]))
        assert [tuple(r)[:4] for r in sorted((r for r in got if r["m"] == m), key=lambda r: r["r"])] == want
        assert max(r["r"] for r in got if r["m"] == m) == len(want)
    # A range holds its share, and next to it less than two shares of a value that is one split point: 300 rows of some 630.
    ranged = ordered._ranged(rows.filter("m != 'c'"), ["m"], "v", 9, F.col("u"), max_ranges)
    assert ranged.groupBy("m", "_range").count().agg(F.max("count")).first()[0] < 300
    with pytest.raises(ValueError):
        ordered.ranked(rows, ["m"], "v", ["id"], spread="u")


def test_label_normalise(spark):
    rows = spark.createDataFrame([("YES ", 1), ("false", 2), (None, 3), ("1", 4), ("maybe", 5)], "Problems string, x int")
    assert [r["LABEL"] for r in cleaning.normalise_label(rows).orderBy("x").collect()] == [1, 0, 0, 1, 0]
    with pytest.raises(ValueError):
        cleaning.normalise_label(rows.select("x"))


def test_cleaner_fit_and_reuse(spark, tmp_path):
    data = [(10.0, 1.0, 5.0, 0), (10.0, 1.0, 5.0, 0), (20.0, None, 5.0, 1), (30.0, 3.0, 5.0, 0), (0.0, 9.0, 5.0, 1), (40.0, 1000.0, 5.0, 1)]
    rows = spark.createDataFrame(data, "loc double, `v(g)` double, k double, LABEL int")
    cleaned, model = cleaning.clean(rows, 0.5)
    got = sorted(tuple(r) for r in cleaned.collect())
    # distinct and loc > 0 leave four rows; v(g): 1, NULL -> 3, 3, 1000
    q1, q3 = np.quantile([1.0, 3.0, 3.0, 1000.0], [0.25, 0.75])
    assert cleaned.columns == ["loc", "v(g)", "LABEL"]
    assert [g[1] for g in got] == pytest.approx([q1 - 0.5 * (q3 - q1) if 1.0 < q1 - 0.5 * (q3 - q1) else 1.0, 3.0, 3.0, q3 + 0.5 * (q3 - q1)])
    fresh = spark.createDataFrame([(0.0, None, 7.0)], "loc double, `v(g)` double, k double")
    model.write().overwrite().save(str(tmp_path / "cleaner"))
    loaded = models.load_model(str(tmp_path / "cleaner"))
    for m in (model, loaded):
        r = m.transform(fresh).first()
        assert r["v(g)"] == 3.0 and "k" not in r.asDict() and r["loc"] > 0.0


def test_nan_counts_as_missing(spark):
    rows = cleaning.nan_to_null(spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double"))
    assert cleaning.medians(rows, ["x"]) == {"x": 2.0}


def test_ratio_of_zero_denominator_is_zero(spark):
    rows = spark.createDataFrame([(4.0, 0.0, 2.0), (4.0, 2.0, None), (4.0, None, 1.0)], "`v(g)` double, loc double, lOComment double")
    got = features.with_ratios(rows).select("`v(g)_per_loc`", "comment_density").collect()
    assert [tuple(r) for r in got] == [(0.0, 0.0), (2.0, None), (0.0, 0.0)]


def test_halstead_identities(spark):
    row = spark.createDataFrame([(3, 3, 4, 4, 2), (0, 0, 0, 0, 0)], "a int, b int, c int, d int, e int")
    h = halstead(*[F.col(c) for c in "abcde"])
    first, empty = row.select(*[v.alias(k) for k, v in h.items()]).collect()
    assert first["volume"] == pytest.approx(8 * math.log2(6))
    assert first["effort"] == pytest.approx(first["volume"] / first["level"])
    assert first["time"] == pytest.approx(first["effort"] / 18)
    assert first["difficulty"] == pytest.approx(1 / first["level"])
    assert empty["volume"] == 0 and empty["effort"] == 0


def test_split_paths_agree(spark):
    rows = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(500)], "id long, LABEL int")
    small = {tuple(r) for r in sampling.stratified_split(rows, "id").filter("is_test").select("id", "LABEL").collect()}
    large = {tuple(r) for r in sampling.stratified_split(rows, "id", small=20).filter("is_test").select("id", "LABEL").collect()}
    assert small == large and len(small) == 100 and sum(y for _, y in small) == 20
    folds = sampling.stratified_folds(rows, "id", rows_per_range=40).groupBy("fold", "LABEL").count().collect()
    assert sorted((r["fold"], r["LABEL"], r["count"]) for r in folds) == [(f, y, n) for f in range(5) for y, n in ((0, 80), (1, 20))]


def brute(queries, candidates, k):
    out = {}
    for q, v in queries:
        best = sorted((math.dist(v, w), c) for c, w in candidates if c != q)[:k]
        out[q] = [(c, round(d, 9)) for d, c in best]
    return out


@pytest.mark.parametrize("cell_rows", [8, 2048])
def test_nearest_matches_brute_force_with_copies(spark, cell_rows):
    rng = random.Random(8)
    points = [(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(120)]
    points += [(1000 + i, [5.0, 5.0, 5.0]) for i in range(60)]  # a third are copies
    frame = spark.createDataFrame(points, "id long, vector array<double>")
    got: dict = {}
    for r in neighbours.nearest(frame, frame, 4, cell_rows=cell_rows).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append((r["neighbour"], round(r["distance"], 9)))
    assert got == brute(points, points, 4)


def test_nearest_with_crowded_cells_and_nulls(spark):
    """Fewer pivots than cells are wanted: cells are dealt in chunks. Grid points tie; null vectors take no part."""
    points = [(i, [float(i % 7), float(i // 7 % 6), float(i // 42 % 2)]) for i in range(300)]
    frame = spark.createDataFrame([*points, (900, None), (901, None)], "id long, vector array<double>")
    got: dict = {}
    for r in neighbours.nearest(frame, frame, 3, cell_rows=16, coarse=4).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append((r["neighbour"], round(r["distance"], 9)))
    assert got == brute(points, points, 3)
    assert neighbours.nearest(frame, frame.limit(0), 3).count() == 0


@pytest.mark.parametrize("spread", [1e-6, 1.0, 1e6])
def test_closest_over_fine_cells(spread):
    draw = np.random.default_rng(1)
    held = draw.normal(size=(3000, 5)) * spread + 1000
    asking = np.concatenate([held[:40], draw.normal(size=(40, 5)) * spread + 1000])
    query, ident, apart = neighbours.closest(asking, held, [np.array([i]) for i in range(3000)], 6, np.full(80, np.inf))
    exact = np.sqrt(((asking[:, None, :] - held[None, :, :]) ** 2).sum(axis=2))
    for i in range(80):
        best = np.lexsort((np.arange(3000), exact[i]))[:6]
        assert ident[query == i].tolist() == best.tolist()
        assert apart[query == i].tolist() == exact[i][best].tolist()


def test_smote_balances_and_stays_on_segments(spark):
    rng = random.Random(9)
    data = [(i, [rng.random(), rng.random()], int(i < 12)) for i in range(80)]
    frame = spark.createDataFrame(data, "id long, x array<double>, LABEL int")
    out = sampling.smote(frame, "id", "x").collect()
    assert sum(r["LABEL"] for r in out) == 68 and len(out) == 136
    points = {i: v for i, v, y in data if y == 1}
    for r in [r for r in out if r["is_synthetic"]]:
        start, new = points[r["id"]], r["x"]
        others = brute([(r["id"], start)], list(points.items()), 5)[r["id"]]
        assert any(
            abs(math.dist(start, new) + math.dist(new, points[c]) - math.dist(start, points[c])) < 1e-9 for c, _ in others
        )


def test_too_few_minority_rows_stay_as_they_are(spark):
    frame = spark.createDataFrame([(i, [float(i)], int(i < 3)) for i in range(20)], "id long, x array<double>, LABEL int")
    assert sampling.smote(frame, "id", "x").count() == 20
    assert sampling.adasyn(frame, "id", "x").count() == 20


def test_curves_by_ranges_and_special_cases(spark):
    rng = random.Random(10)
    rows = [("m", int(rng.random() < 0.4), rng.randint(0, 60) / 60) for _ in range(500)]
    rows += [("perfect", int(i >= 5), i / 10) for i in range(10)] + [("wrong", int(i < 5), i / 10) for i in range(10)]
    rows += [("tied", i % 2, 0.5) for i in range(10)] + [("single", 1, i / 10) for i in range(5)]
    scored = spark.createDataFrame([(m, y, s, int(s > 0.5)) for m, y, s in rows], "model string, label int, score double, prediction int")
    for size in (7, 1_000_000):
        auc = {r["model"]: r["roc_auc"] for r in evaluation.roc_auc(scored, rows_per_range=size).collect()}
        assert auc["perfect"] == 1.0 and auc["wrong"] == 0.0 and auc["tied"] == 0.5 and auc["single"] is None
        mine = [(y, s) for m, y, s in rows if m == "m"]
        pairs = [(p > n) + 0.5 * (p == n) for yp, p in mine if yp for yn, n in mine if not yn]
        assert auc["m"] == pytest.approx(sum(pairs) / len(pairs))
        points = evaluation.roc_curve(scored, rows_per_range=size).filter("model = 'm'")
        assert points.agg(F.max("fpr"), F.max("tpr")).first() == (1.0, 1.0)
    cells = evaluation.class_metrics(evaluation.confusion(scored)).filter("model = 'single'").first()
    assert cells["precision"] == 0.0 and cells["specificity"] == 0.0


def test_average_precision_is_stepwise(spark):
    scored = spark.createDataFrame([("m", 1, 0.9), ("m", 0, 0.8), ("m", 1, 0.7), ("m", 0, 0.1)], "model string, label int, score double")
    assert evaluation.average_precision(scored).first()["avg_precision"] == pytest.approx(0.5 * 1 + 0.5 * 2 / 3)


def test_mutual_information_orders_features(spark):
    rows = spark.createDataFrame([(float(i % 2), float(i % 3), 1.0, i % 2) for i in range(300)], "a double, b double, c double, LABEL int")
    got = {r["feature"]: r["score"] for r in features.mutual_information(rows, ["a", "b", "c"]).collect()}
    assert got["a"] == pytest.approx(math.log(2)) and got["b"] < 0.01 and got["c"] == pytest.approx(0)
    assert "c" not in {r["feature"] for r in features.correlations(rows, ["a", "b", "c"]).collect()}


def test_ranks_around_odd_values(spark):
    """Nulls do not count; -0.0 is 0.0, infinities and NaN stand in order at the ends."""
    from modrisk.functions.ordered import values_at

    data = [-math.inf, -1.0, -0.0, 0.0, 0.5, math.inf, math.nan]
    rows = spark.createDataFrame([(x,) for x in [*data, None, *[2.0] * 30]], "x double").repartition(3)
    order = [-math.inf, -1.0, 0.0, 0.0, 0.5, *[2.0] * 30, math.inf, math.nan]
    for small in (1, 100):
        sizes, found = values_at(rows, {"x": [0.5]}, lambda n: list(range(n)), small)
        assert sizes == {"x": 37}
        assert all(found["x"][i] == v or math.isnan(v) and math.isnan(found["x"][i]) for i, v in enumerate(order))
