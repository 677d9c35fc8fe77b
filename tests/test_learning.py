"""Training, persistence and explanation identities on a small table."""

import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from modrisk.functions.tasks import tasks_for
from modrisk.operators import evaluation, explain, features, forest, models, network
from modrisk.plans.analysis import analyse
from modrisk.plans.preprocessing import Preprocessor, with_folds

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    data = []
    for i in range(200):
        a, b, c = rng.gauss(0, 1), rng.gauss(0, 1), rng.gauss(0, 1)
        data.append((i, a, b, c, int(a + 0.5 * b + rng.gauss(0, 0.5) > 0.8), i % 3))
    return spark.createDataFrame(data, "id long, a double, b double, c double, LABEL int, fold int").persist()


@pytest.fixture(scope="module")
def table(rows):
    return models.compacted(models.model_table(rows, COLUMNS, keep=["id", "fold"]))


@pytest.fixture(scope="module")
def logistic(table):
    return models.estimator(models.LOGISTIC, table, models.DEFAULTS[models.LOGISTIC]).fit(table)


def test_population_scaler(rows):
    fitted = models.PopulationScaler(columns=["a", "fold"]).fit(rows)
    row = fitted.transform(rows).agg(F.avg("a"), F.stddev_pop("a"), F.stddev_pop("fold")).first()
    assert row[0] == pytest.approx(0, abs=1e-9) and row[1] == pytest.approx(1) and row[2] == pytest.approx(1)
    constant = rows.withColumn("a", F.lit(4.0))
    assert models.PopulationScaler(columns=["a"]).fit(constant).transform(constant).agg(F.max("a")).first()[0] == 0.0


def test_linear_attribution_sums_to_log_odds(rows, table, logistic):
    parts = explain.explain_linear(logistic, rows, "id", COLUMNS, rows, "lr")
    sums = parts.groupBy("row_id").agg(F.sum("contribution").alias("s"))
    raw = logistic.transform(table).select(F.col("id").alias("row_id"), F.get(vector_to_array("rawPrediction"), F.lit(1)).alias("z"))
    spread = sums.join(raw, "row_id").agg(F.stddev_pop(F.col("z") - F.col("s"))).first()[0]
    assert spread == pytest.approx(0, abs=1e-9)


def test_permutation_attribution_sums_to_the_gap(rows, table, logistic):
    base = explain.background(rows, COLUMNS, "id", 10)
    parts = explain.permutation_attribution(logistic, rows.limit(20), "id", COLUMNS, base, "lr", permutations=4)
    sums = {r["row_id"]: r["s"] for r in parts.groupBy("row_id").agg(F.sum("contribution").alias("s")).collect()}
    scores = {r["id"]: r["model_score"] for r in models.new_scores(logistic, table, "id").collect()}
    spark = rows.sparkSession
    held = spark.createDataFrame([(i, *x, 0) for i, x in enumerate(base)], "id long, a double, b double, c double, LABEL int")
    mean = models.new_scores(logistic, models.model_table(held, COLUMNS)).agg(F.avg("model_score")).first()[0]
    assert len(sums) == 20
    for i, s in sums.items():
        assert s == pytest.approx(scores[i] - mean, abs=1e-9)


def test_surrogate_finds_the_strong_feature(rows, logistic):
    out = explain.local_surrogate(logistic, rows.filter("a > 1.2"), "id", COLUMNS, rows, samples=200)
    best = out.filter("rank = 1").groupBy("feature").count().orderBy(F.desc("count")).first()
    assert best["feature"] == "a"
    assert out.groupBy("row_id").count().agg(F.min("count")).first()[0] == 3


def test_surrogate_like_one_row_at_a_time(spark, rows):
    """Against numpy: perturbed rows written out, weights applied, least squares with a penalty of 1."""
    def p(x):
        return 1 / (1 + np.exp(-(x[:, 0] + 0.5 * x[:, 1] * x[:, 2])))

    scorer = models.Formula(lambda x: 1 / (1 + F.exp(-(F.get(x, F.lit(0)) + 0.5 * F.get(x, F.lit(1)) * F.get(x, F.lit(2))))))
    asked = rows.limit(10).select("id", *COLUMNS).unionByName(
        spark.createDataFrame([(10_000, None, 1.0, 2.0)], "id long, a double, b double, c double").select("id", *COLUMNS[:3])
    )
    out = explain.local_surrogate(scorer, asked, "id", COLUMNS, rows, samples=60, top=3)
    got = {(r["row_id"], r["feature"]): (r["weight"], r["rank"]) for r in out.collect()}
    train = np.array([[r[c] for c in COLUMNS] for r in rows.select(*COLUMNS).collect()], float)
    cuts = np.quantile(train, [0.25, 0.5, 0.75], axis=0)
    cell = lambda m: (m[:, None, :] > cuts[None]).sum(axis=1)
    cells = cell(train)
    ends = [np.cumsum(np.bincount(cells[:, j], minlength=4))[:3] / len(train) for j in range(3)]
    picks = np.array([[(u >= ends[j]).sum() for j, u in enumerate(draws)] for draws in explain.surrogate_draws(59, 3)])
    want = {}
    for r in asked.collect():
        x = np.array([[r[c] or 0.0 for c in COLUMNS]])
        own = cell(x)
        z = np.vstack([np.ones((1, 3)), picks == own])
        moved = [[x[0, j] if b == own[0, j] else train[cells[:, j] == b, j].mean() for j, b in enumerate(pick)] for pick in picks]
        w = np.sqrt(np.exp(-(3 - z.sum(axis=1)) / (0.75**2 * 3)))
        y = p(np.vstack([x, moved]))
        zc, yc = z - np.average(z, axis=0, weights=w), y - np.average(y, weights=w)
        beta = np.linalg.solve(zc.T @ (zc * w[:, None]) + np.eye(3), zc.T @ (yc * w))
        for place, j in enumerate(np.argsort(-np.abs(beta).round(9), kind="stable")):
            want[r["id"], COLUMNS[j]] = (beta[j], place + 1)
    assert got.keys() == want.keys() and len(got) == 33
    for at, (weight, rank) in want.items():
        assert got[at] == (pytest.approx(weight, abs=1e-9), rank)


def test_surrogate_of_a_forest_scores_no_variants(spark, rows, table, monkeypatch):
    """The sums from a forest's boxes are those of perturbed rows scored one by one, for repeated ids, nulls and thresholds too."""
    forest = models.random_forest(trees=7, depth=4).fit(table)
    cuts = [r[0] for r in rows.select("a").limit(5).collect()]
    odd = [(10_000 + i, x, 1.0, None) for i, x in enumerate([*cuts, None, float("nan"), float("inf")])] + [(10_000, 0.5, 2.0, -1.0), (None, 0.1, 0.2, 0.3)]
    asked = rows.limit(40).select("id", *COLUMNS[:3]).unionByName(
        spark.createDataFrame(odd, f"id long, {', '.join(f'{c} double' for c in COLUMNS[:3])}")
    )

    def found():
        out = explain.local_surrogate(forest, asked, "id", COLUMNS, rows, samples=80, top=3)
        return {(r["row_id"], r["feature"]): (r["weight"], r["rank"]) for r in out.collect()}

    with monkeypatch.context() as patch:
        patch.setattr(explain, "boxes", lambda *_: None)
        want = found()

    def scored(*_):
        raise AssertionError("variants were scored")

    monkeypatch.setattr(type(forest), "transform", scored)
    got = found()
    assert got.keys() == want.keys() and len(got) == 3 * (40 + 8 + 1)
    for at, (weight, rank) in want.items():
        assert got[at] == (pytest.approx(weight, abs=1e-12), rank)


def test_waterfall_ends_at_the_total(rows, logistic):
    parts = explain.explain_linear(logistic, rows, "id", COLUMNS, rows, "lr")
    steps = explain.waterfall(parts, 0.0, top=2)
    last = steps.groupBy("row_id").agg(F.max_by("running_total", "step").alias("end"))
    sums = parts.groupBy("row_id").agg(F.sum("contribution").alias("s"))
    assert last.join(sums, "row_id").filter(F.abs(F.col("end") - F.col("s")) > 1e-9).count() == 0
    assert steps.filter("step = 3 and feature = 'other 1 features'").count() == 200


def test_heatmap_thins_evenly(rows, logistic):
    parts = explain.explain_linear(logistic, rows, "id", COLUMNS, rows, "lr")
    few = explain.heatmap(parts, top=2, samples=20, rows_per_range=30)
    assert few.select("sample").distinct().count() == 20 and few.count() == 40
    totals = [r[1] for r in few.groupBy("sample").agg(F.sum("contribution")).orderBy("sample").collect()]
    assert totals == sorted(totals)


def test_trainer_isolates_failures_and_saves(spark, rows, table, tmp_path):
    trainer = models.Trainer(folds=3, settings={models.FOREST: {"trees": 5}, models.NETWORK: {"hidden": ("bad",)}})
    results = trainer.train_all(table, table)
    assert set(results) == {models.LOGISTIC, models.FOREST}
    assert any(line.startswith("failed Neural") for line in trainer.log)
    board = evaluation.leaderboard(trainer.metrics(spark)).collect()
    assert [r["rank"] for r in board] == [1, 2] and board[0]["roc_auc"] >= board[1]["roc_auc"] > 0.8
    best = evaluation.best_model(trainer.metrics(spark)).first()["model"]
    assert best == board[0]["model"]
    paths = models.save_all(spark, results, str(tmp_path / "models"))
    stored = models.saved_models(spark, str(tmp_path / "models"))
    assert {r["model"] for r in stored.collect()} == set(results)
    loaded = models.load_model(paths[0])
    one, two = (models.new_scores(m, table, "id").orderBy("id").collect() for m in (results[models.LOGISTIC].model, loaded))
    assert one == two
    assert models.preferred_model(results) is results[models.FOREST]


def test_a_failed_model_is_no_leaderboard_row(spark, rows, table, monkeypatch):
    from modrisk.catalog import learning

    quick = {models.FOREST: {"trees": 3, "depth": 2}, models.NETWORK: {"hidden": (2,), "max_iter": 5}}
    for name, settings in quick.items():
        monkeypatch.setitem(models.DEFAULTS, name, {**models.DEFAULTS[name], **settings})
    monkeypatch.setattr(learning, "split_tables", lambda spark, sf: (table, table))
    whole = models.Trainer(folds=3)
    whole.train_all(table, table)
    assert whole.failures == {} and len(whole.require_all().metrics(spark).collect()) == 3
    # A test table of one class has no area under the curve; that is a result and not a failure.
    one = models.Trainer(folds=3)
    one.train_all(table, table.filter("label = 1"), [models.LOGISTIC])
    assert one.failures == {} and one.log[-1].endswith("undefined") and one.require_all() is one
    # Fails on the second call: the first call's row must not stand in for it.
    whole.settings = {models.LOGISTIC: {"C": "bad"}}
    whole.train_all(table, table, [models.LOGISTIC])
    assert set(whole.results) == {models.FOREST, models.NETWORK}
    monkeypatch.setitem(models.DEFAULTS, models.NETWORK, {"hidden": ("bad",)})
    with pytest.raises(RuntimeError, match="1 models failed: Neural Network"):
        learning.train_all(spark, "unused")
    monkeypatch.setattr(models, "scored_rows", lambda fitted, rows, *_: fitted.transform(rows).withColumn("score", F.lit(float("nan"))))
    lost = models.Trainer(folds=3)
    assert lost.train_all(table, table, [models.LOGISTIC]) == {}
    with pytest.raises(RuntimeError, match="not numbers"):
        lost.require_all()


def test_network_and_balancing(table):
    balanced = models.balanced_by_copies(table).groupBy("label").count().collect()
    counts = sorted(r["count"] for r in balanced)
    assert counts[0] / counts[1] > 0.8
    fitted = models.estimator(models.NETWORK, table, {"hidden": (4,), "max_iter": 30}).fit(models.training_rows(models.NETWORK, table))
    scores = evaluation.evaluate(models.scored_rows(fitted, table, "mlp")).first()
    assert scores["roc_auc"] > 0.8


def test_network_in_arrays_takes_sparks_steps(spark, rows, tmp_path, monkeypatch):
    """The same weights as Spark's trainer gives, over copies and in one task or many."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier

    table = models.model_table(rows, COLUMNS).limit(128).coalesce(1).persist()
    twice = table.unionByName(table).coalesce(1)
    few = dict(layers=[3, 6, 4, 2], maxIter=12, seed=7)
    want = MultilayerPerceptronClassifier(**few).fit(twice).weights.toArray()
    for known in (128, 256):  # tables of so many rows stay with Spark's trainer
        monkeypatch.setattr(network, "SPARKS_ROWS", known)
        for work in (10**9, 0):
            monkeypatch.setattr(network, "ONE_TASK_WORK", work)
            monkeypatch.setattr(network, "ROWS_PER_TASK", 50)
            fitted = network.Network(**few).fit(twice)
            assert fitted.weights.toArray() == pytest.approx(want, abs=1e-8 if known == 128 else 0)
    monkeypatch.setattr(network, "SPARKS_ROWS", 0)
    begun = network.Network(**{**few, "maxIter": 1}, initialWeights=fitted.weights.toArray().tolist()).fit(table)
    assert begun.weights.toArray() == pytest.approx(want, abs=1.0) and begun.getLayers() == [3, 6, 4, 2]
    models.save_model(spark, models.Trained(models.NETWORK, begun, {}, {}), str(tmp_path))
    loaded = models.load_model(f"{tmp_path}/{models.safe_name(models.NETWORK)}")
    assert loaded.weights.toArray().tolist() == begun.weights.toArray().tolist()
    both = [models.new_scores(m, table.limit(5)).collect() for m in (begun, loaded)]
    assert both[0] == both[1]
    with pytest.raises(Exception, match="classes are to be 0 to 1"):
        network.Network(**few).fit(table.withColumn("label", F.lit(2.0)))


def test_steps_end_and_recover():
    bowl = lambda x: (float((x - 3) @ (x - 3)) + 1, 2 * (x - 3))
    assert network.minimised(bowl, np.zeros(4), 500, 1e-6) == pytest.approx(np.full(4, 3.0))
    assert network.minimised(bowl, np.zeros(4), 0, 1e-6).tolist() == [0.0] * 4
    uphill = lambda x: (float(x @ x) + 1, -2 * x)  # the gradient is wrong: every search fails
    assert network.minimised(uphill, np.ones(2), 500, 1e-6).tolist() == [1.0, 1.0]
    edge = lambda x: (float("inf") if x[0] > 1 else float((x[0] - 1) ** 2) + 1, 2 * (x - 1))
    assert network.minimised(edge, np.zeros(1), 50, 1e-6)[0] == pytest.approx(1.0, abs=1e-3)


def test_forest_rows_are_dealt_by_their_work(spark):
    table = models.model_table(spark.range(0, 16_000, 1, 1).select((F.col("id") % 97).cast("double").alias("a"), (F.col("id") % 2).cast("int").alias("LABEL")), ["a"])
    assert models.training_rows(models.FOREST, table).rdd.getNumPartitions() == 4
    assert models.training_rows(models.LOGISTIC, table) is table
    few = table.limit(4_000)
    assert models.training_rows(models.FOREST, few) is few


def test_search(table):
    best, trials = models.search(models.LOGISTIC, table, [{"C": 1.0}, {"C": 1e-6}], folds=3)
    assert best == {"C": 1.0} and trials.count() == 2
    drawn = models.random_candidates(models.FOREST, 20)
    assert drawn == models.random_candidates(models.FOREST, 20)
    assert all(4 <= d["depth"] <= 20 and d["features"] in ("sqrt", "log2") for d in drawn)
    assert len(models.grid_candidates(models.FOREST)) == 12


def test_preprocessor_end_to_end(spark):
    rng = random.Random(2)
    data = []
    for i in range(240):
        loc = rng.randint(1, 300)
        data.append((float(loc), float(rng.randint(1, 20)), loc * 4.0 + rng.random(), rng.random() * 20, 7.0, "true" if loc > 220 else "false"))
    data += data[:20]
    raw = spark.createDataFrame(data, "loc double, `v(g)` double, v double, d double, same double, defects string")
    steps = Preprocessor(keep=4, trees=5)
    train, test = steps.fit_transform(raw)
    report = steps.report.first()
    assert report["raw_rows"] == 260 and report["clean_rows"] == 240
    assert report["test_size"] == 48 and report["train_defect_rate"] == pytest.approx(0.5)
    assert report["n_features"] == len(steps.selected) and 4 <= len(steps.selected) <= 8
    fitted = models.random_forest(trees=10).fit(train)
    assert evaluation.evaluate(models.scored_rows(fitted, test, "rf")).first()["roc_auc"] > 0.95
    assert with_folds(train, 3).select("fold").distinct().count() == 3
    leakfree = Preprocessor(keep=4, trees=5, strategy="none", fit_clean_on="train")
    assert leakfree.fit_transform(raw)[0].count() == 192
    from modrisk.operators.languages import source_rows

    files = source_rows(spark.createDataFrame([("a.py", "if a: eval(1)\n" * 250)], "path string, content string"))
    with_model = analyse(files, preprocessor=steps, model=fitted).risks.first()["risk_score"]
    assert 0.0 < with_model < 1.0


def test_training_rows_are_dealt_evenly(spark):
    """Hashed by class all rows of a class are in one partition; they must not stay there."""
    rows = spark.range(60_000).select(
        F.col("id"), (F.col("id") % 97).cast("double").alias("a"), (F.col("id") % 10 == 0).cast("int").alias("LABEL")
    )
    table = models.model_table(rows.repartition(8, "LABEL"), ["a"], keep=["id"])
    even = models.compacted(table)
    sizes = [n for n in even.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect() if n]
    assert len(sizes) == 3 and sum(sizes) == 60_000 and max(sizes) <= 21_000
    assert even.agg(F.countDistinct("id")).first()[0] == 60_000
    small = models.compacted(table.limit(500))
    assert small.rdd.getNumPartitions() == 1
    network = models.training_rows(models.NETWORK, even)
    sizes = network.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) < 1.1 * min(sizes)
    assert network.filter("label = 1").count() == 54_000


def test_tasks_grow_with_rows_and_keep_all_cores_busy():
    assert [tasks_for(n, 12) for n in (0, 20_000, 20_001, 10**6, 36 * 10**6)] == [1, 1, 2, 12, 144]


def test_forest_gets_rows_of_one_row_group_in_even_tasks(spark, monkeypatch):
    rows = spark.range(0, 60_000, 1, 1).select(
        (F.col("id") % 97).cast("double").alias("loc"), (F.col("id") % 31).cast("double").alias("v(g)"), (F.col("id") % 2).cast("int").alias("LABEL")
    )
    seen = []

    class Forest:
        def __init__(self, **settings):
            pass

        def fit(self, table):
            seen.append(table.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect())
            return self

        featureImportances = np.arange(99.0).view(type("Values", (np.ndarray,), {"toArray": lambda self: self}))

    monkeypatch.setattr(features, "RandomForestClassifier", Forest)
    assert features.forest_importance(rows, ["loc", "v(g)"]).count() == 2
    features.FeatureEngineer(keep=2).fit(rows)
    assert len(seen) == 2
    for sizes in seen:
        assert sum(sizes) == 60_000 and len(sizes) == 3 and max(sizes) < 1.1 * min(sizes)


def test_forest_of_many_rows_is_grown_in_arrays(spark, monkeypatch):
    """Importances like those of Spark's forest, without it; copies of a table and its parts do not matter."""
    rng = random.Random(5)
    data = []
    for i in range(4_000):
        a, b, c, d = rng.random(), rng.gauss(0, 1), rng.randint(0, 5), rng.random()
        data.append((a, b if i % 9 else None, c, d, int(a + 0.4 * (b if i % 9 else 0.0) + 0.05 * c > 1.0)))
    rows = spark.createDataFrame(data, "a double, `b(x)` double, c int, d double, LABEL int").repartition(3).persist()
    names = ["a", "b(x)", "c", "d"]

    def scores(**more):
        return {r["feature"]: r["score"] for r in features.forest_importance(rows, names, trees=60, depth=6, **more).collect()}

    want = scores()
    monkeypatch.setattr(features, "RandomForestClassifier", None)
    got = scores(small=3_999)
    assert got == scores(small=0) and sum(got.values()) == pytest.approx(1)
    assert all(got[n] == pytest.approx(want[n], abs=0.04) for n in names)
    constant = features.forest_importance(rows.withColumn("LABEL", F.lit(1)), names, trees=3, small=0).collect()
    assert {r["score"] for r in constant} == {0.0}
    with pytest.raises(Exception, match="not a number"):
        features.forest_importance(rows.withColumn("a", F.lit(float("nan"))), names, trees=3, small=0)


def test_splits_of_a_node_by_hand():
    counts = np.zeros((1, 1, 32, 2), np.int64)
    counts[0, 0, [0, 1, 2]] = [[4, 0], [0, 2], [0, 2]]
    gain, place, last, left, right = forest.best_splits(counts, np.array([1.0, 1.0]))
    assert (gain[0], place[0], last[0], left[0].tolist(), right[0].tolist()) == (0.5, 0, 0, [4, 0], [0, 4])
    assert forest.cuts_between([1.0, 2.0, 2.0, 4.0], [1.0] * 4).tolist() == [1.5, 3.0]
    assert forest.cuts_between(list(range(64)), [1.0] * 64, 3).tolist() == [15.5, 31.5, 47.5]


def test_information_counts_labels_of_any_kind(spark):
    rows = spark.createDataFrame(
        [(1.0, "x"), (None, "x"), (float("nan"), "y"), (2.0, None), (3.0, "y"), (0.0, "x")], "a double, LABEL string"
    ).repartition(3)
    found = features.mutual_information(rows, ["a"]).first()["score"]
    # Bins by the quantiles of a: 0 (twice, as null counts as 0), 1, 2, 3 and NaN are all apart.
    assert found == pytest.approx(-sum(p * np.log(p) for p in (3 / 6, 2 / 6, 1 / 6)))


def test_attribution_sums_are_not_made_by_sorting(spark):
    rows = spark.createDataFrame([(1, 0.2, 0.4), (2, None, 0.9), (2, 0.7, 0.1), (None, 0.5, 0.5)], "id long, a double, b double")
    formula = models.Formula(lambda x: 0.1 + 0.5 * F.get(x, F.lit(0)) + 0.2 * F.get(x, F.lit(1)) * F.get(x, F.lit(0)))
    found = explain.permutation_attribution(formula, rows, "id", ["a", "b"], [[0.0, 0.0], [1.0, 1.0]], "f", permutations=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan and "Union" not in plan

    def p(a, b):
        return 0.1 + 0.5 * a + 0.2 * a * b

    got = {(r["row_id"], r["feature"]): r["contribution"] for r in found.collect()}
    assert len(got) == 6  # rows of one id count together
    for key, a, b in ((1, 0.2, 0.4), (None, 0.5, 0.5)):
        first = sum((p(a, d) - p(c, d)) + (p(a, b) - p(c, b)) for c, d in ((0, 0), (1, 1))) / 4
        assert got[key, "a"] == pytest.approx(first)
        total = p(a, b) - (p(0, 0) + p(1, 1)) / 2
        assert got[key, "a"] + got[key, "b"] == pytest.approx(total)
    one = models.Formula(lambda x: 0.5 * F.get(x, F.lit(0)))
    alone = explain.permutation_attribution(one, rows.filter("id = 1"), "id", ["a"], [[0.0], [1.0]], "f", permutations=2)
    assert alone.first()["contribution"] == pytest.approx(0.1 - 0.25)
