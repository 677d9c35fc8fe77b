"""Queries on training and explanation over document features."""

from __future__ import annotations

from pyspark.sql import functions as F

from modrisk.catalog import query
from modrisk.catalog.scores import WITH as SCORES_WITH, scored
from modrisk.catalog.tables import metrics, rounded
from modrisk.catalog.views import documents, table
from modrisk.functions.tasks import dealt
from modrisk.operators import evaluation, explain, features, models, sampling
from modrisk.operators.cleaning import col
from modrisk.plans.preprocessing import Preprocessor, with_folds

FEATURES = ["chars", "lines", "commas", "capitals", "longest"]
_FEATURES_SQL = """SELECT doc_id, n_chars::DOUBLE AS chars, len(string_split(text, chr(10)))::DOUBLE AS lines,
  (length(text) - length(replace(text, ',', '')))::DOUBLE AS commas, length(regexp_replace(text, '[^A-Z]', '', 'g'))::DOUBLE AS capitals,
  list_max(list_transform(string_split(text, chr(10)), lambda l: length(l)))::DOUBLE AS longest FROM documents"""


def document_features(spark, sf):
    text = F.col("text")
    lines = F.split(text, "\n")
    return documents(spark, sf).select(
        "doc_id",
        F.col("n_chars").cast("double").alias("chars"),
        F.size(lines).cast("double").alias("lines"),
        (F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))).cast("double").alias("commas"),
        F.length(F.regexp_replace(text, "[^A-Z]", "")).cast("double").alias("capitals"),
        F.array_max(F.transform(lines, lambda l: F.length(l))).cast("double").alias("longest"),
    )


# ---- attribution with fixed coefficients ----------------------------------

MEANS = {"chars": 2500.0, "lines": 9.0, "commas": 40.0, "capitals": 30.0, "longest": 700.0}
COEFFICIENTS = {
    "alpha": {"chars": 0.0004, "lines": -0.05, "commas": 0.01, "capitals": 0.002, "longest": -0.0003},
    "beta": {"chars": -0.0002, "lines": 0.08, "commas": -0.02, "capitals": 0.015, "longest": 0.0007},
}
_ATTR = " UNION ALL ".join(
    f"SELECT doc_id AS row_id, '{m}' AS model, '{f}' AS feature, {f} AS value, {w}::DOUBLE * ({f} - {MEANS[f]}::DOUBLE) AS contribution FROM f"
    for m, ws in COEFFICIENTS.items()
    for f, w in ws.items()
)
ATTR = f"WITH f AS ({_FEATURES_SQL}), a AS ({_ATTR})"


def attributions(spark, sf, model: str):
    return explain.linear_attribution(document_features(spark, sf), "doc_id", COEFFICIENTS[model], MEANS, model)


def both(spark, sf):
    return attributions(spark, sf, "alpha").unionByName(attributions(spark, sf, "beta"))


@query("linear_attribution", f"{ATTR} SELECT row_id, model, feature, value, round(contribution, 6) AS contribution FROM a")
def linear_attribution(spark, sf):
    return rounded(both(spark, sf), ["contribution"])


_IMPORTANCE = """SELECT *, row_number() OVER (PARTITION BY model ORDER BY importance DESC, feature)::INT AS rank
  FROM (SELECT model, feature, avg(abs(contribution)) AS importance FROM a GROUP BY ALL)"""


@query("global_importance", f"{ATTR} SELECT model, feature, round(importance, 9) AS importance, rank FROM ({_IMPORTANCE}) WHERE rank <= 4")
def global_importance(spark, sf):
    return rounded(explain.global_importance(both(spark, sf), 4), ["importance"], 9)


@query(
    "attribution_distribution",
    f"""{ATTR} SELECT model, feature, row_id, value, round(contribution, 6) AS contribution, rank FROM a JOIN (SELECT model, feature, rank FROM ({_IMPORTANCE}) WHERE rank <= 3) USING (model, feature)""",
)
def attribution_distribution(spark, sf):
    return rounded(explain.distribution_rows(both(spark, sf), 3), ["contribution"])


@query(
    "attribution_heatmap",
    f"""{ATTR}, r AS (SELECT row_id, feature, contribution, rank FROM a JOIN (SELECT model, feature, rank FROM ({_IMPORTANCE}) WHERE rank <= 3 AND model = 'alpha') USING (model, feature)),
        t AS (SELECT row_id, row_number() OVER (ORDER BY sum(contribution), substr(md5('heatmap:' || row_id), 1, 8), row_id) - 1 AS place, count(*) OVER () AS n FROM r GROUP BY row_id),
        p AS (SELECT DISTINCT floor(i * (n - 1) / 199)::BIGINT AS place FROM (SELECT DISTINCT n FROM t), range(0, 200) g(i)),
        k AS (SELECT row_id, row_number() OVER (ORDER BY place)::INT AS sample FROM t JOIN p USING (place))
        SELECT sample, row_id, rank, feature, round(contribution, 6) AS contribution FROM r JOIN k USING (row_id)""",
)
def attribution_heatmap(spark, sf):
    return rounded(explain.heatmap(attributions(spark, sf, "alpha"), 3), ["contribution"])


@query(
    "waterfall",
    f"""{ATTR}, n AS (SELECT *, row_number() OVER (PARTITION BY model, row_id ORDER BY abs(contribution) DESC, feature) AS n FROM a),
        s AS (SELECT model, row_id, least(n, 4)::INT AS step, CASE WHEN least(n, 4) = 4 THEN 'other ' || count(*) || ' features' ELSE any_value(feature) END AS feature,
          sum(contribution) AS contribution FROM n GROUP BY model, row_id, least(n, 4))
        SELECT model, row_id, step, feature, round(contribution, 6) AS contribution,
          round(0.5 + sum(contribution) OVER (PARTITION BY model, row_id ORDER BY step ROWS UNBOUNDED PRECEDING), 6) AS running_total FROM s""",
)
def waterfall(spark, sf):
    return rounded(explain.waterfall(both(spark, sf), 0.5, 3), ["contribution", "running_total"])


@query(
    "dependency",
    f"""{ATTR} SELECT x.model, x.row_id, x.value, round(x.contribution, 6) AS contribution, y.value AS colour
        FROM a x JOIN a y USING (model, row_id) WHERE x.feature = 'chars' AND y.feature = 'lines'""",
)
def dependency(spark, sf):
    return rounded(explain.dependency(both(spark, sf), "chars", "lines"), ["contribution"])


@query("importance_comparison", f"{ATTR} SELECT model, feature, round(importance, 9) AS importance, rank FROM ({_IMPORTANCE}) WHERE rank <= 10")
def importance_comparison(spark, sf):
    parts = [attributions(spark, sf, m) for m in COEFFICIENTS]
    return rounded(explain.model_comparison(parts), ["importance"], 9)


@query(
    "contribution_breakdown",
    f"""{ATTR} SELECT row_id, model, feature, value, round(contribution, 6) AS contribution, rank FROM (
          SELECT *, row_number() OVER (PARTITION BY model, row_id ORDER BY abs(contribution) DESC, feature)::INT AS rank FROM a) WHERE rank <= 2""",
)
def contribution_breakdown(spark, sf):
    parts = [attributions(spark, sf, m) for m in COEFFICIENTS]
    return rounded(explain.breakdown(parts, top=2), ["contribution"])


_TEXT = "printf('%s = %.2f (%+.4f)', feature, value, contribution)"


@query(
    "narratives",
    f"""{ATTR}, n AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY abs(contribution) DESC, feature) AS n FROM a WHERE model = 'alpha'),
        t AS (SELECT row_id, coalesce(string_agg({_TEXT}, '; ' ORDER BY n) FILTER (contribution > 0), '') AS raises_risk,
                coalesce(string_agg({_TEXT}, '; ' ORDER BY n) FILTER (contribution < 0), '') AS lowers_risk FROM n WHERE n <= 5 GROUP BY row_id)
        SELECT row_id, raises_risk, lowers_risk, CASE WHEN score >= 0.5 THEN 'HIGH RISK' WHEN score >= 0.3 THEN 'MEDIUM RISK' ELSE 'LOW RISK' END AS verdict
        FROM t JOIN (SELECT doc_id AS row_id, (doc_id % 101) / 100.0 AS score FROM f) USING (row_id)""",
)
def narratives(spark, sf):
    probabilities = documents(spark, sf).select(
        F.col("doc_id").alias("row_id"), F.lit("alpha").alias("model"), (F.col("doc_id") % 101 / 100.0).alias("score")
    )
    return explain.narratives(attributions(spark, sf, "alpha"), probabilities).select(
        "row_id", "raises_risk", "lowers_risk", "verdict"
    )


# ---- scaling and stored scores --------------------------------------------


@query(
    "standardise",
    f"""WITH f AS ({_FEATURES_SQL}) SELECT doc_id, """ + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in FEATURES
    ) + " FROM f",
)
def standardise(spark, sf):
    rows = document_features(spark, sf)
    return rounded(models.PopulationScaler(columns=FEATURES).fit(rows).transform(rows), FEATURES)


@query(
    "stored_scores",
    f"""{SCORES_WITH} SELECT model, round(accuracy, 6)::DOUBLE AS accuracy, round(precision, 6)::DOUBLE AS precision, round(recall, 6)::DOUBLE AS recall,
        round(f1, 6)::DOUBLE AS f1, round(roc_auc, 6)::DOUBLE AS roc_auc FROM met JOIN areas USING (model) WHERE model = 'by_size'""",
)
def stored_scores(spark, sf):
    names = ["accuracy", "precision", "recall", "f1", "roc_auc"]
    return rounded(models.allowed_models(evaluation.evaluate(scored(spark, sf)), ["by_size"]), names)


# ---- training (no SQL twin: iterative fits) -------------------------------


def labelled_features(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("LABEL"))
    return document_features(spark, sf).join(labels, "doc_id")


def split_tables(spark, sf):
    """Scaled model tables for training (with folds) and testing."""
    rows = sampling.stratified_split(labelled_features(spark, sf).persist(), "doc_id")
    train, test = rows.filter(~F.col("is_test")), rows.filter("is_test")
    scaler = models.PopulationScaler(columns=FEATURES).fit(train)
    folded = sampling.stratified_folds(scaler.transform(train), "doc_id")
    return (
        models.compacted(models.model_table(folded, FEATURES, keep=["doc_id", "fold"])),
        models.model_table(scaler.transform(test), FEATURES, keep=["doc_id"]),
    )


def _trained(spark, sf, name):
    train, test = split_tables(spark, sf)
    return models.estimator(name, train, models.DEFAULTS[name]).fit(models.training_rows(name, train)), train, test


def _scores_of(name):
    def build(spark, sf):
        fitted, _, test = _trained(spark, sf, name)
        return evaluation.evaluate(models.scored_rows(fitted, test, name, "doc_id"))

    return build


query("train_lr")(_scores_of(models.LOGISTIC))
query("train_rf")(_scores_of(models.FOREST))
query("train_mlp")(_scores_of(models.NETWORK))


@query("train_all")
def train_all(spark, sf):
    train, test = split_tables(spark, sf)
    trainer = models.Trainer(folds=5)
    trainer.train_all(train, test)
    return evaluation.leaderboard(trainer.require_all().metrics(spark))


@query("score_documents")
def score_documents(spark, sf):
    """Every document scored by a model trained on the labelled ones."""
    labelled = labelled_features(spark, sf)
    scaler = models.PopulationScaler(columns=FEATURES).fit(labelled)
    train = models.compacted(models.model_table(scaler.transform(labelled), FEATURES))
    fitted = models.estimator(models.LOGISTIC, train, models.DEFAULTS[models.LOGISTIC]).fit(train)
    # Scoring looks at no label; the model table only wants the column.
    everything = scaler.transform(document_features(spark, sf)).withColumn("LABEL", F.lit(None).cast("int"))
    return models.new_scores(fitted, models.model_table(everything, FEATURES, keep=["doc_id"]), "doc_id")


@query("cross_validate")
def cross_validate(spark, sf):
    train, _ = split_tables(spark, sf)
    scores = models.cross_validated(models.LOGISTIC, train, models.DEFAULTS[models.LOGISTIC])
    return evaluation.fold_summary(scores, ["roc_auc", "f1", "recall"])


@query("grid_search")
def grid_search(spark, sf):
    train, _ = split_tables(spark, sf)
    return models.search(models.LOGISTIC, train, models.grid_candidates(models.LOGISTIC), parallelism=8)[1]


@query("random_search")
def random_search(spark, sf):
    train, _ = split_tables(spark, sf)
    return models.search(models.LOGISTIC, train, models.random_candidates(models.LOGISTIC), parallelism=8)[1]


@query("native_importance")
def native_importance(spark, sf):
    fitted, _, _ = _trained(spark, sf, models.FOREST)
    return models.native_importance(fitted, FEATURES)


@query("feature_selection")
def feature_selection(spark, sf):
    rows = dealt(metrics(spark, sf).drop("k", "l_orderkey", "l_partkey")).persist()
    columns = [c for c in rows.columns if c != "LABEL"]
    return features.union_of_tops(
        features.mutual_information(rows, columns), features.forest_importance(rows, columns, even=True), 10
    )


@query("engineered_features")
def engineered_features(spark, sf):
    rows = metrics(spark, sf).drop("k", "l_orderkey", "l_partkey")
    return features.FeatureEngineer().fit(rows).transform(rows)


@query("preprocess_report")
def preprocess_report(spark, sf):
    raw = labelled_features(spark, sf).select(
        F.col("chars").alias("v"), F.col("lines").alias("loc"), F.col("commas").alias("branchCount"),
        F.col("capitals").alias("v(g)"), F.col("longest").alias("n"), F.col("LABEL").alias("defects"),
    )
    steps = Preprocessor()
    steps.fit_transform(raw)
    return steps.report


def _forest(spark, sf):
    """A forest over the features as they are, since it is asked about rows that are not scaled."""
    rows = sampling.stratified_split(labelled_features(spark, sf).persist(), "doc_id").filter("NOT is_test")
    return models.random_forest(trees=50, depth=5).fit(models.compacted(models.model_table(rows, FEATURES)))


@query("permutation_attribution")
def permutation_attribution(spark, sf):
    """Every document under a forest trained on the labelled ones."""
    fitted = _forest(spark, sf)
    base = explain.background(labelled_features(spark, sf), FEATURES, "doc_id", explain.PERMUTATION_BACKGROUND)
    return explain.permutation_attribution(fitted, document_features(spark, sf), "doc_id", FEATURES, base, "forest")


GROUNDS = [[200.0 * i, 3.0 + i, 5.0 * i, 4.0 * (i % 5), 90.0 * i] for i in range(20)]
ORDERS = explain.permutation_orders(len(FEATURES), 10)


def _formula_sql(x: list[str]) -> str:
    return f"1 / (1 + exp(-(0.0004 * ({x[0]}) - 0.05 * ({x[1]}) + 0.0002 * ({x[2]}) * ({x[3]}) - 0.0003 * ({x[4]}))))"


def _formula(x):
    at = [F.get(x, F.lit(i)) for i in range(len(FEATURES))]
    z = 0.0004 * at[0] - 0.05 * at[1] + 0.0002 * at[2] * at[3] - 0.0003 * at[4]
    return 1.0 / (1.0 + F.exp(-z))


_SWITCHED = ", ".join(f"CASE WHEN list_position(o.ord, {i}) <= s THEN f.{c} ELSE g.x[{i + 1}] END AS x{i}" for i, c in enumerate(FEATURES))
_PERMUTED = f"""WITH f AS ({_FEATURES_SQL}),
o AS (SELECT * FROM (VALUES {', '.join(f'({i}, {o})' for i, o in enumerate(ORDERS))}) t(id, ord)),
g AS (SELECT * FROM (VALUES {', '.join(f'({i}, {g})' for i, g in enumerate(GROUNDS))}) t(id, x)),
v AS (SELECT doc_id, o.id AS o, o.ord, g.id AS g, s, {_SWITCHED} FROM f, o, g, range(0, {len(FEATURES) + 1}) r(s)),
p AS (SELECT doc_id, o, ord, g, s, {_formula_sql([f'x{i}' for i in range(len(FEATURES))])} AS p FROM v),
d AS (SELECT doc_id, ord[s] AS i, p - lag(p) OVER (PARTITION BY doc_id, o, g ORDER BY s) AS d FROM p),
c AS (SELECT doc_id, i, avg(d) AS contribution FROM d WHERE d IS NOT NULL GROUP BY doc_id, i)
SELECT doc_id AS row_id, 'formula' AS model, n.feature, CASE n.i {' '.join(f'WHEN {i} THEN f.{c}' for i, c in enumerate(FEATURES))} END AS value,
  round(contribution, 8) AS contribution
FROM c JOIN f USING (doc_id) JOIN (VALUES {', '.join(f"({i}, '{c}')" for i, c in enumerate(FEATURES))}) n(i, feature) USING (i)"""


@query("formula_attribution", _PERMUTED)
def formula_attribution(spark, sf):
    """Every document under a fixed formula: all variants can be enumerated in SQL."""
    found = explain.permutation_attribution(
        models.Formula(_formula), document_features(spark, sf), "doc_id", FEATURES, GROUNDS, "formula", permutations=len(ORDERS)
    )
    return rounded(found, ["contribution"], 8)


def _surrogate_sql(samples: int = explain.SURROGATE_SAMPLES) -> str:
    """The surrogate in SQL: all perturbed rows of all documents, then elimination feature by feature."""
    k = range(len(FEATURES))
    draws = ", ".join(f"({s}, {u})" for s, u in enumerate(explain.surrogate_draws(samples - 1, len(FEATURES)), 1))
    every = ", ".join(f"({i}, '{c}')" for i, c in enumerate(FEATURES))
    long = "SELECT doc_id, i, CASE i " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(FEATURES)) + " END AS v FROM {} f, names"
    width = explain.KERNEL_FACTOR ** 2 * len(FEATURES)
    wide = ", ".join([f"max(CASE WHEN i = {i} THEN z END) AS z{i}" for i in k] + [f"max(CASE WHEN i = {i} THEN x END) AS x{i}" for i in k])
    sums = ["sum(w) AS w", "sum(w * p) AS p"] + [f"sum(w * z{i}) AS s{i}" for i in k] + [f"sum(w * z{i} * p) AS r{i}" for i in k]
    sums += [f"sum(w * z{i} * z{j}) AS g{i}_{j}" for i in k for j in k]
    begin = [f"g{i}_{j} - s{i} * s{j} / w + {int(i == j)} AS a{i}_{j}" for i in k for j in k] + [f"r{i} - s{i} * p / w AS b{i}" for i in k]
    steps, last = "", "e"
    for n in k:  # clears column n everywhere but in row n
        cleared = [f"a{i}_{j} - a{i}_{n} * a{n}_{j} / a{n}_{n} AS a{i}_{j}" if i != n else f"a{i}_{j}" for i in k for j in k]
        cleared += [f"b{i} - a{i}_{n} * b{n} / a{n}_{n} AS b{i}" if i != n else f"b{i}" for i in k]
        steps += f", e{n} AS (SELECT doc_id, {', '.join(cleared)} FROM {last})"
        last = f"e{n}"
    solved = " ".join(f"WHEN {i} THEN b{i} / a{i}_{i}" for i in k)
    return f"""WITH f AS ({_FEATURES_SQL}), names AS (SELECT * FROM (VALUES {every}) t(i, feature)),
fl AS ({long.format('f')}), tl AS ({long.format('(SELECT * FROM f JOIN labels USING (doc_id))')}),
cuts AS (SELECT i, list_distinct([quantile_cont(v, 0.25), quantile_cont(v, 0.5), quantile_cont(v, 0.75)]) AS c FROM tl GROUP BY i),
lev AS (SELECT i, len(list_filter(c, lambda q: v > q)) AS b, count(*) AS n, avg(v) AS m FROM tl JOIN cuts USING (i) GROUP BY ALL),
share AS (SELECT i, b, m, sum(n) OVER (PARTITION BY i ORDER BY b) / sum(n) OVER (PARTITION BY i)::DOUBLE AS upto FROM lev),
draws AS (SELECT s, i, u[i + 1] AS u FROM (VALUES {draws}) t(s, u), names),
pick AS (SELECT s, i, count_if(upto <= u)::INT AS b FROM draws JOIN share USING (i) GROUP BY s, i),
own AS (SELECT doc_id, i, v, len(list_filter(c, lambda q: v > q)) AS b FROM fl JOIN cuts USING (i)),
moved AS (SELECT doc_id, s, i, (own.b = pick.b)::INT AS z, CASE WHEN own.b = pick.b THEN v ELSE m END AS x
  FROM own JOIN pick USING (i) JOIN share ON share.i = own.i AND share.b = pick.b
  UNION ALL SELECT doc_id, 0, i, 1, v FROM own),
wide AS (SELECT doc_id, s, {wide} FROM moved GROUP BY doc_id, s),
one AS (SELECT *, {_formula_sql([f'x{i}' for i in k])} AS p, sqrt(exp(-({len(FEATURES)} - {' - '.join(f'z{i}' for i in k)}) / {width}::DOUBLE)) AS w FROM wide),
g AS (SELECT doc_id, {', '.join(sums)} FROM one GROUP BY doc_id),
e AS (SELECT doc_id, {', '.join(begin)} FROM g){steps},
beta AS (SELECT doc_id, i, feature, CASE i {solved} END AS weight FROM {last}, names)
SELECT doc_id AS row_id, feature, round(weight, 7) AS weight,
  row_number() OVER (PARTITION BY doc_id ORDER BY round(abs(weight), 9) DESC, i)::INT AS rank FROM beta"""


@query("formula_surrogate", _surrogate_sql())
def formula_surrogate(spark, sf):
    """Every document under a fixed formula."""
    training = labelled_features(spark, sf)
    found = explain.local_surrogate(models.Formula(_formula), document_features(spark, sf), "doc_id", FEATURES, training)
    return rounded(found, ["weight"], 7)


@query("local_surrogate")
def local_surrogate(spark, sf):
    """Every document under a forest trained on the labelled ones."""
    fitted = _forest(spark, sf)
    return explain.local_surrogate(fitted, document_features(spark, sf), "doc_id", FEATURES, labelled_features(spark, sf))
