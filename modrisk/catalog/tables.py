"""Queries on metric tables: cleaning, features, splits and oversampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from modrisk.catalog import query
from modrisk.catalog.views import table
from modrisk.operators import cleaning, features, neighbours, sampling
from modrisk.functions import scores
from modrisk.operators.cleaning import col
from modrisk.sources import tabular

MEASURES = ["loc", "v(g)", "v", "d", "lOComment", "branchCount"]

_METRICS = """SELECT l_orderkey * 10 + l_linenumber AS k, l_orderkey, l_partkey,
  CASE WHEN (l_orderkey * 7 + l_linenumber) % 11 = 0 THEN NULL ELSE l_quantity END AS loc,
  l_linenumber::DOUBLE AS "v(g)",
  CASE WHEN (l_partkey + l_linenumber) % 13 = 0 THEN NULL ELSE l_extendedprice END AS v,
  l_discount AS d, l_tax AS "lOComment", (l_suppkey % 7)::DOUBLE AS "branchCount",
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS "LABEL" FROM lineitem"""


def metrics(spark, sf):
    """Line items as module metrics, with some values missing."""
    li = table(spark, sf, "lineitem")
    c = F.col
    return li.select(
        (c("l_orderkey") * 10 + c("l_linenumber")).alias("k"),
        "l_orderkey", "l_partkey",
        F.when((c("l_orderkey") * 7 + c("l_linenumber")) % 11 != 0, c("l_quantity")).alias("loc"),
        c("l_linenumber").cast("double").alias("v(g)"),
        F.when((c("l_partkey") + c("l_linenumber")) % 13 != 0, c("l_extendedprice")).alias("v"),
        c("l_discount").alias("d"),
        c("l_tax").alias("lOComment"),
        (c("l_suppkey") % 7).cast("double").alias("branchCount"),
        (c("l_returnflag") == "R").cast("int").alias("LABEL"),
    )


def rounded(frame, columns, places=6):
    return frame.select(*[F.round(col(c), places).alias(c) if c in columns else col(c) for c in frame.columns])


_COARSE = """SELECT l_quantity, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem"""


@query("dedup", f"SELECT DISTINCT * FROM ({_COARSE})")
def dedup(spark, sf):
    return cleaning.drop_exact_duplicates(
        table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    )


@query(
    "label_normalise",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS "LABEL" FROM lineitem""",
)
def label_normalise(spark, sf):
    text = F.when(F.col("l_linestatus") == "O", " Yes ").otherwise("no")
    return cleaning.normalise_label(
        table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.alias("Defects"))
    )


@query("integrity_filter", f"SELECT k, l_partkey, loc FROM ({_METRICS}) WHERE loc > 0")
def integrity_filter(spark, sf):
    return cleaning.integrity_filter(metrics(spark, sf)).select("k", "l_partkey", "loc")


@query(
    "feature_columns",
    f'SELECT loc, "v(g)", v, d, "lOComment", "branchCount" FROM ({_METRICS})',
)
def feature_columns(spark, sf):
    return cleaning.features_only(metrics(spark, sf).drop("k", "l_orderkey", "l_partkey"))


@query(
    "median_fill",
    f"""WITH m AS ({_METRICS}) SELECT k, l_partkey, round(coalesce(loc, (SELECT median(loc) FROM m)), 6) AS loc,
        round(coalesce(v, (SELECT median(v) FROM m)), 6) AS v FROM m""",
)
def median_fill(spark, sf):
    rows = metrics(spark, sf)
    filled = cleaning.fill_missing(rows, cleaning.medians(rows, ["loc", "v"]))
    return rounded(filled.select("k", "l_partkey", "loc", "v"), ["loc", "v"])


_HALF = '(SELECT quantile_cont("{c}", 0.25) AS a, quantile_cont("{c}", 0.75) AS b FROM m)'


def _bounds(name: str, factor: float) -> str:
    return f"""(SELECT struct_pack(lo := a - {factor} * (b - a), hi := b + {factor} * (b - a)) FROM {_HALF.format(c=name)})"""


def _clip(name: str, factor: float) -> str:
    return f"""round(CASE WHEN {name} IS NOT NULL THEN least(greatest({name}, {_bounds(name, factor)}.lo), {_bounds(name, factor)}.hi) END, 6)::DOUBLE AS {name}"""


@query(
    "iqr_clip",
    f"WITH m AS ({_METRICS}) SELECT k, l_partkey, {_clip('loc', 0.25)}, {_clip('v', 0.25)} FROM m",
)
def iqr_clip(spark, sf):
    rows = metrics(spark, sf)
    limited = cleaning.clipped(rows, cleaning.clip_bounds(rows, ["loc", "v"], 0.25))
    return rounded(limited.select("k", "l_partkey", "loc", "v"), ["loc", "v"])


@query(
    "zero_variance",
    f"WITH m AS (SELECT * REPLACE (0.05 AS d) FROM ({_METRICS})) "
    + " UNION ALL ".join(f"""SELECT '{c}' AS "column" FROM m HAVING count(DISTINCT "{c}") <= 1""" for c in MEASURES),
)
def zero_variance(spark, sf):
    rows = metrics(spark, sf).withColumn("d", F.lit(0.05))
    found = cleaning.constant_columns(rows, MEASURES)
    return spark.createDataFrame([(c,) for c in found], "`column` string")


_DESCRIBED = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count("{c}") AS count, round(avg("{c}"), 4) AS mean, round(stddev_samp("{c}"), 4) AS std,
    min("{c}")::DOUBLE AS min, round(quantile_cont("{c}", 0.25), 4)::DOUBLE AS q25, round(quantile_cont("{c}", 0.5), 4)::DOUBLE AS q50,
    round(quantile_cont("{c}", 0.75), 4)::DOUBLE AS q75, max("{c}")::DOUBLE AS max, (count(*) - count("{c}")) AS missing FROM m"""
    for c in [*MEASURES, "LABEL"]
)


@query("describe", f"WITH m AS ({_METRICS}) {_DESCRIBED}")
def describe(spark, sf):
    return rounded(
        cleaning.describe(metrics(spark, sf), [*MEASURES, "LABEL"]), ["mean", "std", "q25", "q50", "q75"], 4
    )


@query(
    "missing_counts",
    f"""WITH m AS ({_METRICS}) """ + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS missing FROM m""" for c in [*MEASURES, "LABEL"]
    ),
)
def missing_counts(spark, sf):
    return cleaning.missing_counts(metrics(spark, sf).select(*[col(c) for c in [*MEASURES, "LABEL"]]))


def _cleaned_sql(factor: float = 3.0) -> str:
    """The cleaner in SQL; CTEs m (distinct, checked), f (filled), c (clipped)."""
    names = [*MEASURES]
    fill = ", ".join(f'coalesce("{c}", (SELECT median("{c}") FROM m)) AS "{c}"' for c in names)
    quart = ", ".join(
        f'quantile_cont("{c}", 0.25) AS a{i}, quantile_cont("{c}", 0.75) AS b{i}' for i, c in enumerate(names)
    )
    clip = ", ".join(
        f'least(greatest("{c}", a{i} - {factor} * (b{i} - a{i})), b{i} + {factor} * (b{i} - a{i})) AS "{c}"'
        for i, c in enumerate(names)
    )
    return f"""m AS (SELECT DISTINCT * FROM ({_METRICS}) WHERE loc > 0), f AS (SELECT k, l_partkey, "LABEL", {fill} FROM m),
      q AS (SELECT {quart} FROM f), c AS (SELECT k, l_partkey, "LABEL", {clip} FROM f, q)"""


@query(
    "cleaned_metrics",
    f"""WITH {_cleaned_sql(0.5)} SELECT k, l_partkey, "LABEL", {', '.join(f'round("{c}", 6)::DOUBLE AS "{c}"' for c in MEASURES)} FROM c""",
)
def cleaned_metrics(spark, sf):
    rows = metrics(spark, sf).select("k", "l_partkey", "LABEL", *[col(c) for c in MEASURES])
    keys = ["k", "l_partkey"]
    cleaner = cleaning.MetricCleaner(multiplier=0.5)
    prepared = cleaner.prepare(rows)
    model = cleaner.fit(prepared.drop(*keys))
    return rounded(model.transform(prepared), MEASURES).select("k", "l_partkey", "LABEL", *[col(c) for c in MEASURES])


@query(
    "log_features",
    f"""SELECT k, l_partkey, CASE WHEN loc IS NOT NULL THEN round(ln(1 + greatest(loc, 0)), 6) END AS log_loc,
        CASE WHEN v IS NOT NULL THEN round(ln(1 + greatest(v, 0)), 6) END AS log_v,
        round(ln(1 + greatest(d, 0)), 6) AS log_d, round(ln(1 + greatest("lOComment", 0)), 6) AS "log_lOComment" FROM ({_METRICS})""",
)
def log_features(spark, sf):
    wide = features.with_logs(metrics(spark, sf))
    names = ["log_loc", "log_v", "log_d", "log_lOComment"]
    return rounded(wide.select("k", "l_partkey", *names), names)


@query(
    "interactions",
    f"""SELECT k, l_partkey, round("v(g)" * loc, 6) AS "v(g)xloc", round(d * v, 6) AS dxv, round("branchCount" * loc, 6) AS "branchCountxloc" FROM ({_METRICS})""",
)
def interactions(spark, sf):
    names = ["v(g)xloc", "dxv", "branchCountxloc"]
    return rounded(features.with_products(metrics(spark, sf)).select("k", "l_partkey", *[col(n) for n in names]), names)


@query(
    "ratios",
    f"""SELECT k, l_partkey, round(CASE WHEN coalesce(loc, 0) = 0 THEN 0 ELSE "v(g)" / loc END, 6)::DOUBLE AS "v(g)_per_loc",
        round(CASE WHEN coalesce(loc, 0) = 0 THEN 0 ELSE "lOComment" / loc END, 6)::DOUBLE AS comment_density,
        round(CASE WHEN coalesce(loc, 0) = 0 THEN 0 ELSE "branchCount" / loc END, 6)::DOUBLE AS branch_density FROM ({_METRICS})""",
)
def ratios(spark, sf):
    names = ["v(g)_per_loc", "comment_density", "branch_density"]
    return rounded(features.with_ratios(metrics(spark, sf)).select("k", "l_partkey", *[col(n) for n in names]), names)


@query(
    "minmax",
    """SELECT l_orderkey, l_linenumber, round((l_quantity - min(l_quantity) OVER ()) / (max(l_quantity) OVER () - min(l_quantity) OVER ()), 6) AS l_quantity,
       round((l_extendedprice - min(l_extendedprice) OVER ()) / (max(l_extendedprice) OVER () - min(l_extendedprice) OVER ()), 6) AS l_extendedprice FROM lineitem""",
)
def minmax(spark, sf):
    names = ["l_quantity", "l_extendedprice"]
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *names)
    return rounded(features.min_max(rows, names), names)


@query(
    "aggregated_features",
    """SELECT l_orderkey, (l_linenumber + 1)::INT AS "CYCLOMATIC_COMPLEXITY", round(l_quantity / (l_extendedprice + 1), 6) AS "CODE_DENSITY",
       round(l_tax / (l_extendedprice + 1), 6) AS "COMMENT_RATIO", 0.0::DOUBLE AS "DESIGN_COMPLEXITY_RATIO" FROM lineitem""",
)
def aggregated_features(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("DECISION_COUNT"), F.col("l_quantity").alias("LOC_EXECUTABLE"),
        F.col("l_tax").alias("LOC_COMMENTS"), F.col("l_extendedprice").alias("LOC_TOTAL"),
    )
    names = ["CYCLOMATIC_COMPLEXITY", "CODE_DENSITY", "COMMENT_RATIO", "DESIGN_COMPLEXITY_RATIO"]
    return rounded(features.aggregated_features(rows).select("l_orderkey", *names), names[1:])


@query(
    "feature_corr_topk",
    f"""WITH m AS ({_METRICS}) SELECT feature, round(score, 6) AS score FROM (""" + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, abs(corr("{c}", "LABEL")) AS score FROM m""" for c in MEASURES
    ) + ") ORDER BY score DESC, feature LIMIT 4",
)
def feature_corr_topk(spark, sf):
    return rounded(features.top_features(features.correlations(metrics(spark, sf), MEASURES), 4), ["score"])


def _information(name: str) -> str:
    cuts = f"""(SELECT list_distinct(quantile_cont(coalesce("{name}"), [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) FROM m)"""
    return f"""SELECT '{name}' AS feature, greatest(sum(n / t * ln(n * t / (b * l))), 0) AS score FROM (
      SELECT n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY bin) AS b, sum(n) OVER (PARTITION BY "LABEL") AS l FROM (
        SELECT len(list_filter({cuts}, lambda p: p < coalesce("{name}", 0))) AS bin, "LABEL", count(*)::DOUBLE AS n FROM m GROUP BY ALL))"""


@query(
    "mutual_information",
    f"WITH m AS ({_METRICS}) SELECT feature, round(score, 6) AS score FROM ("
    + " UNION ALL ".join(_information(c) for c in MEASURES) + ")",
)
def mutual_information(spark, sf):
    return rounded(features.mutual_information(metrics(spark, sf), MEASURES), ["score"])


@query(
    "label_counts",
    """SELECT quality AS "LABEL", count(*) AS rows FROM labels GROUP BY quality""",
)
def label_counts(spark, sf):
    return cleaning.label_counts(table(spark, sf, "labels").withColumnRenamed("quality", "LABEL"))


@query(
    "label_summary",
    """SELECT count(*) AS rows, sum(toxic)::BIGINT AS positives, round(avg(toxic), 6) AS positive_rate FROM labels""",
)
def label_summary(spark, sf):
    return rounded(cleaning.label_summary(table(spark, sf, "labels"), "toxic"), ["positive_rate"])


@query(
    "class_weights",
    """SELECT n - p AS negatives, p AS positives, round(n / (2.0 * (n - p)), 6)::DOUBLE AS weight_0, round(n / (2.0 * p), 6)::DOUBLE AS weight_1,
       round((n - p) / p, 6)::DOUBLE AS positive_weight, round(least(p, n - p) / greatest(p, n - p), 6)::DOUBLE AS minority_ratio
       FROM (SELECT count(*) AS n, count(*) FILTER (toxic = 1) AS p FROM labels)""",
)
def class_weights(spark, sf):
    frame = sampling.class_weights(table(spark, sf, "labels"), "toxic")
    return rounded(frame, ["weight_0", "weight_1", "positive_weight", "minority_ratio"])


def draw_sql(text: str) -> str:
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT / 4294967296.0)::DOUBLE"


@query(
    "stratified_split",
    f"""WITH c AS (SELECT toxic, count(*) AS n, sum(count(*)) OVER () AS t FROM labels GROUP BY toxic),
        e AS (SELECT toxic, ceil(0.2 * t) AS target, ceil(0.2 * t) * n / t AS x FROM c),
        s AS (SELECT toxic, floor(x) + CASE WHEN row_number() OVER (ORDER BY floor(x) - x, toxic) <= target - sum(floor(x)) OVER () THEN 1 ELSE 0 END AS take FROM e)
        SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY {draw_sql("'42:' || doc_id")}, doc_id) <= take AS is_test
        FROM labels JOIN s USING (toxic)""",
)
def stratified_split(spark, sf):
    return sampling.stratified_split(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id", "toxic")


@query(
    "stratified_folds",
    f"""SELECT doc_id, toxic, ((row_number() OVER (PARTITION BY toxic ORDER BY {draw_sql("'42:' || doc_id")}, doc_id) - 1) % 5)::INT AS fold FROM labels""",
)
def stratified_folds(spark, sf):
    return sampling.stratified_folds(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id", "toxic")


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vector"), (F.col("label") == 0).cast("int").alias("LABEL")
    )


_VEC = 'v AS (SELECT vec_id, embedding::DOUBLE[] AS x, CASE WHEN label = 0 THEN 1 ELSE 0 END AS y FROM embeddings)'
_DIST = "sqrt(list_sum(list_transform(range(1, len(a.x) + 1), lambda i: (a.x[i] - b.x[i]) * (a.x[i] - b.x[i]))))"


def _near(candidates: str) -> str:
    return f"""SELECT vec_id, neighbour, distance, rank FROM (
      SELECT a.vec_id, b.vec_id AS neighbour, {_DIST} AS distance,
        row_number() OVER (PARTITION BY a.vec_id ORDER BY {_DIST}, b.vec_id)::INT AS rank
      FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.y = 1 AND {candidates}) WHERE rank <= 5"""


@query("knn_minority", f"WITH {_VEC} SELECT vec_id, neighbour, round(distance, 6) AS distance, rank FROM ({_near('b.y = 1')})")
def knn_minority(spark, sf):
    minority = vectors(spark, sf).filter("LABEL = 1")
    return rounded(neighbours.nearest(minority, minority, 5, "vec_id"), ["distance"])


@query("knn_all", f"WITH {_VEC} SELECT vec_id, neighbour, round(distance, 6) AS distance, rank FROM ({_near('true')})")
def knn_all(spark, sf):
    rows = vectors(spark, sf)
    return rounded(neighbours.nearest(rows.filter("LABEL = 1"), rows, 5, "vec_id"), ["distance"])


_NEW = f"""SELECT s.vec_id, s.copy, a.x AS fx, b.x AS tx, {draw_sql("'42:step:' || s.vec_id || ':' || s.copy")} AS u
  FROM (SELECT vec_id, unnest(range(0, copies)) AS copy FROM seeds) s JOIN v a USING (vec_id)
  JOIN nn ON nn.vec_id = s.vec_id AND nn.rank = floor({draw_sql("'42:pick:' || s.vec_id || ':' || s.copy")} * 5) + 1
  JOIN v b ON b.vec_id = nn.neighbour"""
_EMIT = f"""SELECT vec_id, NULL::BIGINT AS copy, y AS "LABEL", round(x[1], 6) AS first, round(list_sum(x), 5) AS total FROM v
  UNION ALL SELECT vec_id, copy::BIGINT, 1, round(fx[1] + u * (tx[1] - fx[1]), 6),
    round(list_sum(list_transform(range(1, len(fx) + 1), lambda i: fx[i] + u * (tx[i] - fx[i]))), 5) FROM ({_NEW})"""


def _summed(frame):
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    return frame.select(
        "vec_id", "copy", "LABEL", F.round(F.element_at("vector", 1), 6).alias("first"), F.round(total, 5).alias("total")
    )


@query(
    "smote",
    f"""WITH {_VEC}, nn AS ({_near('b.y = 1')}), n AS (SELECT count(*) FILTER (y = 1) AS s, count(*) FILTER (y = 0) - count(*) FILTER (y = 1) AS g FROM v),
      seeds AS (SELECT vec_id, g // s + CASE WHEN row_number() OVER (ORDER BY {draw_sql("'42:order:' || vec_id")}, vec_id) <= g % s THEN 1 ELSE 0 END AS copies
                FROM v, n WHERE y = 1) {_EMIT}""",
)
def smote(spark, sf):
    return _summed(sampling.smote(vectors(spark, sf), "vec_id", "vector"))


@query(
    "adasyn",
    f"""WITH {_VEC}, nn AS ({_near('b.y = 1')}), na AS ({_near('true')}), n AS (SELECT count(*) FILTER (y = 0) - count(*) FILTER (y = 1) AS g FROM v),
      h AS (SELECT na.vec_id, count(*) FILTER (v.y <> 1) / 5.0::DOUBLE AS r FROM na JOIN v ON v.vec_id = na.neighbour GROUP BY na.vec_id),
      seeds AS (SELECT vec_id, round_even(r / sum(r) OVER () * g, 0)::BIGINT AS copies FROM h, n) {_EMIT}""",
)
def adasyn(spark, sf):
    return _summed(sampling.adasyn(vectors(spark, sf), "vec_id", "vector"))


# ---- metric tables as text -------------------------------------------------

_TYPED = ["k", *MEASURES]
_READ = f"WITH m AS ({_METRICS}) SELECT " + ", ".join(f'"{c}"::DOUBLE AS "{c}"' for c in _TYPED) + ', "LABEL" FROM m'


def _as_text(spark, sf, missing):
    """The metrics as lines of text; ``missing`` gives the text of a missing value."""
    rows = metrics(spark, sf)
    cells = [F.coalesce(col(c).cast("string"), missing) for c in _TYPED]
    label = F.when(F.col("LABEL") == 1, "TRUE").otherwise("no")
    return rows.select(F.concat_ws(",", *cells, label).alias("value"))


@query("arff_rows", _READ)
def arff_rows(spark, sf):
    """The metrics rendered as lines of an ARFF file, between comments and declarations, and read again."""
    attributes = tabular.declared(["@RELATION m", *[f"@attribute {c} numeric" for c in _TYPED], "  @attribute 'LABEL' {TRUE,no}", "@data"])
    lines = _as_text(spark, sf, F.lit("?"))
    noise = spark.createDataFrame([("% 1,2,3",), ("",), ("@data",), ("   ",)], "value string")
    return tabular.arff_rows(lines.unionByName(noise), attributes)


@query("csv_rows", _READ)
def csv_rows(spark, sf):
    """The metrics rendered as CSV lines with all spellings of a missing value, types found, label normalised."""
    spelled = F.array(*[F.lit(t) for t in [*tabular.MISSING_TEXTS, "N/A", "NaN", " null "]])
    lines = _as_text(spark, sf, F.get(spelled, F.pmod(F.col("k"), F.size(spelled)).cast("int")))
    rows = cleaning.normalise_label(tabular.csv_rows(lines, [*_TYPED, "defects"]))
    return rows.select(*[col(c).cast("double").alias(c) for c in _TYPED], "LABEL")


_HALSTEAD = """WITH c AS (SELECT l_orderkey, l_linenumber, l_linenumber + 3 AS n1, l_suppkey % 9 AS n2, l_quantity::BIGINT AS t1, l_partkey % 40 AS t2,
  l_linenumber % 4 AS args FROM lineitem),
h AS (SELECT *, (n1 + n2)::DOUBLE AS vocabulary, (t1 + t2)::DOUBLE AS length, (args + 2) * log2(args + 2) AS potential FROM c),
v AS (SELECT *, length * log2(vocabulary) AS volume, coalesce(potential / nullif(length, 0), 0) AS level FROM h)
SELECT l_orderkey, l_linenumber, vocabulary, length, round(volume, 4) AS volume, round(level, 6) AS level,
  round(coalesce(1 / nullif(level, 0), 0), 4) AS difficulty, round(level * volume, 4) AS intelligence,
  round(coalesce(volume / nullif(level, 0), 0), 2) AS effort, round(coalesce(volume / nullif(level, 0), 0) / 18, 2) AS time FROM v"""


@query("halstead", _HALSTEAD)
def halstead(spark, sf):
    """Halstead measures from operator and operand counts."""
    c = F.col
    measures = scores.halstead(
        c("l_linenumber") + 3, c("l_suppkey") % 9, c("l_quantity").cast("long"), c("l_partkey") % 40, c("l_linenumber") % 4
    )
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *[e.alias(n) for n, e in measures.items()])
    return rounded(rounded(rounded(rows, ["volume", "difficulty", "intelligence"], 4), ["level"]), ["effort", "time"], 2)


@query(
    "blended_risk",
    """SELECT l_orderkey, l_linenumber, round(CASE WHEN quiet THEN least(risk, 0.1) ELSE risk END, 6) AS risk FROM (
    SELECT l_orderkey, l_linenumber, l_linenumber % 3 = 0 AS quiet,
      CASE WHEN l_linenumber = 1 THEN l_discount * 5 ELSE l_tax * 10 * 0.7 + l_discount * 5 * 0.3 END AS risk FROM lineitem)""",
)
def blended_risk(spark, sf):
    """Model scores mixed with rule scores, the rule alone without a model, quiet files capped."""
    c = F.col
    model = F.when(c("l_linenumber") != 1, c("l_tax") * 10)
    high = (c("l_linenumber") % 3 != 0).cast("int")
    risk = scores.capped(scores.blended(model, c("l_discount") * 5), high, F.lit(0))
    return rounded(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", risk.alias("risk")), ["risk"])
