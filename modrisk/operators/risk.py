"""File risk rows and the workspace roll-ups built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from modrisk.functions.bands import band, band_names
from modrisk.functions.scores import blended, capped, rule_score
from modrisk.operators.code_metrics import analysis_metrics
from modrisk.operators.languages import file_key, join_files
from modrisk.operators.line_rules import DEFAULT_SEALS, line_risks, scored_lines

METRICS = ["loc", "cc", "funcs", "classes", "decisions", "comment_ratio"]


def file_risk(
    files: DataFrame,
    jitter: bool = False,
    model_scores: DataFrame | None = None,
    seals=DEFAULT_SEALS,
) -> DataFrame:
    """Metrics, line counts, score and band of each file.

    Metrics are computed on the file row and travel with its lines, so the one
    shuffle is the roll-up by file, which the map side has already reduced to a
    row per file. ``model_scores(path, model_score)`` is blended in when given.
    With an ``archive`` column, equal paths of different archives stay apart.
    """
    # Name, extension and language follow from the path. As grouping keys they
    # keep the hash aggregate, whose buffers cannot hold strings.
    names = [*file_key(files), "fname", "ext", "lang"]
    rows = scored_lines(analysis_metrics(files), *names, *METRICS, seals=seals)
    rolled = rows.groupBy(*names).agg(
        *[F.any_value(c).alias(c) for c in METRICS],
        F.count_if(F.col("level") == "high").alias("high_lines"),
        F.count_if(F.col("level") == "med").alias("med_lines"),
    )
    base = rule_score(jitter)
    if model_scores is not None:
        rolled = join_files(rolled, model_scores.select(*file_key(rolled, model_scores), "model_score"), "left")
        base = blended(F.col("model_score"), base)
    score = capped(base, F.col("high_lines"), F.col("med_lines"))
    return rolled.select(
        *names, *METRICS, "high_lines", "med_lines", score.alias("risk_score")
    ).withColumn("risk_level", band(F.col("risk_score"), "analysis"))


def workspace_summary(risks: DataFrame, scale: str = "analysis") -> DataFrame:
    """One row: files, LOC, average risk, counts per band, share of high files."""
    score = F.col("risk_score")
    level = band(score, scale)
    high, medium, low = band_names(scale)
    return risks.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("loc"), F.lit(0)).cast("long").alias("total_loc"),
        F.coalesce(F.avg(score), F.lit(0.0)).alias("avg_risk"),
        F.count_if(level == high).alias("high"),
        F.count_if(level == medium).alias("med"),
        F.count_if(level == low).alias("low"),
        (F.count_if(level == high) / F.greatest(F.count(F.lit(1)), F.lit(1)) * 100).alias("high_pct"),
    )


def risk_by_language(risks: DataFrame) -> DataFrame:
    return (
        risks.groupBy("lang")
        .agg(F.avg("risk_score").alias("avg_risk"), F.count(F.lit(1)).alias("files"))
        .withColumn("avg_risk_pct", F.round(F.col("avg_risk") * 100, 1))
    )


def band_counts(risks: DataFrame, scale: str = "dashboard") -> DataFrame:
    """Files per band, every band present; scores in no band are left out."""
    spark = risks.sparkSession
    names = spark.createDataFrame(
        [(i, n) for i, n in enumerate(band_names(scale))], "ord int, band string"
    )
    counted = risks.groupBy(band(F.col("risk_score"), scale).alias("band")).agg(
        F.count(F.lit(1)).alias("files")
    )
    # At most four rows on the counted side: one per band and one for no band.
    return names.join(F.broadcast(counted), "band", "left").select(
        "ord", "band", F.coalesce("files", F.lit(0)).alias("files")
    )


def histogram(
    rows: DataFrame, value: str, bins: int = 30, by: list[str] | None = None
) -> DataFrame:
    """Equal-width bins between minimum and maximum, per group when ``by`` is given."""
    keys = by or []
    limits = rows.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    if keys:
        joined = rows.join(limits, keys)
    else:
        joined = rows.select(
            "*", limits.select("_lo").scalar().alias("_lo"), limits.select("_hi").scalar().alias("_hi")
        )
    lo, hi, v = F.col("_lo"), F.col("_hi"), F.col(value)
    width = (hi - lo) / F.lit(float(bins))
    position = F.when(hi > lo, F.least(F.floor((v - lo) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))).otherwise(0)
    return (
        joined.filter(v.isNotNull())
        .groupBy(*keys, position.cast("int").alias("bin"), lo.alias("_lo"), width.alias("_width"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            *keys,
            "bin",
            (F.col("_lo") + F.col("bin") * F.col("_width")).alias("bin_start"),
            (F.col("_lo") + (F.col("bin") + 1) * F.col("_width")).alias("bin_end"),
            "n",
        )
    )


def riskiest(risks: DataFrame, k: int = 15, tie: str = "path") -> DataFrame:
    """Top-k files by risk; ties by ``tie``. Plans as TakeOrderedAndProject."""
    return risks.orderBy(F.desc("risk_score"), F.asc(tie)).limit(k)


def by_risk(risks: DataFrame, tie: str = "path") -> DataFrame:
    return risks.orderBy(F.desc("risk_score"), F.asc(tie))


def module_table(scored: DataFrame, module: str = "module", probability: str = "probability") -> DataFrame:
    """Modules with probability (3 decimals) and band, most risky first."""
    p = F.col(probability)
    return scored.select(
        F.col(module).alias("module"),
        F.round(p, 3).alias("probability"),
        band(p, "heatmap").alias("risk_level"),
        p.alias("_p"),
    ).orderBy(F.desc("_p"), "module").drop("_p")


def rescored(previous: DataFrame, changed: DataFrame, seals=DEFAULT_SEALS) -> DataFrame:
    """File risks after some files changed content.

    Metrics and score of a changed file stay; its line counts are recomputed,
    and the score drops to the quiet cap once no risky line is left.
    ``changed`` is (path, fname, ext, lang, content), and archive where
    ``previous`` has it: equal paths of different archives are different files.
    """
    keys = file_key(previous, changed)
    levels = (
        line_risks(changed, *keys, seals=seals)
        .groupBy(*keys)
        .agg(
            F.count_if(F.col("level") == "high").alias("_high"),
            F.count_if(F.col("level") == "med").alias("_med"),
        )
    )
    fresh = join_files(changed.select(*keys), levels, "left").select(
        *keys,
        F.lit(True).alias("_changed"),
        F.coalesce("_high", F.lit(0)).alias("_high"),
        F.coalesce("_med", F.lit(0)).alias("_med"),
    )
    joined = join_files(previous, fresh, "left")
    touched = F.col("_changed").isNotNull()
    score = F.when(touched, capped(F.col("risk_score"), F.col("_high"), F.col("_med"))).otherwise(
        F.col("risk_score")
    )
    replaced = {
        "high_lines": F.when(touched, F.col("_high")).otherwise(F.col("high_lines")),
        "med_lines": F.when(touched, F.col("_med")).otherwise(F.col("med_lines")),
        "risk_score": score,
        "risk_level": band(score, "analysis"),
    }
    return joined.select(*[replaced[c].alias(c) if c in replaced else F.col(c) for c in previous.columns])
