"""Review tables: metric violations, dangerous lines, file and workspace context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as Win, functions as F

from modrisk.functions.bands import band
from modrisk.functions.text import has, snippet, strip, universal_lines
from modrisk.operators.languages import file_key, join_files

# Metric, warning edge, critical edge, lower-is-worse, name, unit.
THRESHOLDS = [
    ("loc", 150.0, 300.0, False, "Lines of Code (LOC)", "lines"),
    ("cc", 7.0, 15.0, False, "Cyclomatic Complexity", ""),
    ("funcs", 10.0, 20.0, False, "Function Count", "functions"),
    ("comment_ratio", 0.05, 0.02, True, "Comment Ratio", "%"),
    ("classes", 5.0, 10.0, False, "Class Count", "classes"),
]

# Dangerous patterns in priority order, severity and reason.
DANGEROUS = [
    ("eval(", "CRITICAL", "runs arbitrary code"),
    ("exec(", "CRITICAL", "runs arbitrary code"),
    ("while True", "HIGH", "loop without an end"),
    ("except:", "HIGH", "catches everything, even a request to exit"),
    ("except Exception:", "MEDIUM", "handler is too broad"),
    ("os.system(", "HIGH", "shell command built from text"),
    ("pickle.load", "HIGH", "reads untrusted serialised data"),
    ("TODO", "LOW", "not finished"),
    ("FIXME", "MEDIUM", "known bug"),
    ("HACK", "MEDIUM", "workaround"),
    ("global ", "LOW", "global state"),
    ("__import__(", "MEDIUM", "dynamic import"),
]
SEVERITY_RANK = {"CRITICAL": 0, "HIGH": 1, "MEDIUM": 2, "LOW": 3}
MAX_HIGH_FILES, MAX_MEDIUM_FILES = 10, 8
MAX_PROMPT_HOTSPOTS, MAX_FIX_HOTSPOTS = 15, 20

# Name fragments that put a file first when packing a context.
ENTRY_FRAGMENTS = ["main", "app", "index"]
CODE_ENDINGS = [".py", ".js", ".ts", ".java", ".cpp"]


def _violation(metric: str, warn: float, critical: float, inverse: bool, name: str) -> Column:
    value = F.col(metric).cast("double")

    def found(severity: str, threshold: float) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"),
            F.lit(name).alias("metric_name"),
            value.alias("value"),
            F.lit(threshold).alias("threshold"),
            F.lit(severity).alias("severity"),
        )

    if inverse:
        return F.when(value <= critical, found("CRITICAL", critical)).when(
            value <= warn, found("MEDIUM", warn)
        )
    return F.when(value >= critical, found("CRITICAL", critical)).when(value >= warn, found("HIGH", warn))


def violations_of() -> Column:
    """The threshold violations of one file as an array; five thresholds at most."""
    return F.array_compact(F.array(*[_violation(*t[:5]) for t in THRESHOLDS]))


def metric_violations(risks: DataFrame, *keep: str) -> DataFrame:
    """One row per metric over (or for comments under) its threshold."""
    return risks.select(*keep, F.inline(violations_of()))


def by_severity(violations: DataFrame, *keys: str, alphabetical: bool = True) -> DataFrame:
    """Violations in severity order: alphabetical, or from critical to low."""
    rank = F.create_map(*[F.lit(x) for item in SEVERITY_RANK.items() for x in item])
    order = F.col("severity") if alphabetical else F.element_at(rank, F.col("severity"))
    return violations.orderBy(*keys, order, "metric")


def _first_pattern(text: Column) -> Column:
    """The first matching pattern in priority order, as a struct."""
    chosen = None
    for pattern, severity, reason in DANGEROUS:
        found = F.struct(
            F.lit(pattern).alias("pattern"), F.lit(severity).alias("severity"), F.lit(reason).alias("reason")
        )
        hit = text.contains(pattern)
        chosen = F.when(hit, found) if chosen is None else chosen.when(hit, found)
    return chosen


def dangerous_lines(files: DataFrame, *keep: str) -> DataFrame:
    """Lines with a dangerous pattern, one pattern a line; narrow, no shuffle.

    Files without any pattern are dropped before their lines are split.
    """
    any_pattern = has(F.col("content"), *[p for p, _, _ in DANGEROUS])
    lines = files.filter(any_pattern).select(
        *keep, F.posexplode_outer(universal_lines(F.col("content"))).alias("_pos", "_line")
    ).filter(has(F.col("_line"), *[p for p, _, _ in DANGEROUS]))
    stripped = lines.select(*keep, (F.col("_pos") + 1).alias("line_no"), strip(F.col("_line")).alias("_text"))
    return (
        stripped.select(*keep, "line_no", F.substring("_text", 1, 120).alias("code"), _first_pattern(F.col("_text")).alias("_hit"))
        .filter(F.col("_hit").isNotNull())
        .select(*keep, "line_no", "code", "_hit.*")
    )


def _dangerous_of(content: Column, lines: Column) -> Column:
    """Dangerous lines of one file as an array, in line order."""
    def row(line: Column, i: Column) -> Column:
        return F.struct((i + 1).alias("line_no"), strip(line).alias("text"))

    def found(row: Column) -> Column:
        hit = _first_pattern(row["text"])
        return F.struct(row["line_no"].alias("line_no"), F.substring(row["text"], 1, 120).alias("code"), hit.alias("hit"))

    def flat(row: Column) -> Column:
        hit = row["hit"]
        return F.struct(
            row["line_no"].alias("line_no"), row["code"].alias("code"),
            hit["pattern"].alias("pattern"), hit["severity"].alias("severity"), hit["reason"].alias("reason"),
        )

    patterns = [p for p, _, _ in DANGEROUS]
    candidates = F.filter(F.transform(lines, row), lambda r: has(r["text"], *patterns))
    return F.when(has(content, *patterns), F.transform(F.transform(candidates, found), flat))


def file_context(files: DataFrame, risks: DataFrame) -> DataFrame:
    """Everything about a file on one row, from source files and their risks.

    Hotspots and snippet are worked out on the file row before the join, so
    the shuffle carries those instead of whole texts.
    """
    none = F.array().cast(
        "array<struct<line_no:int,code:string,pattern:string,severity:string,reason:string>>"
    )
    key = file_key(files, risks)
    excerpts = files.select(
        *key, "lang", "content", universal_lines(F.col("content")).alias("_lines")
    ).select(
        *key,
        F.coalesce(F.col("lang"), F.lit("Unknown")).alias("language"),
        F.coalesce(_dangerous_of(F.col("content"), F.col("_lines")), none).alias("hotspots"),
        snippet(F.col("_lines")).alias("snippet"),
    )
    return join_files(excerpts, risks.drop("lang")).select(
        *key,
        "language",
        "risk_score",
        band(F.col("risk_score"), "review").alias("risk_level"),
        "loc", "cc", "funcs", "classes", "comment_ratio",
        violations_of().alias("violations"),
        "hotspots",
        "snippet",
    )


def capped_hotspots(lines: DataFrame, *keys: str, most: int = MAX_PROMPT_HOTSPOTS) -> DataFrame:
    """The first lines of each file, in line order."""
    window = Win.partitionBy(*keys).orderBy("line_no")
    return lines.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= most).drop("_n")


def selected_files(risks: DataFrame, scale: str = "review") -> DataFrame:
    """Files of the high and the medium review band."""
    level = band(F.col("risk_score"), scale)
    return risks.withColumn("review_level", level).filter(level.isin("HIGH", "MEDIUM"))


def workspace_review(risks: DataFrame, order: str = "path") -> DataFrame:
    """The first high and medium files in input order, for a workspace report.

    Two top-k plans (ten and eight rows) instead of a window over a whole band.
    """
    picked = selected_files(risks)
    high = picked.filter(F.col("review_level") == "HIGH").orderBy(order).limit(MAX_HIGH_FILES)
    medium = picked.filter(F.col("review_level") == "MEDIUM").orderBy(order).limit(MAX_MEDIUM_FILES)
    return high.unionByName(medium)


def packing_priority(path: Column) -> Column:
    """0 readme, 1 entry points, 2 main code languages, 3 the rest."""
    name = F.lower(path)
    return (
        F.when(name.contains("readme"), 0)
        .when(has(name, *ENTRY_FRAGMENTS), 1)
        .when(F.substring_index(name, ".", -1).isin(*[e[1:] for e in CODE_ENDINGS]) & name.contains("."), 2)
        .otherwise(3)
    )


def packed_context(files: DataFrame, budget: int = 50000, order: str = "path") -> DataFrame:
    """Files that fit a character budget, most useful first.

    Files are taken by (priority, content length, order) until the first block
    that would go over the budget. Every block is longer than ``overhead``
    characters, so at most ``budget / overhead`` files can fit: a top-k plan of
    that many (path, length) rows, and a window over this bounded prefix only.
    Texts are fetched afterwards for the chosen paths. When even the first block
    is too long it is cut to the budget.
    """
    before, between, after = "\n\n--- File: ", " ---\n```\n", "\n```"
    overhead = len(before + between + after)
    sized = files.filter(F.length("content") > 0).select(
        "path",
        packing_priority(F.col("path")).alias("priority"),
        F.length("content").alias("content_length"),
        F.col(order).alias("_order"),
        (F.length("content") + F.length("path") + overhead).alias("block_length"),
    )
    prefix = sized.orderBy("priority", "content_length", "_order").limit(budget // overhead + 1)
    ordered = Win.orderBy("priority", "content_length", "_order")
    running = prefix.select(
        "*",
        F.row_number().over(ordered).alias("position"),
        F.sum("block_length").over(ordered.rowsBetween(Win.unboundedPreceding, 0)).alias("running_length"),
    )
    fits = F.col("running_length") <= budget
    first_cut = (F.col("position") == 1) & ~fits
    chosen = running.filter(fits | first_cut).select(
        "position", "path", "priority", "block_length", "running_length", first_cut.alias("is_cut")
    )
    block = F.concat(F.lit(before), F.col("path"), F.lit(between), F.col("content"), F.lit(after))
    cut = F.concat(F.substring(block, 1, budget), F.lit("\n...[TRUNCATED]...\n```"))
    # chosen has at most budget / overhead rows.
    return files.select("path", "content").join(F.broadcast(chosen), "path").select(
        "position", "path", "priority", "block_length", "running_length", "is_cut",
        F.when(F.col("is_cut"), cut).otherwise(block).alias("block"),
    )
