"""Per-file code metrics as column expressions, one narrow projection per file.

Each family of languages has its own patterns; a CASE on the extension picks
the branch, so only the matching patterns run on a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from modrisk.functions.text import INLINE_SPACE, S, SPACE, W, count_char, line_start, occurrences, whole_word
from modrisk.operators.languages import file_key, join_files

# Which rules each extension uses. A directory scan reads
# headers with the C rules and leaves .jsx to the fallback; a list of files
# also accepts .jsx.
TREE_FAMILIES = {
    "python": [".py"],
    "java": [".java", ".cs"],
    "javascript": [".js"],
    "c": [".c", ".cpp", ".h", ".hpp"],
}
LIST_FAMILIES = {**TREE_FAMILIES, "javascript": [".js", ".jsx"]}

# The columns a prediction needs.
PREDICTION_COLUMNS = [
    "LOC", "LOC_BLANK", "LOC_TOTAL", "LOC_COMMENTS", "CYCLOMATIC_COMPLEXITY",
    "DECISION_COUNT", "FUNCTION_COUNT", "CLASS_COUNT", "COMMENT_RATIO",
]

# The patterns the counts are defined by.
_SLASH_COMMENT_LINE = rf"(?:\A|\n)[{INLINE_SPACE}]*//"
_BLOCK_COMMENT = r"(?s)/\*.*?\*/"
_VISIBILITY = "(?:public|private|protected)"
_ARGUMENTS = r"\([^)]*\)"
PATTERNS = {
    "non_blank_line": rf"(?md)^[{INLINE_SPACE}]*+[^{SPACE}]",
    "python": {
        "comments": [
            rf"(?:\A|\n)[{INLINE_SPACE}]*#",
            '(?s)""".*?"""',
            "(?s)'''.*?'''",
        ],
        "functions": [line_start(rf"def{S}+{W}+")],
        "classes": [line_start(rf"class{S}+{W}+")],
        "decisions": [whole_word("if|elif|for|while|except|and|or")],
        "imports": [line_start(rf"import{S}+|from{S}+{W}+{S}+import")],
    },
    "java": {
        "comments": [_SLASH_COMMENT_LINE, _BLOCK_COMMENT],
        "functions": [rf"{_VISIBILITY}{S}+(?:static{S}+)?{W}+{S}+{W}+{S}*{_ARGUMENTS}"],
        "classes": [line_start(rf"class{S}+{W}+")],
        "decisions": [
            whole_word("if|for|while|case|catch") + r"|&&|\|\|",
            whole_word(f"else{S}+if"),
        ],
        "imports": [line_start(rf"import{S}+")],
    },
    "javascript": {
        "comments": [_SLASH_COMMENT_LINE, _BLOCK_COMMENT],
        "functions": [rf"function{S}+{W}+|=>"],
        "classes": [rf"class{S}+{W}+"],
        "decisions": [
            whole_word("if|for|while|switch|catch") + r"|&&|\|\||\?",
            whole_word(f"else{S}+if"),
        ],
        "imports": [],
    },
    "c": {
        "comments": [_SLASH_COMMENT_LINE, _BLOCK_COMMENT],
        "functions": [rf"(?<!{W}){W}++{S}++{W}++{S}*+{_ARGUMENTS}{S}*+\{{"],
        "classes": [],
        "decisions": [
            whole_word("if|for|while|switch|case") + r"|&&|\|\|",
            whole_word(f"else{S}+if"),
        ],
        "imports": [line_start("#include|#define")],
    },
}
_FIELD = rf"{_VISIBILITY}{S}+{W}+{S}+{W}+{S}*;"
_PARAMETER_LIST = rf"def{S}+{W}+\(([^)]*)\)"


def written_extension(name: Column) -> Column:
    """Extension as written; leading dots of a name do not start one."""
    return F.regexp_extract(name, r"(?s)[^.].*?(\.[^.]*)\z", 1)


def _per_family(families: dict[str, list[str]], ext: Column, build) -> Column:
    """CASE over the extension; ``build`` gives the expression of one family."""
    chosen = None
    for family, extensions in families.items():
        value = build(family)
        if value is None:
            continue
        hit = ext.isin(*extensions)
        chosen = F.when(hit, value) if chosen is None else chosen.when(hit, value)
    return chosen


def _count(content: Column, family: str, what: str) -> Column:
    total = F.lit(0)
    for pattern in PATTERNS[family][what]:
        total = total + occurrences(content, pattern)
    return total


def _parameters(content: Column) -> Column:
    """Comma pieces over all parameter lists; an empty list still counts one."""
    lists = F.regexp_extract_all(content, F.lit(_PARAMETER_LIST), F.lit(1))
    return F.aggregate(lists, F.lit(0), lambda total, text: total + F.size(F.split(text, ",")))


def count_metrics(files: DataFrame, families: dict[str, list[str]] | None = None) -> DataFrame:
    """Add the code metrics of each file; files of other languages get NULLs.

    Extensions are compared as written, so ``.PY`` is not a Python file here.
    """
    families = families or TREE_FAMILIES
    content = F.col("content")
    ext = written_extension(F.col("fname"))
    handled = ext.isin(*[e for known in families.values() for e in known])

    def count(what: str) -> Column:
        return _per_family(families, ext, lambda family: _count(content, family, what))

    counted = files.select(
        "*",
        F.when(handled, occurrences(content, PATTERNS["non_blank_line"])).alias("LOC"),
        F.when(handled, count_char(content, "\n") + 1).alias("LOC_TOTAL"),
        count("comments").alias("LOC_COMMENTS"),
        count("functions").alias("FUNCTION_COUNT"),
        count("classes").alias("CLASS_COUNT"),
        count("decisions").alias("DECISION_COUNT"),
        _per_family(
            families, ext, lambda f: None if f == "javascript" else _count(content, f, "imports")
        ).alias("IMPORT_COUNT"),
        F.when(ext.isin(*families["python"]), occurrences(content, whole_word("return"))).alias("RETURN_COUNT"),
        F.when(ext.isin(*families["python"]), _parameters(content)).alias("PARAMETER_COUNT"),
        F.when(ext.isin(*families["java"]), occurrences(content, _FIELD)).alias("FIELD_COUNT"),
    )
    return counted.select(
        "*",
        (F.col("LOC_TOTAL") - F.col("LOC")).alias("LOC_BLANK"),
        (F.col("LOC") - F.col("LOC_COMMENTS")).alias("LOC_CODE"),
        (F.col("DECISION_COUNT") + 1).alias("CYCLOMATIC_COMPLEXITY"),
        (F.col("LOC_COMMENTS") / F.col("LOC_TOTAL")).alias("COMMENT_RATIO"),
    )


def supported_only(files: DataFrame, families: dict[str, list[str]] | None = None) -> DataFrame:
    """Keep the files whose extension has metric rules."""
    known = [e for group in (families or TREE_FAMILIES).values() for e in group]
    return files.filter(written_extension(F.col("fname")).isin(*known))


def labelled_metrics(files: DataFrame) -> DataFrame:
    """Metrics of the supported files with a placeholder label of 0."""
    return count_metrics(supported_only(files)).withColumn("LABEL", F.lit(0))


def prediction_columns(metrics: DataFrame) -> DataFrame:
    """The nine prediction columns; absent ones become 0."""
    present = set(metrics.columns)
    return metrics.select(
        *[F.col(c) if c in present else F.lit(0).alias(c) for c in PREDICTION_COLUMNS]
    )


def analysis_metrics(files: DataFrame) -> DataFrame:
    """The six values the risk score uses, with defaults for other languages."""
    counted = count_metrics(files)
    non_blank = occurrences(F.col("content"), PATTERNS["non_blank_line"])
    return counted.select(
        *files.columns,
        F.coalesce(F.col("LOC"), non_blank).alias("loc"),
        F.coalesce(F.col("CYCLOMATIC_COMPLEXITY"), F.lit(2)).alias("cc"),
        F.coalesce(F.col("FUNCTION_COUNT"), F.lit(1)).alias("funcs"),
        F.coalesce(F.col("CLASS_COUNT"), F.lit(0)).alias("classes"),
        F.coalesce(F.col("DECISION_COUNT"), F.lit(1)).alias("decisions"),
        F.coalesce(F.col("COMMENT_RATIO"), F.lit(0.0)).alias("comment_ratio"),
    )


def attach_metrics(files: DataFrame, metrics: DataFrame) -> DataFrame:
    """Left join of metrics that arrive as their own table, with the defaults."""
    wanted = metrics.select(
        *file_key(files, metrics), "LOC", "CYCLOMATIC_COMPLEXITY", "FUNCTION_COUNT", "CLASS_COUNT",
        "DECISION_COUNT", "COMMENT_RATIO",
    )
    non_blank = occurrences(F.col("content"), PATTERNS["non_blank_line"])
    narrow = files.select("*", non_blank.alias("_non_blank")).drop("content")
    return join_files(narrow, wanted, "left").select(
        *[c for c in files.columns if c != "content"],
        F.coalesce(F.col("LOC"), F.col("_non_blank")).alias("loc"),
        F.coalesce(F.col("CYCLOMATIC_COMPLEXITY"), F.lit(2)).alias("cc"),
        F.coalesce(F.col("FUNCTION_COUNT"), F.lit(1)).alias("funcs"),
        F.coalesce(F.col("CLASS_COUNT"), F.lit(0)).alias("classes"),
        F.coalesce(F.col("DECISION_COUNT"), F.lit(1)).alias("decisions"),
        F.coalesce(F.col("COMMENT_RATIO"), F.lit(0.0)).alias("comment_ratio"),
    )
