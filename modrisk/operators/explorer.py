"""File explorer tables: filters, folder matches and listing order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as Win, functions as F

from modrisk.functions.bands import band

# Names of the explorer's risk filters.
FILTER_BANDS = {"High": "HIGH", "Medium": "MED", "Low": "LOW"}


def file_matches(query: str = "", risk_filter: str = "All") -> Column:
    """Case-insensitive substring of the path, and the risk band."""
    matched = F.lower(F.col("path")).contains(query.lower()) if query else F.lit(True)
    if risk_filter in FILTER_BANDS:
        matched = matched & (
            band(F.coalesce(F.col("risk_score"), F.lit(0.0)), "analysis") == FILTER_BANDS[risk_filter]
        )
    return matched


def matching_files(risks: DataFrame, query: str = "", risk_filter: str = "All") -> DataFrame:
    return risks.filter(file_matches(query, risk_filter))


def _segments(path: Column) -> Column:
    return F.filter(F.split(F.translate(path, "\\", "/"), "/"), lambda part: part != "")


def folders(risks: DataFrame, query: str = "", risk_filter: str = "All") -> DataFrame:
    """Every folder with its file count and whether a file below it matches.

    Folder rows are pre-aggregated on the map side, so a folder that holds a
    large share of all files still shuffles as one row per task.
    """
    parts = _segments(F.col("path"))
    depth = F.size(parts) - 1
    prefixes = F.when(
        depth > 0,
        F.transform(F.sequence(F.lit(1), depth), lambda n: F.array_join(F.slice(parts, 1, n), "/")),
    ).otherwise(F.array().cast("array<string>"))
    return (
        risks.select(F.explode(prefixes).alias("folder"), file_matches(query, risk_filter).alias("_hit"))
        .groupBy("folder")
        .agg(F.count(F.lit(1)).alias("files"), F.bool_or("_hit").alias("has_match"))
    )


def listing(risks: DataFrame) -> DataFrame:
    """Children of every folder in display order: folders first, then by lower-case name."""
    parts = _segments(F.col("path"))
    depth = F.size(parts)
    nodes = (
        risks.select(
            F.explode(
                F.transform(
                    F.sequence(F.lit(1), depth),
                    lambda n: F.struct(
                        F.array_join(F.slice(parts, 1, n - 1), "/").alias("parent"),
                        F.element_at(parts, n).alias("name"),
                        (n == depth).alias("is_file"),
                    ),
                )
            ).alias("node")
        )
        .select("node.*")
        .distinct()
    )
    return nodes.orderBy("parent", "is_file", F.lower("name"), "name")
