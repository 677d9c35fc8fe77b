"""Risk bands: four scales, each a CASE expression over a score column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values: (high edge, medium edge, high name, medium name, low name).
BANDS = {
    "analysis": (0.5, 0.3, "HIGH", "MED", "LOW"),
    "review": (0.67, 0.33, "HIGH", "MEDIUM", "LOW"),
    "heatmap": (0.7, 0.4, "High Risk", "Medium Risk", "Low Risk"),
    "dashboard": (0.67, 0.33, "High", "Medium", "Low"),
}
DASHBOARD_TOP = 1.0


def band(score: Column, scale: str = "analysis") -> Column:
    """Name of the band a score falls in.

    The ``dashboard`` scale is closed on the right: a score of 0 or above 1 is
    in no band. The others are closed on the left.
    """
    high, medium, high_name, medium_name, low_name = BANDS[scale]
    if scale == "dashboard":
        return (
            F.when((score > high) & (score <= DASHBOARD_TOP), high_name)
            .when((score > medium) & (score <= high), medium_name)
            .when((score > 0) & (score <= medium), low_name)
        )
    return (
        F.when(score >= high, high_name)
        .when(score >= medium, medium_name)
        .when(score.isNotNull(), low_name)
    )


def band_names(scale: str) -> list[str]:
    return list(BANDS[scale][2:])
