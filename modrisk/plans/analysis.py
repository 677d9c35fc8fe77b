"""Corpus analysis: source files to file risks, summary and exports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from modrisk.functions.scores import approximate_measures
from modrisk.operators import models, reports, review, risk
from modrisk.operators.code_metrics import analysis_metrics
from modrisk.operators.line_rules import DEFAULT_SEALS


@dataclass
class Analysis:
    files: DataFrame
    risks: DataFrame
    summary: DataFrame


def analyse(files: DataFrame, seals=DEFAULT_SEALS, preprocessor=None, model=None) -> Analysis:
    """Risk of every file and the workspace summary.

    With a fitted preprocessor and model, approximate measures of each file are
    scored and blended with the rule score.
    """
    model_scores = None
    if preprocessor is not None and model is not None:
        measures = approximate_measures(analysis_metrics(files)).drop("content", "fname", "ext", "lang")
        ready = preprocessor.transform_new(measures, "path")
        model_scores = models.new_scores(model, ready, "path")
    risks = risk.file_risk(files, model_scores=model_scores, seals=seals)
    return Analysis(files, risks, risk.workspace_summary(risks))


def export(analysis: Analysis, folder: str, generated: str) -> None:
    """CSV, text and JSON exports; the risks are computed once."""
    risks = analysis.risks.persist()
    summary = risk.workspace_summary(risks)
    reports.write_risk_csv(risks, f"{folder}/csv")
    reports.write_text_report(risks, summary, generated, f"{folder}/text")
    reports.write_json(risks, summary, f"{folder}/json")
    risks.unpersist()
