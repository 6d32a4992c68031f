"""Scores, verdicts, reports and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weight of a severity, and the limits a score must exceed for a verdict.
SEVERITY_WEIGHT = {"CRITICAL": 1.0, "HIGH": 0.8, "MEDIUM": 0.5, "LOW": 0.2}
VERDICT_ABOVE = (("CRITICAL", 0.8), ("HIGH", 0.6), ("MEDIUM", 0.4))
VERDICTS = ("CRITICAL", "HIGH", "MEDIUM", "SAFE")

# Points of the additive variant and its limits.
SEVERITY_POINTS = {"CRITICAL": 3, "HIGH": 2}
OTHER_POINTS = 1
ADDITIVE_ABOVE = (("CRITICAL", 8), ("HIGH", 5), ("MEDIUM", 3))

# What blocks a change.
BLOCKING_VERDICT = "CRITICAL"
BLOCKING_SCORE = 0.7


def severity_weight(severity: Column) -> Column:
    out = F.lit(0.0)
    for name, weight in SEVERITY_WEIGHT.items():
        out = F.when(severity == name, F.lit(weight)).otherwise(out)
    return out


def max_weight(findings: Column) -> Column:
    """Highest severity weight in an array of findings, 0 for an empty one."""
    weights = F.transform(findings, lambda hit: severity_weight(hit["severity"]))
    return F.coalesce(F.array_max(weights), F.lit(0.0))


def _above(score: Column, limits, rest: str) -> Column:
    out = F.lit(rest)
    for name, limit in reversed(limits):
        out = F.when(score > limit, F.lit(name)).otherwise(out)
    return out


def hybrid_score(probability: Column, weight: Column) -> Column:
    return F.greatest(F.coalesce(probability, F.lit(0.0)), weight)


def verdict(score: Column) -> Column:
    """Verdict of an unrounded score; every limit must be exceeded."""
    return _above(score, VERDICT_ABOVE, "SAFE")


def additive_points(severity: Column) -> Column:
    out = F.lit(OTHER_POINTS)
    for name, points in SEVERITY_POINTS.items():
        out = F.when(severity == name, F.lit(points)).otherwise(out)
    return out


def additive_verdict(score: Column) -> Column:
    return _above(score, ADDITIVE_ABOVE, "LOW")


def with_verdict(files: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Report rows from files with ``findings`` and ``ml_prob``: verdict first, rounding after."""
    scored = files.withColumn("raw_score", hybrid_score(F.col("ml_prob"), max_weight(F.col("findings"))))
    return scored.select(
        *keep,
        verdict(F.col("raw_score")).alias("verdict"),
        F.round("raw_score", 4).alias("score"),
        F.round(F.coalesce("ml_prob", F.lit(0.0)), 4).alias("ml_prob"),
        "findings",
    )


def gate(report: DataFrame) -> DataFrame:
    """Blocked files: verdict CRITICAL, or a rounded score of 0.7 and more."""
    blocked = (F.col("verdict") == BLOCKING_VERDICT) | (F.col("score") >= BLOCKING_SCORE)
    return report.where(blocked).select(F.col("path").alias("file"), "verdict", "score")


def summary_line(file: Column, verdict_: Column, score: Column) -> Column:
    return F.format_string("- `%s` → **%s** (%.1f%%)", file, verdict_, score * 100)


def filter_report(
    report: DataFrame, severity: str = "all", language: str = "all", search: str = ""
) -> DataFrame:
    """Rows of one verdict, language and part of a path; ``all`` or '' leaves a test out."""
    out = report
    if severity != "all":
        out = out.where(F.col("verdict") == severity)
    if language != "all":
        out = out.where(F.col("language") == language)
    if search:
        out = out.where(F.contains(F.lower("path"), F.lit(search.lower())))
    return out


def verdict_totals(report: DataFrame) -> DataFrame:
    """One row: number of files and of each verdict."""
    return report.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("verdict") == name).alias(name.lower()) for name in VERDICTS],
    )
