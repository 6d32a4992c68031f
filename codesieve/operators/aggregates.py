"""Counts and profiles of datasets and reports. All pre-aggregate before their shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.operators.scoring import VERDICTS, max_weight
from codesieve.operators.sets import code_columns

# Kinds of whole-text and syntax findings that are counted per file.
FINDING_KINDS = (
    "sql_injection",
    "command_injection",
    "path_traversal",
    "hardcoded_secret",
    "debug_mode_enabled",
    "xss_reflected",
)
SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
TOP_LANGUAGES = 10


def label_counts(df: DataFrame, label: str = "target") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def top_languages(df: DataFrame, limit: int = TOP_LANGUAGES) -> DataFrame:
    counted = df.where("language IS NOT NULL").groupBy("language").agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), "language").limit(limit)


def python_total(df: DataFrame, column: str = "programming_language") -> DataFrame:
    """One row: rows named ``Python`` or ``python``, 0 when there are none."""
    return df.agg(F.count_if(F.col(column).isin("Python", "python")).alias("python_total"))


def vulnerable_and_safe(df: DataFrame) -> DataFrame:
    counted = df.groupBy("language").agg(F.sum("target").cast("bigint").alias("vulnerable"), F.count("*").alias("n"))
    return counted.select("language", "n", "vulnerable", (F.col("n") - F.col("vulnerable")).alias("safe"))


def distinct_labels(df: DataFrame, label: str = "safety") -> DataFrame:
    return df.select(label).distinct()


def profile(df: DataFrame, language: str = "language") -> DataFrame:
    """Number of rows, in all (``part`` is ``all``) and per language (``part`` is ``language``), with the names of all
    columns and of those that hint at code. A row per language: their number has no bound."""
    counted = df.rollup(language).agg(F.count("*").alias("n"), F.grouping(language).alias("over_all"))
    return counted.where((F.col("over_all") == 1) | F.col(language).isNotNull()).select(
        F.when(F.col("over_all") == 1, "all").otherwise("language").alias("part"),
        F.col(language).alias("language"),
        "n",
        F.array(*map(F.lit, df.columns)).alias("columns"),
        F.array(*map(F.lit, code_columns(df))).cast("array<string>").alias("code_columns"),
    )


def filled_code_columns(df: DataFrame) -> DataFrame:
    """Columns whose name hints at code, with the number of rows that fill them."""
    names = code_columns(df)
    counted = df.agg(*[F.count(name).alias(name) for name in names])
    rows = [F.struct(F.lit(name).alias("name"), F.col(name).alias("n")) for name in names]
    return counted.select(F.inline(F.array(*rows)))


def _count_equal(values: Column, wanted: str) -> Column:
    return F.size(F.filter(values, lambda value: value == wanted))


def severity_counts(report: DataFrame, keep: tuple[str, ...] = ("file_id",)) -> DataFrame:
    """Findings per file and severity, in all, and a 0/1 flag. Counted inside the row."""
    severity = F.col("findings.severity")
    each = [
        _count_equal(severity, name).alias(f"{name.lower()}_count") for name in SEVERITIES
    ]
    total = F.size("findings")
    return report.select(*keep, *each, total.alias("total"), (total > 0).cast("int").alias("has_any"))


def kind_counts(report: DataFrame, kinds: tuple[str, ...], keep: tuple[str, ...] = ("file_id",)) -> DataFrame:
    """Findings per file for fixed kinds, 0 where there is none."""
    found = F.col("findings.type")
    each = [_count_equal(found, name).alias(f"n_{name}") for name in kinds]
    return report.select(*keep, *each)


def max_severity(report: DataFrame, keep: tuple[str, ...] = ("file_id",)) -> DataFrame:
    return report.select(*keep, max_weight(F.col("findings")).alias("max_severity"))


def findings_per_file(report: DataFrame, keep: tuple[str, ...] = ("file_id",)) -> DataFrame:
    return report.select(*keep, F.size("findings").alias("findings_count"))


def verdict_counts(report: DataFrame) -> DataFrame:
    """Rows per verdict, those without any included."""
    totals = report.agg(*[F.count_if(F.col("verdict") == name).alias(name) for name in VERDICTS])
    rows = [F.struct(F.lit(name).alias("verdict"), F.col(name).alias("n")) for name in VERDICTS]
    return totals.select(F.inline(F.array(*rows)))


def files_per_language(report: DataFrame) -> DataFrame:
    return report.groupBy("language").agg(F.count("*").alias("n"))


def correlation(df: DataFrame, left: str, right: str) -> DataFrame:
    return df.agg(F.corr(F.col(left).cast("double"), F.col(right).cast("double")).alias("correlation"))


def parse_failures(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.count_if("parse_ok").alias("parsed"), F.count_if(~F.col("parse_ok")).alias("failed")
    )
