"""The scan of source files: route by extension, apply rules, add a probability, give a verdict."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.functions import languages, text
from codesieve.functions.unnest import unnest_structs
from codesieve.operators import flat_forest, rules, scoring, vectors
from codesieve.operators.flat_forest import FlatTextModel

#: Columns that identify a file in a report.
REPORT_KEY = ("file_id", "path", "language")


def route(files: DataFrame, unmapped: str = "keep") -> DataFrame:
    """Set ``language`` from the extension; files without one stay with null, or go (``skip``)."""
    routed = files.withColumn("language", languages.from_path(F.col("path")))
    if unmapped == "skip":
        return routed.where("language IS NOT NULL")
    if unmapped == "keep":
        return routed
    raise ValueError(f"unknown policy {unmapped!r}")


def scan(files: DataFrame, probability: Column | None = None, unmapped: str = "keep") -> DataFrame:
    """One report row per file: language, verdict, score, probability and findings.

    A narrow job from end to end: the text is read once, where it lies, and never shuffled.
    """
    prob = F.lit(0.0) if probability is None else probability
    found = rules.with_language_findings(route(files, unmapped)).withColumn("ml_prob", prob)
    return scoring.with_verdict(found, REPORT_KEY)


def findings_table(report: DataFrame, keep: tuple[str, ...] = REPORT_KEY) -> DataFrame:
    """One row per finding of a report."""
    return unnest_structs(report, keep, "findings")


#: A model of this name stands in for a missing Python model.
GENERIC_MODEL = "hybrid"


def model_of(language: Column, available: Iterable[str]) -> Column:
    """Name of the model for a language, the generic one for Python without its own, else null."""
    names = set(available)
    out = F.lit(None).cast("string")
    for name in sorted(names - {GENERIC_MODEL}):
        out = F.when(language == name, F.lit(name)).otherwise(out)
    if "python" not in names and GENERIC_MODEL in names:
        out = F.when(language == "python", F.lit(GENERIC_MODEL)).otherwise(out)
    return out


def route_models(files: DataFrame, models: dict[str, Column]) -> DataFrame:
    """Add ``model`` and ``ml_prob``: every file by the model of its language, 0.0 without one or without a value.

    ``models`` maps a name to the column that gives its probability; all are part of one pass over the files.
    """
    routed = files.withColumn("model", model_of(F.col("language"), models))
    prob = F.lit(0.0)
    for name, value in sorted(models.items()):
        prob = F.when(F.col("model") == name, value).otherwise(prob)
    return routed.withColumn("ml_prob", F.coalesce(prob, F.lit(0.0)))


def route_text_models(
    files: DataFrame,
    models: dict[str, FlatTextModel],
    words: dict[str, tuple[str, ...]],
    stop: dict[str, tuple[str, ...]],
) -> DataFrame:
    """As :func:`route_models` for stored text models, with the keywords and stop words of each: one pass, one Python step."""
    routed = files.withColumn("model", model_of(F.col("language"), models))
    shaped = vectors.with_routed_input(routed, "model", text.clean_multi(F.col("code")), words, stop)
    scored = shaped.withColumn("ml_prob", flat_forest.score(files, models, "terms", "keywords"))
    return scored.drop("terms", "keywords")
