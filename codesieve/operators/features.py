"""Feature tables of Python texts: 9, 10 and 49 numeric columns, one row per parsable text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.functions.text import with_line_metrics, with_token_stats
from codesieve.operators import facts, heuristics, rules
from codesieve.operators.aggregates import FINDING_KINDS, SEVERITIES

FEATURES_9 = (
    "loc",
    "comments",
    "functions",
    "classes",
    "imports",
    "ast_nodes",
    "control_structures",
    "cyclomatic_complexity",
    "maintainability_index",
)
FEATURES_10 = (*FEATURES_9, "size_bytes")
FEATURES_49 = (
    *FEATURES_10,
    "code_lines",
    "blank_lines",
    "avg_line_length",
    "ast_depth",
    "total_tokens",
    "unique_tokens",
    "token_diversity",
    "tainted_vars_count",
    "has_tainted_vars",
    *(f"vuln_{name.lower()}_count" for name in SEVERITIES),
    "total_vulnerabilities",
    "has_vulnerabilities",
    *(f"vuln_{name}" for name in FINDING_KINDS),
    *rules.DANGER_FLAGS,
    *rules.SANITISE_FLAGS,
)


def _structure(files: DataFrame, with_docstrings: bool, **more: Column) -> DataFrame:
    """Parsable texts with the features that come from syntax facts, and ``more`` columns.

    Facts are wide, so all that needs them is computed in one step, after which they are left behind.
    """
    parsed = facts.with_facts(files.where("code IS NOT NULL")).where("parse_ok")
    columns = {
        **facts.node_counts(),
        "cyclomatic_complexity": facts.cyclomatic(),
        "maintainability_index": facts.maintainability(with_docstrings),
        **more,
    }
    return parsed.select(*files.columns, *[column.alias(name) for name, column in columns.items()])


def structural(files: DataFrame, keep: tuple[str, ...], names: tuple[str, ...] = FEATURES_10) -> DataFrame:
    """The columns ``names`` of 9 or 10 features; texts that do not parse are dropped."""
    known = _structure(files.select(*keep, "code"), with_docstrings=False)
    return with_line_metrics(known).select(*keep, *names)


def full(files: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """All 49 features, in one pass over each text and without a shuffle."""
    known = _structure(
        files.select(*keep, "code"),
        with_docstrings=True,
        ast_depth=facts.depth(),
        tainted=facts.tainted(),
        calls=F.col("calls"),
        parse_ok=F.col("parse_ok"),
    )
    judged = heuristics.with_heuristics(known)
    severities, kinds = F.col("heuristics.severity"), F.col("heuristics.name")

    def equal(values: Column, wanted: str) -> Column:
        return F.size(F.filter(values, lambda v: v == wanted))

    counted = judged.withColumns(
        {
            "tainted_vars_count": F.size("tainted"),
            "has_tainted_vars": (F.size("tainted") > 0).cast("int"),
            **{f"vuln_{name.lower()}_count": equal(severities, name) for name in SEVERITIES},
            "total_vulnerabilities": F.size("heuristics"),
            "has_vulnerabilities": (F.size("heuristics") > 0).cast("int"),
            **{f"vuln_{name}": equal(kinds, name) for name in FINDING_KINDS},
        }
    )
    measured = with_token_stats(with_line_metrics(counted))
    flagged = rules.with_flags(measured, {**rules.DANGER_FLAGS, **rules.SANITISE_FLAGS})
    return flagged.select(*keep, *FEATURES_49)
