"""Findings on user input that reaches dangerous calls, from syntax facts and whole texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.functions.text import folded
from codesieve.functions.unnest import unnest_structs
from codesieve.operators import facts
from codesieve.operators.rules import text_findings

# Sinks.
SQL_SINKS = ("execute", "executemany")
OS_CALLS_ESCAPED = (r"os\.system", r"os\.popen", r"subprocess\.Popen", r"subprocess\.call", r"subprocess\.run")
OS_CALLS_PLAIN = ("os.system", "os.popen", "subprocess.Popen", "subprocess.call", "subprocess.run")
PATH_SINKS = ("open", "os.remove", "os.rmdir", "os.unlink")

# What findings say; pairs stand before and behind a name.
SQL_NAME = ("Variable '", "' controlada por usuario usada en SQL execution.")
SQL_JOINED = "Concatenación peligrosa detectada dentro de execute()"
SQL_FORMATTED = "F-string peligrosa en ejecución SQL"
OS_CALL = ("Llamada peligrosa: ", " recibe datos del usuario")
PATH_CALL = ("Llamada a ", " con path controlado por usuario")
UNPARSABLE = "No se pudo analizar el AST"

HIT = "array<struct<name:string,severity:string,detail:string>>"


def _hit(name: str, severity: str, detail: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), F.lit(severity).alias("severity"), detail.alias("detail"))


def _said(around: tuple[str, str], name: Column) -> Column:
    return F.concat(F.lit(around[0]), name, F.lit(around[1]))


def _holds(text: Column, parts: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, [F.contains(text, F.lit(part)) for part in parts])


def _reached(arg: Column) -> Column:
    """Does the expression hold a tainted name?"""
    return F.arrays_overlap(arg["names"], F.col("tainted"))


def _some(values: Column) -> Column:
    return F.filter(values, F.isnotnull)


def sql_injection() -> Column:
    """``.execute`` with a tainted name, or an operation or f-string that holds one, as first argument."""

    def judge(call: Column) -> Column:
        first = F.get(call["args"], F.lit(0))
        named = _said(SQL_NAME, first["name"])
        return (
            F.when(~F.coalesce(call["attr"].isin(*SQL_SINKS) & _reached(first), F.lit(False)), None)
            .when(first["kind"] == "Name", _hit("sql_injection", "CRITICAL", named))
            .when(
                first["kind"] == "BinOp",
                _hit("sql_injection", "CRITICAL", F.lit(SQL_JOINED)),
            )
            .when(
                first["kind"] == "JoinedStr",
                _hit("sql_injection", "CRITICAL", F.lit(SQL_FORMATTED)),
            )
        )

    return _some(F.transform("calls", judge))


def command_injection(match: str = "literal") -> Column:
    """A tainted argument of an operating-system call, one finding per argument.

    ``literal`` looks for the sinks as they are spelled, with backslashes, and so finds none in real
    code; ``intended`` looks for the calls that were meant.
    """
    sinks = {"literal": OS_CALLS_ESCAPED, "intended": OS_CALLS_PLAIN}[match]

    def judge(call: Column) -> Column:
        detail = _said(OS_CALL, call["func"])
        reached = F.filter(call["args"], _reached)
        found = F.transform(reached, lambda _: _hit("command_injection", "CRITICAL", detail))
        return F.when(_holds(call["func"], sinks), found).otherwise(F.array().cast(HIT))

    return F.flatten(F.transform("calls", judge))


def path_traversal() -> Column:
    """A call whose text holds a file function and whose first argument is tainted."""

    def judge(call: Column) -> Column:
        detail = _said(PATH_CALL, call["func"])
        first = F.get(call["args"], F.lit(0))
        hit = _holds(call["func"], PATH_SINKS) & F.coalesce(_reached(first), F.lit(False))
        return F.when(hit, _hit("path_traversal", "HIGH", detail))

    return _some(F.transform("calls", judge))


def with_taint(files: DataFrame) -> DataFrame:
    return files.withColumn("tainted", facts.tainted())


def with_heuristics(files: DataFrame, match: str = "literal") -> DataFrame:
    """Add ``heuristics``: all findings in their fixed order; an unparsable text has one of its own."""
    text = text_findings(F.col("code"), F.col("_lowered"))
    broken = F.array(_hit("syntax_error", "LOW", F.lit(UNPARSABLE)))
    found = F.concat(
        text["secrets"], text["debug"], text["xss"], sql_injection(), command_injection(match), path_traversal()
    )
    lowered = files.withColumn("_lowered", folded(F.col("code")))
    return lowered.withColumn("heuristics", F.when(F.col("parse_ok"), found).otherwise(broken)).drop("_lowered")


def findings_rows(files: DataFrame, column: Column, keep: tuple[str, ...] = ("file_id",)) -> DataFrame:
    """One row per finding of an array column, with its position."""
    return unnest_structs(files, keep, column, "seq")
