"""Training rows from marked source files: comments say which lines are vulnerable and which safe."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.functions.text import before_slashes, lines, strip
from codesieve.functions.unnest import unnest
from codesieve.operators.sets import dedupe_first

# Marks in comments, and the file types that are searched.
NEXT_LINE_VULNERABLE = "ruleid:"
NEXT_LINE_SAFE = "ok:"
INLINE_VULNERABLE = ("// bad", "// not ok", "// unsafe", "// flaw")
INLINE_SAFE = ("// good", "// ok", "// safe", "// fixed")
SCRIPT_ENDINGS = (".js", ".ts", ".jsx", ".tsx")
SOURCE_NEXT_LINE = "semgrep_real"
SOURCE_INLINE = "codeql"
MIN_LENGTH = 10


def script_files(files: DataFrame, folders: tuple[str, ...] = ("",)) -> DataFrame:
    """Script files below one of the folders."""
    below = reduce(Column.__or__, [F.startswith(F.col("path"), F.lit(folder)) for folder in folders])
    ending = reduce(Column.__or__, [F.endswith(F.col("path"), F.lit(end)) for end in SCRIPT_ENDINGS])
    return files.where(below & ending)


def _has(text: Column, marks: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, [F.contains(text, F.lit(mark)) for mark in marks])


def from_next_line(files: DataFrame, keep: tuple[str, ...] = ("file_id",)) -> DataFrame:
    """Rows for ``ruleid:`` (1) and ``ok:`` (0) marks: the code ahead of the comment if it is longer
    than five characters, else the next line. Both marks may fire on one line."""
    # Each line is paired with its successor inside the row, so no ordering shuffle is needed.
    paired = files.withColumn("_lines", lines(F.col("code"))).select(
        *keep,
        F.posexplode_outer(
            F.arrays_zip(F.col("_lines").alias("text"), F.slice("_lines", F.lit(2), F.size("_lines")).alias("after"))
        ).alias("_at", "_pair"),
    )
    marked = paired.select(*keep, (F.col("_at") + 1).alias("line_no"), "_pair.text", "_pair.after").where(
        _has(F.col("text"), (NEXT_LINE_VULNERABLE, NEXT_LINE_SAFE))
    )
    ahead, after = before_slashes(F.col("text")), strip(F.col("after"))
    usable = (after != "") & ~after.startswith("//")
    code = F.when(F.length(ahead) > 5, ahead).when(usable, after)
    targets = F.array(
        F.when(F.contains("text", F.lit(NEXT_LINE_VULNERABLE)), 1),
        F.when(F.contains("text", F.lit(NEXT_LINE_SAFE)), 0),
    )
    rows = marked.select(*keep, "line_no", code.alias("code"), F.explode(targets).alias("target"))
    return rows.where("target IS NOT NULL AND code IS NOT NULL").withColumn("source", F.lit(SOURCE_NEXT_LINE))


def from_inline_marks(files: DataFrame, keep: tuple[str, ...] = ("file_id",)) -> DataFrame:
    """Rows for ``// bad`` and ``// good`` style marks behind code; ``vulnerable`` wins."""
    split = unnest(files, keep, lines(F.col("code")), "text", "_at")
    likely = split.where(F.contains("text", F.lit("//"))).withColumn("bare", strip(F.col("text")))
    pure = _starts(F.col("bare"), ("*", "//", "/*")) | (F.length("bare") < 5)
    lowered = F.lower("text")
    target = F.when(_has(lowered, INLINE_VULNERABLE), 1).when(_has(lowered, INLINE_SAFE), 0)
    rows = likely.where(~pure).select(
        *keep,
        (F.col("_at") + 1).alias("line_no"),
        before_slashes(F.col("text")).alias("code"),
        target.alias("target"),
    )
    return rows.where("target IS NOT NULL AND code != ''").withColumn("source", F.lit(SOURCE_INLINE))


def _starts(text: Column, marks: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, [F.startswith(text, F.lit(mark)) for mark in marks])


def finish(rows: DataFrame) -> DataFrame:
    """First row of each text, then only texts longer than ten characters."""
    # The vulnerable mark is read first on a line, so target 1 comes ahead of 0.
    place = F.col("line_no") * 2 + 1 - F.col("target")
    return dedupe_first(rows, ["file_id", place]).where(F.length("code") > MIN_LENGTH)
