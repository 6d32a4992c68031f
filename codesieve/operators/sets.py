"""Unions, duplicates, label conflicts, pairs and lists of paths."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.functions import languages
from codesieve.functions.text import strip


def union_all(*tables: DataFrame) -> DataFrame:
    """All rows of tables whose columns may differ; what a table lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


#: Decimal digits of a whole number of 64 bits.
DIGITS = 19


def packed_order(order: Sequence[str | Column]) -> Column:
    """One or two whole-number columns as one number of the same order; nulls come first."""
    first, *rest = [F.coalesce(F.col(o) if isinstance(o, str) else o, F.lit(-(2**63))) for o in order]
    wide = first.cast("decimal(19,0)")
    if not rest:
        return wide
    (second,) = rest
    return (wide * F.lit(str(10**DIGITS)).cast("decimal(20,0)") + second.cast("decimal(20,0)")).cast("decimal(38,0)")


def dedupe_first(
    df: DataFrame, order: Sequence[str | Column], text: str = "code", keep: Sequence[str] | None = None
) -> DataFrame:
    """Keep, of rows with equal text, the one that is first in ``order`` (one or two whole numbers).

    ``order`` must tell all rows apart. Only SHA-256 digests and packed order numbers are grouped, in a hash aggregate
    that is reduced inside each task, so a text that fills a third of the table is no hot spot. The rows themselves are
    fetched by their number; with ``keep``, only those columns are, and a text that is not among them never moves.
    """
    number = packed_order(order)
    first = df.groupBy(F.sha2(F.col(text), 256).alias("_key")).agg(F.min(number).alias("_first"))
    columns = [F.col(c) for c in (keep or df.columns)]
    return df.select(*columns, number.alias("_number")).join(
        first.select("_first"), F.col("_number") == F.col("_first"), "left_semi"
    ).drop("_number")


def label_conflicts(df: DataFrame, text: str = "code", label: str = "target") -> DataFrame:
    """Texts that occur under both labels, with the number of rows of each."""
    key = F.md5(F.col(text)).alias("text_md5")
    counted = df.where(F.col(text).isNotNull()).groupBy(key).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col(label) == 1).alias("n_vulnerable"),
        F.count_if(F.col(label) == 0).alias("n_safe"),
    )
    return counted.where("n_vulnerable > 0 AND n_safe > 0")


def pairs_to_rows(pairs: DataFrame, keep: Sequence[str] = ("pair_id",)) -> DataFrame:
    """(vulnerable, fixed) -> two rows with target 1 and 0; rows without a text are dropped."""
    both = F.array(
        F.struct(F.col("vulnerable_code").alias("code"), F.lit(1).alias("target")),
        F.struct(F.col("fixed_code").alias("code"), F.lit(0).alias("target")),
    )
    return pairs.select(*keep, F.explode(both).alias("side")).select(*keep, "side.*").where("code IS NOT NULL")


def pairs_by_language(pairs: DataFrame, keep: Sequence[str] = ("pair_id",)) -> DataFrame:
    """As :func:`pairs_to_rows`, with the language read off the vulnerable text and used for both."""
    guessed = pairs.withColumn("language", languages.from_text(F.col("vulnerable_code")))
    return pairs_to_rows(guessed.where("language != 'unknown'"), (*keep, "language"))


def listed_paths(raw: DataFrame, line: str = "value") -> DataFrame:
    """Distinct non-empty paths of a list, blanks cut."""
    return raw.select(strip(F.col(line)).alias("path")).where("path != ''").distinct()


def only_listed(files: DataFrame, paths: DataFrame) -> DataFrame:
    return files.join(paths, "path", "left_semi")


def absent_paths(paths: DataFrame, files: DataFrame) -> DataFrame:
    return paths.join(files.select("path"), "path", "left_anti")


def python_records(df: DataFrame) -> DataFrame | None:
    """Python rows by ``programming_language``, else by ``file_name``; None when neither decides, or
    when no column holds code."""
    if "programming_language" in df.columns:
        rows = df.where(F.lower("programming_language") == "python")
    elif "file_name" in df.columns:
        rows = df.where(F.endswith(F.col("file_name"), F.lit(".py")))
    else:
        return None
    has_code = {"func_before", "func_after", "code_before", "code_after"} & set(df.columns)
    return rows if has_code else None


def code_columns(df: DataFrame, words: Sequence[str] = ("code", "file")) -> list[str]:
    """Names of columns that hint at code."""
    return [name for name in df.columns if any(word in name.lower() for word in words)]
