"""URL filter: host-suffix and path-prefix expressions of each URL, joined with rules on short hash prefixes.

Every URL is expanded into the expressions a rule could be written as: each suffix of its host by whole
labels, with each prefix of its path up to a slash. Rules are keyed by their host and the folder part of
their path. Both sides meet on the first four bytes of the SHA-256 of the expression; the full digest and the
rule's whole path are then confirmed, and of the rules that fit, the longest wins.

Expressions deeper than the deepest rule cannot meet one and are not made; that depth is read from the
rules, so no URL is cut short. The rules go to all executors when the planner finds them small, otherwise
both sides are shuffled by the hash prefix. The verdicts of a URL's expressions are reduced within the task
before they are brought together.

Defined results: a null URL or one without ``://`` has an empty host and path and gets the default verdict;
rows with the same or no id are judged one by one; other columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve.llm.store import let

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULE_SCHEMA = "host string, path string, verdict string"


def parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def folder(path: Column) -> Column:
    """The part of a path up to and with its last slash."""
    return F.regexp_extract(path, r"(?s)^(.*/)?", 0)


def rules_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules of host, path and verdict as a table whose size the planner knows."""
    if not rules:
        return spark.createDataFrame([], RULE_SCHEMA)
    names = ("host", "path", "verdict")
    rows = [F.struct(*[F.lit(value).alias(name) for name, value in zip(names, rule)]) for rule in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def _slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.translate(path, "/", ""))


def expressions(host: Column, path: Column, labels: Column | int, slashes: Column | int) -> Column:
    """Host suffixes of up to ``labels`` labels with path prefixes of up to ``slashes`` slashes, the empty path included."""
    both = F.lit("/")
    suffixes = let(
        F.split(host, r"\."),
        lambda names: F.transform(
            F.sequence(F.lit(1), F.least(F.size(names), F.lit(labels))),
            lambda k: F.array_join(F.slice(names, -k, k), "."),
        ),
    )
    # A prefix with k slashes is the first k pieces, each followed by a slash.
    prefixes = let(
        F.split(path, "/"),
        lambda pieces: F.transform(
            F.sequence(F.lit(0), F.least(F.size(pieces) - 1, F.lit(slashes))),
            lambda k: F.when(k == 0, "").otherwise(F.concat(F.array_join(F.slice(pieces, 1, k), "/"), both)),
        ),
    )
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, F.lit("\n"), p))))


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages`` (``page_id, url``).

    ``rules`` has ``host, path, verdict``. Of rules with one host and path, the blocking one holds. Reads the
    depth of the rules when it is called.
    """
    known = (
        rules.select(
            F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("r_host"),
            F.coalesce("path", F.lit("")).alias("r_path"),
            F.col("verdict").alias("r_verdict"),
        )
        .groupBy("r_host", "r_path")
        .agg(F.max("r_verdict").alias("r_verdict"))
    )
    depth = known.agg(
        F.coalesce(F.max(_labels(F.col("r_host"))), F.lit(1)).alias("labels"),
        F.coalesce(F.max(_slashes(F.col("r_path"))), F.lit(0)).alias("slashes"),
    ).first()
    keyed = known.withColumn("r_digest", _digest(F.concat_ws("\n", "r_host", folder(F.col("r_path"))))).withColumn(
        "short", F.substring("r_digest", 1, 8)
    )
    host, path = parts(F.col("url"))
    urls = pages.select(
        F.monotonically_increasing_id().alias("row"), "page_id", host.alias("host"), path.alias("path")
    )
    spread = urls.withColumn(
        "digest",
        F.explode(
            F.transform(expressions(F.col("host"), F.col("path"), depth["labels"], depth["slashes"]), _digest)
        ),
    ).withColumn("short", F.substring("digest", 1, 8))
    met = spread.join(keyed, "short", "left")
    fits = (F.col("digest") == F.col("r_digest")) & F.startswith(F.col("path"), F.col("r_path"))
    best = F.when(
        fits,
        F.struct(
            F.length("r_host").alias("host_length"),
            F.length("r_path").alias("path_length"),
            F.concat("r_host", "r_path").alias("rule"),
            F.col("r_verdict").alias("verdict"),
        ),
    )
    return (
        met.groupBy("row", "page_id", "host", "path")
        .agg(F.max(best).alias("best"))
        .select(
            "page_id",
            "host",
            "path",
            F.col("best.rule").alias("rule"),
            F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        )
    )
