"""Lines against tables of many rules, through an index of the grams that any hit must hold.

A pattern can only be found in a line that holds some text which the pattern spells out. :func:`needs` reads from a pattern a
set of literals of which every hit holds at least one; of each literal the rarest gram of three characters stands in the
index. A line meets a rule only if it holds one of the rule's grams, and the pattern then decides. Rules that spell out
no three characters in a row meet every line of their language.

How rare a gram is, is counted in the rules themselves and in the lines of at most :data:`SAMPLE_FILES` files. This decides how many
rules a line meets, never what is found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve.functions.text import folded, is_skipped, lines, strip
from codesieve.functions.unnest import unnest
from codesieve.session import materialise

GRAM = 3
#: Files whose lines tell which grams are rare.
SAMPLE_FILES = 500
#: Distinct grams that may be searched for as a constant set; more are found by the join alone.
KNOWN_GRAMS = 20_000
#: Copies of each index row, over which the lines of its language are spread.
SALTS = 16
#: The gram of rules without literals; every line has it.
ANY = ""

_COUNTS = re.compile(r"[?*+]|\{(\d+)(?:,\d*)?\}")
_FLAGS = re.compile(r"\(\?([a-zA-Z]+)(\)|:)")
_OPAQUE = re.compile(r"\(\?(?:[=!>]|<[=!]|<\w+>)")
_ESCAPED = re.compile(r"\\(?:[pP]\{[^}]*\}|x\{[^}]*\}|x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|k<\w+>|[A-Za-z]|\d+)")


class _Unknown(Exception):
    """A construct whose literals are not looked for."""


class _Pattern:
    """The literals of a pattern in the syntax of Java."""

    def __init__(self, pattern: str):
        self.text, self.at = pattern, 0

    def least(self) -> int:
        """The smallest count of the item before, 1 if none is given."""
        found = _COUNTS.match(self.text, self.at)
        if not found:
            return 1
        self.at = found.end()
        if self.text[self.at : self.at + 1] in ("?", "+"):
            self.at += 1
        return int(found[1]) if found[1] else int(found[0] == "+")

    def charset(self) -> None:
        """Pass over a class, nested ones included."""
        self.at += 1
        if self.text[self.at : self.at + 1] == "^":
            self.at += 1
        first = True
        while first or self.text[self.at] != "]":
            if self.text[self.at] == "\\":
                self.at += 1
            elif self.text[self.at] == "[" and not first:
                self.charset()
                continue
            self.at, first = self.at + 1, False
        self.at += 1

    def any_of(self) -> frozenset[str] | None:
        """Literals of which each match of the alternation here holds one; None if there may be none."""
        found: list[frozenset[str] | None] = []
        while True:
            found.append(self.branch())
            if self.text[self.at : self.at + 1] != "|":
                break
            self.at += 1
        return None if any(f is None for f in found) else frozenset().union(*found)

    def branch(self) -> frozenset[str] | None:
        held: list[frozenset[str]] = []
        run = ""
        while self.at < len(self.text) and self.text[self.at] not in "|)":
            char, literal = self.text[self.at], None
            inner: frozenset[str] | None = None
            if char == "(":
                flags = _FLAGS.match(self.text, self.at)
                if flags and "x" in flags[1] or _OPAQUE.match(self.text, self.at):
                    raise _Unknown
                if flags and flags[2] == ")":
                    self.at = flags.end()
                    continue
                self.at = flags.end() if flags else self.at + 1
                if self.text.startswith("?:", self.at):
                    self.at += 2
                inner = self.any_of()
                self.at += 1
            elif char == "[":
                self.charset()
            elif char == "\\":
                escaped = _ESCAPED.match(self.text, self.at)
                if escaped and escaped[0] in ("\\Q", "\\E"):
                    raise _Unknown
                literal = None if escaped else self.text[self.at + 1]
                self.at = escaped.end() if escaped else self.at + 2
            else:
                literal = None if char in ".^$" or not char.isascii() else char
                self.at += 1
            mark = self.at
            least = self.least()
            if literal is not None and least:
                run += literal.lower()
            if literal is None or self.at != mark:
                held, run = [*held, frozenset([run])] if run else held, ""
            if inner and least:
                held.append(inner)
        if run:
            held.append(frozenset([run]))
        # The longest shortest literal, then the fewest.
        return max(held, key=lambda some: (min(map(len, some)), -len(some)), default=None)


def needs(pattern: str) -> frozenset[str] | None:
    """Small-letter literals of which any hit of ``pattern`` holds one, each of a gram's length or more; None if unknown."""
    reader = _Pattern(pattern)
    try:
        found = reader.any_of()
    except (_Unknown, IndexError):
        return None
    if reader.at != len(pattern) or found is None or min(map(len, found)) < GRAM:
        return None
    return found


def line_grams(lowered):
    """All distinct grams of a folded line, and the one that every line has."""
    grams = F.regexp_extract_all(lowered, F.lit(f"(?s)(?=(.{{{GRAM}}}))"), F.lit(1))
    return F.array_distinct(F.concat(F.array(F.lit(ANY)), grams))


def _choices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for rule, language, pattern in zip(batch["rule"], batch["language"], batch["pattern"]):
            for number, literal in enumerate(sorted(needs(pattern or "") or {ANY})):
                grams = {literal[k : k + GRAM] for k in range(len(literal) - GRAM + 1)} or {ANY}
                rows += [(rule, language, number, gram) for gram in sorted(grams)]
        yield pd.DataFrame(rows, columns=["rule", "language", "number", "gram"])


def index(rules: DataFrame, files: DataFrame) -> DataFrame:
    """``rules`` with a row per gram in ``gram``, and all grams of the rule in ``grams``."""
    numbered = rules.withColumn("rule", F.xxhash64("language", "rule_order", "type", "pattern"))
    choices = numbered.select("rule", "language", "pattern").mapInPandas(_choices, "rule long, language string, number int, gram string")
    sample = unnest(files.limit(SAMPLE_FILES), ("language",), lines(F.col("code")), "text")
    held = sample.select("language", F.explode(line_grams(folded(F.col("text")))).alias("gram"))
    common = held.groupBy("language", "gram").agg(F.count("*").alias("seen"))
    asked = choices.groupBy("language", "gram").agg(F.countDistinct("rule").alias("asked"))
    rated = choices.join(asked, ["language", "gram"]).join(common, ["language", "gram"], "left")
    # Both kinds of cost: lines that hold the gram, and rules that each of them then meets.
    cost = (F.coalesce("seen", F.lit(0)) + 1) * F.col("asked")
    rarest = rated.groupBy("rule", "number").agg(F.min_by("gram", F.struct(cost, F.col("gram"))).alias("gram"))
    grams = rarest.groupBy("rule").agg(F.sort_array(F.collect_set("gram")).alias("grams"))
    return numbered.join(grams, "rule").drop("rule").withColumn("gram", F.explode("grams"))


def candidates(files: DataFrame, rules: DataFrame, keep: tuple[str, ...] = ("file_id",), salts: int = SALTS) -> DataFrame:
    """Lines beside the rules whose grams they hold: ``keep``, ``language``, ``text``, ``at``, and the rule's columns.

    A line meets a rule once, at the first of the rule's grams that it holds. A few languages hold most lines; lines
    therefore carry a salt, and index rows are repeated for each.
    """
    table = materialise(index(rules, files), "rule-index")
    known = [row.gram for row in table.select("gram").distinct().limit(KNOWN_GRAMS + 1).collect()]
    split = unnest(files, (*keep, "language"), lines(F.col("code")), "text", "at")
    live = split.where(~is_skipped(F.col("text"))).withColumn("salt", F.pmod(F.xxhash64(*keep, "at"), F.lit(salts)))
    held = line_grams(F.col("lowered"))
    if len(known) <= KNOWN_GRAMS:
        held = F.filter(held, lambda gram: gram.isin(known))
    live = live.withColumn("lowered", folded(F.col("text"))).withColumn("held", held).drop("lowered")
    spread = table.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    met = live.withColumn("gram", F.explode("held")).join(spread, ["language", "gram", "salt"])
    return met.where(F.col("gram") == F.array_min(F.array_intersect("grams", "held")))


def join_rules(files: DataFrame, rules: DataFrame, keep: tuple[str, ...] = ("file_id",), snippet: int = 80, salts: int = SALTS) -> DataFrame:
    """Lines of ``files`` (``keep``, ``language``, ``code``) in which a pattern of their language's ``rules`` is found.

    ``rules`` has ``language, rule_order, type, severity, pattern``; a rule that is there twice is found twice. Reads a few
    rows of both tables when it is called.
    """
    matched = candidates(files, rules, keep, salts).where(F.rlike("text", F.col("pattern")))
    return matched.select(
        *keep,
        (F.col("at") + 1).alias("line"),
        "rule_order",
        "type",
        "severity",
        F.substring(strip(F.col("text")), 1, snippet).alias("snippet"),
    )
