"""Labels: from safety words, from metrics, or drawn from a key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from codesieve.functions.text import WORD, strip

# Label words. The safe ones are looked for first.
SAFE_WORDS = ("safe", "secure", "0", "false", "no", "clean")
UNSAFE_WORDS = ("unsafe", "vulnerable", "insecure", "1", "true", "yes")

# Limits of the metric-based risk label.
COMPLEXITY_LIMIT = 10
MAINTAINABILITY_LIMIT = 60
NODE_LIMIT = 1000


def binary(safety: Column) -> Column:
    """1 for exactly ``vulnerable``, 0 for all else and for null."""
    return F.when(safety == "vulnerable", 1).otherwise(0)


def normalise(safety: Column, mode: str = "substring") -> Column:
    """0, 1 or null from a free-form safety word.

    ``substring`` finds a word anywhere, so ``unsafe`` holds ``safe`` and gives 0; ``exact`` asks for
    whole words.
    """
    text = strip(F.lower(safety))
    if mode == "substring":
        has = lambda word: F.contains(text, F.lit(word))
    elif mode == "exact":
        edge = WORD.replace("[", "[^", 1)
        has = lambda word: text.rlike(f"(^|{edge}){word}({edge}|$)")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    safe = reduce(Column.__or__, map(has, SAFE_WORDS))
    unsafe = reduce(Column.__or__, map(has, UNSAFE_WORDS))
    return F.when(safe, 0).when(unsafe, 1)


def risk_rule(complexity: Column, maintainability: Column, nodes: Column) -> Column:
    """1 for a file that is complex, hard to maintain or very large."""
    risky = (complexity > COMPLEXITY_LIMIT) | (maintainability < MAINTAINABILITY_LIMIT) | (nodes > NODE_LIMIT)
    return risky.cast("int")


def drawn(key: Column, seed: str = "42") -> Column:
    """0 or 1 by the MD5 of seed and key: random in look, the same on every run."""
    digit = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), key.cast("string"))), 1, 1), 16, 10)
    return (digit.cast("int") % 2).cast("int")
