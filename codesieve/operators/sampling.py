"""Blocks, samples, splits, scaling and class weights."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesieve.operators.ranking import hash_cut, row_hash, small_side, with_row_number

# Rows per block, rows drawn per block and in the end, copies of a chosen row.
BLOCK_ROWS = 10_000
PER_BLOCK = 100
IN_ALL = 100
COPIES = 20


def with_block(df: DataFrame, key: str, rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``block``: which run of ``rows`` input rows a row belongs to, in the order of its key."""
    numbered = with_row_number(df, key, "_position")
    return numbered.withColumn("block", F.floor((F.col("_position") - 1) / rows)).drop("_position")


def block_sample(
    df: DataFrame, key: str, rows: int = BLOCK_ROWS, per_block: int = PER_BLOCK, in_all: int = IN_ALL, seed: str = "42"
) -> DataFrame:
    """``per_block`` drawn rows of every block, then ``in_all`` drawn from those.

    Only keys are numbered and ordered; the chosen rows are fetched from the table at the end.
    """
    keys = with_block(df.select(key), key, rows).withColumn("_hash", row_hash(key, seed))
    rank = F.row_number().over(Window.partitionBy("block").orderBy("_hash"))
    drawn = keys.withColumn("_rank", rank).where(F.col("_rank") <= per_block)
    chosen = drawn.orderBy(row_hash(key, seed + "b")).limit(in_all).select(key)
    return df.join(F.broadcast(chosen), key, "left_semi")


def oversample(df: DataFrame, copies: int = COPIES) -> DataFrame:
    """Every row ``copies`` times, numbered in ``copy``."""
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))


def oversample_counted(df: DataFrame, chosen: Column, copies: int = COPIES) -> DataFrame:
    """The table that :func:`oversample` makes of the ``chosen`` rows beside the others, with one row for all copies of a
    row: add ``copies``, how many rows it stands for."""
    return df.withColumn("copies", F.when(chosen, F.lit(copies)).otherwise(F.lit(1)).cast("long"))


def split(df: DataFrame, key: str, share: float, by: Sequence[str] = (), seed: str = "42") -> DataFrame:
    """Add ``is_test``: exactly ``ceil(share · n)`` rows of every group in ``by``, drawn by hash.

    The table itself is not shuffled: the cut of each group, one row per label, is joined to it.
    """
    need = F.ceil(F.lit(share) * F.col("n"))
    cuts = hash_cut(df, key, by, need, seed)
    if by:
        marked = df.join(small_side(cuts), list(by), "left")
        return marked.withColumn("is_test", F.coalesce(row_hash(key, seed) <= F.col("cut"), F.lit(False))).drop("cut")
    row = cuts.first()
    return df.withColumn("is_test", row_hash(key, seed) <= F.lit(row.cut if row else ""))


@dataclass(frozen=True)
class Scaler:
    """Column means and population deviations, learned by :func:`fit_scaler`."""

    mean: dict[str, float]
    deviation: dict[str, float]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        # A constant column keeps its distance from the mean, as if its deviation were 1.
        return df.withColumns(
            {
                name + suffix: (F.col(name).cast("double") - self.mean[name]) / (self.deviation[name] or 1.0)
                for name in self.mean
            }
        )


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> Scaler:
    """Learn means and deviations in one aggregate; only those numbers reach the driver."""
    parts = [f(F.col(c).cast("double")).alias(f"{f.__name__}_{c}") for c in columns for f in (F.avg, F.stddev_pop)]
    row = train.agg(*parts).first()
    return Scaler({c: row[f"avg_{c}"] for c in columns}, {c: row[f"stddev_pop_{c}"] for c in columns})


def with_class_weight(df: DataFrame, label: str, copies: str | None = None) -> DataFrame:
    """Add ``weight`` = n / (classes · rows of the class), from one row per class.

    With ``copies``, a row counts as so many, and its weight is that of all of them together.
    """
    counts = df.groupBy(label).agg((F.sum(copies) if copies else F.count("*")).alias("_rows"))
    everything = Window.partitionBy()
    weight = F.sum("_rows").over(everything) / (F.count("*").over(everything) * F.col("_rows"))
    weights = counts.withColumn("weight", weight).drop("_rows")
    weighted = df.join(small_side(weights), label)
    return weighted.withColumn("weight", F.col("weight") * F.col(copies)) if copies else weighted
