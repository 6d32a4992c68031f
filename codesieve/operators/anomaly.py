"""Isolation forest: trees are grown in parallel from small samples, rows are scored where they lie."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesieve.operators.ranking import running_by_score
from codesieve.session import materialise

# Trees, rows per tree, share of rows that count as anomalies.
TREES = 100
SAMPLE = 256
CONTAMINATION = 0.1

NODES = "tree int, node int, feature int, threshold double, left int, right int, path double"


def _mean_path(rows: np.ndarray | float) -> np.ndarray:
    """Mean search depth in a random tree of so many rows."""
    n = np.maximum(np.asarray(rows, dtype=float), 1.0)
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))


def _grow(tree: int, values: np.ndarray) -> list[tuple]:
    """Random splits of one sample down to single rows or the depth limit; nodes as rows."""
    draw = np.random.default_rng(tree)
    limit = int(np.ceil(np.log2(max(len(values), 2))))
    nodes, pending = [], [(0, np.arange(len(values)), 0)]
    free = 1
    while pending:
        node, rows, depth = pending.pop()
        low, high = values[rows].min(axis=0), values[rows].max(axis=0)
        open_columns = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(open_columns):
            nodes.append((tree, node, -1, 0.0, -1, -1, depth + float(_mean_path(len(rows)))))
            continue
        column = int(draw.choice(open_columns))
        cut = float(draw.uniform(low[column], high[column]))
        below = values[rows, column] <= cut
        nodes.append((tree, node, column, cut, free, free + 1, 0.0))
        pending += [(free, rows[below], depth + 1), (free + 1, rows[~below], depth + 1)]
        free += 2
    return nodes


def _draw(key: str, tree) -> Column:
    """An evenly spread 64-bit number for a row and a tree."""
    return F.xxhash64(F.lit("isolation"), F.col(key), tree)


def samples(train: DataFrame, key: str, columns: Sequence[str], trees: int = TREES, size: int = SAMPLE) -> DataFrame:
    """(tree, values): for each tree the ``size`` rows of the whole table with the smallest draws of its own.

    One pass: a row goes only to the trees whose draw for it is so small that about twice ``size`` rows of the table come
    that low, so what is ordered per tree has one size whatever the table's. Should a tree get too few, the bound is raised.
    """
    total = train.count()
    values = F.array(*[F.col(c).cast("double") for c in columns]).alias("values")
    share = min(1.0, 2.0 * (size + 32) / max(total, 1))
    while True:
        bound = min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
        low = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda tree: _draw(key, tree) <= F.lit(bound))
        drawn = materialise(train.select(key, values, F.explode(low).alias("tree")), "drawn")
        full = drawn.groupBy("tree").agg(F.count("*").alias("n")).where(F.col("n") >= min(size, total)).count()
        if share >= 1 or full == trees:
            break
        share = min(1.0, 4 * share)
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(_draw(key, F.col("tree")), key))
    return drawn.withColumn("_rank", rank).where(F.col("_rank") <= size).select("tree", "values")


@dataclass(frozen=True)
class IsolationForest:
    """Grown trees as one small table, and the score above which a row is an anomaly."""

    columns: tuple[str, ...]
    nodes: pd.DataFrame
    sample: int
    limit: float | None = None

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``anomaly`` in (0, 1): the sooner random splits isolate a row, the higher."""
        columns, sample = list(self.columns), self.sample
        # At most 100 trees of 511 nodes travel with the job.
        shared = df.sparkSession.sparkContext.broadcast(
            [t.sort_values("node").to_numpy(dtype=float) for _, t in self.nodes.drop(columns="tree").groupby(self.nodes.tree)]
        )

        @F.pandas_udf("double")
        def judge(rows: pd.Series) -> pd.Series:
            values = np.stack(rows.to_list())
            total = np.zeros(len(values))
            for grown in shared.value:
                at = np.zeros(len(values), dtype=int)
                while (inner := grown[at, 1] >= 0).any():
                    column, cut = grown[at, 1].astype(int), grown[at, 2]
                    goes = values[np.arange(len(values)), np.maximum(column, 0)] <= cut
                    at = np.where(inner, np.where(goes, grown[at, 3], grown[at, 4]).astype(int), at)
                total += grown[at, 5]
            return pd.Series(2.0 ** (-total / len(shared.value) / _mean_path(sample)))

        return df.withColumn("anomaly", judge(F.array(*[F.col(c).cast("double") for c in columns])))

    def flag(self, df: DataFrame) -> DataFrame:
        """Add ``is_anomaly``: score above the limit learned from the training rows."""
        return self.score(df).withColumn("is_anomaly", F.col("anomaly") > F.lit(self.limit))


def upper_quantile(scores: DataFrame, column: str, share: float) -> float:
    """The value that ``share`` of the rows exceed, interpolated between ranks; exact at any size."""
    counted = scores.groupBy(column).agg(F.count("*").alias("n"))
    ranked = running_by_score(counted, column, ["n"])
    total = scores.count()
    place = share * (total - 1)
    low = int(place)
    held = lambda rank: (F.col("n_before") <= rank) & (F.col("n_before") + F.col("n") > rank)
    row = ranked.agg(
        F.max(F.when(held(low), F.col(column))).alias("at"),
        F.max(F.when(held(min(low + 1, total - 1)), F.col(column))).alias("after"),
    ).first()
    return row["at"] + (row["after"] - row["at"]) * (place - low)


def fit(
    train: DataFrame, key: str, columns: Sequence[str], trees: int = TREES, size: int = SAMPLE, share: float = CONTAMINATION
) -> IsolationForest:
    """Grow the trees, one small group each, and learn the limit from the scores of all train rows."""

    def grow(keys: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        nodes = _grow(int(keys[0]), np.stack(rows["values"].sort_values(key=lambda v: v.map(tuple)).to_list()))
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "left", "right", "path"])

    drawn = samples(train, key, columns, trees, size)
    nodes = drawn.groupBy("tree").applyInPandas(grow, NODES).toPandas()
    per_tree = min(size, train.count())
    grown = IsolationForest(tuple(columns), nodes, per_tree)
    limit = upper_quantile(grown.score(train.select(*columns)), "anomaly", share)
    return IsolationForest(tuple(columns), nodes, per_tree, limit)
