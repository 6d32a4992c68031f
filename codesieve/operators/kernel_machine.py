"""Kernel machines of two classes: maps that stand for kernels, a squared hinge loss, calibrated probabilities.

An exact kernel machine keeps a matrix of all rows by all rows. Here a kernel becomes a map of fixed width, and the machine a
linear one on it:

* The RBF kernel by Nyström's method: values of the kernel with at most :data:`LANDMARKS` rows of the table, whitened by the
  kernel among those.
* The polynomial kernel exactly: all monomials of its degree, each with the root of its multinomial weight.

The loss is the squared hinge, whose Newton step only needs sums over the rows inside the margin: a pass over the table adds
up one matrix of the map's width for each problem, and about ten passes do. Problems on one map (folds, the whole, several
costs) are solved in the same passes, each for as long as its weights move. Decision values of rows that a fold left out calibrate a sigmoid
(Platt 1999), so probabilities come from rows that were not trained on.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve.session import materialise

#: Rows of the table that the RBF map measures others by, at most.
LANDMARKS = 256
#: Passes over the table, at most; the solver stops before, when no weight moves any more.
PASSES = 50
#: Folds whose decision values calibrate the probabilities.
FOLDS = 5
#: Stands for the fold of a machine that leaves none out.
WHOLE = -1
SEED = 42

SUMS = "problem int, task int, sums binary"

Map = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class NystromMap:
    """Rows whose products approximate ``exp(-gamma |x - y|^2)``; they equal it between landmarks."""

    gamma: float
    landmarks: np.ndarray
    whiten: np.ndarray

    @classmethod
    def fit(cls, landmarks: np.ndarray, gamma: float) -> NystromMap:
        bare = cls(gamma, landmarks, np.eye(len(landmarks)))
        values, vectors = np.linalg.eigh(bare(landmarks))
        kept = values > 1e-10 * values.max(initial=1.0)
        return cls(gamma, landmarks, vectors[:, kept] / np.sqrt(values[kept]))

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        far = (rows * rows).sum(axis=1)[:, None] + (self.landmarks**2).sum(axis=1) - 2 * rows @ self.landmarks.T
        return np.exp(-self.gamma * np.maximum(far, 0)) @ self.whiten


@dataclass(frozen=True)
class PolynomialMap:
    """Rows whose products equal ``(gamma <x, y>) ** degree``."""

    gamma: float
    width: int
    degree: int = 3

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        columns = []
        for chosen in combinations_with_replacement(range(self.width), self.degree):
            weight = math.factorial(self.degree)
            for column in set(chosen):
                weight //= math.factorial(chosen.count(column))
            columns.append(math.sqrt(weight * self.gamma**self.degree) * rows[:, chosen].prod(axis=1))
        return np.stack(columns, axis=1) if columns else np.zeros((len(rows), 0))


def _stacked(rows: pa.Array) -> np.ndarray:
    return rows.flatten().to_numpy().reshape(len(rows), -1)


def _summed(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(data) for data in table.column("sums").to_pylist())
    return table.slice(0, 1).select(["problem", "task"]).append_column("sums", pa.array([total.tobytes()], pa.binary()))


def _collected(parts: DataFrame) -> dict[int, np.ndarray]:
    """Sum of one array per task for each problem, in two steps, so that no task and not the driver gets those of all."""
    some = parts.groupBy("problem", F.floor(F.col("task") / 64).alias("part")).applyInArrow(_summed, SUMS)
    return {row.problem: np.frombuffer(row.sums) for row in some.groupBy("problem").applyInArrow(_summed, SUMS).collect()}


def _with_bias(lift: Map, values: np.ndarray) -> np.ndarray:
    return np.hstack([lift(values), np.ones((len(values), 1))])


def _margin_sums(lift: Map, weights: dict[int, np.ndarray], left: dict[int, int]) -> Callable:
    """For each problem: products and class sums of the rows inside the margin, and their squared distances to it.
    ``left`` has the fold that a problem leaves out."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(next(iter(weights.values())))
        squares = {problem: np.zeros((width, width)) for problem in weights}
        sides, loss = {problem: np.zeros(width) for problem in weights}, dict.fromkeys(weights, 0.0)
        for batch in batches:
            if not len(batch):
                continue
            rows = _with_bias(lift, _stacked(batch.column("values")))
            side = 2 * batch.column("label").to_numpy() - 1
            fold = batch.column("fold").to_numpy()
            short = 1 - side[:, None] * (rows @ np.stack(list(weights.values())).T)
            for at, problem in enumerate(weights):
                inside = (short[:, at] > 0) & (fold != left[problem])
                mine = rows[inside]
                squares[problem] += mine.T @ mine
                sides[problem] += mine.T @ side[inside]
                loss[problem] += (short[inside, at] ** 2).sum()
        task = TaskContext.get().partitionId()
        for problem in weights:
            data = np.concatenate([squares[problem].ravel(), sides[problem], [loss[problem]]]).tobytes()
            columns = [pa.array([problem], pa.int32()), pa.array([task], pa.int32()), pa.array([data], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["problem", "task", "sums"])

    return sums


def solve(rows: DataFrame, lift: Map, width: int, problems: Sequence[tuple[float, int]]) -> np.ndarray:
    """Weights (bias last) of a machine on ``label, values, fold`` for each problem: its ``c`` and the fold it leaves out,
    or :data:`WHOLE`. A problem takes part in the passes until its weights stand still.

    Minimises ``|w|^2 / 2 + c * sum(max(0, 1 - y f(x)) ** 2)``, the bias free, by Newton steps that are halved while they do
    not help.
    """
    size = width + 1
    penalty = np.ones(size)
    penalty[-1] = 1e-9
    weights = np.zeros((len(problems), size))
    step, best = np.zeros((len(problems), size)), np.full(len(problems), np.inf)
    moving = list(range(len(problems)))
    for _ in range(PASSES):
        tried = {k: weights[k] + step[k] for k in moving}
        sums = _margin_sums(lift, tried, {k: problems[k][1] for k in moving})
        data = _collected(rows.select("label", "values", "fold").mapInArrow(sums, SUMS))
        for k in moving:
            c = problems[k][0]
            squares, sides, loss = data[k][: size * size].reshape(size, size), data[k][size * size : -1], data[k][-1]
            cost = (penalty * tried[k] ** 2).sum() / 2 + c * loss
            if cost > best[k]:
                step[k] /= 2
            else:
                gain, best[k], weights[k] = best[k] - cost, cost, tried[k]
                step[k] = np.linalg.solve(np.diag(penalty) + 2 * c * squares, 2 * c * sides) - weights[k]
                if gain <= 1e-8 * (1 + best[k]):
                    step[k] = 0
            if np.abs(step[k]).max() <= 1e-7 * (1 + np.abs(weights[k]).max()):
                step[k] = 0
        moving = [k for k in moving if step[k].any()]
        if not moving:
            break
    return weights


@dataclass(frozen=True)
class Calibration:
    """A sigmoid over decision values."""

    slope: float
    shift: float


def calibrate(decided: DataFrame) -> Calibration:
    """The sigmoid of ``decision`` that fits ``label``, with Platt's targets in place of 0 and 1."""
    counts = decided.agg(F.count_if(F.col("label") == 1).alias("ones"), F.count_if(F.col("label") == 0).alias("zeros")).first()
    high, low = (counts.ones + 1) / (counts.ones + 2), 1 / (counts.zeros + 2)
    target = F.when(F.col("label") == 1, high).otherwise(low)
    both = F.array(
        F.struct(F.lit(1.0).alias("label"), target.alias("weight")), F.struct(F.lit(0.0).alias("label"), (1 - target).alias("weight"))
    )
    soft = decided.select("decision", F.inline(both)).select("label", "weight", array_to_vector(F.array("decision")).alias("features"))
    fit = LogisticRegression(weightCol="weight", maxIter=100, tol=1e-9).fit(materialise(soft, "platt"))
    return Calibration(float(fit.coefficients[0]), float(fit.intercept))


@dataclass(frozen=True)
class KernelMachine:
    """A linear machine on mapped features, with a sigmoid for its probabilities."""

    lift: Map
    weights: np.ndarray
    sigmoid: Calibration

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Add ``decision``, ``prob`` of class 1 and ``pred``, the sign of the decision."""
        scored = df.withColumn("decision", decision(self.lift, self.weights[None])(vector_to_array(features), F.lit(0)))
        prob = 1 / (1 + F.exp(-(F.col("decision") * self.sigmoid.slope + self.sigmoid.shift)))
        return scored.withColumns({"prob": prob, "pred": (F.col("decision") > 0).cast("int")})


def decision(lift: Map, weights: np.ndarray):
    """A function of ``values, problem``: the decision value of a row by the machine of that number."""

    @F.pandas_udf("double")
    def decide(values: pd.Series, problem: pd.Series) -> pd.Series:
        rows = _with_bias(lift, np.stack(values.to_list()))
        return pd.Series((rows * weights[problem.to_numpy()]).sum(axis=1))

    return decide


def landmarks(rows: DataFrame, most: int = LANDMARKS) -> np.ndarray:
    """Distinct rows drawn by hash."""
    drawn = rows.select("values").distinct().orderBy(F.xxhash64(F.lit(SEED), "values"), "values").limit(most)
    return _stacked(drawn.toArrow().column("values").combine_chunks())


def map_for(rows: DataFrame, kernel: str, gamma: float) -> tuple[Map, int]:
    """The map of a kernel for ``values``, and its width."""
    if kernel == "poly":
        width = len(rows.first().values)
        return PolynomialMap(gamma, width), math.comb(width + 2, 3)
    lift = NystromMap.fit(landmarks(rows), gamma)
    return lift, lift.whiten.shape[1]


def folded(train: DataFrame, folds: int = FOLDS, features: str = "features") -> DataFrame:
    """``label, values, fold`` of a table with vectors, written once: each solver makes several passes. Equal rows share a fold."""
    values = vector_to_array(features).alias("values")
    rows = train.select(F.col("label").cast("double").alias("label"), values)
    return materialise(rows.withColumn("fold", F.pmod(F.xxhash64("values", "label"), F.lit(folds)).cast("int")), "folded")


def left_out(rows: DataFrame, lift: Map, weights: np.ndarray) -> DataFrame:
    """``label, fold, decision`` of each row, by the machine that did not see its fold."""
    return rows.select("label", "fold", decision(lift, weights)(F.col("values"), F.col("fold")).alias("decision"))


def fit(rows: DataFrame, kernel: str, c: float, gamma: float, folds: int = FOLDS) -> KernelMachine:
    """A calibrated machine on ``label, values, fold``."""
    lift, width = map_for(rows, kernel, gamma)
    weights = solve(rows, lift, width, [(c, fold) for fold in [*range(folds), WHOLE]])
    return KernelMachine(lift, weights[-1], calibrate(left_out(rows, lift, weights)))


def fit_after_folds(rows: DataFrame, mapped: tuple[Map, int], c: float, folded_weights: np.ndarray) -> KernelMachine:
    """The machine that :func:`fit` gives, where those that leave a fold out are solved already."""
    lift, width = mapped
    return KernelMachine(lift, solve(rows, lift, width, [(c, WHOLE)])[0], calibrate(left_out(rows, lift, folded_weights)))


def fold_accuracies(
    rows: DataFrame, mapped: tuple[Map, int], costs: Sequence[float], folds: int = FOLDS
) -> list[tuple[float, np.ndarray]]:
    """For each cost: the mean share of right signs over the folds, each judged by the machine that did not see it, and the
    weights of those machines. ``mapped`` is of :func:`map_for`."""
    lift, width = mapped
    weights = solve(rows, lift, width, [(c, fold) for c in costs for fold in range(folds)]).reshape(len(costs), folds, -1)

    @F.pandas_udf("array<double>")
    def decide(values: pd.Series, fold: pd.Series) -> pd.Series:
        lifted = _with_bias(lift, np.stack(values.to_list()))
        return pd.Series(list(np.stack([(lifted * own[fold.to_numpy()]).sum(axis=1) for own in weights], axis=1)))

    judged = rows.select("label", "fold", F.posexplode(decide("values", "fold")).alias("cost", "decision"))
    right = F.avg(((F.col("decision") > 0) == (F.col("label") == 1)).cast("double")).alias("share")
    shares = dict(judged.groupBy("cost", "fold").agg(right).groupBy("cost").agg(F.avg("share")).collect())
    return [(shares[k], weights[k]) for k in range(len(costs))]
