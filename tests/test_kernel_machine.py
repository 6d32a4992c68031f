"""Kernel maps, the machine beside an exact one, calibrated probabilities, the search's tie, samples of the isolation forest."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from codesieve.operators import anomaly, kernel_machine, models


def test_polynomial_map_gives_the_kernel():
    draw = np.random.default_rng(1)
    x, y = draw.normal(size=(20, 7)), draw.normal(size=(30, 7))
    for gamma in (0.3, 1.7):
        lift = kernel_machine.PolynomialMap(gamma, 7)
        assert lift(x).shape == (20, math.comb(9, 3))
        assert np.abs(lift(x) @ lift(y).T - (gamma * x @ y.T) ** 3).max() < 1e-9
    assert np.abs(kernel_machine.PolynomialMap(0.3, 7)(x) - kernel_machine.PolynomialMap(1.7, 7)(x)).max() > 0.1


def test_nystrom_map_gives_the_kernel_between_landmarks():
    marks = np.random.default_rng(2).normal(size=(40, 5))
    lift = kernel_machine.NystromMap.fit(marks, 0.4)
    want = np.exp(-0.4 * ((marks[:, None] - marks[None]) ** 2).sum(axis=2))
    assert np.abs(lift(marks) @ lift(marks).T - want).max() < 1e-6
    twice = kernel_machine.NystromMap.fit(np.vstack([marks, marks]), 0.4)
    assert np.isfinite(twice(marks)).all() and twice.whiten.shape[1] <= 40


def rows_of(seed, count):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(count, 2))
    chance = 1 / (1 + np.exp(-4 * ((x**2).sum(axis=1) - 1.4)))
    return x, (draw.random(count) < chance).astype(float), chance


def frame(spark, x, y):
    table = spark.createDataFrame([(k, v.tolist(), float(label)) for k, (v, label) in enumerate(zip(x, y))], "id long, v array<double>, label double")
    return table.withColumn("features", array_to_vector("v")).repartition(3)


def exact_machine(x, y, gamma, c, sweeps=400):
    """Signs of the machine with the hinge loss, by coordinate ascent over the rows of its dual form."""
    kernel = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(axis=2)) + 1
    side, alpha = 2 * y - 1, np.zeros(len(x))
    value = np.zeros(len(x))
    for _ in range(sweeps):
        for k in range(len(x)):
            new = min(c, max(0.0, alpha[k] + (1 - side[k] * value[k]) / kernel[k, k]))
            value += (new - alpha[k]) * side[k] * kernel[:, k]
            alpha[k] = new
    return value > 0


def test_machine_agrees_with_the_exact_one(spark):
    x, y, _ = rows_of(3, 240)
    y = ((x**2).sum(axis=1) > 1.4).astype(float)
    rows = kernel_machine.folded(frame(spark, x, y))
    machine = kernel_machine.fit(rows, "rbf", 1.0, 0.5)
    got = {r.id: (r.decision, r.pred) for r in machine.transform(frame(spark, x, y)).collect()}
    want = exact_machine(x, y, 0.5, 1.0)
    assert np.mean([(got[k][0] > 0) == want[k] for k in range(len(x))]) >= 0.97
    assert all((d > 0) == (p == 1) for d, p in got.values())
    # The gradient of the loss is nothing at the solution.
    lift, weights = machine.lift, machine.weights
    lifted = np.hstack([lift(x), np.ones((len(x), 1))])
    short = np.maximum(0, 1 - (2 * y - 1) * (lifted @ weights))
    slope = np.append(weights[:-1], 0) - 2 * lifted.T @ ((2 * y - 1) * short)
    assert np.abs(slope).max() < 1e-3


def test_probabilities_are_calibrated(spark):
    x, y, _ = rows_of(4, 3000)
    new, _, chance = rows_of(5, 2000)
    machine = models.fit_kernel_machine(frame(spark, x, y), "rbf", 1.0, "scale")
    prob = np.array([r.prob for r in machine.transform(frame(spark, new, chance)).orderBy("id").collect()])
    for low in np.arange(0, 1, 0.2):
        inside = (prob >= low) & (prob < low + 0.2)
        if inside.sum() > 30:
            assert abs(prob[inside].mean() - chance[inside].mean()) < 0.1


def test_forest_wins_ties():
    assert models.pick({"forest": 1.0, "machine": 1.0}) == "forest"
    assert models.pick({"forest": None, "machine": 0.0}) == "forest"
    assert models.pick({"forest": 0.7, "machine": 0.71}) == "machine"
    assert models.pick({"forest": 0.72, "machine": 0.71}) == "forest"


@pytest.mark.parametrize("count", [40, 3000])
def test_each_tree_has_its_own_rows_of_the_whole_table(spark, count):
    table = spark.range(0, count, 1, 6).select("id", F.col("id").cast("double").alias("a"))
    part = F.spark_partition_id().alias("part")
    where = dict(table.select("id", part).collect())
    drawn = {}
    for tree, values in anomaly.samples(table, "id", ["a"], trees=8, size=64).collect():
        drawn.setdefault(tree, []).append(int(values[0]))
    assert sorted(drawn) == list(range(8))
    for tree, ids in drawn.items():
        assert len(ids) == len(set(ids)) == min(64, count)
        assert {where[i] for i in ids} == set(range(6))
        order = table.orderBy(anomaly._draw("id", F.lit(tree)), "id").limit(64)
        assert sorted(ids) == sorted(r.id for r in order.collect())
    if count > 64:
        assert len({tuple(sorted(ids)) for ids in drawn.values()}) == 8


def test_problems_of_several_costs_are_solved_in_the_same_passes(spark, monkeypatch):
    x, y, _ = rows_of(6, 200)
    rows = kernel_machine.folded(frame(spark, x, y), 2)
    lift, width = mapped = kernel_machine.map_for(rows, "poly", 0.5)
    passes, collected = [], kernel_machine._collected
    monkeypatch.setattr(kernel_machine, "_collected", lambda parts: passes.append(1) or collected(parts))
    apart = []
    for problem in ((0.2, 0), (5.0, 1), (5.0, kernel_machine.WHOLE)):
        passes.clear()
        apart.append((kernel_machine.solve(rows, lift, width, [problem])[0], len(passes)))
    passes.clear()
    together = kernel_machine.solve(rows, lift, width, [(0.2, 0), (5.0, 1), (5.0, kernel_machine.WHOLE)])
    assert len(passes) == max(n for _, n in apart) < sum(n for _, n in apart)
    assert np.allclose(together, [weights for weights, _ in apart], atol=1e-6)
    shares = [share for share, _ in kernel_machine.fold_accuracies(rows, mapped, [0.2, 5.0], 2)]
    weights = kernel_machine.solve(rows, lift, width, [(5.0, 0), (5.0, 1)])
    right = [((r.decision > 0) == (r.label == 1), r.fold) for r in kernel_machine.left_out(rows, lift, weights).collect()]
    assert shares[1] == pytest.approx(np.mean([np.mean([ok for ok, fold in right if fold == k]) for k in (0, 1)]))


def test_search_of_machines_passes_once_for_settings_of_one_map(spark, monkeypatch):
    x, y, _ = rows_of(7, 120)
    calls, solve = [], kernel_machine.solve
    monkeypatch.setattr(kernel_machine, "solve", lambda rows, lift, *a, **k: calls.append(lift) or solve(rows, lift, *a, **k))
    machine, settings, accuracy = models.search_machine(frame(spark, x, y).select("label", "features"), size=7, folds=2)
    assert len(calls) <= 5 and 0.5 < accuracy <= 1
    assert settings["kernel"] in models.SEARCH_KERNEL and machine.weights.ndim == 1


def test_search_of_forests_has_the_folds_of_the_cross_validator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator

    x, y, _ = rows_of(8, 150)
    train = frame(spark, x, y).select("label", "features").coalesce(1)
    trees = models.forest("risk")
    maps = [{trees.numTrees: n, trees.maxDepth: d, trees.minInstancesPerNode: 1} for n, d in ((3, 2), (5, 4), (4, 1))]
    judge = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    plain = CrossValidator(estimator=trees, estimatorParamMaps=maps, evaluator=judge, numFolds=3, seed=models.SEED).fit(train)
    model, settings, accuracy = models._search(trees, maps, train, 3)
    assert accuracy == pytest.approx(max(plain.avgMetrics)) and settings == maps[int(np.argmax(plain.avgMetrics))]
    assert model.toDebugString.split("\n")[1:] == plain.bestModel.toDebugString.split("\n")[1:]
    assert not spark.sparkContext._jsc.getPersistentRDDs()
