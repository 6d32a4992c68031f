"""Ranks, cuts, duplicates, text and samples, against brute force on small inputs."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from codesieve.functions import text
from codesieve.operators import anomaly, kernel_machine, metrics, ranking, sampling, sets, vectors

DRAW = random.Random(1)
KEYS = sorted({DRAW.randrange(-(2**62), 2**62) for _ in range(300)}) + [2**62 + i for i in range(200)]


def test_row_numbers(spark):
    rows = KEYS[:]
    random.Random(2).shuffle(rows)
    numbered = ranking.with_row_number(spark.createDataFrame([(k,) for k in rows], "key bigint"), "key")
    assert dict(numbered.collect()) == {k: i for i, k in enumerate(KEYS, 1)}


def test_blocks_of_any_size(spark):
    blocked = sampling.with_block(spark.createDataFrame([(k,) for k in KEYS], "key bigint"), "key", 64)
    assert dict(blocked.collect()) == {k: i // 64 for i, k in enumerate(KEYS)}


@pytest.mark.parametrize("share", [0.0, 0.2, 0.3, 1.0])
def test_split_is_exact_with_a_hot_label(spark, share):
    rows = [(i, 1 if i % 10 == 0 else 0) for i in range(1000)]
    marked = sampling.split(spark.createDataFrame(rows, "id bigint, y int"), "id", share, ["y"]).collect()
    for label in (0, 1):
        ids = [i for i, y in rows if y == label]
        ids.sort(key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
        wanted = set(ids[: math.ceil(share * len(ids))])
        assert {r.id for r in marked if r.y == label and r.is_test} == wanted


def test_first_copy_wins_whatever_its_place(spark):
    rows = [(p, i, "same" if i % 3 else f"t{i}", i % 2) for p in (1, 0) for i in range(90)]
    random.Random(3).shuffle(rows)
    table = spark.createDataFrame(rows, "src_priority int, row_id bigint, code string, target int").repartition(7)
    kept = {r.code: (r.src_priority, r.row_id, r.target) for r in sets.dedupe_first(table, ["src_priority", "row_id"]).collect()}
    wanted = {}
    for p, i, code, target in sorted(rows):
        wanted.setdefault(code, (p, i, target))
    assert kept == wanted


def test_auc_and_curve(spark):
    draw = random.Random(4)
    rows = [(i, draw.randint(0, 1), draw.choice([0.0, 1.0, draw.random(), 0.5])) for i in range(400)]
    table = spark.createDataFrame(rows, "key bigint, label int, prob double").withColumn("pred", F.lit(0))
    pos, neg = ([p for _, y, p in rows if y == label] for label in (1, 0))
    pairs = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert metrics.auc(table).first().auc == pytest.approx(pairs)
    for point in metrics.roc_points(table).collect():
        assert point.tp == sum(p >= point.threshold for p in pos)
        assert point.fp == sum(p >= point.threshold for p in neg)


def test_quantile_is_that_of_numpy(spark):
    values = [round(random.Random(i).random(), 2) for i in range(333)]
    table = spark.createDataFrame([(v,) for v in values], "v double")
    assert anomaly.upper_quantile(table, "v", 0.1) == pytest.approx(np.percentile(values, 90))


def test_isolation_forest_finds_the_far_rows(spark):
    draw = random.Random(5)
    rows = [(i, draw.gauss(0, 1), draw.gauss(0, 1)) for i in range(500)] + [(500 + i, 9.0 + i, -9.0) for i in range(5)]
    table = spark.createDataFrame(rows, "id bigint, a double, b double")
    grown = anomaly.fit(table, "id", ["a", "b"], trees=40)
    scored = grown.flag(table).collect()
    assert abs(sum(r.is_anomaly for r in scored) - 0.1 * len(rows)) <= 2
    assert all(r.is_anomaly for r in scored if r.id >= 500)


STRINGS = [
    "", "a", "a\n", "a\r\nb\r\n", "\n\n", " # x\n\t\n b#\n", "a\x0bb\x0cc\x1cd\x85e\u2028f\u2029", "\u3000#y\n\xa0\n", "a\rb",
]


def test_lines_and_strip_are_those_of_python(spark):
    table = spark.createDataFrame([(i, s) for i, s in enumerate(STRINGS)], "id int, code string")
    rows = text.with_line_metrics(table).withColumn("bare", text.strip(F.col("code"))).collect()
    for row in rows:
        lines = STRINGS[row.id].splitlines()
        assert row.loc == len(lines), repr(STRINGS[row.id])
        assert row.comments == sum(line.strip().startswith("#") for line in lines)
        assert row.blank_lines == sum(not line.strip() for line in lines)
        assert row.bare == STRINGS[row.id].strip()


def test_term_counts(spark):
    words = [["b", "a", "b"], [], ["x"], ["a", "b", "a", "b", "c"]]
    table = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id int, tokens array<string>")
    counted = vectors.with_term_counts(vectors.with_terms(table)).collect()
    for row in counted:
        own = words[row.id]
        terms = own + [f"{a} {b}" for a, b in zip(own, own[1:])]
        assert {c.term: c.tf for c in row.counts} == {t: terms.count(t) for t in terms}


def test_nystrom_map_approximates_the_kernel():
    draw = np.random.default_rng(9)
    points = np.array([(0.0, 0.0), (0.5, -0.2), (1.0, 1.0)])
    mapped = kernel_machine.NystromMap.fit(draw.normal(size=(200, 2)), 0.5)(points)
    for i, p in enumerate(points):
        for j, q in enumerate(points):
            assert mapped[i] @ mapped[j] == pytest.approx(math.exp(-0.5 * ((p - q) ** 2).sum()), abs=0.02)
