"""Lexical search, near copies among vectors and hard negatives, beside plain versions."""

import math
import random

import numpy as np
import pytest

from codesieve.llm import hard_negatives, lexical_search, pstable
from tests.llm import brute

VECTORS = "vec_id long, embedding array<float>, label int, row int, score string, node long"


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def frame(spark, rows):
    """Vectors with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], VECTORS).repartition(3)


def narrow(vector):
    """As 32-bit floats hold it."""
    return None if vector is None else [None if x is None else float(np.float32(x)) for x in vector]


def odd_vectors(seed, count=300, dims=16):
    """Groups of near copies, exact copies, repeated ids, odd rows and large components."""
    draw = random.Random(seed)
    rows, centre = [], None
    for k in range(count):
        if k % 10 == 0:
            centre = [draw.gauss(0, 1) for _ in range(dims)]
        noise = draw.choice([0.0, 0.03, 0.1, 0.14, 1.0])
        rows.append((k * 5, [x + draw.gauss(0, noise) for x in centre], k // 10 % 3))
    rows += [rows[0], (rows[1][0], rows[1][1], 2), (7000, rows[2][1], rows[2][2]), (None, rows[3][1], rows[3][2]), (None, None, None)]
    rows += [(8000, None, 1), (8100, [], 1), (8200, [0.0] * dims, 1), (8300, [1.0, math.nan], 1), (8400, [math.inf], 1)]
    rows += [(8500, [1.0, None], 1), (8600, [1.0, 2.0], 1), (8700, [1e30] * dims, 1), (8800, [1e30] * dims, 2), (8900, rows[4][1], None)]
    return [(i, narrow(v), label) for i, v, label in rows]


def test_near_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pstable, "CHUNK", 4)
    monkeypatch.setattr(pstable, "TASK_ROWS", 64)
    rows = odd_vectors(1)
    got = pstable.near_copies(frame(spark, rows))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert ordered(got.collect()) == ordered(brute.near_vectors(rows))


def test_near_vectors_of_one_large_group(spark):
    draw = np.random.default_rng(5)
    middle = draw.standard_normal(64)
    group = [(k, (middle + draw.standard_normal(64) * 0.07).tolist(), 1) for k in range(400)]
    rows = [(i, narrow(v), label) for i, v, label in group + [(k, middle.tolist(), 1) for k in range(400, 600)]]
    assert ordered(pstable.near_copies(frame(spark, rows)).collect()) == ordered(brute.near_vectors(rows))


def test_projections_and_tables_follow_the_number_of_vectors():
    for count in (1, 1000, 10**6, 10**9):
        width, projections, tables = pstable.plan(count, 0.98)
        met = pstable.collision(0.2, width) ** projections
        assert (1 - met) ** tables <= pstable.MISSED
        assert pstable.collision(math.sqrt(2), width) ** projections * count <= 1.0001 or projections == 4
    draw = np.random.default_rng(3).standard_normal(200_000) * 0.2
    shift = np.random.default_rng(4).random(200_000) * 2
    assert abs(np.mean(np.floor((draw + shift) / 2) == 0) - pstable.collision(0.2, 2.0)) < 0.01


def test_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "FIRST_ROWS", 20)
    monkeypatch.setattr(hard_negatives, "CELL_ROWS", 4)
    monkeypatch.setattr(hard_negatives, "CHUNK", 16)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 5)
    rows = odd_vectors(2)
    got = hard_negatives.mine(frame(spark, rows))
    want = brute.negatives(rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert len(want) > 100
    assert ordered(got.collect()) == ordered(want)


def test_negatives_of_ties(spark):
    rows = [(k, [1.0, 0.0] if k % 3 else [0.5, 0.0], k % 2) for k in range(-200, 205)]
    assert ordered(hard_negatives.mine(frame(spark, rows)).collect()) == ordered(brute.negatives(rows))


def test_cells_come_by_falling_bounds_and_cover_all_rows():
    draw = np.random.default_rng(7)
    points = (draw.standard_normal((500, 8)) * 100).astype(np.int64)
    halves = [points[:, :4], points[:, 4:]]
    books = hard_negatives.Codebooks([hard_negatives.fit(h.astype(float), 6) for h in halves])
    cells = [hard_negatives.assign(h.astype(float), c) for h, c in zip(halves, books.halves)]
    for k, (half, centres) in enumerate(zip(halves, books.halves)):
        np.maximum.at(books.radii[k], cells[k], np.sqrt(((half - centres[cells[k]]) ** 2).sum(axis=1)))
    np.add.at(books.rows, tuple(cells), 1)
    own, query = cells[0] * 6 + cells[1], points[3]
    seen, turn, before = [], 0, np.inf
    while True:
        found, turn, bound = books.visits(query, turn, 1, -np.inf, np.inf)
        seen += found
        rest = ~np.isin(own, seen)
        assert bound <= before
        if bound == -np.inf:
            break
        assert (points[rest] @ query).max() <= bound
        before = bound
    assert sorted(seen) == sorted(set(own.tolist()))


ITEMS = [(1, "alpha3 beta9 the unique7 u3v1 u3v1"), (1, "öäü ÉÈ two-words"), (None, "ONE x x"), (2, None), (3, ""), (4, "... !"), (5, "nowhere")]


@pytest.mark.parametrize("stretch, block_terms", [(3, 4), (16_384, 50_000)])
def test_search_equals_brute_force(spark, odd, documents, monkeypatch, stretch, block_terms):
    monkeypatch.setattr(lexical_search, "STRETCH", stretch)
    monkeypatch.setattr(lexical_search, "BITS", 3)
    items = ITEMS + [(6, " ".join(f"w{k % 700}x{k * k % 911}" for k in range(0, 300, 3)))]
    table = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, term int")
    got = lexical_search.search(odd, table, block_terms=block_terms)
    want = brute.search([d[:2] for d in documents], items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert ordered(got.collect()) == ordered(want)


def test_search_leaves_groups_unscored():
    draw = random.Random(4)
    docs = [(k, " ".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(1, 40)))) for k in range(3000)]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([d[0] for d in docs]), pa.array([d[1] for d in docs])], ["doc_id", "text"])
    asked = next(lexical_search._item_terms(iter([pa.RecordBatch.from_arrays([pa.array([0]), pa.array(["a b c d e f g h"])], ["item", "text"])])))
    vocabulary = asked.column("term").to_numpy()
    postings = pa.Table.from_batches(list(lexical_search._poster(vocabulary)(iter([batch]))))
    n = postings.column("n").to_numpy()
    stretch = lexical_search.Stretch(postings, len(vocabulary), len(n), int(n.sum()))
    df = np.diff(stretch.cuts).tolist()
    best = lexical_search.Best(20)
    weights = np.array([lexical_search.weight(len(n), d) for d in df])
    scored = lexical_search._search(stretch, np.arange(len(vocabulary)), weights, best)
    masks = len({frozenset(set(brute.terms(t)) & set("abcdefgh")) for _, t in docs})
    assert 0 < scored < masks
    want = brute.search(docs, [(0, "a b c d e f g h")])
    assert list(zip(best.doc_id.tolist(), best.score.tolist())) == [(d, s) for _, _, d, s in want]


def test_empty_tables(spark, nothing):
    none = frame(spark, [(1, [1.0], 1)]).limit(0)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert pstable.near_copies(none).count() == 0
    assert hard_negatives.mine(none).count() == 0
    assert lexical_search.search(nothing, items).count() == 0
    assert lexical_search.search(nothing, items.limit(0)).count() == 0
