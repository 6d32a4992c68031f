"""Hard negatives for anchor vectors, found through an inverted multi-index with certified stops.

*Index.* Vectors are cut into two halves, each with a codebook of its own, fitted by k-means to at most
:data:`SAMPLE` rows drawn by hash. Every row is indexed: its cell is the pair of its nearest centroids. Radii (the
largest distance of any row to its centroid, for each centroid of a half) and the rows of each cell are aggregates over
all rows, so the fitted sample decides how fast a search is, never what it finds.

*Visits.* With ``q`` a half of an anchor, no row of a centroid ``c`` of radius ``r`` scores more than ``q.c + |q| r`` in
that half. A heap walks the two sorted lists of half bounds and gives out cells by descending sum (multi-sequence).
Cells whose least possible score is above every window are passed over. An anchor visits as many cells as hold a number of
rows that grows each round; its cells meet the anchors in tasks of bounded size, rows by anchors.

*Certified stops.* Positives first: an anchor is done when it has all it needs and the next cell's bound is below the worst
of them. Then negatives, for the windows of all its positives at once: a window is done when it has all it needs, or can
get no more, because the next bound is below its worst score or its lower limit. Equal bounds are visited, for ties go to
the smaller id. So the result is exact. Anchors that are done leave; a round sends on only rows that can still change a
result.

Defined results: rows with a null label, a null vector or a component that is null or not finite take no part; shorter
vectors are filled up with zeros; components beyond 2^28 after scaling count as 2^28; null ids are never anchors, are no
multiples of seven and lose ties; repeated rows are rows of their own (an anchor's copy may be its positive), rows
equal in score and id in any order; an anchor without positives, or windows without rows, have no result; an empty table
has an empty result; other columns are neither read nor returned.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codesieve.llm.store import Store

#: Rows the codebooks are fitted to, at most.
SAMPLE = 8192
#: Rows of a cell that the size of the codebooks aims at, and the largest codebook.
CELL_ROWS, MOST_CENTROIDS = 512, 128
#: Rows of a cell, and anchors, that meet in one task.
CHUNK, ANCHORS = 4096, 512
#: Rows an anchor visits in its first round; each further round visits so many times as many.
FIRST_ROWS, GROWTH = 16_384, 8
LIMIT = 1 << 28


def fit(points: np.ndarray, centroids: int, rounds: int = 8) -> np.ndarray:
    """Centroids of k-means, begun at evenly spaced points. An empty centroid stays where it is."""
    centres = points[np.linspace(0, len(points) - 1, centroids).astype(int)].astype(float)
    for _ in range(rounds):
        nearest = assign(points, centres)
        counts = np.bincount(nearest, minlength=centroids)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def assign(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


def padded(column: pa.Array, dims: int) -> np.ndarray:
    """Whole-number vectors of ``dims`` components."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows; by floating point where that is exact."""
    top = lambda x: int(np.abs(x).max(initial=0))
    if top(a) * top(b) * max(1, a.shape[1]) < 1 << 53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


class Codebooks:
    """Centroids and radii of both halves, and how many rows each cell holds."""

    def __init__(self, halves: list[np.ndarray]):
        self.halves = halves
        self.size = len(halves[0])
        self.cut = halves[0].shape[1]
        self.radii = [np.zeros(self.size), np.zeros(self.size)]
        self.rows = np.zeros((self.size, self.size), np.int64)

    def split(self, vectors: np.ndarray) -> list[np.ndarray]:
        return [vectors[:, : self.cut], vectors[:, self.cut :]]

    def visits(self, vector: np.ndarray, skip: int, rows: int, floor: float, ceiling: float) -> tuple[list[int], int, float]:
        """Cells for an anchor by falling bound, after the first ``skip``, until they hold ``rows``.

        Ends before a bound below ``floor``; leaves cells out that only hold scores above ``ceiling``. Also returns how many
        cells have been given out in all, and the bound of the next one, minus infinity if there is none.
        """
        parts = [half[0].astype(float) for half in self.split(vector[None])]
        middle = [centres @ part for centres, part in zip(self.halves, parts)]
        reach = [np.sqrt((part**2).sum()) * radii for part, radii in zip(parts, self.radii)]
        # Room for the rounding of bounds.
        slack = [1e-9 * (np.abs(m) + x) + 1e-6 for m, x in zip(middle, reach)]
        high = [m + x + s for m, x, s in zip(middle, reach, slack)]
        low = [m - x - s for m, x, s in zip(middle, reach, slack)]
        order = [np.argsort(-h, kind="stable") for h in high]
        heap = [(-(high[0][order[0][0]] + high[1][order[1][0]]), 0, 0)]
        cells, held, turn = [], 0, 0
        while heap:
            bound, i, j = heap[0]
            if -bound < floor:
                return cells, turn, -np.inf
            if held >= rows:
                return cells, turn, -bound
            heapq.heappop(heap)
            a, b = order[0][i], order[1][j]
            if turn >= skip and self.rows[a, b] and low[0][a] + low[1][b] <= ceiling:
                cells.append(int(a) * self.size + int(b))
                held += int(self.rows[a, b])
            turn += 1
            # Each cell is entered once: from the left, or from above in the first column.
            if j + 1 < self.size:
                heapq.heappush(heap, (-(high[0][a] + high[1][order[1][j + 1]]), i, j + 1))
            if j == 0 and i + 1 < self.size:
                heapq.heappush(heap, (-(high[0][order[0][i + 1]] + high[1][order[1][0]]), i + 1, 0))
        return cells, turn, -np.inf


def _indexer(books: Codebooks, dims: int) -> Callable:
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            vectors = padded(batch.column("parts"), dims)
            nearest, distance = [], []
            for half, centres in zip(books.split(vectors), books.halves):
                own = assign(half.astype(float), centres)
                nearest.append(own)
                distance.append(np.sqrt(((half - centres[own]) ** 2).sum(axis=1)))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("row", "vec_id", "label")),
                    pa.array([v.tobytes() for v in vectors], pa.binary()),
                    *(pa.array(n.astype(np.int64)) for n in nearest),
                    *(pa.array(d) for d in distance),
                ],
                ["row", "vec_id", "label", "vector", "half_a", "half_b", "far_a", "far_b"],
            )

    return index


def _visitor(books: Codebooks, rows: int) -> Callable:
    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, turns, bounds = [], [], []
            state = [batch.column(c).to_pylist() for c in ("vector", "turn", "floor", "ceiling")]
            for vector, turn, floor, ceiling in zip(*state):
                found = books.visits(np.frombuffer(vector, np.int64), turn, rows, floor, ceiling)
                for out, value in zip((cells, turns, bounds), found):
                    out.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("anchor"), pa.array(cells, pa.list_(pa.int64())), pa.array(turns, pa.int64()), pa.array(bounds, pa.float64())],
                ["anchor", "cells", "turn", "bound"],
            )

    return visit


def _stack(table: pa.Table) -> np.ndarray:
    return np.stack([np.frombuffer(v, np.int64) for v in table.column("vector").to_pylist()])


FOUND = "anchor long, window int, score long, vec_id long, row long"
FOUND_NAMES = ["anchor", "window", "score", "vec_id", "row"]
#: The floor of a window that no row can change any more.
CLOSED = 1 << 62


def _comparer(keep: int, negatives: bool, most: int) -> Callable:
    """The best rows of a piece of a cell for each open window of each anchor."""

    def compare(key: tuple, held: pa.Table, anchors: pa.Table) -> pa.Table:
        found = [[np.zeros(0, np.int64)] for _ in range(4)]
        if len(held) and len(anchors):
            score = scores(_stack(anchors), _stack(held))
            row, label = held.column("row").to_numpy(), held.column("label").to_numpy()
            # Rows by id, nulls last, so that a stable order by score settles ties.
            ids = held.column("vec_id").combine_chunks()
            unnamed = ids.is_null().to_numpy(zero_copy_only=False)
            by_id = np.lexsort((row, ids.fill_null(0).to_numpy(zero_copy_only=False), unnamed))
            columns = [anchors.column(c).to_pylist() for c in ("anchor", "label", "targets", "floors")]
            for mine, anchor, own, targets, floors in zip(score, *columns):
                able = (label != own) if negatives else (label == own) & (row != anchor)
                able = by_id[(able & (mine >= min(floors)))[by_id]]
                able = able[np.argsort(-mine[able], kind="stable")]
                falling = -mine[able]
                for window, (target, floor) in enumerate(zip(targets, floors)):
                    start = np.searchsorted(falling, -(most * target // 100)) if negatives else 0
                    chosen = able[start : min(start + keep, np.searchsorted(falling, -floor, "right"))]
                    for part, value in zip(found, (np.full(len(chosen), anchor), np.full(len(chosen), window), mine[chosen], chosen)):
                        part.append(value)
        anchor, window, score, chosen = map(np.concatenate, found)
        names = held.select(["vec_id", "row"]).take(pa.array(chosen))
        return pa.table([pa.array(anchor), pa.array(window.astype(np.int32)), pa.array(score), *names.columns], FOUND_NAMES)

    return compare


def _stack(table: pa.Table) -> np.ndarray:
    return np.stack([np.frombuffer(v, np.int64) for v in table.column("vector").to_pylist()])


class Miner:
    """Searches over one index of ``vectors`` (``vec_id, embedding, label``)."""

    def __init__(self, vectors: DataFrame, scale: int = 256, anchor_every: int = 100, seed: int = 11):
        self.store = Store(vectors.sparkSession, "negatives")
        self.anchor_every = anchor_every
        finite = lambda x: x.isNotNull() & (F.abs(x) < float("inf"))
        able = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", finite)
        whole = lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(x * scale))).cast("long")
        rows = vectors.where(able).select(
            F.monotonically_increasing_id().alias("row"),
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("long").alias("label"),
            F.transform(F.col("embedding").cast("array<double>"), whole).alias("parts"),
        )
        rows = self.store.keep(rows, "rows")
        self.count, dims = rows.agg(F.count("*"), F.max(F.size("parts"))).first()
        self.dims = max(2, dims or 0)
        self.books = self._fitted(rows, seed)
        self.index = self._indexed(rows)

    def _fitted(self, rows: DataFrame, seed: int) -> Codebooks:
        sample = rows.select("parts", F.xxhash64(F.lit(seed), "row").alias("draw")).orderBy("draw").limit(SAMPLE).toArrow()
        points = padded(sample.column("parts").combine_chunks(), self.dims) if len(sample) else np.zeros((1, self.dims), np.int64)
        centroids = int(min(MOST_CENTROIDS, len(points), max(4, (self.count / CELL_ROWS) ** 0.5)))
        cut = (self.dims + 1) // 2
        return Codebooks([fit(half.astype(float), centroids) for half in (points[:, :cut], points[:, cut:])])

    def _indexed(self, rows: DataFrame) -> DataFrame:
        """All rows with their cells; fills in the radii and sizes of cells."""
        schema = "row long, vec_id long, label long, vector binary, half_a long, half_b long, far_a double, far_b double"
        index = self.store.keep(rows.mapInArrow(_indexer(self.books, self.dims), schema), "index")
        for radii, half in zip(self.books.radii, "ab"):
            for centroid, far in index.groupBy(f"half_{half}").agg(F.max(f"far_{half}")).collect():
                radii[centroid] = far * (1 + 1e-9) + 1e-6
        for a, b, n in index.groupBy("half_a", "half_b").agg(F.count("*")).collect():
            self.books.rows[a, b] = n
        cell = (F.col("half_a") * self.books.size + F.col("half_b")).alias("cell")
        return index.select("row", "vec_id", "label", "vector", cell)

    def _rounds(self, anchors: DataFrame, keep: int, name: str, limits: tuple[int, int] | None = None) -> DataFrame:
        """``anchor, window, score, vec_id, row``: the first ``keep`` rows of each window of each anchor.

        ``anchors`` has ``anchor, label, vector, targets``, with a window for each target. Without ``limits`` a window takes
        other rows of the anchor's label; with them, rows of other labels that score from ``limits[0]`` to ``limits[1]``
        percent of its target.
        """
        spark, (least, most) = self.store.spark, limits or (0, 0)
        used = np.argwhere(self.books.rows).tolist()
        sized = [(a * self.books.size + b, -(-int(self.books.rows[a, b]) // CHUNK)) for a, b in used]
        sized = F.broadcast(spark.createDataFrame(sized, "cell long, chunks long"))
        chunked = self.index.join(sized, "cell").withColumn("chunk", F.pmod(F.xxhash64("row"), F.col("chunks")))
        # The worst score that can still change a window; ceil(least * target / 100) at first, in whole numbers.
        if limits:
            floors = f"transform(targets, t -> (t * {least} + pmod(-(t * {least}), 100)) div 100)"
            ceiling = F.array_max(F.transform("targets", lambda t: t.cast("double"))) * most / 100 + 1
        else:
            floors, ceiling = f"transform(targets, t -> {-CLOSED})", F.lit(float("inf"))
        state = anchors.select("anchor", "label", "vector", F.lit(0).cast("long").alias("turn"), "targets", F.expr(floors).alias("floors"))
        best = self.store.keep(spark.createDataFrame([], FOUND), f"{name}-best0")
        state = self.store.keep(state, f"{name}-state0")
        turn, rows = 0, FIRST_ROWS
        while active := state.count():
            asked = state.select("anchor", "vector", "turn", F.array_min("floors").cast("double").alias("floor"), ceiling.alias("ceiling"))
            schema = "anchor long, cells array<long>, turn long, bound double"
            visits = self.store.keep(asked.mapInArrow(_visitor(self.books, rows), schema), f"{name}-visits{turn}")
            pairs = visits.select("anchor", F.explode("cells").alias("cell")).join(sized, "cell")
            chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk")
            part = F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-active // ANCHORS)))).alias("part")
            pairs = pairs.select("anchor", "cell", chunk, part)
            met = self.store.keep(pairs.select("cell", "chunk", "part").distinct(), f"{name}-met{turn}")
            key = ["cell", "chunk", "part"]
            held = chunked.join(met, ["cell", "chunk"]).select("row", "vec_id", "label", "vector", *key)
            asking = pairs.join(state.select("anchor", "label", "vector", "targets", "floors"), "anchor")
            compare = _comparer(keep, limits is not None, most)
            found = held.groupBy(*key).cogroup(asking.groupBy(*key)).applyInArrow(compare, FOUND)
            first = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
            ranked = best.unionByName(found).withColumn("place", F.row_number().over(first)).where(F.col("place") <= keep)
            turn, rows = turn + 1, rows * GROWTH
            best = self.store.keep(ranked.drop("place"), f"{name}-best{turn}")
            state = self.store.keep(self._open(state, visits, best, keep), f"{name}-state{turn}")
        return best

    @staticmethod
    def _open(state: DataFrame, visits: DataFrame, best: DataFrame, keep: int) -> DataFrame:
        """Anchors with a window that the next cell may still change; all others of their windows are closed."""
        worst = best.groupBy("anchor", "window").agg(F.count("*").alias("n"), F.min("score").alias("worst")).where(F.col("n") == keep)
        worst = worst.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("window", "worst"))).alias("worst"))
        after = state.drop("turn").join(visits.select("anchor", "turn", "bound"), "anchor").join(worst, "anchor", "left")
        risen = F.transform("floors", lambda f, k: F.greatest(f, F.coalesce(F.try_element_at("worst", k), f)))
        after = after.withColumn("floors", risen)
        after = after.withColumn("floors", F.transform("floors", lambda f: F.when(f > F.col("bound"), F.lit(CLOSED)).otherwise(f)))
        return after.where(F.array_min("floors") < CLOSED).select("anchor", "label", "vector", "turn", "targets", "floors")

    def mine(self, positives: int, negatives: int, least: int, most: int) -> DataFrame:
        """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``. Runs jobs when it is called."""
        anchors = self.index.where(F.col("vec_id") % self.anchor_every == 0)
        anchors = anchors.select(F.col("row").alias("anchor"), "vec_id", "label", "vector", F.array(F.lit(0).cast("long")).alias("targets"))
        anchors = self.store.keep(anchors, "anchors")
        near = self._rounds(anchors.drop("vec_id"), positives, "positives")
        place = F.struct((-F.col("score")).alias("order"), F.col("vec_id").isNull().alias("unnamed"), "vec_id", "row", "score")
        near = near.groupBy("anchor").agg(F.array_sort(F.collect_list(place)).alias("near"))
        anchors = self.store.keep(anchors.drop("targets").join(near, "anchor"), "targets")
        windows = anchors.select("anchor", "label", "vector", F.transform("near", lambda p: p["score"]).alias("targets"))
        hard = self._rounds(windows, negatives, "negatives", (least, most))
        met = hard.join(anchors.select("anchor", F.col("vec_id").alias("anchor_id"), "near"), "anchor")
        first = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
        positive = F.get("near", F.col("window"))
        return met.select(
            "anchor_id",
            positive["vec_id"].alias("positive_id"),
            F.row_number().over(first).alias("rank"),
            F.col("vec_id").alias("negative_id"),
            positive["score"].alias("positive_score"),
            F.col("score").alias("negative_score"),
        )


def mine(vectors: DataFrame, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90) -> DataFrame:
    """For every anchor (a ``vec_id`` divisible by 100) and each of its first ``positives`` rows, the first ``negatives`` rows of
    other labels that score from ``least`` to ``most`` percent of the positive's score."""
    return Miner(vectors).mine(positives, negatives, least, most)
