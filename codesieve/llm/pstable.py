"""Near copies among labelled vectors, by Euclidean p-stable hashing and exact cosines.

Equal vectors of a label are one class; only one of a class is compared, and its size counts. Vectors are normalised, so
that a cosine of ``c`` is a distance of ``sqrt(2 - 2c)``. A table hashes a vector by the cells of ``K`` random Gaussian
projections, each cut into pieces of ten such distances; two vectors at that distance share a piece with a probability
that is worked out from the normal distribution (the 2-stable one). ``K`` grows with the logarithm of the number of
classes, so that unrelated vectors seldom meet, and the number of tables follows from ``K`` and from :data:`MISSED`, the
share of pairs at exactly the asked cosine that may meet in no table. Closer pairs are missed far less.

Vectors of one cell and label are compared in double precision. A pair is counted in the first table in which it shares a
cell: a row carries its cells in all tables, so every comparing task sees which that is. Cells with more than
:data:`CHUNK` members are cut into chunks, and every two chunks meet in a task of their own; a task returns counts per
member and a forest of links, never pairs. Small cells are compared many to a task.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and those with a null label,
link with nothing; shorter vectors are filled up with zeros; repeated rows are vectors of their own and link with each
other; a component's id is the smallest ``vec_id`` in it (null when all are null); a row is kept if its ``vec_id`` is that
id, null ids included; other columns are neither read nor returned.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve.llm import bytetext
from codesieve.llm.components import components
from codesieve.llm.store import Store

COSINE = 0.98
#: Share of pairs at exactly the asked cosine that may stay unfound.
MISSED = 1e-7
#: Width of a piece of a projection, in distances of the asked cosine.
WIDTH = 10.0
#: Members of a cell that are compared with as many others in one task.
CHUNK = 1024
#: Rows that a comparing task gets at least, made up of many cells.
TASK_ROWS = 8192
HASHED = "node long, size long, label long, vector binary, cells array<long>"


def collision(distance: float, width: float) -> float:
    """Probability that vectors at ``distance`` fall into the same piece of one projection."""
    ratio = width / distance
    normal = 0.5 * (1 + math.erf(-ratio / math.sqrt(2)))
    return 1 - 2 * normal - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-(ratio**2) / 2))


def plan(vectors: int, cosine: float, missed: float = MISSED) -> tuple[float, int, int]:
    """Width of a piece, projections of a table and number of tables."""
    near = math.sqrt(2 - 2 * cosine)
    width = WIDTH * near
    projections = max(4, math.ceil(math.log(max(2, vectors)) / -math.log(collision(math.sqrt(2), width))))
    met = collision(near, width) ** projections
    return width, projections, max(1, math.ceil(math.log(missed) / math.log(1 - met)))


def _normalised(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors of length one, filled up to ``dims`` components."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dims))
    out[np.arange(dims) < sizes[:, None]] = column.flatten().to_numpy()
    # The largest component first, so that squares neither overflow nor vanish.
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def _hasher(dims: int, width: float, projections: int, tables: int, seed: int) -> Callable:
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.default_rng(seed)
        normal = draw.standard_normal((dims, tables * projections))
        shift = draw.random(tables * projections) * width
        for batch in batches:
            if not len(batch):
                continue
            vectors = _normalised(batch.column("embedding"), dims)
            pieces = np.floor((vectors @ normal + shift) / width).astype(np.int64).view(np.uint64)
            pieces = pieces.reshape(len(batch), tables, projections)
            label = batch.column("label").to_numpy().view(np.uint64)
            cells = bytetext.mix(label[:, None] + np.arange(tables, dtype=np.uint64) * bytetext._P)
            for k in range(projections):
                cells = bytetext.mix(cells * bytetext._R + pieces[:, :, k])
            offsets = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * tables)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("node", "size", "label")),
                    pa.array([v.tobytes() for v in vectors], pa.binary()),
                    pa.ListArray.from_arrays(offsets, pa.array(bytetext.to_long(cells.ravel()))),
                ],
                ["node", "size", "label", "vector", "cells"],
            )

    return hashed


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the links ``a, b`` connect, one fewer than nodes in each component."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = x = root.get(up, up)
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        first, second = find(x), find(y)
        if first != second:
            root[second] = first
            kept.append((x, y))
    return kept


def _comparer(cosine: float) -> Callable:
    """Links of a task's cells: rows with ``b`` null say how many vectors ``a`` is linked with, the others are links."""

    def blocks(table: pa.Table) -> Iterator[np.ndarray]:
        cell, left, right = (table.column(c).to_numpy() for c in ("cell", "left", "right"))
        order = np.lexsort((right, left, cell))
        change = np.zeros(len(order), bool)
        for key in (cell, left, right):
            change[1:] |= key[order][1:] != key[order][:-1]
        return np.split(order, np.flatnonzero(change))

    def compare(table: pa.Table) -> pa.Table:
        vectors = np.stack([np.frombuffer(v) for v in table.column("vector").to_pylist()])
        cells = np.stack(table.column("cells").to_pylist())
        node, size, place, chunk, left, right = (
            table.column(c).to_numpy() for c in ("node", "size", "place", "chunk", "left", "right")
        )
        label = table.column("label").to_numpy()
        linked = np.zeros(len(node), np.int64)
        forest: list[tuple[int, int]] = []
        for rows in blocks(table):
            across = left[rows[0]] != right[rows[0]]
            mine = rows[chunk[rows] == left[rows]] if across else rows
            theirs = rows[chunk[rows] == right[rows]] if across else rows
            if not len(mine) or not len(theirs):
                continue
            near = vectors[mine] @ vectors[theirs].T >= cosine
            near &= label[mine][:, None] == label[theirs]
            if not across:
                near &= np.arange(len(mine))[:, None] < np.arange(len(theirs))
            x, y = np.nonzero(near)
            x, y = mine[x], theirs[y]
            for some in range(0, len(x), 1 << 16):
                a, b = x[some : some + (1 << 16)], y[some : some + (1 << 16)]
                first = (cells[a] == cells[b]).argmax(axis=1) == place[a]
                a, b = a[first], b[first]
                np.add.at(linked, a, size[b])
                np.add.at(linked, b, size[a])
                forest += _forest(node[a], node[b])
        some = np.flatnonzero(linked)
        a, b = zip(*forest) if forest else ((), ())
        return pa.table(
            {
                "a": pa.array([*node[some].tolist(), *a], pa.int64()),
                "b": pa.array([*[None] * len(some), *b], pa.int64()),
                "linked": pa.array([*linked[some].tolist(), *[None] * len(forest)], pa.int64()),
            }
        )

    return compare


def near_copies(vectors: DataFrame, cosine: float = COSINE, missed: float = MISSED, seed: int = 12) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (``vec_id, embedding, label``). Runs jobs when called."""
    store = Store(vectors.sparkSession, "near-vectors")
    finite = lambda x: x.isNotNull() & (F.abs(x) < float("inf"))
    able = F.col("label").isNotNull() & F.exists("embedding", lambda x: x != 0) & F.forall("embedding", finite)
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    rows = rows.withColumn("able", F.coalesce(able, F.lit(False)))
    same = ["label", "key_a", "key_b"]
    rows = rows.withColumn("key_a", F.xxhash64("embedding")).withColumn("key_b", F.xxhash64(F.lit(1), "embedding"))
    rows = store.keep(rows, "rows")
    good = rows.where("able")
    classes = good.groupBy(*same).agg(F.min("row").alias("node"), F.count("*").alias("size"))
    classes = store.keep(classes, "classes")
    count = classes.count()
    dims = good.agg(F.max(F.size("embedding"))).first()[0] or 1
    width, projections, tables = plan(count, cosine, missed)
    heads = good.select(F.col("row").alias("node"), "embedding").join(classes, "node").select("node", "size", "label", "embedding")
    hashed = store.keep(heads.mapInArrow(_hasher(dims, width, projections, tables, seed), HASHED), "hashed")

    # Cells with two members or more, in chunks that are drawn by node.
    places = hashed.select("node", F.posexplode("cells").alias("place", "cell"))
    chunks = F.ceil(F.col("members") / CHUNK).cast("long").alias("chunks")
    shared = places.groupBy("cell").agg(F.count("*").alias("members")).where("members > 1").select("cell", chunks)
    placed = places.join(shared, "cell").withColumn("chunk", F.pmod(F.xxhash64("node", "cell"), F.col("chunks")))
    meets = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    placed = placed.withColumn("other", meets)
    placed = placed.select(
        "node", "place", "cell", "chunk", F.least("chunk", "other").alias("left"), F.greatest("chunk", "other").alias("right")
    )
    placed = store.keep(placed, "placed")
    tasks = max(1, placed.count() // TASK_ROWS)
    task = F.pmod(F.xxhash64("cell", "left", "right"), F.lit(tasks)).alias("task")
    grouped = placed.select("*", task).join(hashed, "node").groupBy("task")
    found = store.keep(grouped.applyInArrow(_comparer(cosine), "a long, b long, linked long"), "found")
    store.drop("placed")

    links = found.where("b IS NOT NULL").select("a", "b")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("linked").alias("linked"))
    labels = store.keep(components(links, store, "components").withColumnRenamed("label", "component"), "labels")
    told = classes.join(counts, "node", "left").join(labels, "node", "left")
    told = told.withColumn("component", F.coalesce("component", "node"))
    told = told.withColumn("n_links", F.coalesce("linked", F.lit(0)) + F.col("size") - 1).select(*same, "component", "n_links")
    ids = rows.select("row", "vec_id", *same, "able")
    members = ids.where("able").join(told, same).select("vec_id", "component", "n_links")
    members = store.keep(members, "members")
    least = members.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    joined = members.join(least, "component").select("vec_id", "n_links", "component_id")
    alone = ids.where(~F.col("able")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
