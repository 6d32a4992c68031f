"""Self-join of documents by Jaccard similarity of word shingles, with adaptive multi-match prefixes.

Shingles are ordered by how many sets hold them, rarest first, then by their hash. The frequencies come from a sketch
of fixed size (counters over all documents, of which the binary logarithms are kept): it decides what a join
costs, never what it finds, for any one order of all shingles is exact. A document of ``n`` shingles whose partners must share ``o`` of them can only
have partners that share at least ``l`` shingles within its first ``n - o + l`` (and theirs): the prefix may be
lengthened, and then more matches may be asked for. Every document's stored prefix is indexed; how much of it a document
looks up, it decides by its estimated cost. Looking up costs the lengths of the lists its shingles stand in, verifying
costs its size times the candidates, of which there are at most the listed matches divided by the matches asked for. A
prefix lengthened to ``l`` matches may leave its ``k < l`` longest lists aside and ask for the other ``l - k``: so a
document with common shingles in its prefix lengthens it until it can do without them.

Large groups are never spelled out in pairs:

* Documents with equal shingle sets are one class with one representative; only representatives are joined.
* Every shingle's list is first linked to one pivot, the most central member, if it holds a third of those stored shingles
  of a member that stand in other sets too. The components of these unverified links are *clusters*.
* Within a cluster, members are first verified against their pivots and closed to components. What is left in different
  components is compared chunk by chunk: a task gets two chunks of bounded size, counts shared shingles in an inverted
  index and returns verified links only. A cluster whose members are all linked with its pivot costs nothing here.
* Across clusters, matches are looked up in the lists: the clusters in a list are paired before their members are.

Each pair is verified on all shingles of both texts. The links found connect the same documents as all pairs of
similar documents would.

Defined results: a text of fewer words than a shingle has is one shingle; null and empty texts have no shingles and
their row is a component of its own; repeated rows are members of one class; a component's id is the smallest
``doc_id`` in it (null when all are null); other columns are neither read nor returned.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesieve.llm import bytetext
from codesieve.llm.components import components
from codesieve.llm.store import Store

WORDS = 5
PERCENT = 80
#: A document joins the cluster of a pivot that holds one in so many of its shared stored shingles.
PIVOT_SHARE = 3
#: Documents of a cluster that are compared with as many others in one task.
CHUNK = 256
#: Counters of the frequency sketch, and those in a piece of it that travels by itself.
COUNTERS, PIECE = 1 << 23, 1 << 17
#: What a task counts to, at most.
MOST = 255
#: Shingles of this class (a power of two of sets) and above are listed in two steps; lists of the others are short.
HEAVY = 8
SKETCH = "row long, doc_id long, text_key long, n int, set_a long, set_b long, light int, tokens array<long>"
INDEX = "node long, n int, stored int, central int, token long, place int"
PROBES = "node long, n int, label long, ask int, token long"


def required(n, percent: int):
    """Shingles that a partner of a document with ``n`` must share with it: ``ceil(n * percent / 100)``."""
    return -(-n * percent // 100)


def prefix_length(n: int, percent: int) -> int:
    """Shingles of the shortest prefix, which has to share one."""
    return n - required(n, percent) + 1


def stored_length(n: int, percent: int) -> int:
    """Shingles of the longest prefix, which is indexed."""
    need = prefix_length(n, percent)
    return min(n, need + max(8, need // 4))


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text. ASCII letters count as small ones."""
    for part in bytetext.slices(column):
        data = bytetext.LOWER[part.data]
        begin, stop = bytetext.word_bounds(part, ~bytetext.IS_SPACE[data])
        hashes = bytetext.word_hashes(data, begin, stop)
        windows = bytetext.window_hashes(hashes, words)
        low, high = np.searchsorted(begin, part.starts), np.searchsorted(begin, part.ends)
        for a, b in zip(low.tolist(), high.tolist()):
            if b - a >= words:
                yield np.unique(windows[a : b - words + 1])
            elif b > a:
                yield bytetext.window_hashes(hashes[a:b], b - a) ^ np.uint64(b - a)
            else:
                yield np.zeros(0, np.uint64)


def _set_keys(shingles: np.ndarray) -> tuple[int, int]:
    """Two sums that together name the set."""
    first = bytetext.mix(shingles)
    sums = np.array([first.sum(dtype=np.uint64), bytetext.mix(first + np.uint64(1)).sum(dtype=np.uint64)])
    return tuple(sums.view(np.int64).tolist())


def _slots(shingles: np.ndarray) -> np.ndarray:
    """The counter of each shingle."""
    return ((shingles * bytetext._P) >> np.uint64(64 - int(math.log2(COUNTERS)))).view(np.int64)


def _counter(words: int) -> Callable:
    """How many sets hold the shingles of each counter, up to :data:`MOST` in a task, in pieces."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.uint32)
        held, size = [], 0
        for batch in batches:
            for shingles in shingle_sets(batch.column("text"), words):
                held.append(shingles)
                size += len(shingles)
                if size >= COUNTERS // 4:
                    counts += np.bincount(_slots(np.concatenate(held)), minlength=COUNTERS).astype(np.uint32)
                    held, size = [], 0
        if size:
            counts += np.bincount(_slots(np.concatenate(held)), minlength=COUNTERS).astype(np.uint32)
        pieces = np.minimum(counts, MOST).astype(np.uint8).reshape(-1, PIECE)
        some = np.flatnonzero(pieces.any(axis=1))
        task = pa.array(np.full(len(some), TaskContext.get().partitionId()))
        data = pa.array([pieces[k].tobytes() for k in some.tolist()], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(some), task, data], ["piece", "task", "counts"])

    return count


def _summed(kind: type, last: bool) -> Callable:
    """The sums of a piece's counts, in the end their binary logarithms."""

    def total(table: pa.Table) -> pa.Table:
        counts = np.zeros(PIECE, np.uint32)
        for data in table.column("counts").to_pylist():
            counts += np.frombuffer(data, kind)
        data = np.frexp(counts.astype(np.float64))[1].astype(np.uint8) if last else counts
        return pa.table({"piece": table.column("piece")[:1], "task": table.column("task")[:1], "counts": [data.tobytes()]})

    return total


def frequency_classes(docs: DataFrame, words: int) -> np.ndarray:
    """The binary logarithms of the counters over all rows of ``docs``: a sketch of fixed size.

    Tasks count for themselves; their counters are summed in two steps, so that no task gets those of all others.
    """
    schema = "piece long, task long, counts binary"
    pieces = docs.select("text").mapInArrow(_counter(words), schema)
    some = pieces.groupBy("piece", F.floor(F.col("task") / 64).alias("part")).applyInArrow(_summed(np.uint8, False), schema)
    whole = some.groupBy("piece").applyInArrow(_summed(np.uint32, True), schema).toArrow()
    classes = np.zeros((COUNTERS // PIECE, PIECE), np.uint8)
    for piece, data in zip(whole.column("piece").to_pylist(), whole.column("counts").to_pylist()):
        classes[piece] = np.frombuffer(data, np.uint8)
    return classes.ravel()


def _rarest_first(shingles: np.ndarray, classes: np.ndarray, length: int) -> tuple[np.ndarray, int]:
    """The first shingles of a set (sorted by hash) in the order of all sets: by frequency class, then by hash; how many of
    them are below :data:`HEAVY`."""
    known = classes[_slots(shingles)]
    order = np.argsort(known, kind="stable")[:length]
    return shingles[order], int((known[order] < HEAVY).sum())


def _sketcher(words: int, percent: int, classes: Broadcast) -> Callable:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, heads, light = [], [], [], []
            for shingles in shingle_sets(batch.column("text"), words):
                n = len(shingles)
                sizes.append(n)
                keys.append(_set_keys(shingles))
                head, few = _rarest_first(shingles, classes.value, stored_length(n, percent))
                heads.append(head)
                light.append(few)
            offsets = np.concatenate([[0], np.cumsum([len(h) for h in heads])]).astype(np.int32)
            tokens = bytetext.to_long(np.concatenate(heads)) if heads else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(sizes, pa.int32()),
                    pa.array([k[0] for k in keys], pa.int64()),
                    pa.array([k[1] for k in keys], pa.int64()),
                    pa.array(light, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens)),
                ],
                ["row", "doc_id", "text_key", "n", "set_a", "set_b", "light", "tokens"],
            )

    return sketch


def _adapter(percent: int) -> Callable:
    """Chooses what each document looks up from the lists its stored shingles stand in, less its own cluster's members."""

    def choose(n: int, places: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, int]:
        """The shingles to look up, and the matches to ask for."""
        # The smallest partner has the shortest stored prefix, so both reach what it reaches.
        least = required(n, percent)
        reach = stored_length(least, percent) - prefix_length(least, percent) + 1
        best = (np.inf, np.zeros(0, np.int64), 1)
        for matches in sorted({1, max(1, reach // 4), max(1, reach // 2), reach}):
            inside = np.flatnonzero(places < prefix_length(n, percent) + matches - 1)
            inside = inside[np.argsort(lengths[inside], kind="stable")]
            listed = np.concatenate([[0], np.cumsum(lengths[inside] - 1)])
            aside = np.arange(min(matches, len(inside) + 1))
            listed, ask = listed[len(inside) - aside], matches - aside
            cost = listed + n * listed / ask
            k = int(cost.argmin())
            if cost[k] < best[0]:
                best = (cost[k], inside[: len(inside) - k], matches - k)
        return best[1], best[2]

    def adapt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, offsets, flat = _hits(batch)
            place, length, token = (flat.field(f).to_numpy() for f in ("place", "length", "token"))
            found, asks = [], np.ones(len(counts), np.int32)
            for i, n in enumerate(batch.column("n").to_pylist()):
                here = slice(offsets[i], offsets[i + 1])
                chosen, asks[i] = choose(n, place[here], length[here])
                found.append(offsets[i] + chosen)
            sizes = [len(f) for f in found]
            again = lambda values: pa.array(np.repeat(values, sizes))
            at = np.concatenate(found) if found else np.zeros(0, np.int64)
            own = [again(batch.column(c).to_numpy()) for c in ("node", "n", "label")]
            yield pa.RecordBatch.from_arrays([*own, again(asks), pa.array(token[at])], ["node", "n", "label", "ask", "token"])

    return adapt


def _hits(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.StructArray]:
    """Lengths, offsets and elements of the lists in ``hits``."""
    hits = batch.column("hits")
    offsets = hits.offsets.to_numpy()
    return np.diff(offsets), offsets - offsets[0], hits.flatten()


def _centrality(percent: int) -> Callable:
    """Index rows with how long the lists of a document's stored shingles are on average, as logarithms."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, offsets, flat = _hits(batch)
            place, length, token = (flat.field(f) for f in ("place", "length", "token"))
            sums = np.concatenate([[0], np.cumsum(np.log2(length.to_numpy()))])
            # Edits stand first and in no other set: the shared shingles alone tell how close two sets may be.
            stored = counts.astype(np.int32)
            lengths = [stored_length(n, percent) for n in batch.column("n").to_pylist()]
            central = ((sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(lengths, 1) * 1_000_000).astype(np.int32)
            again = lambda values: pa.array(np.repeat(values, counts))
            yield pa.RecordBatch.from_arrays(
                [*[again(batch.column(c).to_numpy()) for c in ("node", "n")], again(stored), again(central), token, place],
                ["node", "n", "stored", "central", "token", "place"],
            )

    return measure


def _verifier(percent: int) -> Callable:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [[np.frombuffer(s, np.uint64) for s in batch.column(c).to_pylist()] for c in ("set_a", "set_b")]
            linked = []
            for x, y in zip(*sets):
                shared = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(
                pa.array(linked, pa.bool_())
            )

    return verify


def _chunk_verifier(percent: int) -> Callable:
    """Links between the documents of two chunks, or of one with itself."""

    def pairs(table: pa.Table) -> Iterator[tuple[int, int]]:
        node, label, chunk, left = (table.column(c).to_numpy() for c in ("node", "label", "chunk", "left"))
        sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
        sizes = np.array([len(s) for s in sets])
        shingle, number = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), sizes)
        by = np.argsort(number, kind="stable")
        cuts = np.searchsorted(number[by], np.arange(len(shingle) + 1))
        holders = owner[by]
        lengths = np.diff(cuts)
        starts = np.cumsum(sizes) - sizes
        for a in np.flatnonzero(chunk == left).tolist():
            mine = number[starts[a] : starts[a] + sizes[a]]
            count = lengths[mine]
            at = np.repeat(cuts[mine] - np.cumsum(count) + count, count) + np.arange(count.sum())
            shared = np.bincount(holders[at], minlength=len(sets))
            linked = (100 * shared >= percent * (sizes + sizes[a] - shared)) & (label != label[a])
            for b in np.flatnonzero(linked).tolist():
                yield node[a], node[b]

    def verify(table: pa.Table) -> pa.Table:
        found = [(min(a, b), max(a, b)) for a, b in pairs(table)]
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return verify


def _set_packer(words: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets(batch.column("text"), words)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "shingles"])

    return write


class Join:
    """One run over ``docs`` (``doc_id, text``): classes, links between their representatives, components."""

    def __init__(self, docs: DataFrame, words: int = WORDS, percent: int = PERCENT):
        self.words, self.percent = words, percent
        self.store = Store(docs.sparkSession, "jaccard")
        text_key = F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_key")
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key)
        numbered = self.docs.withColumn("row", F.monotonically_increasing_id())
        classes = docs.sparkSession.sparkContext.broadcast(frequency_classes(self.docs, words))
        self.sketch = self.store.keep(numbered.mapInArrow(_sketcher(words, percent, classes), SKETCH), "sketch")
        # The table is written: no task asks for the classes again.
        classes.destroy()
        same = ["n", "set_a", "set_b"]
        sets = self.sketch.where("n > 0")
        self.classes = sets.groupBy(*same).agg(F.min("row").alias("node"))
        heads = sets.groupBy(*same).agg(F.min("row").alias("node"), F.first(F.struct("light", "tokens")).alias("head"))
        self.index = self.store.keep(self._index(heads.select("node", "n", "head.light", "head.tokens")), "index")

    def _similar_size(self, a: str, b: str) -> Column:
        return 100 * F.least(a, b) >= self.percent * F.greatest(a, b)

    def _index(self, nodes: DataFrame) -> DataFrame:
        """The stored shingles of every representative that some other one has stored too."""
        # The most similar set that is another one has a single shingle more.
        able = nodes.where(100 * F.col("n") >= self.percent * (F.col("n") + 1))
        # Below MOST the sketch never counts too few: a list of light shingles has less than 2 ** (HEAVY - 1) members, and is
        # counted where it is gathered. Heavy ones may stand in any number of sets; they are counted first and then joined.
        split = F.least("light", F.size("tokens"))
        rows = able.select("node", "n", F.posexplode(F.slice("tokens", F.lit(1), split)).alias("place", "token"))
        light = rows.withColumn("length", F.count("*").over(Window.partitionBy("token"))).where("length > 1")
        rest = F.slice("tokens", split + 1, F.size("tokens"))
        rows = able.where(F.size("tokens") > split).select("node", "n", "light", F.posexplode(rest).alias("after", "token"))
        rows = rows.select("node", "n", (F.col("light") + F.col("after")).alias("place"), "token")
        lists = rows.groupBy("token").agg(F.count("*").alias("length")).where("length > 1")
        columns = ["node", "n", "place", "token", "length"]
        hits = light.select(columns).unionByName(rows.join(lists, "token").select(columns)).groupBy("node", "n")
        listed = hits.agg(F.collect_list(F.struct("place", "length", "token")).alias("hits"))
        return listed.mapInArrow(_centrality(self.percent), INDEX)

    def _star_pairs(self) -> DataFrame:
        """Every member of a shingle's list with the pivot of the list, if they share enough of their stored prefixes.

        The pivot is the member whose own shingles stand in the longest lists: among copies that were each edited
        a little, the one they were made from, which is closer to all of them than they are to each other.
        """
        place = F.struct("central", F.xxhash64("node").alias("draw"), F.col("node").alias("pivot"), F.col("n").alias("pivot_n"))
        pivots = self.index.groupBy("token").agg(F.max(place).alias("p"))
        met = self.index.join(pivots, "token").where("node <> p.pivot")
        met = met.where(self._similar_size("n", "p.pivot_n"))
        shared = met.groupBy("node", F.col("p.pivot").alias("pivot"), "n", "stored").agg(F.count("*").alias("shared"))
        most = shared.where(PIVOT_SHARE * F.col("shared") >= F.col("stored"))
        return most.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()

    def _cluster_links(self, clusters: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
        """Verified links within clusters, between components: chunks with a document outside its cluster's largest
        component, against all chunks of the cluster."""
        members = clusters.select("node", F.col("label").alias("cluster")).join(labels, "node", "left")
        members = members.withColumn("label", F.coalesce("label", "node"))
        sizes = members.groupBy("cluster", "label").agg(F.count("*").alias("size"))
        largest = sizes.groupBy("cluster").agg(F.max(F.struct("size", "label")).alias("top"), F.count("*").alias("labels"))
        mixed = largest.where("labels > 1").select("cluster", F.col("top.label").alias("top"))
        members = members.join(mixed, "cluster").withColumn("inside", (F.col("label") == F.col("top")).cast("int"))
        # Members of the largest component are numbered after the others, in chunks of their own.
        parts = members.groupBy("cluster", "inside").agg(F.count("*").alias("rows"))
        chunks = F.greatest(F.lit(1), F.ceil(F.col("rows") / CHUNK)).cast("long")
        counts = parts.groupBy("cluster").agg(
            F.coalesce(F.max(F.when(F.col("inside") == 0, chunks)), F.lit(0)).alias("outside_chunks"),
            F.coalesce(F.max(F.when(F.col("inside") == 1, chunks)), F.lit(0)).alias("inside_chunks"),
        )
        draw = F.xxhash64("node", F.lit(7))
        placed = members.join(counts, "cluster").withColumn(
            "chunk",
            F.when(F.col("inside") == 0, F.pmod(draw, F.col("outside_chunks"))).otherwise(
                F.col("outside_chunks") + F.pmod(draw, F.col("inside_chunks"))
            ),
        )
        # An outside chunk meets itself, the outside chunks after it and all inside chunks.
        own = F.col("chunk") < F.col("outside_chunks")
        last = F.col("outside_chunks") + F.col("inside_chunks") - 1
        as_left = F.when(own, F.transform(F.sequence(F.col("chunk"), last), lambda r: F.struct(F.col("chunk").alias("left"), r.alias("right"))))
        earlier = F.least(F.col("chunk"), F.col("outside_chunks")) - 1
        as_right = F.when(
            earlier >= 0, F.transform(F.sequence(F.lit(0).cast("long"), earlier), lambda x: F.struct(x.alias("left"), F.col("chunk").alias("right")))
        )
        none = F.array().cast("array<struct<left:bigint,right:bigint>>")
        meets = F.concat(F.coalesce(as_left, none), F.coalesce(as_right, none))
        rows = placed.select("cluster", "node", "label", "chunk", F.explode(meets).alias("m")).select(
            "cluster", "node", "label", "chunk", "m.left", "m.right"
        )
        grouped = rows.join(sets, "node").groupBy("cluster", "left", "right")
        return self.store.keep(grouped.applyInArrow(_chunk_verifier(self.percent), "a long, b long").distinct(), "cluster-links")

    def _clusters_met(self, probes: DataFrame, listed: DataFrame) -> DataFrame:
        """``token, label_a, label_b``: a cluster that looks a list up with another one in it, only where the sizes of
        their members there leave room for a similar pair."""
        ranges = [
            df.groupBy("token", f"label_{s}").agg(F.min(f"n_{s}").alias(f"low_{s}"), F.max(f"n_{s}").alias(f"high_{s}"))
            for df, s in ((probes, "a"), (listed, "b"))
        ]
        reach = lambda high, low: 100 * F.col(high).cast("long") >= self.percent * F.col(low).cast("long")
        near = reach("high_a", "low_b") & reach("high_b", "low_a")
        met = ranges[0].join(ranges[1], "token").where((F.col("label_a") != F.col("label_b")) & near)
        return met.select("token", "label_a", "label_b")

    def _pairs_across(self, clusters: DataFrame) -> DataFrame:
        """Pairs of different clusters that share as many looked-up shingles as the one that looks them up asks for."""
        index = self.index.join(clusters, "node", "left").withColumn("label", F.coalesce("label", "node"))
        index = self.store.keep(index.select("node", "n", "label", "token", "place"), "labelled")
        self.store.drop("index")
        lists = index.groupBy("token", "label").agg(F.count("*").alias("own"))
        mixed = lists.groupBy("token").agg(F.sum("own").alias("rows"), F.count("*").alias("labels")).where("labels > 1")
        # What a document would find in a list is what other clusters have there.
        length = (F.col("rows") - F.col("own") + 1).cast("long").alias("length")
        lengths = lists.join(mixed, "token").select("token", "label", length)
        index = self.store.keep(index.join(lengths, ["token", "label"]), "mixed")
        hits = index.groupBy("node", "n", "label")
        hits = hits.agg(F.collect_list(F.struct("place", "length", "token")).alias("hits"))
        probes = self.store.keep(hits.mapInArrow(_adapter(self.percent), PROBES), "probes")
        self.store.drop("labelled")
        names = lambda side: [F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "label")]
        probes = probes.select("token", "ask", *names("a"))
        listed = index.select("token", *names("b"))
        across = self._clusters_met(probes, listed)
        met = probes.join(across, ["token", "label_a"]).join(listed, ["token", "label_b"])
        met = met.where(self._similar_size("n_a", "n_b"))
        shared = met.groupBy("node_a", "node_b", "ask").agg(F.count("*").alias("shared")).where("shared >= ask")
        return shared.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()

    def _sets(self, rows: DataFrame, name: str, size_known: bool) -> DataFrame:
        """``node, shingles`` of the representatives in ``rows`` (``row``), from their texts.

        Rows whose number follows the corpus are joined by a shuffle at every size. Few rows are written first
        (``size_known``), so that the planner may send them to the texts instead.
        """
        wanted = self.sketch.select("row", "doc_id", "text_key").join(rows.distinct(), "row")
        wanted = wanted.select(F.col("row").alias("node"), F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
        wanted = self.store.keep(wanted, f"{name}-wanted") if size_known else wanted.hint("merge")
        same = self.docs["doc_id"].eqNullSafe(wanted["_id"]) & (self.docs["text_key"] == wanted["_key"])
        texts = self.docs.join(wanted, same).select("node", "text").mapInArrow(_set_packer(self.words), "node long, shingles binary")
        return self.store.keep(texts.dropDuplicates(["node"]), f"{name}-sets")

    def _verified(self, pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
        """The pairs whose whole sets are similar."""
        met = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
        met = met.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
        links = met.select("a", "b", "set_a", "set_b").mapInArrow(_verifier(self.percent), "a long, b long")
        return self.store.keep(links, f"{name}-links")

    def links(self) -> DataFrame:
        """Verified links ``a, b`` between representatives; they connect all that similar pairs connect."""
        pairs = self.store.keep(self._star_pairs(), "star-pairs")
        clusters = self.store.keep(components(pairs, self.store, "star-clusters"), "clusters")
        sets = self._sets(clusters.select(F.col("node").alias("row")), "clusters", size_known=False)
        stars = self._verified(pairs, sets, "stars")
        inner = self._cluster_links(clusters, components(stars, self.store, "star-components"), sets)
        self.store.drop("clusters-sets")
        far = self.store.keep(self._pairs_across(clusters), "far-pairs")
        for table in ("mixed", "probes"):
            self.store.drop(table)
        nodes = far.select(F.col("a").alias("row")).union(far.select(F.col("b").alias("row")))
        across = self._verified(far, self._sets(nodes, "far", size_known=True), "far")
        return stars.unionByName(inner).unionByName(across)

    def members(self) -> DataFrame:
        """``row, doc_id, text_key, n, node, label`` for every row; node and label are null where there are no shingles."""
        labels = self.store.keep(components(self.links(), self.store, "components"), "labels")
        classes = self.classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        rows = self.sketch.drop("tokens", "light")
        return rows.join(classes, ["n", "set_a", "set_b"], "left").select("row", "doc_id", "text_key", "n", "node", "label")

    def groups(self) -> DataFrame:
        """``doc_id, n_shingles, component_id`` for every row."""
        members = self.members()
        least = members.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("least"))
        known = members.join(least, "label", "left")
        component = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("least"))
        return known.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"))


def groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``. Runs jobs when it is called."""
    return Join(docs, words, percent).groups()


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without those that a component holds besides its first one, by ``doc_id``.

    Rows without shingles stay. Of rows that repeat the first one's id and text, one stays.
    """
    join = Join(docs, words, percent)
    members = join.members()
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("text_key"))
    heads = members.where("label IS NOT NULL").groupBy("label").agg(F.min(first).alias("head"))
    repeated = (
        members.where("label IS NOT NULL").groupBy("doc_id", "text_key").agg((F.count("*") > 1).alias("again"))
    )
    kept = heads.select(F.col("head.doc_id").alias("_id"), F.col("head.text_key").alias("_key")).join(
        repeated.select(F.col("doc_id").alias("_id2"), F.col("text_key").alias("_key2"), "again"),
        F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_key") == F.col("_key2")),
    )
    bare = members.where("label IS NULL").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.lit(False).alias("again")
    )
    kept = join.store.keep(kept.select("_id", "_key", "again").unionByName(bare.distinct()), "kept")
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    same = docs["doc_id"].eqNullSafe(kept["_id"]) & (key == kept["_key"])
    met = docs.join(kept, same)
    once = met.where(~F.col("again")).select(*[docs[c] for c in docs.columns])
    again = met.where("again").dropDuplicates(["_id", "_key"]).select(*[docs[c] for c in docs.columns])
    return once.unionByName(again)
