"""Removes every byte that a 50-byte string covers which also starts in a document with a smaller id.

Equal strings are found by sorting suffixes to a depth of ``length`` bytes: deep-shallow sorting. Down to
``SHALLOW`` bytes a multikey quicksort partitions all groups of a depth at once, eight bytes at a time. Groups that are
still together are ordered by blind tries: a group's branching place is the least common prefix of its members with its
first one, only the byte there is looked at, and what lies between two branchings is never read. Members that no
branching parts are equal.

Sorting every suffix of a corpus would move fifty bytes for each byte. Two observations spare that:

* Each string's *anchor* is the place of the smallest hash of a ``GRAM``-byte gram within it, so equal strings have equal
  grams at equal places. Consecutive strings with one anchor are a *unit*.
* If the gram of an anchor stands in one and the same unit everywhere, its strings are equal where the units are. Only
  the units of grams that occur in different ones (the edges of copied passages, mostly) have their suffixes sorted.

Documents lie in blocks of some megabytes, written once. Two rounds of exchange go over all blocks: which grams occur
elsewhere, and in one unit or more; then the smallest document for every unit or distinct string that a block asks
about. A block sends each gram, unit or string once, however many of its documents hold it, and gets its answer in the
same order. So a passage that a third of all documents hold costs one entry per block, and no group of copies is
gathered anywhere. Entries are dealt to buckets by their hash. Blocks stay where they are: their table is bucketed by
block, and only answers are shuffled.

Strings and units are compared by 64-bit hashes between blocks, and by their bytes within one.

Defined results: null texts are empty; a document without an id counts as the largest and keeps its null; rows with the
same id do not take bytes from each other; texts shorter than ``length`` keep all bytes; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import struct
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve.llm.bytetext import mix, slices
from codesieve.llm.store import Store

LENGTH = 50
GRAM = 20
SHALLOW = 24
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
#: A block is worked on in pieces of so many places, which fit a processor's cache.
PIECE = 1 << 17
KEY_BITS = 48
NO_ID = np.int64(2**63 - 1)

BLOCKS = "block long, ids binary, named binary, sizes binary, data binary"
ENTRIES = "bucket int, block long, packed binary"
ANSWERS = "block long, bucket int, packed binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


# -- Suffixes of one block ------------------------------------------------------------------------------------------


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number in the order of the bytes; beyond the end they are 0."""
    padded = np.zeros(len(data) + 72, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 64,), ">u8", padded, strides=(1,)).astype(np.uint64)


def string_hashes(words: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` bytes (8 at least) from each place on."""
    total = np.full(len(places), length, np.uint64)
    for depth in [*range(0, length - 7, 8), length - 8]:
        total ^= words[places + depth]
        total *= _A
        total ^= total >> np.uint64(31)
    return mix(total)


def _runs(keys: np.ndarray) -> np.ndarray:
    """Whether a value differs from the one before."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return new


def sort_suffixes(words: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes at ``places`` by their first ``length`` bytes, and the class of equal ones for each in it."""
    order = np.arange(len(places))
    group = np.zeros(len(places), np.int64)
    shallow = min(SHALLOW, length // 8 * 8)
    for depth in range(0, shallow, 8):  # multikey quicksort of all groups that are not single
        several = np.zeros(len(order), bool)
        several[1:] = group[1:] == group[:-1]
        several[:-1] |= several[1:]
        at = np.flatnonzero(several)
        key = words[places[order[at]] + depth]
        by = np.lexsort((key, group[at])) if depth else np.argsort(key)
        order[at] = order[at[by]]
        new = _runs(group)
        new[at] |= _runs(key[by])
        group = np.cumsum(new)
    return _blind_tries(words, places, length, shallow, order, group)


def _blind_tries(words, places, length, shallow, order, group) -> tuple[np.ndarray, np.ndarray]:
    new = _runs(group)
    several = ~new
    several[:-1] |= ~new[1:]
    open_ = np.flatnonzero(several)  # places in the order whose group may still part
    while len(open_):
        starts = new[open_]
        head = np.maximum.accumulate(np.where(starts, np.arange(len(open_)), 0))
        mine = places[order[open_]]
        lead = mine[head]
        common = np.full(len(open_), length, np.int64)
        left = np.flatnonzero(~starts)
        for depth in [*range(shallow, length - 7, 8), max(shallow, length - 8)]:
            differ = words[mine[left] + depth] ^ words[lead[left] + depth]
            parted = differ != 0
            zeros = 7 - np.floor(np.log2(np.maximum(differ[parted] >> np.uint64(0), 1).astype(np.float64))).astype(np.int64) // 8
            # Rounding to a float may name a byte too early by one; that byte is then equal and looked at again.
            shift = (np.uint64(56) - np.clip(zeros, 0, 7).astype(np.uint64) * np.uint64(8))
            early = (differ[parted] >> shift) & np.uint64(255) == 0
            common[left[parted]] = depth + np.clip(zeros, 0, 7) + early
            left = left[~parted]
        first = np.flatnonzero(starts)
        branch = np.minimum.reduceat(common, first)
        number = np.cumsum(starts) - 1
        parting = (branch < length)[number]
        keep = np.flatnonzero(parting)
        if not len(keep):
            break
        at = open_[keep]
        byte = (words[mine[keep] + branch[number[keep]]] >> np.uint64(56)).astype(np.int64)
        by = np.lexsort((byte, number[keep]))
        order[at] = order[at[by]]
        new[at] |= _runs(byte[by])
        new[at[0]] = True
        several = np.zeros(len(at), bool)
        several[1:] = ~new[at[1:]] & (at[1:] == at[:-1] + 1)
        several[:-1] |= several[1:]
        open_ = at[several]
    return order, np.cumsum(new) - 1


def _gram_hashes(first: np.ndarray, middle: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of grams from the three words that cover them."""
    total = first * _A
    total += middle
    total ^= total >> np.uint64(29)
    total *= _B
    total += last
    total ^= total >> np.uint64(32)
    total *= _A
    total ^= total >> np.uint64(29)
    return total


class Block:
    """Documents of a block, and the units of their strings."""

    def __init__(self, ids: bytes, named: bytes, sizes: bytes, data: bytes, length: int = LENGTH):
        self.length = length
        self.ids = np.frombuffer(ids, np.int64)
        self.named = np.frombuffer(named, np.bool_)
        self.sizes = np.frombuffer(sizes, np.int64)
        self.data = np.frombuffer(data, np.uint8)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.words = words_at(self.data)
        assert length - GRAM <= 32, "the words at the end of a unit must reach back to its first string"
        found = [self._units(*piece) for piece in self._pieces()]
        columns = zip(*found) if found else [np.zeros(0, np.int64)] * 4
        self.low, self.high, self.anchor, self.doc = (np.concatenate(c) if found else c for c in columns)
        self.id = self.ids[self.doc]
        # The first string and the words that end with the last one cover the unit.
        tail = [self.words[self.high + depth] for depth in range(length - 8, max(-1, length - 8 * 5), -8)]
        ranges = (self.high - self.low).astype(np.uint64) * _A + (self.anchor - self.low).astype(np.uint64) * _B
        for word in tail:
            ranges = mix(ranges ^ word)
        self.unit_hash = mix(string_hashes(self.words, self.low, length) ^ ranges)
        self.gram = self._grams(self.anchor) >> np.uint64(64 - KEY_BITS)

    def _grams(self, places) -> np.ndarray:
        return _gram_hashes(self.words[places], self.words[places + 8], self.words[places + (GRAM - 8)])

    def _pieces(self) -> Iterator[tuple[int, int]]:
        """Ranges of places: of many whole documents, or parts of a long one."""
        low = 0
        for end in self.ends.tolist():
            while end - low > PIECE:
                yield low, low + PIECE
                low += PIECE
        if low < len(self.data):
            yield low, len(self.data)

    def _units(self, low: int, high: int) -> tuple[np.ndarray, ...]:
        """Units of the strings that start in ``low .. high``: first and last start, anchor, document."""
        length, window = self.length, self.length - GRAM + 1
        reach = min(len(self.data), high + length)
        w = self.words
        grams = _gram_hashes(w[low:reach], w[low + 8 : reach + 8], w[low + GRAM - 8 : reach + GRAM - 8])
        ends = self.ends[np.searchsorted(self.ends, low, "right") : np.searchsorted(self.ends, reach, "left") + 1]
        valid = np.ones(high - low, bool)
        for back in range(1, length):  # places too near to the end of their document
            at = ends - back - low
            valid[at[(at >= 0) & (at < len(valid))]] = False
            if back < GRAM:
                grams[at[(at >= 0) & (at < len(grams))]] = np.uint64(2**64 - 1)
        least, span = grams, 1
        while span * 2 <= window:
            least, span = np.minimum(least[:-span], least[span:]), span * 2
        if span < window:
            least = np.minimum(least[: len(least) - (window - span)], least[window - span :])
        count = min(high - low, len(least))
        valid, least = valid[:count], least[:count]
        if not valid.any():
            return (np.zeros(0, np.int64),) * 4
        # A unit ends where the document does, where the smallest hash changes, or where its place is left behind.
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (least[1:] != least[:-1]) | (grams[: count - 1] == least[:-1])
        stop = valid.copy()
        stop[:-1] &= ~valid[1:] | new[1:]
        first, last = np.flatnonzero(new), np.flatnonzero(stop)
        value = least[first]
        anchor = np.full(len(first), -1)
        # The place that is left behind is the anchor; a unit that ends otherwise has it further on.
        behind = grams[last] == value
        anchor[behind] = last[behind]
        left = np.flatnonzero(~behind)
        for offset in range(window):
            if not len(left):
                break
            hit = grams[first[left] + offset] == value[left]
            anchor[left[hit]] = first[left[hit]] + offset
            left = left[~hit]
        return first + low, last + low, anchor + low, np.searchsorted(self.ends, first + low, "right")

    def asked_grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct grams in order, what a unit of each hashes to, and two flags: several units, several documents."""
        order = np.argsort(self.gram)
        gram, unit, doc = self.gram[order], self.unit_hash[order], self.doc[order]
        at = np.flatnonzero(_runs(gram)) if len(gram) else np.zeros(0, np.int64)
        if not len(at):
            return gram, unit.astype(np.uint32), np.zeros(0, np.uint8)
        least = np.minimum.reduceat(unit, at)
        several = least != np.maximum.reduceat(unit, at)
        shared = np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at)
        return gram[at], (least >> np.uint64(32)).astype(np.uint32), (several * 2 + shared).astype(np.uint8)

    def asked_strings(self, grams: np.ndarray, flags: np.ndarray) -> Questions:
        """What to ask about, given the answers to :meth:`asked_grams`."""
        of = flags[np.searchsorted(grams, self.gram)]
        return Questions(self, np.flatnonzero(of == 1), np.flatnonzero(of >= 2))


class Questions:
    """The units that stand alone for their gram, and the strings of the others, as distinct keys with smallest ids."""

    def __init__(self, block: Block, single: np.ndarray, several: np.ndarray):
        self.block, self.single = block, single
        counts = block.high[several] - block.low[several] + 1
        before = np.cumsum(counts) - counts
        self.places = np.repeat(block.low[several] - before, counts) + np.arange(counts.sum())
        self.place_ids = np.repeat(block.id[several], counts)
        order, group = sort_suffixes(block.words, self.places, block.length)
        self.string = np.zeros(len(order), np.int64)
        self.string[order] = group
        at = np.flatnonzero(_runs(group)) if len(group) else group
        least = np.minimum.reduceat(self.place_ids[order], at) if len(at) else self.place_ids
        strings = string_hashes(block.words, self.places[order[at]], block.length)
        units, self.unit = np.unique(block.unit_hash[single], return_inverse=True)
        unit_least = np.full(len(units), NO_ID)
        np.minimum.at(unit_least, self.unit, block.id[single])
        keys = np.concatenate([strings, units ^ _B])
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.least = np.concatenate([least, unit_least])[self.order]

    def covered(self, least: np.ndarray) -> np.ndarray:
        """Which bytes go, given the smallest id anywhere for each key."""
        block = self.block
        answer = np.empty(len(least), np.int64)
        answer[self.order] = least
        strings = len(answer) - (int(self.unit.max()) + 1 if len(self.unit) else 0)
        steps = np.zeros(len(block.data) + 1, np.int32)
        gone = self.places[answer[:strings][self.string] < self.place_ids] if len(self.places) else self.places
        np.add.at(steps, gone, 1)
        np.add.at(steps, gone + block.length, -1)
        units = self.single[answer[strings:][self.unit] < block.id[self.single]] if len(self.single) else self.single
        np.add.at(steps, block.low[units], 1)
        np.add.at(steps, block.high[units] + block.length, -1)
        return np.cumsum(steps[:-1]) > 0


# -- Packing --------------------------------------------------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, byte by byte of their numbers, compressed."""
    planes = [a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays]
    return struct.pack("<q", len(arrays[0])) + zstandard.ZstdCompressor(1).compress(b"".join(planes))


def unpack(packed: bytes, *kinds) -> list[np.ndarray]:
    (count,) = struct.unpack_from("<q", packed)
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[8:]), np.uint8)
    out, at = [], 0
    for kind in kinds:
        size = np.dtype(kind).itemsize
        plane = flat[at : at + count * size].reshape(size, count)
        out.append(np.ascontiguousarray(plane.T).view(kind).reshape(count))
        at += count * size
    return out


def _steps(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as differences, which are small."""
    return np.diff(keys, prepend=keys[:0].dtype.type(0))


def _bucket_cuts(keys: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    edges = [min((k << bits) // buckets, (1 << 64) - 1) for k in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]]).astype(np.int64)


def _entries(block: int, buckets: int, bits: int, keys: np.ndarray, *values: np.ndarray) -> pa.RecordBatch:
    cuts = _bucket_cuts(keys, buckets, bits)
    used = [b for b in range(buckets) if cuts[b + 1] > cuts[b]]
    packed = [
        pack(_steps(keys[cuts[b] : cuts[b + 1]]), *[v[cuts[b] : cuts[b + 1]] for v in values]) for b in used
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array([block] * len(used), pa.int64()), pa.array(packed, pa.binary())],
        ["bucket", "block", "packed"],
    )


def _answers(answers: list[dict] | None, *kinds) -> list[np.ndarray]:
    """A block's answers in the order of its keys."""
    parts = [unpack(a["packed"], *kinds) for a in sorted(answers or (), key=lambda a: a["bucket"])]
    return [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, k) for k in kinds]


# -- Stages ---------------------------------------------------------------------------------------------------------


def _packer(block_bytes: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        texts: list[bytes] = []
        size = 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([np.array([NO_ID if i is None else i for i in ids], np.int64).tobytes()], pa.binary()),
                    pa.array([np.array([i is not None for i in ids], np.bool_).tobytes()], pa.binary()),
                    pa.array([np.array([len(t) for t in texts], np.int64).tobytes()], pa.binary()),
                    pa.array([b"".join(texts)], pa.binary()),
                ],
                ["block", "ids", "named", "sizes", "data"],
            )

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for part in slices(batch.column("text")):
                for k, (start, end) in enumerate(zip(part.starts.tolist(), part.ends.tolist())):
                    if texts and size + end - start > block_bytes:
                        yield block()
                        number, ids, texts, size = number + 1, [], [], 0
                    ids.append(names[part.first + k])
                    texts.append(part.data[start:end].tobytes())
                    size += end - start
        if texts:
            yield block()

    return write


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, Block, list, list]]:
    for row in batch.to_pylist():
        block = Block(row["ids"], row["named"], row["sizes"], row["data"])
        yield row["block"], block, row.get("grams"), row.get("least")


def _ask_grams(buckets: int) -> Callable:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, block, _, _ in _rows(batch):
                yield _entries(number, buckets, KEY_BITS, *block.asked_grams())

    return ask


def _gathered(table: pa.Table, *kinds) -> tuple[list, list[np.ndarray], np.ndarray]:
    blocks = table.column("block").to_pylist()
    parts = [unpack(p, *kinds) for p in table.column("packed").to_pylist()]
    keys = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
    values = [np.concatenate([p[i] for p in parts]) for i in range(1, len(kinds))]
    cuts = np.cumsum([len(p[0]) for p in parts])
    return blocks, [keys, *values], cuts


def _returned(table: pa.Table, blocks: list, answer: np.ndarray, cuts: np.ndarray) -> pa.Table:
    bucket = table.column("bucket")[0].as_py()
    packed = [pack(a) for a in np.split(answer, cuts[:-1])]
    return pa.table({"block": pa.array(blocks, pa.int64()), "bucket": pa.array([bucket] * len(blocks), pa.int32()), "packed": pa.array(packed, pa.binary())})


def _tell_grams(table: pa.Table) -> pa.Table:
    """For each gram asked about: 0 in one place only, 1 in one and the same unit everywhere, 2 in several units."""
    blocks, (keys, unit, flags), cuts = _gathered(table, np.uint64, np.uint32, np.uint8)
    order = np.argsort(keys, kind="stable")
    at = np.flatnonzero(_runs(keys[order]))
    unit, flags = unit[order], flags[order]
    several = (np.minimum.reduceat(unit, at) != np.maximum.reduceat(unit, at)) | (np.maximum.reduceat(flags, at) >= 2)
    shared = (np.diff(np.append(at, len(order))) > 1) | (np.maximum.reduceat(flags & 1, at) > 0)
    answer = np.empty(len(order), np.uint8)
    answer[order] = np.repeat(np.where(shared, 1 + several, 0).astype(np.uint8), np.diff(np.append(at, len(order))))
    return _returned(table, blocks, answer, cuts)


def _tell_least(table: pa.Table) -> pa.Table:
    """For each unit or string asked about, how far the smallest id anywhere lies below the block's own."""
    blocks, (keys, least), cuts = _gathered(table, np.uint64, np.int64)
    order = np.argsort(keys, kind="stable")
    at = np.flatnonzero(_runs(keys[order]))
    smallest = np.minimum.reduceat(least[order], at)
    answer = np.empty(len(order), np.int64)
    answer[order] = np.repeat(smallest, np.diff(np.append(at, len(order))))
    return _returned(table, blocks, least - answer, cuts)


def _questions(block: Block, answers: list[dict] | None) -> Questions:
    return block.asked_strings(block.asked_grams()[0], _answers(answers, np.uint8)[0])


def _ask_least(buckets: int) -> Callable:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, block, grams, _ in _rows(batch):
                questions = _questions(block, grams)
                yield _entries(number, buckets, 64, questions.keys, questions.least)

    return ask


def _cleaner(texts: bool) -> Callable:
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, block, grams, least in _rows(batch):
                questions = _questions(block, grams)
                gone = questions.covered(questions.least - _answers(least, np.int64)[0])
                rows = []
                for k, (start, end) in enumerate(zip(block.starts.tolist(), block.ends.tolist())):
                    cut = gone[start:end]
                    kept = block.data[start:end][~cut].tobytes()
                    spans = int((cut[1:] & ~cut[:-1]).sum() + cut[:1].sum())
                    name = int(block.ids[k]) if block.named[k] else None
                    digest = hashlib.sha256(kept).hexdigest()
                    rows.append((name, end - start, int(cut.sum()), spans, digest, kept if texts else None))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return clean


def dedup(
    docs: DataFrame, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES, texts: bool = False
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every row of ``docs`` (``doc_id, text``).

    ``kept`` is what is left of the text, as bytes, if ``texts`` is set. Writes blocks and answers to the shared folder
    when it is called.
    """
    spark = docs.sparkSession
    store = Store(spark, "suffixes")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    # Bucketed by block, so that a join with answers leaves the blocks where they are.
    name = f"codesieve_blocks_{uuid.uuid4().hex}"
    files = max(8, math.ceil(total / (4 * block_bytes)))
    written = rows.mapInArrow(_packer(block_bytes), BLOCKS).write.option("compression", "zstd")
    written.option("path", store.path("blocks")).bucketBy(files, "block").saveAsTable(name)
    blocks = spark.table(name)

    def answered(asked: DataFrame, tell: Callable, column: str) -> DataFrame:
        told = store.keep(asked.groupBy("bucket").applyInArrow(tell, ANSWERS), column)
        return told.groupBy("block").agg(F.collect_list(F.struct("bucket", "packed")).alias(column))

    grams = answered(blocks.mapInArrow(_ask_grams(buckets), ENTRIES), _tell_grams, "grams")
    known = blocks.join(grams, "block", "left")
    least = answered(known.mapInArrow(_ask_least(buckets), ENTRIES), _tell_least, "least")
    result = store.keep(known.join(least, "block", "left").mapInArrow(_cleaner(texts), RESULT), "result")
    spark.sql(f"DROP TABLE {name}")
    for table in ("blocks", "grams", "least"):
        store.drop(table)
    return result
