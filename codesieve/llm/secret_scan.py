"""Secret scan whose false positives a random forest takes out.

Detectors with high recall mark candidates: access-key formats, values assigned to names like ``token`` or
``password``, and long runs of key characters. Each candidate is described by its length and character make-up, by how
usual its character transitions are in the corpus, by how much of it common words of the corpus cover, by the path it
stands under and by the words next to it. A random forest trained on labelled findings gives the probability that it
is a secret.

The corpus statistics come from all texts: transitions between 29 kinds of characters, and the most frequent short
words, of which ``DICTIONARY_WORDS`` are sent to all executors. The forest is trained on at most ``TRAIN_ROWS``
labelled findings, drawn by hash.

:func:`labelled` makes labelled findings where a corpus has none of its own: findings of the strict formats are
secrets; so are their values in the places of ordinary words; ordinary words of the corpus, put together and set in the
places of secrets or left where they are, and fill-in values are not.

Results name secrets by SHA-256 only. Defined results: null and empty texts have no candidates; a null path is empty;
rows with the same id are scanned one by one; candidates of repeated rows are repeated; without labelled findings of
both kinds there is no forest, and every candidate stays with a null probability; other columns are not read.
"""

from __future__ import annotations

import hashlib
import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve.llm import bytetext
from codesieve.llm.store import Store

DICTIONARY_WORDS = 20_000
TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 40, 8, 20240

DETECTORS = (
    ("access_key", re.compile(r"(?<![A-Za-z0-9])(AKIA[0-9A-Z]{16})(?![A-Za-z0-9])")),
    (
        "assignment",
        re.compile(
            r"(?i)(?<![a-z0-9])(?:pass(?:word|wd)?|secret|token|api[_-]?key|auth)[\"']?\s*[:=]\s*[\"']?([^\s\"',;]{8,})"
        ),
    ),
    ("run", re.compile(r"(?<![A-Za-z0-9+/_=.-])((?=[A-Za-z0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{20,})")),
)
STRICT = ("access_key", "assignment")

KEY_WORDS = re.compile(r"(?i)pass|secret|token|api.?key|auth|credential|private")
FILL_WORDS = re.compile(r"(?i)example|sample|dummy|your|change|placeholder|xxx|todo|test")
CONFIG_PATH = re.compile(r"(?i)config|\.env|secret|credential|\.ya?ml|\.ini|settings")
FILLS = ("your_token_here", "changeme_changeme", "xxxxxxxxxxxxxxxxxxxx", "example-password-123", "<insert-key-here>")

FEATURES = (
    "length entropy transitions class_changes digits capitals dictionary longest_word path_depth path_test path_config "
    "key_before fill_around known_neighbours"
).split()

FINDING = "id long, path string, start int, detector string, value string, before string, after string"
LABELLED = FINDING + ", label int"
_NAMES = ["id", "path", "start", "detector", "value", "before", "after"]
_KINDS = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string()]

#: Kinds of characters: 26 letters, digit, joiner, base-64 mark; the last stands for all others.
CLASSES = 29
_CLASS = np.full(256, CLASSES, np.int64)
_CLASS[97:123] = _CLASS[65:91] = np.arange(26)
_CLASS[48:58] = 26
_CLASS[[45, 95]] = 27
_CLASS[[43, 47, 61]] = 28


def corpus_counts(docs: DataFrame) -> DataFrame:
    """``kind, key, n``: counts of character pairs and of words of three to six letters, over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = np.zeros((CLASSES + 1) ** 2, np.int64)
            found: list[np.ndarray] = []
            for part in bytetext.slices(batch.column("text")):
                kind = _CLASS[part.data]
                pairs += np.bincount(kind[:-1] * (CLASSES + 1) + kind[1:], minlength=len(pairs))
                data = bytetext.LOWER[part.data]
                begin, stop = bytetext.word_bounds(part, kind < 26)
                short = (stop - begin >= 3) & (stop - begin <= 6)
                begin, stop = begin[short], stop[short]
                packed = np.zeros(len(begin), np.int64)
                for k in range(6):
                    inside = begin + k < stop
                    packed[inside] = packed[inside] << 8 | data[begin[inside] + k]
                found.append(packed)
            words, n = np.unique(np.concatenate(found), return_counts=True) if found else (pairs[:0], pairs[:0])
            used = np.flatnonzero(pairs)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(["pair"] * len(used) + ["word"] * len(words)),
                    pa.array(np.concatenate([used, words]), pa.int64()),
                    pa.array(np.concatenate([pairs[used], n]), pa.int64()),
                ],
                ["kind", "key", "n"],
            )

    return docs.select("text").mapInArrow(count, "kind string, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


class Language:
    """What is usual in the corpus: log-probabilities of transitions, and common words."""

    def __init__(self, pairs: dict[int, int], words: set[str]):
        table = np.ones((CLASSES, CLASSES))
        for key, n in pairs.items():
            a, b = divmod(key, CLASSES + 1)
            if a < CLASSES and b < CLASSES:
                table[a, b] += n
        self.log = np.log(table / table.sum(axis=1, keepdims=True))
        self.words = words

    @classmethod
    def of(cls, docs: DataFrame, store: Store, size: int = DICTIONARY_WORDS) -> Language:
        counts = store.keep(corpus_counts(docs), "counts")
        pairs = {r["key"]: r["n"] for r in counts.where("kind = 'pair'").collect()}
        top = counts.where("kind = 'word'").orderBy(F.desc("n"), "key").limit(size).collect()
        unpack = lambda key: key.to_bytes(8, "big").lstrip(b"\0").decode()
        return cls(pairs, {unpack(r["key"]) for r in top})

    def transitions(self, value: str) -> float:
        kind = _CLASS[np.frombuffer(value.encode(), np.uint8)]
        kind = kind[kind < CLASSES]
        return float(self.log[kind[:-1], kind[1:]].mean()) if len(kind) > 1 else 0.0

    def covered(self, value: str) -> tuple[float, float]:
        """Shares of the value that common words cover, taking the longest from the left, and the longest one covers."""
        low, at, total, longest = value.lower(), 0, 0, 0
        while at < len(low):
            size = next((k for k in (6, 5, 4, 3) if low[at : at + k] in self.words and at + k <= len(low)), 0)
            total, longest, at = total + size, max(longest, size), at + (size or 1)
        return total / max(1, len(low)), longest / max(1, len(low))

    def features(self, path: str, value: str, before: str, after: str) -> list[float]:
        n = max(1, len(value))
        counts = Counter(value)
        entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
        sort = [c.isdigit() + 2 * c.isupper() + 4 * c.islower() for c in value]
        changes = sum(a != b for a, b in zip(sort, sort[1:])) / n
        dictionary, longest = self.covered(value)
        around = [w.strip(".,:;=\"'|()").lower() for w in (before + " " + after).split()]
        known = sum(self.covered(w)[0] > 0.6 for w in around) / max(1, len(around))
        return [
            float(n),
            entropy,
            self.transitions(value),
            changes,
            sum(c.isdigit() for c in value) / n,
            sum(c.isupper() for c in value) / n,
            dictionary,
            longest,
            float(path.count("/")),
            float(bool(FILL_WORDS.search(path))),
            float(bool(CONFIG_PATH.search(path))),
            float(bool(KEY_WORDS.search(before))),
            float(bool(FILL_WORDS.search(before + " " + after))),
            known,
        ]


def _candidates(text: str) -> Iterator[tuple[int, str, str, str, str]]:
    # Places taken by strict findings, which never overlap, in their order.
    begins: list[int] = []
    ends: list[int] = []
    for name, pattern in DETECTORS:
        found = []
        for match in pattern.finditer(text):
            start, end = match.span(1)
            last = bisect.bisect_left(begins, end) - 1
            if last >= 0 and ends[last] > start:
                continue
            if name in STRICT:
                found.append((start, end))
            before = " ".join(text[max(0, start - 80) : start].split()[-3:])
            after = " ".join(text[end : end + 80].split()[:2])
            yield start, name, match[1], before, after
        if found:
            taken = sorted([*zip(begins, ends), *found])
            begins, ends = [b for b, _ in taken], [e for _, e in taken]


def scan(docs: DataFrame) -> DataFrame:
    """Candidates of all texts (``doc_id, text, path``) with the words next to them."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (doc_id, path or "", start, name, value, before, after)
                for doc_id, text, path in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "path")])
                for start, name, value, before, after in _candidates(text or "")
            ]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], _NAMES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "path").mapInArrow(find, FINDING)


def labelled(findings: DataFrame) -> DataFrame:
    """Labelled findings made from findings; a value's label hangs on the value's kind, not on its place alone."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                value, own = row["value"], list(row.values())
                draw = hashlib.sha256(f"{value} {row['id']} {row['start']}".encode()).hexdigest()
                words = [w.strip(".,:;=\"'|()") for w in (row["after"] + " " + row["before"]).split()]
                joined = "".join(w for w in words if w.isalpha() and not KEY_WORDS.search(w))
                placed = lambda v, keep, label: [*own[:4], v, own[5] if keep else " ".join(words[-2:]), own[6], label]  # noqa: B023,E731
                if row["detector"] in STRICT:
                    rows.append([*own, 1])
                    rows.append(placed(value, False, 1))
                    if len(joined) >= 8:
                        rows.append(placed(joined[: 8 + int(draw[:2], 16) % 24], True, 0))
                    if draw[2] in "01":
                        rows.append(placed(FILLS[int(draw[:2], 16) % len(FILLS)], True, 0))
                elif value.isalpha() and value[1:].islower():
                    rows.append([*own, 0])
            if rows:
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), [*_KINDS, pa.int32()])]
                yield pa.RecordBatch.from_arrays(columns, [*_NAMES, "label"])

    return findings.mapInArrow(make, LABELLED)


def described(findings: DataFrame, language: Language) -> DataFrame:
    """``findings`` with ``value_sha256`` and ``features`` for the value itself."""
    sent = findings.sparkSession.sparkContext.broadcast(language)
    others = [c for c in findings.columns if c not in ("value", "before", "after")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in findings.select(*others).schema)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*[batch.column(c).to_pylist() for c in ("path", "value", "before", "after")]))
            values = [sent.value.features(*row) for row in rows]
            hashed = [hashlib.sha256(row[1].encode()).hexdigest() for row in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in others],
                    pa.array([len(row[1]) for row in rows], pa.int32()),
                    pa.array(hashed, pa.string()),
                    pa.array(values, pa.list_(pa.float64())),
                ],
                [*others, "length", "value_sha256", "features"],
            )

    return findings.mapInArrow(describe, f"{schema}, length int, value_sha256 string, features array<double>")


def train(rows: DataFrame, store: Store, limit: int = TRAIN_ROWS) -> RandomForestClassificationModel | None:
    """A forest from described, labelled findings, at most ``limit`` of them; none unless both labels occur.

    The sample is written as one file, so that the forest's own draws do not hang on how rows lie.
    """
    order = F.xxhash64("value_sha256", "id", "start", "label", F.hash("features"))
    sample = rows.select("label", "features", order.alias("draw")).orderBy("draw", "label", "features").limit(limit)
    sample = store.keep(sample.coalesce(1), "sample").select("label", array_to_vector("features").alias("vector"))
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxBins=64
    )
    return forest.fit(sample)


def score(rows: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """Described findings with ``probability`` and ``is_secret``."""
    if model is None:
        return rows.withColumns({"probability": F.lit(None).cast("double"), "is_secret": F.lit(True)})
    scored = model.transform(rows.withColumn("vector", array_to_vector("features")))
    return scored.withColumn("probability", F.round(vector_to_array("probability")[1], 4)).withColumn(
        "is_secret", F.col("probability") >= 0.5
    )


def find_secrets(docs: DataFrame, store: Store | None = None) -> DataFrame:
    """Every candidate of ``docs`` (``doc_id, text, path``): place, detector, hash, probability and verdict.

    Counts the corpus, writes the findings and trains the forest when it is called.
    """
    store = store or Store(docs.sparkSession, "secrets")
    language = Language.of(docs, store)
    findings = store.keep(scan(docs), "findings")
    model = train(described(labelled(findings), language), store)
    return score(described(findings, language), model).select(
        F.col("id").alias("doc_id"), "start", "length", "detector", "value_sha256", "probability", "is_secret"
    )
