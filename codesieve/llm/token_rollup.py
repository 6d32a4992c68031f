"""Token counts by source, language and tokenizer version, maintained from batches of changes.

A batch holds inserts, deletes and revised counts of documents. Against the ledger of what each version of a document counts
for now, it becomes signed amounts, minus the old and plus the new, which are summed per key and written as the
batch's own part of the rollup. Totals are the sum of the parts: nothing written is ever changed. A document may be counted
by several tokenizers at once; each is a version of its own, and their totals stand side by side.

The ledger is cut into buckets by a hash of ``doc_id``, and a batch reads those that it touches; of their parts it reads those
since the last merge, which comes every so many batches.

A batch counts from the moment its marker is written, after its parts. A batch whose marker is there is not applied
again; parts without a marker are those of an attempt that died and are overwritten. One writer at a time.

Defined results: of several changes to a version in a batch the one with the largest ``seq`` holds, of equal ones the revision,
then the one with the larger keys and count; a delete takes out all versions of its document, but for changes of the same or a
larger ``seq``; deletes of unknown documents change nothing; an insert of a known version is a revision; a revision of a version
(or, with ``replaces``, in place of one) that no earlier batch has left there is void; changes without a ``doc_id`` add up
if they are inserts and are void otherwise; null sources, languages and tokenizers are keys like others; a null
count is 0; an empty batch is committed and changes nothing. Null texts have no tokens; a long text is encoded whole, by one task.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
STATE = "doc_id long, tokenizer string, source string, lang string, n_tokens long, turn long, bucket int"
DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
MARKER = "batch string, turn long, merged boolean"

#: Fixed value: how the public byte-level vocabularies cut a text before they merge.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@functools.lru_cache(maxsize=4)
def encoding(ranks: bytes, pattern: str = PATTERN):
    """A tokenizer from the bytes of a rank file. Kept by each Python worker."""
    import tiktoken

    merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def count_tokens(docs: DataFrame, ranks: dict[str, bytes], choose: Callable[[str | None], tuple[str, ...]]) -> DataFrame:
    """``doc_id, source, lang, tokenizer, n_tokens`` for the tokenizers that ``choose`` names for a language.

    The rank files are vocabularies of fixed size, sent to all executors.
    """
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, source, lang, text in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "source", "lang", "text")]):
                for name in choose(lang):
                    tokens = encoding(sent.value[name]).encode_ordinary(text or "")
                    rows.append((doc_id, source, lang, name, len(tokens)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())
            names = ["doc_id", *KEYS, "n_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "text")
    return rows.mapInArrow(count, f"doc_id long, {', '.join(f'{k} string' for k in KEYS)}, n_tokens long")


class Rollup:
    """A rollup in a folder of a file system that all executors reach.

    ``buckets`` cuts the ledger by a hash of ``doc_id``; it is the same for all batches of a folder. After ``every`` batches the
    parts are merged into one.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64, every: int = 32):
        self.spark, self.folder, self.buckets, self.every = spark, folder.rstrip("/"), buckets, every

    def _exists(self, path: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def _path(self, part: str, batch: str) -> str:
        # A common base above named parts makes the buckets below them columns.
        return f"{self.folder}/{part}/part={batch}" if part == "ledger" else f"{self.folder}/{part}/{batch}"

    def _parts(self) -> tuple[list[str], int]:
        """Names of the parts that count, which are few, and the last turn."""
        if not self._exists(f"{self.folder}/markers"):
            return [], -1
        markers = self.spark.read.schema(MARKER).option("recursiveFileLookup", "true").parquet(f"{self.folder}/markers")
        base = markers.agg(F.coalesce(F.max(F.when(F.col("merged"), F.col("turn"))), F.lit(-1)), F.max("turn")).first()
        rows = markers.where(F.col("turn") >= base[0]).orderBy("turn").collect()
        return [row["batch"] for row in rows], -1 if base[1] is None else base[1]

    def _read(self, part: str, schema: str) -> DataFrame:
        paths = [self._path(part, name) for name in self._parts()[0]]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.folder}/{part}").parquet(*paths)

    def ledger(self, buckets: list[int] | None = None) -> DataFrame:
        """What each known version of a document counts for now; with ``buckets``, only theirs are read."""
        rows = self._read("ledger", STATE)
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(buckets))
        state = F.struct("turn", "source", "lang", "n_tokens")
        last = rows.groupBy("bucket", "doc_id", "tokenizer").agg(F.max(state).alias("s")).where("s.n_tokens IS NOT NULL")
        return last.select("bucket", "doc_id", "s.source", "s.lang", "tokenizer", "s.n_tokens")

    def _write_ledger(self, rows: DataFrame, name: str) -> None:
        # Small buckets share a task, large ones are split.
        rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._path("ledger", name))

    def _mark(self, name: str, turn: int, merged: bool) -> None:
        marker = self.spark.range(1).select(F.lit(name).alias("batch"), F.lit(turn).cast("long").alias("turn"), F.lit(merged).alias("merged"))
        marker.coalesce(1).write.mode("overwrite").parquet(self._path("markers", name))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch of ``op, seq, doc_id, source, lang, tokenizer, n_tokens`` once; False if it had been applied.

        ``op`` is ``insert``, ``delete`` or ``revise``; a column ``replaces`` may name the version that a revision puts out. The
        name of a batch must do as a folder name.
        """
        if self._exists(f"{self._path('markers', batch)}/_SUCCESS"):
            return False
        names, turn = self._parts()
        count = F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)).alias("n_tokens")
        replaces = F.col("replaces") if "replaces" in changes.columns else F.lit(None).cast("string")
        changes = changes.select("op", "seq", F.col("doc_id").cast("long").alias("doc_id"), *KEYS, count, replaces.alias("replaces"))
        unnamed = changes.where("doc_id IS NULL AND op = 'insert'").select(*KEYS, F.lit(1).alias("sign"), "n_tokens")
        bucket = F.pmod(F.xxhash64("doc_id"), F.lit(self.buckets)).cast("int")
        named = changes.where("doc_id IS NOT NULL").withColumn("bucket", bucket)
        touched = [row["bucket"] for row in named.select("bucket").distinct().collect()]
        # Versions may be null: they are told apart in a form that is not.
        version = lambda name: F.concat(F.col(name).isNull().cast("string"), F.coalesce(name, F.lit("")))
        key = ["bucket", "doc_id", "version"]
        held = self.ledger(touched).join(named.select("doc_id").distinct(), "doc_id", "left_semi")
        held = held.select("bucket", "doc_id", version("tokenizer").alias("version"), F.struct(*KEYS, "n_tokens").alias("old"))

        named = named.withColumn("version", version("tokenizer"))
        named = named.withColumn("base", F.when(F.col("replaces").isNull(), F.col("version")).otherwise(version("replaces")))
        known = held.select("bucket", "doc_id", F.col("version").alias("base"))
        revised = named.where("op = 'revise'").join(known, ["bucket", "doc_id", "base"], "left_semi").select(named.columns)
        able = named.where("op = 'insert'").unionByName(revised)
        newest = able.groupBy(*key).agg(F.max(F.struct("seq", "op", *KEYS, "n_tokens")).alias("new"))
        put_out = revised.where("base <> version").groupBy("bucket", "doc_id", F.col("base").alias("version")).agg(F.max("seq").alias("out_seq"))
        deleted = named.where("op = 'delete'").groupBy("bucket", "doc_id").agg(F.max("seq").alias("delete_seq"))
        met = held.join(newest, key, "full").join(put_out, key, "left").join(deleted, ["bucket", "doc_id"], "left")
        gone = F.greatest("out_seq", "delete_seq")
        met = met.withColumn("holds", F.col("new").isNotNull() & (gone.isNull() | (F.col("new.seq") >= gone)))
        met = met.where(F.col("holds") | (gone.isNotNull() & F.col("old").isNotNull()))
        states = met.select(
            "doc_id",
            F.when(F.col("holds"), F.col("new.tokenizer")).otherwise(F.col("old.tokenizer")).alias("tokenizer"),
            *[F.when(F.col("holds"), F.col(f"new.{c}")).alias(c) for c in ("source", "lang", "n_tokens")],
            F.lit(turn + 1).cast("long").alias("turn"),
            "bucket",
            "old",
        )
        self._write_ledger(states, batch)
        states = self.spark.read.schema(states.schema).parquet(self._path("ledger", batch))
        plus = states.where("n_tokens IS NOT NULL").select(*KEYS, F.lit(1).alias("sign"), "n_tokens")
        minus = states.where("old IS NOT NULL").select(
            *[f"old.{k}" for k in KEYS], F.lit(-1).alias("sign"), (-F.col("old.n_tokens")).alias("n_tokens")
        )
        signed = plus.unionByName(minus).unionByName(unnamed)
        deltas = signed.groupBy(*KEYS).agg(F.sum("sign").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        deltas.write.mode("overwrite").parquet(self._path("deltas", batch))
        self._mark(batch, turn + 1, merged=False)
        if len(names) + 1 >= self.every:
            self.compact()
        return True

    def compact(self) -> None:
        """Merge all parts into one, which counts in their place from its marker on; the old ones may then be deleted."""
        _, turn = self._parts()
        name = f"merged-{turn + 1}"
        self._write_ledger(self.ledger().withColumn("turn", F.lit(turn + 1).cast("long")), name)
        self.totals().write.mode("overwrite").parquet(self._path("deltas", name))
        self._mark(name, turn + 1, merged=True)

    def totals(self) -> DataFrame:
        """Documents and tokens per source, language and tokenizer."""
        sums = self._read("deltas", DELTA).groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.where("n_docs <> 0 OR n_tokens <> 0")
