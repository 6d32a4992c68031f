"""Two-pass external shuffle into shards, in DataFrame functions only.

First pass: a seeded hash scatters the records over buckets of about ``bucket_bytes``, whatever their keys,
sources or texts are; each bucket is gathered, put in one order and then shuffled as a whole by Spark's
``shuffle``, which is a Fisher-Yates shuffle with a seed; the shuffled buckets are written. Second pass: the
counts of the written buckets give each bucket its offset in the overall order, and record ``g`` of that order
goes to shard ``g mod shards`` at slot ``g div shards``. Counts per shard are therefore at most one apart and
slots have no gaps.

The permutation is drawn once and fixed by the written table: a lost executor cannot draw it anew for a part
of the rows. A bucket is the only thing that has to fit in a task's memory; the number of buckets grows with the
input, and the scatter key holds the row's place besides its id, so repeated rows spread as others do.

Defined results: a null text has size 1 and the checksum of no bytes; an empty table has no rows; columns of the
input are kept as they are, and those named ``shard`` or ``slot`` give way to the result's.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesieve.llm.store import Store

BUCKET_BYTES = 8 << 20
SEED = 20240
#: Buckets that share one running sum of counts.
BUCKET_GROUP = 4096


def record_size(text: Column) -> Column:
    """UTF-8 bytes of a text plus one."""
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("long")


def _scatter(docs: DataFrame, buckets: int, seed: int) -> DataFrame:
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.monotonically_increasing_id())
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(
        F.pmod(key, F.lit(buckets)).alias("bucket"),
        F.struct(F.xxhash64(F.lit(seed + 1), key).alias("draw"), record.alias("record")).alias("item"),
    )


def _offsets(counts: DataFrame) -> DataFrame:
    """Records in all buckets before each one. Sums run within groups of buckets and over the groups."""
    group = F.floor(F.col("bucket") / BUCKET_GROUP)
    before = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("part", group)
    parts = counts.groupBy("part").agg(F.sum("n").alias("n"))
    above = parts.select("part", F.coalesce(F.sum("n").over(before("part")), F.lit(0)).alias("above"))
    within = counts.select("part", "bucket", F.coalesce(F.sum("n").over(before("part", "bucket")), F.lit(0)).alias("within"))
    return within.join(above, "part").select("bucket", (F.col("within") + F.col("above")).alias("first"))


def shuffle(docs: DataFrame, shards: int = 8, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows and columns of ``docs`` (``doc_id, text`` among them) with ``shard`` and ``slot``.

    Sums the sizes and writes the shuffled buckets to the shared folder when it is called.
    """
    docs = docs.drop("shard", "slot")
    total = docs.agg(F.sum(record_size(F.col("text")))).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    gathered = _scatter(docs, buckets, seed).groupBy("bucket").agg(F.sort_array(F.collect_list("item")).alias("items"))
    mixed = gathered.select("bucket", F.shuffle("items", F.lit(seed)).alias("items"))
    flat = mixed.select("bucket", F.posexplode("items").alias("place", "item")).select("bucket", "place", "item.record")
    store = Store(docs.sparkSession, "shards")
    written = store.keep(flat, "buckets")
    # A row per bucket: written, so that the planner knows its size and sends it to the records.
    first = store.keep(_offsets(written.groupBy("bucket").agg(F.count("*").alias("n"))), "offsets")
    rank = F.col("first") + F.col("place")
    return written.join(first, "bucket").select(
        "record.*", F.pmod(rank, F.lit(shards)).cast("int").alias("shard"), F.floor(rank / shards).cast("long").alias("slot")
    )


def write(shuffled: DataFrame, path: str, shards: int = 8) -> None:
    """Write each shard as files of its own below ``path``, rows in the order of their slots within a file."""
    shuffled.repartitionByRange(shards * 4, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
