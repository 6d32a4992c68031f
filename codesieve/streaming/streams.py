"""Stream forms: the batch transforms over files and events as they arrive.

Every stream runs with the ``availableNow`` trigger: it takes in all that has arrived since the last
run, in order, and stops. The checkpoint folder remembers what was taken, so each file is seen once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import LongType, StructField, StructType

from codesieve.operators import scan


def read_files(spark: SparkSession, folder: str, schema, glob: str = "*.parquet", per_batch: int | None = None) -> DataFrame:
    """Stream of Parquet files; ``per_batch`` limits the files of one micro-batch, not the whole."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(folder)


def run_to_end(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append the stream's rows as Parquet until all input is taken in."""
    running = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()


def scan_new_files(files: DataFrame) -> DataFrame:
    """The scan, unchanged, on a stream of files: stateless, one report row per arriving file."""
    return scan.scan(files)


def dedupe(rows: DataFrame, text: str = "code", time: str = "ts", within: str = "1 hour") -> DataFrame:
    """Drop repeats of a text that come within a time of its first; state is dropped after that."""
    keyed = rows.withColumn("code_md5", F.md5(F.col(text))).withWatermark(time, within)
    return keyed.dropDuplicatesWithinWatermark(["code_md5"])


def count_windows(events: DataFrame, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Events per kind and tumbling window; a window is final once the watermark has passed it.

    In append mode the windows that the watermark has not passed at the end of a run are held back until later events
    move it on; :func:`run_windows` reads those from the state and counts late rows.
    """
    window = F.window("ts", width)
    counted = events.withWatermark("ts", late).groupBy(window, "event_type").agg(F.count("*").alias("n"))
    return counted.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "event_type", "n"
    )


@dataclass(frozen=True)
class WindowRun:
    """What a finished run of :func:`count_windows` says: final windows, windows held back, and rows that came too late."""

    closed: DataFrame
    open: DataFrame
    late: int

    def rows(self) -> DataFrame:
        """All windows with their ``state``, and one row without a window for the late rows."""
        named = lambda df, state: df.withColumn("state", F.lit(state))
        late = self.closed.sparkSession.range(1).select(
            *[F.lit(None).cast(self.closed.schema[c].dataType).alias(c) for c in ("window_start", "window_end", "event_type")],
            F.lit(self.late).cast("long").alias("n"),
        )
        return named(self.closed, "closed").unionByName(named(self.open, "open")).unionByName(named(late, "late"))


class _Arrivals(StreamingQueryListener):
    """Adds up the rows that a query says it has observed."""

    def __init__(self, name: str):
        self.name, self.rows = name, 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        self.rows += seen["rows"] if seen is not None else 0

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def run_windows(spark: SparkSession, events: DataFrame, out: str, checkpoint: str, width: str = "1 hour", late: str = "1 hour") -> WindowRun:
    """Run :func:`count_windows` to the end of what has arrived.

    Nothing is counted a second time from the source: windows that are open stand in the state behind the checkpoint, how
    many rows have come is an observed metric of the query, and what is in neither kind of window was too late. The count
    of late rows is that of the whole stream while ``out`` and ``arrived`` in it are kept.
    """
    name = f"arrived-{uuid.uuid4().hex}"
    arrivals = _Arrivals(name)
    counted = count_windows(events.observe(name, F.count(F.lit(1)).alias("rows")), width, late)
    schema = counted.schema
    spark.streams.addListener(arrivals)
    try:
        run_to_end(counted, f"{out}/windows", checkpoint)
        # The bus hands over progress in order; its last event may come after the query has ended.
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(arrivals)
    spark.range(1).select(F.lit(arrivals.rows).cast("long").alias("rows")).write.mode("append").parquet(f"{out}/arrived")
    closed = spark.read.schema(schema).parquet(f"{out}/windows")
    state = spark.read.format("statestore").load(checkpoint)
    window, value = F.col("key.window"), F.col("value.count")
    still = state.select(window["start"].alias("window_start"), window["end"].alias("window_end"), F.col("key.event_type").alias("event_type"), value.alias("n"))
    total = lambda df, column: df.agg(F.coalesce(F.sum(column), F.lit(0))).first()[0]
    arrived = total(spark.read.parquet(f"{out}/arrived"), "rows")
    return WindowRun(closed, still, arrived - total(closed, "n") - total(still, "n"))


def run_batches(stream: DataFrame, out: str, checkpoint: str) -> None:
    """As :func:`run_to_end`, each micro-batch in a folder that bears its number.

    A batch that is run again after a lost driver, before its commit was written, puts the same rows in the same folder.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def written_batches(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """The rows that :func:`run_batches` has written, with their ``batch``; none if no batch has come yet."""
    whole = StructType([*schema.fields, StructField("batch", LongType())])
    path = spark._jvm.org.apache.hadoop.fs.Path(out)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(out)


def through_stream(
    spark: SparkSession, source: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> DataFrame:
    """Run ``transform`` over a stream to its end and read back what it wrote."""
    result = transform(source)
    schema = result.schema
    run_to_end(result, out, checkpoint)
    return spark.read.schema(schema).parquet(out)
