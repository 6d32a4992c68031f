"""Tables that an operator writes once and reads again, in the folder all executors share.

A written table cuts the lineage, fixes row numbers that would otherwise be drawn anew, and survives the
loss of executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve.session import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Store:
    """A folder of written tables below the shared folder of the session, for one run of one operator."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, name)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def keep(self, df: DataFrame, table: str) -> DataFrame:
        """Write ``df`` and read it back. Spark deletes the shuffle files of the job as soon as it has ended.

        Left alone they would stay until the driver's garbage collector has found that nothing refers to them. Collections
        forced for that count as pauses, and the driver's heap grows by a good part for every few of them.
        """
        before = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(self.path(table))
        finally:
            if before is None:
                self.spark.conf.unset(CLEANUP)
            else:
                self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(self.path(table))

    def drop(self, table: str) -> None:
        """Delete a table that nothing reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
