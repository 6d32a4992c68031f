"""Readers: delimited tables, trees of source files, lists and stored JSON."""

from __future__ import annotations

import os
import warnings
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve import schemas
from codesieve.functions import languages
from codesieve.operators.sets import union_all
from codesieve.session import materialise

# Quoted fields may hold line feeds and doubled quotes, as code does.
CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}

#: Names that a listing hands over at a time, files that a task reads, bytes that it hands over at a time.
NAMES = 10_000
FILES_PER_TASK = 5_000
BATCH_BYTES = 4 << 20

# A pair of characters that no text may hold; stands for a real U+FFFD while bad bytes are dropped.
_HELD = "﷐﷑"


def labelled_csv(spark: SparkSession, path: str, schema: str = schemas.LABELLED) -> DataFrame:
    """Labelled snippets. A file with multi-line fields is one split, so large inputs should come as
    many files."""
    return spark.read.schema(schema).options(**CSV).csv(path)


def resolve_pairs(df: DataFrame) -> DataFrame:
    """Name the pair columns: ``vulnerable_code`` or else ``code``, ``fixed_code`` or else null."""
    bad = "vulnerable_code" if "vulnerable_code" in df.columns else "code"
    good = F.col("fixed_code") if "fixed_code" in df.columns else F.lit(None).cast("string")
    rest = [c for c in df.columns if c not in ("vulnerable_code", "fixed_code", "code")]
    return df.select(*rest, F.col(bad).alias("vulnerable_code"), good.alias("fixed_code"))


def fix_pairs_csv(spark: SparkSession, path: str, schema: str = schemas.FIX_PAIRS) -> DataFrame:
    return resolve_pairs(spark.read.schema(schema).options(**CSV).csv(path))


def language_column(df: DataFrame) -> Column:
    """``language``, or ``lang`` where a table names it so."""
    return F.col("language" if "language" in df.columns else "lang")


def existing(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A Parquet table, or None and a warning when there is none at ``path``."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        warnings.warn(f"no table at {path}", stacklevel=2)
        return None


def training_table(spark: SparkSession, base: str, language: str, extras: Iterable[str] = ()) -> DataFrame:
    """Rows of one language from a table partitioned by language, joined by those extra tables that
    exist. Only the folder of the language is read."""
    found = [existing(spark, base, f"{schemas.TRAIN}, language string")]
    if found[0] is not None:
        found[0] = found[0].where(F.col("language") == language).drop("language")
    found += [existing(spark, path, schemas.HARVESTED) for path in extras]
    tables = [t for t in found if t is not None]
    if not tables:
        raise FileNotFoundError(f"no training data for {language}")
    return union_all(spark.createDataFrame([], schemas.HARVESTED), *tables)


def decode(content: Column) -> Column:
    """Text of UTF-8 bytes without the invalid ones, line ends as line feeds."""
    held = F.replace(content.cast("string"), F.lit("�"), F.lit(_HELD))
    valid = F.replace(F.make_valid_utf8(held), F.lit("�"), F.lit(""))
    text = F.replace(valid, F.lit(_HELD), F.lit("�"))
    return F.regexp_replace(text, "\r\n?", "\n")


def _binary(spark: SparkSession, root: str, glob: str, deep: bool) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    return reader.option("recursiveFileLookup", str(deep).lower()).load(root)


def _parts(path: Column) -> Column:
    return F.split(path, "/")


def file_manifest(spark: SparkSession, root: str, repo: str, glob: str = "*.py") -> DataFrame:
    """(repo, file_path, file_name, size_bytes) of every matching file below ``root``; contents are
    not read."""
    listed = _binary(spark, root, glob, deep=True)
    return listed.select(
        F.lit(repo).alias("repo"),
        F.col("path").alias("file_path"),
        F.element_at(_parts(F.col("path")), -1).alias("file_name"),
        F.coalesce("length", F.lit(-1)).alias("size_bytes"),
    )


def source_tree(spark: SparkSession, root: str, glob: str = "*.py") -> DataFrame:
    """(path, code) of every matching file below ``root``."""
    return _binary(spark, root, glob, deep=True).select("path", decode(F.col("content")).alias("code"))


def _hidden(name: str) -> bool:
    """Names that Spark's own listing leaves out."""
    metadata = name.startswith(("_common_metadata", "_metadata"))
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name and not metadata)


def _names(folder: str) -> Iterator[str]:
    with os.scandir(folder) as entries:
        for entry in entries:
            if not _hidden(entry.name) and entry.is_file():
                yield entry.name


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """``name`` of the files directly in a folder, read as a stream by one task and written: the driver holds none."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some: list[str] = []
            for name in _names(folder) if len(batch) else ():
                some.append(name)
                if len(some) == NAMES:
                    yield pa.RecordBatch.from_pydict({"name": some})
                    some = []
            if some:
                yield pa.RecordBatch.from_pydict({"name": some})

    return materialise(spark.range(0, 1, 1, 1).mapInArrow(names, "name string"), "names")


def _contents(names: DataFrame, folder: str) -> DataFrame:
    """``name, content`` of files in a folder, read by as many tasks as their number asks for; like Spark's reader without
    the empty ones."""
    schema = pa.schema([("name", pa.string()), ("content", pa.binary())])

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some, held = [], 0
            for name in batch.column(0).to_pylist():
                with open(os.path.join(folder, name), "rb") as file:
                    content = file.read()
                if content:
                    some.append({"name": name, "content": content})
                    held += len(content)
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(some, schema)
                    some, held = [], 0
            if some:
                yield pa.RecordBatch.from_pylist(some, schema)

    tasks = max(names.sparkSession.sparkContext.defaultParallelism, -(-names.count() // FILES_PER_TASK))
    return names.repartition(tasks).mapInArrow(contents, "name string, content binary")


def _local_folder(spark: SparkSession, root: str) -> tuple[str, str] | None:
    """A folder of the machines' own file system as Spark names it and as a plain path; None for another store."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    named = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path)
    uri = named.toUri()
    return (named.toString(), uri.getPath()) if uri.getScheme() == "file" else None


def source_folder(spark: SparkSession, root: str) -> DataFrame:
    """(path, language, code) of the files directly in ``root`` that have a mapped extension.

    Spark's file source keeps the status of every file in the driver. A folder that all executors reach as a path is
    listed and read by tasks instead; its names are written once, when this is called. Other stores are read by Spark.
    """
    local = _local_folder(spark, root)
    if local:
        shown, folder = local
        names = _listed(spark, folder)
        path = F.concat(F.lit(shown.rstrip("/") + "/"), F.col("name"))
        language = languages.from_path(F.col("name"))
        flat = _contents(names.where(language.isNotNull()), folder).withColumn("path", path)
    else:
        flat = _binary(spark, root, "*", deep=False)
    mapped = flat.withColumn("language", languages.from_path(F.col("path"))).where("language IS NOT NULL")
    return mapped.select("path", "language", decode(F.col("content")).alias("code"))


def path_list(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines of a changed-file list, in a column named ``value``."""
    return spark.read.text(path)


def commits_json(spark: SparkSession, path: str) -> DataFrame:
    """(repo, sha, message) of stored commit lists, one folder per repository."""
    return spark.read.schema(f"{schemas.COMMITS}, repo string").json(path)


def report_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REPORT).json(path)
