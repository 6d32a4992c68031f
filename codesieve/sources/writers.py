"""Writers for training tables, features, reports and profiles."""

from __future__ import annotations

import pathlib
from collections.abc import Iterable

from pyarrow import fs
from pyspark.sql import DataFrame, Row

# The CSV writer cuts blanks by default, which would change code.
CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def csv_table(df: DataFrame, path: str) -> None:
    df.write.options(**CSV).csv(path)


def language_csv(df: DataFrame, path: str) -> None:
    """One folder per language; a language without rows leaves none."""
    df.write.partitionBy("language").options(**CSV).csv(path)


def language_parquet(df: DataFrame, path: str) -> None:
    df.write.partitionBy("language").parquet(path)


def features(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def report_json(df: DataFrame, path: str) -> None:
    """One JSON line per file."""
    df.write.json(path)


def commits_json(df: DataFrame, path: str) -> None:
    df.write.partitionBy("repo").json(path)


def inside(path: str) -> str:
    """``path`` if it stays below the folder it is joined to."""
    parts = pathlib.PurePosixPath(path)
    if parts.is_absolute() or ".." in parts.parts:
        raise ValueError(f"{path!r} leaves its folder")
    return path


def source_files(files: DataFrame, root: str) -> None:
    """Write each row as a file of its own, ``root`` joined with its ``path``.

    ``root`` is a folder that all executors reach, as a path or a URI. A path that would leave it is refused. A file
    written twice by a retried task holds the same text.
    """

    def write(rows: Iterable[Row]) -> None:
        system, base = fs.FileSystem.from_uri(root) if ":" in root else (fs.LocalFileSystem(), root)
        for row in rows:
            target = f"{base.rstrip('/')}/{inside(row.path)}"
            system.create_dir(target.rsplit("/", 1)[0], recursive=True)
            with system.open_output_stream(target, compression=None) as out:
                out.write(row.code.encode("utf-8"))

    files.select("path", "code").foreachPartition(write)
