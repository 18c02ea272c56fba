"""Moving and deleting many files in tasks, on any file system that Arrow knows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Files a task handles.
FILES_PER_TASK = 500


def same_form(path: Column) -> Column:
    """Spark writes local paths as ``file:/a`` and as ``file:///a``, percent-encoded; one form for both."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def _place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pyarrow.fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return pyarrow.fs.LocalFileSystem(), path


def _exists(files: pyarrow.fs.FileSystem, path: str) -> bool:
    return files.get_file_info(path).type != pyarrow.fs.FileType.NotFound


def _delete(path: str) -> bool:
    files, name = _place(path)
    if not _exists(files, name):
        return False
    files.delete_file(name)
    return True


def _move(path: str, target: str) -> bool:
    """False where an earlier attempt has moved the file."""
    files, name = _place(path)
    to = _place(target)[1]
    if not _exists(files, name):
        if not _exists(files, to):
            raise FileNotFoundError(path)
        return False
    files.create_dir(to.rpartition("/")[0], recursive=True)
    files.move(name, to)
    return True


def _spread(paths: DataFrame) -> DataFrame:
    count = paths.count()
    return paths.repartition(max(1, -(-count // FILES_PER_TASK)))


def delete_in_tasks(files: DataFrame, column: str = "file_path") -> int:
    """Delete the listed files; how many were there. A repeated task finds its files gone and goes on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = sum(_delete(path) for path in batch.column("path").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], ["done"])

    paths = _spread(files.select(same_form(F.col(column)).alias("path")).distinct())
    return paths.mapInArrow(run, "done bigint").agg(F.coalesce(F.sum("done"), F.lit(0))).first()[0]


def move_in_tasks(files: DataFrame, source: str, target: str) -> int:
    """Give the listed files their new names; how many were moved now."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([sum(_move(a, b) for a, b in pairs)], pa.int64())], ["done"])

    pairs = _spread(files.select(same_form(F.col(source)).alias("a"), same_form(F.col(target)).alias("b")))
    return pairs.mapInArrow(run, "done bigint").agg(F.coalesce(F.sum("done"), F.lit(0))).first()[0]
