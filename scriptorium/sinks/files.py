"""Committed files: one file per row, published together or not at all.

Each task writes its rows into a staging folder of its own beside the target
files, through the file system that the path names (local, HDFS, S3, GCS).  Only
when every task has succeeded are the files moved to their names; a failed job
drops the staging folder, so no reader ever sees a part of a file and a failed run
publishes nothing (a task that outlives its job may leave a hidden staging folder).  A retried or speculative task has its own folder; the one that
the engine commits counts.
"""

from __future__ import annotations

import os
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

MOVES = 16  # files moved at a time


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path on it; paths without a scheme are local."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))


def _joined(*parts: str) -> str:
    return "/".join(p.strip("/") if k else p.rstrip("/") for k, p in enumerate(parts))


class _Written(WriterCommitMessage):
    def __init__(self, folder: str, files: int):
        self.folder, self.files = folder, files


class _Writer(DataSourceWriter):
    def __init__(self, options):
        self.path, self.job = options["path"], uuid.uuid4().hex

    def _staging(self, base: str) -> str:
        return _joined(base, f"_staging-{self.job}")

    def write(self, iterator) -> _Written:
        files, base = _opened(self.path)
        folder = _joined(self._staging(base), f"{TaskContext.get().partitionId()}-{uuid.uuid4().hex}")
        made, n = set(), 0
        for row in iterator:
            target = _joined(folder, row["name"])
            parent = target.rpartition("/")[0]
            if parent not in made:
                files.create_dir(parent, recursive=True)
                made.add(parent)
            with files.open_output_stream(target) as out:
                out.write(row["content"].encode("utf-8"))
            n += 1
        return _Written(folder, n)

    def commit(self, messages) -> None:
        files, base = _opened(self.path)
        files.create_dir(base, recursive=True)

        def publish(source: str, folder: str) -> None:
            target = _joined(base, source[len(folder):])
            files.create_dir(target.rpartition("/")[0], recursive=True)
            try:
                files.move(source, target)
            except OSError:  # a file system whose move does not replace
                files.delete_file(target)
                files.move(source, target)

        with ThreadPoolExecutor(MOVES) as pool:
            for message in messages:
                if message is not None and message.files:
                    found = files.get_file_info(fs.FileSelector(message.folder, recursive=True))
                    list(pool.map(lambda f, folder=message.folder: publish(f.path, folder), (f for f in found if f.is_file)))
        self._drop(files, base)

    def abort(self, messages) -> None:
        self._drop(*_opened(self.path))

    def _drop(self, files: fs.FileSystem, base: str) -> None:
        staging = self._staging(base)
        if files.get_file_info(staging).type != fs.FileType.NotFound:
            files.delete_dir(staging)


class CommittedFiles(DataSource):
    """``df.write.format("committedfiles").option("path", folder)`` with (name, content)."""

    @classmethod
    def name(cls) -> str:
        return "committedfiles"

    def schema(self) -> str:
        return "name string, content string"

    def writer(self, schema, overwrite) -> DataSourceWriter:
        return _Writer(self.options)


def write_files(spark: SparkSession, df: DataFrame, folder: str, name: Column, content: Column) -> None:
    """One file per row at ``folder/name`` (names may hold sub-folders), all or none; an existing file is replaced."""
    spark.dataSource.register(CommittedFiles)
    rows = df.select(name.alias("name"), F.coalesce(content, F.lit("")).alias("content"))
    rows.write.format("committedfiles").mode("append").option("path", folder).save()


def listed(spark: SparkSession, *folders: str, ext: str = "") -> DataFrame:
    """(path) of every file under the folders whose name ends so, empty ones too; a folder that is missing has none.

    The names come from the engine's own file index, which the driver holds for any
    scan of a folder; no content is read.
    """
    found: list[tuple[str]] = []
    for folder in folders:
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{ext}").load(folder).inputFiles()
            found += [(re.sub("^file:(//)?(?=/)", "", unquote(f)),) for f in files]
    return spark.createDataFrame(found, "path string")
