"""Tables of committed folders: appends that can be repeated and replacements seen as a whole.

A table is a folder with ``data/write=<name>``, one folder for each write, and ``_commits``, small
files that say which of them count. A write becomes visible when its file is there, which is created
once and never changed; folders of writes that failed or came second are not read. Readers choose
their folders when they are built, so what is written later doesn't reach them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, types as T

WRITE = "write"
#: Ends a commit file; a file without it is still being written.
_END = "\n"


class Commits:
    """The commit files of one table, on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._folder = self._path(f"{path}/_commits")
        self._files = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def add(self, name: str, entry: dict) -> bool:
        """Create the commit file of this name; False if there is one already."""
        file = self._path(f"{self._folder.toString()}/{name}")
        if self._files.exists(file):
            return False
        try:
            out = self._files.create(file, False)
        except Py4JJavaError:
            if self._files.exists(file):  # another writer was first
                return False
            raise
        out.write(bytearray((json.dumps(entry, sort_keys=True) + _END).encode()))
        out.close()
        return True

    def names(self) -> list[str]:
        if not self._files.exists(self._folder):
            return []
        return sorted(status.getPath().getName() for status in self._files.listStatus(self._folder))

    def entry(self, name: str) -> dict | None:
        """What a commit file says; None while it is being written."""
        stream = self._files.open(self._path(f"{self._folder.toString()}/{name}"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text) if text.endswith(_END) else None

    def entries(self) -> dict[str, dict]:
        found = {name: self.entry(name) for name in self.names()}
        return {name: entry for name, entry in found.items() if entry is not None}

    def subfolders(self, path: str) -> list[str]:
        folder = self._path(path)
        statuses = self._files.listStatus(folder) if self._files.exists(folder) else []
        return sorted(s.getPath().getName() for s in statuses if s.isDirectory())


def _write(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    """Write to a folder of its own; its name below the table."""
    folder = f"data/{WRITE}=w{uuid.uuid4().hex}"
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.partitionBy(*partition_by).parquet(f"{path}/{folder}")
    return folder


def _read(spark: SparkSession, path: str, folders: Sequence[str], schema: T.StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", f"{path}/data")
    return reader.parquet(*(f"{path}/{folder}" for folder in folders)).select(schema.names)


def append_once(df: DataFrame, path: str, batch: str, partition_by: Sequence[str] = ()) -> bool:
    """Append the rows of a batch unless a batch of this name is in the table; whether they were added.

    Repeating an append that failed, or that succeeded unnoticed, gives the same table. Of two
    writers with the same batch at the same time one is added.
    """
    commits = Commits(df.sparkSession, path)
    if batch in commits.names():
        return False
    return commits.add(batch, {"folder": _write(df, path, partition_by)})


def read_appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all batches that were added."""
    folders = [entry["folder"] for entry in Commits(spark, path).entries().values()]
    return _read(spark, path, folders, schema)


def _newest(commits: Commits) -> tuple[int, dict[str, str]]:
    """Number of the newest version and its parts: partition folder to the folder that holds it."""
    for name in reversed(commits.names()):
        entry = commits.entry(name)
        if entry is not None:
            return int(name), entry["parts"]
    return 0, {}


def replace_table(df: DataFrame, path: str, partition_by: str | None = None) -> int:
    """Publish a new version of the table; its number.

    Without ``partition_by`` the rows replace all others. With it only the partitions that they
    belong to are replaced, all others stay where they are. A reader sees the old or the new version.
    Of versions published at the same time the later one is built on the earlier one, so that
    replacements of different partitions don't undo each other.
    """
    spark = df.sparkSession
    commits = Commits(spark, path)
    folder = _write(df, path, [partition_by] if partition_by else [])
    if partition_by:
        names = [name for name in commits.subfolders(f"{path}/{folder}") if name.startswith(f"{partition_by}=")]
        written = {name: f"{folder}/{name}" for name in names}
    else:
        written = {"": folder}
    while True:
        number, parts = _newest(commits)
        merged = {**parts, **written} if partition_by else written
        if commits.add(f"{number + 1:012d}", {"parts": merged}):
            return number + 1
        if commits.entry(f"{number + 1:012d}") is None:
            raise RuntimeError(f"version {number + 1} of {path} is unfinished")


def read_version(
    spark: SparkSession, path: str, schema: T.StructType, parts: Sequence[str] | None = None
) -> DataFrame:
    """The newest version, or of it only the partitions ``parts`` (as ``column=value``)."""
    _, held = _newest(Commits(spark, path))
    folders = [folder for name, folder in sorted(held.items()) if parts is None or name in parts]
    return _read(spark, path, folders, schema)
