"""SNK-08: a table of versions with an atomic commit, format("versioned"). Two writers that read one version can't both win.

Tasks write files of their own name; the driver's commit then puts the next version's manifest in place if it isn't
there, which the file system does as one step (a hard link). A writer that comes second fails, and its files are removed.
The folder must be one that driver and executors share as files; stores without such a step need a `put_if_absent` of
their own.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

NONE = -1


class Conflict(Exception):
    """Another writer has committed the version that this one was to become."""


def folder_of(path: str) -> str:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        raise ValueError(f"{path} is no folder of shared files; give a put_if_absent for its store")
    return path


def put_if_absent(path: str, content: bytes) -> bool:
    """Whether the file is there now by this call: it appears whole and at once, or was there before."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as f:
        f.write(content)
        f.flush()
        os.fsync(f.fileno())
    try:
        os.link(own, path)
        return True
    except FileExistsError:
        return False
    finally:
        os.unlink(own)


def manifests(folder: str) -> list[int]:
    at = f"{folder}/_versions"
    return sorted(int(n[:-5]) for n in os.listdir(at) if n.endswith(".json")) if os.path.isdir(at) else []


def manifest(folder: str, version: int | None = None) -> dict:
    """The manifest of a version, the latest by default; version NONE without files if there is none."""
    found = manifests(folder)
    if not found and version in (None, NONE):
        return {"version": NONE, "files": [], "schema": None}
    with open(f"{folder}/_versions/{found[-1] if version is None else version:012d}.json") as f:
        return json.load(f)


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


class Writer(DataSourceArrowWriter):
    def __init__(self, folder: str, expected: int, schema: StructType, put: Callable[[str, bytes], bool] = put_if_absent):
        self.folder, self.expected, self.schema, self.put = folder, expected, schema, put
        self.run = uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        # An attempt that is made twice writes under another name; files that no commit names are nobody's.
        name, rows, out = f"{self.run}-{uuid.uuid4().hex}.parquet", 0, None
        os.makedirs(f"{self.folder}/data", exist_ok=True)
        for batch in batches:
            out = out or pq.ParquetWriter(f"{self.folder}/data/{name}", batch.schema)
            out.write_batch(batch)
            rows += batch.num_rows
        if out:
            out.close()
        return Written(name if out else None, rows)

    def commit(self, messages: list[Written | None]) -> None:
        done = [m for m in messages if m and m.file]
        content = {"version": self.expected + 1, "files": [m.file for m in done], "rows": sum(m.rows for m in done), "schema": self.schema.json()}
        if not self.put(f"{self.folder}/_versions/{self.expected + 1:012d}.json", json.dumps(content).encode()):
            raise Conflict(f"version {self.expected + 1} of {self.folder} is there already")

    def abort(self, messages: list[Written | None]) -> None:
        for name in os.listdir(f"{self.folder}/data") if os.path.isdir(f"{self.folder}/data") else []:
            if name.startswith(self.run):
                os.unlink(f"{self.folder}/data/{name}")


class Reader(DataSourceReader):
    def __init__(self, folder: str, version: int | None):
        self.folder, self.files = folder, manifest(folder, version)["files"]

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(f) for f in self.files] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is not None:
            yield from pq.ParquetFile(f"{self.folder}/data/{partition.value}").iter_batches()


class Versioned(DataSource):
    """Options: path; expected, the version that a writer has read (NONE for the first); version to read, the latest by default."""

    @classmethod
    def name(cls) -> str:
        return "versioned"

    def schema(self) -> StructType:
        found = manifest(folder_of(self.options["path"]), self._version())["schema"]
        if found is None:
            raise ValueError(f"there is no version in {self.options['path']}")
        return StructType.fromJson(json.loads(found))

    def reader(self, schema: StructType) -> Reader:
        return Reader(folder_of(self.options["path"]), self._version())

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(folder_of(self.options["path"]), int(self.options["expected"]), schema)

    def _version(self) -> int | None:
        return int(self.options["version"]) if "version" in self.options else None


def latest(path: str) -> int:
    """The latest version of a table, NONE if there is none: what a writer states as expected."""
    return manifest(folder_of(path))["version"]


def commit(rows: DataFrame, path: str, expected: int) -> int:
    """SNK-08: rows as the version after `expected`, which is returned; a Conflict if another writer was faster.

    In a thread of its own the session must be the thread's active one, as it is after createDataFrame: Spark looks sources of Python up there.
    """
    rows.sparkSession.dataSource.register(Versioned)
    rows.write.format("versioned").option("path", path).option("expected", expected).mode("append").save()
    return expected + 1


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of a table, the latest by default; later commits don't change what has been opened."""
    spark.dataSource.register(Versioned)
    at = latest(path) if version is None else version
    return spark.read.format("versioned").option("path", path).option("version", at).load()
