"""Bulk insert that becomes visible in one step, through a Python data source.

Every task stages its rows under a name of its own and reports what it staged; once all tasks are done
the driver publishes the reported pieces. A lost executor's piece is reported by nobody, so a repeated or
speculative task can neither leave half a batch nor add a row twice.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from labtables.config import path_exists

# the writers travel with the job; executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules["labtables.sinks"])

Piece = tuple[str, int]


class Target(Protocol):
    """A store that takes rows in two steps: staged ones are seen by no reader until they are published."""

    def stage(self, task: str, batches: Iterator[pa.RecordBatch]) -> list[Piece]:
        """Store the rows of one task attempt out of sight, in an executor; (name, rows) of each piece."""

    def publish(self, pieces: Sequence[Piece]) -> None:
        """Make the pieces visible all at once; runs once for a job."""

    def discard(self, pieces: Sequence[Piece]) -> None:
        """Forget the pieces of a job that failed; pieces of lost tasks are not among them."""


def file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else path.removeprefix("file:"))


@dataclass(frozen=True)
class FolderTarget:
    """Parquet files below a folder; the manifest of a batch lists those that count.

    A manifest is written beside and renamed, so it is there as a whole or not at all. The folder must be
    one that pyarrow's file systems reach from all executors.
    """

    path: str
    batch: str

    def stage(self, task: str, batches: Iterator[pa.RecordBatch]) -> list[Piece]:
        import pyarrow.parquet as pq

        fs, root = file_system(self.path)
        name, rows, writer = f"{self.batch}-{task}.parquet", 0, None
        fs.create_dir(f"{root}/pieces")
        try:
            for batch in batches:
                if batch.num_rows:
                    if writer is None:
                        writer = pq.ParquetWriter(f"{root}/pieces/{name}", batch.schema, filesystem=fs)
                    writer.write_batch(batch)
                    rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return [(name, rows)] if rows else []

    def publish(self, pieces: Sequence[Piece]) -> None:
        fs, root = file_system(self.path)
        fs.create_dir(f"{root}/batches")
        fresh = f"{root}/batches/_{uuid.uuid4().hex}"
        with fs.open_output_stream(fresh) as out:
            for name, rows in sorted(pieces):
                out.write(json.dumps({"batch": self.batch, "name": name, "n_rows": rows}).encode() + b"\n")
        fs.move(fresh, f"{root}/batches/{self.batch}.json")

    def discard(self, pieces: Sequence[Piece]) -> None:
        """Nothing: what no manifest lists is not read."""


@dataclass
class _Staged(WriterCommitMessage):
    pieces: list


class _Writer(DataSourceArrowWriter):
    def __init__(self, target: Target):
        self.target = target

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        task = TaskContext.get()
        return _Staged(self.target.stage(f"{task.partitionId():06d}-{task.taskAttemptId()}", iterator))

    def commit(self, messages) -> None:
        self.target.publish([p for m in messages if m is not None for p in m.pieces])

    def abort(self, messages) -> None:
        self.target.discard([p for m in messages if m is not None for p in m.pieces])


def bulk_insert_committed(df: DataFrame, target: Target) -> None:
    """Insert all rows of ``df`` or none; an error in any task, after its retries, ends the job."""
    name = f"bulk_{uuid.uuid4().hex}"

    class Bulk(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> _Writer:
            return _Writer(target)

    df.sparkSession.dataSource.register(Bulk)
    df.write.format(name).mode("append").save()


def insert_batch(df: DataFrame, path: str, batch: str) -> bool:
    """Insert a named batch into a folder of batches; False, and nothing done, if it is there already."""
    if path_exists(df.sparkSession, f"{path}/batches/{batch}.json"):
        return False
    bulk_insert_committed(df, FolderTarget(path, batch))
    return True


def batches(spark: SparkSession, path: str) -> DataFrame:
    """(batch, n_rows) of the batches that were committed."""
    listed = spark.read.schema("batch string, name string, n_rows long").json(f"{path}/batches")
    return listed.groupBy("batch").agg(F.sum("n_rows").alias("n_rows"))


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of all committed batches; the driver holds the names of their files, as for any scan."""
    if not path_exists(spark, f"{path}/batches"):
        return spark.createDataFrame([], schema)
    names = [r["name"] for r in spark.read.schema("name string").json(f"{path}/batches").collect()]
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/pieces/{n}" for n in names])
