"""Loading documents into a keyed store."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession

from labtables.config import is_complete
from labtables.operators.documents import DOCUMENT_KEY
from labtables.operators.keys import drop_matching, first_of_each

Writer = Callable[[list[dict]], None]


def bulk_insert(df: DataFrame, open_writer: Callable[[], Writer], batch: int = 1000) -> None:
    """Send each partition to a store in batches; one writer per partition, errors end the job.

    A lost executor repeats its partition, so a writer must set documents by their
    whole key (``_id`` and ``part`` for documents in parts), not add them.
    """

    def send(rows: Iterator[Row]) -> None:
        write = open_writer()
        while docs := [r.asDict(recursive=True) for r in islice(rows, batch)]:
            write(docs)

    df.foreachPartition(send)


def new_documents(incoming: DataFrame, target: DataFrame, keys: Sequence[str] = DOCUMENT_KEY,
                  unique: bool = False) -> DataFrame:
    """Incoming documents, once per key, whose key is not in the target; ``unique`` says that no key
    repeats among them, which spares the fold of whole documents."""
    rows = incoming if unique else first_of_each(incoming, list(keys))
    return drop_matching(rows, target.select(*keys), list(keys))


def insert_ignoring_duplicates(spark: SparkSession, incoming: DataFrame, path: str,
                               keys: Sequence[str] = DOCUMENT_KEY, unique: bool = False) -> None:
    """Append new documents to a Parquet store; running it again adds nothing. The keys of the whole store
    are read; ``BucketStore`` reads those of the buckets that a batch touches.

    A store counts once a write to it was committed (``_SUCCESS``); what a failed first write left in the
    folder is not read. Documents in parts have the key (_id, part).
    """
    if is_complete(spark, path):
        incoming = new_documents(incoming, spark.read.schema(incoming.schema).parquet(path), keys, unique)
    elif not unique:
        incoming = first_of_each(incoming, list(keys))
    incoming.write.mode("append").parquet(path)
