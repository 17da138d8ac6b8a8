"""A keyed document store in hash buckets, so that an insert reads only the buckets it touches.

A bucket is a folder: rows of one id lie in one bucket, whatever their part. Stored keys are read with a
partition filter on the touched buckets and, for a small batch, with its ids, which the Bloom filters in
the files answer. Only the keys of the store are read, and only those that the batch brings again
meet the batch.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labtables.config import is_complete, shared_dir
from labtables.operators.documents import DOCUMENT_KEY
from labtables.operators.keys import first_of_each, keep_matching

BUCKET = "bucket"


@dataclass(frozen=True)
class BucketStore:
    """``buckets`` is fixed for the life of a store; the first of ``keys`` decides the bucket.

    ``probe`` is the most ids that are sent to the files' Bloom filters; larger batches read the keys of
    their buckets. ``ids_per_file`` sizes the filters.
    """

    path: str
    keys: Sequence[str] = DOCUMENT_KEY
    buckets: int = 256
    probe: int = 1000
    ids_per_file: int = 100_000

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """All rows (without the bucket); a store to which no insert was committed is empty."""
        if not is_complete(spark, self.path):
            return spark.createDataFrame([], schema)
        return self._scan(spark, schema).drop(BUCKET)

    def _scan(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        fields = [*schema.fields, T.StructField(BUCKET, T.IntegerType())]
        return spark.read.schema(T.StructType(fields)).parquet(self.path)

    def _write(self, rows: DataFrame, mode: str) -> None:
        """Rows by bucket; the rebalance gives a bucket one task, and one with very many rows several."""
        key = self.keys[0]
        (
            rows.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, *self.keys)
            .write.mode(mode).partitionBy(BUCKET)
            .option("partitionOverwriteMode", "dynamic")
            .option(f"parquet.bloom.filter.enabled#{key}", "true")
            .option(f"parquet.bloom.filter.expected.ndv#{key}", str(self.ids_per_file))
            .parquet(self.path)
        )

    def stored_keys(self, spark: SparkSession, schema: T.StructType, touched: Sequence[int], ids: Sequence) -> DataFrame:
        """Keys of the touched buckets, and of the given ids if there are any."""
        keys = T.StructType([schema[k] for k in self.keys])
        found = self._scan(spark, keys).where(F.col(BUCKET).isin(list(touched)))
        if ids:
            found = found.where(F.col(self.keys[0]).isin(list(ids)))
        return found.drop(BUCKET)

    def insert(self, incoming: DataFrame, unique: bool = False) -> None:
        """Add rows whose key is not stored; running it again adds nothing.

        ``unique`` says that no key repeats in ``incoming``, which spares the fold of equal keys. The plan
        of ``incoming`` runs once; what it gives is staged by bucket in the shared folder. Rows without id
        are an error, as no key names them.
        """
        # a session of its own: its Parquet settings hold for this insert alone
        spark = incoming.sparkSession.newSession()
        spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(self.probe))
        schema, key = incoming.schema, self.keys[0]
        rows = incoming if unique else first_of_each(incoming, list(self.keys))
        named = F.when(F.col(key).isNull(), F.raise_error(F.lit("row without id"))).otherwise(F.col(key))
        bucket = F.pmod(F.xxhash64(named), F.lit(self.buckets)).cast("int")
        folder = shared_dir(spark, "staged")
        rows.withColumn(BUCKET, bucket).write.parquet(folder)
        staged = spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(folder)
        if is_complete(spark, self.path):
            touched = [r[0] for r in staged.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
            some = [r[0] for r in staged.select(key).distinct().limit(self.probe + 1).collect()]
            stored = self.stored_keys(spark, schema, touched, some if len(some) <= self.probe else [])
            again = keep_matching(stored, staged.select(*self.keys), list(self.keys))
            staged = staged.join(again, list(self.keys), "left_anti").select(staged.columns)
        self._write(staged, "append")

    def files(self, spark: SparkSession, schema: T.StructType) -> Counter:
        """Number of files of each bucket, from the listing alone."""
        mark = f"/{BUCKET}="
        names = self._scan(spark, schema).inputFiles()
        return Counter(int(unquote(n.split(mark)[1].split("/")[0])) for n in names)

    def compact(self, spark: SparkSession, schema: T.StructType, buckets: Iterable[int] | None = None,
                most_files: int = 8) -> list[int]:
        """Rewrite buckets (default: those of more than ``most_files`` files) as sorted files.

        Only these buckets are read, and replaced by a dynamic partition overwrite when the job commits.
        """
        chosen = sorted(b for b, n in self.files(spark, schema).items() if n > most_files) if buckets is None else sorted(buckets)
        if chosen:
            self._write(self._scan(spark, schema).where(F.col(BUCKET).isin(chosen)), "overwrite")
        return chosen
