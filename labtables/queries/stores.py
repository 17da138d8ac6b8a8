"""Loading documents: one commit for a batch, a store in buckets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from labtables.config import shared_dir
from labtables.queries.base import query, table
from labtables.queries.documents import documents_in_parts
from labtables.sinks.buckets import BucketStore
from labtables.sinks.bulk import FolderTarget, bulk_insert_committed, insert_batch, read_batches
from labtables.sinks.layout import read_bucketed, write_bucketed


@dataclass(frozen=True)
class LosesOneTask(FolderTarget):
    """A target whose first task fails, after it staged its rows, the first time it runs."""

    def stage(self, task, batches):
        pieces = super().stage(task, batches)
        context = TaskContext.get()
        if context.partitionId() == 0 and context.attemptNumber() == 0:
            raise RuntimeError("the executor is lost")
        return pieces


def contents(stored):
    """Per document the number of items of each list and a sum over what they hold."""
    whole = lambda c: F.round(c * 100).cast("bigint")
    total = lambda items, value: F.coalesce(F.aggregate(
        items, F.lit(0).cast("bigint"), lambda s, x: s + value(x)), F.lit(0).cast("bigint"))
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("bigint")
    return stored.groupBy("_id").agg(
        F.sum(size(F.col("external_id.nist"))).alias("n_ids"),
        F.sum(total(F.col("external_id.nist"), lambda x: x.cast("bigint"))).alias("ids"),
        F.sum(size(F.col("expir"))).alias("n_spectra"),
        F.sum(total(F.col("expir"), lambda s: whole(F.get(s["vec"], F.lit(0))))).alias("spectra"),
        F.sum(size(F.col("thir"))).alias("n_methods"),
        F.sum(total(F.col("thir"), lambda t: F.get(t["freqs"], F.lit(0))["freq"].cast("bigint"))).alias("freqs"),
        F.max(whole(F.col("mass"))).alias("mass"),
    )


CONTENTS_SQL = """
WITH e AS (SELECT CAST(o_custkey AS VARCHAR) AS id, count(*) AS n_ids, sum(o_orderkey)::BIGINT AS ids FROM orders GROUP BY 1),
p AS (SELECT id, count(*) AS n_spectra, sum(CAST(round(o_totalprice * 100) AS BIGINT))::BIGINT AS spectra FROM (
  SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id, o_totalprice, o_orderstatus, o_orderpriority FROM orders) GROUP BY 1),
t AS (SELECT CAST(user_id AS VARCHAR) AS id, count(*) AS n_methods, sum(event_id)::BIGINT AS freqs FROM events GROUP BY 1),
c AS (SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(round(c_acctbal * 100) AS BIGINT) AS mass FROM customer WHERE c_acctbal > 0)
SELECT id AS _id, coalesce(n_ids, 0) AS n_ids, coalesce(ids, 0) AS ids, coalesce(n_spectra, 0) AS n_spectra,
  coalesce(spectra, 0) AS spectra, coalesce(n_methods, 0) AS n_methods, coalesce(freqs, 0) AS freqs, mass
FROM e FULL OUTER JOIN p USING (id) FULL OUTER JOIN t USING (id) FULL OUTER JOIN c USING (id)
"""


@query("bulk_insert_commit", CONTENTS_SQL)
def bulk_insert_commit(spark, d):
    """Documents in parts; one task is lost once, the batch is sent again and every item is there once.

    Where tasks are retried the first insert gets through and the second finds its batch; where they are
    not (a local session) it fails as a whole and the second inserts it.
    """
    path = shared_dir(spark, "batches")
    documents = documents_in_parts(spark, d)
    try:
        bulk_insert_committed(documents, LosesOneTask(path, "first"))
    except PySparkException as lost:
        if "the executor is lost" not in str(lost):
            raise
    insert_batch(documents, path, "first")
    return contents(read_batches(spark, path, documents.schema))


@query("bucket_inserts", CONTENTS_SQL)
def bucket_inserts(spark, d):
    """Documents in parts into a store in buckets: a few first, then all of them, then all again."""
    documents = documents_in_parts(spark, d)
    store = BucketStore(shared_dir(spark, "buckets"), buckets=16)
    for rows in (documents.where("_id % 50 = 0"), documents, documents):
        store.insert(rows, unique=True)
    return contents(store.read(spark, documents.schema))


@query("bucket_compaction", """
SELECT c_custkey AS _id, c_name FROM customer
""")
def bucket_compaction(spark, d):
    """Customers segment by segment, repeated rows included, then the buckets are rewritten."""
    customer = table(spark, d, "customer").select(F.col("c_custkey").alias("_id"), "c_name", "c_mktsegment")
    store = BucketStore(shared_dir(spark, "buckets"), ["_id"], buckets=4)
    rows = customer.select("_id", "c_name")
    store.insert(rows.where(F.col("c_mktsegment") == "BUILDING"))
    store.insert(rows.unionByName(rows))
    store.compact(spark, rows.schema, most_files=1)
    return store.read(spark, rows.schema)


def bucketed(spark, d, name, columns, key):
    rows, path = table(spark, d, name).select(*columns), shared_dir(spark, name)
    write_bucketed(rows, path, key, 8)
    return read_bucketed(spark, path, rows.schema, key, 8)


@query("bucketed_join", """
SELECT c_custkey, c_name, count(o_orderkey) AS n, max(o_totalprice) AS most FROM customer
LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name
""")
def bucketed_join(spark, d):
    """Orders and customers kept in buckets of the customer: joined and counted without a shuffle."""
    customer = bucketed(spark, d, "customer", ["c_custkey", "c_name"], "c_custkey")
    orders = bucketed(spark, d, "orders", ["o_custkey", "o_orderkey", "o_totalprice"], "o_custkey")
    # the join of two large tables; a small side would be broadcast
    joined = customer.hint("merge").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.groupBy("c_custkey", "c_name").agg(F.count("o_orderkey").alias("n"), F.max("o_totalprice").alias("most"))
