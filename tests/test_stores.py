"""Bulk insert with one commit, and the store in buckets."""

import sys

import pytest
from pyspark import TaskContext, cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from labtables.sinks.buckets import BucketStore
from labtables.sinks.bulk import FolderTarget, batches, bulk_insert_committed, insert_batch, read_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "_id string, part long, items array<struct<a long, b string>>"


def docs(spark, low, high):
    ids = spark.range(low, high).repartition(4)
    item = F.struct(F.col("id").alias("a"), F.lit("x").alias("b"))
    return ids.select(F.concat(F.lit("k"), "id").alias("_id"), F.lit(0).cast("long").alias("part"), F.array(item).alias("items"))


class Fails(FolderTarget):
    def stage(self, task, rows):
        pieces = super().stage(task, rows)
        if TaskContext.get().partitionId() == 1:
            raise RuntimeError("lost")
        return pieces


def test_failed_batch_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "store")
    assert read_batches(spark, path, SCHEMA).count() == 0
    with pytest.raises(PySparkException, match="lost"):
        bulk_insert_committed(docs(spark, 0, 100), Fails(path, "one"))
    assert any((tmp_path / "store" / "pieces").iterdir())  # staged by the tasks that got through
    assert read_batches(spark, path, SCHEMA).count() == 0
    assert insert_batch(docs(spark, 0, 100), path, "one") and not insert_batch(docs(spark, 0, 100), path, "one")
    assert insert_batch(docs(spark, 100, 130), path, "two") and insert_batch(docs(spark, 0, 0), path, "none")
    rows = read_batches(spark, path, SCHEMA)
    assert rows.count() == 130 and rows.select("_id").distinct().count() == 130
    assert rows.where("_id = 'k7'").first()["items"][0].asDict() == {"a": 7, "b": "x"}
    assert {r["batch"]: r["n_rows"] for r in batches(spark, path).collect()} == {"one": 100, "two": 30}


def scanned_rows(df):
    """Rows that the Parquet scan of a plan without exchange gave."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def test_store_in_buckets(spark, tmp_path):
    store = BucketStore(str(tmp_path / "store"), buckets=8)
    schema = docs(spark, 0, 1).schema
    assert store.read(spark, schema).count() == 0
    store.insert(docs(spark, 0, 400))
    store.insert(docs(spark, 300, 500).unionByName(docs(spark, 450, 500)))
    rows = store.read(spark, schema)
    assert rows.count() == 500 and rows.select("_id").distinct().count() == 500
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    store.insert(docs(spark, 0, 500))
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")} == before
    with pytest.raises(Exception, match="row without id"):
        store.insert(docs(spark, 0, 1).withColumn("_id", F.lit(None).cast("string")))
    other = docs(spark, 3, 4).withColumn("part", F.lit(1).cast("long"))
    store.insert(other)  # another part of a stored id
    assert store.read(spark, schema).count() == 501


def test_untouched_buckets_are_not_read(spark, tmp_path):
    store = BucketStore(str(tmp_path / "store"), buckets=8)
    schema = docs(spark, 0, 1).schema
    store.insert(docs(spark, 0, 400))
    assert set(store.files(spark, schema)) == set(range(8))
    keys = store.stored_keys(spark, schema, [3], [])
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "items" not in plan
    in_bucket = {r["_id"] for r in keys.collect()}
    assert in_bucket and scanned_rows(store.stored_keys(spark, schema, [3], [])) == len(in_bucket) < 400
    session = spark.newSession()
    session.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", "1000")
    # ids between stored ones, so that the files' smallest and largest id do not exclude them
    absent = [f"k{i}x" for i in range(20, 60)]
    assert scanned_rows(store.stored_keys(session, schema, [3], absent)) == 0
    assert scanned_rows(store.stored_keys(session, schema, [3], [min(in_bucket), *absent])) == len(in_bucket)


def test_compaction_replaces_chosen_buckets(spark, tmp_path):
    store = BucketStore(str(tmp_path / "store"), buckets=4)
    schema = docs(spark, 0, 1).schema
    for low in (0, 100, 200):
        store.insert(docs(spark, low, low + 100))
    kept = {p for p in (tmp_path / "store" / "bucket=1").glob("*.parquet")}
    assert store.compact(spark, schema, [0, 2]) == [0, 2] and store.compact(spark, schema) == []
    assert {p for p in (tmp_path / "store" / "bucket=1").glob("*.parquet")} == kept
    n = store.files(spark, schema)
    assert n[0] == n[2] == 1 < n[1]
    rows = store.read(spark, schema)
    assert rows.count() == 300 and rows.select("_id").distinct().count() == 300
