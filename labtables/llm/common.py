"""Helpers that several operators share: shared scratch, bounded worker caches, samples, components."""

from __future__ import annotations

import sys
import tempfile
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labtables.config import shared_dir


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by files in the folder that the cluster names in spark.checkpoint.dir.

    Only a local session (tests) without that setting gets a temporary folder of its own.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="llm-checkpoint-")
        sc.setCheckpointDir(folder)
    return df.checkpoint()


def worker_cache(name: str) -> dict:
    """A dictionary that tasks of one Python worker share until a task asks for another name.

    A worker serves the stages of a job one after the other; it holds the cache of the last one alone.
    """
    caches = sys.__dict__.setdefault("llm_worker_caches", {})
    for other in [x for x in caches if x != name]:
        del caches[other]
    return caches.setdefault(name, {})


def grow(cache: dict, key, value, limit: int):
    """Store a value; a full cache starts anew, so that its memory is bounded and nothing is lost."""
    if len(cache) >= limit:
        cache.clear()
    cache[key] = value
    return value


def held_out(doc_id: Column) -> Column:
    """True for the fold that no model learns labels from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def hash_sample(df: DataFrame, key: str, bound: int) -> DataFrame:
    """At most ``bound`` rows, those with the smallest hash of ``key``; the same rows on each call."""
    return df.orderBy(F.xxhash64(key), key).limit(bound)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers with well spread bits (shift, multiply)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _changed(before: DataFrame, after: DataFrame) -> bool:
    sums = [F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    return before.agg(*sums).first() != after.agg(*sums).first()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node of an edge list reaches.

    Alternating stars: every node links its larger neighbours to its smallest neighbour, then its
    smaller ones. Nodes only ever move between aggregated minima and joins, so a star with very many
    leaves is combined on the map side and its join side can be split; the rounds are logarithmic.
    Loops and repeated edges are allowed; edges with a null end are ignored.
    """
    links = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    links = checkpoint(links.distinct())
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = checkpoint(large.distinct())
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = checkpoint(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
        if not _changed(links, after):
            break
        links = after
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def row_pieces(rows: int, size: int) -> Sequence[tuple[int, int]]:
    return [(i, min(i + size, rows)) for i in range(0, rows, size)]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as it reads back from files in the shared folder; its plan runs once, here."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
