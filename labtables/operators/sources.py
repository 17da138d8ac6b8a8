"""Merging keys that several sources supply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tag(df: DataFrame, source: str) -> DataFrame:
    return df.withColumn("source", F.lit(source))


def merge_sources(tagged: DataFrame, key: str | list[str], *more: Column) -> DataFrame:
    """(key, sorted source tags) from rows (key, source); ``more`` are further aggregates of a key.

    The set of tags is the aggregation buffer: copies fall together before the shuffle, and a key
    never holds more than one entry per source.
    """
    keys = [key] if isinstance(key, str) else key
    return tagged.groupBy(*keys).agg(F.sort_array(F.collect_set("source")).alias("source"), *more)


def count_sources(tagged: DataFrame, key: str, line: str) -> DataFrame:
    """(key, sources as (source, times)): how many distinct lines of each source gave the key.

    Repeats are counts, not repeated tags, so the list stays as short as the number of sources.
    """
    per_source = (
        tagged.select(key, "source", line).distinct()
        .groupBy(key, "source").agg(F.count(F.lit(1)).alias("times"))
    )
    entries = F.sort_array(F.collect_list(F.struct("source", "times")))
    return per_source.groupBy(key).agg(entries.alias("sources"))
