"""Per-key enrichment by a Python function and boolean flags from a pattern dictionary."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Enricher = Callable[[pd.Series], pd.DataFrame]


def enrich_unique(df: DataFrame, key: str, fn: Enricher, schema: T.StructType,
                  partitions: int | None = None) -> DataFrame:
    """Add the columns of ``schema`` to rows whose key is unique; failing keys are dropped.

    ``fn`` gets a batch of keys and returns flat columns under the same index, without the failing
    ones. The rows go through Python once and come back enriched, so that no filter on the result can
    make a second call of it. ``partitions`` deals the rows out to that many tasks where the function
    is slow; a shuffle before may have left few large ones.
    """
    if partitions:
        df = df.repartition(partitions)
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = fn(batch[key])
            yield batch.loc[found.index].assign(**{n: found[n] for n in names})

    return df.mapInPandas(run, T.StructType([*df.schema.fields, *schema.fields]))


def enrich(df: DataFrame, key: str, fn: Enricher, schema: T.StructType,
           partitions: int | None = None) -> DataFrame:
    """As ``enrich_unique`` for repeated keys: the function sees each key once.

    Keys fall together and meet their rows again by a 256-bit digest, so that long texts are shuffled
    once each, for the function, and never for the join.
    """
    digest = F.sha2(F.col(key).cast("binary"), 256)
    named = df.withColumn("key_digest", digest)
    keys = named.where(F.col(key).isNotNull()).groupBy("key_digest").agg(F.any_value(key).alias(key))
    found = enrich_unique(keys, key, fn, schema, partitions).drop(key)
    return named.join(found, "key_digest").drop("key_digest")


def matches(text: Column, pattern: str) -> Column:
    """Regular-expression search; plain words and alternatives of them need no regular expression."""
    words = pattern.split("|")
    if all(re.fullmatch(r"[\w \-/@:,;<>=\"']+", w) for w in words):
        return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])
    return F.rlike(text, F.lit(pattern))


def pattern_flags(text: Column, dictionary: Iterable[tuple[str, str]]) -> Column:
    """Struct with one boolean per (pattern, name): does the text match the pattern?"""
    return F.struct(*[matches(text, p).alias(n) for p, n in dictionary])


def read_dictionary(parsed: DataFrame, limit: int = 10_000) -> list[tuple[str, str]]:
    """The entries of a pattern dictionary, needed on the driver because they become columns.

    More than ``limit`` entries are an error, as each becomes a column of every row.
    """
    rows = parsed.select("pattern", "name").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a pattern dictionary makes columns; over {limit} entries are no dictionary")
    return [(r["pattern"], r["name"]) for r in rows]


def fold_flags(names: Iterable[str], alias: str = "fg") -> Column:
    """Flat boolean columns as one struct column."""
    return F.struct(*[F.col(n).alias(n) for n in names]).alias(alias)
