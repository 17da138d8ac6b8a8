"""Joins that keep, drop or replace keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNRESOLVED = "unresolved alias"


def known_keys(df: DataFrame, on: str | list[str]) -> DataFrame:
    """The keys once each. A repeated key is folded before the shuffle; the join reuses its
    partitioning. Skew splitting covers the left side of a semi or anti join only."""
    return df.select(*([on] if isinstance(on, str) else on)).distinct()


def keep_matching(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """Left rows whose key is known; each row once however often the key repeats on the right."""
    return left.join(known_keys(right, on), on, "left_semi")


def drop_matching(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """Left rows whose key is unknown on the right (resume lists, remaining documents)."""
    return left.join(known_keys(right, on), on, "left_anti")


def replace_key(left: DataFrame, mapping: DataFrame, key: str, new_key: str) -> DataFrame:
    """Left rows under the mapping's other key; rows without an entry are dropped."""
    return left.join(mapping.select(key, new_key), key).drop(key)


def resolve_aliases(aliases: DataFrame, canonical: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(canonical rows + alias rows with the canonical attributes, unresolved aliases).

    One hop only: an alias of an alias stays unresolved. Repeated canonical lines give an alias one row.
    """
    target = canonical.select(F.col("mid").alias("dupof"), "smiles").distinct()
    resolved = aliases.join(target, "dupof").select("mid", "smiles")
    lost = aliases.join(target, "dupof", "left_anti").withColumn("reason", F.lit(UNRESOLVED))
    return resolved.unionByName(canonical.select("mid", "smiles")), lost


def latest(df: DataFrame, keys: Sequence[str], order: Column, value: str) -> DataFrame:
    """Per key the value of the row with the highest order; the order must be unique in a key."""
    return df.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def first_of_each(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by its other columns, so repeated runs agree."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return (
        df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("row"))
        .select(*[F.col(c) if c in keys else F.col("row")[c].alias(c) for c in df.columns])
    )


def remaining(all_ids: DataFrame, done: DataFrame, key: str | list[str]) -> DataFrame:
    """Distinct ids not done yet."""
    cols = [key] if isinstance(key, str) else list(key)
    return drop_matching(all_ids.select(*cols).distinct(), done, cols)


def progress(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """One row: ids done, ids in all and the share in percent, rounded half to even."""
    n_all = todo.agg(F.count_distinct(key).alias("n_all"))
    n_done = keep_matching(done, todo, key).agg(F.count_distinct(key).alias("n_done"))
    return n_all.select(n_done.scalar().alias("n_done"), "n_all").withColumn(
        "percent",
        F.bround(F.try_divide(F.lit(100.0) * F.col("n_done"), F.col("n_all")), 3),
    )
