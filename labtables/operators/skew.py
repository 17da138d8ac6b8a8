"""Bounded grouping: no key, however hot, meets one task or one row as a whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LIST_LIMIT = 100_000
# A key is split above this many lists' worth of rows; a task sorts about one such piece at a time.
LISTS_PER_TASK = 10
# Candidates for each boundary between the pieces of a key; more of them make the pieces more even.
CANDIDATES = 8


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, rows_of_key), combined on the map side; only the key columns are read."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_of_key"))


def hot_keys(counts: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """(keys, fan, every): keys of more than ``rows`` rows, the pieces to cut each into, and the step
    between rows that may be boundaries. A key's own count decides, whatever other keys hold."""
    fan = F.ceil(F.col("rows_of_key") / F.lit(rows)).cast("bigint")
    every = F.greatest(F.floor(F.col("rows_of_key") / (fan * F.lit(CANDIDATES))), F.lit(1)).cast("bigint")
    return counts.where(F.col("rows_of_key") > rows).select(*keys, fan.alias("fan"), every.alias("every"))


def with_piece(rows: DataFrame, keys: Sequence[str], place: Sequence[str], hot: DataFrame) -> DataFrame:
    """Add ``piece``: 0 for ordinary keys; for hot ones the number of boundaries up to a row's place.

    Boundaries are rows of the key that a hash picks, about ``CANDIDATES`` for each piece, thinned to
    ``fan - 1``. Pieces follow each other in the order of ``place``.
    """
    at = F.struct(*place)
    picked = (
        rows.select(*keys, *place).join(hot, list(keys))
        .where(F.pmod(F.xxhash64(*place, F.lit("boundary")), F.col("every")) == 0)
        .groupBy(*keys, "fan").agg(F.sort_array(F.collect_set(at)).alias("candidates"))
    )
    step = F.greatest(F.floor(F.size("candidates") / F.col("fan")), F.lit(1)).cast("int")
    cut = F.filter("candidates", lambda _, i: (i > 0) & (i % F.col("step") == 0))
    bounds = picked.withColumn("step", step).select(*keys, cut.alias("bounds"))
    below = F.size(F.filter("bounds", lambda b: b <= at))
    return (
        rows.join(bounds, list(keys), "left")
        .withColumn("piece", F.coalesce(below, F.lit(0)))
        .drop("bounds")
    )


def collect_parts(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    name: str,
    order: Sequence[Column] | None = None,
    limit: int = LIST_LIMIT,
    rows: int | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Lists of values per key, sorted, as (keys, part, list) with at most ``limit`` items each.

    Values are ordered by ``order`` (default: the value), ties by a hash of the value, and part p holds
    the places p * limit to (p + 1) * limit - 1 of that order, whatever other keys there are. Keys of
    more than ``rows`` rows (default: ``LISTS_PER_TASK`` lists) are sorted in pieces; the counts of the
    pieces give each its first place. ``counts`` may bring (keys, rows_of_key), also upper bounds, so
    that ``df`` is not counted.
    """
    rows = rows or LISTS_PER_TASK * limit
    sort_cols = [f"sort_{i}" for i in range(len(order or [value]))]
    items = df.select(
        *keys, value.alias("item"), *[c.alias(s) for c, s in zip(order or [value], sort_cols)]
    ).withColumn("tie", F.xxhash64("item"))
    place = [*sort_cols, "tie"]
    hot = hot_keys(key_counts(df, keys) if counts is None else counts, keys, rows)
    items = with_piece(items, keys, place, hot)
    inside = Window.partitionBy(*keys, "piece").orderBy(*place)
    numbered = items.withColumn("at", F.row_number().over(inside).cast("bigint") - 1)
    before = Window.partitionBy(*keys).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        items.join(hot.select(*keys), list(keys), "left_semi").groupBy(*keys, "piece")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*keys, "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    at = F.col("at") + F.coalesce("first", F.lit(0))
    return (
        numbered.join(firsts, [*keys, "piece"], "left")
        .select(*keys, "item", at.alias("at"))
        .groupBy(*keys, F.floor(F.col("at") / F.lit(limit)).cast("bigint").alias("part"))
        .agg(F.sort_array(F.collect_list(F.struct("at", "item"))).alias("packed"))
        .select(*keys, "part", F.transform("packed", lambda s: s["item"]).alias(name))
    )


def join_parts(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """(keys, place, value): the items of all parts of a key with their place in the whole list.

    Places count from 0 within a part and parts come in order, so ``(part, place)`` orders the list.
    """
    return df.select(*keys, "part", F.posexplode(name).alias("place", "value"))
