"""Exact quotas per stratum: the rows up to a place in the order of a hash, found without a global sort.

The place is narrowed down in rounds. Each round counts keys per stratum and range of hash values, a small
table whatever the number of keys, and goes on in the range that holds the place; after the last round it
is one hash value. Keys of equal hash are told apart by themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labtables.functions.hashing import hash32

# Bits of the hash that are settled after each round.
ROUNDS = (12, 24, 32)


def quota_places(n: Column, weights: Sequence[float]) -> list[Column]:
    """Number of keys before each boundary between labels: the shares of the weights, rounded down."""
    exact = [Fraction(str(w)) for w in weights]
    if not exact or min(exact) < 0 or sum(exact) == 0:
        raise ValueError("weights must be non-negative and not all zero")
    run = [sum(exact[:i + 1]) / sum(exact) for i in range(len(exact) - 1)]
    return [F.floor(n * F.lit(r.numerator) / F.lit(r.denominator)).cast("bigint") for r in run]


def boundaries(keys: DataFrame, stratum: str, key: str, weights: Mapping[str, Sequence[float]], seed: int | str = 0) -> DataFrame:
    """(stratum, place number, h, key): the first key behind each boundary, in the order of hash and key.

    ``keys`` are distinct (stratum, key). A boundary behind the last key has no row.
    """
    hashed = keys.select(stratum, key, hash32(F.col(key), seed).alias("h"))
    sizes = keys.groupBy(stratum).agg(F.count(F.lit(1)).alias("n"))
    wanted = reduce(DataFrame.unionByName, [
        sizes.where(F.col(stratum) == name).select(stratum, F.posexplode(F.array(*quota_places(F.col("n"), w))).alias("number", "place"))
        for name, w in weights.items()
    ])
    # ``low`` is the start of the range that is left, ``place`` the number of keys of the range before the boundary
    left = wanted.withColumn("low", F.lit(0).cast("bigint"))
    settled = 0
    for bits in ROUNDS:
        span, width = 1 << (32 - settled), 1 << (32 - bits)
        inside = hashed.join(left.select(stratum, "low").distinct(), stratum).where(
            (F.col("h") >= F.col("low")) & (F.col("h") < F.col("low") + F.lit(span)))
        start = (F.floor(F.col("h") / F.lit(width)) * F.lit(width)).cast("bigint")
        counts = inside.groupBy(stratum, "low", start.alias("start")).agg(F.count(F.lit(1)).alias("m"))
        before = Window.partitionBy(stratum, "low").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0)))
        left = left.join(counts, [stratum, "low"]).where(
            (F.col("before") <= F.col("place")) & (F.col("place") < F.col("before") + F.col("m"))
        ).select(stratum, "number", (F.col("place") - F.col("before")).alias("place"), F.col("start").alias("low"))
        settled = bits
    # keys of one hash value are few: their place among them decides
    ties = hashed.join(left.select(stratum, F.col("low").alias("h")).distinct(), [stratum, "h"])
    ties = ties.withColumn("at", F.row_number().over(Window.partitionBy(stratum, "h").orderBy(key)).cast("bigint") - 1)
    return left.withColumnRenamed("low", "h").join(ties, [stratum, "h"]).where(F.col("at") == F.col("place")).select(
        stratum, "number", "h", key)


def with_quotas(df: DataFrame, stratum: str, key: str, weights: Mapping[str, Sequence[float]], labels: Sequence[str],
                name: str = "usage", other: str = "unused", seed: int | str = 0) -> DataFrame:
    """Add the label of each row: in every stratum the labels have exactly their shares of the distinct keys.

    All rows of a key in a stratum share its label. Rows of a stratum without weights, without stratum or
    without key get ``other``.
    """
    keys = df.where(F.col(stratum).isin(*weights) & F.col(key).isNotNull()).select(stratum, key).distinct()
    bounds = boundaries(keys, stratum, key, weights, seed)
    # as many entries as there are labels, less one, for each stratum that is named
    cuts = bounds.groupBy(stratum).agg(F.sort_array(F.collect_list(F.struct("h", F.col(key).alias("k")))).alias("cuts"))
    known = df.join(F.broadcast(cuts), stratum, "left")
    mine = F.struct(hash32(F.col(key), seed).alias("h"), F.col(key).alias("k"))
    at = F.size(F.filter(F.coalesce("cuts", F.array().cast(cuts.schema["cuts"].dataType)), lambda c: c <= mine))
    named = F.col(stratum).isin(*weights) & F.col(key).isNotNull()
    label = F.when(named, F.get(F.array(*map(F.lit, labels)), at)).otherwise(F.lit(other))
    return known.withColumn(name, F.coalesce(label, F.lit(other))).select(*df.columns, name)
