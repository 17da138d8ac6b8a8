"""Levels and reproducible training/validation/testing splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtables.functions.hashing import choose, hash32
from labtables.schemas import LIMITED_WEIGHTS, OVERALL_WEIGHTS, USAGES


def split_label(key: Column, weights: Sequence[float], seed: int | str = 0,
                labels: Sequence[str] = USAGES) -> Column:
    """Label by the hash of ``key``: a row key splits rows, a group key keeps groups together."""
    return choose(hash32(key, seed), weights, labels)


def level(state: Column, sources: Column, more_than: int = 1) -> Column:
    """Only gas-phase rows are used; those in more than ``more_than`` sources count as overall."""
    return (
        F.when(~state.eqNullSafe(F.lit("gas")), "unused")
        .when(F.size(sources) > more_than, "overall")
        .otherwise("limited")
    )


def with_levels(spectra: DataFrame, structure_map: DataFrame, universe: DataFrame,
                more_than: int = 1) -> DataFrame:
    """(mid, index, level) by the joins mid → smiles → sources; repeated lines of the map count once."""
    return (
        spectra.select("mid", "index", "state")
        .join(structure_map.select("mid", "smiles").distinct(), "mid")
        .join(universe.select("smiles", "source"), "smiles")
        .select("mid", "index", level(F.col("state"), F.col("source"), more_than).alias("level"))
    )


def with_usage(leveled: DataFrame, seed: int | str = 0,
               overall: Sequence[float] = OVERALL_WEIGHTS,
               limited: Sequence[float] = LIMITED_WEIGHTS) -> DataFrame:
    """Usage per row from the hash of ``mid`` and the weights of its level: no shuffle, and rows of
    one mid agree within a level."""
    h = hash32(F.col("mid"), seed)
    return leveled.withColumn(
        "usage",
        F.when(F.col("level") == "overall", choose(h, overall, USAGES))
        .when(F.col("level") == "limited", choose(h, limited, USAGES))
        .otherwise("unused"),
    )


def split_and_repair(df: DataFrame, row_key: Column, group: str, weights: Sequence[float],
                     seed: int | str = 0) -> DataFrame:
    """Split by row, then give groups with mixed labels one of their own labels.

    The pick is the label of the group's row with the smallest row hash. Labels travel as small
    integers, so the aggregate stays a hash aggregate, combined before its shuffle.
    """
    codes = list(range(len(USAGES)))
    labelled = df.withColumn("row_hash", hash32(row_key, seed)).withColumn(
        "code", choose(F.col("row_hash"), weights, codes)
    )
    mixed = (
        labelled.groupBy(group)
        .agg(
            F.min("code").alias("low"),
            F.max("code").alias("high"),
            F.min_by("code", "row_hash").alias("pick"),
        )
        .where(F.col("low") != F.col("high"))
        .select(group, "pick")
    )
    code = F.coalesce(F.col("pick"), F.col("code"))
    usage = F.get(F.array(*[F.lit(u) for u in USAGES]), code)
    return labelled.join(mixed, group, "left").withColumn("usage", usage).drop("row_hash", "code", "pick")
