"""One nested document per key, in fragments where a list is too long for one row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtables.operators.skew import collect_parts, join_parts, key_counts

# Items per fragment, so that a row stays around 10 MB whatever a key holds; parameters of ``documents``.
SPECTRA_PER_ROW = 2_000
METHODS_PER_ROW = 2_000
IDS_PER_ROW = 100_000
DOCUMENT_KEY = ("_id", "part")


def external_ids(structure_map: DataFrame, limit: int = IDS_PER_ROW) -> DataFrame:
    return collect_parts(
        structure_map.select("smiles", "mid").distinct(), ["smiles"], F.col("mid"), "nist", limit=limit,
        counts=key_counts(structure_map, ["smiles"]),
    )


def spectra_lists(measured: DataFrame, structure_map: DataFrame, limit: int = SPECTRA_PER_ROW) -> DataFrame:
    """(smiles, part, expir) with the distinct spectra of a structure."""
    known = structure_map.select("mid", "smiles").distinct()
    rows = measured.join(known, "mid").select("smiles", "vec", "state", "state_info").distinct()
    # counted on the ids alone: an upper bound, as equal spectra fall together later
    counts = key_counts(measured.select("mid").join(known, "mid"), ["smiles"])
    item = F.struct("vec", "state", "state_info")
    return collect_parts(rows, ["smiles"], item, "expir", [F.col("state"), F.col("state_info")], limit, counts=counts)


def method_lists(computed: DataFrame, limit: int = METHODS_PER_ROW) -> DataFrame:
    rows = computed.select("smiles", "method", "freqs").distinct()
    item = F.struct("method", "freqs")
    order = [F.col("method"), F.col("freqs")]
    return collect_parts(rows, ["smiles"], item, "thir", order, limit, counts=key_counts(computed, ["smiles"]))


def merge_parts(sides: list[DataFrame], big: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer merge on ``keys`` of sides that each have a key at most once.

    The small sides are stacked and folded in one shuffle; its partitioning also serves the join
    with the big side, so every row is shuffled once.
    """
    values = [c for s in sides for c in s.columns if c not in keys]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    folded = stacked.groupBy(*keys).agg(*[F.first(v, ignorenulls=True).alias(v) for v in values])
    return folded.join(big, keys, "full_outer")


def documents(structure_map: DataFrame, measured: DataFrame, computed: DataFrame, universe: DataFrame,
              spectra_per_row: int = SPECTRA_PER_ROW, methods_per_row: int = METHODS_PER_ROW,
              ids_per_row: int = IDS_PER_ROW) -> DataFrame:
    """Documents ``_id, part, mass, source, fg, external_id, expir, thir`` with the key (_id, part).

    Part 0 is the document itself, further parts carry on its longer lists, which hold at most so many
    items per row as the parameters say. Absent fields are null.
    """
    sides = [
        spectra_lists(measured, structure_map, spectra_per_row),
        method_lists(computed, methods_per_row),
        external_ids(structure_map, ids_per_row),
    ]
    base = universe.select("smiles", F.lit(0).cast("bigint").alias("part"), "mass", "source", "fg")
    merged = merge_parts(sides, base, ["smiles", "part"])
    external = F.when(F.col("nist").isNotNull(), F.struct("nist"))
    return merged.select(
        F.col("smiles").alias("_id"), "part", "mass", "source", "fg",
        external.alias("external_id"), "expir", "thir",
    )


def last_wins(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One value per key, the one with the highest order."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def document_items(documents: DataFrame, field: str) -> DataFrame:
    """(_id, part, place, value): the items of a list field over all parts of the documents."""
    return join_parts(documents.select(*DOCUMENT_KEY, F.col(field).alias("items")), ["_id"], "items")
