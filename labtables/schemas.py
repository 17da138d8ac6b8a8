"""Row schemas of the tables and the values they fix."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# Default grid (inclusive ends), resolution limit, split weights, gas-phase states.
GRID_MIN, GRID_MAX, GRID_STEP = 670, 3702, 4
MAX_GAP = 50
OVERALL_WEIGHTS = (5, 3, 3)
LIMITED_WEIGHTS = (4, 1, 1)
USAGES = ("training", "validation", "testing")
STATES = ("gas", "solid", "liquid", "solution")

# Names of the boolean flags of the universe table, in column order.
FLAG_NAMES = (
    "acid", "aldehyde", "amide", "anhydride", "ketone", "ester", "carbonyl", "alkane", "alkyne",
    "aromatic", "amine", "ether", "nitrile", "nitro", "CF", "CCl", "CBr", "CI", "alcohol", "alkene",
)

STRUCTURE_MAP = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("smiles", T.StringType()),
])
MEASURED = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("index", T.IntegerType()),
    T.StructField("vec", T.ArrayType(T.DoubleType())),
    T.StructField("state", T.StringType()),
    T.StructField("state_info", T.StringType()),
])
PEAKS = T.ArrayType(T.StructType([
    T.StructField("freq", T.DoubleType()),
    T.StructField("intensity", T.DoubleType()),
]))
COMPUTED = T.StructType([
    T.StructField("smiles", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("freqs", PEAKS),
])
PARSED_PROPERTIES = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("freqsformat", T.StringType()),
    T.StructField("freqs", PEAKS),
    T.StructField("reason", T.StringType()),
])
PARSED_SERIES = T.StructType([
    T.StructField("file", T.StringType()),
    *MEASURED.fields,
    T.StructField("reason", T.StringType()),
])
USAGE = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("index", T.IntegerType()),
    T.StructField("level", T.StringType()),
    T.StructField("usage", T.StringType()),
])
REJECTS = T.StructType([
    T.StructField("input", T.StringType()),
    T.StructField("line", T.StringType()),
    T.StructField("reason", T.StringType()),
])


def flag_struct(names: Iterable[str] = FLAG_NAMES) -> T.StructType:
    """One boolean field per dictionary entry, known when the plan is built."""
    return T.StructType([T.StructField(n, T.BooleanType()) for n in names])


def universe(names: Iterable[str] = FLAG_NAMES) -> T.StructType:
    return T.StructType([
        T.StructField("smiles", T.StringType()),
        T.StructField("mass", T.DoubleType()),
        T.StructField("fg", flag_struct(names)),
        T.StructField("source", T.ArrayType(T.StringType())),
    ])

