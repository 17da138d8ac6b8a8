"""File sinks and ledgers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labtables.config import is_complete, path_exists
from labtables.operators.coords import format_atoms


def write_new(df: DataFrame, path: str) -> None:
    """Write Parquet; an existing path is an error."""
    df.write.mode("errorifexists").parquet(path)


def export_json(spark: SparkSession, folder: str, names: Iterable[str]) -> list[str]:
    """Export tables of a folder to ``<name>.json`` next to them; those that are complete and not
    exported yet. Returns the names written."""
    written = []
    for name in names:
        source, target = f"{folder}/{name}", f"{folder}/{name}.json"
        if is_complete(spark, source) and not path_exists(spark, target):
            spark.read.parquet(source).write.json(target)
            written.append(name)
    return written


def write_documents(df: DataFrame, path: str, as_json: bool = False) -> None:
    """Nested documents as Parquet, or one JSON object per line with absent fields left out."""
    if as_json:
        df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.text(path)
    else:
        write_new(df, path)


def write_coords(df: DataFrame, path: str) -> None:
    """``key<TAB>n;type,x,y,z;…`` lines from (key, atoms)."""
    df.select(F.concat_ws("\t", "key", format_atoms(F.col("atoms"))).alias("value")).write.text(path)


def write_lines(df: DataFrame, path: str, folder: str | None = None) -> None:
    """Text lines from a column ``value``, in a subfolder for each value of the column ``folder``."""
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(folder) if folder else writer).text(path)


def append_ledger(df: DataFrame, path: str) -> None:
    """Add rows to a ledger; the commit of the write is its end marker."""
    df.write.mode("append").parquet(path)


def read_ledger(spark: SparkSession, path: str, schema) -> DataFrame:
    """A ledger that was never written is empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
