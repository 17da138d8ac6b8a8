"""Registration of queries together with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from labtables.config import shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a table dealt out to all cores, before long texts are made of them.

    A narrow table of millions of rows is a small file, which a scan cuts into a few tasks or a single one.
    """
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


_WRITTEN: dict[tuple[str, str, str], str] = {}


def text_files(spark: SparkSession, sf_dir: str, name: str, make: Callable[[SparkSession, str], DataFrame],
               end: str = "\n") -> str:
    """Folder of text files with the rows of ``make`` (column ``value``), each closed by ``end``.

    The raw files of a query: written to the shared folder once for a session and a folder of tables.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        path = shared_dir(spark, name)
        make(spark, sf_dir).write.option("lineSep", end).text(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]
