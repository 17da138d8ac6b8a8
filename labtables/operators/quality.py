"""Validity, rejects and checksum audit."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Check = Callable[[pd.Series], pd.Series]


def filter_valid(df: DataFrame, key: str, check: Column | Check, partitions: int | None = None) -> DataFrame:
    """Rows whose key passes the check.

    A Column is a plain filter. A vectorised Python function runs once per distinct key, in Arrow
    batches, and its survivors select the rows by a semi join. ``partitions`` deals the keys out to
    that many tasks where the function is slow.
    """
    if isinstance(check, Column):
        return df.where(check)

    def passing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[check(batch[key]).to_numpy(dtype=bool)]

    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    if partitions:
        keys = keys.repartition(partitions)
    return df.join(keys.mapInPandas(passing, keys.schema), key, "left_semi")


def count_reasons(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def audit(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """Ledger rows (filename, md5) against files (filename, content): ok, missing or mismatch."""
    actual = files.select("filename", F.md5("content").alias("actual"))
    status = (
        F.when(F.col("actual").isNull(), "missing")
        .when(F.col("actual") == F.col("md5"), "ok")
        .otherwise("mismatch")
    )
    return ledger.join(actual, "filename", "left").withColumn("status", status).drop("actual")


def verified(audited: DataFrame) -> DataFrame:
    return audited.where(F.col("status") == "ok").drop("status")
