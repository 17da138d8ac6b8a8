"""Column helpers that steer how often an expression is evaluated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add or replace columns as the output of a one-row generator.

    A filter on a plain computed column is pushed below it as a copy of its expression; for a parser
    that would parse each file again, once per reference. Filters stay above a generator.
    """
    others = [c for c in df.columns if c not in columns]
    packed = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*others, F.explode(F.array(packed)).alias("once")).select(
        *others, *[F.col("once")[name].alias(name) for name in columns]
    )

