"""Tables kept in hash buckets of a key, each sorted by it, so that joins on the key move no rows.

The files carry their bucket in their names; the number of buckets and the key are told to Spark again when
a session first reads the path. Two tables join without a shuffle if they have the same number of buckets
on the join's key. Keys of very many rows make uneven buckets, and a join between buckets does not split
them: keep tables with such keys as plain Parquet, where the join's shuffle is split at run time.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _name(path: str, schema: T.StructType, key: str, buckets: int) -> str:
    text = "\\0".join([path, schema.simpleString(), key, str(buckets)])
    return f"labtables_{hashlib.md5(text.encode()).hexdigest()}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Replace the files at ``path`` by those of ``df``, one task and one file for each bucket."""
    name = _name(path, df.schema, key, buckets)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")  # an external table: its files stay
    dealt = df.repartition(buckets, F.col(key))
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """The table at ``path`` with its buckets; ``schema`` is that with which it was written."""
    name = _name(path, schema, key, buckets)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)
