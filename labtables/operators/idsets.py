"""Sets of whole-number ids as bitmaps, kept for each batch and merged without reading the batches again.

A set is a table (bucket, bits): a bitmap of 32 768 ids for each bucket that has any. Building it folds equal
ids before the shuffle; a union moves only bitmaps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 32_768


def id_set(df: DataFrame, key: str) -> DataFrame:
    """(bucket, bits) of the ids of a column; null ids are in no set."""
    rows = df.select(F.col(key).cast("long").alias("id")).where("id IS NOT NULL")
    return rows.groupBy(F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def union(*sets: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, sets).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def size(ids: DataFrame) -> DataFrame:
    """One row (n): the number of ids."""
    return ids.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias("n"))


def has(bits: Column, place: Column) -> Column:
    """True where the bit at a place is set; false without a bitmap."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.floor(byte / F.pow(F.lit(2), place % 8)) % 2 == 1, F.lit(False))


def members(ids: DataFrame, name: str = "id") -> DataFrame:
    """The ids of a set as rows."""
    places = F.sequence(F.lit(0), F.lit(WIDTH - 1))
    set_ = F.filter(places, lambda p: has(F.col("bits"), p))
    rows = ids.select("bucket", F.explode(set_).alias("place"))
    value = F.when(F.col("bucket") > 0, (F.col("bucket") - 1) * WIDTH + F.col("place") + 1).otherwise(
        F.col("bucket") * WIDTH - F.col("place"))
    return rows.select(value.cast("long").alias(name))


def not_in(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows whose id is not in the set; rows without id are in none."""
    bucket, place = F.bitmap_bucket_number(F.col(key)), F.bitmap_bit_position(F.col(key))
    sets = ids.select(F.col("bucket").alias("bucket_of_id"), F.col("bits").alias("bits_of_id"))
    joined = df.join(sets, bucket == F.col("bucket_of_id"), "left")
    return joined.where(F.col(key).isNull() | ~has(F.col("bits_of_id"), place)).select(df.columns)
