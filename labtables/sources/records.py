"""Scans of files that hold many records, split between records.

A record ends at a separator, which the scan takes for the end of a line: a large file is cut into
splits like any text file and its records go to as many tasks. Small files are packed into splits. The
name of a record is in its text, as the file's name serves all of its records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labtables.functions.strings import INLINE_BLANK, strip
from labtables.sources.tagged import RECORD_END

# Fixed value: the line that ends a labelled record.
LABELLED_END = "\n##END="


def records(spark: SparkSession, path: str | list[str], end: str, name: Column) -> DataFrame:
    """(file, content, path) for each record; ``name`` is computed from the column ``content``.

    Text behind the last separator of a file is a record too, unless it is blank.
    """
    found = spark.read.option("lineSep", end).text(path).select(
        F.col("value").alias("content"), F.col("_metadata.file_name").alias("path")
    )
    # any letter, digit or mark: no trimmed copy of each record only to see that it is not blank
    return found.where(F.rlike("content", F.lit(r"[^\x00-\x20]"))).select(name.alias("file"), "content", "path")


def labelled_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Labelled records of files with one or many of them; the name is the value of the header TITLE."""
    title = rf"(?:^|\n)##{INLINE_BLANK}*TITLE{INLINE_BLANK}*=([^\r\n]*)"
    return records(spark, path, LABELLED_END, strip(F.regexp_extract("content", title, 1)))


def tagged_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Property records of files with one or many of them; the name is the record's first line with text."""
    return records(spark, path, RECORD_END, F.regexp_extract("content", r"([^\x00-\x20][^\r\n]*?)[\x00-\x20]*(?:[\r\n]|$)", 1))
