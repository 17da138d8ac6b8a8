"""Versioned text ledgers: a new version is written beside the old one and taken over in one step.

A ledger is a folder of versions and a pointer, a small file that is swapped when a version is complete.
Readers follow the pointer, so they see a whole version and never one that is being written. Each
version is text as a crawler writes it; if the ledger is finished, its last file holds the end marker.
Lines come in the order of file names and of places in a file, which the writers keep to.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labtables.config import read_small, swap_small
from labtables.operators.keys import remaining
from labtables.operators.quality import audit, verified
from labtables.operators.skew import collect_parts
from labtables.sources.text import DONE, current_lines, parse_checksums

POINTER = "_current"
LAST_FILE = "~end"
BLOCK_ROWS = 1000


def current(spark: SparkSession, path: str) -> dict | None:
    """Folder and state of the version in force; null before the first."""
    text = read_small(spark, f"{path}/{POINTER}")
    return json.loads(text) if text else None


def is_done(spark: SparkSession, path: str) -> bool:
    """The ledger is finished: its step need not run again."""
    state = current(spark, path)
    return bool(state and state["done"])


def write_version(lines: DataFrame, path: str, done: bool = False, keep: bool = False) -> str:
    """Write lines (column ``value``) as the next version and make it the current one; its folder.

    ``keep`` carries the files of the current version on by name, so that adding rows copies none.
    ``done`` adds the end marker behind all lines. Adding to a finished ledger opens it again.
    """
    spark = lines.sparkSession
    before = current(spark, path)
    folder = f"{path}/v-{uuid.uuid4().hex}"
    lines.select("value").write.mode("errorifexists").text(folder)
    if done:
        swap_small(spark, f"{folder}/{LAST_FILE}", f"{DONE}\n")
    folders = [*(before["folders"] if before and keep else []), folder]
    swap_small(spark, f"{path}/{POINTER}", json.dumps({"folders": folders, "done": done}))
    return folder


def write_ranges(df: DataFrame, path: str, done: bool = True, keep: bool = False) -> str:
    line = F.concat_ws(" ", F.col("low").cast("string"), F.col("high").cast("string"))
    return write_version(df.select(line.alias("value")), path, done, keep)


def write_ids(df: DataFrame, path: str, done: bool = True, keep: bool = False) -> str:
    return write_version(df.select(F.col("id").cast("string").alias("value")), path, done, keep)


def write_checksums(df: DataFrame, path: str, done: bool = True, keep: bool = False) -> str:
    return write_version(df.select(F.concat_ws(" ", "filename", "md5").alias("value")), path, done, keep)


def block_lines(df: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """``id start``, its ``url filename`` rows and ``id end`` as one value of several lines per block.

    An id of more than ``rows`` rows gets several blocks, so that no row is as long as a hot id. Rows
    without url and filename make an empty block of their id.
    """
    line = F.concat_ws(" ", "url", "filename")
    parts = collect_parts(df.select("id", line.alias("line")), ["id"], F.col("line"), "lines", limit=rows)
    inside = F.filter("lines", lambda l: l != "")
    ends = [F.array(F.concat_ws(" ", F.col("id").cast("string"), F.lit(word))) for word in ("start", "end")]
    return parts.select(F.array_join(F.concat(ends[0], inside, ends[1]), "\n").alias("value"))


def write_blocks(df: DataFrame, path: str, done: bool = True, keep: bool = False, rows: int = BLOCK_ROWS) -> str:
    return write_version(block_lines(df, rows), path, done, keep)


def ledger_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines (value, seq) of the current version up to its end marker; none before the first version."""
    state = current(spark, path)
    return current_lines(spark, state["folders"] if state else [])


def keep_verified(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """Audit a checksum ledger against files (filename, content) and replace it by the rows that hold.

    Returns the audit (filename, md5, status), as it was; files not in the ledger play no part.
    """
    ledger = parse_checksums(ledger_lines(spark, path))
    audited = audit(ledger, files)
    done = is_done(spark, path)
    write_checksums(verified(audited), path, done)
    return audited


def remaining_ids(all_ids: DataFrame, path: str, parse: Callable[[DataFrame], DataFrame], key: str = "id") -> DataFrame:
    """Distinct ids for which the ledger has no entry; none once it is done.

    ``parse`` makes (id) rows of the ledger's lines, such as ``parse_ids`` or ``parse_block_ends``.
    """
    spark = all_ids.sparkSession
    if is_done(spark, path):
        return all_ids.select(key).limit(0)
    done = parse(ledger_lines(spark, path)).select(F.col("id").alias(key))
    return remaining(all_ids, done, key)
