"""Line, whole-file and ledger scans. Parsers take a DataFrame and keep bad lines as rejects."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labtables.functions.strings import strip, strip_comment, tokens

SHORT_LINE = "too few tokens"
# Marks of ledgers.
DONE, START, END = "done", "start", "end"
CHUNK = 10_000


def lines(spark: SparkSession, path: str | list[str], partitions: int | None = None) -> DataFrame:
    """One row per line, column ``value``; ``partitions`` only ahead of costly Python work."""
    df = spark.read.text(path)
    return df.repartition(partitions) if partitions else df


def ordered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with ``seq`` = (file, split start, row number in the scan), which follows file order."""
    return spark.read.text(path).select(
        "value",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("seq"),
    )


def files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per small file: (file, content). Listing and reading are done by the scan."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file"), F.col("value").alias("content")
    )


def binary_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file below ``folder``: (filename, content), the name relative to the folder and the
    bytes as they are, as a checksum audit needs them."""
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/*$", 1)
    root = folder.rstrip("/").rsplit("/", 1)[-1]
    inside = F.substring_index(F.col("_metadata.file_path"), f"/{root}/", -1)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return found.select(F.coalesce(F.url_decode(inside), name).alias("filename"), "content")


def tagged_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of every file of a folder in one scan, with the file name as source tag."""
    return spark.read.text(path).select("value", F.col("_metadata.file_name").alias("source"))


def split_rejects(df: DataFrame, keep: Sequence[str], input_name: str, line: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects) of a parsed frame by its ``reason`` column."""
    good = df.where(F.col("reason").isNull()).select(*keep)
    bad = df.where(F.col("reason").isNotNull()).select(
        F.lit(input_name).alias("input"), line.alias("line"), "reason"
    )
    return good, bad


def fail_fast(df: DataFrame) -> DataFrame:
    """Stop the job at the first row that carries a reject reason."""
    text = F.concat(F.lit("rejected row: "), F.col("reason"))
    return df.withColumn("reason", F.when(F.col("reason").isNotNull(), F.raise_error(text)).cast("string"))


def parse_pairs(df: DataFrame, col: str = "value") -> DataFrame:
    """``structure id`` lines as (mid, smiles, reason)."""
    return (
        df.withColumn("tok", tokens(F.col(col)))
        .withColumns({
            "mid": F.get("tok", F.lit(1)),
            "smiles": F.get("tok", F.lit(0)),
            "reason": F.when(F.size("tok") < 2, SHORT_LINE),
        })
        .drop("tok")
    )


def parse_aliases(df: DataFrame, col: str = "value") -> DataFrame:
    """Duplicate-log lines as (mid, dupof, reason): second token alias, seventh canonical id."""
    return (
        df.withColumn("tok", tokens(F.col(col)))
        .withColumns({
            "mid": F.get("tok", F.lit(1)),
            "dupof": F.get("tok", F.lit(6)),
            "reason": F.when(F.size("tok") < 7, SHORT_LINE),
        })
        .drop("tok")
    )


def parse_dictionary(df: DataFrame, col: str = "value") -> DataFrame:
    """``pattern<TAB>name // comment`` lines as (pattern, name); other lines hold no entry."""
    parts = F.split(strip_comment(F.col(col)), "\t")
    return (
        df.withColumn("entry", parts)
        .where(F.size("entry") == 2)
        .withColumns({"pattern": F.get("entry", F.lit(0)), "name": strip(F.get("entry", F.lit(1)))})
        .drop("entry")
    )


def parse_ranges(df: DataFrame, col: str = "value") -> DataFrame:
    """``low high`` lines of a range ledger."""
    tok = tokens(F.col(col))
    return df.select(
        F.get(tok, F.lit(0)).try_cast("double").alias("low"),
        F.get(tok, F.lit(1)).try_cast("double").alias("high"),
    ).where(F.col("low").isNotNull() & F.col("high").isNotNull())


def until_done(df: DataFrame, col: str = "value") -> DataFrame:
    """Ordered lines (``seq`` of ``ordered_lines``) before the first ``done`` line of the whole ledger.

    The files of a ledger follow each other by name; the marker may stand in any of them.
    """
    stop = df.where(strip(F.col(col)) == DONE).agg(F.min("seq").alias("stop"))
    # one row with the first marker, or null
    kept = df.join(F.broadcast(stop), F.lit(True), "left")
    return kept.where(F.col("stop").isNull() | (F.col("seq") < F.col("stop"))).drop("stop")


def current_lines(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Lines (value, seq) of the folders of a ledger, in their order, up to the end marker.

    A marker counts in the last folder only: rows added later open a finished ledger again.
    """
    if not folders:
        return spark.createDataFrame([], "value string, seq struct<folder int, file string, start long, row long>")
    parts = []
    for number, folder in enumerate(folders):
        found = ordered_lines(spark, folder)
        found = until_done(found) if number == len(folders) - 1 else found.where(strip(F.col("value")) != DONE)
        seq = F.struct(F.lit(number).alias("folder"), "seq.file", "seq.start", "seq.row")
        parts.append(found.select("value", seq.alias("seq")))
    return reduce(DataFrame.unionAll, parts)


def parse_ids(df: DataFrame, col: str = "value") -> DataFrame:
    """Distinct ids of an id ledger; with a column ``seq`` only those before the end marker."""
    if "seq" in df.columns:
        df = until_done(df, col)
    return df.select(strip(F.col(col)).alias("id")).where(~F.col("id").isin("", DONE)).distinct()


def parse_block_ends(df: DataFrame, col: str = "value") -> DataFrame:
    """Ids whose block is closed by an ``<id> end`` line; a block only begun does not count."""
    tok = tokens(F.col(col))
    closed = (F.size(tok) == 2) & (F.get(tok, F.lit(1)) == END)
    return df.where(closed).select(F.get(tok, F.lit(0)).alias("id")).distinct()


def in_closed_blocks(df: DataFrame, col: str = "value", chunk: int = CHUNK) -> DataFrame:
    """Ordered lines inside blocks that were begun and ended, with the ``id`` of their block.

    A line counts if the last mark before it is ``<id> start`` and the next one ``<id> end`` of the same
    id, both in its file; blocks still open, or cut off by another start, are left out. Files are worked
    through in chunks of so many lines: a chunk knows its marks, and a window over the few chunks
    of a file gives the marks before and after each.
    """
    tok = tokens(F.col(col))
    is_mark = (F.size("tok") == 2) & F.get("tok", F.lit(1)).isin(START, END)
    mark = F.when(is_mark, F.struct("seq", F.get("tok", F.lit(0)).alias("id"), F.get("tok", F.lit(1)).alias("kind")))
    of = [c for c in ("folder", "file", "start") if c in df.schema["seq"].dataType.names]
    file = F.struct(*[F.col("seq")[c].alias(c) for c in of if c != "start"])
    place = F.struct(F.col("seq.start").alias("start"), F.floor(F.col("seq.row") / F.lit(chunk)).alias("number"))
    lines = df.withColumn("tok", tok).withColumns({"mark": mark, "of_file": file, "chunk": place})
    # aggregates of structs that begin with ``seq``: the first and last mark of a chunk
    chunks = lines.groupBy("of_file", "chunk").agg(F.min("mark").alias("first"), F.max("mark").alias("last"))
    # the next mark is the last one in descending order: frames that only grow are worked through once
    both = {"before": F.col("chunk").asc(), "after": F.col("chunk").desc()}
    near = {"before": "last", "after": "first"}
    chunks = chunks.select("of_file", "chunk", *[
        F.last(near[name], ignorenulls=True).over(
            Window.partitionBy("of_file").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)).alias(name)
        for name, order in both.items()
    ])
    here = Window.partitionBy("of_file", "chunk")

    def nearest(order: Column) -> Column:
        return F.last("mark", ignorenulls=True).over(here.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))

    joined = lines.join(chunks, ["of_file", "chunk"]).withColumns({
        "opened": F.coalesce(nearest(F.col("seq").asc()), "before"),
        "closed": F.coalesce(nearest(F.col("seq").desc()), "after"),
    })
    whole = (F.col("opened.kind") == START) & (F.col("closed.kind") == END) & (F.col("opened.id") == F.col("closed.id"))
    return joined.where(whole & F.col("mark").isNull()).select(*df.columns, F.col("opened.id").alias("id"))


def parse_manifest(df: DataFrame, col: str = "value") -> DataFrame:
    """``url filename`` rows between the block markers, other columns kept; lines of blocks that are still
    open count too, ``in_closed_blocks`` leaves them out."""
    return (
        df.withColumn("tok", tokens(F.col(col)))
        .where((F.size("tok") == 2) & ~F.get("tok", F.lit(1)).isin(START, END))
        .withColumns({"url": F.get("tok", F.lit(0)), "filename": F.get("tok", F.lit(1))})
        .drop("tok")
    )


def parse_checksums(df: DataFrame, col: str = "value") -> DataFrame:
    """``filename md5`` rows of a checksum ledger."""
    tok = tokens(F.col(col))
    return df.where(F.size(tok) == 2).select(
        F.get(tok, F.lit(0)).alias("filename"), F.get(tok, F.lit(1)).alias("md5")
    )


def parse_keyed_text(df: DataFrame, col: str = "value") -> DataFrame:
    """``key base64`` lines as (key, encoded)."""
    tok = tokens(F.col(col))
    return df.where(F.size(tok) >= 2).select(
        F.get(tok, F.lit(0)).alias("key"), F.get(tok, F.lit(1)).alias("encoded")
    )
