"""From raw documents to packed sequences: quality, toxicity, near duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``; ``run`` writes what a stage
returns as Parquet below the shared folder and reads it again for the next one. The classifiers learn
from ``labels`` and the documents of ``sf_dir``, whatever stage comes before; their decisions are made on
``docs``, which need hold no labelled row.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labtables.llm import neardup, packing, quality, toxicity
from labtables.llm.queries import table, tokenizer


def _with_row_ids(spark: SparkSession, docs: DataFrame, row_id: str) -> DataFrame:
    """``docs`` with a number of each row in the column ``row_id``: its doc_id where that is no other row's.

    Rows without doc_id and those that share one get numbers above all doc_ids, fixed by writing them.
    """
    times = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times"))
    several = times.where("times > 1 AND doc_id IS NOT NULL").select("doc_id")
    if times.where("times > 1 OR doc_id IS NULL").isEmpty():  # no join of whole texts where every id is its row's own
        return docs.withColumn(row_id, F.col("doc_id").cast("long"))
    odd = docs.where("doc_id IS NULL").unionByName(docs.join(several, "doc_id", "left_semi").select(docs.columns))
    plain = docs.where("doc_id IS NOT NULL").join(several, "doc_id", "left_anti").select(docs.columns)
    plain = plain.withColumn(row_id, F.col("doc_id").cast("long"))
    above = docs.agg(F.coalesce(F.max("doc_id"), F.lit(0)).cast("long")).first()[0] + 1
    path = f"{_folder(spark)}/rows"
    odd.withColumn(row_id, F.monotonically_increasing_id() + F.lit(above)).write.parquet(path)
    return plain.unionByName(spark.read.parquet(path))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as good."""
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not predict as toxic."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (similarity 0.8), that with the smallest id.

    Rows that share a doc_id, and rows without one, are documents of their own here; in a group they come
    after all rows with a doc_id of their own. Texts without words are linked with nothing and stay.
    """
    row_id = max(["row", *docs.columns], key=len) + "_id"  # a name that no column has
    rows = _with_row_ids(spark, docs, row_id)
    judged = neardup.near_duplicates(rows, percent=80, id_col=row_id)
    return rows.join(judged.where("NOT kept").select(row_id), row_id, "left_anti").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    import public_tokenizers

    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", keep_quality),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack),
]

# Trained models and token ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def _folder(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="corpus-")
    return f"{base.rstrip('/')}/corpus-{uuid.uuid4().hex}"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs, folder = table(spark, sf_dir, "documents"), _folder(spark)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
