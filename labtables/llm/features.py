"""Hashed word features of whole texts, for the classifiers.

A word is what stands between ASCII white space. Its parts (runs of letters and digits in lower case,
runs of other characters, a mark for capitals) are hashed to 32 bits; the hashes of words are kept in a
bounded cache of the worker.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labtables.llm.common import grow, worker_cache

WORD_CACHE = 500_000
TRAIN_FEATURES = 12_000_000
COLLECT_PARTS = 32
_PARTS = re.compile(r"[^\W_]+|[\W_]+")
_CAPITALS = crc32(b"\x00capitals")
_AGAIN = crc32(b"\x00again")


def _hashes(word: bytes) -> bytes:
    out = []
    for part in _PARTS.findall(word.decode(errors="replace")):
        out.append(crc32(part.lower().encode()))
        if len(part) > 1 and part.isupper():
            out.append(_CAPITALS)
    return np.array(out, np.uint32).tobytes()


def _start_hashes(word: bytes) -> bytes:
    out = []
    for part in _PARTS.findall(word.decode(errors="replace").lower()):
        out.append(crc32(part.encode()))
        out += [crc32(f"{part[:n]}\x00start".encode()) for n in (4, 5) if len(part) > n]
    return np.array(out, np.uint32).tobytes()


def part_hashes(text: str, make: Callable[[bytes], bytes] = _hashes, kind: str = "word_parts") -> np.ndarray:
    """Hashes that ``make`` gives for the words of a text, in order; ``kind`` names its cache."""
    cache = worker_cache(kind)
    words = text.encode().split()
    out = [*map(cache.get, words)]
    if None in out:
        for i, got in enumerate(out):
            if got is None:
                out[i] = grow(cache, words[i], make(words[i]), WORD_CACHE)
    return np.frombuffer(b"".join(out), np.uint32)


def ngrams(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values): shares of single parts and of pairs among the parts of a text.

    A part that stands also one or two places before counts as a repeat, a feature of its own.
    """
    one = part_hashes(text)
    if not len(one):
        return np.zeros(0, np.int64), np.zeros(0)
    pairs = one[:-1] * np.uint32(0x9E3779B1) ^ (one[1:] + np.uint32(0x7F4A7C15))
    again = np.zeros(len(one), bool)
    again[1:] |= one[1:] == one[:-1]
    again[2:] |= one[2:] == one[:-2]
    marks = np.full(int(again.sum()), _AGAIN, np.uint32)
    buckets, counts = np.unique(_buckets(np.concatenate([one, pairs, marks]), bits), return_counts=True)
    return buckets, counts * (10.0 / len(one))


def presence(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, ones): the parts that occur in a text, and the first four and five characters of them."""
    buckets = np.unique(_buckets(part_hashes(text, _start_hashes, "word_starts"), bits))
    return buckets, np.ones(len(buckets))


def _buckets(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes * np.uint32(0x85EBCA6B) >> np.uint32(32 - bits)).astype(np.int64)


Featurise = Callable[[str, int], tuple[np.ndarray, np.ndarray]]


def collect(df: DataFrame, featurise: Featurise, bits: int, label: str, most: int = TRAIN_FEATURES,
            shares: bool = True) -> list[tuple]:
    """[(buckets, values, label)] of a bounded sample, made in tasks and ordered by hash of the id.

    ``df`` has ``id``, ``text`` and the label column; callers bound the number of different ids. Of the rows
    of an id with one label a single one counts, that with the smallest features: each task sends one,
    and these are folded before they are collected. Rows of a label are taken in order of the hash until
    they hold ``most`` features, 8 bytes each, so what reaches the driver is bounded in rows and bytes.
    Without ``shares`` the values are None and a feature is 4 bytes; for features whose values are all one.
    The rows are dealt out once more before they are sent, so that no single task sends all of a label.
    """
    rows = df.select("id", F.col("text").cast("string"), F.col(label).cast("int").alias("y"), F.xxhash64("id").alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[tuple, tuple] = {}
        held = 0
        for batch in batches:
            for row, text, y, h in zip(*batch.columns):
                buckets, values = featurise(text.as_py() or "", bits)
                made = (len(buckets), buckets.astype(np.int32).tobytes(), values.astype(np.float32).tobytes() if shares else b"")
                key = y.as_py(), h.as_py(), row.as_py()
                before = least.get(key)
                least[key] = made if before is None else min(made, before)
                held += least[key][0] - (before[0] if before else 0)
                if held > 4 * most:
                    held = _cut(least, most)
        _cut(least, most)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[2] for k in least], pa.int64()), pa.array([k[0] for k in least], pa.int32()),
             pa.array([m[0] for m in least.values()], pa.int32()), pa.array([m[1] for m in least.values()], pa.binary()),
             pa.array([m[2] for m in least.values()], pa.binary())], names=["id", "y", "size", "buckets", "shares"],
        )

    made = rows.mapInArrow(run, "id long, y int, size int, buckets binary, shares binary")
    one = made.groupBy("id", "y").agg(F.min(F.struct("size", "buckets", "shares")).alias("f"))
    # a window over the rows of a sample, whose number is bounded
    before = Window.partitionBy("y").orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, 0)
    some = one.withColumn("held", F.sum("f.size").over(before)).where(F.col("held") <= most)
    found = some.select("id", "y", "f.buckets", *["f.shares"] * shares).repartition(COLLECT_PARTS, "id").toArrow()
    ids, labels = found["id"].to_pylist(), found["y"].to_pylist()
    # views of the collected bytes, of which there is no second copy
    buckets = [np.frombuffer(b.as_buffer(), np.int32) for b in found["buckets"]]
    values = [np.frombuffer(s.as_buffer(), np.float32) for s in found["shares"]] if shares else [None] * len(ids)
    order = sorted(range(len(ids)), key=lambda i: (crc32(str(ids[i]).encode()), ids[i], labels[i]))
    return [(buckets[i], values[i], labels[i]) for i in order]


def _cut(least: dict[tuple, tuple], most: int) -> int:
    """Drop what lies beyond ``most`` features of a label in the order of the hash; the number that is left.

    A row beyond that in one task is beyond it in all.
    """
    label, run, left = None, 0, 0
    for key in sorted(least):
        run = least[key][0] + (run if key[0] == label else 0)
        label = key[0]
        if run > most:
            del least[key]
        else:
            left += least[key][0]
    return left


def _scores(texts: pa.Array, weights: np.ndarray, bias: float, featurise: Featurise, bits: int) -> np.ndarray:
    scores = np.empty(len(texts))
    for i, text in enumerate(texts):
        buckets, values = featurise(text.as_py() or "", bits)
        scores[i] = bias + weights[buckets] @ values
    return 1 / (1 + np.exp(-np.clip(scores, -30, 30)))


def score_rows(df: DataFrame, weights: np.ndarray, bias: float, featurise: Featurise, bits: int, threshold: float,
               id_col: str, text_col: str) -> DataFrame:
    """(id, score, predicted): logistic score of each whole text, one row out for each row in."""
    rows = df.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _scores(batch.column(1), weights, bias, featurise, bits)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=[id_col, "score", "predicted"],
            )

    return rows.mapInArrow(run, f"`{id_col}` {id_type}, score double, predicted int")


def filter_rows(df: DataFrame, weights: np.ndarray, bias: float, featurise: Featurise, bits: int, threshold: float,
                text_col: str, above: bool) -> DataFrame:
    """Rows of ``df``, all columns, whose score is at least the threshold, or below it."""
    rows = df.select(F.col(text_col).cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _scores(batch.column(0), weights, bias, featurise, bits)
            whole = pa.RecordBatch.from_arrays(batch.column(1).flatten(), names=names)
            yield whole.filter(pa.array((scores >= threshold) == above))

    return rows.mapInArrow(run, df.schema)
