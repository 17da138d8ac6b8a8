"""Importance resampling towards a target distribution of hashed n-grams (operator 13).

Every feature's CRC-32 is taken in matrices: distinct features of one length form the rows of a byte matrix
and all their checksums advance together, a column at a time; the buckets are scattered back to the
features. The gain of a bucket compares its share of the target's features with its share of the corpus;
a document's weight is the sum of gains, and noise from a hash of its id turns the highest scores into
a sample without replacement.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain, islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtables.llm.common import worker_cache, written

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
LONG = 256
CACHE = 400_000

_LOWER = bytes(
    b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = _crc_table()


def words_of(text: str) -> list[bytes]:
    """Words of a whole text: runs of 0-9, letters and non-ASCII characters, A-Z in lower case."""
    return text.encode().translate(_LOWER).split()


def crcs(features: Sequence[bytes], long: int = LONG) -> np.ndarray:
    """CRC-32 of each feature: one matrix for each length, all rows of it updated column by column.

    Features of over ``long`` bytes, of which a matrix would have more columns than rows, take the same
    function from the library.
    """
    out = np.empty(len(features), np.uint32)
    sizes = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(sizes, kind="stable")
    lengths, starts = np.unique(sizes[order], return_index=True)
    for length, rows in zip(lengths, np.split(order, starts[1:])):
        if length > long:
            out[rows] = [crc32(features[i]) for i in rows]
            continue
        matrix = np.frombuffer(b"".join([features[i] for i in rows]), np.uint8).reshape(len(rows), length)
        state = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        for column in matrix.T:
            state = CRC[(state ^ column) & 0xFF] ^ state >> 8
        out[rows] = ~state
    return out


def features_of(words: list[bytes], shortest: int, longest: int) -> list[bytes]:
    """All runs of ``shortest`` to ``longest`` words, joined by one space, with repeats."""
    if longest == 1:
        return words
    runs = (zip(*[islice(words, j, None) for j in range(n)]) for n in range(shortest, longest + 1))
    return [b" ".join(run) for run in chain.from_iterable(runs)]


def buckets_of(block: Sequence[list[bytes]], buckets: int) -> list[np.ndarray]:
    """Bucket of each feature of each document; features new to the worker are hashed together."""
    known = worker_cache(f"buckets {buckets}")
    fresh = list(set(chain.from_iterable(block)).difference(known))
    if len(known) + len(fresh) > CACHE:
        known.clear()
        fresh = list(set(chain.from_iterable(block)))
    known.update(zip(fresh, (crcs(fresh) % np.uint32(buckets)).tolist()))
    return [np.fromiter(map(known.__getitem__, features), np.int64, len(features)) for features in block]


def _documents(batch: pa.RecordBatch, column: int, shortest: int, longest: int) -> Iterator[tuple[int, int, list, list[int]]]:
    """(first row, end, features, number of words) of parts of a batch with a bounded number of bytes."""
    block, words, held, first = [], [], 0, 0
    for row, text in enumerate(batch.column(column)):
        found = words_of(text.as_py() or "")
        block.append(features_of(found, shortest, longest))
        words.append(len(found))
        held += len(found)
        if held >= 200_000:
            yield first, row + 1, block, words
            block, words, held, first = [], [], 0, row + 1
    if block:
        yield first, batch.num_rows, block, words


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, shortest: int = 1, longest: int = 1) -> np.ndarray:
    """Features in each bucket over all texts of the first column; at most one row a bucket reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, block, _ in _documents(batch, 0, shortest, longest):
                for found in buckets_of(block, buckets):
                    np.add.at(counts, found, 1)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])

    counts = np.zeros(buckets, np.int64)
    for row in texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) for each bucket."""
    s, t = corpus.astype(float), target.astype(float)
    ratio = (t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(rows: DataFrame, gain: np.ndarray, shortest: int = 1, longest: int = 1) -> DataFrame:
    """Rows of (id, text) as (id, n_words, n_features, weight), one for one."""
    sent = rows.sparkSession.sparkContext.broadcast(gain)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for batch in batches:
            for low, high, block, words in _documents(batch, 1, shortest, longest):
                sums = [int(gain[found].sum()) for found in buckets_of(block, len(gain))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(words, pa.int64()),
                     pa.array([len(f) for f in block], pa.int64()), pa.array(sums, pa.int64())],
                    names=["id", "n_words", "n_features", "weight"],
                )

    return rows.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of sha256("<seed>:<key>"); a null key is empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def ranked(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` with ``rank`` from 1 in a total order, without a single task for all rows.

    Rows are dealt to ranges of the order and written sorted; what comes to the driver is one count a
    range. The place in a file is the place in its range.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # the id of a row is its partition's number and its place there, fixed once it is written
    placed = written(dealt.withColumn("at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("at", 33)
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, run = [], 0
    for number in sorted(sizes):
        starts.append((number, run))
        run += sizes[number]
    before = df.sparkSession.createDataFrame(starts, "part long, before long")
    # one row for each partition of the shuffle
    joined = placed.withColumn("part", part).join(F.broadcast(before), "part")
    place = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return joined.select(*df.columns, (F.col("before") + place + 1).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
             buckets: int = BUCKETS, shortest: int = 1, longest: int = 1, seed: int = SEED, id_col: str = "doc_id",
             text_col: str = "text", target_col: str = "text") -> DataFrame:
    """(id, n_features, weight, score, rank): rank 1, 2, 3, ... for the drawn documents, null for the others.

    Of the N documents with at least ``min_words`` words the floor(percent * N / 100) highest scores are
    drawn, ties by smaller id, then fewer features, then smaller weight; null ids last. One row out for each
    row in; repeated ids are rows of their own with the same noise. Null and empty texts have no
    features and weight 0, and are never drawn while ``min_words`` is above 0. An empty target gives gains
    against the even distribution. Other columns are not read.
    """
    if not 1 <= shortest <= longest:
        raise ValueError("features have 1 word or more, the longest not fewer than the shortest")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    aims = target.select(F.col(target_col).cast("string").alias("text"))
    gain = gains(bucket_counts(rows.select("text"), buckets, shortest, longest),
                 bucket_counts(aims, buckets, shortest, longest))
    scored = weights(rows, gain, shortest, longest).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    scored = written(scored, "resampling")
    able = scored.where(F.col("n_words") >= min_words)
    drawn = able.count() * percent // 100
    order = [F.desc("score"), F.col("id").asc_nulls_last(), F.asc("n_features"), F.asc("weight")]
    rank = F.col("rank").cast("long")
    chosen = ranked(able, order).withColumn("rank", F.when(rank <= drawn, rank))
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return chosen.unionByName(rest).select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")


def oracle(percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> str:
    """DuckDB SQL for ``documents`` against ``benchmark`` with single words as features."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = rf"regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    bit = "(CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    return f"""
    WITH RECURSIVE steps(b, c, i) AS (
        SELECT b::BIGINT, b::BIGINT, 0 FROM range(256) AS t(b)
        UNION ALL SELECT b, {bit}, i + 1 FROM steps WHERE i < 8),
    crc AS (SELECT list(c ORDER BY b) AS of FROM steps WHERE i = 8),
    docs AS (SELECT row_number() OVER () AS row, doc_id, {words} AS words FROM documents),
    aims AS (SELECT {words} AS words FROM benchmark),
    held AS (SELECT row, unnest(words) AS word FROM docs),
    aimed AS (SELECT unnest(words) AS word FROM aims),
    spelt AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM held UNION SELECT word FROM aimed)),
    bytes AS (SELECT word, list_transform(range(1, len(h), 2), lambda i: ('0x' || h[i:i + 1])::BIGINT) AS data FROM spelt),
    hashed AS (SELECT word, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], data),
                      lambda s, x: xor(of[(xor(s, x) & 255) + 1], s >> 8))) % {buckets} AS bucket FROM bytes, crc),
    s AS (SELECT bucket, count(*) AS n FROM held JOIN hashed USING (word) GROUP BY 1),
    t AS (SELECT bucket, count(*) AS n FROM aimed JOIN hashed USING (word) GROUP BY 1),
    sums AS (SELECT (SELECT coalesce(sum(n), 0)::BIGINT FROM s) AS s_all, (SELECT coalesce(sum(n), 0)::BIGINT FROM t) AS t_all),
    gain AS (SELECT bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1) * (s_all + {buckets}))::DOUBLE
                                            / ((s.n + 1) * (t_all + {buckets}))))::BIGINT AS g
             FROM s LEFT JOIN t USING (bucket), sums),
    weighed AS (SELECT row, sum(g)::BIGINT AS weight FROM held JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY 1),
    scored AS (SELECT row, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                      ('0x' || sha256('{seed}:' || doc_id)[1:8])::BIGINT AS h
               FROM docs LEFT JOIN weighed USING (row)),
    noisy AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scored),
    able AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
             FROM noisy WHERE n_features >= {min_words})
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * {percent} // 100 THEN place END::BIGINT AS rank
    FROM noisy LEFT JOIN able USING (row)
    """
