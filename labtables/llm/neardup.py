"""Near-duplicate documents by circulant MinHash, banding and exact verification (operator 2).

Two permutations of the 64-bit numbers serve all coordinates: ``mix64`` scatters the shingles, and an
affine one, shifted circularly by k places, orders them for coordinate k. A shift of an affine
permutation adds a constant, so the smallest value under shift k is the first scattered value at or
after a point of the ring: one sort of a document's values gives its whole signature. The shifts are
pseudo-random: with evenly spread ones a single wide gap of the ring could be met by every band.

Small sets are found exactly instead, as few shingles leave a wide spread of what the bands see: sets of
similarity t share a shingle among the first n - ceil(t * n) + 1 of each, in any order that all sets have
in common. Frequent shingles come last in that order, the others by their hash.

Copies with equal shingle sets are one class. Classes that agree in a key meet in a bucket, whose pairs
are confirmed on full sets in groups of bounded size; what leaves a group are the links that span its
linked classes. Pairs that are known to be in one component by then are not compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labtables.llm.common import checkpoint, components, grow, mix64, worker_cache

WORDS = 5
BANDS = 40
ROWS_PER_BAND = 6
EXACT = 200  # pairs whose smaller set has so many shingles at most are found by prefixes
SAMPLE_DOCS = 20_000
FREQUENT = 20_000
BLOCK = 256
LEADERS = 8
WORD_CACHE = 500_000
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so that multiples of it spread evenly over the ring
_FOLD = np.uint64(0xD6E8FEB86659FD93)


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words: A-Z in lower case, cut at ASCII white space."""
    cache = worker_cache("word_hashes")
    words = text.encode().lower().split()
    out = [*map(cache.get, words)]
    if None in out:
        for i, got in enumerate(out):
            if got is None:
                out[i] = grow(cache, words[i], hashlib.blake2b(words[i], digest_size=8).digest(), WORD_CACHE)
    return np.frombuffer(b"".join(out), "<u8")


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` words; of the whole text if it has fewer."""
    hashes = word_hashes(text)
    if not len(hashes):
        return hashes
    n = max(1, len(hashes) - words + 1)
    out = np.full(n, np.uint64(min(len(hashes), words)))
    for i in range(min(words, len(hashes))):
        out = (out ^ hashes[i:i + n]) * _FOLD
        out ^= out >> np.uint64(29)
    return np.unique(mix64(out))


def signature(shingles: np.ndarray, size: int | np.ndarray) -> np.ndarray:
    """Coordinates 0 to ``size`` - 1, or those of an array of numbers: coordinate k is the shingle that is
    first in the order shifted k times.

    With pi(x) = x / step modulo 2**64, the shifted order is pi(x) + k, or x + k * step up to the factor.
    This file sorts by x + k * step itself, so the first shingle is the successor of ``-k * step`` on the
    ring. Shingles are scattered by ``mix64`` before, which is the other permutation.
    """
    points = np.uint64(0) - (np.arange(size, dtype=np.uint64) if isinstance(size, int) else size) * _STEP
    at = np.searchsorted(shingles, points)
    return shingles[np.where(at == len(shingles), 0, at)]


def band_keys(coordinates: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key for each band, made of its number and its coordinates."""
    rows = coordinates.reshape(bands, -1)
    keys = np.arange(1, bands + 1, dtype=np.uint64) * _STEP
    for i in range(rows.shape[1]):
        keys = mix64((keys ^ rows[:, i]) * _FOLD)
    return keys


def prefix_keys(shingles: np.ndarray, percent: int, listed: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """One key for each shingle of a set's prefix.

    ``listed`` are the frequent shingles, sorted, and ``ranks`` their places from 1 in the common order, in
    which all other shingles come before them. Any list gives the same links.
    """
    n = len(shingles)
    at = np.minimum(np.searchsorted(listed, shingles), max(len(listed) - 1, 0))
    place = np.where(listed[at] == shingles, ranks[at], 0) if len(listed) else np.zeros(n, np.int64)
    first = np.lexsort((shingles, place))[:n - -(-percent * n // 100) + 1]
    return mix64(shingles[first] * _FOLD)


def frequent_shingles(df: DataFrame, id_col: str, text_col: str, words: int, most: int) -> np.ndarray:
    """Shingles of a bounded sample of the sets of up to ``most``, those in three or more, rarest first."""
    step = max(1, -(-df.count() // SAMPLE_DOCS))
    key = F.col(id_col).cast("long")
    texts = df.select(key.alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.where(F.pmod(F.xxhash64("id"), F.lit(step)) == 0)
    seen = shingle_sets(texts, words).where(F.col("n") <= most).select(F.explode("shingles").alias("s"))
    seen = seen.groupBy("s").agg(F.count(F.lit(1)).alias("m")).where("m > 2").orderBy(F.desc("m"), "s").limit(FREQUENT)
    return np.array([r["s"] for r in seen.collect()][::-1], np.int64).view(np.uint64)


def sketches(df: DataFrame, id_col: str, text_col: str, percent: int, words: int = WORDS, bands: int = BANDS,
             rows: int = ROWS_PER_BAND, exact: int = EXACT) -> DataFrame:
    """(id, n_shingles, hi, lo, keys): set size, 128-bit digest of the set and keys of each row.

    Sets of more than ``exact`` shingles have band keys; those that can be linked with a set of up to
    ``exact`` have prefix keys. The digest and the keys are null where there is no word.
    """
    most = 100 * exact // percent
    frequent = frequent_shingles(df, id_col, text_col, words, most)
    by_value = frequent.argsort()
    listed, ranks = frequent[by_value], by_value + 1
    shifts = mix64(np.arange(1, bands * rows + 1, dtype=np.uint64) * _STEP)
    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, hi, lo, keys = [], [], [], []
            for text in batch.column(1):
                shingles = shingle_set(text.as_py() or "", words)
                sizes.append(len(shingles))
                if not len(shingles):
                    hi.append(None), lo.append(None), keys.append(None)
                    continue
                digest = np.frombuffer(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), "<i8")
                hi.append(int(digest[0])), lo.append(int(digest[1]))
                made = [band_keys(signature(shingles, shifts), bands)] if len(shingles) > exact else []
                made += [prefix_keys(shingles, percent, listed, ranks)] if len(shingles) <= most else []
                keys.append(np.concatenate(made).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["id", "n_shingles", "hi", "lo", "keys"],
            )

    return source.mapInArrow(run, "id long, n_shingles long, hi long, lo long, keys array<long>")


def shingle_sets(df: DataFrame, words: int = WORDS) -> DataFrame:
    """(id, n, shingles) of rows (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingle_set(t.as_py() or "", words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, made), pa.int64()),
                 pa.array([m.view(np.int64) for m in made], pa.list_(pa.int64()))], names=["id", "n", "shingles"],
            )

    return df.select("id", "text").mapInArrow(run, "id long, n long, shingles array<long>")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows (key, i, j, ...) that follow each other with equal key, i and j, as lists."""
    group, held = None, []
    for batch in batches:
        names = batch.schema.names
        columns = [c.to_pylist() if n != "shingles" else [np.asarray(v.values) for v in c]
                   for n, c in zip(names, batch.columns)]
        for row in zip(*columns):
            if row[:3] != group:
                if held:
                    yield held
                group, held = row[:3], []
            held.append(row[3:])
    if held:
        yield held


def _span(rows: list[tuple], percent: int) -> Iterator[tuple[int, int]]:
    """Confirmed links (a, b) that span the linked rows of one group.

    Rows are (cid, n, part, left, right, shingles). Rows of ``left`` are compared with rows of ``right``
    unless their parts are one by then; every such pair is counted on the full sets.
    """
    parts: dict[int, int] = {}

    def root(part: int) -> int:
        while parts.setdefault(part, part) != part:
            part = parts[part]
        return part

    sizes = np.array([r[1] for r in rows])
    ends = np.cumsum([len(r[5]) for r in rows])
    values, columns = np.unique(np.concatenate([r[5] for r in rows]), return_inverse=True)
    mark = np.zeros(len(values), np.int64)
    for i, (cid, n, part, left, _, shingles) in enumerate(rows):
        if not left:
            continue
        mine = root(part)
        others = [j for j, r in enumerate(rows) if r[4] and (j > i or not r[3]) and root(r[2]) != mine
                  and 100 * min(n, r[1]) >= percent * max(n, r[1])]
        if not others:
            continue
        own = columns[ends[i] - len(shingles):ends[i]]
        mark[own] = 1
        if 4 * len(others) >= len(rows):
            common = np.add.reduceat(mark[columns], np.r_[0, ends[:-1]])[others]
        else:
            common = np.array([mark[columns[ends[j] - len(rows[j][5]):ends[j]]].sum() for j in others])
        mark[own] = 0
        for j in np.array(others)[100 * common >= percent * (n + sizes[others] - common)]:
            if root(rows[j][2]) != mine:
                yield cid, rows[j][0]
                parts[root(rows[j][2])] = mine


def confirm(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among rows (key, i, j, cid, n, part, left, right), group by group of (key, i, j).

    Groups are bounded by the caller. They are dealt out by a hash, follow each other in a task and go
    through Arrow in batches, so that very many small groups cost no call each.
    """
    full = rows.join(sets, "cid").select("key", "i", "j", "cid", "n", "part", "left", "right", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            links = list(_span(group, percent))
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    dealt = full.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "cid")
    return dealt.mapInArrow(run, "a long, b long")


def _block(count: Column, size: int) -> Column:
    return F.greatest(F.ceil(count / F.lit(size)), F.lit(1)).cast("int")


def _steps(count: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), count - F.lit(1)))


def link_classes(classes: DataFrame, texts: DataFrame, percent: int, words: int = WORDS,
                 block: int = BLOCK) -> DataFrame:
    """(node, component) of classes (cid, n, keys) that have a confirmed link; ``texts`` is (id, text).

    A bucket of up to ``block`` classes is one group, all of whose pairs are settled. A larger one is
    split into blocks, each with the same few leaders of the bucket, which tie the blocks of one group of
    copies together. If such a bucket is not one component then, its classes outside the largest part are
    compared with those of all blocks, so that no link is lost.
    """
    rows = classes.select(F.explode("keys").alias("key"), "cid", "n")
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    found = checkpoint(rows.join(shared, "key"))
    leaders = F.array_distinct(F.array(*[F.min_by("cid", F.xxhash64("cid", F.lit(i))) for i in range(LEADERS)]))
    buckets = (
        found.groupBy("key", "m").agg(F.bit_xor(F.xxhash64("cid")).alias("who"), leaders.alias("leaders"))
        # keys with the very same members are one bucket
        .groupBy("m", "who").agg(F.min_by(F.struct("key", "leaders"), "key").alias("b"))
        .select("b.key", "b.leaders", _block(F.col("m"), block).alias("blocks"))
    )
    buckets = checkpoint(buckets)
    inside = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    members = found.join(buckets.select("key", "blocks"), "key").select("key", "cid", "n", "blocks", inside.alias("j"))
    # in a bucket of one block, a set with none of like size beside it has no link there
    by_size = Window.partitionBy("key", "j").orderBy("n", "cid")
    like = lambda m: F.coalesce(F.lit(100) * F.least("n", m) >= F.lit(percent) * F.greatest("n", m), F.lit(False))
    near = (F.col("blocks") > 1) | like(F.lag("n").over(by_size)) | like(F.lead("n").over(by_size))
    members = checkpoint(members.withColumn("near", near).where("near").drop("near"))
    needed = members.select(F.col("cid").alias("id")).distinct()
    sets = checkpoint(
        shingle_sets(texts.join(needed, "id", "left_semi"), words).select(F.col("id").alias("cid"), "shingles")
    )
    sizes = classes.select("cid", "n")
    large = buckets.where("blocks > 1").select("key", "blocks", F.explode("leaders").alias("cid")).join(sizes, "cid")
    first = members.select("key", "j", "cid", "n").unionByName(
        large.select("key", _steps(F.col("blocks")).alias("j"), "cid", "n")
    )
    both = [F.lit(True).alias("left"), F.lit(True).alias("right")]
    first = first.select("key", F.lit(0).alias("i"), "j", "cid", "n", F.col("cid").alias("part"), *both)
    links = checkpoint(confirm(first, sets, percent))
    wide = members.where("blocks > 1")
    if wide.isEmpty():
        return components(links)
    known = components(links).withColumnRenamed("node", "cid")
    placed = checkpoint(wide.join(known, "cid", "left").withColumn("part", F.coalesce("component", "cid")).drop("component"))
    counts = placed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("m"))
    apart = (
        counts.groupBy("key").agg(F.max_by("part", F.struct("m", "part")).alias("most"),
                                  (F.sum("m") - F.max("m")).alias("outside"))
        .where("outside > 0").select("key", "most", _block(F.col("outside"), block).alias("outer"))
    )
    placed = checkpoint(placed.join(apart, "key"))
    right = placed.select("key", _steps(F.col("outer")).alias("i"), "j", "cid", "n", "part", F.lit(False).alias("left"),
                          F.lit(True).alias("right"))
    left = placed.where("part <> most").select(
        "key", F.pmod(F.xxhash64("cid", F.lit(7)), F.col("outer")).cast("int").alias("i"),
        _steps(F.col("blocks")).alias("j"), "cid", "n", "part", F.lit(True).alias("left"), F.lit(False).alias("right"),
    )
    return components(links.unionByName(confirm(right.unionByName(left), sets, percent)))


def near_duplicates(df: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                    words: int = WORDS, bands: int = BANDS, rows: int = ROWS_PER_BAND,
                    block: int = BLOCK) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row, ``id`` being a number.

    ``component_id`` is the smallest id that a row reaches over links; ``kept`` is true for the row that
    bears it. Rows without words are linked with nothing. Rows with one id count as one document. A row
    without id is judged by its text: its component is that of the rows with the same shingle set, or null
    if there are none, and it is kept only then. Columns besides the two named are not read. Links are
    found exactly where the smaller set has up to ``EXACT`` shingles, by bands where both have more.
    """
    sketch = checkpoint(sketches(df, id_col, text_col, percent, words, bands, rows))
    classes = checkpoint(
        sketch.where("hi IS NOT NULL AND id IS NOT NULL").groupBy("hi", "lo")
        .agg(F.min("id").alias("cid"), F.min("n_shingles").alias("n"), F.first("keys").alias("keys"))
    )
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    linked = link_classes(classes, texts, percent, words, block)
    # documents whose id is that of another class belong to it as well
    same_id = sketch.where("id IS NOT NULL AND hi IS NOT NULL").select("id", "hi", "lo").distinct()
    several = same_id.groupBy("id").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1").select("id")
    joined = several.join(same_id, "id").join(classes.select("hi", "lo", "cid"), ["hi", "lo"]).where("id <> cid")
    by_id = joined.select(F.col("id").alias("a"), F.col("cid").alias("b"))
    linked = components(
        linked.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(by_id)
    ) if not by_id.isEmpty() else linked
    labels = classes.join(linked.withColumnRenamed("node", "cid"), "cid", "left").select(
        "hi", "lo", F.coalesce("component", "cid").alias("component_id")
    )
    out = sketch.select("id", "n_shingles", "hi", "lo").join(labels, ["hi", "lo"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
        F.when(F.col("id").isNull(), component.isNull()).otherwise(F.col("id") == component).alias("kept"),
    )
