"""Near-duplicate vectors: all pairs above a cosine by dual traversal of cover trees (operator 6)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtables.llm.common import checkpoint, components, mix64
from labtables.llm.covertree import (
    BLOCK_ROWS, PLACED, Tree, homes, make_cells, over_blocks, place, placed_batch, threshold_pairs, vectors,
)


def unit_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, hi, lo, v): unit vectors in double precision with a digest; null where a vector cannot be compared."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hi, lo, out = [], [], []
            for x in batch.column(1):
                x = None if x.as_py() is None or None in x.as_py() else np.array(x.as_py(), float)
                top = 0.0 if x is None or not len(x) else np.abs(x).max()
                if top == 0 or not np.isfinite(top):
                    hi.append(None), lo.append(None), out.append(None)
                    continue
                x = x / top  # no overflow in the squares
                x = x / np.sqrt(x @ x)
                digest = np.frombuffer(hashlib.blake2b(x.tobytes(), digest_size=16).digest(), "<i8")
                hi.append(int(digest[0])), lo.append(int(digest[1])), out.append(x.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(out, pa.binary())],
                names=["id", "hi", "lo", "v"],
            )

    return rows.mapInArrow(run, "id long, hi long, lo long, v binary")


def links(classes: DataFrame, cosine: float, block: int = BLOCK_ROWS) -> DataFrame:
    """(id, links, other) of classes (id, weight, v): linked weights, and an id in the same component.

    A row is at home in the cell of its nearest centre and visits a later cell, or a later block of its
    own, if the covering radius and the plane between both centres leave room for a link.
    """
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    cells = make_cells(classes, block)
    centres, spread = cells.centres, np.arange(len(cells.centres))
    apart = cells.distances(centres) if len(centres) else np.zeros((0, 0))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, weights = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            bounds, raw = np.zeros(len(ids)), batch.column(2)
            d = cells.distances(vectors(batch, 2))
            home, own = d.argmin(1), d.min(1)
            yield from homes(ids, weights, bounds, raw, home, cells)
            block_at = place(ids, cells.blocks[home])
            visit = place(mix64(ids.astype(np.int64).view(np.uint64)).view(np.int64), np.full(len(ids), cells.visits))
            room = (d <= cells.radius[None, :] + reach + 1e-6)
            room &= d * d - (own * own)[:, None] <= 2 * reach * apart[home] + 1e-6
            room &= spread[None, :] >= home[:, None]
            for cell in spread:
                for b in range(cells.blocks[cell]):
                    take = np.nonzero(room[:, cell] & ((home != cell) | (block_at < b)))[0]
                    if len(take):
                        yield placed_batch(np.full(len(take), cell), np.full(len(take), b), visit[take], True, ids,
                                           weights, bounds, raw, take)

    def run(group: tuple, home: tuple, visitors: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        ids, weights, _, points = home
        # parts of a leaf that lie this close are linked or apart as a whole, or compared at once
        tree, near = Tree(points, reach / 16), lambda x, y: x @ y.T >= cosine
        found, root = np.zeros(len(ids), np.int64), list(range(len(ids)))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        def join(a: np.ndarray, b: np.ndarray) -> None:
            for i, j in zip(a.tolist(), b.tolist()):
                i, j = top(i), top(j)
                if i != j:
                    root[max(i, j)] = min(i, j)

        if group[2] == 0:
            for a, b, whole in threshold_pairs(tree, tree, reach, near):
                if whole:
                    found[a] += weights[b].sum()
                    join(np.r_[a, b], np.full(len(a) + len(b), a[0]))
                else:
                    np.add.at(found, a, weights[b])
                    join(a, b)
            found -= weights  # each row met itself
        for v_ids, v_weights, _, v_points in visitors:
            guests = Tree(v_points, reach / 16)
            linked, host = np.zeros(len(v_ids), np.int64), np.full(len(v_ids), -1)
            for a, b, whole in threshold_pairs(tree, guests, reach, near):
                if whole:
                    found[a] += v_weights[b].sum()
                    linked[b] += weights[a].sum()
                    join(a, np.full(len(a), a[0]))
                    a, b = np.full(len(b), a[0]), b
                else:
                    np.add.at(found, a, v_weights[b])
                    np.add.at(linked, b, weights[a])
                fresh = host[b] < 0
                host[b[fresh]] = a[fresh]
                join(a, host[b])
            out = np.nonzero(host >= 0)[0]
            if len(out):
                yield _links(v_ids[out], linked[out], ids[host[out]])
        out = np.nonzero(found > 0)[0]
        if len(out):
            yield _links(ids[out], found[out], ids[[top(i) for i in out]])

    placed = classes.select("id", "weight", "v").mapInArrow(deal, PLACED)
    return over_blocks(placed, run, "id long, links long, other long")


def _links(ids, links, others) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids, links, others)],
                                      names=["id", "links", "other"])


def near_duplicate_vectors(df: DataFrame, cosine: float = 0.95, id_col: str = "vec_id",
                           vector_col: str = "embedding", block: int = BLOCK_ROWS) -> DataFrame:
    """(id, n_links, component_id, kept) for each row.

    ``n_links`` counts the other rows at ``cosine`` or more, copies included; ``component_id`` is the smallest
    id reached over links. Vectors that are null, empty, zero, or hold null or non-finite components, and
    rows without id, link with nothing and are kept (their component is their id). All vectors have one
    length; other columns are not read.
    """
    rows = checkpoint(unit_vectors(df, id_col, vector_col))
    usable = rows.where("v IS NOT NULL AND id IS NOT NULL")
    classes = checkpoint(
        usable.groupBy("hi", "lo").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"), F.first("v").alias("v"))
    )
    found = checkpoint(links(classes.select("id", "weight", "v"), cosine, block))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    labels = (
        classes.join(counts, "id", "left").join(parts.withColumnRenamed("node", "id"), "id", "left")
        .select("hi", "lo", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                F.coalesce("component", "id").alias("component_id"))
    )
    key = rows.select("id", *[F.when(F.col("id").isNotNull(), F.col(c)).alias(c) for c in ("hi", "lo")])
    return key.join(labels, ["hi", "lo"], "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(True)).alias("kept"),
    )
