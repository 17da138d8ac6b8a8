"""Exact search of the largest inner products with dual cover trees (operator 7)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labtables.llm.common import checkpoint
from labtables.llm.covertree import (
    BLOCK_ROWS, PLACED, Cells, Tree, homes, make_cells, over_blocks, place, placed_batch, top_products, vectors,
)

K = 10


def scaled_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int, query: Column) -> DataFrame:
    """(id, v, m, q): floor(scale * x) of each usable vector as doubles, in which the products are exact.

    Equal rows (id, v) are one, ``m`` is their number and ``q`` the number of queries among them.
    """
    x = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("id"), query.alias("query"), x.alias("x"))
    rows = rows.where("id IS NOT NULL AND size(x) > 0 AND forall(x, c -> c IS NOT NULL AND abs(c) < double('Infinity'))")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.floor(scale * np.array(x.as_py(), float)).tobytes() for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                                             names=["id", "query", "v"])

    made = rows.mapInArrow(run, "id long, query boolean, v binary")
    return made.groupBy("id", "v").agg(F.count(F.lit(1)).alias("m"), F.count_if("query").alias("q"))


def _search(data: DataFrame, queries: DataFrame, cells: Cells, k: int, everywhere: bool) -> DataFrame:
    """(query_id, vec_id, score, n): candidates of the queries (id, q, bound, v) in the blocks they visit.

    Rows and queries are distinct; ``n`` is how many pairs of their copies a result stands for.
    Either one block of the query's own cell, for a first bound, or every block whose largest possible
    product, from its centre and covering radius, is not below the query's bound.
    """
    def deal_data(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, copies = batch.column(0).to_numpy(), batch.column(2).to_numpy()
                home = cells.distances(vectors(batch, 1)).argmin(1)
                yield from homes(ids, copies, np.zeros(len(ids)), batch.column(1), home, cells)

    def deal_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, bounds = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            points, copies = vectors(batch, 2), batch.column(3).to_numpy()
            visit = place(ids, np.full(len(ids), cells.visits))
            home = cells.distances(points).argmin(1)
            most = points @ cells.centres.T + np.linalg.norm(points, axis=1)[:, None] * cells.radius[None, :]
            for cell in range(len(cells.centres)):
                for b in range(cells.blocks[cell]):
                    if everywhere:
                        take = np.nonzero(most[:, cell] + 1e-6 >= bounds)[0]
                    else:
                        take = np.nonzero((home == cell) & (place(ids, cells.blocks[home]) == b))[0]
                    if len(take):
                        yield placed_batch(np.full(len(take), cell), np.full(len(take), b), visit[take], True, ids,
                                           copies, bounds, batch.column(2), take)

    def run(group: tuple, home: tuple, visitors: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        ids, copies, _, points = home
        tree = None
        for v_ids, v_copies, v_bounds, v_points in visitors:
            tree = tree or Tree(points)
            best = top_products(Tree(v_points), tree, k, ids, v_bounds, v_ids)
            sizes = [len(rows) for rows, _ in best]
            rows = np.concatenate([rows for rows, _ in best])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(v_ids, sizes), pa.int64()), pa.array(ids[rows], pa.int64()),
                 pa.array(np.concatenate([s for _, s in best]).astype(np.int64)),
                 pa.array(np.repeat(v_copies, sizes) * copies[rows])], names=["query_id", "vec_id", "score", "n"],
            )

    placed = data.select("id", "v", "m").mapInArrow(deal_data, PLACED).unionByName(
        queries.select("id", "bound", "v", "q").mapInArrow(deal_queries, PLACED)
    )
    return over_blocks(placed, run, "query_id long, vec_id long, score long, n long")


def top_k(df: DataFrame, query: Column, k: int = K, scale: int = 1024, id_col: str = "vec_id",
          vector_col: str = "embedding", block: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest products of each query with all rows but its own.

    Rows for which ``query`` holds are the queries. Scores are whole numbers, ties go to the smaller id.
    Vectors that are null, empty, or hold null or non-finite components, and rows without id, take no part;
    fewer than k candidates give fewer rows. Rows with the query's id count as its own. Repeated rows are
    searched once; as in SQL each copy of a candidate takes a rank, and so does each copy of its query's row.
    All vectors have one length; other columns are not read.
    """
    rows = checkpoint(scaled_vectors(df, id_col, vector_col, scale, F.coalesce(query, F.lit(False))))
    cells = make_cells(rows, block)
    queries = rows.where("q > 0").select("id", F.lit(float("-inf")).alias("bound"), "v", "q")
    first = _search(rows, queries, cells, k, everywhere=False)
    ranks = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    bounds = (
        first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("low"))
        .where(F.col("n") >= k)
    )
    bounds = queries.join(bounds, F.col("id") == F.col("query_id"), "left").select(
        "id", F.coalesce("low", "bound").alias("bound"), "v", "q"
    )
    found = _search(rows, checkpoint(bounds), cells, k, everywhere=True)
    copies = F.explode(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k)).cast("int")))
    ranked = found.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)
    return (
        ranked.select("query_id", "vec_id", "score", copies.alias("copy"))
        .withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
