"""Ranked lexical search by hashed max-sketches (operator 12).

An item is a query, its terms are looked up in every document. A document's impact of a term depends on
its own length and the term's occurrences alone; the impacts of terms that items ask for are folded by
hash into a row of coordinates, each holding the largest impact dealt to it. One product with the items'
weights gives upper bounds for a block of documents and all items. Documents are then scored exactly in
descending order of bound, until the bound falls below an item's k-th best score so far.
"""

from __future__ import annotations

from bisect import insort
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

COORDINATES = 2048
BLOCK_ROWS = 512
ITEMS = 1_000
ITEM_BYTES = 4_000_000
MERGE_PARTS = 16

# Bytes of terms stay (A-Z in lower case), all others become spaces.
_TABLE = bytes(
    b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: str) -> list[bytes]:
    """Terms of a whole text: runs of 0-9, letters and non-ASCII characters, A-Z in lower case."""
    return text.encode().translate(_TABLE).split()


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, all their terms, and the number of documents that hold each wanted term."""

    n: int
    places: int
    holding: dict[bytes, int]

    def weight(self, term: bytes) -> int:
        return floor(1000 * log((2 * self.n + 2) / (2 * self.holding.get(term, 0) + 1)))


def corpus(texts: DataFrame, wanted: frozenset[bytes]) -> Corpus:
    """Statistics over all texts of the first column; one row a wanted term, and one more, reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding: Counter = Counter()
        n = places = 0
        for batch in batches:
            for text in batch.column(0):
                terms = terms_of(text.as_py() or "")
                n += bool(terms)
                places += len(terms)
                holding.update(wanted.intersection(terms))
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *holding], pa.binary()), pa.array([n, *holding.values()], pa.int64()),
             pa.array([places, *[0] * len(holding)], pa.int64())], names=["term", "n", "places"],
        )

    sums = texts.mapInArrow(run, "term binary, n long, places long").groupBy("term").agg(
        F.sum("n").alias("n"), F.sum("places").alias("places"))
    rows = {None if r["term"] is None else bytes(r["term"]): r for r in sums.collect()}
    whole = rows.pop(None, None)
    return Corpus(whole["n"] if whole else 0, whole["places"] if whole else 0, {t: r["n"] for t, r in rows.items()})


@dataclass(frozen=True)
class Items:
    """Terms of a block of items with what an occurrence adds, and the same by coordinate."""

    ids: list
    terms: list[list[tuple[bytes, int]]]  # of each item: (term, times * weight), none of weight 0
    coordinate: dict[bytes, int]
    weights: np.ndarray  # coordinates x items

    @staticmethod
    def make(ids: Sequence, counts: Sequence[Counter], stats: Corpus, coordinates: int) -> Items:
        terms = [[(t, c * w) for t, c in sorted(of.items()) if (w := stats.weight(t)) > 0] for of in counts]
        place = {t: crc32(t) % coordinates for of in terms for t, _ in of}
        weights = np.zeros((coordinates, len(terms)))
        for item, of in enumerate(terms):
            for t, w in of:
                weights[place[t], item] += w
        return Items(list(ids), terms, place, weights)


def impacts(words: Sequence[bytes], wanted: dict[bytes, int], stats: Corpus) -> dict[bytes, int]:
    """Impact of each wanted term of a document with these words, in integers."""
    m = 100 - 25 + 25 * len(words) * stats.n // stats.places
    return {t: 1_000_000_000 * tf // (1000 * tf + 12 * m) for t, tf in Counter(filter(wanted.__contains__, words)).items()}


def sketch(block: Sequence[dict[bytes, int]], place: dict[bytes, int], coordinates: int) -> np.ndarray:
    """documents x coordinates: the largest impact of the terms dealt to a coordinate."""
    out = np.zeros((len(block), coordinates))
    for row, found in zip(out, block):
        if found:
            np.maximum.at(row, [place[t] for t in found], list(found.values()))
    return out


class Best:
    """The k best documents of each item among those seen by a task."""

    def __init__(self, items: Items, k: int):
        self.items, self.k = items, k
        self.best: list[list[tuple]] = [[] for _ in items.ids]  # (-score, id is null, id), ascending
        self.worst = np.ones(len(items.ids))  # a document must reach this score

    def add(self, ids: Sequence, block: Sequence[dict[bytes, int]]) -> None:
        # sums of integers below 2**53, so the bounds are exact in doubles
        bounds = sketch(block, self.items.coordinate, self.items.weights.shape[0]) @ self.items.weights
        for item in np.flatnonzero((bounds >= self.worst).any(0)):
            column = bounds[:, item]
            rows = np.flatnonzero(column >= self.worst[item])
            for row in rows[np.argsort(-column[rows], kind="stable")]:
                if column[row] < self.worst[item]:
                    break
                found = block[row]
                score = sum(w * found[t] for t, w in self.items.terms[item] if t in found)
                if score > 0:
                    self.offer(item, score, ids[row])

    def offer(self, item: int, score: int, doc) -> None:
        best = self.best[item]
        insort(best, (-score, doc is None, 0 if doc is None else doc))
        if len(best) > self.k:
            best.pop()
        if len(best) == self.k:
            self.worst[item] = -best[-1][0]


def _search(rows: DataFrame, items: Items, stats: Corpus, k: int) -> DataFrame:
    """(item, doc, score): the k best documents of each item in every task."""
    sent = rows.sparkSession.sparkContext.broadcast((items, stats))
    kind = rows.schema["doc"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, stats = sent.value
        best, id_type = Best(items, k), None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                words = (terms_of(t.as_py() or "") for t in part.column(1))
                found = [impacts(w, items.coordinate, stats) if w else {} for w in words]
                best.add(part.column(0).to_pylist(), found)
        if id_type is not None:
            out = [(i, None if null else doc, -score) for i, of in enumerate(best.best) for score, null, doc in of]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], id_type),
                 pa.array([o[2] for o in out], pa.int64())], names=["item", "doc", "score"],
            )

    return rows.mapInArrow(run, f"item int, doc {kind.simpleString()}, score long")


def _blocks(items: DataFrame, size: int, most_bytes: int) -> Iterator[list[tuple]]:
    """Different (id, text) rows in blocks of bounded number and bytes, read piece by piece."""
    block, held = [], 0
    for row in items.distinct().orderBy("id", "text").toLocalIterator():
        block.append((row["id"], row["text"]))
        held += len(row["text"])
        if len(block) >= size or held >= most_bytes:
            yield block
            block, held = [], 0
    if block:
        yield block


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", coordinates: int = COORDINATES,
                  block: int = ITEMS) -> DataFrame:
    """(item, rank, doc, score): each item's k highest-scoring documents with a score above 0.

    Equal scores are ranked by ascending document id, null ids last; repeated document rows are documents
    of their own. Items of equal id and text are one item, of equal id and different texts items of
    their own; items without a term of the corpus have no rows. Null texts hold no term. Columns
    besides those named are not read. Every document is tokenised once for the statistics and once for the
    search, in blocks of items of which there are as many as the table of items needs; a task sends at
    most k rows an item.
    """
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).alias("id"), F.col(item_text_col).cast("string").alias("text")).where("text IS NOT NULL")
    parts = []
    for some in _blocks(asked, block, ITEM_BYTES):
        counts = [Counter(terms_of(text)) for _, text in some]
        stats = corpus(rows.select("text"), frozenset(t for of in counts for t in of))
        made = Items.make([i for i, _ in some], counts, stats, coordinates)
        parts.append(_ranked(_search(rows, made, stats, k), made.ids, asked.schema["id"].dataType, k, item_col, id_col))
    if not parts:
        return docs.sparkSession.createDataFrame([], f"`{item_col}` {asked.schema['id'].dataType.simpleString()}, rank int, "
                                                     f"`{id_col}` {rows.schema['doc'].dataType.simpleString()}, score long")
    return reduce(DataFrame.unionAll, parts)


def _ranked(found: DataFrame, ids: list, kind, k: int, item_col: str, id_col: str) -> DataFrame:
    """The k best of what the tasks sent: first among the rows of each part, then of each item."""
    order = [F.desc("score"), F.col("doc").asc_nulls_last()]
    parted = found.withColumn("part", F.pmod(F.xxhash64("doc"), F.lit(MERGE_PARTS)))
    for keys in (["item", "part"], ["item"]):
        parted = parted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    names = found.sparkSession.createDataFrame(list(enumerate(ids)), f"number int, `{item_col}` {kind.simpleString()}")
    # one row for each item of a block, whose number is bounded
    return parted.join(F.broadcast(names), F.col("item") == F.col("number")).select(
        item_col, F.col("rank").cast("int").alias("rank"), F.col("doc").alias(id_col), "score")


def oracle(k: int = 20) -> str:
    """DuckDB SQL for ``documents`` and ``benchmark``."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = rf"regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {words} AS words FROM documents),
    items AS (SELECT row_number() OVER () AS item, item_id, {words} AS words
              FROM (SELECT DISTINCT item_id, text FROM benchmark)),
    asked AS (SELECT item, term, count(*) AS times FROM (SELECT item, unnest(words) AS term FROM items) GROUP BY ALL),
    held AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(words) AS term FROM docs)
             WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
    whole AS (SELECT count(*)::BIGINT AS n, sum(len(words))::BIGINT AS l FROM docs WHERE len(words) > 0),
    weights AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
                FROM (SELECT term, count(*) AS df FROM held GROUP BY 1), whole),
    sizes AS (SELECT row, doc_id, (100 - 25 + (25 * len(words)::BIGINT * n) // l)::BIGINT AS m
              FROM docs, whole WHERE len(words) > 0),
    scores AS (SELECT item, row, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
               FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN sizes USING (row) GROUP BY ALL),
    ranked AS (SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank
               FROM scores JOIN docs USING (row) WHERE score > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked JOIN items USING (item) WHERE rank <= {k}
    """
