"""Token counts by byte-pair merging with a heap and a linked list (operator 5).

A text is cut where no merge can cross: the pieces of the vocabulary hold the mark of a space only at
their start, so each run of other characters after a space is a unit of its own. Counts of units are
kept in a bounded cache of the worker; a unit that is not in it goes through the merging below.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtables.llm.common import grow, worker_cache

SPACE = "▁"
UNIT_CACHE = 400_000
WORD_CACHE = 600_000
_UNITS = re.compile(" *[^ ]+| +$")


def load_pieces(path: str) -> tuple[dict[str, int], frozenset[str]]:
    """Rank of each mergeable piece (0 is best) and the characters that the vocabulary has."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        i for i in range(model.vocab_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    pieces = {model.id_to_piece(i): -model.get_score(i) for i in plain}
    order = {p: k for k, p in enumerate(sorted(pieces, key=lambda p: (pieces[p], p)))}
    ties: dict[float, int] = {}
    ranks = {p: ties.setdefault(pieces[p], order[p]) for p in sorted(pieces, key=order.__getitem__)}
    if any(SPACE in p.lstrip(SPACE) for p in pieces):
        raise ValueError("a piece has a space inside: units cannot be cut at spaces")
    return ranks, frozenset(p for p in pieces if len(p) == 1)


def merge_count(symbols: str, ranks: dict[str, int], known: frozenset[str]) -> int:
    """Tokens of one unit: its characters, less the merges, an unknown one being its UTF-8 bytes.

    The heap holds rank and left end of each adjacent pair that is a piece; the lowest rank, then the
    leftmost, is merged first. An entry is stale when its pair has changed since.
    """
    n = len(symbols)
    count = n if known.issuperset(symbols) else sum(1 if s in known else len(s.encode()) for s in symbols)
    if n == 1:
        return count
    rank_of = ranks.get
    base = n + 1  # rank, left end and right end of a pair as one number, in this order
    heap = []
    for i in range(n - 1):
        rank = rank_of(symbols[i:i + 2])
        if rank is not None:
            heap.append((rank * base + i) * base + i + 2)
    if not heap:
        return count
    heapify(heap)
    # linked list over start positions: the end of the symbol at a start, the start of the one before
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    while heap:
        rest, stop = divmod(heappop(heap), base)
        left = rest % base
        middle = end[left]
        if middle <= left or middle >= n or end[middle] != stop:  # merged away or grown meanwhile
            continue
        end[left], end[middle] = stop, -1
        count -= 1
        if stop < n:
            before[stop] = left
            rank = rank_of(symbols[left:end[stop]])
            if rank is not None:
                heappush(heap, (rank * base + left) * base + end[stop])
        start = before[left]
        if start >= 0:
            rank = rank_of(symbols[start:stop])
            if rank is not None:
                heappush(heap, (rank * base + start) * base + stop)
    return count


class Counter:
    """Tokens of whole texts; one for each worker, as the model is read from a file of the node."""

    def __init__(self, path: str):
        self.ranks, self.known = load_pieces(path)
        self.units: dict[str, int] = {}
        self.words: dict[str, int] = {}
        # a cut between two characters that no piece has side by side is exact as well
        self.joined = frozenset(p[i:i + 2] for p in self.ranks for i in range(len(p) - 1))

    def word(self, unit: str) -> int:
        """Tokens of a unit, from its stretches between characters that no piece joins."""
        joined, words, total, start = self.joined, self.words, 0, 0
        n = len(unit)
        for i in range(1, n + 1):
            if i == n or unit[i - 1:i + 1] not in joined:
                part = unit[start:i]
                got = words.get(part)
                if got is None:
                    got = grow(words, part, merge_count(part, self.ranks, self.known), WORD_CACHE)
                total += got
                start = i
        return total

    def count(self, text: str) -> int:
        if not text:
            return 0
        if SPACE in text:
            text = text.replace(SPACE, " ")
        # one space before each unit is the rule; runs of spaces belong to the unit that follows
        if "  " in text or text[0] == " " or text[-1] == " ":
            units = [u[1:] for u in _UNITS.findall(" " + text)]
        else:
            units = text.split(" ")
        cache = self.units
        try:
            return sum(map(cache.__getitem__, units))
        except KeyError:
            total = 0
            for unit in units:
                got = cache.get(unit)
                if got is None:
                    got = grow(cache, unit, self.word((" " + unit).replace(" ", SPACE)), UNIT_CACHE)
                total += got
            return total


def counter(path: str) -> Counter:
    cache = worker_cache("bpe")
    if path not in cache:
        cache[path] = Counter(path)
    return cache[path]


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for each row, in one pass without a shuffle.

    A null or empty text has 0 bytes and 0 tokens. Null and repeated ids are kept as they are, one
    row out for each row in. Columns besides the two named are not read.
    """
    rows = df.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch in batches:
            texts = batch.column(1)
            tokens = [count(t.as_py() or "") for t in texts]
            size = [0 if x is None else x for x in pa.compute.binary_length(texts).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([t > limit for t in tokens], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    return rows.mapInArrow(run, f"`{id_col}` {id_type.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
