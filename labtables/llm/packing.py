"""Hierarchical packing of documents into sequences of several lengths (operator 3).

Each scan task packs what it reads: full windows of the longest tier are cut off first, the rest of a
document is routed to the shortest tier that holds it. Within a bounded pool the tiers are packed from
the longest down, a window's gap is filled from the pieces of shorter tiers, and a gap that none of
them fits is closed by cutting one. Sequences of a pool are dealt into step groups of like cost.
Nothing is shuffled and no task holds more than a pool, whatever a source or a document holds.
"""

from __future__ import annotations

import struct
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence
from itertools import count
from zlib import crc32

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtables.llm.common import grow, worker_cache

TIERS = (1024, 512, 256, 128)
POOL_TOKENS = 1_000_000
UNIT_CACHE = 700_000
WORD_CACHE = 700_000
_CONTROL = regex.compile("[\x1c-\x1f]")
_LETTERS = "\u0250"  # below it the letters of Python are those of the splitting pattern


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others from 256 on."""
    free = count(256)
    shown = [33 <= b <= 126 or 161 <= b <= 172 or 174 <= b for b in range(256)]
    return [chr(b) if shown[b] else chr(next(free)) for b in range(256)]


class Encoder:
    """Ids of whole texts as bytes (little-endian 32 bits), equal to those of the ``tokenizers`` file.

    A text is cut before spaces that a non-space follows, where the splitting pattern always cuts.
    Ids of units and of their parts are kept in bounded caches; the library's model finds the others.
    """

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.split = regex.compile(pattern)
        self.letters = dict(enumerate(byte_letters()))
        self.packs = [struct.Struct(f"<{n}I").pack for n in range(32)]
        self.parts: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}

    def part(self, part: str) -> bytes:
        got = self.parts.get(part)
        if got is None:
            letters = part.encode().decode("latin-1").translate(self.letters)
            ids = [t.id for t in self.model.tokenize(letters)]
            packed = self.packs[len(ids)](*ids) if len(ids) < len(self.packs) else struct.pack(f"<{len(ids)}I", *ids)
            got = grow(self.parts, part, packed, WORD_CACHE)
        return got

    def plain(self, text: str) -> bool:
        """Whether the splitting pattern alone decides; what holds for a text holds for all that is cut from it."""
        return not (_CONTROL.search(text) or any(s in text for s in self.special))

    def whole(self, text: str) -> bytes:
        if not self.plain(text):
            ids = self.library.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(map(self.part, self.split.findall(text)))

    def encode(self, text: str) -> bytes:
        first, *units = text.split(" ")
        cache = self.units
        out = [*map(cache.get, units)]
        if missing := out.count(None):
            part, find, plain, i = self.part, self.split.findall, self.plain(text), -1
            for _ in range(missing):
                i = out.index(None, i + 1)
                unit = units[i]
                if not unit or unit[0].isspace():  # the space before it is not cut off
                    return self.whole(text)
                if not plain:
                    ids = self.whole(" " + unit)
                elif unit.isalpha() and max(unit) < _LETTERS:  # the pattern takes it as one part
                    ids = part(" " + unit)
                else:
                    ids = b"".join(map(part, find(" " + unit)))
                out[i] = grow(cache, unit, ids, UNIT_CACHE)
        if first:
            out.insert(0, self.whole(first))
        return b"".join(out)


def encoder(path: str, pattern: str) -> Encoder:
    cache = worker_cache("byte_bpe")
    if path not in cache:
        cache[path] = Encoder(path, pattern)
    return cache[path]


class Packer:
    """Packs pieces (document, start, ids) of one task; ``pool`` keeps them sorted by length."""

    def __init__(self, tiers: Sequence[int], task: int, step: int):
        self.tiers = sorted(tiers, reverse=True)
        self.step = step
        self.next_id = task << 40
        self.next_step = task << 40
        self.pool: list[tuple[int, int, int, tuple]] = []  # length, order of arrival, start, document
        self.arrived = count()
        self.tokens = 0
        self.done: list[list[tuple[int, int, tuple]]] = []  # sequences of (start, length, document)

    def add(self, document: tuple) -> None:
        """document: (id, ids as bytes, tokens)."""
        start, total, top = 0, document[2], self.tiers[0]
        while total - start >= top:
            self.done.append([(start, top, document)])
            start += top
        if start < total:
            self._put(total - start, start, document)

    def _put(self, length: int, start: int, document: tuple) -> None:
        insort(self.pool, (length, next(self.arrived), start, document))
        self.tokens += length

    def _fill(self, window: int) -> None:
        """One full window: the longest piece that fits, again and again; else the shortest one is cut."""
        sequence, gap = [], window
        while gap:
            at = bisect_right(self.pool, (gap, float("inf")))
            length, _, start, document = self.pool.pop(at - 1 if at else 0)
            self.tokens -= length
            if length > gap:
                self._put(length - gap, start + gap, document)
                length = gap
            sequence.append((start, length, document))
            gap -= length
        self.done.append(sequence)

    def pack(self, last: bool = False) -> list[tuple]:
        """Pack the pool tier by tier; pieces that fill no window wait for the next pool.

        At the end of the task the rest goes to sequences of powers of two, so nothing is padded.
        """
        for tier, below in zip(self.tiers, [*self.tiers[1:], 0]):
            while self.tokens >= tier and bisect_left(self.pool, (below + 1,)) < len(self.pool):
                self._fill(tier)
        while last and self.tokens:
            self._fill(1 << (min(self.tokens, self.tiers[0]).bit_length() - 1))
        return self._rows()

    def _rows(self) -> list[tuple]:
        rows = []
        cost = lambda s: sum(p[1] * p[1] for p in s)  # noqa: E731  attention within documents
        by_size: dict[int, list] = {}
        for sequence in self.done:
            by_size.setdefault(sum(p[1] for p in sequence), []).append(sequence)
        self.done = []
        for size, sequences in sorted(by_size.items(), reverse=True):
            groups = -(-len(sequences) // self.step)
            for i, sequence in enumerate(sorted(sequences, key=cost, reverse=True)):
                turn, at = divmod(i, groups)  # there and back, so that costs even out
                group = at if turn % 2 == 0 else groups - 1 - at
                offset = 0
                for start, length, (doc_id, ids, total) in sequence:
                    digest = crc32(memoryview(ids)[4 * start:4 * (start + length)])
                    rows.append((doc_id, start, length, digest, total, self.next_id, offset, size,
                                 self.next_step + group))
                    offset += length
                self.next_id += 1
            self.next_step += groups
        return rows


def pack_documents(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                   tiers: Sequence[int] = TIERS, end_id: int = 0, step: int = 64,
                   pool_tokens: int = POOL_TOKENS) -> DataFrame:
    """Pieces (id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_id).

    ``tiers`` are powers of two, the longest being the window. A document is its ids and ``end_id``;
    null and empty texts have that id alone. Each id lies in exactly one piece and each sequence is
    filled to a power of two. ``step`` sequences of one length form a step group. Null or repeated
    document ids are kept apart by row; columns besides the two named are not read.
    """
    if any(t < 1 or t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two")
    rows = df.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema[id_col].dataType.simpleString()
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_id"]
    ending = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern).encode
        packer = Packer(tiers, TaskContext.get().partitionId(), step)
        id_arrow, waiting = None, 0

        def out(packed: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*packed))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_arrow), *[pa.array(c, pa.int64()) for c in columns[1:]]], names=names
            )

        for batch in batches:
            id_arrow = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + ending
                packer.add((doc_id, ids, len(ids) // 4))
                waiting += len(ids) // 4
                if waiting >= pool_tokens:
                    waiting = 0
                    if packed := packer.pack():
                        yield out(packed)
        if id_arrow is not None and (packed := packer.pack(last=True)):
            yield out(packed)

    return rows.mapInArrow(run, f"`{id_col}` {id_type}, " + ", ".join(f"{n} long" for n in names[1:]))
