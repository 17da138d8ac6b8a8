"""SentencePiece encoding by streaming Viterbi, and decoding (operator 4).

The best path is the one with the highest sum of the scores that the model file gives its pieces. A
character without a piece is written as its UTF-8 bytes, at a score below that of every piece. Only
back pointers inside a window of the longest piece are kept; once all of them lead back to one
boundary, the ids before it are final and leave the window.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from itertools import accumulate
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtables.llm.common import grow, worker_cache

SPACE = "▁"
UNIT_CACHE = 400_000
LONG_UNIT = 64
SLICE = 256
UNKNOWN_PENALTY = 10.0
NEVER = float("-inf")


class Vocabulary:
    """Pieces, scores and byte ids of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, tuple[float, int]] = {}
        self.bytes = [0] * 256
        self.text: list[str | int | None] = []  # of an id: its piece, its byte, or nothing
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.text.append(int(piece[3:5], 16))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.text.append(None)
            else:
                self.pieces[piece] = (model.get_score(i), i)
                self.text.append(piece)
        self.longest = max(map(len, self.pieces))
        self.trie: dict = {}  # by character: [further characters, score, id]; id -1 where no piece ends
        for piece, (value, i) in self.pieces.items():
            at = self.trie
            for c in piece:
                node = at.setdefault(c, [{}, 0.0, -1])
                at = node[0]
            node[1:] = value, i
        self.joined = frozenset(p[i:i + 2] for p in self.pieces for i in range(len(p) - 1))
        self.parts: dict[str, bytes] = {}
        self.unknown = min(s for s, _ in self.pieces.values()) - UNKNOWN_PENALTY
        self.cut = all(SPACE not in p.lstrip(SPACE) for p in self.pieces)
        self.units: dict[str, bytes] = {}

    def stream(self, text: str | Iterable[str]) -> Iterator[int]:
        """Ids of the best path through a text (spaces already marked); ties go to the longer piece.

        ``best[k]`` and ``back[k]`` belong to position ``k`` of the window, which holds the characters from the
        last committed boundary on. Where no piece reaches beyond the current position, every path goes
        through it and what lies before is committed; a window that grows to four times the longest piece
        is cut at the boundary on which the back pointers of all reached positions meet.
        """
        trie, unknown, longest = self.trie, self.unknown, self.longest
        slices = (text[i:i + SLICE] for i in range(0, len(text), SLICE)) if isinstance(text, str) else iter(text)
        window, at, reach, best, back, ids = "", 0, 0, [0.0], [0], [-1]
        more = next(slices, None)
        while more is not None:
            window += more
            best += [NEVER] * len(more)
            back += [0] * len(more)
            ids += [-1] * len(more)
            more, size = next(slices, None), len(window)
            # a position is worked on once all pieces from it lie in the window
            stop = size if more is None else size - longest
            start = 0  # the last boundary, whose best path scores 0
            while at < stop:
                if at == reach:
                    if at > start:
                        yield from self._path(window, back, ids, at, start)
                        start, best[at] = at, 0.0
                elif at - start >= 4 * longest:
                    meet = self._meeting(best, back, at, size)
                    if meet > start:
                        yield from self._path(window, back, ids, meet, start)
                        lost = best[meet]
                        for k in range(meet, min(at + longest, size) + 1):
                            best[k] -= lost
                            # reached from before the boundary: on no path any more
                            back[k] = max(back[k], meet)
                        start = meet
                score, node, end = best[at], trie, at
                if best[at + 1] == NEVER:
                    best[at + 1], back[at + 1] = score + unknown, at
                    if reach <= at:
                        reach = at + 1
                while end < size:
                    found = node.get(window[end])
                    if found is None:
                        break
                    end += 1
                    node, value, number = found
                    if number >= 0 and score + value > best[end]:
                        best[end], back[end], ids[end] = score + value, at, number
                        if end > reach:
                            reach = end
                at += 1
            if start:
                window, at, reach = window[start:], at - start, reach - start
                best, ids = best[start:], [-1, *ids[start + 1:]]
                back = [0, *[max(b - start, 0) for b in back[start + 1:]]]
        yield from self._path(window, back, ids, len(window), 0)

    @staticmethod
    def _meeting(best: list[float], back: list[int], at: int, size: int) -> int:
        """The last boundary on which the back pointers of all reached positions from ``at`` on meet."""
        ends = {e for e in range(at, size + 1) if best[e] != NEVER}
        while len(ends) > 1:
            last = max(ends)
            ends.discard(last)
            ends.add(back[last])
        return ends.pop()

    def _path(self, text: str, back: list[int], ids: list[int], at: int, stop: int) -> list[int]:
        """Ids of the best path from the boundary ``stop`` to the position ``at``."""
        out: list[int] = []
        while at > stop:
            start = back[at]
            if ids[at] >= 0:
                out.append(ids[at])
            else:
                out.extend(self.bytes[b] for b in reversed(text[start:at].encode()))
            at = start
        return out[::-1]

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32 bits.

        No piece has the mark of a space after another character, so all paths meet before each word;
        ids of short words are cached from there. Without that property the text is one stream.
        """
        if not text:
            return b""
        marked = SPACE + text.replace(" ", SPACE)
        if not self.cut:
            return self._pack(self.stream(marked))
        out, cache, run = [], self.units, ""
        for unit in marked[1:].split(SPACE):
            if not unit:
                run += SPACE  # a run of spaces belongs to the word that follows
                continue
            unit, run = run + SPACE + unit, ""
            got = cache.get(unit)
            if got is None:
                got = self._unit(unit)
                if len(unit) <= LONG_UNIT:
                    grow(cache, unit, got, UNIT_CACHE)
            out.append(got)
        if run:
            out.append(self._pack(self.stream(run)))
        return b"".join(out)

    def _unit(self, unit: str) -> bytes:
        """Ids of a word; all paths also meet between two characters that no piece has side by side."""
        out, start = [], 0
        for i in range(1, len(unit) + 1):
            if i == len(unit) or unit[i - 1:i + 1] not in self.joined:
                part = unit[start:i]
                got = self.parts.get(part)
                if got is None:
                    got = self._pack(self.stream(part))
                    if len(part) <= LONG_UNIT:
                        grow(self.parts, part, got, UNIT_CACHE)
                out.append(got)
                start = i
        return b"".join(out)

    @staticmethod
    def _pack(ids: Iterable[int]) -> bytes:
        ids = list(ids)
        return struct.pack(f"<{len(ids)}I", *ids)

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters, other ids nothing."""
        out = bytearray()
        for i in struct.unpack(f"<{len(ids) // 4}I", ids):
            piece = self.text[i] if i < len(self.text) else None
            if isinstance(piece, int):
                out.append(piece)
            elif piece is not None:
                out += piece.encode()
        text = out.decode(errors="replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


def vocabulary(path: str) -> Vocabulary:
    cache = worker_cache("viterbi")
    if path not in cache:
        cache[path] = Vocabulary(path)
    return cache[path]


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of each text; a null text has null ids, an empty one none.

    One row out for each row in, whatever its id; columns besides the two named are not read.
    """
    rows = df.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        words = vocabulary(path)
        for batch in batches:
            ids = [None if t.as_py() is None else np.frombuffer(words.encode(t.as_py()), "<i4")
                   for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[id_col, "ids"]
            )

    return rows.mapInArrow(run, f"`{id_col}` {id_type}, ids array<int>")


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of each row of ids; null ids have a null text."""
    rows = df.select(F.col(id_col).alias(id_col), F.col(ids_col).cast("array<int>").alias("ids"))
    id_type = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            texts = [None if i is None else words.decode(struct.pack(f"<{len(i)}I", *i))
                     for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             names=[id_col, "text"])

    return rows.mapInArrow(run, f"`{id_col}` {id_type}, text string")


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_ids, ids_crc32, ids, same): encoding and decoding in one pass; ``same`` if the text comes back.

    A null text counts as empty. A literal mark of a space in a text comes back as a space.
    """
    rows = df.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            counts, digests, same, coded = [], [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                ids = words.encode(text)
                counts.append(len(ids) // 4)
                digests.append(crc32(ids))
                coded.append(ids)
                same.append(words.decode(ids) == text.replace(SPACE, " "))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.int64()), _lists(coded),
                 pa.array(same, pa.bool_())], names=[id_col, "n_ids", "ids_crc32", "ids", "same"],
            )

    return rows.mapInArrow(run, f"`{id_col}` {id_type}, n_ids long, ids_crc32 long, ids array<int>, same boolean")


def _lists(coded: list[bytes]) -> pa.Array:
    """Lists of 32-bit ids from their bytes, without a copy of each id."""
    ends = pa.array([0, *accumulate(len(ids) // 4 for ids in coded)], pa.int32())
    values = pa.Array.from_buffers(pa.int32(), ends[-1].as_py(), [None, pa.py_buffer(b"".join(coded))])
    return pa.ListArray.from_arrays(ends, values)
