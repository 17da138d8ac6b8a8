"""Quality rules with the perplexity of an n-gram model (operator 11).

A text is read as its bytes, none folded or left out. Spark counts every n-gram of them in all documents and makes
modified Kneser-Ney estimates of the counts, order by order. The model is one pair of arrays an order, hashes of
n-grams in order and their -log2 probabilities beside them, looked up by binary search. Lower orders go out whole
(an order of 3 has at most 256**3 n-grams, text in UTF-8 far fewer); the highest goes out in parts of about
``PART`` n-grams, with a scan for each, so that no task and not the driver holds all of it.

Byte classes (``CLASSES``: letters, one for capitals, digits, blanks, kinds of punctuation, other bytes folded to
20) can be counted instead of bytes (``FOLDED``); there are 64, which bounds such a model by 64**order n-grams.

Fixed rules come first. Of the texts that pass them, each language has a band of bits per byte around its
median; a text below its band repeats itself, one above it is not running text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labtables.llm.common import mix64, written

ORDER = 4
PIECE = 1 << 20
HELD = 1 << 21  # distinct n-grams that a task holds
PART = 1 << 23  # n-grams of the highest order that go out at once
DEAL = 1_000_003  # a prime: n-grams are dealt to parts by their remainders
BINS = 1000  # of one bit per byte
WIDTH = 6.0
LEAST_SPREAD = 0.01
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# Classes of ASCII bytes besides letters and digits; 0 stands before the start of a text.
_GROUPS = (" \t\x0b\x0c", "\n\r", ".", ",", "!", "?", ";:", "'\"`", "()[]{}", "-_", "|", "/\\", "#*$%&<>@^~+=")


def _classes() -> np.ndarray:
    of = np.full(256, 42, np.uint8)  # control bytes
    of[ord("a"):ord("z") + 1] = np.arange(1, 27)
    of[ord("A"):ord("Z") + 1] = 27
    of[ord("0"):ord("9") + 1] = 28
    for number, group in enumerate(_GROUPS):
        of[[ord(c) for c in group]] = 29 + number
    of[0x80:0xC0] = 43 + (np.arange(0x80, 0xC0) & 15)
    of[0xC0:0xE0] = 59 + (np.arange(0xC0, 0xE0) & 1)
    of[0xE0:0xF0] = 61
    of[0xF0:] = 62
    return of


CLASSES = _classes()


@dataclass(frozen=True)
class Codes:
    """What n-grams are made of: bits of a code, the code of each byte, the code before the start of a text."""

    bits: int
    of: np.ndarray
    start: int


BYTES = Codes(8, np.arange(256, dtype=np.uint8), 255)  # 255 is in no text of UTF-8
FOLDED = Codes(6, CLASSES, 0)


def grams(text: str, order: int, codes: Codes = FOLDED) -> Iterator[np.ndarray]:
    """The n-gram that ends at each byte, packed into a number, in pieces of bounded length."""
    data = np.frombuffer(text.encode(), np.uint8)
    for start in range(0, len(data), PIECE):
        low = max(start - order + 1, 0)
        found = codes.of[data[low:start + PIECE]].astype(np.int64)
        found = np.concatenate([np.full(order - 1 - (start - low), codes.start, np.int64), found])
        n = len(found) - order + 1
        packed = np.zeros(n, np.int64)
        for j in range(order):
            packed = packed << codes.bits | found[j:j + n]
        yield packed


def _hash(packed: np.ndarray) -> np.ndarray:
    return mix64(packed.astype(np.uint64))


@dataclass(frozen=True)
class Model:
    """For each order from 1: sorted hashes of n-grams and their bits, of contexts and the bits to back off.

    One of several parts answers for the n-grams dealt to it, seen or not; totals of all parts add up.
    """

    grams: tuple[np.ndarray, ...]
    bits: tuple[np.ndarray, ...]
    contexts: tuple[np.ndarray, ...]
    backoff: tuple[np.ndarray, ...]
    code_bits: int
    part: int = 0
    parts: int = 1

    def total(self, packed: np.ndarray) -> float:
        """Sum of -log2 p(last | others) over packed n-grams of the model's order."""
        out, rest = 0.0, packed
        if self.parts > 1:
            rest = rest[rest % DEAL % self.parts == self.part]
        for k in range(len(self.grams), 0, -1):
            at, found = _find(self.grams[k - 1], rest & ((1 << self.code_bits * k) - 1))
            out += float(self.bits[k - 1][at[found]].sum())
            rest = rest[~found]
            if not len(rest):
                return out
            at, found = _find(self.contexts[k - 1], (rest & ((1 << self.code_bits * k) - 1)) >> self.code_bits)
            out += float(self.backoff[k - 1][at[found]].sum())
        return out + self.code_bits * len(rest)


def _find(table: np.ndarray, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes = _hash(packed)
    if not len(table):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
    return at, table[at] == hashes


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Discounts of counts 1, 2 and 3 or more, from the numbers of n-grams with counts 1 to 4.

    Kept between 0.1 and the count itself, so that every context leaves something to lower orders;
    0.5, 1 and 1.5 where the corpus is too small to estimate them.
    """
    if not min(n1, n2, n3):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    raw = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return [min(max(d, 0.1), i) for i, d in enumerate(raw, 1)]


def _sorted(packed: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes = _hash(packed)
    order = np.argsort(hashes)
    return hashes[order], values[order]


def _arrays(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the first column and -log2 of the second."""
    key, value = df.columns
    got = df.select(key, (-F.log2(value)).cast("float").alias("bits")).toArrow()
    return _sorted(got[key].to_numpy(), got["bits"].to_numpy())


@dataclass(frozen=True)
class Estimates:
    """Tables of each order from 1: (gram, p, left), where ``left`` is what the gram's context leaves to lower orders."""

    levels: tuple[DataFrame, ...]
    codes: Codes
    parts: int

    def models(self, parts: int | None = None) -> Iterator[Model]:
        """Lower orders whole with one part of the highest after the other; they are collected one at a time."""
        parts = parts or self.parts
        *lower, top = self.levels
        whole = [(*_arrays(level.select("gram", "p")), *self._contexts(level)) for level in lower]
        contexts = self._contexts(top)
        for part in range(parts):
            dealt = top.where(F.col("gram") % DEAL % parts == part)
            yield Model(*zip(*whole, (*_arrays(dealt.select("gram", "p")), *contexts)), self.codes.bits, part, parts)

    def _contexts(self, level: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        return _arrays(level.groupBy(_context(self.codes).alias("context")).agg(F.first("left").alias("left")))


def _context(codes: Codes) -> Column:
    return F.shiftright("gram", codes.bits)


def _suffix(codes: Codes, order: int) -> Column:
    return F.col("gram").bitwiseAND(F.lit((1 << codes.bits * order) - 1))


def estimate(counts: DataFrame, order: int, codes: Codes) -> Estimates:
    """Interpolated modified Kneser-Ney from the counts (gram, n) of distinct n-grams.

    Below the highest order an n-gram counts the different codes that stand before it. A context has at most
    one n-gram for each code, so no group is large.
    """
    tables = [written(counts, "grams")]
    for k in range(order - 1, 0, -1):
        tables.append(written(tables[-1].groupBy(_suffix(codes, k).alias("gram")).agg(F.count(F.lit(1)).alias("n")), "grams"))
    levels: list[DataFrame] = []
    for k, table in enumerate(reversed(tables), 1):
        n = F.col("n")
        *ones_to_fours, size = table.agg(*[F.count_if(n == i) for i in range(1, 5)], F.count(n)).first()
        d = discounts(*ones_to_fours)
        inside = Window.partitionBy("context")
        total = F.sum("n").over(inside)
        left = sum(F.sum(F.when(n.between(low, high), 1).otherwise(0)).over(inside) * F.lit(x)
                   for x, low, high in zip(d, (1, 2, 3), (1, 2, 1 << 62)))
        taken = F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])
        level = table.withColumn("context", _context(codes)).select(
            "gram", ((n - taken) / total).alias("own"), (left / total).alias("left"))
        if levels:
            below = levels[-1].select(F.col("gram").alias("suffix"), F.col("p").alias("below"))
            level = level.withColumn("suffix", _suffix(codes, k - 1)).join(below, "suffix")
        else:
            level = level.withColumn("below", F.lit(1 / (1 << codes.bits)))
        level = level.select("gram", (F.col("own") + F.col("left") * F.col("below")).alias("p"), "left")
        levels.append(written(level, "estimates"))
    return Estimates(tuple(levels), codes, max(-(-size // PART), 1))


def count_grams(texts: DataFrame, order: int = ORDER, codes: Codes = FOLDED, held: int = HELD) -> DataFrame:
    """(gram, n): packed n-grams of all texts (first column) with their numbers.

    A task sums what it meets; it sends on what it has when ``held`` distinct n-grams are too many for it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: list[tuple[np.ndarray, np.ndarray]] = []
        for piece in _joined(text.as_py() or "" for batch in batches for text in batch.column(0)):
            sums.append(np.unique(piece, return_counts=True))
            if sum(len(found) for found, _ in sums) > held:
                sums = [_sum(sums)]
                if len(sums[0][0]) > held // 2:
                    yield from _sent(*sums.pop())
        if sums:
            yield from _sent(*_sum(sums))

    def _joined(texts: Iterator[str]) -> Iterator[np.ndarray]:
        waiting, size = [], 0
        for text in texts:
            for piece in grams(text, order, codes):
                waiting.append(piece)
                size += len(piece)
                if size >= PIECE:
                    yield np.concatenate(waiting)
                    waiting, size = [], 0
        if waiting:
            yield np.concatenate(waiting)

    return texts.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _sum(sums: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = (np.concatenate(side) for side in zip(*sums))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n[order], first)


def _sent(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(keys), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(x[at:at + (1 << 16)]) for x in (keys, n)], names=["gram", "n"])


def train(texts: DataFrame, order: int = ORDER, codes: Codes = FOLDED) -> Model:
    """The whole model of all texts of the first column, in the driver: for classes at most 64**order n-grams."""
    return next(trained(texts, order, codes).models(1))


def trained(texts: DataFrame, order: int = ORDER, codes: Codes = BYTES) -> Estimates:
    """The tables of the model of all texts of the first column; none of them is collected."""
    if not 1 <= order <= ORDER:
        raise ValueError(f"the order is 1 to {ORDER}, which bounds the lower orders")
    return estimate(count_grams(texts, order, codes), order, codes)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which the text holds twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    _, pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
    _, inside, times = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    if len(times) == len(inside):
        return 0
    again = times[inside] > 1
    covered = np.zeros(len(words), bool)
    for j in range(3):
        covered[j:len(words) - 2 + j] |= again
    return int(covered.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen, found = set(), 0
    for line in text.split("\n"):
        if line in seen:
            found += 1
        elif line.strip(BLANKS):
            seen.add(line)
    return found


def measure(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text."""
    words = text.encode().split()  # bytes split at the six ASCII blanks only
    chars = len(text) - sum(map(text.count, BLANKS))
    return len(words), chars, sum(map(text.count, SYMBOLS)), repeated_lines(text), repeated_words(words)


def score_rows(rows: DataFrame, estimates: Estimates) -> DataFrame:
    """Rows of (id, lang, text) as (id, lang, counts of ``measure``, bits per byte or null), one for one.

    With several parts the texts are numbered and written once, scanned for each part, and a row's sums added up.
    """
    context = rows.sparkSession.sparkContext
    if estimates.parts == 1:
        return _scan(rows, ["id", "lang"], COUNTS, context.broadcast(next(estimates.models())), estimates.codes)
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "texts")
    sums = []
    for model in estimates.models():
        sent = context.broadcast(model)
        sums.append(written(_scan(rows, ["row"], (), sent, estimates.codes), "perplexity-part"))
        sent.destroy()
    values = F.array_sort(F.collect_list("bits"))  # a text without bytes has none; in order they add up to the same
    bits = reduce(DataFrame.unionByName, sums).groupBy("row").agg(
        F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda x, y: x + y)).alias("bits"))
    return _scan(rows, ["row", "id", "lang"], COUNTS, None, estimates.codes).join(bits, "row").drop("row")


def _scan(rows: DataFrame, carried: list[str], names: Sequence[str], sent: Broadcast | None, codes: Codes) -> DataFrame:
    """Carried columns with the named counts of ``measure`` (all or none) and, where a model is sent, its bits per byte."""
    kinds = rows.schema
    fields = [*[f"{c} {kinds[c].dataType.simpleString()}" for c in carried], *[f"{n} long" for n in names]]
    fields += ["bits double"] if sent else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value if sent else None
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(len(carried))]
            columns = batch.columns[:-1]
            if names:
                counts = list(zip(*map(measure, texts))) if texts else [()] * len(names)
                columns += [pa.array(c, pa.int64()) for c in counts]
            if model:
                bits = []
                for text in texts:
                    size = len(text.encode())
                    bits.append(sum(map(model.total, grams(text, len(model.grams), codes))) / size if size else None)
                columns.append(pa.array(bits, pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in fields])

    return rows.select(*carried, "text").mapInArrow(run, ", ".join(fields))


def bands(scored: DataFrame, width: float = WIDTH, least: float = LEAST_SPREAD) -> DataFrame:
    """(lang, low, high) in bits per byte: median and ``width`` times the median distance from it.

    Exact on bins of a thousandth of a bit: what a language holds is a histogram, not its rows.
    """
    bins = scored.select("lang", F.round(F.col("bits") * BINS).cast("int").alias("bin")).groupBy("lang", "bin").agg(
        F.count(F.lit(1)).alias("n"))
    bins = written(bins, "perplexity-bins")
    middle = bins.groupBy("lang").agg(F.percentile("bin", F.lit(0.5), F.col("n")).alias("median"))
    far = bins.join(middle.withColumnRenamed("lang", "l"), F.col("lang").eqNullSafe(F.col("l")))
    spread = far.groupBy("lang", "median").agg(
        F.percentile(F.abs(F.col("bin") - F.col("median")), F.lit(0.5), F.col("n")).alias("spread"))
    reach = width * F.greatest(F.col("spread"), F.lit(least * BINS))
    return spread.select("lang", ((F.col("median") - reach) / BINS).alias("low"),
                         ((F.col("median") + reach) / BINS).alias("high"))


def quality_rules(df: DataFrame, order: int = ORDER, width: float = WIDTH, min_words: int = MIN_WORDS,
                  max_repeat_percent: int = MAX_REPEAT_PERCENT, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang", codes: Codes = BYTES) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, perplexity, low, high).

    One row out for each row in, whatever its id. Null texts are empty: no words, ``base_failed``, no
    perplexity. Rows without a language form a group of their own. ``perplexity`` is per byte; ``low`` and
    ``high`` bound it for the language (null for one of which no text passes the rules). A text whose bits
    are exactly on a bound is kept. Other columns are not read. ``codes`` is what n-grams are made of.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text"))
    scored = written(score_rows(rows, trained(rows.select("text"), order, codes)), "perplexity")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    limits = bands(scored.where(~failed), width).withColumnRenamed("lang", "l")
    joined = scored.withColumn("base_failed", failed).join(limits, F.col("lang").eqNullSafe(F.col("l")), "left")
    binned = F.round(F.col("bits") * BINS) / BINS
    return joined.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & binned.between(F.col("low"), F.col("high"))).alias("kept"),
        F.pow(F.lit(2.0), "bits").alias("perplexity"),
        F.pow(F.lit(2.0), "low").alias("low"), F.pow(F.lit(2.0), "high").alias("high"),
    )
