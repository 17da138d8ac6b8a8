"""Text expressions; all are plain Columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from labtables.schemas import STATES

BLANKS = "".join(chr(i) for i in range(0x21))
INLINE_BLANK = r"[\x00-\x09\x0B-\x20]"


def strip(c: Column) -> Column:
    """Cut every control or blank character at both ends (SQL ``trim`` cuts spaces only)."""
    return F.btrim(c, F.lit(BLANKS))


def unix_lines(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("\r")), F.regexp_replace(c, r"\r\n?", "\n")).otherwise(c)


def tokens(c: Column) -> Column:
    """Whitespace tokens of a line; blanks at the ends give no empty token, an empty line none."""
    return F.filter(F.split(c, r"\s+"), lambda t: t != "")


def strip_comment(c: Column, mark: str = "//") -> Column:
    return strip(F.split_part(c, F.lit(mark), F.lit(1)))


def file_key(name: Column) -> tuple[Column, Column]:
    """``<id>-<index>.<suffix>`` as (id, index); the index is null where it is no number."""
    parts = F.split(F.split_part(name, F.lit("."), F.lit(1)), "-")
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1)).try_cast("int")


def file_stem(name: Column) -> Column:
    return F.split_part(name, F.lit("."), F.lit(1))


def leading_word(text: Column, allowed: Sequence[str] = STATES) -> tuple[Column, Column]:
    """(word, rest) when the lower-cased leading word is allowed, else ("others", whole text)."""
    word = F.lower(F.regexp_extract(text, r"^(\w*)(.*)", 1))
    rest = strip(F.regexp_extract(text, r"^(\w*)(.*)", 2))
    known = word.isin(*allowed)
    return F.when(known, word).otherwise("others"), F.when(known, rest).otherwise(text)


def between(c: Column, start: str, end: str) -> Column:
    """Text after the first ``start`` up to the next ``end``; null where ``start`` is absent."""
    after = F.substring(c, F.instr(c, start) + F.lit(len(start)), F.length(c))
    return F.when(F.contains(c, F.lit(start)), F.substring_index(after, end, 1))
