"""Seeded hash expressions: the same value always gets the same number, on any engine."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = 1 << 32


def hash32(key: Column, seed: int | str) -> Column:
    """First 32 bits of md5("<seed>:<key>") as a bigint."""
    text = F.concat(F.lit(f"{seed}:"), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def cutoffs(weights: Sequence[float]) -> list[int]:
    """Upper ends of the hash ranges that belong to the weights; the last one is open."""
    exact = [Fraction(str(w)) for w in weights]
    if not exact or min(exact) < 0 or sum(exact) == 0:
        raise ValueError("weights must be non-negative and not all zero")
    total, run, ends = sum(exact), Fraction(0), []
    for w in exact[:-1]:
        run += w
        ends.append(int(run * SPAN / total))
    return ends


def choose(h: Column, weights: Sequence[float], labels: Sequence) -> Column:
    """The label whose share of the 32-bit range holds ``h``."""
    if len(weights) != len(labels):
        raise ValueError("one label per weight")
    out = F.lit(labels[-1])
    for end, label in reversed(list(zip(cutoffs(weights), labels))):
        out = F.when(h < F.lit(end), F.lit(label)).otherwise(out)
    return out
