"""Calibration of measured series, resampling to a regular grid and the resolution gate.

A sample belongs to grid cell ``c`` = number of grid points at or below its x. Grid point k has its
left neighbour in the last filled cell at or under k and its right neighbour in the next filled one,
so two samples per filled cell are all that interpolation needs, and a count per cell is all the
gate needs. Series stored as rows are therefore first reduced per (series, cell), which splits a hot
series over all cells and leaves at most grid-size + 1 rows per series. Series that lie in one row
(one file) are resampled in that row without any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtables.functions.plans import add_once
from labtables.schemas import GRID_MAX, GRID_MIN, GRID_STEP, MAX_GAP

# The units that are converted.
MICROMETERS, ABSORBANCE = "MICROMETERS", "ABSORBANCE"

TOO_FEW = "too few samples"
OUT_OF_RANGE = "out of range"
NO_RIGHT = "no right neighbour"
LOW_RESOLUTION = "resolution too low"
BAD_HEADER = "missing or bad header"
BAD_SAMPLE = "bad sample"


@dataclass(frozen=True)
class Grid:
    """Grid points start, start + step, … up to stop (included)."""

    start: float = GRID_MIN
    stop: float = GRID_MAX
    step: float = GRID_STEP

    @property
    def size(self) -> int:
        return int((self.stop - self.start) // self.step) + 1

    def point(self, k: Column) -> Column:
        return F.lit(float(self.start)) + F.lit(float(self.step)) * k

    def last(self) -> float:
        return float(self.start) + float(self.step) * (self.size - 1)

    def points(self) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(self.size - 1)), lambda k: self.point(k))

    def guess(self, x: Column) -> Column:
        """Number of grid points <= x up to the rounding of a division."""
        # the ends first: an infinite x must not reach the floor
        return (
            F.when(x < F.lit(float(self.start)), F.lit(0))
            .when(x >= F.lit(self.last()), F.lit(self.size))
            .otherwise(F.floor((x - F.lit(float(self.start))) / F.lit(float(self.step))).cast("int") + 1)
        )

    def settle(self, x: Column, guess: Column) -> Column:
        """The exact number of grid points <= x from a guess one off at most."""
        return (
            F.when((guess > 0) & (x < self.point(guess - 1)), guess - 1)
            .when((guess < self.size) & (x >= self.point(guess)), guess + 1)
            .otherwise(guess)
        )


def calibrated(x0: Column, j: Column, y: Column, dx: Column, yfactor: Column,
               wavelength: Column, absorbance: Column) -> tuple[Column, Column]:
    """Physical (x, y) of sample j of a data line; the flags tell the units of x and y."""
    x = x0 + dx * j
    inverse = F.coalesce(F.try_divide(F.lit(10000.0), x), F.lit(float("inf")))
    scaled = y * yfactor
    return (
        F.when(wavelength, inverse).otherwise(x),
        F.when(absorbance, F.lit(1.0) - F.pow(F.lit(10.0), -scaled))
        .otherwise(F.lit(1.0) - scaled),
    )


def calibrate(records: DataFrame) -> DataFrame:
    """Add ``samples`` = sorted array of calibrated (x, y), or a reject ``reason``.

    Input is the labelled-record scan: text columns FIRSTX … YUNITS and ``data`` (x, ys per line).
    """
    numbers = {n: F.col(n).try_cast("double") for n in ("FIRSTX", "LASTX", "NPOINTS", "YFACTOR")}
    dx = F.try_divide(numbers["LASTX"] - numbers["FIRSTX"], numbers["NPOINTS"] - 1)
    bad = numbers["YFACTOR"].isNull() | dx.isNull() | F.col("XUNITS").isNull() | F.col("YUNITS").isNull()

    def xs(wavelength: bool) -> Column:
        def line(d: Column) -> Column:
            return F.transform(d["ys"], lambda y, j: calibrated(
                d["x"], j, y, F.col("dx"), F.col("yf"), F.lit(wavelength), F.lit(False))[0])

        return F.flatten(F.transform("data", line))

    def ys(absorbance: bool) -> Column:
        return F.transform(F.flatten(F.col("data")["ys"]), lambda y: calibrated(
            F.lit(0.0), F.lit(0), y, F.col("dx"), F.col("yf"), F.lit(False), F.lit(absorbance))[1])

    checked = add_once(records, reason=F.coalesce(F.col("reason"), F.when(bad, BAD_HEADER)))
    good = F.col("reason").isNull()
    # the units hold for a file, so they are asked once and not for each sample; arrays of numbers are
    # paired by the engine, while a lambda would make each pair by itself
    return (
        checked.withColumns({"dx": dx, "yf": numbers["YFACTOR"]})
        .withColumns({
            "x": F.when(good, F.when(F.col("XUNITS") == MICROMETERS, xs(True)).otherwise(xs(False))),
            "y": F.when(good, F.when(F.col("YUNITS") == ABSORBANCE, ys(True)).otherwise(ys(False))),
        })
        .withColumn("samples", F.sort_array(F.arrays_zip("x", "y")))
        .drop("dx", "yf", "x", "y")
    )


def _interpolated(neighbours: Column, grid: Grid) -> Column:
    """Grid values from samples (cell, x, y) sorted by (x, y): each step to a later cell fills the
    grid points in between. A first sample right on the first grid point supplies that value."""
    n = grid.size

    def segment(a: Column, b: Column) -> Column:
        end = F.least(b["cell"], F.lit(n)) - 1
        slope = (b["y"] - a["y"]) / (b["x"] - a["x"])
        fill = F.transform(
            F.sequence(a["cell"], end), lambda k: a["y"] + slope * (grid.point(k) - a["x"])
        )
        return F.when(end >= a["cell"], fill).otherwise(F.array().cast("array<double>"))

    count = F.size(neighbours)
    steps = F.flatten(F.zip_with(
        F.slice(neighbours, 1, count - 1), F.slice(neighbours, 2, count - 1), segment
    ))
    first = F.get(neighbours, F.lit(0))
    hit = first["x"] == F.lit(float(grid.start))
    return F.when(hit, F.concat(F.array(first["y"]), steps)).otherwise(steps)


def _range_reason(count: Column, first_x: Column, last_x: Column, grid: Grid) -> Column:
    return (
        F.when(count < 2, TOO_FEW)
        .when(first_x > F.lit(float(grid.start)), OUT_OF_RANGE)
        .when(last_x < F.lit(grid.last()), NO_RIGHT)
    )


def _finish(df: DataFrame, grid: Grid, max_gap: int | None, first_x: Column, last_x: Column,
            values: Column) -> DataFrame:
    """Vector and reason from ``samples_n``, ``gap`` and the ends of a series; ``values`` are those on the grid."""
    out = F.coalesce(F.col("reason"), _range_reason(F.col("samples_n"), first_x, last_x, grid))
    low = F.lit(False) if max_gap is None else F.col("gap") > F.lit(max_gap)
    df = add_once(
        df,
        gap=F.when(out.isNull(), F.col("gap")).cast("int"),
        reason=F.coalesce(out, F.when(low, LOW_RESOLUTION)),
    )
    return df.withColumn("vec", F.when(F.col("reason").isNull(), values)).drop("samples_n")


def _below(x: Column, grid: Grid) -> Column:
    """For each grid point the number of sorted ``x`` that are smaller.

    Grid points and samples are sorted together, a point before its equals: point k at place i has i - k
    samples before it. Sorting two sorted runs is one merge, and costs no expression per sample and point.
    """
    # constant, so that the marks are made once and not for each series
    points = F.split(F.lit(",".join(repr(float(grid.start) + float(grid.step) * k) for k in range(grid.size))), ",")
    marks = F.arrays_zip(points.cast("array<double>").alias("x"), F.array_repeat(F.lit(False), grid.size).alias("sample"))
    samples = F.arrays_zip(x.alias("x"), F.array_repeat(F.lit(True), F.size(x)).alias("sample"))
    merged = F.sort_array(F.concat(marks, samples))
    places = F.transform(merged["sample"], lambda sample, i: F.when(sample, F.lit(-1)).otherwise(i))
    return F.transform(F.array_remove(places, -1), lambda i, k: i - k)


def resample_files(df: DataFrame, grid: Grid = Grid(), max_gap: int | None = MAX_GAP) -> DataFrame:
    """Resample the sorted array column ``samples`` of each row; adds ``vec``, ``gap``, ``reason``.

    Runs inside the scan stage: a file is one row from reading to vector.
    """
    n = grid.size
    # sample i (from 0, the first is not counted) in cell c stands for i consumed samples; cell c ends
    # before grid point c
    lead = F.transform("below", lambda b, k: b - 1 - k)
    consumed = F.get("below", F.lit(n - 1)) - 1
    gap = F.lit(n) - F.greatest(consumed, F.lit(0)) + F.greatest(F.array_max(lead), F.lit(0))

    def value(b: Column, k: Column) -> Column:
        """A point between samples b - 1 and b; the first point may be the first sample itself."""
        xa, xb, ya, yb = (F.get(c, at) for c in ("xs", "ys") for at in (b - 1, b))
        return F.when(b > 0, ya + (yb - ya) / (xb - xa) * (grid.point(k) - xa)).otherwise(yb)

    df = df.withColumns({"xs": F.col("samples")["x"], "ys": F.col("samples")["y"]})
    if "reason" not in df.columns:
        df = df.withColumn("reason", F.lit(None).cast("string"))
    df = df.withColumns({"below": _below(F.col("xs"), grid), "samples_n": F.size("samples")}).withColumn("gap", gap)
    ends = F.get("xs", F.lit(0)), F.element_at("xs", -1)
    return _finish(df.drop("samples"), grid, max_gap, *ends, F.transform("below", value)).drop("xs", "ys", "below")


def cells(points: DataFrame, keys: Sequence[str], x: str, y: str, grid: Grid) -> DataFrame:
    """Lowest and highest sample and sample count per (series, grid cell), combined before the shuffle."""
    sample = F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    return (
        points.select(*keys, sample.alias("s"))
        .withColumn("guess", grid.guess(F.col("s.x")))
        .withColumn("cell", grid.settle(F.col("s.x"), F.col("guess")))
        .groupBy(*keys, "cell")
        .agg(F.min("s").alias("lo"), F.max("s").alias("hi"), F.count(F.lit(1)).alias("n"))
    )


def resample_rows(points: DataFrame, keys: Sequence[str], x: str, y: str,
                  grid: Grid = Grid(), max_gap: int | None = None) -> DataFrame:
    """Resample series stored one sample per row: (keys, vec, gap, reason), one row per series."""
    n = grid.size
    per_cell = cells(points, keys, x, y, grid)
    # at most grid size + 1 entries per series
    series = per_cell.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("cell", "lo", "hi", "n"))).alias("cells")
    )
    both_ends = F.flatten(F.transform("cells", lambda c: F.array(
        F.struct(c["cell"].alias("cell"), c["lo"]["x"].alias("x"), c["lo"]["y"].alias("y")),
        F.struct(c["cell"].alias("cell"), c["hi"]["x"].alias("x"), c["hi"]["y"].alias("y")),
    )))
    walk = F.aggregate(
        "cells",
        # the first sample is not consumed; cells at the upper end neither
        F.struct(F.lit(-1).cast("bigint").alias("used"), F.lit(0).cast("bigint").alias("lead")),
        lambda s, c: F.when(c["cell"] < n, F.struct(
            (s["used"] + c["n"]).alias("used"),
            F.greatest(s["lead"], s["used"] + c["n"] - c["cell"]).alias("lead"),
        )).otherwise(s),
        lambda s: F.lit(n) - F.greatest(s["used"], F.lit(0)) + s["lead"],
    )
    total = F.aggregate("cells", F.lit(0).cast("bigint"), lambda s, c: s + c["n"])
    df = series.select(
        *keys,
        both_ends.alias("neighbours"),
        total.alias("samples_n"),
        walk.alias("gap"),
        F.lit(None).cast("string").alias("reason"),
    )
    first, last = F.get("neighbours", F.lit(0)), F.element_at("neighbours", -1)
    values = _interpolated(F.col("neighbours"), grid)
    return _finish(df, grid, max_gap, first["x"], last["x"], values).drop("neighbours")


def to_points(df: DataFrame, keys: Sequence[str], grid: Grid) -> DataFrame:
    """Vectors back as rows (keys, x, y) along the grid."""
    return (
        df.where(F.col("vec").isNotNull())
        .select(*keys, F.posexplode("vec").alias("grid_index", "y"))
        .select(*keys, grid.point(F.col("grid_index")).alias("x"), "y")
    )
