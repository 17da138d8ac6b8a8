"""Resampling and the gate against plain sequential definitions on random series."""

import random

import pytest
from pyspark.sql import functions as F

from labtables.operators.series import Grid, calibrate, calibrated, resample_files, resample_rows, to_points


def brute_force(samples, grid):
    """(values, gap, reason) straight from the definitions."""
    samples = sorted(samples)
    points = [grid.start + grid.step * k for k in range(grid.size)]
    if len(samples) < 2:
        return None, None, "too few samples"
    if samples[0][0] > points[0]:
        return None, None, "out of range"
    if samples[-1][0] < points[-1]:
        return None, None, "no right neighbour"
    values = []
    for g in points:
        left = [s for s in samples if s[0] < g]
        right = [s for s in samples if s[0] >= g]
        if not left:
            values.append(samples[0][1])
        else:
            (xl, yl), (xr, yr) = left[-1], right[0]
            values.append(yl + (yr - yl) / (xr - xl) * (g - xl))
    # a counter goes up at each grid point and down, not below zero, at each sample after the first
    gap = 0
    walk = [(p, 0) for p in points] + [(x, 1) for x, _ in samples[1:] if x < points[-1]]
    for _, is_sample in sorted(walk):
        gap = max(gap - 1, 0) if is_sample else gap + 1
    return values, gap, None


def random_series(seed):
    rng = random.Random(seed)
    n = rng.choice([0, 1, 2, 3, 8, 20, 40])
    xs = [rng.choice([rng.uniform(-8, 48), float(rng.randrange(-2, 12) * 4), rng.uniform(0, 12)]) for _ in range(n)]
    if rng.random() < 0.8:
        xs += [rng.choice([0.0, -1.0, -5.5]), rng.choice([40.0, 41.0, 77.7])]
    return [(x, float(rng.randrange(-3, 9))) for x in xs]


GRIDS = [Grid(0, 40, 4), Grid(0, 40, 3), Grid(0.5, 39.9, 0.7)]


@pytest.mark.parametrize("grid", GRIDS)
def test_both_forms_equal_the_definition(spark, grid):
    series = {k: random_series(k) for k in range(300)}
    expected = {k: brute_force(s, grid) for k, s in series.items()}
    assert sum(e[2] is None for e in expected.values()) > 100
    rows = spark.createDataFrame([(k, x, y) for k, s in series.items() for x, y in s], "k int, x double, y double")
    by_rows = {r["k"]: r for r in resample_rows(rows, ["k"], "x", "y", grid).collect()}
    arrays = spark.createDataFrame([(k, sorted(s)) for k, s in series.items()], "k int, samples array<struct<x:double,y:double>>")
    by_file = {r["k"]: r for r in resample_files(arrays, grid, None).collect()}
    for k, (values, gap, reason) in expected.items():
        results = [by_file[k]] + ([by_rows[k]] if series[k] else [])
        for r in results:
            assert (r["reason"], r["gap"]) == (reason, gap), k
            assert (r["vec"] is None) == (values is None)
            if values is not None:
                assert r["vec"] == pytest.approx(values)


def test_gate_limit(spark):
    grid = Grid(0, 40, 4)
    rows = spark.createDataFrame([(0, 0.0, 1.0), (0, 50.0, 2.0)], "k int, x double, y double")
    assert resample_rows(rows, ["k"], "x", "y", grid, 11).first()["reason"] is None
    low = resample_rows(rows, ["k"], "x", "y", grid, 10).first()
    assert (low["reason"], low["gap"], low["vec"]) == ("resolution too low", 11, None)


def test_sparse_start_dense_end_passes(spark):
    grid = Grid(0, 400, 4)
    dense = [(300.0 + i / 2, 1.0) for i in range(250)]
    rows = spark.createDataFrame([(0, x, y) for x, y in [(0.0, 0.0), *dense]], "k int, x double, y double")
    assert resample_rows(rows, ["k"], "x", "y", grid, 50).first()["reason"] is None


def test_points_back(spark):
    grid = Grid(0, 8, 4)
    rows = spark.createDataFrame([("a", 0.0, 0.0), ("a", 8.0, 8.0), ("b", 3.0, 0.0)], "k string, x double, y double")
    points = to_points(resample_rows(rows, ["k"], "x", "y", grid), ["k"], grid).collect()
    assert sorted(map(tuple, points)) == [("a", 0.0, 0.0), ("a", 4.0, 4.0), ("a", 8.0, 8.0)]


def test_samples_of_a_file_are_not_paired_one_by_one(spark):
    """No lambda makes a row for each sample, and the grid is a constant of the plan."""
    files = spark.createDataFrame(
        [], "file string, FIRSTX string, LASTX string, NPOINTS string, YFACTOR string, XUNITS string, YUNITS string, "
            "data array<struct<x:double,ys:array<double>>>, reason string")
    plan = resample_files(calibrate(files), Grid(0, 40, 4))._jdf.queryExecution().optimizedPlan().toString()
    assert "arrays_zip" in plan and "lambdafunction(struct(" not in plan and "sequence(" not in plan


def test_ends_and_equal_samples_of_a_file(spark):
    inf, nan = float("inf"), float("nan")
    series = [
        [(0.0, 1.0), (0.0, 5.0), (4.0, 2.0), (8.0, 3.0)], [(-0.0, 1.0), (4.0, 2.0), (4.0, 7.0), (9.0, 3.0)],
        [(-inf, 1.0), (2.0, 2.0), (inf, 3.0)], [(0.0, 1.0), (1.0, 2.0), (nan, 3.0)], [(0.0, 1.0)], [], None,
    ]
    rows = spark.createDataFrame(list(enumerate(series)), "k int, samples array<struct<x:double,y:double>>")
    got = [r for r in resample_files(rows, Grid(0, 8, 4), 1).orderBy("k").collect()]
    assert [r["reason"] for r in got] == [None, None, "resolution too low", "resolution too low", *["too few samples"] * 2, "resolution too low"]
    assert got[0]["vec"] == [1.0, 2.0, 3.0] and got[1]["vec"] == [1.0, 2.0, pytest.approx(7 - 4 * 4 / 5)]
    assert [r["gap"] for r in got] == [1, 1, 2, 2, None, None, 3]


def test_cells_of_the_default_grid(spark):
    grid = Grid()
    assert grid.size == 759 and grid.last() == 3702
    xs = [float(x) for p in (670, 674, 3698, 3702) for x in (p - 1e-9, p, p + 1e-9)] + [float("inf"), -float("inf")]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = {r["x"]: r["c"] for r in df.select("x", grid.settle(F.col("x"), grid.guess(F.col("x"))).alias("c")).collect()}
    assert got == {x: sum(p <= x for p in range(670, 3703, 4)) for x in xs}


@pytest.mark.parametrize("micro, absorb, expected", [
    (False, False, (11.0, 0.75)), (True, False, (10000 / 11, 0.75)), (False, True, (11.0, 1 - 10**-0.25)),
])
def test_calibration(spark, micro, absorb, expected):
    x, y = calibrated(F.lit(10.0), F.lit(2), F.lit(0.5), F.lit(0.5), F.lit(0.5), F.lit(micro), F.lit(absorb))
    assert tuple(spark.range(1).select(x, y).first()) == pytest.approx(expected)
