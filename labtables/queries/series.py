"""Series on a regular grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from labtables.operators.quality import count_reasons
from labtables.operators.series import Grid, calibrated, resample_rows, to_points
from labtables.plans.tables import measured, measured_series
from labtables.queries.base import query, spread, table, text_files
from labtables.sources.records import LABELLED_END, labelled_records

PRICE_GRID = Grid(5000, 85000, 500)
PRICE_GAP = 2
FILE_GRID = Grid(1000, 1400, 4)
FILE_GAP = 50


def resample_sql(grid: Grid, max_gap: int | None = None) -> str:
    """CTEs over pts(k, x, y): sample-level windows for neighbours (w) and the walk (final), and the
    verdict per series (v)."""
    low, high = f"{grid.start}::DOUBLE", f"{grid.last()}::DOUBLE"
    gap = "false" if max_gap is None else f"gap > {max_gap}"
    return f"""
stat AS (SELECT k, count(*) AS n, min(x) AS x0, max(x) AS x1 FROM pts GROUP BY k),
grid AS (SELECT {low} + {grid.step} * i AS x FROM generate_series(0, {grid.size - 1}) AS g(i)),
u AS (SELECT k, x, y, 1 AS kind FROM pts UNION ALL
  SELECT k, grid.x, NULL, 0 FROM stat, grid),
w AS (SELECT k, x, kind,
  last_value(CASE WHEN kind = 1 THEN x END IGNORE NULLS) OVER before AS xl,
  last_value(CASE WHEN kind = 1 THEN y END IGNORE NULLS) OVER before AS yl,
  first_value(CASE WHEN kind = 1 THEN x END IGNORE NULLS) OVER after AS xr,
  first_value(CASE WHEN kind = 1 THEN y END IGNORE NULLS) OVER after AS yr
  FROM u WINDOW
  before AS (PARTITION BY k ORDER BY x, kind, y ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  after AS (PARTITION BY k ORDER BY x, kind, y ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
ranked AS (SELECT k, x, y, row_number() OVER (PARTITION BY k ORDER BY x, y) AS rn FROM pts),
steps AS (SELECT k, x, 0 AS kind, NULL AS y, 1 AS s FROM stat, grid UNION ALL
  SELECT k, x, 1, y, -1 FROM ranked WHERE rn > 1 AND x < {high}),
walk AS (SELECT k, sum(s) OVER (PARTITION BY k ORDER BY x, kind, y
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run,
  sum(s) OVER (PARTITION BY k) AS total FROM steps),
final AS (SELECT k, CAST(max(total) - least(0, min(run)) AS INTEGER) AS gap FROM walk GROUP BY k),
v AS (SELECT stat.k, gap, CASE WHEN n < 2 THEN 'too few samples' WHEN x0 > {low} THEN 'out of range'
  WHEN x1 < {high} THEN 'no right neighbour' WHEN {gap} THEN 'resolution too low' END AS reason
  FROM stat JOIN final USING (k)),
r AS (SELECT w.k, w.x, CASE WHEN xl IS NULL THEN yr ELSE yl + (yr - yl) / (xr - xl) * (w.x - xl) END AS y
  FROM w JOIN v ON w.k = v.k WHERE kind = 0 AND reason IS NULL)
"""


PRICE_PTS = "WITH pts AS (SELECT l_suppkey AS k, l_extendedprice AS x, l_quantity AS y FROM lineitem),"


def price_series(spark, d, max_gap=None):
    samples = table(spark, d, "lineitem").select("l_suppkey", "l_extendedprice", "l_quantity")
    return resample_rows(
        samples, ["l_suppkey"], "l_extendedprice", "l_quantity", PRICE_GRID, max_gap
    )


@query("calibrate_points", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  round(CASE WHEN l_linestatus = 'F' THEN 10000.0::DOUBLE / px ELSE px END, 6) AS x,
  round(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE - pow(10.0::DOUBLE, -py) ELSE 1.0::DOUBLE - py END, 6) AS y
FROM (SELECT *, l_quantity + 0.25::DOUBLE * l_linenumber AS px, l_tax * (l_discount + 0.5::DOUBLE) AS py
  FROM lineitem)
""")
def calibrate_points(spark, d):
    x, y = calibrated(
        F.col("l_quantity"), F.col("l_linenumber"), F.col("l_tax"), F.lit(0.25), F.col("l_discount") + F.lit(0.5),
        F.col("l_linestatus") == "F", F.col("l_returnflag") == "R",
    )
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.round(x, 6).alias("x"), F.round(y, 6).alias("y")
    )


@query("resample_linear", PRICE_PTS + resample_sql(PRICE_GRID) + """
SELECT k AS l_suppkey, x, round(y, 4) AS y FROM r
""")
def resample_linear(spark, d):
    points = to_points(price_series(spark, d), ["l_suppkey"], PRICE_GRID)
    return points.withColumn("y", F.round("y", 4))


@query("resolution_gate", PRICE_PTS + resample_sql(PRICE_GRID, PRICE_GAP) + """
SELECT k AS l_suppkey, CASE WHEN reason IS NULL OR reason = 'resolution too low' THEN gap END AS gap, reason FROM v
""")
def resolution_gate(spark, d):
    return price_series(spark, d, PRICE_GAP).select("l_suppkey", "gap", "reason")


def vector_text(vec, factor):
    return F.array_join(F.transform(vec, lambda y: F.round(y * factor).cast("bigint").cast("string")), ",")


@query("series_vector", PRICE_PTS + resample_sql(PRICE_GRID) + """
SELECT k AS l_suppkey, string_agg(CAST(CAST(round(y * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY x) AS vec
FROM r GROUP BY k
""")
def series_vector(spark, d):
    good = price_series(spark, d).where(F.col("reason").isNull())
    return good.select("l_suppkey", vector_text("vec", 100).alias("vec"))


def series_text(spark, d):
    """One labelled record of 250 samples per customer.

    The first x depends on the nation (some start above the grid), the step on the segment (some are
    too coarse), the units and the state on other columns. Negative numbers are glued to the last.
    """
    dx = F.when(F.col("c_mktsegment") == "MACHINERY", 10).otherwise(2)
    first = F.lit(980) + F.col("c_nationkey")
    sample = lambda i: F.pmod(F.col("c_custkey") * 7 + i * 13, F.lit(1000)) - 300

    def line(n):
        ys = F.transform(F.sequence(n * 10, n * 10 + 9), lambda i: F.when(
            sample(i) < 0, sample(i).cast("string")
        ).otherwise(F.concat(F.lit(" "), sample(i).cast("string"))))
        return F.concat((first + dx * 10 * n).cast("string"), F.array_join(ys, ""))

    block = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(24)), line), "\n")
    content = F.concat(
        F.lit("\n##TITLE="), F.col("c_custkey").cast("string"), F.lit("-"), F.col("c_nationkey").cast("string"),
        F.lit(".jdx\n##STATE="),
        F.when(F.col("c_acctbal") < 0, "vapor").otherwise("GAS (100 mmHg)"),
        F.lit("\n##NPOINTS=250\n##FIRSTX="), first.cast("string"),
        F.lit("\n##LASTX="), (first + dx * 249).cast("string"), F.lit("\n##XUNITS=1/CM\n##YUNITS="),
        F.when(F.col("c_mktsegment") == "BUILDING", "ABSORBANCE").otherwise("TRANSMITTANCE"),
        F.lit("\n"), F.when(F.col("c_mktsegment") == "FURNITURE", "").otherwise("##YFACTOR=0.001\n"),
        F.lit("##XYDATA=(X++(Y..Y))\n"), block,
    )
    return spread(table(spark, d, "customer")).select(content.alias("value"))


def series_files(spark, d):
    return labelled_records(spark, text_files(spark, d, "series", series_text, LABELLED_END))


FILE_PTS = """
WITH s AS (SELECT c_custkey AS k, c_mktsegment, (980 + c_nationkey)::DOUBLE AS first,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 10 ELSE 2 END AS dx, i,
    ((c_custkey * 7 + i * 13) % 1000 - 300)::DOUBLE * 0.001::DOUBLE AS py
  FROM customer, generate_series(0, 249) AS g(i) WHERE c_mktsegment <> 'FURNITURE'),
pts AS (SELECT k, first + dx * i AS x,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0::DOUBLE - pow(10.0::DOUBLE, -py) ELSE 1.0::DOUBLE - py END AS y FROM s),
"""


@query("spectra_table", FILE_PTS + resample_sql(FILE_GRID, FILE_GAP) + """
, vec AS (SELECT k, string_agg(CAST(CAST(round(y * 10000) AS BIGINT) AS VARCHAR), ',' ORDER BY x) AS vec
  FROM r GROUP BY k)
SELECT CAST(k AS VARCHAR) AS mid, c_nationkey AS index, vec,
  CASE WHEN c_acctbal < 0 THEN 'others' ELSE 'gas' END AS state,
  CASE WHEN c_acctbal < 0 THEN 'vapor' ELSE '(100 mmHg)' END AS state_info
FROM vec JOIN customer ON k = c_custkey WHERE k IN (SELECT o_custkey FROM orders)
""")
def spectra_table(spark, d):
    mapping = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("mid"))
    spectra = measured(measured_series(series_files(spark, d), FILE_GRID, FILE_GAP), mapping)
    return spectra.withColumn("vec", vector_text("vec", 10000))


@query("spectra_rejects", FILE_PTS + resample_sql(FILE_GRID, FILE_GAP) + """
, m AS (SELECT 'missing header' AS reason FROM customer WHERE c_mktsegment = 'FURNITURE')
SELECT coalesce(reason, 'ok') AS reason, count(*) AS n FROM (SELECT reason FROM v UNION ALL SELECT * FROM m) GROUP BY 1
""")
def spectra_rejects(spark, d):
    series = measured_series(series_files(spark, d), FILE_GRID, FILE_GAP)
    return count_reasons(series.withColumn("reason", F.coalesce("reason", F.lit("ok"))))
