"""The registry from raw files to the last table, with what follows from a changed file built anew."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from labtables.config import shared_dir
from labtables.operators.series import Grid
from labtables.plans.registry import Registry
from labtables.plans.tables import Inputs, tables
from labtables.queries.base import ORACLES, query, table, text_files
from labtables.queries.series import FILE_GAP, FILE_GRID, series_text
from labtables.sources.records import LABELLED_END
from labtables.sources.tagged import RECORD_END

GRID = Grid(0, 40, 10)


def mass_of(names: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"mass": names.str.len() + 0.0, "long": names.str.len() > 18}, index=names.index)


def raw_files(spark, d):
    """Suppliers as structures, their nation's customers as spectra, orders as properties, names as sources."""
    path = shared_dir(spark, "raw")
    text = lambda c: F.col(c).cast("string")
    supplier, customer, orders = (table(spark, d, n) for n in ("supplier", "customer", "orders"))
    name = F.replace("s_name", F.lit(" "), F.lit("_"))
    supplier.select(F.concat(name, F.lit(" "), text("s_suppkey")).alias("value")).write.text(f"{path}/structures")
    supplier.where("s_suppkey % 2 = 0").select(F.concat(
        F.lit("Removed a"), text("s_suppkey"), F.lit(" - a duplicate of "), text("s_suppkey"), F.lit(" (#1)")
    ).alias("value")).write.text(f"{path}/aliases")
    record = F.concat(
        F.lit("\n##TITLE="), text("c_custkey"), F.lit("-0.jdx\n##STATE="),
        F.when(F.col("c_acctbal") > 0, "gas").otherwise("solid"),
        F.lit("\n##FIRSTX=0\n##LASTX=40\n##NPOINTS=5\n##YFACTOR=1\n##XUNITS=1/CM\n##YUNITS=T\n##XYDATA=(X++(Y..Y))\n0"),
        *[F.concat(F.lit(" "), F.pmod(F.col("c_custkey") * i, F.lit(7)).cast("string")) for i in range(1, 6)],
    )
    customer.select(record.alias("value")).write.option("lineSep", LABELLED_END).text(f"{path}/series")
    molecule = F.concat(
        F.lit("\n"), text("o_custkey"), F.lit(".sdf\n> <METHOD>\n"), text("o_orderkey"),
        F.lit("\n\n> <IR.FREQUENCIES>\nf i\n1 2\n\n"),
    )
    orders.select(molecule.alias("value")).write.option("lineSep", RECORD_END).text(f"{path}/properties")
    supplier.where("s_suppkey % 3 = 0").select(F.concat(name, F.lit(" x")).alias("value")).write.text(f"{path}/universe")
    return path


# A structure has more than one source from its two external files on; each file is a source of its own.
USAGE_SQL = """
WITH map AS (SELECT s_suppkey AS k, CAST(s_suppkey AS VARCHAR) AS mid FROM supplier
  UNION ALL SELECT s_suppkey, 'a' || s_suppkey FROM supplier WHERE s_suppkey % 2 = 0),
spectra AS (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS mid, c_acctbal > 0 AS gas FROM customer),
u AS (SELECT CASE WHEN NOT gas THEN 'unused' WHEN c_custkey % 3 = 0 OR c_custkey % 5 = 0 THEN 'overall' ELSE 'limited' END AS level,
  count(*) AS n FROM spectra JOIN map USING (mid) GROUP BY 1)
"""


@query("registry_rebuild", USAGE_SQL + """
SELECT 'structure_map' AS name, false AS rebuilt, (SELECT count(*) FROM map) AS n
UNION ALL SELECT 'parsed_series', false, (SELECT count(*) FROM customer)
UNION ALL SELECT 'parsed_properties', false, (SELECT count(*) FROM orders)
UNION ALL SELECT 'measured', false, (SELECT count(*) FROM spectra JOIN map USING (mid))
UNION ALL SELECT 'computed', false, (SELECT count(*) FROM orders WHERE o_custkey IN (SELECT s_suppkey FROM supplier))
UNION ALL SELECT 'universe', true, (SELECT count(*) FROM supplier)
UNION ALL SELECT 'usage ' || level, true, n FROM u
""")
def registry_rebuild(spark, d):
    """All tables from raw files; then one more file of external structures arrives, and a build writes the
    universe and the usage anew and nothing else. Rows of each table, of usage by level."""
    path = raw_files(spark, d)
    out = shared_dir(spark, "tables")
    inputs = Inputs(
        f"{path}/structures", f"{path}/aliases", f"{path}/series", f"{path}/properties", F.lit(True), mass_of,
        f"{path}/universe", "own", ("long",), GRID, many_records=True,
    )
    registry = Registry(spark, f"{out}/small", f"{out}/large").add(*tables(inputs))
    registry.build()
    before = {n: registry.record(n)["stamp"] for n in registry.defs}
    more = F.concat(F.replace("s_name", F.lit(" "), F.lit("_")), F.lit(" y"))
    table(spark, d, "supplier").where("s_suppkey % 5 = 0").select(more.alias("value")).write.mode("append").text(f"{path}/universe")
    stale = registry.stale()
    built = registry.build()
    rows = []
    for name in registry.defs:
        rebuilt = registry.record(name)["stamp"] != before[name]
        if rebuilt != (name in stale):
            raise AssertionError(f"{name} was announced as {'stale' if name in stale else 'fresh'}")
        key = F.concat(F.lit("usage "), "level") if name == "usage" else F.lit(name)
        rows.append(built[name].groupBy(key.alias("name")).agg(F.count(F.lit(1)).alias("n"))
                    .select("name", F.lit(rebuilt).alias("rebuilt"), "n"))
    result = rows[0]
    for other in rows[1:]:
        result = result.unionByName(other)
    return result


@query("observed_reasons", ORACLES["spectra_rejects"])
def observed_reasons(spark, d):
    """Reasons of rejected spectra as they were counted while the parsed table was written."""
    raw, out = text_files(spark, d, "series", series_text, LABELLED_END), shared_dir(spark, "tables")
    inputs = Inputs(raw, raw, raw, raw, F.lit(True), mass_of, grid=FILE_GRID, max_gap=FILE_GAP, many_records=True)
    registry = Registry(spark, out, out).add(*[t for t in tables(inputs) if t.name == "parsed_series"])
    registry.build()
    counted = registry.metrics("parsed_series")
    if counted.pop("rows") != sum(counted.values()):
        raise AssertionError(f"a reason is not counted: {counted}")
    return spark.createDataFrame([(r, n) for r, n in counted.items() if n], "reason string, n long")
