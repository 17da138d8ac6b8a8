"""Queries that write rows of the tables as files to the shared folder and scan them."""

from __future__ import annotations

from pyspark.sql import functions as F

from labtables.config import shared_dir
from labtables.operators.quality import audit
from labtables.plans.tables import rejected, structure_map
from labtables.queries.base import query, table
from labtables.sinks.files import write_lines
from labtables.sources import text


def size_lines(spark, d):
    """A folder for each size with the names of its parts, one a line."""
    path = shared_dir(spark, "lines")
    write_lines(table(spark, d, "part").select(F.col("p_name").alias("value"), "p_size"), path, "p_size")
    return path


@query("binary_scan", """
SELECT 'p_size=' || p_size AS folder, sum(length(p_name) + 1)::BIGINT AS n_bytes FROM part GROUP BY p_size
""")
def binary_scan(spark, d):
    found = text.binary_files(spark, size_lines(spark, d))
    folder = F.substring_index("filename", "/", 1)
    return found.groupBy(folder.alias("folder")).agg(F.sum(F.length("content").cast("bigint")).alias("n_bytes"))


@query("binary_audit", """
SELECT CAST(p_size AS VARCHAR) AS folder, CASE WHEN p_size % 5 = 0 THEN 'missing' WHEN p_size % 5 = 1 THEN 'mismatch' ELSE 'ok' END
  AS status, count(DISTINCT p_name) AS n_names FROM part GROUP BY ALL
""")
def binary_audit(spark, d):
    """Files of names by size, the ledger of their bytes, and the files as they are found later: those of
    every fifth size are gone, those of another fifth have changed."""
    part = table(spark, d, "part").select(F.col("p_name").alias("value"), "p_size")
    first, later = shared_dir(spark, "lines"), shared_dir(spark, "lines")
    changed = F.when(F.col("p_size") % 5 == 1, F.concat("value", F.lit("."))).otherwise(F.col("value"))
    # one file for a size, its name without the parts that the writer makes up
    of_size = part.groupBy("p_size").agg(F.sort_array(F.collect_set("value")).alias("names"))
    write_lines(of_size.select(F.array_join("names", "\n").alias("value"), "p_size"), first, "p_size")
    write_lines(of_size.where("p_size % 5 <> 0").select(
        F.array_join("names", "\n").alias("value"), "p_size").withColumn("value", changed), later, "p_size")
    size = lambda: F.regexp_extract("filename", r"^p_size=(\d+)/", 1)
    before = text.binary_files(spark, first).withColumn("filename", size())
    ledger = before.select("filename", F.md5("content").alias("md5"))
    status = audit(ledger, text.binary_files(spark, later).withColumn("filename", size()))
    lines = before.select("filename", (F.size(F.split(F.decode("content", "UTF-8"), "\n")) - 1).cast("bigint").alias("n_names"))
    return status.join(lines, "filename").select(F.col("filename").alias("folder"), "status", "n_names")


@query("text_lines", "SELECT p_name AS value, count(*) AS n FROM part GROUP BY p_name")
def text_lines(spark, d):
    path = shared_dir(spark, "lines")
    write_lines(table(spark, d, "part").select(F.col("p_name").alias("value")), path)
    return text.lines(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("tagged_files", """
SELECT p_name AS value, CAST(p_size AS VARCHAR) AS source, count(*) AS n FROM part GROUP BY ALL
""")
def tagged_files(spark, d):
    """Lines of all files in one scan. The first line of a file says what it holds; every other line must
    bear the name of the file whose first line fits it."""
    path = shared_dir(spark, "lines")
    part = table(spark, d, "part")
    lines = part.select(F.concat_ws("|", F.col("p_size").cast("string"), "p_name").alias("value"), "p_size")
    heads = part.select("p_size").distinct().select(F.concat(F.lit("head|"), F.col("p_size").cast("string")).alias("value"), "p_size")
    write_lines(lines.unionByName(heads).repartition("p_size"), path, "p_size")
    tagged = text.tagged_lines(spark, f"{path}/*").withColumn("cells", F.split("value", r"\|", 2))
    head = F.get("cells", F.lit(0)) == "head"
    heads = tagged.where(head).select("source", F.get("cells", F.lit(1)).alias("size"))
    found = tagged.where(~head).join(heads, "source").where(F.get("cells", F.lit(0)) == F.col("size"))
    return found.groupBy(F.get("cells", F.lit(1)).alias("value"), F.col("size").alias("source")).agg(
        F.count(F.lit(1)).alias("n"))


REJECTS_SQL = """
WITH s AS (SELECT p_partkey AS k, p_size <= 2 AS short, p_name LIKE 'hot%' AS failed FROM part),
good AS (SELECT k FROM s WHERE NOT short AND NOT failed),
kept_names AS (SELECT DISTINCT p_name FROM part JOIN good ON p_partkey = k)
SELECT 'structures' AS input, 'too few tokens' AS reason, count(*) AS n FROM s WHERE short HAVING count(*) > 0
UNION ALL SELECT 'structures', 'failed check', count(*) FROM s WHERE NOT short AND failed HAVING count(*) > 0
UNION ALL SELECT 'aliases', 'unresolved alias', count(*) FROM part WHERE p_partkey % 7 <> 0
  AND p_partkey // 2 NOT IN (SELECT k FROM good) HAVING count(*) > 0
UNION ALL SELECT 'aliases', 'too few tokens', count(*) FROM part WHERE p_partkey % 7 = 0 HAVING count(*) > 0
UNION ALL SELECT 'series', 'bad number in data', count(*) FROM supplier WHERE s_suppkey % 3 = 0 HAVING count(*) > 0
UNION ALL SELECT 'series', 'unknown id', count(*) FROM supplier WHERE s_suppkey % 3 <> 0
  AND s_suppkey NOT IN (SELECT k FROM good) HAVING count(*) > 0
UNION ALL SELECT 'properties', 'unknown id', count(*) FROM customer WHERE c_custkey NOT IN (SELECT k FROM good) HAVING count(*) > 0
UNION ALL SELECT 'universe', 'failed enrichment', count(*) FROM kept_names WHERE p_name LIKE '%blue%' HAVING count(*) > 0
"""


@query("rejects_table", REJECTS_SQL)
def rejects_counts(spark, d):
    """Rejects of parts as structures and aliases, suppliers as series and customers as property files."""
    part, key = table(spark, d, "part"), F.col("p_partkey").cast("string")
    name = F.replace("p_name", F.lit(" "), F.lit("_"))
    pairs = part.select(F.when(F.col("p_size") <= 2, name).otherwise(F.concat(name, F.lit(" "), key)).alias("value"))
    canonical = F.floor(F.col("p_partkey") / 2).cast("string")
    aliases = part.select(F.concat(
        F.lit("Removed a"), key, F.when(F.col("p_partkey") % 7 != 0, F.concat(F.lit(" - a duplicate of "), canonical, F.lit(" (#1)")))
        .otherwise("")
    ).alias("value"))
    own = text.parse_pairs(pairs).where(F.col("reason").isNull()).select("mid")
    mapping, _ = structure_map(pairs, aliases, ~F.startswith("smiles", F.lit("hot")))
    suppliers, customers = table(spark, d, "supplier"), table(spark, d, "customer")
    series = suppliers.select(
        F.concat(F.col("s_suppkey").cast("string"), F.lit("-0.jdx")).alias("file"), F.col("s_suppkey").cast("string").alias("mid"),
        F.when(F.col("s_suppkey") % 3 == 0, "bad number in data").alias("reason"),
    )
    properties = customers.select(F.col("c_custkey").cast("string").alias("mid"), F.lit(None).cast("string").alias("reason"))
    canonical_map = mapping.join(own, "mid", "left_semi")
    keys = canonical_map.select("smiles", F.lit("own").alias("source"))
    known = keys.where(~F.contains("smiles", F.lit("blue")))
    found = rejected(pairs, aliases, series, properties, keys, canonical_map, known)
    return found.groupBy("input", "reason").agg(F.count(F.lit(1)).alias("n"))
