"""Ledgers of a crawl: written, finished, added to and replaced."""

from __future__ import annotations

from pyspark.sql import functions as F

from labtables.config import shared_dir
from labtables.operators import idsets
from labtables.operators.keys import latest
from labtables.queries.base import query, table
from labtables.sinks import ledgers
from labtables.sources import text


def with_later_lines(spark, path, lines):
    """Lines that somebody added behind the end marker: a file whose name comes after that of the marker."""
    folder = ledgers.current(spark, path)["folders"][-1]
    ledgers.swap_small(spark, f"{folder}/~later", "\n".join(lines) + "\n")


@query("ledger_ranges", """
SELECT DISTINCT floor(o_totalprice / 1000) AS low, floor(o_totalprice / 1000) + 1 AS high FROM orders
""")
def ledger_ranges(spark, d):
    """Ranges of prices, written and finished; what is added behind the marker does not count."""
    path = shared_dir(spark, "ranges")
    low = F.floor(F.col("o_totalprice") / 1000).cast("double")
    ledgers.write_ranges(table(spark, d, "orders").select(low.alias("low"), (low + 1).alias("high")).distinct(), path)
    with_later_lines(spark, path, ["-5 -4", "done", "-3 -2"])
    return text.parse_ranges(ledgers.ledger_lines(spark, path))


@query("id_ledger", "SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_acctbal > 0")
def id_ledger(spark, d):
    """Ids in two goes: the second adds to the first without copying it and finishes the ledger."""
    path, customer = shared_dir(spark, "ids"), table(spark, d, "customer").where(F.col("c_acctbal") > 0)
    ids = customer.select(F.col("c_custkey").alias("id"), "c_mktsegment")
    ledgers.write_ids(ids.where(F.col("c_mktsegment") == "BUILDING"), path, done=False)
    ledgers.write_ids(ids.where(F.col("c_mktsegment") != "BUILDING"), path, keep=True)
    with_later_lines(spark, path, ["x1", "x2"])
    return text.parse_ids(ledgers.ledger_lines(spark, path))


def downloads(spark, d):
    """Files per user, and those of every seventh user once more from another address."""
    events = table(spark, d, "events").where(~F.col("event_type").isin("signup", "error"))
    name = F.concat("event_type", F.lit("/"), F.col("user_id").cast("string"), F.lit("-"), F.col("event_id").cast("string"))
    return events.select(
        F.col("user_id").cast("string").alias("id"),
        F.concat(F.lit("http://files/"), F.col("event_id").cast("string")).alias("url"), name.alias("filename"),
    )


FILES_SQL = """
SELECT CAST(user_id AS VARCHAR) AS id, event_type || '/' || user_id || '-' || event_id AS filename,
  'http://files/' || event_id AS url FROM events WHERE event_type NOT IN ('signup', 'error')
"""


@query("ledger_blocks", f"SELECT id, filename, url FROM ({FILES_SQL})")
def ledger_blocks(spark, d):
    """Blocks of a hundred rows at most; then a block that is cut off by the next, one never ended, and one
    behind the marker, of which nothing counts."""
    path = shared_dir(spark, "blocks")
    ledgers.write_blocks(downloads(spark, d), path, done=False, rows=100)
    folder = ledgers.current(spark, path)["folders"][-1]
    ledgers.swap_small(spark, f"{folder}/z-open", "u1 start\nhttp://x a/1\nu2 start\nhttp://x a/2\nu1 end\nu3 start\nhttp://x a/3\n")
    ledgers.write_version(spark.createDataFrame([], "value string"), path, done=True, keep=True)
    with_later_lines(spark, path, ["u4 start", "http://x a/4", "u4 end"])
    inside = text.in_closed_blocks(ledgers.ledger_lines(spark, path))
    rows = text.parse_manifest(inside)
    return latest(rows, ["id", "filename"], F.col("seq"), "url").select("id", "filename", "url")


@query("ledger_checksums", """
SELECT source || '/' || doc_id AS filename, md5(text) AS md5 FROM documents WHERE lang <> 'de' AND source <> 'src3'
""")
def ledger_checksums(spark, d):
    """A finished ledger of documents, of which German ones changed and those of a source are gone, audited
    and replaced by the rows that hold; lines behind its marker are gone with the old version."""
    path, docs = shared_dir(spark, "checksums"), table(spark, d, "documents")
    docs = docs.withColumn("filename", F.concat("source", F.lit("/"), F.col("doc_id").cast("string")))
    changed = F.when(F.col("lang") == "de", F.concat("text", F.lit("\n"))).otherwise(F.col("text"))
    ledgers.write_checksums(docs.select("filename", F.md5(changed).alias("md5")), path)
    with_later_lines(spark, path, ["src3/later 0123"])
    files = docs.where(F.col("source") != "src3").select("filename", F.encode("text", "UTF-8").alias("content"))
    ledgers.keep_verified(spark, path, files)
    return text.parse_checksums(ledgers.ledger_lines(spark, path))


def stored_id_sets(spark, d):
    """Users of three kinds of events as bitmaps, each kept in files of its own."""
    folder, events = shared_dir(spark, "idsets"), table(spark, d, "events")
    paths = []
    for kind in ("view", "click", "signup"):
        paths.append(f"{folder}/{kind}")
        idsets.id_set(events.where((F.col("event_type") == kind) & (F.col("user_id") % 3 > 0)), "user_id").write.parquet(paths[-1])
    return [spark.read.parquet(p) for p in paths]


@query("id_set_members", """
SELECT DISTINCT user_id AS id FROM events WHERE event_type IN ('view', 'click', 'signup') AND user_id % 3 > 0
""")
def id_set_members(spark, d):
    """Ids found in any of three batches, from their bitmaps alone."""
    return idsets.members(idsets.union(*stored_id_sets(spark, d)))


@query("id_set_todo", """
SELECT c_custkey, (SELECT count(DISTINCT user_id) FROM events WHERE event_type IN ('view', 'click', 'signup')
  AND user_id % 3 > 0) AS n_found FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type IN ('view', 'click', 'signup') AND user_id % 3 > 0)
""")
def id_set_todo(spark, d):
    """Customers whose id no batch holds, and how many ids the batches hold."""
    found = idsets.union(*stored_id_sets(spark, d))
    todo = idsets.not_in(table(spark, d, "customer").select("c_custkey"), "c_custkey", found)
    return todo.select("c_custkey", idsets.size(found).scalar().alias("n_found"))
