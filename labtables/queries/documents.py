"""Sources, lists per key, documents and keyed loading."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labtables.config import shared_dir
from labtables.operators import documents as docs
from labtables.operators.enrich import enrich
from labtables.operators.keys import drop_matching, first_of_each
from labtables.operators.skew import collect_parts
from labtables.operators.sources import count_sources, merge_sources
from labtables.plans.registry import summary
from labtables.plans.tables import universe
from labtables.queries.base import query, table
from labtables.sinks.files import write_documents
from labtables.sinks.store import insert_ignoring_duplicates, new_documents


@query("tagged_union", """
SELECT DISTINCT source, md5(text) AS digest FROM documents
""")
def tagged_union(spark, d):
    # texts are compared by a 256-bit digest, so that no text is shuffled
    lines = table(spark, d, "documents").select("source", F.md5("text").alias("digest"), F.sha2("text", 256).alias("key"))
    return lines.distinct().select("source", "digest")


@query("source_universe", """
SELECT md5(text) AS digest, min(n_chars) AS n_chars, string_agg(DISTINCT source, ',' ORDER BY source) AS source
FROM documents GROUP BY text
""")
def source_universe(spark, d):
    tagged = table(spark, d, "documents").select(
        "source", "n_chars", F.md5("text").alias("digest"), F.sha2("text", 256).alias("key")
    )
    merged = merge_sources(tagged, ["key", "digest"], F.min("n_chars").alias("n_chars"))
    return merged.select("digest", "n_chars", F.array_join("source", ",").alias("source"))


@query("source_set_counts", """
SELECT source, count(*) AS n FROM (
  SELECT string_agg(DISTINCT source, ',' ORDER BY source) AS source FROM documents GROUP BY text) GROUP BY source
""")
def source_set_counts(spark, d):
    merged = merge_sources(table(spark, d, "documents").select(F.sha2("text", 256).alias("key"), "source"), "key")
    return summary(merged, "source").withColumn("source", F.array_join("source", ","))


TEXT_STATS = T.StructType([T.StructField("n_letters", T.LongType()), T.StructField("n_digits", T.LongType())])


def text_stats(texts: pd.Series) -> pd.DataFrame:
    """Length and number of digits; texts without a digit fail."""
    out = pd.DataFrame({"n_letters": texts.str.len(), "n_digits": texts.str.count("[0-9]")}, index=texts.index)
    return out[out["n_digits"] > 0]


@query("enrich_pandas", """
SELECT doc_id, length(text) AS n_letters, length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits
FROM documents WHERE regexp_matches(text, '[0-9]')
""")
def enrich_pandas(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "text")
    return enrich(rows, "text", text_stats, TEXT_STATS).drop("text")


def mass_and_flags(names: pd.Series) -> pd.DataFrame:
    out = pd.DataFrame({
        "mass": names.str.len() + 0.5, "ring": names.str.contains("ring"), "blue": names.str.contains("blue"),
    }, index=names.index)
    return out[~names.str.startswith("hot")]


@query("universe_table", """
SELECT p_name AS smiles, length(p_name) + 0.5::DOUBLE AS mass, contains(p_name, 'ring') AS ring,
  contains(p_name, 'blue') AS blue,
  string_agg(DISTINCT CASE own WHEN 1 THEN 'own' ELSE p_brand END, ',' ORDER BY CASE own WHEN 1 THEN 'own' ELSE p_brand END)
  AS source
FROM (SELECT p_name, p_brand, 0 AS own FROM part UNION ALL
  SELECT p_name, p_brand, 1 FROM part WHERE p_size > 10)
WHERE p_name NOT LIKE 'hot%' GROUP BY p_name
""")
def universe_table(spark, d):
    part = table(spark, d, "part").withColumn("name", F.replace("p_name", F.lit(" "), F.lit("_")))
    own = part.where(F.col("p_size") > 10).select(F.col("name").alias("smiles"))
    external = part.select(
        F.concat("name", F.lit(" "), F.col("p_partkey").cast("string")).alias("value"), F.col("p_brand").alias("source")
    )
    table_rows = universe(own, external, "own", mass_and_flags, ("ring", "blue"))
    return table_rows.select(
        F.replace("smiles", F.lit("_"), F.lit(" ")).alias("smiles"), "mass", "fg.ring", "fg.blue",
        F.array_join("source", ",").alias("source"),
    )


def ids_of_customers(spark, d):
    return table(spark, d, "orders").select(F.col("o_custkey").alias("smiles"), F.col("o_orderkey").alias("mid"))


@query("external_ids", """
SELECT o_custkey AS smiles, 0::BIGINT AS part, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS nist
FROM orders GROUP BY o_custkey
""")
def external_ids(spark, d):
    return docs.external_ids(ids_of_customers(spark, d)).withColumn("nist", F.array_join("nist", ","))


@query("external_ids_in_parts", """
SELECT o_custkey AS smiles, part, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS nist
FROM (SELECT o_custkey, o_orderkey,
  (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 4 AS part FROM orders)
GROUP BY o_custkey, part
""")
def external_ids_in_parts(spark, d):
    return docs.external_ids(ids_of_customers(spark, d), limit=4).withColumn("nist", F.array_join("nist", ","))


@query("doc_lists", """
SELECT o_custkey, 0::BIGINT AS part, string_agg(o_orderpriority || ':' || o_orderkey, ',' ORDER BY o_orderkey) AS items
FROM orders GROUP BY o_custkey
""")
def doc_lists(spark, d):
    item = F.struct("o_orderpriority", "o_orderkey")
    lists = collect_parts(table(spark, d, "orders"), ["o_custkey"], item, "items", [F.col("o_orderkey")])
    text = F.transform("items", lambda s: F.concat_ws(":", s["o_orderpriority"], s["o_orderkey"].cast("string")))
    return lists.withColumn("items", F.array_join(text, ","))


@query("doc_last_wins", """
SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY o_custkey
""")
def doc_last_wins(spark, d):
    return docs.last_wins(table(spark, d, "orders"), "o_custkey", "o_orderpriority", "o_orderkey")


def document_inputs(spark, d):
    """Orders as measurements and ids, events as computed rows, customers in credit as universe."""
    orders, events, customer = (table(spark, d, n) for n in ("orders", "events", "customer"))
    key = lambda c: F.col(c).cast("string")
    mapping = orders.select(key("o_orderkey").alias("mid"), key("o_custkey").alias("smiles"))
    measured = orders.select(
        key("o_orderkey").alias("mid"), F.col("o_orderkey").cast("int").alias("index"),
        F.array("o_totalprice").alias("vec"), F.col("o_orderstatus").alias("state"),
        F.col("o_orderpriority").alias("state_info"),
    )
    computed = events.select(
        key("user_id").alias("smiles"), F.col("event_type").alias("method"),
        F.array(F.struct(F.col("event_id").cast("double").alias("freq"), F.col("value").alias("intensity"))).alias("freqs"),
    )
    base = customer.where(F.col("c_acctbal") > 0).select(
        key("c_custkey").alias("smiles"), F.col("c_acctbal").alias("mass"),
        F.struct((F.col("c_acctbal") > 5000).alias("rich"), (F.col("c_nationkey") < 10).alias("near")).alias("fg"),
        F.array("c_mktsegment").alias("source"),
    )
    return mapping, measured, computed, base


SPECTRUM_SQL = "o_orderstatus || ':' || o_orderpriority || ':' || CAST(round(o_totalprice * 100) AS BIGINT)"


def spectra_text():
    """Spectra of a document, which hold one value each, as sorted text."""
    return F.array_join(F.array_sort(F.transform("expir", lambda s: F.concat_ws(
        ":", s["state"], s["state_info"], F.round(F.get(s["vec"], F.lit(0)) * 100).cast("bigint").cast("string")
    ))), ",")


@query("docs_full_merge", f"""
WITH e AS (SELECT CAST(o_custkey AS VARCHAR) AS id,
    string_agg(DISTINCT {SPECTRUM_SQL}, ',' ORDER BY {SPECTRUM_SQL}) AS expir,
    string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY CAST(o_orderkey AS VARCHAR)) AS nist FROM orders GROUP BY 1),
t AS (SELECT CAST(user_id AS VARCHAR) AS id, string_agg(event_type || ':' || event_id, ',' ORDER BY event_type, event_id) AS thir
  FROM events GROUP BY 1),
c AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_acctbal AS mass, c_mktsegment AS source, c_acctbal > 5000 AS rich,
  c_nationkey < 10 AS near FROM customer WHERE c_acctbal > 0)
SELECT id AS _id, 0::BIGINT AS part, mass, source, rich, near, nist, expir, thir
FROM e FULL OUTER JOIN t USING (id) FULL OUTER JOIN c USING (id)
""")
def docs_full_merge(spark, d):
    merged = docs.documents(*document_inputs(spark, d))
    thir = F.array_join(F.transform("thir", lambda t: F.concat_ws(
        ":", t["method"], F.get(t["freqs"], F.lit(0))["freq"].cast("bigint").cast("string")
    )), ",")
    return merged.select(
        "_id", "part", "mass", F.array_join("source", ",").alias("source"), "fg.rich", "fg.near",
        F.array_join("external_id.nist", ",").alias("nist"),
        spectra_text().alias("expir"), thir.alias("thir"),
    )


@query("source_line_counts", """
SELECT p_name AS smiles, string_agg(p_brand || ':' || times, ',' ORDER BY p_brand) AS sources
FROM (SELECT p_name, p_brand, count(DISTINCT (p_type, p_size)) AS times FROM part GROUP BY p_name, p_brand)
GROUP BY p_name
""")
def source_line_counts(spark, d):
    lines = table(spark, d, "part").select(
        F.col("p_name").alias("smiles"), F.col("p_brand").alias("source"), F.struct("p_type", "p_size").alias("line")
    )
    counted = count_sources(lines, "smiles", "line")
    text = F.transform("sources", lambda s: F.concat_ws(":", s["source"], s["times"].cast("string")))
    return counted.select("smiles", F.array_join(text, ",").alias("sources"))


ORDER_ITEMS_SQL = """
SELECT CAST(o_custkey AS VARCHAR) AS _id, count(*) AS n, sum(k) AS keys, max(p) AS last FROM (
  SELECT o_custkey, o_orderkey AS k, (row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderkey AS VARCHAR)) - 1) // 3 AS p
  FROM orders) GROUP BY o_custkey
"""


def documents_in_parts(spark, d):
    """Documents of several parts, written once and read back."""
    path = shared_dir(spark, "documents")
    write_documents(docs.documents(*document_inputs(spark, d), ids_per_row=3, spectra_per_row=2, methods_per_row=4), path)
    return spark.read.parquet(path)


@query("insert_documents_in_parts", ORDER_ITEMS_SQL)
def insert_documents_in_parts(spark, d):
    """Documents of several parts, inserted twice: every item of every list is in the store once."""
    path = shared_dir(spark, "parts")
    documents = documents_in_parts(spark, d)
    for _ in range(2):
        insert_ignoring_duplicates(spark, documents, path, unique=True)
    items = docs.document_items(spark.read.parquet(path).withColumn("nist", F.col("external_id.nist")), "nist")
    return items.groupBy("_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("bigint")).alias("keys"), F.max("part").alias("last")
    )


ROUNDTRIP_SQL = f"""
SELECT id AS _id, 0::BIGINT AS part, c_acctbal AS mass, c_acctbal > 5000 AS rich, c_mktsegment AS source, nist, expir
FROM (SELECT CAST(o_custkey AS VARCHAR) AS id, string_agg(DISTINCT {SPECTRUM_SQL}, ',' ORDER BY {SPECTRUM_SQL}) AS expir,
    string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY CAST(o_orderkey AS VARCHAR)) AS nist FROM orders GROUP BY 1)
  FULL OUTER JOIN (SELECT CAST(c_custkey AS VARCHAR) AS id, * FROM customer WHERE c_acctbal > 0) USING (id)
WHERE id NOT IN (SELECT CAST(user_id AS VARCHAR) FROM events)
"""


def not_stored(spark, d, documents):
    """Documents, as they read back, without those whose id is on the list of stored ones."""
    stored = table(spark, d, "events").select(F.col("user_id").cast("string").alias("_id"))
    return drop_matching(documents, stored, "_id").select(
        "_id", "part", "mass", "fg.rich", F.array_join("source", ",").alias("source"),
        F.array_join("external_id.nist", ",").alias("nist"), spectra_text().alias("expir"),
    )


@query("document_roundtrip", ROUNDTRIP_SQL)
def document_roundtrip(spark, d):
    path = shared_dir(spark, "documents")
    write_documents(docs.documents(*document_inputs(spark, d)), path)
    return not_stored(spark, d, spark.read.parquet(path))


@query("document_json_roundtrip", ROUNDTRIP_SQL)
def document_json_roundtrip(spark, d):
    path, documents = shared_dir(spark, "documents"), docs.documents(*document_inputs(spark, d))
    write_documents(documents, path, as_json=True)
    return not_stored(spark, d, spark.read.schema(documents.schema).json(path))


@query("insert_ignore_duplicates", """
SELECT c_custkey AS _id, c_name FROM customer
""")
def insert_ignore_duplicates(spark, d):
    """A store of one segment, then all customers twice over, then a run that adds nothing."""
    customer = table(spark, d, "customer").select(F.col("c_custkey").alias("_id"), "c_name", "c_mktsegment", "c_acctbal")
    path = shared_dir(spark, "store")
    columns = ["_id", "c_name"]
    repeated = customer.unionByName(customer.where(F.col("c_acctbal") > 0)).select(*columns)
    insert_ignoring_duplicates(spark, customer.where(F.col("c_mktsegment") == "BUILDING").select(*columns), path, ["_id"])
    insert_ignoring_duplicates(spark, repeated, path, ["_id"])
    insert_ignoring_duplicates(spark, repeated, path, ["_id"])
    return spark.read.parquet(path)


@query("new_documents", """
SELECT DISTINCT c_custkey AS _id, c_name FROM customer WHERE c_mktsegment <> 'BUILDING'
""")
def not_stored_yet(spark, d):
    customer = table(spark, d, "customer").select(F.col("c_custkey").alias("_id"), "c_name", "c_mktsegment")
    stored = customer.where(F.col("c_mktsegment") == "BUILDING")
    return new_documents(customer.unionByName(customer).select("_id", "c_name"), stored, ["_id"])


@query("first_of_each", """
SELECT o_custkey, arg_min(o_orderpriority, (o_totalprice, o_orderkey)) AS o_orderpriority, min(o_totalprice) AS o_totalprice
FROM orders GROUP BY o_custkey
""")
def one_row_per_key(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_totalprice", "o_orderkey", "o_orderpriority")
    return first_of_each(rows, ["o_custkey"]).drop("o_orderkey")
