"""Parsers of lines and files, on text files that Spark writes from table rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from labtables.config import shared_dir
from labtables.functions.strings import file_key, leading_word
from labtables.operators import coords, enrich, keys, quality
from labtables.plans.tables import computed, computed_properties
from labtables.queries.base import query, spread, table, text_files
from labtables.sinks.files import export_json, write_coords, write_new
from labtables.sources import labelled, text
from labtables.sources.records import LABELLED_END, labelled_records, tagged_records
from labtables.sources.tagged import RECORD_END


def text_of(name: str):
    return F.col(name).cast("string")


@query("text_pairs", """
SELECT CAST(p_partkey AS VARCHAR) AS mid, replace(p_name, ' ', '_') AS smiles FROM part
""")
def text_pairs(spark, d):
    line = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit(" \t "), text_of("p_partkey"), F.lit(" "))
    parsed = text.parse_pairs(table(spark, d, "part").select(line.alias("value")))
    return parsed.where(F.col("reason").isNull()).select("mid", "smiles")


def alias_tables(spark, d):
    """Parts of one name and brand are duplicates of the first of them; small sizes are canonical."""
    part = table(spark, d, "part")
    first = part.groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("first"))
    dup = part.join(first, ["p_name", "p_brand"]).where(F.col("p_partkey") != F.col("first"))
    log = dup.select(F.concat(
        F.lit("Removed "), text_of("p_partkey"), F.lit(" - a duplicate of "), text_of("first"), F.lit(" (#1)")
    ).alias("value"))
    canonical = part.join(first, F.col("p_partkey") == F.col("first")).where(F.col("p_size") <= 40)
    aliases = text.parse_aliases(log).where(F.col("reason").isNull()).select("mid", "dupof")
    return aliases, canonical.select(text_of("p_partkey").alias("mid"), F.col("p_type").alias("smiles"))


ALIAS_SQL = """
WITH f AS (SELECT p_name, p_brand, min(p_partkey) AS first FROM part GROUP BY p_name, p_brand),
dup AS (SELECT p_partkey, first FROM part JOIN f USING (p_name, p_brand) WHERE p_partkey <> first),
canon AS (SELECT p_partkey, p_type FROM part JOIN f ON p_partkey = first WHERE p_size <= 40)
"""


@query("alias_resolve", ALIAS_SQL + """
SELECT CAST(dup.p_partkey AS VARCHAR) AS mid, p_type AS smiles FROM dup JOIN canon ON first = canon.p_partkey
UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_type FROM canon
""")
def alias_resolve(spark, d):
    return keys.resolve_aliases(*alias_tables(spark, d))[0]


@query("alias_unresolved", ALIAS_SQL + """
SELECT CAST(p_partkey AS VARCHAR) AS mid, CAST(first AS VARCHAR) AS dupof, 'unresolved alias' AS reason
FROM dup WHERE first NOT IN (SELECT p_partkey FROM canon)
""")
def alias_unresolved(spark, d):
    return keys.resolve_aliases(*alias_tables(spark, d))[1].select("mid", "dupof", "reason")


@query("parse_rejects", """
WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT CASE WHEN len(list_filter(string_split_regex(line, '\\s+'), lambda t: t <> '')) < 2
  THEN 'too few tokens' ELSE 'ok' END AS reason, count(*) AS n FROM l GROUP BY 1
""")
def parse_rejects(spark, d):
    rows = table(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    parsed = text.parse_pairs(rows).withColumn("reason", F.coalesce("reason", F.lit("ok")))
    return quality.count_reasons(parsed)


@query("file_name_parts", """
SELECT doc_id, source AS id, CAST(doc_id AS INTEGER) AS index FROM documents
""")
def file_name_parts(spark, d):
    name = F.concat("source", F.lit("-"), text_of("doc_id"), F.lit(".jdx"))
    mid, index = file_key(F.col("name"))
    return table(spark, d, "documents").select("doc_id", name.alias("name")).select(
        "doc_id", mid.alias("id"), index.alias("index")
    )


@query("state_parse", """
SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'purchase') THEN event_type ELSE 'others' END AS word,
  CASE WHEN event_type IN ('click', 'view', 'purchase') THEN props
  ELSE upper(event_type) || '  ' || props END AS rest FROM events
""")
def state_parse(spark, d):
    word, rest = leading_word(F.col("state"), ("click", "view", "purchase"))
    state = F.concat(F.upper("event_type"), F.lit("  "), "props")
    return table(spark, d, "events").select("event_id", state.alias("state")).select(
        "event_id", word.alias("word"), rest.alias("rest")
    )


def labelled_text(spark, d):
    """One labelled record per order: a repeated header, stray lines, glued negative numbers."""
    whole = F.floor("o_totalprice").cast("bigint").cast("string")
    name = F.concat(text_of("o_custkey"), F.lit("-"), text_of("o_orderkey"), F.lit(".jdx"))
    content = F.concat(
        F.lit("\n99 99\n##TITLE= "), name, F.lit(" \r\n##STATE="), F.col("o_orderpriority"),
        F.lit("\r\n##FIRSTX=1\n##LASTX="), text_of("o_custkey"), F.lit("\n##NPOINTS = 6\n##YFACTOR=9\n"),
        F.when(F.col("o_orderstatus") != "P", "##YFACTOR=0.5\n").otherwise(""),
        F.lit("##XUNITS=1/CM\n##YUNITS= "), F.col("o_orderstatus"), F.lit(" \nstray 1 2\n##XYDATA=(XY..XY)\n3 4\n"),
        F.lit("##XYDATA= (X++(Y..Y))\n"), text_of("o_orderkey"), F.lit(" "), whole, F.lit("-"), text_of("o_custkey"),
        F.lit("\n##NOTE=inside\n  "), text_of("o_custkey"), F.lit(" 1e-2 7 "), whole,
    )
    return spread(table(spark, d, "orders")).select(content.alias("value"))


def labelled_files(spark, d):
    return labelled_records(spark, text_files(spark, d, "labelled", labelled_text, LABELLED_END))


@query("labelled_headers", """
SELECT o_custkey || '-' || o_orderkey || '.jdx' AS file, o_orderpriority AS state, '1' AS firstx,
  CAST(o_custkey AS VARCHAR) AS lastx, '6' AS npoints,
  CASE WHEN o_orderstatus = 'P' THEN '9' ELSE '0.5' END AS yfactor, '1/CM' AS xunits, o_orderstatus AS yunits
FROM orders
""")
def labelled_headers(spark, d):
    parsed = labelled.parse_labelled(labelled_files(spark, d))
    return parsed.select("file", *[F.col(h).alias(h.lower()) for h in labelled.HEADERS])


@query("labelled_points", """
WITH o AS (SELECT o_custkey || '-' || o_orderkey || '.jdx' AS file, o_orderkey::DOUBLE AS k,
  o_custkey::DOUBLE AS c, floor(o_totalprice) AS w FROM orders)
SELECT file, line::INTEGER AS line, j::INTEGER AS j, x, y FROM (
  SELECT file, 0 AS line, 0 AS j, k AS x, w AS y FROM o UNION ALL
  SELECT file, 0, 1, k, CASE WHEN c = 0 THEN 0.0 ELSE -c END FROM o UNION ALL
  SELECT file, 1, 0, c, 0.01 FROM o UNION ALL
  SELECT file, 1, 1, c, 7.0 FROM o UNION ALL SELECT file, 1, 2, c, w FROM o)
""")
def labelled_points(spark, d):
    points = labelled.points(labelled.parse_labelled(labelled_files(spark, d)), ["file"])
    # -0.0 and 0.0 are one number
    return points.select("file", "line", "j", "x", (F.col("y") + F.lit(0.0)).alias("y"))


def tagged_text(spark, d):
    """One property record per order; open orders have a method only in the record's last line."""
    whole = F.floor("o_totalprice").cast("bigint").cast("string")
    content = F.concat(
        F.lit("\n"), text_of("o_orderkey"), F.lit(".sdf \n"),
        F.when(F.col("o_orderstatus") == "O", "order\n").otherwise(
            F.concat(F.lit("> <METHOD>\n"), F.col("o_orderpriority"), F.lit("\n\n"))
        ),
        F.lit("> <TOTAL.PRICE>\n"), whole, F.lit("\n> <IR.FREQUENCIES>\nfrequency intensity\n"),
        text_of("o_orderkey"), F.lit("  "), text_of("o_custkey"), F.lit(".5\n\n"), whole,
        F.lit("\t-3\n> <METHOD>\nlater\n"),
    )
    return spread(table(spark, d, "orders")).select(content.alias("value"))


def tagged_files(spark, d):
    return tagged_records(spark, text_files(spark, d, "tagged", tagged_text, RECORD_END))


def peaks_text(freqs):
    return F.array_join(F.transform(freqs, lambda p: F.concat_ws(
        ":", p["freq"].cast("bigint").cast("string"), (p["intensity"] * 10).cast("bigint").cast("string")
    )), " ")


# the later METHOD counts only where no earlier one exists
PEAKS_SQL = """o_orderkey || ':' || (10 * o_custkey + 5) || ' ' ||
  CAST(floor(o_totalprice) AS BIGINT) || ':-30'"""
METHOD_SQL = "CASE WHEN o_orderstatus = 'O' THEN 'later' ELSE o_orderpriority END"


@query("tagged_properties", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS mid, {METHOD_SQL} AS method, 'frequency intensity' AS freqsformat,
  {PEAKS_SQL} AS peaks FROM orders
""")
def tagged_properties(spark, d):
    good = computed_properties(tagged_files(spark, d)).where(F.col("reason").isNull())
    return good.select("mid", "method", "freqsformat", peaks_text("freqs").alias("peaks"))


@query("property_table", f"""
SELECT c_name AS smiles, {METHOD_SQL} AS method, {PEAKS_SQL} AS peaks
FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0
""")
def property_table(spark, d):
    known = table(spark, d, "customer").where(F.col("c_acctbal") > 0)
    mapping = table(spark, d, "orders").join(known, F.col("o_custkey") == F.col("c_custkey")).select(
        text_of("o_orderkey").alias("mid"), F.col("c_name").alias("smiles")
    )
    return computed(computed_properties(tagged_files(spark, d)), mapping).select(
        "smiles", "method", peaks_text("freqs").alias("peaks")
    )


@query("dictionary_scan", """
SELECT p_brand AS pattern, p_type AS name, count(*) AS n FROM part
WHERE p_size > 5 AND p_retailprice < 1500 GROUP BY p_brand, p_type
""")
def dictionary_scan(spark, d):
    line = (
        F.when(F.col("p_size") <= 5, F.concat(F.lit("// "), "p_brand", F.lit("\t"), "p_type"))
        .when(F.col("p_retailprice") >= 1500, F.concat("p_brand", F.lit(" "), "p_type"))
        .otherwise(F.concat("p_brand", F.lit("\t"), "p_type", F.lit(" // "), "p_name"))
    )
    entries = text.parse_dictionary(table(spark, d, "part").select(line.alias("value")))
    return entries.groupBy("pattern", "name").agg(F.count(F.lit(1)).alias("n"))


DICTIONARY = [
    ("[0-9]{3,}", "digits"), ("https?://", "link"), ("[a-z]@[a-z]", "address"), (" the ", "article"),
    ("(?i)license", "license"), ("eau|aux", "french"), ("sch", "german"), ("ci[oó]n", "spanish"),
]


@query("pattern_flags", "SELECT doc_id, " + ", ".join(
    f"regexp_matches(text, '{p}') AS {n}" for p, n in DICTIONARY
) + " FROM documents")
def pattern_flags(spark, d):
    flags = enrich.pattern_flags(F.col("text"), DICTIONARY)
    return table(spark, d, "documents").select("doc_id", flags.alias("fg")).select("doc_id", "fg.*")


@query("base64_roundtrip", """
SELECT doc_id, length(base64(encode(text))) AS n_encoded, md5(text) AS digest, true AS same FROM documents
""")
def base64_roundtrip(spark, d):
    """Encoded texts in a file of keyed lines, scanned and decoded, and encoded again."""
    keyed = text.parse_keyed_text(text.lines(spark, text_files(spark, d, "encoded", encoded_lines)))
    back = keyed.select("key", "encoded", coords.decode_base64(F.col("encoded")).alias("back"))
    return back.select(
        F.col("key").cast("bigint").alias("doc_id"), F.length("encoded").cast("bigint").alias("n_encoded"),
        F.md5("back").alias("digest"), (one_line(F.col("back")) == F.col("encoded")).alias("same"),
    )


def one_line(data):
    # the encoder breaks lines after 76 characters, which the decoder must not see
    return F.regexp_replace(F.base64(data), "\r\n", "")


def encoded_lines(spark, d):
    line = F.concat(text_of("doc_id"), F.lit("\t"), one_line(F.encode("text", "UTF-8")))
    return table(spark, d, "documents").select(line.alias("value"))


def coordinate_lines(spark, d):
    """A block of 16 atoms per vector: thirds of the values are x, y, z, the last quarter the element."""
    e = F.col("embedding")
    symbols = F.array(*[F.lit(s) for s in coords.SYMBOLS])

    def line(i):
        xyz = [F.format_string("%10.4f", F.get(e, i + k).cast("double")) for k in (0, 16, 32)]
        z = F.floor(F.abs(F.get(e, i + 48).cast("double")) * 300).cast("int")
        return F.concat(*xyz, F.lit(" "), F.coalesce(F.get(symbols, z), F.lit("Xx")), F.lit("  0  0\n"))

    block = F.concat(
        F.lit("name\n program\n\n 16  0  0\n"),
        F.array_join(F.transform(F.sequence(F.lit(0), F.lit(15)), line), ""), F.lit("M  END\n"),
    )
    value = F.concat(text_of("vec_id"), F.lit("\t"), one_line(F.encode(block, "UTF-8")))
    return table(spark, d, "embeddings").select(value.alias("value"))


def coordinate_blocks(spark, d):
    keyed = text.parse_keyed_text(text.lines(spark, text_files(spark, d, "coordinates", coordinate_lines)))
    return coords.parse_coords(keyed).where(F.col("reason").isNull())


ATOM_SQL = """
SELECT vec_id, i, CASE WHEN z >= 118 THEN 0 ELSE z + 1 END AS type, x, y, w FROM (
  SELECT vec_id, i, CAST(floor(abs(embedding[i + 49]::DOUBLE) * 300) AS INTEGER) AS z,
    round(embedding[i + 1]::DOUBLE, 4) AS x, round(embedding[i + 17]::DOUBLE, 4) AS y,
    round(embedding[i + 33]::DOUBLE, 4) AS w
  FROM embeddings, unnest(generate_series(0, 15)) AS g(i))
"""


@query("coords_parse", f"""
SELECT CAST(vec_id AS VARCHAR) AS key, i::INTEGER AS atom, type::INTEGER AS type, x + 0.0 AS x, y + 0.0 AS y,
  w + 0.0 AS z FROM ({ATOM_SQL})
""")
def coords_parse(spark, d):
    atoms = coordinate_blocks(spark, d).select("key", F.posexplode("atoms").alias("atom", "a"))
    xyz = [(F.round(F.col(f"a.{c}").cast("double"), 4) + F.lit(0.0)).alias(c) for c in "xyz"]
    return atoms.select("key", "atom", F.col("a.type").cast("int").alias("type"), *xyz)


@query("coords_format", f"""
SELECT CAST(vec_id AS VARCHAR) AS key, '16;' || string_agg(
  type || ',' || printf('%.5g', x) || ',' || printf('%.5g', y) || ',' || printf('%.5g', w) || ';', '' ORDER BY i)
  AS line FROM ({ATOM_SQL}) GROUP BY vec_id
""")
def coords_format(spark, d):
    """Atoms written as text lines, which are read again."""
    path = shared_dir(spark, "atoms")
    write_coords(coordinate_blocks(spark, d), path)
    parts = F.split("value", "\t", 2)
    return text.lines(spark, path).select(F.get(parts, F.lit(0)).alias("key"), F.get(parts, F.lit(1)).alias("line"))


@query("json_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
""")
def json_roundtrip(spark, d):
    folder = shared_dir(spark, "export")
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )
    write_new(orders, f"{folder}/orders")
    export_json(spark, folder, ["orders", "absent"])
    return spark.read.schema(orders.schema).json(f"{folder}/orders.json")
