"""Pages, manifests and ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F

from labtables.operators import pages as ops
from labtables.operators.keys import latest
from labtables.operators.quality import audit, verified
from labtables.queries.base import query, table
from labtables.sources.text import parse_block_ends, parse_manifest

SITE = "https://data.example.org"
SCAN_PATH = "/scans/17.gif"
CLASSES = (("###", "marked"), ('lang="fr"', "french"), ('lang="de"', "german"), ('lang="en"', "english"))


@query("page_classify", "SELECT page_id, CASE " + " ".join(
    f"WHEN contains(html, '{m}') THEN '{n}'" for m, n in CLASSES
) + " ELSE 'unrecognised' END AS class FROM pages")
def page_classify(spark, d):
    return table(spark, d, "pages").select("page_id", ops.classify(F.col("html"), CLASSES).alias("class"))


@query("page_ids", """
SELECT DISTINCT page_id, trim(split_part(piece, '"', 1)) AS id FROM (
  SELECT page_id, unnest(string_split(html, '<a href="')[2:]) AS piece FROM pages)
""")
def page_ids(spark, d):
    return ops.page_ids(table(spark, d, "pages"), "html", '<a href="', '"', ["page_id"])


def number_in_url():
    return F.regexp_extract("url", r"/(\d+)", 1)


def structure_pages(spark, d):
    """Pages with the marks of structure files and links to spectrum pages, set by their address."""
    link = lambda n: F.concat(
        F.lit('<a href="/cgi/cbook.cgi?ID='), F.col("id"), F.lit("&amp;Units=SI&amp;Type=IR-SPEC&amp;Index="),
        n, F.lit('#IR-SPEC">spectrum</a>'),
    )
    p = table(spark, d, "pages").withColumn("id", F.concat(F.lit("C"), F.col("page_id").cast("string")))
    html = F.concat(
        F.col("html"),
        F.when(F.startswith("url", F.lit("https")), f"<p>{ops.FILE_KINDS[0][0]}</p>").otherwise(""),
        F.when(F.contains("url", F.lit("/en/")), f"<p>{ops.FILE_KINDS[1][0]}</p>").otherwise(""),
        F.when(number_in_url() != "", F.concat(link(number_in_url()), link(F.lit("7")), link(number_in_url())))
        .otherwise(""),
        F.lit('<a href="/cgi/cbook.cgi?ID=other&amp;Units=SI&amp;Type=IR-SPEC&amp;Index=5#IR-SPEC">'),
    )
    return p.select("id", "url", html.alias("html"))


NUMBER_SQL = "regexp_extract(url, '/(\\d+)', 1)"


@query("page_structure_files", f"""
SELECT 'C' || page_id AS id, '{SITE}/cgi/cbook.cgi?Str2File=C' || page_id AS url,
  'mol_files/C' || page_id || '.mol' AS filename FROM pages WHERE starts_with(url, 'https')
UNION ALL SELECT 'C' || page_id, '{SITE}/cgi/cbook.cgi?Str3File=C' || page_id, 'sdf_files/C' || page_id || '.sdf'
FROM pages WHERE contains(url, '/en/')
""")
def page_structure_files(spark, d):
    return ops.structure_files(structure_pages(spark, d), SITE)


@query("page_links", f"""
WITH n AS (SELECT page_id, {NUMBER_SQL} AS n FROM pages),
i AS (SELECT DISTINCT page_id, CAST(i AS BIGINT) AS index FROM (
  SELECT page_id, n AS i FROM n WHERE n <> '' UNION ALL SELECT page_id, '7' FROM n WHERE n <> ''))
SELECT 'C' || n.page_id AS id, coalesce(index, 0) AS index, CASE WHEN index IS NULL
  THEN '{SITE}/cgi/cbook.cgi?ID=C' || n.page_id || '&Units=SI&Mask=80'
  ELSE '{SITE}/cgi/cbook.cgi?ID=C' || n.page_id || '&amp;Units=SI&amp;Type=IR-SPEC&amp;Index=' || index || '#IR-SPEC'
  END AS url FROM n LEFT JOIN i ON n.page_id = i.page_id
""")
def page_links(spark, d):
    return ops.spectrum_pages(structure_pages(spark, d), SITE)


def fetched_pages(spark, d):
    # a line that holds the mark, with a link of our own in quotes
    scan = F.lit(f'<li>{ops.SCAN_LINE}: <b title="{SCAN_PATH}">see page</b></li>\n')
    http = ~F.startswith("url", F.lit("https"))
    html = F.concat(
        F.col("html"), F.lit("\n"),
        F.when(F.contains("url", F.lit("/en/")), f"Numbers {ops.DIGITAL_MARK}\n")
        .when(F.contains("url", F.lit("/fr/")), "\n")
        .otherwise(f"{ops.SCAN_MARK}\n"),
        scan, F.when(http & F.contains("url", F.lit("/de/")), scan).otherwise(""),
    )
    return table(spark, d, "pages").select(
        F.concat(F.lit("C"), F.col("page_id").cast("string")).alias("id"),
        F.length("url").cast("int").alias("index"), html.alias("html"),
    )


KIND_SQL = """
SELECT 'C' || page_id AS id, CAST(length(url) AS INTEGER) AS index,
  CASE WHEN contains(url, '/en/') THEN 'digitalized' WHEN contains(url, '/fr/') THEN NULL ELSE 'scanned' END AS kind,
  CASE WHEN contains(url, '/fr/') THEN 'unrecognised'
    WHEN contains(url, '/de/') AND NOT starts_with(url, 'https') THEN 'more than one scan' END AS reason FROM pages
"""


@query("page_spectrum_files", f"""
SELECT id, index, kind, reason, CASE WHEN reason IS NOT NULL THEN NULL
  WHEN kind = 'scanned' THEN '{SITE}{SCAN_PATH}'
  ELSE '{SITE}/cgi/cbook.cgi?JCAMP=' || id || '&Index=' || index || '&Type=IR' END AS url,
  CASE WHEN reason IS NULL THEN kind || '/' || id || '-' || index
    || CASE kind WHEN 'scanned' THEN '.gif' ELSE '.jdx' END END AS filename FROM ({KIND_SQL})
""")
def page_spectrum_files(spark, d):
    return ops.spectrum_files(fetched_pages(spark, d), SITE)


@query("page_file_counts", f"SELECT id, count(*) AS n FROM ({KIND_SQL}) WHERE reason IS NULL GROUP BY id")
def page_file_counts(spark, d):
    return ops.files_per_id(ops.spectrum_files(fetched_pages(spark, d), SITE))


def manifest_lines(spark, d):
    """A download log: signups open the block of a user, errors close it, the rest are file lines."""
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    line = (
        F.when(F.col("event_type") == "signup", F.concat(user, F.lit(" start")))
        .when(F.col("event_type") == "error", F.concat(user, F.lit(" end")))
        .otherwise(F.concat(F.lit(f"{SITE}/"), event, F.lit(" "), F.col("event_type"), F.lit("/"), user, F.lit(".jdx")))
    )
    return table(spark, d, "events").select(line.alias("value"), F.col("event_id").alias("seq"))


@query("manifest_latest", f"""
SELECT event_type || '/' || user_id || '.jdx' AS filename, '{SITE}/' || max(event_id) AS url FROM events
WHERE event_type NOT IN ('signup', 'error') GROUP BY event_type, user_id
""")
def manifest_latest(spark, d):
    return latest(parse_manifest(manifest_lines(spark, d)), ["filename"], F.col("seq"), "url")


@query("ledger_done", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS id FROM events WHERE event_type = 'error'")
def ledger_done(spark, d):
    return parse_block_ends(manifest_lines(spark, d))


def ledger_and_files(spark, d):
    """Every document has a ledger row; German ones changed since, those of one source are gone."""
    docs = table(spark, d, "documents").withColumn("filename", F.concat("source", F.lit("/"), F.col("doc_id").cast("string")))
    digest = F.md5(F.when(F.col("lang") == "de", F.concat("text", F.lit("\n"))).otherwise(F.col("text")))
    files = docs.where(F.col("source") != "src3").select("filename", F.encode("text", "UTF-8").alias("content"))
    return docs.select("filename", digest.alias("md5")), files


AUDIT_SQL = """
SELECT source || '/' || doc_id AS filename,
  CASE WHEN lang = 'de' THEN md5(text || chr(10)) ELSE md5(text) END AS md5,
  CASE WHEN source = 'src3' THEN 'missing' WHEN lang = 'de' THEN 'mismatch' ELSE 'ok' END AS status FROM documents
"""


@query("checksum_audit", AUDIT_SQL)
def checksum_audit(spark, d):
    return audit(*ledger_and_files(spark, d))


@query("checksum_verified", f"SELECT filename, md5 FROM ({AUDIT_SQL}) WHERE status = 'ok'")
def checksum_verified(spark, d):
    return verified(audit(*ledger_and_files(spark, d)))
