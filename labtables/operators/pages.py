"""Result pages: class, ids and links to files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtables.functions.strings import between, strip

# Texts that tell the page classes, in the order they are tested.
PAGE_CLASSES = (
    ("Chemical Formula Not Found", "no results"),
    ("Due to the large number of matching species, only the first", "too large"),
    ("matching species were found.", "multiple results"),
    ("Information on this page:", "single result"),
)
# Marks around an id.
ID_MARK, ID_END = '<a href="/cgi/cbook.cgi?ID=', "&amp;"
# Texts that offer a structure file, its query and its file name.
FILE_KINDS = (
    ("2d Mol file", "Str2File", "mol_files", ".mol"),
    ("3d SD file", "Str3File", "sdf_files", ".sdf"),
)
# Links and marks of spectrum pages, file suffixes.
QUERY_PATH = "/cgi/cbook.cgi"
INDEX_LINK = r'/cgi/cbook\.cgi\?ID=[^&"]*&amp;Units=SI&amp;Type=IR-SPEC&amp;Index=(?:0|[1-9]\d*)#IR-SPEC'
DIGITAL_MARK = "in JCAMP-DX format."
SCAN_MARK = "A digitized version of this spectrum is not currently available."
SCAN_LINE = "scan of original (hardcopy) spectrum"
SUFFIXES = (("scanned", ".gif"), ("digitalized", ".jdx"))

UNRECOGNISED = "unrecognised"
TWO_SCANS = "more than one scan"
NO_SCAN = "no scan link"


def classify(html: Column, classes: Sequence[tuple[str, str]] = PAGE_CLASSES) -> Column:
    """Class of the first marker that occurs, else ``unrecognised``."""
    out = F.lit(UNRECOGNISED)
    for mark, name in reversed(list(classes)):
        out = F.when(F.contains(html, F.lit(mark)), name).otherwise(out)
    return out


def page_ids(pages: DataFrame, html: str = "html", mark: str = ID_MARK, end: str = ID_END,
             keep: Sequence[str] = ()) -> DataFrame:
    """Distinct ids: the text after each marker up to ``end``."""
    pieces = F.split(F.col(html), rf"\Q{mark}\E")
    after = F.slice(pieces, F.lit(2), F.size(pieces))
    ids = F.array_distinct(F.transform(after, lambda p: strip(F.substring_index(p, end, 1))))
    return pages.select(*keep, F.explode(ids).alias("id")).distinct()


def structure_files(pages: DataFrame, site: str) -> DataFrame:
    """(id, url, filename) of the structure files a page (id, html) offers."""
    offers = F.array(*[
        F.when(
            F.contains(F.col("html"), F.lit(mark)),
            F.struct(
                F.concat(F.lit(f"{site}{QUERY_PATH}?{query}="), F.col("id")).alias("url"),
                F.concat(F.lit(f"{folder}/"), F.col("id"), F.lit(suffix)).alias("filename"),
            ),
        )
        for mark, query, folder, suffix in FILE_KINDS
    ])
    return pages.select("id", F.explode(F.array_compact(offers)).alias("f")).select("id", "f.url", "f.filename")


def spectrum_pages(pages: DataFrame, site: str) -> DataFrame:
    """(id, index, url) of the spectrum pages a page links to; index 0 of the page itself if none."""
    own = F.concat(F.lit(f"{QUERY_PATH}?ID="), F.col("id"), F.lit("&amp;"))
    links = F.filter(
        F.regexp_extract_all(F.col("html"), F.lit(INDEX_LINK), F.lit(0)), lambda l: F.startswith(l, own)
    )
    indices = F.sort_array(F.array_distinct(F.transform(
        links, lambda l: F.regexp_extract(l, r"Index=(\d+)#", 1).cast("bigint")
    )))
    none = F.size("indices") == 0
    whole = F.concat(F.lit(f"{site}{QUERY_PATH}?ID="), F.col("id"), F.lit("&Units=SI&Mask=80"))
    linked = F.concat(
        F.lit(f"{site}{QUERY_PATH}?ID="), F.col("id"), F.lit("&amp;Units=SI&amp;Type=IR-SPEC&amp;Index="),
        F.col("index").cast("string"), F.lit("#IR-SPEC"),
    )
    return (
        pages.select("id", indices.alias("indices"))
        .withColumn("none", none)
        .withColumn("index", F.explode(F.when(F.col("none"), F.array(F.lit(0).cast("bigint"))).otherwise(F.col("indices"))))
        .select("id", "index", F.when(F.col("none"), whole).otherwise(linked).alias("url"))
    )


def spectrum_files(pages: DataFrame, site: str) -> DataFrame:
    """(id, index, kind, url, filename, reason) from fetched spectrum pages (id, index, html)."""
    scan_lines = F.filter(F.split(F.col("html"), "\n"), lambda l: F.contains(l, F.lit(SCAN_LINE)))
    kind = F.when(F.contains(F.col("html"), F.lit(DIGITAL_MARK)), "digitalized").when(
        F.contains(F.col("html"), F.lit(SCAN_MARK)), "scanned"
    )
    scanned = F.col("kind") == "scanned"
    quoted = between(F.get("scan_lines", F.lit(0)), '"', '"')
    digital_url = F.concat(
        F.lit(f"{site}{QUERY_PATH}?JCAMP="), F.col("id"), F.lit("&Index="), F.col("index").cast("string"),
        F.lit("&Type=IR"),
    )
    suffix = F.lit(None).cast("string")
    for name, text in SUFFIXES:
        suffix = F.when(F.col("kind") == name, text).otherwise(suffix)
    reason = (
        F.when(F.col("kind").isNull(), UNRECOGNISED)
        .when(scanned & (F.size("scan_lines") > 1), TWO_SCANS)
        .when(scanned & quoted.isNull(), NO_SCAN)
    )
    filename = F.concat("kind", F.lit("/"), "id", F.lit("-"), F.col("index").cast("string"), suffix)
    return (
        pages.withColumns({"scan_lines": scan_lines, "kind": kind})
        .withColumn("reason", reason)
        .withColumn("url", F.when(F.col("reason").isNull(), F.when(
            scanned, F.concat(F.lit(site), quoted)
        ).otherwise(digital_url)))
        .select("id", "index", "kind", "url", F.when(F.col("reason").isNull(), filename).alias("filename"), "reason")
    )


def files_per_id(links: DataFrame) -> DataFrame:
    """Number of spectra found per id."""
    return links.where(F.col("reason").isNull()).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
