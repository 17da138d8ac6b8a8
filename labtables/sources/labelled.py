"""Labelled-record files (``##NAME=VALUE`` headers and one X++(Y..Y) data block).

One file is one row: the whole text is parsed by array expressions inside the scan stage, so line
order is the order in the text and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtables.functions.plans import add_once
from labtables.functions.strings import INLINE_BLANK, strip, unix_lines

# The headers the tables read and the marks of the data block.
HEADERS = ("STATE", "FIRSTX", "LASTX", "NPOINTS", "YFACTOR", "XUNITS", "YUNITS")
_B = rf"{INLINE_BLANK}*"
BLOCK_OPEN = rf"##{_B}XYDATA{_B}={_B}\(X\+\+\(Y\.\.Y\)\){_B}"
BLOCK_CLOSE = rf"##{_B}END{_B}="

# What lies between an opening line and the closing line or the end of the file.
BLOCK = rf"(?s)(?:^|\n){BLOCK_OPEN}(?=\n)(.*?)(?=\n{BLOCK_CLOSE}|\n?\z)"

BAD_HEADER_LINE = "header line without ="
BAD_NUMBER = "bad number in data"
MISSING = "missing header"


def _spaced(block: Column) -> Column:
    """Numbers set apart by spaces; a minus also separates, unless it belongs to an exponent."""
    has_blanks = F.contains(block, F.lit("\t")) | F.contains(block, F.lit("\x0b")) | F.contains(block, F.lit("\f"))
    out = F.when(has_blanks, F.translate(block, "\t\x0b\f", "   ")).otherwise(block)
    for text, with_space in (("-", " -"), ("E -", "E-"), ("e -", "e-")):
        out = F.replace(out, F.lit(text), F.lit(with_space))
    return out


def _data_lines(block: Column) -> Column:
    """Data lines of a block, whose text is empty or starts with the end of the opening line."""
    rows = F.split(F.substring(_spaced(block), F.lit(2), F.length(block) * 2), "\n")
    return F.when(block != "", F.filter(rows, lambda l: ~F.startswith(l, F.lit("##")))).otherwise(
        F.array().cast("array<string>")
    )


def _numbers(line: Column) -> Column:
    return F.transform(F.filter(F.split(line, " "), lambda t: t != ""), lambda t: t.try_cast("double"))


def parse_labelled(df: DataFrame, content: str = "content") -> DataFrame:
    """Add the header columns, ``data`` (array of x and ys) and ``reason`` to a file scan."""
    header_lines = F.filter(F.split("text", "\n"), lambda l: F.startswith(l, F.lit("##")))
    # the last header of a name counts, so they are looked up from the end
    names = F.transform(F.reverse("header_lines"), lambda l: strip(F.substring(F.substring_index(l, "=", 1), 3, 1 << 20)))
    values = F.transform(F.reverse("header_lines"), lambda l: strip(
        F.substring(l, F.locate("=", l) + F.lit(1), F.length(l))))

    def last_value(name: str) -> Column:
        at = F.array_position("names", name)
        return F.when(at > 0, F.get("values", at - 1))

    def row(n: Column) -> Column:
        return F.struct(F.get(n, F.lit(0)).alias("x"), F.slice(n, F.lit(2), F.size(n)).alias("ys"))

    columns = {n: last_value(n) for n in HEADERS}
    columns["STATE"] = F.coalesce(columns["STATE"], F.lit(""))
    missing = F.array_contains(F.array(*[F.col(n).isNull() for n in HEADERS if n != "STATE"]), True)
    bad_line = F.exists("numbers", lambda n: (F.size(n) == 0) | F.exists(n, lambda v: v.isNull()))
    reason = (
        F.when(F.exists("header_lines", lambda l: ~F.contains(l, F.lit("="))), BAD_HEADER_LINE)
        .when(bad_line, BAD_NUMBER)
        .when(missing, MISSING)
    )
    parsed = (
        df.withColumn("text", unix_lines(F.col(content)))
        .withColumns({
            "header_lines": header_lines,
            "blocks": F.regexp_extract_all("text", F.lit(BLOCK), F.lit(1)),
        })
        .withColumns({
            "numbers": F.transform(F.flatten(F.transform("blocks", _data_lines)), _numbers), "names": names, "values": values,
        })
        .withColumns(columns)
    )
    parts = {n: F.col(n) for n in HEADERS}
    return add_once(parsed, **parts, data=F.transform("numbers", row), reason=reason).drop(
        content, "text", "header_lines", "blocks", "numbers", "names", "values"
    )


def points(records: DataFrame, keys: list[str]) -> DataFrame:
    """Raw samples as rows: (keys, line, x, j, y)."""
    return (
        records.where(F.col("reason").isNull())
        .select(*keys, F.posexplode("data").alias("line", "d"))
        .select(*keys, "line", F.col("d.x").alias("x"), F.posexplode("d.ys").alias("j", "y"))
    )
