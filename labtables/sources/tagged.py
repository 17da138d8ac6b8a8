"""Tagged-property files (``> <NAME>`` followed by the value), one file per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtables.functions.plans import add_once
from labtables.functions.strings import strip, unix_lines

# Form of a tag, end of a record, the two properties that are read.
TAG = r"> <([\w.]+)>"
RECORD_END = "$$$$"
METHOD = "METHOD"
FREQUENCIES = "IR.FREQUENCIES"

# A tag and what follows it up to the next one.
PROPERTY = rf"(?s){TAG}(.*?)(?={TAG}|\z)"

NO_TAG = "missing property"
BAD_NUMBER = "bad number in property"


def parse_tagged(df: DataFrame, content: str = "content") -> DataFrame:
    """Add method, freqsformat, freqs and ``reason``; the first occurrence of a tag counts."""
    names = F.regexp_extract_all(F.col("text"), F.lit(PROPERTY), F.lit(1))
    pieces = F.regexp_extract_all(F.col("text"), F.lit(PROPERTY), F.lit(2))

    def value(name: str) -> Column:
        at = F.array_position("names", name)
        return F.when(at > 0, strip(F.substring_index(F.get("pieces", at - 1), RECORD_END, 1)))

    def pair(line: Column) -> Column:
        parts = F.split(strip(line), r"\s+", 2)
        return F.struct(
            F.get(parts, F.lit(0)).try_cast("double").alias("freq"),
            F.get(parts, F.lit(1)).try_cast("double").alias("intensity"),
        )

    reason = (
        F.when(F.col("method").isNull() | F.col("peak_lines").isNull(), NO_TAG)
        .when(F.exists("freqs", lambda p: p["freq"].isNull() | p["intensity"].isNull()), BAD_NUMBER)
    )
    parsed = (
        df.withColumn("text", unix_lines(F.col(content)))
        .withColumns({"names": names, "pieces": pieces})
        .withColumns({"method": value(METHOD), "peak_lines": F.split(value(FREQUENCIES), r"\n+")})
        .withColumns({
            "freqsformat": strip(F.get("peak_lines", F.lit(0))),
            "freqs": F.transform(F.slice("peak_lines", F.lit(2), F.size("peak_lines")), pair),
        })
    )
    return add_once(parsed, freqs=F.col("freqs"), reason=reason).drop(
        content, "text", "names", "pieces", "peak_lines"
    )
