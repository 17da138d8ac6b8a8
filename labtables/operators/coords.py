"""Coordinate blocks in base64 text: parse to atoms and format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtables.functions.plans import add_once

# Element symbols by atomic number, from 1.
SYMBOLS = (
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br "
    "Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho "
    "Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U Np Pu Am Cm Bk Cf Es "
    "Fm Md No Lr Rf Db Sg Bh Hs Mt Ds Rg Cn Nh Fl Mc Lv Ts Og"
).split()
HEADER_LINES = 3
SHORT_BLOCK = "bad atom block"
BAD_COUNT = "bad atom count"
ATOM_LINE = r"^\s*\S+\s+\S+\s+\S+\s+[A-Za-z]"


def decode_base64(c: Column) -> Column:
    """Bytes of the leading base64 characters; decoding ends at the first other character."""
    clean = F.regexp_extract(c, "^[A-Za-z0-9+/]*", 0)
    whole = F.length(clean) - F.when(F.length(clean) % 4 == 1, 1).otherwise(0)
    return F.unbase64(F.substring(clean, F.lit(1), whole))


def atomic_number(symbol: Column) -> Column:
    """1 to 118, 0 for an unknown symbol."""
    table = F.array(*[F.lit(s) for s in SYMBOLS])
    return F.array_position(table, symbol).cast("tinyint")


def parse_coords(df: DataFrame, encoded: str = "encoded") -> DataFrame:
    """Add ``atoms`` and ``reason``: 3 header lines, a count, then one ``x y z symbol …`` per line.

    A count that is no number, or does not agree with the atom lines that follow it, is a reject.
    """

    def atom(line: Column) -> Column:
        t = F.filter(F.split(line, r"\s+"), lambda w: w != "")
        return F.struct(
            atomic_number(F.get(t, F.lit(3))).alias("type"),
            F.get(t, F.lit(0)).try_cast("float").alias("x"),
            F.get(t, F.lit(1)).try_cast("float").alias("y"),
            F.get(t, F.lit(2)).try_cast("float").alias("z"),
        )

    text_lines = F.split(F.decode(decode_base64(F.col(encoded)), "ISO-8859-1"), "\n")
    # the count is the first number of its line; fields of three characters may run together there
    count_line = F.get("text_lines", F.lit(HEADER_LINES))
    whole = F.regexp_extract(count_line, r"^\s*(\d+)", 1).try_cast("int")
    narrow = F.trim(F.substring(count_line, 1, 3)).try_cast("int")
    after = F.slice("text_lines", F.lit(HEADER_LINES + 2), F.greatest(F.size("text_lines"), F.lit(0)))
    stop = F.array_position(F.transform(after, lambda l: F.rlike(l, F.lit(ATOM_LINE))), F.lit(False))
    n_lines = F.when(stop == 0, F.size(after)).otherwise(stop - F.lit(1)).cast("int")
    bad = F.exists("atoms", lambda a: a["type"].isNull() | a["x"].isNull() | a["y"].isNull() | a["z"].isNull())
    parsed = (
        df.withColumn("text_lines", text_lines)
        .withColumns({"whole": whole, "narrow": narrow, "n_lines": n_lines})
        .withColumn("atoms", F.transform(F.slice("text_lines", F.lit(HEADER_LINES + 2), F.col("n_lines")), atom))
    )
    agrees = (F.col("whole") == F.col("n_lines")) | F.coalesce(F.col("narrow") == F.col("n_lines"), F.lit(False))
    reason = F.when(F.col("whole").isNull(), BAD_COUNT).when(bad | ~agrees, SHORT_BLOCK)
    return add_once(parsed, atoms=F.col("atoms"), reason=reason).drop("text_lines", "whole", "narrow", "n_lines")


def five_digits(c: Column) -> Column:
    """Five significant digits without trailing zeros, ties to even, as C streams print floats."""
    v = c.cast("double")
    size = F.abs(v)
    rounded = v
    for exponent in range(-4, 5):
        rounded = F.when(size >= F.lit(10.0**exponent), F.bround(v, 4 - exponent)).otherwise(rounded)
    rounded = F.when(size >= F.lit(100000.0), v).otherwise(rounded)
    text = F.format_string("%.5g", rounded)
    # zeros before an exponent or at the end, and a point left bare
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+(e|$)", "$1$2"), r"\.(e|$)", "$1")


def format_atoms(atoms: Column) -> Column:
    """``n;type,x,y,z;…``"""
    parts = F.transform(atoms, lambda a: F.concat_ws(
        ",", a["type"].cast("string"), five_digits(a["x"]), five_digits(a["y"]), five_digits(a["z"])
    ))
    return F.concat(F.size(atoms).cast("string"), F.lit(";"), F.array_join(
        F.transform(parts, lambda p: F.concat(p, F.lit(";"))), ""
    ))
