"""Labelled-record and tagged-property files, one case per quirk."""

import pytest
from pyspark.sql import functions as F

from labtables.functions.strings import leading_word
from labtables.plans.tables import computed_properties, measured_series
from labtables.operators.series import Grid
from labtables.sources.labelled import parse_labelled
from labtables.sources.tagged import parse_tagged
from labtables.sources.text import fail_fast, files, split_rejects

HEAD = "##FIRSTX=1\n##LASTX=5\n##NPOINTS=5\n##YFACTOR=1\n##XUNITS=1/CM\n##YUNITS=T\n"
OPEN = "##XYDATA=(X++(Y..Y))\n"


def parse(spark, text):
    return parse_labelled(spark.createDataFrame([("a-1.jdx", text)], "file string, content string")).first()


def rows(record):
    return [(d["x"], list(d["ys"])) for d in record["data"]]


@pytest.mark.parametrize("block, expected", [
    ("1 2 3\n##END=\n", [(1.0, [2.0, 3.0])]),
    ("1 2 3\n", [(1.0, [2.0, 3.0])]),
    ("1 2 3", [(1.0, [2.0, 3.0])]),
    ("123-45\n##END=\n", [(123.0, [-45.0])]),
    ("1 2e-3-4E-1\n##END=", [(1.0, [0.002, -0.4])]),
    ("-1 2\n  7\t8  \n##END=\n", [(-1.0, [2.0]), (7.0, [8.0])]),
    ("1 2\n##NOTE=in between\n3 4\n##END=\n5 6\n", [(1.0, [2.0]), (3.0, [4.0])]),
    ("1 2\n##END=\n7 7\n" + OPEN + "3 4\n## END = x\n5 6\n", [(1.0, [2.0]), (3.0, [4.0])]),
    ("1 2\n" + OPEN + "3 4\n##END=\n", [(1.0, [2.0]), (3.0, [4.0])]),
    ("##END=\n1 2\n", []),
    ("5\n##END=\n", [(5.0, [])]),
])
def test_data_block(spark, block, expected):
    for text in (HEAD + OPEN + block, (HEAD + OPEN + block).replace("\n", "\r\n")):
        record = parse(spark, text)
        assert record["reason"] is None
        assert rows(record) == expected


@pytest.mark.parametrize("text, reason", [
    (HEAD + OPEN + "1 x\n##END=\n", "bad number in data"),
    (HEAD + OPEN + "1 2\n\n3 4\n##END=\n", "bad number in data"),
    (HEAD + "##NOTHING\n", "header line without ="),
    (HEAD.replace("##YFACTOR=1\n", ""), "missing header"),
    ("", "missing header"),
])
def test_rejects(spark, text, reason):
    assert parse(spark, text)["reason"] == reason


def test_headers(spark):
    record = parse(spark, "## YFACTOR = 2 \n##STATE=a=b\n" + HEAD + "##YFACTOR=\t3 \n##XYDATA=(XY..XY)\n1 2\n ##XUNITS=no\n")
    assert record["YFACTOR"] == "3" and record["STATE"] == "a=b" and record["XUNITS"] == "1/CM"
    assert record["reason"] is None and record["data"] == []
    assert parse(spark, HEAD)["STATE"] == ""


def test_series_reasons(spark):
    def text(**change):
        head = {"FIRSTX": 0, "LASTX": 40, "NPOINTS": 5, "YFACTOR": 1, "XUNITS": "1/CM", "YUNITS": "T", **change}
        return "".join(f"##{k}={v}\n" for k, v in head.items()) + OPEN + "0 0 1 0 1 0\n##END=\n"

    cases = [
        ("m-0.jdx", text(), None), ("m-1.jdx", text(NPOINTS=1), "missing or bad header"),
        ("m-2.jdx", text(YFACTOR="one"), "missing or bad header"), ("m-x.jdx", text(), "bad file name"),
        ("m.jdx", text(), "bad file name"), ("m-3.jdx", text(LASTX=20), "no right neighbour"),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "file string, content string")
    got = {r["file"]: r for r in measured_series(df, Grid(0, 40, 10), 50).collect()}
    assert {f: got[f]["reason"] for f, _, _ in cases} == {f: r for f, _, r in cases}
    assert got["m-0.jdx"]["vec"] == [1.0, 0.0, 1.0, 0.0, 1.0] and got["m-0.jdx"]["index"] == 0
    good, bad = split_rejects(measured_series(df, Grid(0, 40, 10), 50), ["mid", "index"], "series", F.col("file"))
    assert good.count() == 1 and bad.count() == 5 and bad.columns == ["input", "line", "reason"]
    with pytest.raises(Exception, match="rejected row"):
        fail_fast(measured_series(df, Grid(0, 40, 10), 50)).collect()


@pytest.mark.parametrize("text, expected", [
    ("SOLUTION (10% CCl4)", ("solution", "(10% CCl4)")), ("vapor x", ("others", "vapor x")), ("", ("others", "")),
    ("gas", ("gas", "")), ("gases", ("others", "gases")),
])
def test_state(spark, text, expected):
    word, rest = leading_word(F.col("s"))
    assert tuple(spark.createDataFrame([(text,)], "s string").select(word, rest).first()) == expected


PEAKS = "> <IR.FREQUENCIES>\nfreq int\n1 2\n\n 3.5   4 \n\n"


@pytest.mark.parametrize("text, expected", [
    ("mol\n> <A>\nx\n\n> <METHOD>\n B3 \n\n" + PEAKS + "$$$$\n", ("B3", "freq int", [(1.0, 2.0), (3.5, 4.0)], None)),
    ("> <METHOD>\nB3\n" + PEAKS, ("B3", "freq int", [(1.0, 2.0), (3.5, 4.0)], None)),
    (PEAKS + "> <METHOD>\nB3\n$$$$\n> <METHOD>\nB4\n", ("B3", "freq int", [(1.0, 2.0), (3.5, 4.0)], None)),
    ("> <METHOD>\nB3\n> <IR.FREQUENCIES>\nfmt\n", ("B3", "fmt", [], None)),
    (PEAKS, (None, None, None, "missing property")),
    ("> <METHOD>\nB3\n", (None, None, None, "missing property")),
    ("> <METHOD>\nB3\n> <IR.FREQUENCIES>\nfmt\n1 x\n", (None, None, None, "bad number in property")),
])
def test_tagged(spark, text, expected):
    for body in (text, text.replace("\n", "\r\n")):
        r = parse_tagged(spark.createDataFrame([("m.sdf", body)], "file string, content string")).first()
        assert r["reason"] == expected[3]
        if r["reason"] is None:
            assert (r["method"], r["freqsformat"], [tuple(p) for p in r["freqs"]]) == expected[:3]


def test_file_scan(spark, write):
    write("props/m1.sdf", "> <METHOD>\nB3\n" + PEAKS)
    folder = write("props/m2.sdf", "nothing").rsplit("/", 1)[0]
    got = {r["mid"]: r["reason"] for r in computed_properties(files(spark, folder)).collect()}
    assert got == {"m1": None, "m2": "missing property"}
