"""Keys, lists in parts, splits, quality, enrichment, pages and coordinates."""

import base64
import random
import re

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labtables.functions.hashing import cutoffs
from labtables.operators import coords, keys, pages, quality, splits
from labtables.operators.documents import merge_parts
from labtables.operators.enrich import enrich, enrich_unique, matches, read_dictionary
from labtables.operators.skew import collect_parts, hot_keys, join_parts, key_counts
from labtables.operators.sources import count_sources, merge_sources
from labtables.sinks.files import write_coords
from labtables.sources import text


def df_of(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_semi_keeps_each_row_once_and_anti_is_the_rest(spark):
    left = df_of(spark, [(i % 7, i) for i in range(30)], "k int, v int")
    right = df_of(spark, [(1,), (1,), (3,), (9,)], "k int")
    kept, rest = keys.keep_matching(left, right, "k"), keys.drop_matching(left, right, "k")
    assert {r["k"] for r in kept.collect()} == {1, 3}
    assert sorted(kept.unionByName(rest).collect()) == sorted(left.collect())


def test_alias_of_an_alias_stays_unresolved(spark):
    log = df_of(spark, [("Removed b - a duplicate of a (#1)",), ("Removed c - a duplicate of b (#1)",), ("short line",)], "value string")
    parsed = text.parse_aliases(log)
    assert parsed.where("reason is not null").count() == 1
    aliases = parsed.where("reason is null").select("mid", "dupof")
    total, lost = keys.resolve_aliases(aliases, df_of(spark, [("a", "CC")], "mid string, smiles string"))
    assert sorted(map(tuple, total.collect())) == [("a", "CC"), ("b", "CC")]
    assert [r["mid"] for r in lost.collect()] == ["c"]


def test_pairs(spark):
    lines = ["CC\t 1 ", "  C 2 more", "one", "", " "]
    parsed = text.parse_pairs(df_of(spark, [(l,) for l in lines], "value string")).collect()
    assert [(r["smiles"], r["mid"]) for r in parsed if r["reason"] is None] == [("CC", "1"), ("C", "2")]
    assert sum(r["reason"] is not None for r in parsed) == 3


def test_dictionary(spark, write):
    path = write("dict.txt", "//note\n\n[a]\tfirst //Note: x\nno tab\nb\t second\nc\td\te\n")
    assert read_dictionary(text.parse_dictionary(text.lines(spark, path))) == [("[a]", "first"), ("b", "second")]


def test_ledgers(spark, write):
    log = text.ordered_lines(spark, write("log", "7 start\nu1 a\nu2 b\n7 end\n8 start\nu3 a\ndone\n"))
    assert [r["id"] for r in text.parse_block_ends(log).collect()] == ["7"]
    last = keys.latest(text.parse_manifest(log), ["filename"], F.col("seq"), "url")
    assert {r["filename"]: r["url"] for r in last.collect()} == {"a": "u3", "b": "u2"}
    ids = text.parse_ids(text.lines(spark, write("ids", "x\ny\nx\ndone\n")))
    assert sorted(r["id"] for r in ids.collect()) == ["x", "y"]
    cut = text.parse_ids(text.ordered_lines(spark, write("cut", "a\ndone\nb\n")))
    assert [r["id"] for r in cut.collect()] == ["a"]
    ranges = text.parse_ranges(text.lines(spark, write("ranges", "0 1.5\n1.5 99\ndone")))
    assert sorted(map(tuple, ranges.collect())) == [(0.0, 1.5), (1.5, 99.0)]
    sums = text.parse_checksums(text.lines(spark, write("sums", "f abc\n")))
    assert [tuple(r) for r in sums.collect()] == [("f", "abc")]


def test_lists_in_parts_are_whole_sorted_and_bounded(spark):
    rng = random.Random(5)
    rows = [("hot", rng.randrange(400)) for _ in range(700)] + [(f"k{i % 60}", i) for i in range(600)] + [("hot", None)]
    rng.shuffle(rows)
    df = df_of(spark, rows, "k string, v int")
    hot = hot_keys(key_counts(df, ["k"]), ["k"], rows=50)
    assert [(r["k"], r["fan"]) for r in hot.collect()] == [("hot", 15)]
    parts = collect_parts(df, ["k"], F.col("v"), "items", limit=40, rows=50).collect()
    whole = {}
    for k, v in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        whole.setdefault(k, []).append(v)
    expected = {(k, p): v[p * 40:(p + 1) * 40] for k, v in whole.items() for p in range(-(-len(v) // 40))}
    assert {(p["k"], p["part"]): p["items"] for p in parts} == expected
    items = join_parts(spark.createDataFrame(parts), ["k"], "items").where("k = 'hot'").orderBy("part", "place")
    assert [r["value"] for r in items.collect()] == whole["hot"]


def test_parts_of_a_key_do_not_depend_on_other_keys(spark):
    rng = random.Random(8)
    own = [("a", rng.randrange(90)) for _ in range(300)]
    alone = collect_parts(df_of(spark, own, "k string, v int"), ["k"], F.col("v"), "items", limit=20, rows=60)
    others = own + [(f"b{i % 3}", i) for i in range(3000)]
    among = collect_parts(df_of(spark, others, "k string, v int"), ["k"], F.col("v"), "items", limit=20, rows=60).where("k = 'a'")
    assert sorted(map(tuple, alone.collect())) == sorted(map(tuple, among.collect()))


def test_long_lists_without_hot_keys_count_on(spark):
    df = df_of(spark, [("a", i) for i in range(10)], "k string, v int")
    parts = collect_parts(df, ["k"], F.col("v"), "items", limit=4).collect()
    assert {p["part"]: p["items"] for p in parts} == {0: [0, 1, 2, 3], 1: [4, 5, 6, 7], 2: [8, 9]}


def test_merge_parts_is_a_full_outer_merge(spark):
    a = df_of(spark, [("x", 0, [1]), ("y", 0, [2])], "k string, part int, a array<int>")
    b = df_of(spark, [("y", 0, "b")], "k string, part int, b string")
    big = df_of(spark, [("y", 0, 5.0), ("z", 0, 6.0)], "k string, part int, m double")
    got = {r["k"]: (r["a"], r["b"], r["m"]) for r in merge_parts([a, b], big, ["k", "part"]).collect()}
    assert got == {"x": ([1], None, None), "y": ([2], "b", 5.0), "z": (None, None, 6.0)}


def test_first_of_each(spark):
    df = df_of(spark, [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 9, None)], "k string, n int, t string")
    assert sorted(map(tuple, keys.first_of_each(df, ["k"]).collect())) == [("a", 1, "y"), ("b", 9, None)]


def test_sources(spark):
    rows = [("a", "s2", "a 1"), ("a", "s2", "a 1"), ("a", "s2", "a 2"), ("a", "s1", "a"), ("b", "s1", "b")]
    df = df_of(spark, rows, "k string, source string, line string")
    assert dict(map(tuple, merge_sources(df, "k").collect())) == {"a": ["s1", "s2"], "b": ["s1"]}
    counted = {r["k"]: [tuple(s) for s in r["sources"]] for r in count_sources(df, "k", "line").collect()}
    assert counted == {"a": [("s1", 1), ("s2", 2)], "b": [("s1", 1)]}


@given(st.lists(st.integers(0, 9), min_size=1, max_size=5).filter(any))
@settings(max_examples=50)
def test_cutoffs_follow_the_weights(weights):
    ends = [*cutoffs(weights), 1 << 32]
    shares = [b - a for a, b in zip([0, *ends], ends)]
    assert all(abs(s / (1 << 32) - w / sum(weights)) < 1e-8 for s, w in zip(shares, weights))


def test_split_shares_and_groups(spark):
    df = spark.range(20000).select(F.col("id"), (F.col("id") % 4000).alias("g"))
    rows = df.withColumn("u", splits.split_label(F.col("id"), (5, 3, 3), 1))
    shares = {r["u"]: r["count"] / 20000 for r in rows.groupBy("u").count().collect()}
    assert shares == pytest.approx({"training": 5 / 11, "validation": 3 / 11, "testing": 3 / 11}, abs=0.02)
    for split in (
        df.withColumn("usage", splits.split_label(F.col("g"), (4, 1, 1), 1)),
        splits.split_and_repair(df, F.col("id"), "g", (5, 3, 3), 1),
    ):
        assert split.groupBy("g").agg(F.count_distinct("usage").alias("n")).where("n > 1").count() == 0
        assert split.count() == 20000
    other = df.withColumn("u2", splits.split_label(F.col("id"), (5, 3, 3), 2)).join(rows, "id")
    assert other.where("u <> u2").count() > 5000


def test_levels(spark):
    df = df_of(spark, [("gas", ["a", "b"]), ("gas", ["a"]), ("solid", ["a", "b"]), (None, ["a", "b"])], "s string, src array<string>")
    got = [r[0] for r in df.select(splits.level(F.col("s"), F.col("src"))).collect()]
    assert got == ["overall", "limited", "unused", "unused"]


def test_validity_by_column_and_by_function(spark):
    df = df_of(spark, [("aa", 1), ("aa", 2), ("b", 3), (None, 4)], "k string, v int")
    by_function = quality.filter_valid(df, "k", lambda s: s.str.len() > 1)
    by_column = quality.filter_valid(df, "k", F.length("k") > 1)
    assert sorted(r["v"] for r in by_function.collect()) == sorted(r["v"] for r in by_column.collect()) == [1, 2]


def test_enrichment_drops_failing_keys(spark):
    schema = T.StructType([T.StructField("n", T.LongType())])

    def fn(keys_):
        out = pd.DataFrame({"n": keys_.str.len()}, index=keys_.index)
        return out[keys_ != "bad"]

    df = df_of(spark, [("aa", 1), ("aa", 2), ("bad", 3), ("c", 4), (None, 5)], "k string, v int")
    assert sorted((r["v"], r["n"]) for r in enrich(df, "k", fn, schema).collect()) == [(1, 2), (2, 2), (4, 1)]
    unique = df_of(spark, [("aa",), ("bad",)], "k string")
    assert [tuple(r) for r in enrich_unique(unique, "k", fn, schema).collect()] == [("aa", 2)]


@pytest.mark.parametrize("pattern", ["sch", "a|sch", "a.c", "[0-9]{2}", "a\\|b", "", "|x"])
def test_patterns_match_as_regular_expressions(spark, pattern):
    texts = ["", "a", "abc", "schule", "a|b", "x12", "1"]
    got = df_of(spark, [(t,) for t in texts], "t string").select("t", matches(F.col("t"), pattern).alias("m")).collect()
    assert {r["t"]: r["m"] for r in got} == {t: re.search(pattern, t) is not None for t in texts}


def test_page_links(spark):
    link = '<a href="/cgi/cbook.cgi?ID=C1&amp;Units=SI&amp;Type=IR-SPEC&amp;Index={}#IR-SPEC">'
    html = "2d Mol file" + "".join(link.format(i) for i in (3, 0, 3, 1000, "01")) + link.format(5).replace("C1", "C2")
    df = df_of(spark, [("C1", html), ("C9", "3d SD file")], "id string, html string")
    found = pages.spectrum_pages(df, "http://h").collect()
    assert [(r["id"], r["index"]) for r in found] == [("C1", 0), ("C1", 3), ("C1", 1000), ("C9", 0)]
    assert found[3]["url"] == "http://h/cgi/cbook.cgi?ID=C9&Units=SI&Mask=80"
    assert [r["filename"] for r in pages.structure_files(df, "http://h").collect()] == ["mol_files/C1.mol", "sdf_files/C9.sdf"]
    ids = pages.page_ids(df_of(spark, [('<a href="/cgi/cbook.cgi?ID= C5 &amp;x<a href="/cgi/cbook.cgi?ID=C5&amp;',)], "html string"))
    assert [r["id"] for r in ids.collect()] == ["C5"]


@pytest.mark.parametrize("html, expected", [
    ("matching species were found. Chemical Formula Not Found", "no results"),
    ("Due to the large number of matching species, only the first 9. matching species were found.", "too large"),
    ("7 matching species were found.", "multiple results"), ("Information on this page:", "single result"),
    ("", "unrecognised"),
])
def test_page_class(spark, html, expected):
    assert df_of(spark, [(html,)], "h string").select(pages.classify(F.col("h"))).first()[0] == expected


def block(atoms, count=None):
    lines = ["a", "b", "c", f"{len(atoms) if count is None else count:>3}  0"]
    return "\n".join(lines + [f"{x:10.4f}{y:10.4f}{z:10.4f} {s}  0" for x, y, z, s in atoms] + ["M  END", ""])


def coords_of(spark, encoded):
    return coords.parse_coords(df_of(spark, [("k", encoded)], "key string, encoded string"))


def encode(s):
    return base64.b64encode(s.encode()).decode()


def test_coordinates(spark):
    b64 = encode(block([(1.5, -0.0, 12.3456, "C"), (0.0001, 100.25, 2.0, "Xx"), (0.0, 0.0, 0.0, "Og")]))
    df = coords_of(spark, b64)
    row = df.first()
    assert row["reason"] is None and [a["type"] for a in row["atoms"]] == [6, 0, 118]
    line = df.select(coords.format_atoms(F.col("atoms"))).first()[0]
    assert line == "3;6,1.5,-0,12.346;0,0.0001,100.25,2;118,0,0,0;"
    # decoding ends at the first foreign character, padding may be absent
    assert coords_of(spark, b64.rstrip("=") + "!" + b64).first()["atoms"] == row["atoms"]
    assert coords_of(spark, encode(block([]))).select(coords.format_atoms(F.col("atoms"))).first()[0] == "0;"
    many = [(1, 2, 3, "H")] * 1234
    for atoms, count, reason in (
        (many[:1], 40, "bad atom block"), (many[:2], 1, "bad atom block"), (many[:1], "x", "bad atom count"),
        (many, 1234, None), (many[:16], " 16100", None), ([], "?", "bad atom count"),
    ):
        row = coords_of(spark, encode(block(atoms, count))).first()
        assert row["reason"] == reason and (reason or len(row["atoms"]) == len(atoms))


def test_coordinate_lines_are_written(spark, tmp_path):
    df = coords_of(spark, encode(block([(1.5, 0, 2, "C")])))
    write_coords(df, str(tmp_path / "out"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()] == ["k\t1;6,1.5,0,2;"]


def test_five_digits_print_as_c_does(spark):
    rng = random.Random(3)
    values = [rng.choice([1, -1]) * rng.uniform(0, 10) * 10.0 ** rng.randrange(-7, 8) for _ in range(300)]
    values += [10.0625, 10.1875, 0.0, -0.0, 99999.5, 100000.0, 123456.0, 9.99996, 0.00012, 1e-5, 2.5e-7]
    got = df_of(spark, [(v,) for v in values], "v double").select(coords.five_digits(F.col("v"))).collect()
    assert [r[0] for r in got] == ["%.5g" % v for v in values]


@given(st.binary(max_size=60))
@settings(max_examples=25, deadline=None)
def test_base64_roundtrip(spark, data):
    df = df_of(spark, [(base64.b64encode(data).decode(),)], "s string")
    assert bytes(df.select(coords.decode_base64(F.col("s"))).first()[0]) == data
