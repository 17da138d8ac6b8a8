"""Versioned ledgers and the registry's records."""

import time

import pytest
from pyspark.sql import functions as F

from labtables.plans.registry import Registry, TableDef
from labtables.sinks import ledgers
from labtables.sources import text


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def values(df):
    return sorted(r[0] for r in df.select("value").collect())


def test_versions_are_swapped(spark, tmp_path):
    path = str(tmp_path / "ids")
    assert ledgers.ledger_lines(spark, path).count() == 0 and not ledgers.is_done(spark, path)
    ledgers.write_version(lines(spark, "a", "b"), path)
    assert values(ledgers.ledger_lines(spark, path)) == ["a", "b"] and not ledgers.is_done(spark, path)
    ledgers.write_version(lines(spark, "c"), path, done=True, keep=True)
    assert values(ledgers.ledger_lines(spark, path)) == ["a", "b", "c"] and ledgers.is_done(spark, path)
    old = ledgers.ledger_lines(spark, path)
    ledgers.write_version(lines(spark, "d"), path)  # replaces all
    assert values(ledgers.ledger_lines(spark, path)) == ["d"]
    assert values(old) == ["a", "b", "c"]  # a reader keeps the version it began with
    (tmp_path / "ids" / "v-lost").mkdir()
    (tmp_path / "ids" / "v-lost" / "part-0").write_text("half of a version that failed\n")
    assert values(ledgers.ledger_lines(spark, path)) == ["d"]


def test_marker_cuts_the_whole_ledger(spark, tmp_path):
    for name, content in (("a", "1\n2\n"), ("b", "3\n done \n4\n"), ("c", "5\ndone\n")):
        (tmp_path / name).write_text(content)
    ordered = text.ordered_lines(spark, str(tmp_path))
    assert values(text.until_done(ordered)) == ["1", "2", "3"]
    assert sorted(r["id"] for r in text.parse_ids(ordered).collect()) == ["1", "2", "3"]
    (tmp_path / "b").write_text("3\n4\n")
    (tmp_path / "c").write_text("5\n")
    assert text.until_done(text.ordered_lines(spark, str(tmp_path))).count() == 5


@pytest.mark.parametrize("chunk", [1, 2, 3, 100])
def test_closed_blocks(spark, tmp_path, chunk):
    (tmp_path / "a").write_text(
        "u0 f0\nx start\nu1 f1\nu2 f2\nx end\nu3 f3\ny start\nu4 f4\nz start\nu5 f5\nz end\nw start\nw end\nv start\nu6 f6\n")
    (tmp_path / "b").write_text("u7 f7\nv end\nt start\nu8 f8\nx end\nx end\nt end\n")
    found = text.in_closed_blocks(text.ordered_lines(spark, str(tmp_path)), chunk=chunk)
    assert sorted((r["id"], r["value"]) for r in found.collect()) == [("x", "u1 f1"), ("x", "u2 f2"), ("z", "u5 f5")]


def test_blocks_round_trip(spark, tmp_path):
    rows = [(f"i{i % 3}", f"http://h/{i}", f"d/{i}") for i in range(40)] + [("empty", None, None)]
    path = str(tmp_path / "blocks")
    ledgers.write_blocks(spark.createDataFrame(rows, "id string, url string, filename string"), path, rows=4)
    got = text.parse_manifest(text.in_closed_blocks(ledgers.ledger_lines(spark, path)))
    assert sorted((r["id"], r["url"], r["filename"]) for r in got.collect()) == sorted(rows[:-1])
    assert {r["id"] for r in text.parse_block_ends(ledgers.ledger_lines(spark, path)).collect()} == {"i0", "i1", "i2", "empty"}


def test_resume_of_ids(spark, tmp_path):
    path, ids = str(tmp_path / "done"), spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "id string")
    left = lambda: sorted(r["id"] for r in ledgers.remaining_ids(ids, path, text.parse_ids).collect())
    assert left() == ["a", "b", "c"]
    ledgers.write_ids(ids.where("id = 'b'"), path, done=False)
    assert left() == ["a", "c"]
    ledgers.write_ids(ids.where("id = 'a'"), path, keep=True)
    assert left() == []  # finished, whatever it holds


def test_verified_rows_replace_the_ledger(spark, tmp_path):
    path = str(tmp_path / "sums")
    files = spark.createDataFrame([("a", bytearray(b"1")), ("b", bytearray(b"2"))], "filename string, content binary")
    sums = files.select("filename", F.md5("content").alias("md5"))
    more = spark.createDataFrame([("gone", "00"), ("b", "11")], "filename string, md5 string")
    ledgers.write_checksums(sums.where("filename = 'a'").unionByName(more), path)
    audited = ledgers.keep_verified(spark, path, files)
    assert {(r["filename"], r["status"]) for r in audited.collect()} == {("a", "ok"), ("b", "mismatch"), ("gone", "missing")}
    left = text.parse_checksums(ledgers.ledger_lines(spark, path)).collect()
    assert [r["filename"] for r in left] == ["a"] and ledgers.is_done(spark, path)


def registry(spark, tmp_path, calls, version="1"):
    def of(name, deps=(), inputs=(), v=""):
        def build(s, t):
            calls.append(name)
            return s.range(1)

        return TableDef(name, build, deps, inputs=inputs, version=v)

    raw = [str(tmp_path / n) for n in ("raw1", "raw2")]
    return Registry(spark, str(tmp_path / "t"), str(tmp_path / "l")).add(
        of("a", (), (raw[0],)), of("b", (), (raw[1],), version), of("c", ("a",)), of("d", ("b", "c")), of("e", ("b",)))


def test_registry_follows_its_inputs(spark, tmp_path):
    (tmp_path / "raw1").mkdir()
    (tmp_path / "raw1" / "x").write_text("1")
    calls = []
    reg = registry(spark, tmp_path, calls)
    assert reg.stale() == reg.order("abcde")
    reg.build()
    assert sorted(calls) == list("abcde") and reg.stale() == []
    calls.clear()
    reg.build()
    assert calls == []
    (tmp_path / "raw1" / "y").write_text("2")
    assert reg.stale() == ["a", "c", "d"] and reg.stale(["e"]) == []
    reg.build(["d"])
    assert calls == ["a", "c", "d"] and reg.stale() == []
    calls.clear()
    time.sleep(0.01)
    (tmp_path / "raw1" / "y").write_text("3")  # same size, later time
    assert reg.stale(["c"]) == ["a", "c"]
    reg.build(["a"])
    assert calls == ["a"] and reg.stale() == ["c", "d"]  # what follows is known to be stale
    reg.build()
    calls.clear()
    (tmp_path / "raw2").write_text("now there")
    changed = registry(spark, tmp_path, calls)
    assert changed.stale() == ["b", "d", "e"]
    changed.build()
    again = registry(spark, tmp_path, calls, version="2")
    assert again.stale() == ["b", "d", "e"]


def test_registry_rebuilds_dependents(spark, tmp_path):
    calls = []
    reg = registry(spark, tmp_path, calls)
    reg.build(["d"])
    calls.clear()
    assert reg.rebuild(["a"]) == ["a", "c", "d"] == calls  # e was never built
    assert reg.dependents(["b"]) == ["d", "e"] and reg.stale(["d"]) == []
    (tmp_path / "t" / "_builds" / "c.json").unlink()
    assert reg.record("c") is None and reg.is_fresh("c")  # put there by other means


def test_tables_in_buckets(spark, tmp_path):
    schema = "mid string, n long"
    rows = lambda k: spark.range(200).selectExpr("concat('m', id % 50) AS mid", f"id * {k} AS n")
    made = [TableDef(n, lambda s, t, k=k: rows(k), (), schema=spark.createDataFrame([], schema).schema, buckets=("mid", 4))
            for n, k in (("x", 1), ("y", 2))]
    reg = Registry(spark, str(tmp_path), str(tmp_path)).add(*made)
    t = reg.build()
    joined = t["x"].hint("merge").join(t["y"].select("mid").distinct(), "mid")
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and joined.count() == 200
    assert len(list((tmp_path / "x").glob("part-*"))) == 4
    reg.build(["x"], overwrite=True)
    assert reg.read("x").count() == 200
    # a session that did not write the files, and one that takes them for plain Parquet
    assert Registry(spark.newSession(), str(tmp_path), str(tmp_path)).add(*made).read("x").count() == 200
    assert spark.read.parquet(str(tmp_path / "x")).count() == 200
