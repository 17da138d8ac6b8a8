"""Sinks, registry and the five tables from raw files to documents."""

import json
import sys
from pathlib import Path
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labtables.config import is_complete, shared_dir
from labtables.operators.enrich import enrich
from labtables.operators.quality import audit, verified
from labtables.operators.series import Grid
from labtables.plans.registry import Registry, TableDef, preview, summary
from labtables.plans.tables import Inputs, create_documents, rejects_table, tables
from labtables.sinks import files as sinks
from labtables.sinks.store import bulk_insert, insert_ignoring_duplicates


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def counting(name, calls, deps=(), large=False):
    def build(spark, t):
        calls.append(name)
        return spark.range(len(deps) + 1)

    return TableDef(name, build, deps, large)


def test_registry_builds_once_in_order(spark, tmp_path):
    calls = []
    reg = Registry(spark, str(tmp_path / "small"), str(tmp_path / "large")).add(
        counting("c", calls, ("a", "b")), counting("b", calls, ("a",), True), counting("a", calls),
    )
    assert reg.get_or_create("c").count() == 3 and calls == ["a", "b", "c"]
    reg.build()
    assert calls == ["a", "b", "c"] and (tmp_path / "large" / "b" / "_SUCCESS").exists()
    reg.build(["b"], overwrite=True)
    assert calls == ["a", "b", "c", "b"]
    with pytest.raises(KeyError, match="known: a, b, c"):
        reg.build(["d"])
    (tmp_path / "small" / "a" / "_SUCCESS").unlink()
    reg.get_or_create("a")
    assert calls[-1] == "a"


def test_registry_refuses_circles(spark, tmp_path):
    reg = Registry(spark, str(tmp_path), str(tmp_path)).add(counting("a", [], ("b",)), counting("b", [], ("a",)))
    with pytest.raises(ValueError, match="a > b > a"):
        reg.build()


def test_write_new_refuses_existing(spark, tmp_path):
    sinks.write_new(spark.range(2), str(tmp_path / "t"))
    assert is_complete(spark, str(tmp_path / "t"))
    with pytest.raises(AnalysisException):
        sinks.write_new(spark.range(2), str(tmp_path / "t"))


def test_json_export(spark, tmp_path):
    sinks.write_new(spark.range(3), str(tmp_path / "t"))
    assert sinks.export_json(spark, str(tmp_path), ["t", "none"]) == ["t"]
    assert sinks.export_json(spark, str(tmp_path), ["t"]) == []
    assert spark.read.json(str(tmp_path / "t.json")).count() == 3


def test_documents_as_json_leave_absent_fields_out(spark, tmp_path):
    df = spark.createDataFrame([("a", None, [1.0]), ("b", 2.0, None)], "_id string, mass double, vec array<double>")
    sinks.write_documents(df, str(tmp_path / "d"), as_json=True)
    docs = sorted(r["value"] for r in spark.read.text(str(tmp_path / "d")).collect())
    assert [json.loads(d) for d in docs] == [{"_id": "a", "vec": [1.0]}, {"_id": "b", "mass": 2.0}]
    sinks.write_documents(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2


def test_ledger(spark, tmp_path):
    path, schema = str(tmp_path / "ledger"), "filename string, md5 string"
    assert sinks.read_ledger(spark, path, schema).count() == 0
    for rows in ([("a", "1")], [("b", "2")]):
        sinks.append_ledger(spark.createDataFrame(rows, schema), path)
    assert sorted(map(tuple, sinks.read_ledger(spark, path, schema).collect())) == [("a", "1"), ("b", "2")]


def test_audit_of_files(spark, write):
    folder = str(Path(write("f/a", "one")).parent)
    write("f/b", "two")
    found = spark.read.format("binaryFile").load(folder).select(F.col("_metadata.file_name").alias("filename"), "content")
    ledger = spark.createDataFrame(
        [("a", "f97c5d29941bfb1b2fdab0874906ab82"), ("b", "0"), ("c", "0")], "filename string, md5 string"
    )
    status = audit(ledger, found)
    assert {r["filename"]: r["status"] for r in status.collect()} == {"a": "ok", "b": "mismatch", "c": "missing"}
    assert [r["filename"] for r in verified(status).collect()] == ["a"]


def test_bulk_insert_in_batches(spark, tmp_path):
    folder = tmp_path / "store"
    folder.mkdir()

    def open_writer():
        def write_batch(docs):
            assert len(docs) <= 3
            for d in docs:
                (folder / str(d["_id"])).write_text(json.dumps(d))

        return write_batch

    bulk_insert(spark.range(20).select(F.col("id").alias("_id"), F.struct("id").alias("n")), open_writer, batch=3)
    assert len(list(folder.iterdir())) == 20 and json.loads((folder / "7").read_text()) == {"_id": 7, "n": {"id": 7}}

    def failing():
        def write_batch(docs):
            raise OSError("store is down")

        return write_batch

    with pytest.raises(Exception, match="store is down"):
        bulk_insert(spark.range(2), failing)


def test_insert_ignoring_duplicates(spark, tmp_path):
    path, schema = str(tmp_path / "store"), "_id string, n int"
    for rows in ([("a", 1), ("a", 0)], [("a", 9), ("b", 2), ("b", 3)], [("b", 4)]):
        insert_ignoring_duplicates(spark, spark.createDataFrame(rows, schema), path, ["_id"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 0), ("b", 2)]


def test_parts_of_a_document_are_all_inserted(spark, tmp_path):
    path, schema = str(tmp_path / "store"), "_id string, part long, n int"
    (tmp_path / "store" / "_temporary").mkdir(parents=True)  # a first write that failed
    rows = [("a", 0, 1), ("a", 1, 2), ("a", 1, 3), ("b", 0, 4)]
    for _ in range(2):
        insert_ignoring_duplicates(spark, spark.createDataFrame(rows, schema), path)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 0, 1), ("a", 1, 2), ("b", 0, 4)]


def test_enrichment_sees_each_key_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def fn(keys):
        seen.add(len(keys))
        return pd.DataFrame({"n": keys.str.len()}, index=keys.index)[keys != "k0"]

    df = spark.createDataFrame([(i, f"k{i % 10}") for i in range(1000)] + [(-1, None)], "i int, k string")
    out = enrich(df, "k", fn, T.StructType([T.StructField("n", T.LongType())])).where("n > 0")
    assert out.count() == 900 and seen.value == 10


@pytest.mark.parametrize("setting", ["hdfs://shared/folder/", None])
def test_shared_dir_follows_the_session(setting):
    context = SimpleNamespace(master="local[2]" if setting is None else "yarn")
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting), sparkContext=context)
    first, second = shared_dir(session, "x"), shared_dir(session, "x")
    assert first != second and first.split("/x-")[0] == second.split("/x-")[0]
    assert setting is None or first.startswith("hdfs://shared/folder/x-")


def test_shared_dir_is_never_local_on_a_cluster():
    context = SimpleNamespace(master="local-cluster[2,1,1024]")
    with pytest.raises(ValueError):
        shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: None), sparkContext=context), "x")


def check(smiles: pd.Series) -> pd.Series:
    return ~smiles.str.contains("!")


def describe(smiles: pd.Series) -> pd.DataFrame:
    out = pd.DataFrame({"mass": smiles.str.len().astype(float), "ring": smiles.str.contains("c1")}, index=smiles.index)
    return out[~smiles.str.startswith("[")]


def series(state, ys="0 1 2 3 4"):
    return (
        f"##STATE={state}\n##FIRSTX=0\n##LASTX=40\n##NPOINTS=5\n##YFACTOR=0.1\n##XUNITS=1/CM\n##YUNITS=T\n"
        f"##XYDATA=(X++(Y..Y))\n0 {ys}\n##END=\n"
    )


def sdf(method):
    return f"mol\n> <METHOD>\n{method}\n\n> <IR.FREQUENCIES>\nfmt\n1 2\n3 4\n\n$$$$\n"


@pytest.fixture
def inputs(write):
    structures = write("all.smi", "CC m1\nc1ccccc1\tm2\nbad! m3\n[x] m4\nshort\n")
    aliases = write("dup.log", "Removed m5 - a duplicate of m1 (#1)\nRemoved m6 - a duplicate of m3 (#2)\n")
    for name, text in {
        "m1-0.jdx": series("gas"), "m1-1.jdx": series("liquid (neat)"), "m5-0.jdx": series("GAS", "0 0 0 0 0"),
        "m2-0.jdx": series("gas"), "m3-0.jdx": series("gas"), "m9-0.jdx": series("gas"),
        "m1-2.jdx": series("gas", "0 x"),
    }.items():
        folder = Path(write(f"digital/{name}", text)).parent
    for name in ("m1", "m5", "m9"):
        props = Path(write(f"sdf/{name}.sdf", sdf(f"B3 {name}"))).parent
    write("universe/gdb", "CC 1\nCCC\nCCC\n")
    more = Path(write("universe/zinc", "CCC\n[y]\n")).parent
    return Inputs(
        structures, aliases, str(folder), str(props), check, describe, str(more), flags=("ring",),
        grid=Grid(0, 40, 10), seed=3, check_tasks=2, enrich_tasks=2,
    )


def test_tables_and_documents(spark, inputs, tmp_path):
    reg = Registry(spark, str(tmp_path / "t"), str(tmp_path / "l")).add(*tables(inputs))
    built = reg.build()
    rows = {n: sorted(map(tuple, df.collect()), key=str) for n, df in built.items()}
    assert rows["structure_map"] == [("m1", "CC"), ("m2", "c1ccccc1"), ("m4", "[x]"), ("m5", "CC")]
    assert [(r[0], r[1], r[3], r[4]) for r in rows["measured"]] == [
        ("m1", 0, "gas", ""), ("m1", 1, "liquid", "(neat)"), ("m2", 0, "gas", ""), ("m5", 0, "gas", ""),
    ]
    assert rows["measured"][0][2] == pytest.approx([1, 0.9, 0.8, 0.7, 0.6])
    assert [r[:2] for r in rows["computed"]] == [("CC", "B3 m1"), ("CC", "B3 m5")]
    assert [(r[0], r[1], r[2][0], r[3]) for r in rows["universe"]] == [
        ("CC", 2.0, False, ["gdb", "nist"]), ("CCC", 3.0, False, ["gdb", "zinc"]), ("c1ccccc1", 8.0, True, ["nist"]),
    ]
    assert {(r[0], r[1]): r[2] for r in rows["usage"]} == {
        ("m1", 0): "overall", ("m1", 1): "unused", ("m2", 0): "limited", ("m5", 0): "overall",
    }
    docs = {d["_id"]: d for d in create_documents(reg).collect()}
    assert set(docs) == {"CC", "CCC", "c1ccccc1", "[x]"} and all(d["part"] == 0 for d in docs.values())
    cc = docs["CC"]
    assert cc["external_id"]["nist"] == ["m1", "m5"] and len(cc["expir"]) == 3
    assert [t["method"] for t in cc["thir"]] == ["B3 m1", "B3 m5"]
    assert [tuple(p) for p in cc["thir"][0]["freqs"]] == [(1.0, 2.0), (3.0, 4.0)]
    assert docs["CCC"]["expir"] is None and docs["[x]"]["mass"] is None and docs["[x]"]["external_id"]["nist"] == ["m4"]
    assert [r["n"] for r in summary(built["usage"], "level").collect()] == [2, 1, 1]
    rejects = reg.add(rejects_table(inputs)).get_or_create("rejects")
    assert sorted(map(tuple, rejects.collect())) == [
        ("aliases", "m6", "unresolved alias"), ("properties", "m9", "unknown id"),
        ("series", "m1-2.jdx", "bad number in data"), ("series", "m3-0.jdx", "unknown id"),
        ("series", "m9-0.jdx", "unknown id"), ("structures", "bad! m3", "failed check"),
        ("structures", "short", "too few tokens"), ("universe", "[x]", "failed enrichment"),
        ("universe", "[y]", "failed enrichment"),
    ]
    assert [r["mid"] for r in preview(built["structure_map"], ["mid"], 2).collect()] == ["m1", "m2"]
