"""Bitmap id sets, exact quotas and counts taken while a table is written."""

import random
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from labtables.operators import idsets, quotas
from labtables.plans.registry import Registry, TableDef

IDS = [1, 2, 32_768, 32_769, 65_536, 65_537, 0, -1, -32_767, -32_768, -40_000, 10**12, 10**12 + 1]


def longs(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id long")


def test_id_sets(spark):
    a, b = idsets.id_set(longs(spark, IDS[:8] * 3 + [None]), "id"), idsets.id_set(longs(spark, IDS[5:]), "id")
    both = idsets.union(a, b)
    assert sorted(r["id"] for r in idsets.members(both).collect()) == sorted(IDS)
    assert idsets.size(both).first()["n"] == len(IDS) and idsets.size(a).first()["n"] == 8
    rows = longs(spark, IDS + [3, -2, 7 * 10**12, None]).withColumn("bits", F.lit("x"))
    left = idsets.not_in(rows, "id", a)
    assert left.columns == ["id", "bits"]
    assert {r["id"] for r in left.collect()} == set(IDS[8:]) | {3, -2, 7 * 10**12, None}
    none = idsets.id_set(longs(spark, []), "id")
    assert idsets.members(none).count() == 0 and idsets.size(none).first()["n"] == 0
    assert idsets.not_in(rows, "id", none).count() == rows.count()


def hashed(key, seed):
    return int(md5(f"{seed}:{key}".encode()).hexdigest()[:8], 16)


@pytest.mark.parametrize("bits", [32, 3])
def test_quotas_hold_exactly(spark, monkeypatch, bits):
    """With few bits of hash most keys are ties."""
    cut = lambda h: h & ~((1 << (32 - bits)) - 1)
    real = quotas.hash32
    monkeypatch.setattr(quotas, "hash32", lambda k, s: real(k, s).bitwiseAND(F.lit(cut((1 << 32) - 1))))
    rng = random.Random(3)
    rows = [(rng.choice("abbbc"), f"k{rng.randrange(400)}") for _ in range(1500)] + [("a", None), (None, "k"), ("one", "k1")]
    weights = {"a": (5, 3, 3), "b": (0.5, 0, 0.5), "one": (1, 1, 1), "absent": (1, 1, 1)}
    labels = ("x", "y", "z")
    got = quotas.with_quotas(spark.createDataFrame(rows, "s string, k string").repartition(4), "s", "k", weights, labels, seed=9)
    want = {}
    for s, w in weights.items():
        keys = sorted({k for t, k in rows if t == s and k}, key=lambda k: (cut(hashed(k, 9)), k))
        ends = [int(len(keys) * sum(w[:i + 1]) / sum(w) + 1e-9) for i in range(3)]
        for at, k in enumerate(keys):
            want[s, k] = labels[sum(at >= e for e in ends[:2])]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((s, k, want.get((s, k), "unused")) for s, k in rows), key=str)


def test_quotas_sort_no_stratum_as_a_whole(spark):
    keys = spark.range(1000).select(F.lit("a").alias("s"), F.col("id").cast("string").alias("k"))
    text = quotas.boundaries(keys, "s", "k", {"a": (1, 1)})._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in text.splitlines() if "Window" in line]
    numbered = [line for line in windows if "row_number" in line]
    assert numbered and all("[h#" in line or ", h#" in line for line in numbered)  # ties of one hash value only
    assert "Sort [" not in text


def test_metrics_are_taken_with_the_write(spark, tmp_path):
    evaluated = spark.sparkContext.accumulator(0)

    def build(s, _):
        def count(batches):
            for batch in batches:
                evaluated.add(len(batch))
                yield batch

        rows = s.range(100).mapInPandas(count, "id long")
        return rows.withColumn("reason", F.when(F.col("id") % 4 == 0, "bad").when(F.col("id") % 10 == 1, "odd"))

    reason = F.col("reason")
    metrics = (("rows", F.count(F.lit(1))), ("bad", F.count_if(reason.eqNullSafe("bad"))), ("odd", F.count_if(reason.eqNullSafe("odd"))))
    reg = Registry(spark, str(tmp_path), str(tmp_path)).add(TableDef("t", build, metrics=metrics), TableDef("u", lambda s, t: s.range(1)))
    assert reg.metrics("t") == {}
    reg.build()
    assert reg.metrics("t") == {"rows": 100, "bad": 25, "odd": 10} and reg.metrics("u") == {}
    assert evaluated.value == 100
    table = reg.read("t").groupBy("reason").count().collect()
    assert {r["reason"]: r["count"] for r in table} == {"bad": 25, "odd": 10, None: 65}
