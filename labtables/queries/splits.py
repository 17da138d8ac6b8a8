"""Levels and splits on the event stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from labtables.functions.hashing import cutoffs
from labtables.operators import splits
from labtables.operators.quotas import with_quotas
from labtables.operators.sources import merge_sources, tag
from labtables.plans.registry import summary
from labtables.queries.base import query, table
from labtables.schemas import LIMITED_WEIGHTS, OVERALL_WEIGHTS, USAGES

SEED = 7


def hash_sql(key: str) -> str:
    return f"CAST('0x' || substr(md5('{SEED}:' || {key}), 1, 8) AS BIGINT)"


def label_sql(h: str, weights) -> str:
    a, b = cutoffs(weights)
    return f"CASE WHEN {h} < {a} THEN 'training' WHEN {h} < {b} THEN 'validation' ELSE 'testing' END"


def leveled(spark, d):
    events = table(spark, d, "events")
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("smiles"))
    customer = table(spark, d, "customer")
    spectra = events.select(
        F.col("user_id").cast("string").alias("mid"), F.col("event_id").cast("int").alias("index"),
        F.when(F.col("event_type") == "view", "gas").otherwise(F.col("event_type")).alias("state"),
    )
    mapping = customer.select(F.col("c_custkey").cast("string").alias("mid"), F.col("c_nationkey").alias("key")).join(
        nation, "key"
    )
    tagged = tag(table(spark, d, "supplier").select(F.col("s_nationkey").alias("key")), "supplier").unionByName(
        tag(customer.where(F.col("c_acctbal") > 9900).select(F.col("c_nationkey").alias("key")), "customer")
    )
    universe = merge_sources(tagged.join(nation, "key"), "smiles")
    return splits.with_levels(spectra, mapping, universe)


LEVEL_SQL = """
WITH tags AS (SELECT n_name, count(DISTINCT tag) AS n FROM (
    SELECT s_nationkey AS nk, 'supplier' AS tag FROM supplier UNION ALL
    SELECT c_nationkey, 'customer' FROM customer WHERE c_acctbal > 9900)
  JOIN nation ON nk = n_nationkey GROUP BY n_name),
lv AS (SELECT CAST(user_id AS VARCHAR) AS mid, CAST(event_id AS INTEGER) AS index,
    CASE WHEN event_type <> 'view' THEN 'unused' WHEN n > 1 THEN 'overall' ELSE 'limited' END AS level
  FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN tags USING (n_name)),
us AS (SELECT mid, index, level, CASE level WHEN 'overall' THEN """ + label_sql(hash_sql("mid"), OVERALL_WEIGHTS) + """
  WHEN 'limited' THEN """ + label_sql(hash_sql("mid"), LIMITED_WEIGHTS) + """ ELSE 'unused' END AS usage FROM lv)
"""


@query("usage_level", LEVEL_SQL + "SELECT mid, index, level FROM lv")
def usage_level(spark, d):
    return leveled(spark, d)


@query("usage_table", LEVEL_SQL + "SELECT mid, index, level, usage FROM us")
def usage_table(spark, d):
    return splits.with_usage(leveled(spark, d), SEED)


@query("usage_summary", LEVEL_SQL + "SELECT level, usage, count(*) AS n FROM us GROUP BY level, usage")
def usage_summary(spark, d):
    return summary(splits.with_usage(leveled(spark, d), SEED), "level", "usage")


@query("row_split", "SELECT event_id, " + label_sql(hash_sql("event_id"), OVERALL_WEIGHTS) + " AS usage FROM events")
def row_split(spark, d):
    label = splits.split_label(F.col("event_id"), OVERALL_WEIGHTS, SEED)
    return table(spark, d, "events").select("event_id", label.alias("usage"))


@query("group_split", "SELECT event_id, user_id, " + label_sql(hash_sql("user_id"), LIMITED_WEIGHTS)
       + " AS usage FROM events")
def group_split(spark, d):
    label = splits.split_label(F.col("user_id"), LIMITED_WEIGHTS, SEED)
    return table(spark, d, "events").select("event_id", "user_id", label.alias("usage"))


@query("split_repair", f"""
WITH l AS (SELECT event_id, user_id, {hash_sql("event_id")} AS h,
  {label_sql(hash_sql("event_id"), OVERALL_WEIGHTS)} AS u FROM events),
g AS (SELECT user_id, min(u) <> max(u) AS mixed, arg_min(u, h) AS pick FROM l GROUP BY user_id)
SELECT event_id, user_id, CASE WHEN mixed THEN pick ELSE u END AS usage FROM l JOIN g USING (user_id)
""")
def split_repair(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id")
    return splits.split_and_repair(events, F.col("event_id"), "user_id", OVERALL_WEIGHTS, SEED)


QUOTAS = {"view": (5, 3, 3), "click": (4, 1, 1), "purchase": (1, 0, 0)}


def quota_sql(place: str, n: str) -> str:
    cases = []
    for name, weights in QUOTAS.items():
        a, b, total = weights[0], weights[0] + weights[1], sum(weights)
        cases.append(f"WHEN event_type = '{name}' THEN CASE WHEN {place} < {n} * {a} // {total} THEN 'training' "
                     f"WHEN {place} < {n} * {b} // {total} THEN 'validation' ELSE 'testing' END")
    return f"CASE {' '.join(cases)} ELSE 'unused' END"


@query("exact_quotas", f"""
WITH u AS (SELECT DISTINCT event_type, CAST(user_id AS VARCHAR) AS mid FROM events),
p AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY {hash_sql('mid')}, mid) - 1 AS place,
  count(*) OVER (PARTITION BY event_type) AS n FROM u)
SELECT event_id, {quota_sql('place', 'n')} AS usage FROM events JOIN p USING (event_type)
WHERE CAST(events.user_id AS VARCHAR) = mid
""")
def exact_quotas(spark, d):
    """Users of each event type in shares that hold exactly; all events of a user and type go together."""
    events = table(spark, d, "events").select("event_id", "event_type", F.col("user_id").cast("string").alias("mid"))
    return with_quotas(events, "event_type", "mid", QUOTAS, USAGES, seed=SEED).select("event_id", "usage")


@query("exact_quota_counts", f"""
WITH p AS (SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('view', 'click') GROUP BY 1),
c AS (SELECT event_type, n * CASE event_type WHEN 'view' THEN 5 ELSE 4 END // CASE event_type WHEN 'view' THEN 11 ELSE 6 END AS a,
  n * CASE event_type WHEN 'view' THEN 8 ELSE 5 END // CASE event_type WHEN 'view' THEN 11 ELSE 6 END AS b, n FROM p)
SELECT event_type, 'training' AS usage, a AS n FROM c UNION ALL SELECT event_type, 'validation', b - a FROM c
UNION ALL SELECT event_type, 'testing', n - b FROM c
""")
def exact_quota_counts(spark, d):
    """Events of two types split 5:3:3 and 4:1:1 by their own id: rows per type and label."""
    events = table(spark, d, "events").select("event_type", F.col("event_id").cast("string").alias("key"))
    weights = {"view": OVERALL_WEIGHTS, "click": LIMITED_WEIGHTS}
    split = with_quotas(events.where(F.col("event_type").isin(*weights)), "event_type", "key", weights, USAGES, seed=SEED)
    return split.groupBy("event_type", "usage").agg(F.count(F.lit(1)).alias("n"))
