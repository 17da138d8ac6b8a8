"""Joins, groups, sets and previews."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from labtables.operators import keys, quality
from labtables.plans.registry import preview, summary
from labtables.queries.base import query, table


@query("three_way_join", """
SELECT o_orderkey, o_totalprice, c_name, n_name FROM orders
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderstatus = 'F'
""")
def three_way_join(spark, d):
    orders, customer, nation = (table(spark, d, n) for n in ("orders", "customer", "nation"))
    return (
        orders.where(F.col("o_orderstatus") == "F")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_totalprice", "c_name", "n_name")
    )


def urgent(priorities: pd.Series) -> pd.Series:
    return priorities.str.split("-").str[0].astype(int) <= 2


@query("semi_valid", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem
WHERE l_orderkey IN (
  SELECT o_orderkey FROM orders WHERE CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) <= 2)
""")
def semi_valid(spark, d):
    orders = quality.filter_valid(table(spark, d, "orders"), "o_orderpriority", urgent)
    return keys.keep_matching(
        table(spark, d, "lineitem").select(
            F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_suppkey", "l_linenumber"
        ),
        orders, "o_orderkey",
    ).withColumnRenamed("o_orderkey", "l_orderkey")


@query("semi_fanout_compat", """
SELECT a.l_partkey, count(*) AS n FROM lineitem a JOIN lineitem b ON a.l_partkey = b.l_partkey
GROUP BY a.l_partkey
""")
def semi_fanout_compat(spark, d):
    # joining k rows with their k unmerged keys gives k * k rows; counted without making them
    counts = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("k"))
    return counts.select("l_partkey", (F.col("k") * F.col("k")).alias("n"))


@query("key_replace", """
SELECT o_orderkey, o_totalprice, c_name FROM orders JOIN customer ON o_custkey = c_custkey
""")
def key_replace(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.col("o_custkey").alias("c_custkey"))
    return keys.replace_key(orders, table(spark, d, "customer"), "c_custkey", "c_name")


@query("anti_rest", """
SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def anti_rest(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    done = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return keys.drop_matching(orders, done, "o_orderkey")


def viewed_and_bought(spark, d):
    events = table(spark, d, "events").select(
        "event_type", "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")
    )
    return events.where(F.col("event_type") == "view"), events.where(F.col("event_type") == "purchase")


@query("resume_todo", """
SELECT DISTINCT user_id, strftime(ts, '%Y-%m-%d') AS day FROM events WHERE event_type = 'view'
EXCEPT SELECT user_id, strftime(ts, '%Y-%m-%d') FROM events WHERE event_type = 'purchase'
""")
def resume_todo(spark, d):
    viewed, bought = viewed_and_bought(spark, d)
    return keys.remaining(viewed, bought, ["user_id", "day"])


@query("resume_progress", """
WITH todo AS (SELECT DISTINCT o_orderkey AS id FROM orders),
done AS (SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_returnflag = 'R')
SELECT (SELECT count(*) FROM done JOIN todo USING (id)) AS n_done, (SELECT count(*) FROM todo) AS n_all,
  round(100.0::DOUBLE * (SELECT count(*) FROM done JOIN todo USING (id)) / (SELECT count(*) FROM todo), 3)
  AS percent
""")
def resume_progress(spark, d):
    todo = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"))
    done = table(spark, d, "lineitem").where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("id"))
    return keys.progress(todo, done, "id")


@query("distinct_rows", """
SELECT DISTINCT l_returnflag, l_linestatus,
  CAST(l_linenumber AS VARCHAR) || ',' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS pair FROM lineitem
""")
def distinct_rows(spark, d):
    pair = F.array("l_linenumber", F.col("l_quantity").cast("int"))
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", pair.alias("pair")).distinct()
    return rows.withColumn("pair", F.array_join("pair", ","))


@query("count_all", "SELECT count(*) AS n FROM lineitem")
def count_all(spark, d):
    return table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("preview_top20", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20
""")
def preview_top20(spark, d):
    return preview(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"])


@query("state_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def state_counts(spark, d):
    return summary(table(spark, d, "events"), "event_type")


@query("status_priority_counts", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderstatus, o_orderpriority
""")
def status_priority_counts(spark, d):
    return summary(table(spark, d, "orders"), "o_orderstatus", "o_orderpriority")
