"""Keyed table maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagesmith.operators import keyed as K

from .common import table


def item_lookup(spark, sf):
    requests = table(spark, sf, "events").select("event_id", F.col("user_id").alias("id"))
    items = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return K.lookup(requests, items).withColumn("found", F.col("found").cast("int"))


def _appended(spark, sf):
    items = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("").alias("description")
    )
    incoming = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name"), F.col("c_mktsegment").alias("description")
    )
    return K.append(items, incoming, "c_custkey")


def items_append(spark, sf):
    return _appended(spark, sf)[0]


def items_append_rejects(spark, sf):
    return _appended(spark, sf)[1].select("c_custkey", "reason")


def _updated(spark, sf):
    items = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("description")
    )
    changes = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_size") > 25, F.col("p_name")).alias("name"),
        F.when(F.col("p_type") != "ECONOMY", F.col("p_type")).alias("description"),
    )
    return K.update(items, changes, ["name", "description"])


def items_update(spark, sf):
    return _updated(spark, sf)[0]


def items_update_rejects(spark, sf):
    return _updated(spark, sf)[1].select("id", "reason")


def items_delete(spark, sf):
    items = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    ids = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("id"))
    return K.delete(items, ids)


QUERIES = {
    f.__name__: f
    for f in (item_lookup, items_append, items_append_rejects, items_update, items_update_rejects, items_delete)
}

ORACLE = {
    "item_lookup": """
SELECT event_id, user_id AS id, s_name AS name, CASE WHEN s_suppkey IS NULL THEN 0 ELSE 1 END AS found
FROM events LEFT JOIN supplier ON s_suppkey = user_id""",
    "items_append": """
SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY c_custkey) AS id, c_name AS name, c_mktsegment AS description
FROM customer WHERE c_acctbal >= 0""",
    "items_append_rejects": "SELECT c_custkey, 'name_required' AS reason FROM customer WHERE c_acctbal < 0",
    "items_update": """
SELECT c_custkey AS id, CASE WHEN p_size > 25 THEN p_name ELSE c_name END AS name,
       CASE WHEN p_type <> 'ECONOMY' THEN p_type ELSE c_mktsegment END AS description
FROM customer LEFT JOIN part ON p_partkey = c_custkey""",
    "items_update_rejects": """
SELECT p_partkey AS id, 'unknown_id' AS reason FROM part WHERE p_partkey NOT IN (SELECT c_custkey FROM customer)""",
    "items_delete": """
SELECT o_orderkey AS id, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
}
