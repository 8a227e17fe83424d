"""The domain model over the driver tables.

Evidence items are orders: area = region, source = market segment, platform =
nation, rating = priority digit, retrieval type from the status. Engagement and
stakes come from the order's lines. Integer attributes without a column of their
own are taken from the key, so that every engine derives the same values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import table


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per item. The lines are summed before they meet the orders; nation
    and region are dimension tables that the planner broadcasts by their size."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("quantity"), F.count("*").alias("n_lines"), F.max((F.col("l_returnflag") == "R").cast("int")).alias("returned")
    )
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")
    people = customer.join(places, customer.c_nationkey == places.n_nationkey).select("c_custkey", "c_mktsegment", "n_name", "r_name")
    key = F.col("o_orderkey")
    return (
        orders.join(people, orders.o_custkey == people.c_custkey)
        .join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        .select(
            key.alias("item_id"),
            F.col("r_name").alias("area_id"),
            F.col("c_mktsegment").alias("source"),
            F.col("n_name").alias("platform"),
            F.col("o_custkey").alias("author"),
            F.when(key % 31 != 0, F.to_date("o_orderdate")).alias("day"),
            F.when(key % 7 != 0, F.substring("o_orderpriority", 1, 1).cast("int")).alias("rating"),
            F.when(F.col("o_orderstatus") == "F", "vague").when(F.col("o_orderstatus") == "O", "general").otherwise("not").alias("retrieval_type"),
            (key % 11).alias("relevance10"),
            (key % 6).cast("int").alias("frustration"),
            (1 + key % 5).cast("int").alias("strength"),
            (F.coalesce("returned", F.lit(0)) == 1).alias("high_stakes"),
            F.coalesce("quantity", F.lit(0)).alias("quantity"),
            F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
            (key % 97 == 0).alias("is_spam"),
            F.when(key % 5 != 0, key % 101).alias("confidence100"),
            F.when(key % 13 != 0, F.concat(F.lit("cat"), (key % 8).cast("string"))).alias("category"),
        )
    )


#: The same items in DuckDB SQL, as the head of an oracle.
EV = """
ln AS (SELECT l_orderkey, sum(l_quantity::BIGINT)::BIGINT AS quantity, count(*) AS n_lines, max((l_returnflag = 'R')::INT) AS returned FROM lineitem GROUP BY 1),
ev AS (
  SELECT o_orderkey AS item_id, r_name AS area_id, c_mktsegment AS source, n_name AS platform, o_custkey AS author,
    CASE WHEN o_orderkey % 31 <> 0 THEN o_orderdate::DATE END AS day,
    CASE WHEN o_orderkey % 7 <> 0 THEN left(o_orderpriority, 1)::INT END AS rating,
    CASE o_orderstatus WHEN 'F' THEN 'vague' WHEN 'O' THEN 'general' ELSE 'not' END AS retrieval_type,
    o_orderkey % 11 AS relevance10, (o_orderkey % 6)::INT AS frustration, (1 + o_orderkey % 5)::INT AS strength,
    coalesce(returned, 0) = 1 AS high_stakes, coalesce(quantity, 0) AS quantity, coalesce(n_lines, 0) AS n_lines,
    o_orderkey % 97 = 0 AS is_spam, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 101 END AS confidence100,
    CASE WHEN o_orderkey % 13 <> 0 THEN 'cat' || (o_orderkey % 8) END AS category
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN ln ON o_orderkey = l_orderkey)
"""


def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correction log: target, field, value by increasing override_id; an empty
    value clears."""
    e = table(spark, sf_dir, "events")
    value = F.when(F.col("event_id") % 9 == 0, "").otherwise(F.concat(F.lit("cat"), (F.col("event_id") % 8).cast("string")))
    return e.select(F.col("event_id").alias("override_id"), F.col("user_id").alias("target_id"), F.col("event_type").alias("field"), value.alias("value"))


OV = """
ov AS (SELECT event_id AS override_id, user_id AS target_id, event_type AS field,
  CASE WHEN event_id % 9 = 0 THEN '' ELSE 'cat' || (event_id % 8) END AS value FROM events)
"""
