"""Relational queries over the driver's tables. They have no counterpart in the reference, which has no queries.

All are plain DataFrame operations: filters and columns reach the scans, dimension tables are left to Spark's
own size-checked broadcasts, and money sums are decimals, so that no result depends on the order of addition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brindle.sources.tables import table


def _cents(value: Column) -> Column:
    """A money amount as a whole number of cents."""
    return F.round(value * 100).cast("long")


def b0_revenue_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Star join: revenue, orders and line items by region and year of shipment."""
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", _cents(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("cents"), F.year("l_shipdate").cast("long").alias("year")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    place = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    # One row per order and year before the joins: they move orders, not line items.
    sums = line.groupBy("l_orderkey", "year").agg(F.sum("cents").alias("cents"), F.count(F.lit(1)).alias("lines"))
    met = sums.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(place, F.col("o_custkey") == F.col("c_custkey"))
    return met.groupBy(F.col("r_name").alias("region"), "year").agg(
        F.sum("cents").alias("revenue_cents"), F.count(F.lit(1)).alias("n_order_years"), F.sum("lines").alias("n_lines")
    )


def b2_pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped sums with a date filter."""
    line = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return line.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("sum_qty"), F.sum(_cents(F.col("l_extendedprice"))).alias("sum_cents"),
        F.count(F.lit(1)).alias("n"), F.count_distinct("l_suppkey").alias("suppliers"),
    )


def b3_customers_without_urgent_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anti join, by nation."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT").select("o_custkey")
    lone = table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti")
    return lone.groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("customers"))


def b5_orders_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollup over status and priority."""
    orders = table(spark, sf_dir, "orders")
    return orders.rollup("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum(_cents(F.col("o_totalprice"))).alias("cents"))


def b6_running_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user and event: its rank, the type of the event before it, and how many of the last five there are."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return events.select(
        "event_id", F.row_number().over(w).cast("long").alias("nth"),
        F.lag("event_type").over(w).alias("previous_type"),
        F.count(F.lit(1)).over(w.rowsBetween(-4, 0)).alias("last_five"),
    )


def b7_top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three largest orders of each customer's nation."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    met = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    w = Window.partitionBy("c_nationkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    ranked = met.withColumn("place", F.row_number().over(w).cast("long")).where("place <= 3")
    return ranked.select(F.col("c_nationkey").alias("nation"), "place", "o_orderkey")


def b12_event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of JSON properties by event type."""
    events = table(spark, sf_dir, "events").select("event_type", F.json_object_keys("props").alias("keys"))
    return events.select("event_type", F.explode("keys").alias("prop")).groupBy("event_type", "prop").agg(F.count(F.lit(1)).alias("n"))


def b13_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions per user with gaps of an hour."""
    events = table(spark, sf_dir, "events").select("user_id", "ts")
    sessions = events.groupBy("user_id", F.session_window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return sessions.groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.max("n").alias("longest"))


QUERIES = {f.__name__: f for f in (b0_revenue_by_region, b2_pricing_summary, b3_customers_without_urgent_orders, b5_orders_rollup, b6_running_value, b7_top_orders, b12_event_props, b13_sessions)}
ORACLE_SQL = {
    "b0_revenue_by_region": """
        WITH sums AS (
            SELECT l_orderkey, year(l_shipdate) AS year, CAST(sum(CAST(round(l_extendedprice * (1 - l_discount) * 100) AS BIGINT)) AS BIGINT) AS cents,
                   count(*) AS lines FROM lineitem GROUP BY ALL)
        SELECT r_name AS region, year, CAST(sum(cents) AS BIGINT) AS revenue_cents, count(*) AS n_order_years, CAST(sum(lines) AS BIGINT) AS n_lines
        FROM sums JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
    "b2_pricing_summary": """
        SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sum_qty,
               CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS sum_cents, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers
        FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""",
    "b3_customers_without_urgent_orders": """
        SELECT c_nationkey AS nation, count(*) AS customers FROM customer
        WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') GROUP BY ALL""",
    "b5_orders_rollup": """
        SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
        FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""",
    "b6_running_value": """
        SELECT event_id, row_number() OVER w AS nth, lag(event_type) OVER w AS previous_type,
               count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS last_five
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "b7_top_orders": """
        SELECT c_nationkey AS nation, row_number() OVER (PARTITION BY c_nationkey ORDER BY o_totalprice DESC, o_orderkey) AS place, o_orderkey
        FROM orders JOIN customer ON o_custkey = c_custkey QUALIFY place <= 3""",
    "b12_event_props": """
        SELECT event_type, prop, count(*) AS n FROM (SELECT event_type, unnest(json_keys(props)) AS prop FROM events) GROUP BY ALL""",
    "b13_sessions": """
        WITH gaps AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 1 HOUR THEN 0 ELSE 1 END AS begins FROM events),
        numbered AS (SELECT user_id, sum(begins) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM gaps),
        sessions AS (SELECT user_id, s, count(*) AS n FROM numbered GROUP BY ALL)
        SELECT user_id, count(*) AS sessions, max(n) AS longest FROM sessions GROUP BY ALL""",
}
