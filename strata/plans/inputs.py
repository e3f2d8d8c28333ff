"""Inputs derived from the test tables (region ... conversations) with Spark.

* purchases: lineitem with its order, customer, part and nation, in the purchase layout;
* reviews: the user turns of ``conversations``;
* review log XML: ``events`` rendered as one ``<log>`` element per row.

Joins are left to Catalyst and AQE: a side is broadcast only when its measured size is
under ``spark.sql.autoBroadcastJoinThreshold``; otherwise it is a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.xml import render_log

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The purchase layout, one row per lineitem.

    The order side (orders + customer + nation) is joined first, so that when nothing is
    small enough to broadcast the lineitem-sized data is shuffled twice (by order key, then
    by part key) rather than three times.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    order_side = (od.join(cu, od.o_custkey == cu.c_custkey)
                    .join(na, cu.c_nationkey == na.n_nationkey)
                    .select("o_orderkey", "o_orderdate", "c_custkey", "n_name"))
    return (li.join(order_side, li.l_orderkey == order_side.o_orderkey)
              .join(pa, li.l_partkey == pa.p_partkey)
              .select(F.col("o_orderkey").cast("string").alias("invoice_number"),
                      F.col("l_partkey").cast("string").alias("stock_code"),
                      F.col("p_name").alias("detail"),
                      F.col("l_quantity").cast("int").alias("quantity"),
                      F.col("o_orderdate").alias("invoice_date"),
                      F.col("p_retailprice").cast("decimal(8,3)").alias("unit_price"),
                      F.col("c_custkey").cast("int").alias("customer_id"),
                      F.col("n_name").alias("country")))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation turn as a review: ``(customer_id, review_id, review_text)``."""
    return (table(spark, sf_dir, "conversations")
            .select(F.col("conv_id").alias("customer_id"), F.col("turn").alias("review_id"),
                    F.col("text").alias("review_text")))


def review_log_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw review logs: ``(event_id, log)`` with ``log`` one XML element."""
    ev = table(spark, sf_dir, "events")
    fields = F.struct(F.col("ts").cast("string").alias("ts"), "user_id", "event_type", "value")
    return ev.select("event_id", render_log(fields).alias("log"))
