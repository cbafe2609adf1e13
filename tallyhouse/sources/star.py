"""Adapter: a TPC-H-like star schema seen as retail sales.

Regions are organisations, nations are stores, suppliers sell at the counter.
Explicit schemas keep Spark from opening the files at planning time and read
timestamps as instants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.category import Rule, apply_rules

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                 "c_mktsegment string"),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp"),
    "events": ("event_id bigint, ts timestamp, user_id bigint, event_type string, value double, "
               "props string"),
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = T.StructType.fromDDL(TABLES[name])
    return spark.read.schema(schema).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The star's part types, given categories by the same kind of rule table the
# retail names use.
STAR_RULES = [Rule(category, "raw", f"^{word}$", "fill") for word, category in [
    ("economy", "EDIBLES"), ("small", "VAPES"), ("medium", "FLOWER"), ("promo", "PREROLLS"),
    ("standard", "EXTRACTS"), ("large", "DRINKS")]]

# Order priority as (order type, order source).
_TYPE = {"1-URGENT": "Delivery", "2-HIGH": "Retail", "3-MEDIUM": "Retail",
         "4-NOT SPECIFIED": "Retail", "5-LOW": "Other"}
_SOURCE = {"1-URGENT": "web", "2-HIGH": "Walk-In", "3-MEDIUM": "app", "5-LOW": "Unknown"}


def _priority(values: dict[str, str]):
    out = F.lit(None).cast("string")
    for key, value in values.items():
        out = F.when(F.col("o_orderpriority") == key, value).otherwise(out)
    return out


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location dimension: org, store and their ids."""
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        "n_nationkey", F.col("r_name").alias("org"), F.col("n_name").alias("store"),
        F.concat(F.lit("org-"), F.col("r_regionkey").cast("string")).alias("org_uuid"),
        F.concat(F.lit("store-"), F.col("n_nationkey").cast("string")).alias("store_id"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with contact data and their home store."""
    c = load(spark, sf_dir, "customer")
    s = stores(spark, sf_dir)
    key = F.col("c_custkey")
    text = key.cast("string")
    return c.join(s, c["c_nationkey"] == s["n_nationkey"]).select(
        "org_uuid", "org", "store_id", "store", text.alias("customer_id"),
        # Every ninth customer shares a phone with eight others.
        F.concat(F.lit("555"), F.when(key % 9 == 0, F.floor(key / 81)).otherwise(key)
                 .cast("string")).alias("phone"),
        F.when(key % 4 != 0, F.concat(F.lit("u"), text, F.lit("@example.com"))).alias("email"),
        F.col("c_name").alias("full_name"), F.col("c_mktsegment").alias("user_type"),
        F.substring("c_mktsegment", 1, 1).alias("gender"), F.col("c_acctbal").alias("balance"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order headers with customer and store."""
    o, c = load(spark, sf_dir, "orders"), customers(spark, sf_dir)
    o = o.select(F.col("o_orderkey").cast("string").alias("order_id"),
                 F.col("o_custkey").cast("string").alias("customer_id"),
                 # The date plus a made-up time of day that depends on the key.
                 F.timestamp_seconds(F.unix_timestamp("o_orderdate")
                                     + F.pmod(F.col("o_orderkey") * 7919, F.lit(43200)) + 28800)
                 .alias("order_time_utc"),
                 F.col("o_totalprice").alias("order_tot"), F.col("o_orderstatus").alias("status"),
                 _priority(_TYPE).alias("order_type"), _priority(_SOURCE).alias("order_source"))
    return o.join(c, "customer_id").withColumn("order_time_local", F.col("order_time_utc"))


def star_category(raw: Column) -> Column:
    return apply_rules(F.lower(raw), F.lit(None).cast("string"), rules=STAR_RULES)


def lines(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Order lines with product attributes, without the order; ``lineitem`` rows of one's own may have columns to ``keep``."""
    li, p = lineitem if lineitem is not None else load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "part")
    price, off = F.col("l_extendedprice"), F.col("l_discount")
    return li.join(p, li["l_partkey"] == p["p_partkey"]).select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        .alias("order_line_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.concat(F.lit("SKU"), F.col("l_partkey").cast("string")).alias("product_sku"),
        F.col("p_name").alias("product_name"), F.col("p_brand").alias("brand_name"),
        F.col("p_type").alias("raw_category_name"), F.col("l_quantity").alias("product_qty"),
        price.alias("item_list_price"), (-price * off).alias("item_discount"),
        (price * (1 - off)).alias("item_subtotal"),
        (price * (1 - off) * F.col("l_tax")).alias("item_tax"),
        (price * (1 - off) * (1 + F.col("l_tax"))).alias("item_total"),
        F.col("l_suppkey").cast("string").alias("sold_by_id"),
        (F.col("l_returnflag") == "R").alias("is_returned"),
        star_category(F.col("p_type")).alias("category3"), *keep)


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide order-line table: one row per line with order, customer and product."""
    return lines(spark, sf_dir).join(orders(spark, sf_dir), "order_id")


def order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order headers with subtotal and discount summed from their lines."""
    li = load(spark, sf_dir, "lineitem")
    sums = li.groupBy(F.col("l_orderkey").cast("string").alias("order_id")).agg(
        F.sum("l_extendedprice").alias("order_subtot"),
        (-F.sum(F.col("l_extendedprice") * F.col("l_discount"))).alias("order_disc"),
        F.min("l_suppkey").cast("string").alias("sold_by_id"))
    return orders(spark, sf_dir).join(sums, "order_id")
