"""Row order, ranking, sorting, set operations, pivots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import ordered, reshape
from ..operators.contacts import next_message_flag
from ..operators.joins import first_row_per_key
from ..sources import star
from . import event_sales
from .registry import ORDS, POP, digits, query


@query("""
SELECT o_orderkey, o_custkey, date_diff('day', lag(o_orderdate) OVER w, o_orderdate)
  AS days_since FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def days_since_previous_order(spark, sf_dir) -> DataFrame:
    """Lag over a customer's orders, hot customers split by year."""
    o = star.load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    out = ordered.fill_ordered(o, ["o_custkey"], ["o_orderdate", "o_orderkey"],
                               {"prev": "o_orderdate"}, include_current=False, bucket="year")
    return out.select("o_orderkey", "o_custkey",
                      F.datediff("o_orderdate", "prev").alias("days_since"))


@query(f"WITH {event_sales.EVENT_CTES} " + """
SELECT msg_id, coalesce(lead(NOT outbound AND event_type = 'error') OVER (
  PARTITION BY org_uuid, phone ORDER BY date_sent, event_id), false) AS next_is_stop FROM emsg
""")
def next_message_is_stop(spark, sf_dir) -> DataFrame:
    """Lead: is the customer's next message a request to stop?"""
    m = event_sales.messages(spark, sf_dir)
    rows = m.select("msg_id", "org_uuid", "date_sent",
                    F.when(F.col("sent_from_messaging_service"), F.col("to"))
                    .otherwise(F.col("from")).alias("phone"),
                    (F.col("body") == "STOP it").alias("stop"))
    return next_message_flag(rows, ["org_uuid", "phone"], ["date_sent", "msg_id"], "stop",
                             "next_is_stop", bucket="week").select("msg_id", "next_is_stop")


@query("""
SELECT event_id, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled_down,
  first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS filled_up
FROM (SELECT *, CASE WHEN event_type = 'view' THEN value END AS v FROM events)
""")
def fill_both_ways(spark, sf_dir) -> DataFrame:
    """Last known and next known value per user."""
    e = star.load(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") == "view", F.col("value"))
        .alias("v"))
    order = ["ts", "event_id"]
    down = ordered.fill_ordered(e, ["user_id"], order, {"filled_down": "v"}, bucket="day")
    both = ordered.fill_ordered(down, ["user_id"], order, {"filled_up": "v"}, direction="up",
                                bucket="day")
    return both.select("event_id", "filled_down", "filled_up")


@query("""
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (SELECT *, row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1
""")
def latest_order_per_customer(spark, sf_dir) -> DataFrame:
    """Latest row per key with a full tie-break."""
    o = star.load(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice",
                                                  "o_orderkey")
    return ordered.latest_row(o, ["o_custkey"], ["o_orderdate"])


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem JOIN (
  SELECT l_orderkey AS k, max(l_quantity) AS q FROM lineitem GROUP BY 1)
  ON l_orderkey = k AND l_quantity = q
""")
def largest_lines_with_ties(spark, sf_dir) -> DataFrame:
    """All rows at their group's maximum."""
    li = star.load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                     "l_quantity")
    return ordered.keep_at_max(li, ["l_orderkey"], "l_quantity")


@query("""
SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate,
  o_orderkey) AS n FROM orders
""")
def running_order_number(spark, sf_dir) -> DataFrame:
    """Running number in very large groups (five in all), split by month."""
    o = star.load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return ordered.number_rows(o, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], "n").select(
        "o_orderkey", "n")


@query(f"WITH {POP} " + """
SELECT org_uuid, category3, s AS spend, s / sum(s) OVER (PARTITION BY org_uuid) AS share
FROM (SELECT org_uuid, category3, sum(item_subtotal) AS s FROM pop GROUP BY ALL)
""", digits={**digits(2, "spend"), **digits(6, "share")})
def category_share_of_spend(spark, sf_dir) -> DataFrame:
    """Share of the group's total."""
    spend = (star.population(spark, sf_dir).groupBy("org_uuid", "category3")
             .agg(F.sum("item_subtotal").alias("spend")))
    return ordered.share_of_total(spend, ["org_uuid"], "spend", "share")


@query(f"WITH {ORDS} " + """
SELECT order_id, CAST(order_time_utc AS DATE) = min(CAST(order_time_utc AS DATE))
  OVER (PARTITION BY customer_id) AS is_first_order FROM ords
""")
def first_order_flag(spark, sf_dir) -> DataFrame:
    """Orders of the customer's first day."""
    o = star.orders(spark, sf_dir).select("order_id", "customer_id", "order_time_utc")
    return ordered.is_first_day(o, ["customer_id"], "order_time_utc", "is_first_order").select(
        "order_id", "is_first_order")


@query("""
SELECT o_orderkey, avg(o_totalprice) OVER w AS mean, stddev_samp(o_totalprice) OVER w AS sd
FROM orders WINDOW w AS (PARTITION BY o_custkey)
""", digits=digits(4, "mean", "sd"))
def customer_mean_on_orders(spark, sf_dir) -> DataFrame:
    """Group mean and deviation kept on rows."""
    o = star.load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return ordered.with_group_stats(
        o, ["o_custkey"], F.avg("o_totalprice").alias("mean"),
        F.stddev_samp("o_totalprice").alias("sd")).select("o_orderkey", "mean", "sd")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, n AS suppliers FROM lineitem JOIN (
  SELECT l_partkey AS k, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1) ON l_partkey = k
""")
def suppliers_per_product_on_lines(spark, sf_dir) -> DataFrame:
    """Distinct count kept on rows."""
    li = star.load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                     "l_suppkey")
    return ordered.with_group_stats(
        li, ["l_partkey"], F.count_distinct("l_suppkey").alias("suppliers")).drop("l_suppkey")


@query("SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY 2, 3 DESC, 1")
def sorted_customers(spark, sf_dir) -> DataFrame:
    """Sort by keys up and down."""
    c = star.load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return c.orderBy(F.col("c_mktsegment").asc(), F.col("c_acctbal").desc(), "c_custkey")


@query("""
SELECT l_partkey, l_orderkey, l_extendedprice FROM (SELECT *, row_number() OVER (
  PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rn
  FROM lineitem) WHERE rn = 1
""")
def first_row_per_product(spark, sf_dir) -> DataFrame:
    """First row per key after a sort."""
    li = star.load(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber",
                                                     "l_extendedprice")
    return first_row_per_key(li, ["l_partkey"], [
        F.col("l_extendedprice").desc(), F.col("l_orderkey").asc(),
        F.col("l_linenumber").asc()]).drop("l_linenumber")


@query("SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def distinct_sold_pairs(spark, sf_dir) -> DataFrame:
    """Distinct rows."""
    return star.load(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey",
                                                       "l_returnflag").distinct()


@query("""
SELECT 'customer' AS side, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment
FROM customer UNION ALL SELECT 'supplier', s_name, s_acctbal, NULL FROM supplier
""")
def stacked_parties(spark, sf_dir) -> DataFrame:
    """Union all by name; missing columns are NULL."""
    c = star.load(spark, sf_dir, "customer").select(
        F.lit("customer").alias("side"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = star.load(spark, sf_dir, "supplier").select(
        F.lit("supplier").alias("side"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"))
    return reshape.stack(c, s)


@query("""
SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier
""")
def nations_of_either(spark, sf_dir) -> DataFrame:
    """Union of distinct rows."""
    return reshape.stack_distinct(
        star.load(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")),
        star.load(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation")))


@query("""
SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem
WHERE l_returnflag = 'R' AND l_quantity > 47
""")
def never_returned_products(spark, sf_dir) -> DataFrame:
    """Set difference."""
    return reshape.minus(
        star.load(spark, sf_dir, "part").select("p_partkey"),
        star.load(spark, sf_dir, "lineitem").where("l_returnflag = 'R' AND l_quantity > 47").select(
            F.col("l_partkey").alias("p_partkey")))


@query("""
SELECT o_custkey, coalesce(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 0) AS spend_F,
  coalesce(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 0) AS spend_O,
  0.0::DOUBLE AS spend_X FROM orders GROUP BY o_custkey
""", digits=digits(2, "spend_F", "spend_O", "spend_X"))
def pivot_spend_by_status(spark, sf_dir) -> DataFrame:
    """Pivot on fixed levels, one of which the data lacks."""
    spend = (star.load(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderstatus")
             .agg(F.sum("o_totalprice").alias("s")))
    return reshape.pivot_levels(spend, ["o_custkey"], "o_orderstatus", ["F", "O", "X"],
                                F.col("s"), prefix="spend_", fill=0.0)


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, kind, amount FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, 'l_discount' AS kind, l_discount AS amount
  FROM lineitem UNION ALL
  SELECT l_orderkey, l_linenumber, l_partkey, 'l_tax', l_tax FROM lineitem)
""")
def unpivot_rates(spark, sf_dir) -> DataFrame:
    """Columns to rows."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    li = star.load(spark, sf_dir, "lineitem").select(*keys, "l_discount", "l_tax")
    return reshape.unpivot_columns(li, keys, ["l_discount", "l_tax"], "kind", "amount")


@query("""
SELECT 'till' AS pos, l_shipdate AS snapshot_utc, CAST(l_partkey AS VARCHAR) AS product_id,
       l_quantity AS units FROM lineitem
WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem)
UNION ALL SELECT 'web', date_trunc('day', ts)::TIMESTAMP, CAST(event_id AS VARCHAR), NULL
FROM events WHERE date_trunc('day', ts) = (SELECT max(date_trunc('day', ts)) FROM events)
""")
def stacked_snapshots(spark, sf_dir) -> DataFrame:
    """Latest snapshots of two systems in one layout."""
    till = star.load(spark, sf_dir, "lineitem").withColumnRenamed("l_shipdate", "snapshot_utc")
    web = star.load(spark, sf_dir, "events").withColumn("snapshot_utc", F.date_trunc("day", "ts"))
    return reshape.stack_snapshots({
        "till": (till, {"snapshot_utc": "snapshot_utc",
                        "product_id": F.col("l_partkey").cast("string"), "units": "l_quantity"}),
        "web": (web, {"snapshot_utc": "snapshot_utc",
                      "product_id": F.col("event_id").cast("string")})}, ts="snapshot_utc")
