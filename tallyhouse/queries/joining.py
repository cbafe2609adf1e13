"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import joins
from ..plans.attribution import sms_attribution
from ..session import cut_lineage
from ..sources import star
from . import event_sales
from .registry import CUST, ORDS, digits, query


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, o_totalprice
FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P')
  ON l_orderkey = o_orderkey
""")
def items_with_orders(spark, sf_dir) -> DataFrame:
    """Every line, with its order where that was kept."""
    orders = star.load(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").withColumnRenamed(
        "o_orderkey", "l_orderkey")
    return joins.lines_with_orders(star.load(spark, sf_dir, "lineitem"), orders,
                                   ["l_orderkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "o_totalprice")


@query(f"WITH {CUST} " + """
SELECT o_orderkey, k AS customer_id, phone, org FROM (
  SELECT *, CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_custkey AS VARCHAR) END AS k
  FROM orders) LEFT JOIN cust ON customer_id = k
""")
def orders_with_customers(spark, sf_dir) -> DataFrame:
    """Customer columns on each order; many orders have no customer."""
    orders = star.load(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "1-URGENT",
                             F.col("o_custkey").cast("string")).alias("customer_id"))
    return joins.with_customers(orders, star.customers(spark, sf_dir), ["customer_id"],
                                ["o_orderkey"]).select("o_orderkey", "customer_id", "phone",
                                                       "org")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, p_name, p_brand
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size < 40) ON l_partkey = p_partkey
""")
def lines_from_products(spark, sf_dir) -> DataFrame:
    """Product columns set from a table that repeats products."""
    part = star.load(spark, sf_dir, "part").where("p_size < 40").withColumnRenamed(
        "p_partkey", "l_partkey")
    twice = part.unionByName(part.withColumn("p_name", F.lit(None).cast("string")))
    lines = star.load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.fill_from_products(lines, twice, ["l_partkey"], ["p_name", "p_brand"])


@query(f"WITH {CUST} " + """
SELECT l_orderkey, l_linenumber, l_partkey, o_totalprice, phone
FROM lineitem JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey
LEFT JOIN cust ON customer_id = CASE WHEN o_orderpriority <> '1-URGENT'
  THEN CAST(o_custkey AS VARCHAR) END
""")
def complete_lines(spark, sf_dir) -> DataFrame:
    """Lines that have an order, with the customer if there is one."""
    orders = star.load(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_totalprice",
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey").cast("string"))
        .alias("customer_id"))
    return joins.complete_lines(star.load(spark, sf_dir, "lineitem"), orders,
                                star.customers(spark, sf_dir), ["l_orderkey"], ["customer_id"],
                                ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_totalprice", "phone")


@query("""
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)
""")
def customers_without_big_orders(spark, sf_dir) -> DataFrame:
    """Anti join."""
    big = star.load(spark, sf_dir, "orders").where("o_totalprice > 450000").select(
        F.col("o_custkey").alias("c_custkey"))
    return joins.only_new(star.load(spark, sf_dir, "customer"), big, ["c_custkey"]).select(
        "c_custkey", "c_name")


@query("""
SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)
  AS has_big_order FROM customer
""")
def flag_big_order_customers(spark, sf_dir) -> DataFrame:
    """Membership as a flag."""
    big = star.load(spark, sf_dir, "orders").where("o_totalprice > 450000").select(
        F.col("o_custkey").alias("c_custkey"))
    return joins.flag_listed(star.load(spark, sf_dir, "customer").select("c_custkey"), big,
                             "c_custkey", "has_big_order")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')
""")
def lines_of_listed_products(spark, sf_dir) -> DataFrame:
    """Semi join."""
    promo = star.load(spark, sf_dir, "part").where("p_type = 'PROMO'").select(
        F.col("p_partkey").alias("l_partkey"))
    return joins.only_listed(star.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey"), promo, ["l_partkey"])


@query("""
SELECT coalesce(v.user_id, p.user_id) AS user_id, views, purchases FROM
  (SELECT user_id, count(*) AS views FROM events WHERE event_type = 'view' AND value > 60
   GROUP BY 1) v FULL JOIN
  (SELECT user_id, count(*) AS purchases FROM events WHERE event_type = 'purchase' AND value > 60
   GROUP BY 1) p ON v.user_id = p.user_id
""")
def views_and_purchases(spark, sf_dir) -> DataFrame:
    """Full outer join of two histories."""
    e = star.load(spark, sf_dir, "events").where("value > 60")

    def count(kind, name):
        return e.where(F.col("event_type") == kind).groupBy("user_id").agg(
            F.count(F.lit(1)).alias(name))

    return joins.full_history(count("view", "views"), count("purchase", "purchases"), ["user_id"])


_TOUCH = """
SELECT p.event_id, p.user_id, p.ts, p.value,
  (SELECT max(ts) FROM events t WHERE t.user_id = p.user_id AND t.event_type IN ('view', 'click')
     AND t.ts < p.ts) AS last_touch_ts,
  (SELECT arg_max(event_type, ts) FROM events t WHERE t.user_id = p.user_id
     AND t.event_type IN ('view', 'click') AND t.ts < p.ts) AS last_touch_kind,
  (SELECT arg_max(value, ts) FROM events t WHERE t.user_id = p.user_id
     AND t.event_type IN ('view', 'click') AND t.ts < p.ts AND t.value > 20) AS last_touch_value
FROM events p WHERE p.event_type = 'purchase'
"""


def _touch(spark, sf_dir, bucket):
    e = star.load(spark, sf_dir, "events")
    orders = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    touches = e.where("event_type IN ('view', 'click')").select(
        "user_id", "ts", "event_id", "event_type",
        F.when(F.col("value") > 20, F.col("value")).alias("value"))
    return joins.last_touch(
        orders, touches, ["user_id"], order_time="ts", touch_time="ts",
        touch_columns={"last_touch_ts": "ts", "last_touch_kind": "event_type",
                       "last_touch_value": "value"},
        order_tie=["event_id"], touch_tie=["event_id"], bucket=bucket)


@query(_TOUCH)
def last_touch_join(spark, sf_dir) -> DataFrame:
    """As-of join: the latest touch before each purchase, hot users split by day."""
    return _touch(spark, sf_dir, "day")


@query(_TOUCH)
def last_touch_single_window(spark, sf_dir) -> DataFrame:
    """The same with one window per user, for data without hot keys."""
    return _touch(spark, sf_dir, None)


@query("""
WITH course AS (
  SELECT user_id, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
  FROM events WHERE event_type = 'signup'),
o AS (SELECT * FROM events WHERE event_type = 'purchase'
      AND user_id IN (SELECT user_id FROM course)),
b AS (
  SELECT o.event_id, o.user_id, o.ts,
    (SELECT max(n) FROM course c WHERE c.user_id = o.user_id AND c.ts < o.ts) AS ln,
    (SELECT min(n) FROM course c WHERE c.user_id = o.user_id AND c.ts >= o.ts) AS nn FROM o)
SELECT b.event_id, b.user_id, l.event_id AS last_course_id, coalesce(b.ln, 0) AS last_n_course,
  n.event_id AS next_course_id, b.nn AS next_n_course,
  date_diff('microsecond', l.ts, b.ts) / 86400000000.0 AS time_since_last_course,
  date_diff('microsecond', b.ts, n.ts) / 86400000000.0 AS time_to_next_course,
  coalesce(-date_diff('microsecond', b.ts, n.ts) / 86400000000.0,
           date_diff('microsecond', l.ts, b.ts) / 86400000000.0) AS time_normalized,
  coalesce(l.ts, n.ts) AS course_ts_utc
FROM b LEFT JOIN course l ON l.user_id = b.user_id AND l.n = b.ln
LEFT JOIN course n ON n.user_id = b.user_id AND n.n = b.nn
""", digits=digits(6, "time_since_last_course", "time_to_next_course", "time_normalized"))
def touch_both_ways(spark, sf_dir) -> DataFrame:
    """Previous and next course around each order."""
    e = star.load(spark, sf_dir, "events")
    orders = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    courses = e.where("event_type = 'signup'").select(
        "user_id", F.col("event_id").alias("course_id"), F.col("ts").alias("done"))
    out = joins.touch_both_ways(orders, courses, ["user_id"], order_time="ts", course_time="done",
                                course_id="course_id", order_tie=["event_id"], bucket="week",
                                stage=cut_lineage)
    return out.select("event_id", "user_id", "last_course_id", "last_n_course", "next_course_id",
                      "next_n_course", "time_since_last_course", "time_to_next_course",
                      "time_normalized", "course_ts_utc")


@query(f"WITH {event_sales.SMS_CTES} " + """
SELECT customer_id, order_id, is_24hr, is_72hr, is_7day, is_2wk, is_30day FROM credited
""")
def horizon_flags(spark, sf_dir) -> DataFrame:
    """Orders within one day to one month of the message before."""
    return sms_attribution(event_sales.messages(spark, sf_dir),
                           event_sales.campaigns(spark, sf_dir),
                           event_sales.population(spark, sf_dir), line_columns=[], stage=cut_lineage).select(
        "customer_id", "order_id", *[f"is_{h}" for h in joins.HORIZON_HOURS])


@query("""
SELECT p.p_partkey, m.label FROM (
  SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_type END AS t FROM part) p
LEFT JOIN (SELECT t, count(*) AS label FROM (
  SELECT CASE WHEN p_size % 2 = 0 THEN p_type END AS t FROM part) GROUP BY t) m
ON p.t IS NOT DISTINCT FROM m.t
""")
def null_safe_lookup(spark, sf_dir) -> DataFrame:
    """Lookup in which NULL finds NULL."""
    part = star.load(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") % 2 == 0, F.col("p_type")).alias("t"))
    counts = part.groupBy("t").agg(F.count(F.lit(1)).alias("label"))
    return joins.null_safe_lookup(part, counts, ["t"], ["label"]).select("p_partkey", "label")


@query(f"WITH {ORDS} " + """,
d AS (SELECT order_id, order_time_utc + to_seconds(600) AS s, order_time_utc + to_seconds(4200)
        AS e, CASE WHEN org = 'AMERICA' THEN 'America/New_York' ELSE 'UTC' END AS tz
      FROM ords WHERE order_type <> 'Other')
SELECT o.order_id,
  coalesce(strftime((s AT TIME ZONE 'UTC') AT TIME ZONE tz, '%Y-%m-%d %H:%M:%S'),
           '2000-01-01 00:00:00') AS delivery_order_started_local,
  strftime((e AT TIME ZONE 'UTC') AT TIME ZONE tz, '%Y-%m-%d %H:%M:%S')
    AS delivery_order_complete_local,
  CASE WHEN d.order_id IS NOT NULL THEN 60.0::DOUBLE END AS delivery_drive_minutes
FROM ords o LEFT JOIN d USING (order_id)
""")
def delivery_lookup(spark, sf_dir) -> DataFrame:
    """Delivery times by short id, else by full id, over the order's own."""
    o = star.orders(spark, sf_dir)
    lines = o.select("org", "order_id", F.concat(F.lit("s"), "order_id").alias("pos_short_order_id"),
                     F.lit("2000-01-01 00:00:00").alias("delivery_order_started_local"),
                     F.lit(None).cast("string").alias("delivery_order_complete_local"))
    short = F.col("order_type") == "Delivery"
    t = F.unix_timestamp("order_time_utc")
    deliveries = o.where("order_type <> 'Other'").select(
        "org", F.when(short, F.concat(F.lit("s"), "order_id")).otherwise(F.col("order_id"))
        .alias("pos_short_order_id"), F.timestamp_seconds(t + 9000).alias("created_at_utc"),
        F.timestamp_seconds(t + 600).alias("delivery_start_utc"),
        F.timestamp_seconds(t + 4200).alias("delivery_complete_utc"),
        F.when(F.col("org") == "AMERICA", "America/New_York").otherwise("UTC").alias("timezone"))
    # An earlier entry that gave a later end was corrected.
    first = deliveries.withColumns({
        "created_at_utc": F.col("created_at_utc") - F.expr("INTERVAL 1 HOUR"),
        "delivery_complete_utc": F.col("delivery_complete_utc") + F.expr("INTERVAL 2 HOURS")})
    return joins.lookup_deliveries(lines, deliveries.unionByName(first)).drop(
        "pos_short_order_id", "org")


@query(f"WITH {CUST} " + """,
one AS (SELECT org, customer_id, phone FROM cust WHERE org <> 'ASIA'),
two AS (SELECT org, customer_id, phone, balance FROM cust WHERE org <> 'EUROPE'),
shared AS (SELECT org, phone FROM one GROUP BY ALL HAVING count(*) > 1),
newest AS (SELECT org, phone, 'other_' || arg_max(customer_id, (balance, customer_id)) AS linked,
                  max(balance) AS balance
           FROM two ANTI JOIN shared USING (org, phone) GROUP BY org, phone)
SELECT one.customer_id, one.phone, linked AS other_customer_id FROM one LEFT JOIN newest
  USING (org, phone)
UNION ALL SELECT linked, phone, linked FROM newest ANTI JOIN one USING (org, phone)
""")
def merge_customer_systems(spark, sf_dir) -> DataFrame:
    """Second system's customers linked by phone or added with a prefixed id."""
    c = star.customers(spark, sf_dir).select("customer_id", "phone", "org", "balance")
    one = c.where("org <> 'ASIA'").select("org", "customer_id", "phone")
    two = c.where("org <> 'EUROPE'").select("org", "customer_id", "phone",
                                            F.col("balance").alias("last_updated_utc"))
    return joins.merge_customers(one, two).select("customer_id", "phone", "other_customer_id")


@query(f"WITH {CUST} " + """,
x AS (SELECT org, customer_id, phone, customer_id IN (SELECT CAST(o_custkey AS VARCHAR) FROM orders
        WHERE o_totalprice > 300000) AS bought FROM cust)
SELECT customer_id, phone, bought FROM x
WHERE bought OR (org, phone) NOT IN (SELECT (org, phone) FROM x WHERE bought)
""")
def drop_never_ordered_profiles(spark, sf_dir) -> DataFrame:
    """Profiles without an order whose phone is another buyer's."""
    big = star.load(spark, sf_dir, "orders").where("o_totalprice > 300000").select(
        F.col("o_custkey").cast("string").alias("customer_id"))
    c = joins.flag_listed(star.customers(spark, sf_dir).select("org", "customer_id", "phone"), big,
                          "customer_id", "bought")
    c = c.withColumn("last_order_facility", F.when(F.col("bought"), "shop"))
    return joins.drop_never_ordered_dupes(c).select("customer_id", "phone", "bought")


@query("""
SELECT coalesce(s.c, t.c) AS campaign_id, s.lo AS sent_at_utc, s.hi AS end_at_utc,
  t.total AS customers_reached, t.delivered / nullif(t.total, 0)::DOUBLE AS delivery_rate,
  t.opened / nullif(t.total, 0)::DOUBLE AS open_rate,
  t.clicked / nullif(t.total, 0)::DOUBLE AS click_rate
FROM (SELECT props->>'k' AS c, min(ts) AS lo, max(ts) AS hi FROM events
      WHERE event_type = 'signup' GROUP BY 1) s
FULL JOIN (SELECT props->>'k' AS c, count(*) FILTER (WHERE event_type <> 'signup') AS total,
       count(*) FILTER (WHERE event_type IN ('view', 'click', 'purchase')) AS delivered,
       count(*) FILTER (WHERE event_type = 'view') AS opened,
       count(*) FILTER (WHERE event_type = 'click') AS clicked
      FROM events WHERE value > 30 GROUP BY 1) t ON s.c = t.c
""", digits=digits(6, "delivery_rate", "open_rate", "click_rate"))
def email_delivery_stats(spark, sf_dir) -> DataFrame:
    """Send times with rates of the total; a total of 0 gives no rate."""
    e = star.load(spark, sf_dir, "events").withColumn("campaign_id",
                                                      F.get_json_object("props", "$.k"))
    kind = F.col("event_type")
    log = e.where("event_type = 'signup'").select("campaign_id", F.col("ts").alias("updated_at"))
    stats = e.where("value > 30").groupBy("campaign_id").agg(
        F.count_if(kind != "signup").alias("total"),
        F.count_if(kind.isin("view", "click", "purchase")).alias("delivered"),
        F.count_if(kind == "view").alias("opened"), F.count_if(kind == "click").alias("clicked"))
    return joins.email_delivery_stats(log, stats)


@query("""
SELECT u.user_id, d AS date FROM (SELECT DISTINCT user_id FROM events) u,
  (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30',
                                      INTERVAL 1 DAY)) AS DATE) AS d)
WHERE (u.user_id, d) NOT IN (SELECT (user_id, CAST(ts AS DATE)) FROM events)
""")
def missing_landing_dates(spark, sf_dir) -> DataFrame:
    """(key, day) pairs with nothing landed."""
    e = star.load(spark, sf_dir, "events")
    return joins.missing_dates(e.select("user_id").distinct(), e, ["user_id"], ts="ts",
                               first_day=F.lit("2024-01-01").cast("date"),
                               last_day=F.lit("2024-01-30").cast("date"))
