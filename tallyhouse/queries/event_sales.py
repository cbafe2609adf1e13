"""Events as a message and sales history.

Orders and events do not overlap in time, so for attribution purchases are the
orders and other events the messages around them. Users are the customers of
the same number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import star
from .registry import CUST


def _with_customer(spark, sf_dir) -> DataFrame:
    e = star.load(spark, sf_dir, "events")
    c = star.customers(spark, sf_dir).select("customer_id", "org", "org_uuid", "store", "phone",
                                             "email")
    return e.join(c, e["user_id"].cast("string") == c["customer_id"])


def population(spark, sf_dir) -> DataFrame:
    """Purchases as one-line orders."""
    e = _with_customer(spark, sf_dir).where("event_type = 'purchase'")
    p = star.load(spark, sf_dir, "part")
    # Product keys run from 1 to the number of products.
    e = e.withColumn("__part", F.col("event_id") % p.agg(F.count(F.lit(1))).scalar() + 1)
    rows = e.join(p, F.col("__part") == p["p_partkey"])
    return rows.select(
        "org", "org_uuid", "customer_id", F.lit("till").alias("source_system"), "phone", "email",
        F.col("event_id").cast("string").alias("order_id"), F.lit("Retail").alias("order_type"),
        F.col("store").alias("order_facility"), F.col("ts").alias("order_time_utc"),
        F.col("ts").alias("order_time_local"), F.col("value").alias("order_total"),
        F.concat("event_id", F.lit("-1")).alias("order_line_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_brand").alias("brand_name"), F.lit("each").alias("product_uom"),
        F.lit(1.0).alias("product_unit_count"), F.lit(1.0).alias("product_qty"),
        F.col("p_type").alias("product_category_name"), F.lit("hybrid").alias("product_class"),
        F.col("value").alias("order_line_total"),
        star.star_category(F.col("p_type")).alias("category3"))


def messages(spark, sf_dir) -> DataFrame:
    """Views and clicks as messages out, signups and errors as replies."""
    e = _with_customer(spark, sf_dir).where("event_type <> 'purchase'")
    out = F.col("event_type").isin("view", "click")
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    return e.select(
        F.col("event_id").cast("string").alias("msg_id"), "org", "org_uuid",
        F.when(out, F.lit("short")).otherwise(F.col("phone")).alias("from"),
        F.when(out, F.col("phone")).otherwise("short").alias("to"),
        F.when(kind == "error", "STOP it").when(kind == "signup", "Yes, thanks")
        .otherwise(F.concat(F.lit("deal\n "), k)).alias("body"),
        F.col("ts").alias("date_sent"), out.alias("sent_from_messaging_service"),
        # One message in ten belongs to no campaign.
        F.when(F.col("event_id") % 10 != 0, F.concat(F.lit("c"), k)).alias("campaign_id"),
        (kind == "click").alias("is_mms"), F.lit(0.01).alias("price"),
        (F.col("event_id") % 3 + 1).cast("string").alias("num_segments"),
        F.when(F.col("event_id") % 8 == 0, "30003").alias("error_code"))


def campaigns(spark, sf_dir) -> DataFrame:
    """Campaigns seen in the messages; the even-numbered ones have a text."""
    m = messages(spark, sf_dir).where("campaign_id IS NOT NULL")
    number = F.substring("campaign_id", 2, 9).cast("int")
    return m.select("org", "campaign_id").distinct().withColumn(
        "campaign_body", F.when(number % 2 == 0, F.concat(F.lit("text  of "), "campaign_id")))


EVENT_CTES = CUST + """,
ec AS (SELECT e.*, c.customer_id, c.org, c.org_uuid, c.store, c.phone, c.email
       FROM events e JOIN cust c ON CAST(e.user_id AS VARCHAR) = c.customer_id),
epop AS (
  SELECT org, org_uuid, customer_id, phone, email, CAST(event_id AS VARCHAR) AS order_id,
         store AS order_facility, ts AS order_time_utc, value AS order_total,
         event_id || '-1' AS order_line_id, p_name AS product_name, p_brand AS brand_name,
         p_type AS product_category_name,
         CASE p_type WHEN 'ECONOMY' THEN 'EDIBLES' WHEN 'SMALL' THEN 'VAPES'
              WHEN 'MEDIUM' THEN 'FLOWER' WHEN 'PROMO' THEN 'PREROLLS'
              WHEN 'STANDARD' THEN 'EXTRACTS' WHEN 'LARGE' THEN 'DRINKS' END AS category3
  FROM ec, part WHERE event_id % (SELECT count(*) FROM part) + 1 = p_partkey
    AND event_type = 'purchase'),
emsg AS (
  SELECT CAST(event_id AS VARCHAR) AS msg_id, event_id, org, org_uuid, phone, ts AS date_sent,
         event_type IN ('view', 'click') AS outbound, event_type,
         CASE event_type WHEN 'error' THEN 'STOP it' WHEN 'signup' THEN 'Yes, thanks'
              ELSE 'deal ' || (props->>'k') END AS body,
         CASE WHEN event_id % 10 <> 0 THEN 'c' || (props->>'k') END AS campaign_id,
         event_type = 'click' AS is_mms, event_id % 3 + 1 AS segments,
         CASE WHEN event_id % 8 = 0 THEN '30003' END AS error_code
  FROM ec WHERE event_type <> 'purchase')"""

# Every order with the columns of the last message before it, each column from
# the last message that has it.
SMS_CTES = EVENT_CTES + """,
contact AS (SELECT DISTINCT customer_id, org, phone FROM epop),
gap AS (
  SELECT o.*, contact.phone, date_diff('day', CAST(lag(order_time_utc) OVER w AS DATE),
                                       CAST(order_time_utc AS DATE)) AS time_since_last_order
  FROM (SELECT DISTINCT org, customer_id, order_id, order_facility, order_time_utc, order_total
        FROM epop) o JOIN contact USING (customer_id, org)
  WINDOW w AS (PARTITION BY org, customer_id ORDER BY order_time_utc, order_id)),
sent AS (
  SELECT m.org, c.customer_id, m.campaign_id, m.date_sent,
         CASE WHEN m.campaign_id IS NOT NULL AND CAST(substr(m.campaign_id, 2) AS INTEGER) % 2 = 0
              THEN 'text of ' || m.campaign_id ELSE m.body END AS body
  FROM emsg m JOIN contact c ON c.org = m.org
    AND c.phone = CASE WHEN m.outbound THEN m.phone ELSE 'short' END),
touched AS (
  SELECT g.*,
    (SELECT max(date_sent) FROM sent s WHERE s.org = g.org AND s.customer_id = g.customer_id
       AND s.date_sent < g.order_time_utc) AS last_sms_date_sent,
    (SELECT arg_max(body, date_sent) FROM sent s WHERE s.org = g.org
       AND s.customer_id = g.customer_id AND s.date_sent < g.order_time_utc) AS last_sms_body,
    (SELECT arg_max(campaign_id, date_sent) FROM sent s WHERE s.org = g.org
       AND s.customer_id = g.customer_id AND s.date_sent < g.order_time_utc
       AND s.campaign_id IS NOT NULL) AS last_sms_campaign_id
  FROM gap g),
credited AS (
  SELECT t.*, order_time_utc - last_sms_date_sent <= INTERVAL 24 HOUR AS is_24hr,
         order_time_utc - last_sms_date_sent <= INTERVAL 72 HOUR AS is_72hr,
         order_time_utc - last_sms_date_sent <= INTERVAL 168 HOUR AS is_7day,
         order_time_utc - last_sms_date_sent <= INTERVAL 336 HOUR AS is_2wk,
         order_time_utc - last_sms_date_sent <= INTERVAL 720 HOUR AS is_30day,
         time_since_last_order >= 90 AS was_lost
  FROM touched t WHERE last_sms_body IS NOT NULL),
sms_lines AS (
  SELECT c.*, p.order_line_id, p.product_name, p.brand_name, p.product_category_name,
         p.category3, p.order_total AS order_line_total
  FROM credited c JOIN epop p USING (org, order_id))"""
