"""Attribution and campaign reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import campaigns as ops
from ..operators import contacts
from ..operators.joins import email_delivery_stats
from ..plans.attribution import email_attribution, sms_attribution
from ..session import cut_lineage
from ..sources import star
from . import event_sales
from .registry import EVENTS_AS_OF, digits, query

_HORIZONS = ("24hr", "72hr", "7day", "2wk", "30day")
_FLAGS = ", ".join(f"is_{h}" for h in _HORIZONS)
SMS = event_sales.SMS_CTES


def attributed(spark, sf_dir) -> DataFrame:
    return sms_attribution(event_sales.messages(spark, sf_dir),
                           event_sales.campaigns(spark, sf_dir),
                           event_sales.population(spark, sf_dir), stage=cut_lineage)


@query(f"WITH {SMS} " + f"""
SELECT org, customer_id, order_id, phone, time_since_last_order, last_sms_date_sent,
  last_sms_body, last_sms_campaign_id, {_FLAGS}, was_lost, order_line_id, product_name,
  order_line_total FROM sms_lines
""")
def sms_attribution_lines(spark, sf_dir) -> DataFrame:
    """Order lines credited to the last text message before them."""
    return attributed(spark, sf_dir).select(
        "org", "customer_id", "order_id", "phone", "time_since_last_order", "last_sms_date_sent",
        "last_sms_body", "last_sms_campaign_id", *[f"is_{h}" for h in _HORIZONS], "was_lost",
        "order_line_id", "product_name", "order_line_total")


def _emails(spark, sf_dir):
    """Outbound messages as emails, their campaigns as email campaigns."""
    out = event_sales.messages(spark, sf_dir).where("sent_from_messaging_service")
    mail = event_sales.population(spark, sf_dir).select("phone", "org", "email").distinct()
    sent = (out.where("campaign_id IS NOT NULL").withColumnRenamed("to", "phone")
            .join(mail, ["phone", "org"]).where("email IS NOT NULL")
            .select("campaign_id", "email", F.col("date_sent").alias("sent_at_utc")).distinct())
    info = out.where("campaign_id IS NOT NULL").select("campaign_id").distinct().select(
        "campaign_id", F.concat(F.lit("u-"), "campaign_id").alias("campaign_uuid"),
        F.concat(F.lit("hot \n"), "campaign_id").alias("email_subject"),
        F.when(F.substring("campaign_id", -1, 1) != "7", F.lit(" buy\n now ")).alias("email_body"),
        F.lit("p.png").alias("email_img_path"), F.lit(3).alias("email_template_id"))
    return sent, info


_EMAIL = event_sales.EVENT_CTES + """,
mail AS (SELECT DISTINCT customer_id, org, email, phone FROM epop WHERE email IS NOT NULL),
hop AS (SELECT DISTINCT m.campaign_id, l.email, m.date_sent FROM emsg m
        JOIN (SELECT DISTINCT phone, org, email FROM epop WHERE email IS NOT NULL) l
          ON l.org = m.org AND l.phone = m.phone
        WHERE m.outbound AND m.campaign_id IS NOT NULL),
sent AS (SELECT l.org, l.customer_id, h.campaign_id, h.date_sent,
           'u-' || h.campaign_id AS uuid, 'hot ' || h.campaign_id AS subject,
           CASE WHEN right(h.campaign_id, 1) <> '7' THEN 'buy now' END AS body
         FROM hop h JOIN (SELECT DISTINCT org, customer_id, email FROM mail) l USING (email)),
gap AS (SELECT o.*, l.email, date_diff('day', CAST(lag(order_time_utc) OVER w AS DATE),
          CAST(order_time_utc AS DATE)) AS time_since_last_order
  FROM (SELECT DISTINCT org, customer_id, order_id, order_time_utc, order_total FROM epop) o
  JOIN (SELECT DISTINCT org, customer_id, email FROM mail) l USING (org, customer_id)
  WINDOW w AS (PARTITION BY org, customer_id ORDER BY order_time_utc, order_id)),
touched AS (SELECT g.*,
    (SELECT max(date_sent) FROM sent s WHERE s.org = g.org AND s.customer_id = g.customer_id
       AND s.date_sent < g.order_time_utc) AS last_email_date_sent,
    (SELECT arg_max(uuid, date_sent) FROM sent s WHERE s.org = g.org
       AND s.customer_id = g.customer_id AND s.date_sent < g.order_time_utc)
       AS last_email_campaign_uuid,
    (SELECT arg_max(subject, date_sent) FROM sent s WHERE s.org = g.org
       AND s.customer_id = g.customer_id AND s.date_sent < g.order_time_utc)
       AS last_email_subject,
    (SELECT arg_max(body, date_sent) FROM sent s WHERE s.org = g.org
       AND s.customer_id = g.customer_id AND s.date_sent < g.order_time_utc
       AND s.body IS NOT NULL) AS last_email_body FROM gap g),
email_lines AS (
  SELECT t.*, p.product_name, p.brand_name, p.product_category_name, p.order_line_id,
         p.order_total AS order_line_total, """ + ", ".join(
    f"t.order_time_utc - last_email_date_sent <= INTERVAL {n} HOUR AS is_{h}"
    for h, n in zip(_HORIZONS, (24, 72, 168, 336, 720))) + """,
         time_since_last_order >= 90 AS was_lost
  FROM touched t JOIN epop p USING (org, order_id) WHERE last_email_body IS NOT NULL)"""


def _email_attributed(spark, sf_dir):
    sent, info = _emails(spark, sf_dir)
    return email_attribution(sent, info, event_sales.population(spark, sf_dir), stage=cut_lineage)


@query(f"WITH {_EMAIL} " + f"""
SELECT org, customer_id, order_id, last_email_date_sent, last_email_campaign_uuid,
  last_email_subject, last_email_body, {_FLAGS}, was_lost, order_line_total FROM email_lines
""")
def email_attribution_lines(spark, sf_dir) -> DataFrame:
    """Order lines credited to the last email before them."""
    return _email_attributed(spark, sf_dir).select(
        "org", "customer_id", "order_id", "last_email_date_sent", "last_email_campaign_uuid",
        "last_email_subject", "last_email_body", *[f"is_{h}" for h in _HORIZONS], "was_lost",
        "order_line_total")


def _messages(spark, sf_dir):
    """Messages with the length of their campaign's text."""
    m = event_sales.messages(spark, sf_dir)
    c = event_sales.campaigns(spark, sf_dir)
    return m.join(c, ["org", "campaign_id"], "left").withColumn(
        "text_length", F.length(F.coalesce("campaign_body", "body")))


def _org_config(spark, sf_dir):
    return star.stores(spark, sf_dir).select(
        "org", F.when(F.col("org").startswith("A"), 2.0).otherwise(3.0).alias("mms_ratio")
    ).distinct()


_DELIVERY = """
kinds AS (
  SELECT campaign_id, org, is_mms, count(DISTINCT phone) FILTER (WHERE error_code IS NULL)
      AS customers, coalesce(sum(segments) FILTER (WHERE error_code IS NULL), 0) AS texts,
    sum(segments) AS texts_sent, count(DISTINCT phone) AS customers_targeted,
    min(date_sent) AS first_text, max(date_sent) AS last_text,
    count(DISTINCT CAST(date_sent AS DATE)) AS days, count(*) * 0.01 AS price,
    max(CASE WHEN CAST(substr(campaign_id, 2) AS INTEGER) % 2 = 0
      THEN length('text  of ' || campaign_id) ELSE length(body) + 1 END) AS text_length
  FROM emsg WHERE outbound AND campaign_id IS NOT NULL GROUP BY ALL),
delivery AS (
  SELECT campaign_id, org, sum(customers)::BIGINT AS customers, sum(texts)::DOUBLE AS texts,
    sum(texts_sent)::DOUBLE AS texts_sent, sum(customers_targeted)::BIGINT AS customers_targeted,
    min(first_text) AS first_text, max(last_text) AS last_text, max(days) AS days,
    sum(price)::DOUBLE AS price, max(text_length)::BIGINT AS text_length, bool_or(is_mms) AS is_mms,
    sum(CASE WHEN is_mms THEN texts * (CASE WHEN org LIKE 'A%' THEN 2.0 ELSE 3.0 END)
             ELSE texts END)::DOUBLE AS billed_texts
  FROM kinds GROUP BY campaign_id, org),
delivery2 AS (
  SELECT *, price / nullif(customers, 0) AS cost_per_customer, customers < 3 AS is_single_text,
    days > 2 AS is_many_days, texts / nullif(texts_sent, 0) AS pct_delivered,
    customers / nullif(customers_targeted, 0)::DOUBLE AS pct_reached FROM delivery)"""
_DELIVERY_DIGITS = digits(6, "price", "cost_per_customer", "pct_delivered", "pct_reached")


@query(f"WITH {event_sales.EVENT_CTES}, {_DELIVERY} SELECT * FROM delivery2",
       digits=_DELIVERY_DIGITS)
def campaign_delivery(spark, sf_dir) -> DataFrame:
    """Customers, texts, billed texts, price and delivery rates per campaign."""
    return ops.campaign_delivery(_messages(spark, sf_dir), _org_config(spark, sf_dir)).withColumn(
        "text_length", F.col("text_length").cast("bigint"))


_STATE = """
state AS (
  SELECT phone, org_uuid, org,
    NOT (coalesce(max(date_sent) FILTER (WHERE event_type = 'error'), TIMESTAMP '1970-01-01')
       > coalesce(max(date_sent) FILTER (WHERE event_type = 'signup'), TIMESTAMP '1970-01-01'))
      AS is_subscribed,
    max(date_sent) FILTER (WHERE event_type = 'error') AS unsubscribed_at_utc,
    max(date_sent) FILTER (WHERE event_type = 'signup') AS resubscribed_at_utc,
    max(date_sent) FILTER (WHERE outbound) AS last_sms_engagement_utc,
    arg_max(body, date_sent) FILTER (WHERE outbound) AS last_msg_received,
    arg_max(CASE WHEN event_type = 'error' THEN 'stop it' ELSE 'yes thanks' END, date_sent)
      FILTER (WHERE NOT outbound) AS last_customer_resp,
    arg_max(campaign_id, date_sent) FILTER (WHERE outbound AND campaign_id IS NOT NULL)
      AS last_campaign_id,
    count(*) FILTER (WHERE outbound) AS tot_sms_received
  FROM emsg GROUP BY phone, org_uuid, org)"""
STATE_CTES = event_sales.EVENT_CTES + "," + _STATE


def sms_state(spark, sf_dir) -> DataFrame:
    """Message state with the organisation's name."""
    orgs = star.stores(spark, sf_dir).select("org_uuid", "org").distinct()
    return contacts.customer_sms(event_sales.messages(spark, sf_dir)).join(orgs, "org_uuid")


@query(f"WITH {STATE_CTES} " + """
SELECT org, last_campaign_id AS campaign_id, count(*) FILTER (WHERE NOT is_subscribed)
  AS unsubscribes FROM state GROUP BY ALL
""")
def campaign_opt_outs(spark, sf_dir) -> DataFrame:
    """Unsubscribed customers per last campaign."""
    return ops.campaign_opt_outs(sms_state(spark, sf_dir))


@query(f"WITH {STATE_CTES}, {_DELIVERY}, " + """
outs AS (SELECT org, last_campaign_id AS campaign_id, count(*) FILTER (WHERE NOT is_subscribed)
           AS unsubscribes FROM state GROUP BY ALL)
SELECT campaign_id, org, customers, unsubscribes,
  unsubscribes / nullif(customers, 0)::DOUBLE AS opt_out_rate
FROM delivery2 LEFT JOIN outs USING (campaign_id, org)
""", digits=digits(6, "opt_out_rate"))
def campaign_opt_out_rate(spark, sf_dir) -> DataFrame:
    """Opt-outs per reached customer."""
    delivery = ops.campaign_delivery(_messages(spark, sf_dir), _org_config(spark, sf_dir))
    outs = ops.campaign_opt_outs(sms_state(spark, sf_dir))
    return ops.with_opt_out_rate(delivery, outs).select("campaign_id", "org", "customers",
                                                        "unsubscribes", "opt_out_rate")


def _roi_sql(source: str, keys: str, group: str) -> str:
    cells = []
    for h in _HORIZONS:
        cells += [f"coalesce(sum(order_total) FILTER (WHERE is_{h}), 0) AS x{h}_roi",
                  f"count(DISTINCT customer_id) FILTER (WHERE is_{h}) AS x{h}_customers",
                  f"count(DISTINCT customer_id) FILTER (WHERE is_{h} AND was_lost) "
                  f"AS x{h}_recapture",
                  f"coalesce(sum(order_total) FILTER (WHERE is_{h} AND was_lost), 0) "
                  f"AS x{h}_recapture_sales"]
    return (f"SELECT {group}, {', '.join(cells)} FROM (SELECT DISTINCT {keys}, customer_id, "
            f"order_total, {_FLAGS}, was_lost FROM {source}) GROUP BY ALL")


_ROI_DIGITS = digits(4, *[f"x{h}_{n}" for h in _HORIZONS for n in ("roi", "recapture_sales")])
# Events span a month, so for the win-back columns a gap of three days is lost.
_SHORT = SMS.replace("time_since_last_order >= 90", "time_since_last_order >= 3")


@query(f"WITH {_SHORT} " + _roi_sql("sms_lines", "last_sms_campaign_id, org",
                                    "last_sms_campaign_id AS campaign_id, org"),
       digits=_ROI_DIGITS)
def campaign_roi(spark, sf_dir) -> DataFrame:
    """Sales, customers and win-backs per campaign in five horizons."""
    lines = attributed(spark, sf_dir).withColumn("was_lost",
                                                 F.col("time_since_last_order") >= 3)
    return ops.campaign_roi(lines, ["last_sms_campaign_id", "org"]).withColumnRenamed(
        "last_sms_campaign_id", "campaign_id")


@query(f"WITH {_SHORT}, {_DELIVERY}, {_STATE.strip()}, " + """
outs AS (SELECT org, last_campaign_id AS campaign_id, count(*) FILTER (WHERE NOT is_subscribed)
           AS unsubscribes FROM state GROUP BY ALL),
info AS (SELECT DISTINCT org, campaign_id,
           CASE WHEN CAST(substr(campaign_id, 2) AS INTEGER) % 2 = 0
                THEN 'text  of ' || campaign_id END AS body
         FROM emsg WHERE campaign_id IS NOT NULL),
roi AS (""" + _roi_sql("sms_lines", "last_sms_campaign_id, org",
                       "last_sms_campaign_id AS campaign_id, org") + """)
SELECT d.*, unsubscribes, unsubscribes / nullif(customers, 0)::DOUBLE AS opt_out_rate, body,
  roi.* EXCLUDE (campaign_id, org)
FROM delivery2 d LEFT JOIN outs USING (campaign_id, org) LEFT JOIN info USING (campaign_id, org)
LEFT JOIN roi USING (campaign_id, org) WHERE org <> 'ASIA'
""", digits={**_DELIVERY_DIGITS, **_ROI_DIGITS, **digits(6, "opt_out_rate")})
def sms_campaigns(spark, sf_dir) -> DataFrame:
    """Text campaigns with delivery, opt-outs, text and return."""
    lines = attributed(spark, sf_dir).withColumn("was_lost",
                                                 F.col("time_since_last_order") >= 3)
    roi = ops.campaign_roi(lines, ["last_sms_campaign_id", "org"]).withColumnRenamed(
        "last_sms_campaign_id", "campaign_id")
    delivery = ops.campaign_delivery(_messages(spark, sf_dir), _org_config(spark, sf_dir)).withColumn(
        "text_length", F.col("text_length").cast("bigint"))
    return ops.sms_campaigns(delivery, ops.campaign_opt_outs(sms_state(spark, sf_dir)),
                             event_sales.campaigns(spark, sf_dir), roi, hidden_orgs=("ASIA",))


@query(f"WITH {event_sales.EVENT_CTES}, " + """
failed AS (
  SELECT DISTINCT org, campaign_id, phone FROM emsg
  WHERE outbound AND date_sent >= TIMESTAMP '2024-01-21 00:00:00'
    AND (error_code IS NOT NULL OR (segments = 2 AND is_mms)))
SELECT org, campaign_id, phone, max(date_sent) AS timestamp
FROM emsg e WHERE outbound AND campaign_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM failed f WHERE f.org = e.org AND f.campaign_id = e.campaign_id
                  AND f.phone = e.phone)
GROUP BY ALL HAVING max(date_sent) >= TIMESTAMP '2024-01-11 00:00:00'
""")
def send_exclusions(spark, sf_dir) -> DataFrame:
    """Recipients that a campaign must not text again."""
    m = event_sales.messages(spark, sf_dir).where("sent_from_messaging_service")
    sent = m.where("campaign_id IS NOT NULL").groupBy(
        "org", "campaign_id", F.col("to").alias("phone")).agg(F.max("date_sent").alias("timestamp"))
    log = m.select("org", "campaign_id", "to", "msg_id", F.col("date_sent").alias("created_at_utc"),
                   F.when(F.col("error_code").isNull(), "200").otherwise("500").alias("http_code"))
    lost = (F.col("num_segments") == "2") & F.col("is_mms")
    carrier = m.select(F.col("msg_id").alias("id"), F.lit("outbound").alias("direction"),
                       F.when(lost, "delivery_failed").otherwise("delivered").alias("status"))
    return ops.keep_send_exclusions(sent, log, carrier, F.lit(EVENTS_AS_OF).cast("timestamp"),
                                    retry_hours=240, kept_hours=480)


_PRODUCT_CELLS = ", ".join(
    f"coalesce(sum(order_line_total) FILTER (WHERE is_{h}), 0) AS x{h}_roi, "
    f"count(*) FILTER (WHERE is_{h}) AS x{h}_orders" for h in _HORIZONS)


@query(f"WITH {SMS} " + f"""
SELECT last_sms_campaign_id, last_sms_body, product_name, category3, brand_name, org,
  {_PRODUCT_CELLS} FROM sms_lines GROUP BY ALL
""", digits=digits(4, *[f"x{h}_roi" for h in _HORIZONS]))
def product_roi(spark, sf_dir) -> DataFrame:
    """The same by product within campaign."""
    return ops.product_roi(attributed(spark, sf_dir), [
        "last_sms_campaign_id", "last_sms_body", "product_name", "category3", "brand_name", "org"])


@query(f"WITH {_EMAIL} " + f"""
SELECT last_email_campaign_uuid, last_email_subject, product_name, brand_name,
  {_PRODUCT_CELLS} FROM email_lines GROUP BY ALL
""", digits=digits(4, *[f"x{h}_roi" for h in _HORIZONS]))
def email_product_roi(spark, sf_dir) -> DataFrame:
    return ops.product_roi(_email_attributed(spark, sf_dir), [
        "last_email_campaign_uuid", "last_email_subject", "product_name", "brand_name"])


@query(f"WITH {_EMAIL}, roi AS (" + _roi_sql(
    "email_lines", "last_email_campaign_uuid", "last_email_campaign_uuid AS campaign_uuid")
    + """),
info AS (SELECT DISTINCT campaign_id FROM emsg WHERE outbound AND campaign_id IS NOT NULL),
log AS (SELECT campaign_id, min(date_sent) AS lo, max(date_sent) AS hi,
          count(*) FILTER (WHERE error_code IS NULL) AS total,
          count(*) FILTER (WHERE error_code IS NULL AND is_mms) AS opened
        FROM emsg WHERE outbound AND campaign_id IS NOT NULL AND segments > 1 GROUP BY 1)
SELECT campaign_id, 'u-' || campaign_id AS campaign_uuid, lo AS sent_at_utc,
  coalesce(total, 0) AS customers_reached, coalesce(opened / nullif(total, 0)::DOUBLE, 0)
    AS open_rate,
  CASE WHEN right(campaign_id, 1) <> '7' THEN length('hot ' || campaign_id) + 7 END AS text_length,
  r.x24hr_roi, r.x30day_customers
FROM info LEFT JOIN log USING (campaign_id)
LEFT JOIN roi r ON r.campaign_uuid = 'u-' || campaign_id
""", digits={**digits(4, "x24hr_roi"), **digits(6, "open_rate")})
def email_campaigns(spark, sf_dir) -> DataFrame:
    """Email campaigns with delivery rates and return."""
    m = event_sales.messages(spark, sf_dir).where(
        "sent_from_messaging_service AND campaign_id IS NOT NULL")
    m = m.where(F.col("num_segments").cast("int") > 1)
    ok = F.col("error_code").isNull()
    stats = m.groupBy("campaign_id").agg(
        F.count_if(ok).alias("total"), F.count_if(ok).alias("delivered"),
        F.count_if(ok & F.col("is_mms")).alias("opened"), F.lit(0).alias("clicked"))
    delivery = email_delivery_stats(m.withColumnRenamed("date_sent", "updated_at"), stats)
    roi = ops.campaign_roi(_email_attributed(spark, sf_dir), ["last_email_campaign_uuid"])
    info = _emails(spark, sf_dir)[1]
    out = ops.email_campaigns(info, delivery, roi.withColumnRenamed(
        "last_email_campaign_uuid", "campaign_uuid"))
    return out.select("campaign_id", "campaign_uuid", "sent_at_utc", "customers_reached",
                      "open_rate", "text_length", "x24hr_roi", "x30day_customers")


@query(f"WITH {event_sales.EVENT_CTES}, " + """
log AS (SELECT campaign_id, org, CASE WHEN error_code IS NULL THEN 200 ELSE 500 END AS http_code,
          count(*) AS send_logs_n, min(date_sent) AS start_log, max(date_sent) AS end_log
        FROM emsg WHERE outbound GROUP BY ALL),
seen AS (
  SELECT campaign_id, error_code, NULL AS carrier, count(*) AS sms_service_n,
         min(date_sent) AS start_sent, max(date_sent) AS end_sent, 'one' AS sms_service
  FROM emsg WHERE outbound AND campaign_id IS NOT NULL AND event_type = 'view' GROUP BY ALL
  UNION ALL
  SELECT campaign_id, error_code, CASE WHEN segments = 1 THEN 'acme' ELSE 'bell' END, count(*),
         min(date_sent), max(date_sent), 'two'
  FROM emsg WHERE outbound AND campaign_id IS NOT NULL AND event_type = 'click' GROUP BY ALL)
SELECT c.campaign_id, c.org, http_code, send_logs_n, start_log, end_log, sms_service, error_code,
       carrier, sms_service_n, start_sent, end_sent
FROM (SELECT DISTINCT org, campaign_id FROM emsg WHERE campaign_id IS NOT NULL) c
LEFT JOIN log USING (campaign_id, org) LEFT JOIN seen USING (campaign_id)
""")
def delivery_rates(spark, sf_dir) -> DataFrame:
    """Sends per campaign and status as logged and as two carriers saw them."""
    m = event_sales.messages(spark, sf_dir).where("sent_from_messaging_service")
    failed = F.col("error_code").isNotNull()
    log = m.select("campaign_id", "org", "msg_id", F.col("date_sent").alias("created_at_utc"),
                   F.when(failed, 500).otherwise(200).alias("http_code"),
                   F.lit("c").alias("http_status_category"),
                   F.lit("m").alias("http_status_message"),
                   F.when(F.col("is_mms"), "two").otherwise("one").alias("sms_service"))
    carrier = F.when(F.col("num_segments") == "1", "acme").otherwise("bell").alias("carrier")
    sent = ["msg_id", "date_sent", "error_code"]
    out = ops.delivery_rates(event_sales.campaigns(spark, sf_dir).select("org", "campaign_id"), log, {
        "one": m.where("NOT is_mms").select(*sent),
        "two": m.where("is_mms").select(*sent, carrier)})
    return out.drop("http_status_category", "http_status_message")
