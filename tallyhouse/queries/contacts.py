"""Opt-in status, message state, marketing lists, phones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import contacts as ops
from ..operators.reshape import checked_in_customers as check_in_list
from ..session import cut_lineage
from ..sources import star
from .campaigns import STATE_CTES, sms_state
from .customers import BEHAVIOR_CTES, behavior
from .registry import CUST, EVENTS_AS_OF, at, digits, query


@query(f"WITH {STATE_CTES} SELECT * EXCLUDE (org) FROM state")
def customer_sms_state(spark, sf_dir) -> DataFrame:
    """Subscription, last messages and counts after the whole history."""
    return sms_state(spark, sf_dir).drop("org")


_OPTIN = f"""WITH {STATE_CTES},
src AS (
  SELECT org_uuid AS orguuid, phone, CASE WHEN is_subscribed THEN resubscribed_at_utc
           ELSE unsubscribed_at_utc END AS ts,
         CASE WHEN is_subscribed THEN 'opt_in' ELSE 'opt_out' END AS status,
         'sms_response' AS channel, 0 AS rk
  FROM state WHERE unsubscribed_at_utc IS NOT NULL OR resubscribed_at_utc IS NOT NULL
  UNION ALL
  SELECT org_uuid, phone, TIMESTAMP '2001-01-01', 'opt_in', 'custom_code', 1 FROM cust
  WHERE user_type = 'BUILDING'
  UNION ALL
  SELECT org_uuid, phone, TIMESTAMP '2001-02-01', 'opt_in', 'webhook', 2 FROM cust
  WHERE user_type = 'MACHINERY'
  UNION ALL
  SELECT org_uuid, phone, TIMESTAMP '2001-03-01', CASE WHEN balance > 0 THEN 'opt_in'
           ELSE 'opt_out' END, 'file_import', 3 FROM cust WHERE user_type = 'FURNITURE'
  UNION ALL
  SELECT org_uuid, phone, t, arg_max(s, s), 'pos', 4 FROM (
    SELECT *, max(t) OVER (PARTITION BY org_uuid, phone) AS tm FROM (
      SELECT org_uuid, phone, TIMESTAMP '1990-01-01' + to_seconds(CAST(balance AS BIGINT)) AS t,
             CASE WHEN balance > 5000 THEN 'opt_in' ELSE 'opt_out' END AS s FROM cust))
  WHERE t = tm GROUP BY ALL)
SELECT DISTINCT orguuid, phone, ts, status, channel FROM (
  SELECT *, min(rk) OVER (PARTITION BY orguuid, phone) AS best FROM src)
WHERE rk = best AND orguuid IN ('org-0', 'org-1', 'org-2', 'org-3')"""


def optins(spark, sf_dir) -> DataFrame:
    c = star.customers(spark, sf_dir).withColumn("orguuid", F.col("org_uuid"))

    def kind(segment):
        return c.where(F.col("user_type") == segment)

    day = F.lit
    sms = sms_state(spark, sf_dir).withColumn("orguuid", F.col("org_uuid"))
    active = star.stores(spark, sf_dir).where("org_uuid <> 'org-4'").select(
        F.col("org_uuid").alias("orguuid"))
    return ops.optin_status(
        sms,
        kind("BUILDING").select("orguuid", "phone", day("2001-01-01").cast("timestamp")
                                .alias("ts"), F.lit("opt_in").alias("status")),
        kind("MACHINERY").select("orguuid", "phone", day("2001-02-01").cast("timestamp")
                                 .alias("ts_gmt")),
        kind("FURNITURE").select("orguuid", "phone", day("2001-03-01").cast("timestamp")
                                 .alias("time"), (F.col("balance") > 0).alias("opted_in")),
        c.select("orguuid", "phone", F.timestamp_seconds(
            F.unix_timestamp(F.lit("1990-01-01").cast("timestamp"))
            + F.bround("balance").cast("bigint")).alias("last_updated_utc"),
            (F.col("balance") > 5000).alias("pos_is_subscribed")), active, stage=cut_lineage)


@query(_OPTIN)
def optin_status(spark, sf_dir) -> DataFrame:
    """Opt-in status from the strongest channel per organisation and phone."""
    return optins(spark, sf_dir)


@query(f"WITH {STATE_CTES}, " + """
outs AS (SELECT phone, org, is_subscribed, tot_sms_received FROM state)
SELECT customer_id, phone, CASE WHEN c.org = 'ASIA' THEN false ELSE balance > 0 END
    AS pos_is_subscribed,
  coalesce(o.is_subscribed, CASE WHEN c.org = 'ASIA' THEN false ELSE balance > 0 END, true)
    AS is_subscribed, coalesce(o.tot_sms_received, 0) AS tot_sms_received,
  upper(CASE WHEN CAST(customer_id AS BIGINT) % 10 < 5
        THEN 'Town ' || CAST(customer_id AS BIGINT) % 10
        WHEN CAST(customer_id AS BIGINT) % 3 = 0 THEN 'old town' END) AS city
FROM cust c LEFT JOIN outs o USING (phone, org)
""")
def integrated_customers(spark, sf_dir) -> DataFrame:
    """Customers with subscription, message count and city by zip code."""
    key = F.col("customer_id").cast("bigint")
    c = star.customers(spark, sf_dir).select(
        "customer_id", "phone", "org", (F.col("balance") > 0).alias("pos_is_subscribed"),
        (key % 10).cast("string").alias("zipcode"),
        F.when(key % 3 == 0, "old town").otherwise("").alias("city"))
    zips = star.load(spark, sf_dir, "nation").where("n_nationkey < 5").select(
        F.col("n_nationkey").cast("string").alias("zipcode"),
        F.concat(F.lit("Town "), "n_nationkey").alias("zipcity"))
    outs = sms_state(spark, sf_dir).select("phone", "org", "is_subscribed", "tot_sms_received")
    return ops.integrated_customers(c, outs, zips, ["ASIA"]).select(
        "customer_id", "phone", "pos_is_subscribed", "is_subscribed", "tot_sms_received", "city")


@query(f"WITH {CUST} " + """
SELECT org_uuid, phone, string_agg(customer_id, '|' ORDER BY customer_id)
    AS pos_customer_id, sha256(org_uuid || chr(31) || phone) AS person_id
FROM cust WHERE phone NOT IN (SELECT phone FROM cust k WHERE k.user_type = 'BUILDING'
  AND k.org_uuid = cust.org_uuid) GROUP BY org_uuid, phone
""")
def person_ids(spark, sf_dir) -> DataFrame:
    """New phones with a stable person id and their register ids."""
    c = star.customers(spark, sf_dir)
    return ops.joined_person_ids(ops.person_ids(c, c.where("user_type = 'BUILDING'")))


@query(f"WITH {CUST} " + """
SELECT DISTINCT org_uuid, phone, customer_id, sha256(org_uuid || chr(31) || phone) AS person_id
FROM cust WHERE phone NOT IN (SELECT phone FROM cust k WHERE k.user_type = 'BUILDING'
  AND k.org_uuid = cust.org_uuid)
""")
def person_id_rows(spark, sf_dir) -> DataFrame:
    """New phones with a stable person id, one row per register id."""
    c = star.customers(spark, sf_dir)
    return ops.person_ids(c, c.where("user_type = 'BUILDING'"))


@query(f"{_OPTIN.replace('SELECT DISTINCT orguuid', ', opt AS (SELECT DISTINCT orguuid')}), " + """
carts AS (
  SELECT DISTINCT phone, org_uuid AS orguuid, date_diff('day', CAST(ts AS DATE),
    DATE '2024-01-31') AS days_since_cart FROM (
      SELECT *, max(CAST(ts AS DATE)) OVER (PARTITION BY phone) AS d FROM ec
      WHERE event_type = 'error') WHERE CAST(ts AS DATE) = d),
beh AS (FROM (WITH {BEHAVIOR_CTES} SELECT * FROM behavior))
SELECT DISTINCT customer_id, last_customer_phone, CASE WHEN status = 'opt_in' THEN 'Y'
    WHEN status = 'opt_out' THEN 'N' WHEN sub THEN 'Y' ELSE 'N' END AS last_opted_in,
  days_since_cart, coalesce(beh.num_orders, 0) AS num_orders, coalesce(beh.total_purchases_usd, 0) AS total_purchases_usd,
  coalesce(beh.last_order_date, TIMESTAMP '2001-06-01') AS last_order_date,
  CASE WHEN beh.num_orders IS NULL THEN 'Never Ordered' ELSE last_order_facility END AS last_order_facility,
  coalesce(last_order_source, 'Unknown') AS last_order_source, coalesce(pct_flower, 0) AS pct_flower,
  coalesce(pct_indica, 0) AS pct_indica, coalesce(avg_order_time, 0) AS avg_order_time
FROM (SELECT customer_id, phone AS last_customer_phone, org_uuid, balance > 0 AS sub FROM cust) c
LEFT JOIN opt ON opt.phone = last_customer_phone AND opt.orguuid = org_uuid
LEFT JOIN carts k ON k.phone = last_customer_phone AND k.orguuid = org_uuid
LEFT JOIN beh USING (customer_id)
""".replace("{BEHAVIOR_CTES}", BEHAVIOR_CTES), digits={**digits(2, "total_purchases_usd"), **digits(
    6, "pct_flower", "pct_indica", "avg_order_time")})
def crm_table(spark, sf_dir) -> DataFrame:
    """Marketing list: customers with opt-in, cart and behaviour."""
    c = star.customers(spark, sf_dir).select(
        "customer_id", "org", "phone", F.col("org_uuid").alias("orguuid"),
        F.lit("2001-06-01").cast("timestamp").alias("last_updated_utc"),
        (F.col("balance") > 0).alias("pos_is_subscribed"))
    e = star.load(spark, sf_dir, "events").where("event_type = 'error'")
    carts = e.join(star.customers(spark, sf_dir), e["user_id"].cast("string")
                   == F.col("customer_id")).select(
        "phone", F.col("org_uuid").alias("orguuid"), F.col("ts").alias("created_at"))
    return ops.crm_table(c, optins(spark, sf_dir), carts, behavior(spark, sf_dir), at(EVENTS_AS_OF)).select(
        "customer_id", "last_customer_phone", "last_opted_in", "days_since_cart", "num_orders",
        "total_purchases_usd", "last_order_date", "last_order_facility", "last_order_source", "pct_flower",
        "pct_indica", "avg_order_time")


_CARRIERS = """
car AS (SELECT phone, arg_max(carrier, (ts, carrier)) AS carrier FROM (
  SELECT phone, ts, CASE WHEN event_id % 3 = 0 THEN 'acme' ELSE 'bell' END AS carrier FROM ec
  WHERE event_type = 'click') GROUP BY phone)"""


@query(f"WITH {STATE_CTES}, {_CARRIERS}, " + """
opt AS (SELECT DISTINCT org, phone, 'Y' AS opt_in FROM cust WHERE user_type = 'BUILDING'),
j AS (SELECT coalesce(s.org, o.org) AS org, coalesce(s.phone, o.phone) AS last_customer_phone,
        last_sms_engagement_utc AS last_sms, tot_sms_received AS tot_sms,
        last_campaign_id AS latest_campaign_id, tot_sms_received AS latest_tot_sms, opt_in
      FROM state s FULL JOIN opt o ON s.org = o.org AND s.phone = o.phone)
SELECT j.*, carrier, upper(carrier) AS normalized_carrier, coalesce(carrier = 'acme', false)
  AS blocked_by_carrier FROM j LEFT JOIN car ON phone = last_customer_phone
""")
def phones_info(spark, sf_dir) -> DataFrame:
    """Phones with message history, opt-in and carrier."""
    e = star.load(spark, sf_dir, "events").where("event_type = 'click'")
    c = star.customers(spark, sf_dir)
    name = F.when(F.col("event_id") % 3 == 0, "acme").otherwise("bell")
    carriers = e.join(c, e["user_id"].cast("string") == c["customer_id"]).select(
        "phone", name.alias("carrier"), F.upper(name).alias("normalized_carrier"),
        F.col("ts").alias("updated_at_utc"))
    status = c.where("user_type = 'BUILDING'").select("org", "phone", F.lit("opt_in")
                                                      .alias("status")).distinct()
    blocked = carriers.where("carrier = 'acme'").select("carrier")
    return ops.phones_info(sms_state(spark, sf_dir), status, carriers, blocked)


def _carrier_tables(spark, sf_dir):
    e = star.load(spark, sf_dir, "events")
    name = (F.when(F.col("event_id") % 3 == 0, "acme").when(F.col("event_id") % 3 == 1, "bell")
            .otherwise(""))
    seen = e.select(F.concat(F.lit("555"), "user_id").alias("phone"), name.alias("carrier"),
                    F.col("ts").alias("updated_at_utc"), "event_type")

    def kind(k):
        return seen.where(F.col("event_type") == k).drop("event_type")

    return kind("view"), kind("click"), kind("signup").where("carrier <> ''")


_CARRIER_SQL = """WITH seen AS (
  SELECT '555' || user_id AS phone, ['acme', 'bell', ''][event_id % 3 + 1] AS carrier,
         ts AS updated_at_utc, event_type FROM events),
fresh AS (
  SELECT phone, carrier, updated_at_utc FROM (SELECT *, max(updated_at_utc) OVER (PARTITION BY phone)
    AS m FROM seen WHERE event_type IN ('view', 'click') AND carrier <> '')
  WHERE updated_at_utc = m
  UNION ALL SELECT phone, carrier, updated_at_utc FROM seen WHERE event_type = 'signup'
    AND carrier <> '' AND updated_at_utc >= TIMESTAMP '2024-01-16'),
cur AS (SELECT phone, arg_max(carrier, (updated_at_utc, carrier)) AS carrier,
          max(updated_at_utc) AS updated_at_utc FROM fresh GROUP BY phone)"""


@query(_CARRIER_SQL + " SELECT * FROM cur")
def phone_carriers(spark, sf_dir) -> DataFrame:
    """Newest carrier per phone from sends and fresh stored values."""
    view, click, stored = _carrier_tables(spark, sf_dir)
    return ops.phone_carriers([view, click], stored, at(EVENTS_AS_OF), keep_days=15)


@query(_CARRIER_SQL + """
SELECT DISTINCT phone FROM seen WHERE event_type = 'signup' AND carrier <> ''
  AND updated_at_utc < TIMESTAMP '2024-01-16'
  AND phone NOT IN (SELECT phone FROM seen WHERE event_type = 'error' AND updated_at_utc
                    > TIMESTAMP '2024-01-29')
  AND phone NOT IN (SELECT phone FROM fresh WHERE updated_at_utc > TIMESTAMP '2024-01-29')
""")
def phones_to_look_up(spark, sf_dir) -> DataFrame:
    """Phones whose stored carrier is old and that nothing newer covers."""
    view, click, stored = _carrier_tables(spark, sf_dir)
    current = ops.phone_carriers([view, click], stored, at(EVENTS_AS_OF), keep_days=15).where(
        "updated_at_utc > timestamp '2024-01-29'")
    contacted = star.load(spark, sf_dir, "events").where(
        "event_type = 'error' AND ts > timestamp '2024-01-29'").select(
        F.concat(F.lit("555"), "user_id").alias("phone"))
    return ops.phones_to_look_up(stored, current, contacted, at(EVENTS_AS_OF), keep_days=15)


@query("""
SELECT upper(c_name) AS full_name, lower(c_mktsegment) AS email, 'one' AS pos FROM customer
UNION ALL SELECT upper(s_name), NULL, 'two' FROM supplier
""")
def checked_in_customers(spark, sf_dir) -> DataFrame:
    """Customers checked in now, from several systems."""
    one = star.load(spark, sf_dir, "customer").select(
        F.col("c_name").alias("full_name"), F.col("c_mktsegment").alias("email"),
        F.lit("one").alias("pos"))
    two = star.load(spark, sf_dir, "supplier").select(F.col("s_name").alias("full_name"),
                                                      F.lit("two").alias("pos"))
    three = one.where("full_name IS NULL")
    return check_in_list(one, two.withColumn("email", F.lit(None).cast("string")), three)
