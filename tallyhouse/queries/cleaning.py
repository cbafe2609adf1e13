"""Text, dates, categories, brands, amounts and flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import brand, category, dates, orders, people, text
from ..operators.customers import segment_lines
from ..operators.joins import map_with_override
from ..plans.population import category_cached, fill_amounts, house_rules, standardize_brand
from ..session import cut_lineage
from ..sources import star
from . import payloads
from .registry import CUST, ORDS, POP, digits, query


@query(r"""
SELECT p_partkey, nullif(trim(regexp_replace(nullif(t, 'N/A'), '[\s\pZ]+', ' ', 'g')), '') AS plain,
  nullif(nullif(trim(regexp_replace(upper(t), '[\s\pZ]+', ' ', 'g')), 'N/A'), '') AS upper_text,
  nullif(nullif(trim(regexp_replace(lower(t), '[\s\pZ]+', ' ', 'g')), 'N/A'), '') AS lower_text
FROM (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'N/A' WHEN 1 THEN 'n/a' WHEN 2 THEN '   '
  ELSE '  ' || replace(p_name, ' ', '    ') || chr(9) || 'x ' END AS t FROM part)
""")
def clean_strings(spark, sf_dir) -> DataFrame:
    """Squished text in three cases; N/A and blank become NULL."""
    rest = F.concat(F.lit("  "), F.regexp_replace("p_name", " ", "    "), F.lit("\tx "))
    raw = (F.when(F.col("p_size") % 5 == 0, "N/A").when(F.col("p_size") % 5 == 1, "n/a")
           .when(F.col("p_size") % 5 == 2, "   ").otherwise(rest))
    return star.load(spark, sf_dir, "part").select(
        "p_partkey", text.clean_text(raw).alias("plain"),
        text.clean_text(raw, "upper").alias("upper_text"),
        text.clean_text(raw, "lower").alias("lower_text"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_orderdate END AS at_us,
       CASE WHEN o_orderstatus = 'O' THEN o_orderdate END AS at_iso,
       CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderdate AS DATE) END AS day FROM orders
""")
def parse_dates(spark, sf_dir) -> DataFrame:
    """Text in two formats; the filler year and unreadable text become NULL."""
    o = star.load(spark, sf_dir, "orders")

    def written(fmt):
        return (F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", fmt))
                .when(F.col("o_orderstatus") == "F", F.date_format(
                    F.lit("1900-01-01").cast("timestamp"), fmt)).otherwise("soon"))

    iso = written("yyyy-MM-dd'T'HH:mm:ss")
    return o.select("o_orderkey", dates.parse_timestamp(written("MM/dd/yyyy HH:mm:ss"),
                                                        "MM/dd/yyyy HH:mm:ss").alias("at_us"),
                    dates.parse_timestamp(iso).alias("at_iso"),
                    dates.parse_date(iso).alias("day"))


@query("""
SELECT user_id, CASE WHEN n > 0 THEN csv END AS csv, CASE WHEN n > 0 THEN csv_blank END AS csv_blank,
       kinds_json FROM (
  SELECT user_id, count(k) AS n, string_agg(k, ',' ORDER BY k) AS csv,
         string_agg(k, ', ' ORDER BY k) AS csv_blank,
         '[' || coalesce(string_agg('"' || k || '"', ',' ORDER BY k), '') || ']' AS kinds_json
  FROM (SELECT DISTINCT user_id, CASE WHEN value > 100 THEN event_type END AS k FROM events)
  GROUP BY user_id)
""")
def list_columns(spark, sf_dir) -> DataFrame:
    """Array columns as separated text and as JSON; empty lists are NULL text."""
    kinds = (star.load(spark, sf_dir, "events").groupBy("user_id")
             .agg(F.sort_array(F.collect_set(F.when(F.col("value") > 100, F.col("event_type"))))
                  .alias("k")))
    return kinds.select("user_id", text.list_to_csv(F.col("k")).alias("csv"),
                        text.csv_or_null(F.col("k")).alias("csv_blank"),
                        text.list_to_json(F.col("k")).alias("kinds_json"))


_GENDERS = ["Male", "male", "m", "feMale", "F", "RANDO", "", "Unknown", "10", "1", "x2", "u0"]


@query("""
SELECT c_custkey, ['M', 'M', 'M', 'F', 'F', NULL, NULL, NULL, 'M', 'F', 'U', NULL, NULL]
                  [c_custkey % 13 + 1] AS gender,
       coalesce(['M', 'M', 'M', 'F', 'F', NULL, NULL, NULL, 'M', 'F', 'U', NULL, NULL]
                  [c_custkey % 13 + 1], 'U') AS gender_or_u FROM customer
""")
def clean_genders(spark, sf_dir) -> DataFrame:
    """Spellings and codes of a gender."""
    raw = F.get(F.array(*[F.lit(g) for g in _GENDERS]), (F.col("c_custkey") % 13).cast("int"))
    return star.load(spark, sf_dir, "customer").select(
        "c_custkey", people.clean_gender(raw).alias("gender"),
        people.gender_or_unknown(raw).alias("gender_or_u"))


def _rule_sql(rules, flags: str, default: str) -> str:
    """The rule table as one UPDATE-like step per rule, in order."""
    step = "names"
    for rule in rules:
        field = {"raw": "raw", "product": "product", "product_category": "master"}[rule.field]
        if rule.kind == "exact":
            hit = f"{field} IN ({', '.join(repr(n) for n in rule.pattern)})"
        else:
            pattern, subject = rule.pattern, field
            if "(?<!" in pattern:  # this dialect has no look-behind
                pattern = pattern.replace("(?<!non)(?<!non )(?<!non-)", "")
                subject = f"regexp_replace({field}, 'non[ -]?edible', '#', '{flags}g')"
            hit = f"regexp_matches({subject}, '{pattern}', '{flags or 'c'}')"
        if rule.kind in ("fill", "fill_no_raw"):
            hit += " AND cat IS NULL"
        if rule.kind == "fill_no_raw":
            hit += " AND raw IS NULL"
        step = (f"(SELECT * REPLACE (CASE WHEN {hit} THEN '{rule.category}' ELSE cat END AS cat)"
                f" FROM {step})")
    final = f"CASE WHEN cat = 'BATTERIES' THEN 'ACCESSORIES' ELSE {default} END"
    return f"SELECT p_partkey, {final} AS category3 FROM {step}"


@query(f"""WITH names AS (
  SELECT p_partkey, lower({payloads.SQL_RAW}) AS raw, upper({payloads.SQL_TITLE}) AS product,
         upper({payloads.SQL_MASTER}) AS master, CAST(NULL AS VARCHAR) AS cat FROM part)
""" + _rule_sql(category.STRICT_RULES, "", "cat"))
def categories_strict(spark, sf_dir) -> DataFrame:
    """Ordered category rules, case-sensitive; no match is NULL."""
    part = payloads.retail_names(star.load(spark, sf_dir, "part"))
    return part.select("p_partkey", category.strict_category(
        F.col("raw_category_name"), F.col("product_name"), F.col("product_category_name"))
        .alias("category3"))


_IGNORE_CASE_NAMES = f"""names AS (
  SELECT p_partkey, nullif(upper({payloads.SQL_RAW}), '') AS raw,
         upper({payloads.SQL_TITLE}) AS product, CAST(NULL AS VARCHAR) AS cat FROM part)"""
_IGNORE_CASE = _rule_sql(category.IGNORE_CASE_RULES, "i", "coalesce(cat, 'OTHER')")


@query(f"WITH {_IGNORE_CASE_NAMES} {_IGNORE_CASE}")
def categories_ignore_case(spark, sf_dir) -> DataFrame:
    """The rules on any case; no match is OTHER."""
    part = payloads.retail_names(star.load(spark, sf_dir, "part"))
    return part.select("p_partkey", category.ignore_case_category(
        F.col("raw_category_name"), F.col("product_name")).alias("category3"))


_SAVED_SQL = f"""
saved AS (SELECT DISTINCT nullif(upper({payloads.SQL_RAW}), '') AS raw,
                 upper({payloads.SQL_TITLE}) AS product FROM part WHERE p_size > 25),
cats AS ({_IGNORE_CASE})"""


def _cached(spark, sf_dir):
    part = payloads.retail_names(star.load(spark, sf_dir, "part"))
    saved = (part.where("p_size > 25")
             .select(F.nullif(F.upper("raw_category_name"), F.lit("")).alias("raw_category_name"),
                     F.upper("product_name").alias("product_name")).distinct()
             .withColumn("category3", F.lit("SAVED")))
    return category_cached(part, saved)


@query(f"WITH {_IGNORE_CASE_NAMES}, {_SAVED_SQL}" + """
SELECT n.p_partkey, CASE WHEN s.product IS NOT NULL THEN 'SAVED' ELSE c.category3 END AS category3
FROM names n JOIN cats c USING (p_partkey)
LEFT JOIN saved s ON n.raw IS NOT DISTINCT FROM s.raw AND n.product = s.product
""")
def categories_cached(spark, sf_dir) -> DataFrame:
    """Saved name pairs first, rules only for the rest; NULL names match."""
    return _cached(spark, sf_dir)[0].select("p_partkey", "category3")


@query(f"WITH {_IGNORE_CASE_NAMES}, {_SAVED_SQL}" + """
SELECT DISTINCT n.raw AS raw_category_name, n.product AS product_name, c.category3
FROM names n JOIN cats c USING (p_partkey)
LEFT JOIN saved s ON n.raw IS NOT DISTINCT FROM s.raw AND n.product = s.product
WHERE s.product IS NULL
""")
def categories_to_save(spark, sf_dir) -> DataFrame:
    """Newly derived name pairs."""
    return _cached(spark, sf_dir)[1]


_RULES = [(r"^BRAND#1[0-9]$", "TEENS"), (r"^BRAND#(2|3)$", "DUO"), ("^TEENS$", "$TEEN"),
          ("RING|BOLT", "METAL")]
_BRANDS = """
SELECT l_orderkey, l_linenumber, l_partkey, CASE
  WHEN regexp_matches(b, '^BRAND#1[0-9]$') THEN 'HOUSE'
  WHEN regexp_matches(b, '^BRAND#(2|3)$') THEN 'DUO'
  WHEN regexp_matches(b, 'RING|BOLT') THEN 'METAL' ELSE b END AS brand_name
FROM lineitem JOIN (
  SELECT p_partkey, CASE WHEN p_size % 6 = 0 THEN upper(p_name)
    WHEN p_size % 6 = 1 THEN upper(p_brand) ELSE upper(p_brand) END AS b FROM part)
ON l_partkey = p_partkey
"""


def _odd_brands(spark, sf_dir):
    return star.load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("product_name"),
        F.when(F.col("p_size") % 6 == 0, None)
        .when(F.col("p_size") % 6 == 1, F.concat(F.lit("x  "), "p_brand", F.lit(" (1/4) oz")))
        .otherwise(F.concat(F.lit(" '"), "p_brand", F.lit(".\""))).alias("brand_name"))


@query(_BRANDS)
def brands_standardized(spark, sf_dir) -> DataFrame:
    """Brand clean-up and ordered rules on every line; product name as fallback."""
    lines = star.load(spark, sf_dir, "lineitem").join(_odd_brands(spark, sf_dir), "l_partkey")
    return standardize_brand(lines, _RULES, stage=cut_lineage).select(
        "l_orderkey", "l_linenumber", "l_partkey", "brand_name")


@query(_BRANDS)
def brands_by_distinct_name(spark, sf_dir) -> DataFrame:
    """The same on the product table, before the lines are joined."""
    parts = standardize_brand(_odd_brands(spark, sf_dir), _RULES, stage=cut_lineage)
    return star.load(spark, sf_dir, "lineitem").join(parts, "l_partkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "brand_name")


@query("""
SELECT p_partkey, CASE WHEN b IS NULL AND v IS NOT NULL THEN 'supplier' ELSE b END AS brand_name,
       upper(regexp_replace(coalesce(b, p_name), '[.]', '', 'g')) AS shown
FROM (SELECT p_partkey, p_name, CASE WHEN p_size % 3 <> 0 THEN p_brand END AS b,
             CASE WHEN p_size % 2 = 0 THEN 1 END AS v FROM part)
""")
def brand_fallbacks(spark, sf_dir) -> DataFrame:
    """Vendor fills a missing brand; the product name stands in for display."""
    known = F.when(F.col("p_size") % 3 != 0, F.col("p_brand"))
    vendor = F.when(F.col("p_size") % 2 == 0, F.lit("supplier"))
    return star.load(spark, sf_dir, "part").select(
        "p_partkey", F.coalesce(known, vendor).alias("brand_name"),
        brand.tidy_brand(F.coalesce(known, F.col("p_name"))).alias("shown"))


@query(f"WITH {ORDS} " + """
SELECT order_id, pickup, CASE WHEN order_type = 'Retail' THEN
    CASE WHEN NOT pickup THEN 'WALK-IN' WHEN order_tot > 200000 THEN 'PREORDER'
         ELSE 'PREORDER - NO ECOMM' END
  WHEN order_type = 'Delivery' THEN 'DELIVERY' ELSE 'OTHER' END AS channel,
  CASE WHEN order_type = 'Retail' AND pickup THEN 'PREORDER - NO ECOMM'
       WHEN order_type = 'Retail' THEN 'WALK-IN' WHEN order_type = 'Delivery' THEN 'DELIVERY'
       ELSE 'OTHER' END AS channel_alone
FROM (SELECT *, coalesce(order_source, '') = 'app' AS pickup FROM ords)
""")
def order_channels(spark, sf_dir) -> DataFrame:
    """Pickup flag and sales channel, with and without preorder data."""
    o = star.orders(spark, sf_dir)
    pickup = orders.is_pickup(F.col("order_type"), F.col("order_source"))
    ahead = F.when(F.col("order_tot") > 200000, F.col("order_tot"))
    return o.select("order_id", pickup.alias("pickup"),
                    orders.channel(F.col("order_type"), pickup, ahead).alias("channel"),
                    orders.channel(F.col("order_type"), pickup).alias("channel_alone"))


@query(f"WITH {POP} " + """
SELECT order_line_id, order_id, category3, item_subtotal FROM pop
WHERE order_time_utc > TIMESTAMP '1998-01-01' AND (coalesce(email, '') <> '' OR phone IS NOT NULL)
  AND item_subtotal > 100 AND item_subtotal < 50000
  AND category3 IN ('EDIBLES', 'VAPES', 'FLOWER', 'PREROLLS', 'EXTRACTS', 'DRINKS')
""", digits=digits(4, "item_subtotal"))
def segment_line_filter(spark, sf_dir) -> DataFrame:
    """Recent, contactable lines of plausible amount."""
    pop = star.population(spark, sf_dir)
    return segment_lines(pop, since="1998-01-01", low=100, high=50000).select(
        "order_line_id", "order_id", "category3", "item_subtotal")


_DELIVERED = "o_orderdate + to_seconds(o_orderkey % 20000)"


@query(f"""
SELECT o_orderkey, (o_orderkey % 20000) / 60.0 AS minutes,
  CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 20000 > 10800
         THEN o_orderdate + to_seconds(10800)
       WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 20000 < 1200
         THEN o_orderdate + to_seconds(1200) ELSE {_DELIVERED} END AS complete
FROM orders
""", digits=digits(6, "minutes"))
def delivery_durations(spark, sf_dir) -> DataFrame:
    """Minutes a delivery took, and its end limited to 20 to 180 minutes."""
    o = star.load(spark, sf_dir, "orders")
    start = F.col("o_orderdate")
    end = F.timestamp_seconds(F.unix_timestamp(start) + F.col("o_orderkey") % 20000)
    return o.select("o_orderkey", dates.minutes_between(start, end).alias("minutes"),
                    dates.clamp_end(start, end, F.col("o_orderpriority") == "1-URGENT")
                    .alias("complete"))


_ZONES = ["UTC", "America/New_York", "Asia/Tokyo", "Europe/Berlin", "America/Los_Angeles"]


@query("""
SELECT o_orderkey, (o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE
  (['UTC', 'America/New_York', 'Asia/Tokyo', 'Europe/Berlin', 'America/Los_Angeles']
   [o_orderkey % 5 + 1]) AS local_time FROM orders
""")
def local_times(spark, sf_dir) -> DataFrame:
    """UTC to wall clock of a zone that differs per row."""
    zone = F.get(F.array(*[F.lit(z) for z in _ZONES]), (F.col("o_orderkey") % 5).cast("int"))
    return star.load(spark, sf_dir, "orders").select(
        "o_orderkey", dates.utc_to_local(F.col("o_orderdate"), zone).alias("local_time"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, 0.0::DOUBLE AS order_disc,
  coalesce(tax, 0) AS item_tax, coalesce(disc, 0) AS item_discount,
  coalesce(sub, lst + coalesce(disc, 0)) AS item_subtotal,
  CASE WHEN tot IS NULL AND lst IS NOT NULL
    THEN coalesce(sub, lst + coalesce(disc, 0)) + coalesce(disc, 0) + coalesce(tax, 0)
    ELSE tot END AS item_total,
  coalesce(lst, sub) AS item_list_price
FROM (SELECT *, CASE WHEN l_linenumber % 2 = 0 THEN l_tax END AS tax,
  CASE WHEN l_linenumber % 3 = 0 THEN -l_discount END AS disc,
  CASE WHEN l_linenumber % 4 = 0 THEN l_extendedprice * 0.5 END AS sub,
  CASE WHEN l_linenumber % 5 = 0 THEN l_extendedprice END AS lst,
  CASE WHEN l_linenumber % 7 = 0 THEN l_quantity END AS tot FROM lineitem)
""", digits=digits(4, "item_tax", "item_discount", "item_subtotal", "item_total",
                   "item_list_price"))
def repaired_amounts(spark, sf_dir) -> DataFrame:
    """Missing tax, discount, subtotal, total and list price filled from each other."""
    n = F.col("l_linenumber")
    rows = star.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.lit(None).cast("double").alias("order_disc"),
        F.when(n % 2 == 0, F.col("l_tax")).alias("item_tax"),
        F.when(n % 3 == 0, -F.col("l_discount")).alias("item_discount"),
        F.when(n % 4 == 0, F.col("l_extendedprice") * 0.5).alias("item_subtotal"),
        F.when(n % 5 == 0, F.col("l_extendedprice")).alias("item_list_price"),
        F.when(n % 7 == 0, F.col("l_quantity")).alias("item_total"))
    return fill_amounts(rows)


@query("""
SELECT p_partkey, CASE WHEN c IS NULL AND b IS NULL AND n IS NULL THEN 'HOUSE' ELSE b END
    AS brand_name,
  CASE WHEN c IS NULL AND b IS NULL AND n IS NULL THEN 'HOUSE' ELSE c END AS category,
  CASE WHEN c IS NULL AND b IS NULL AND n IS NULL THEN 'HOUSE'
       WHEN b IS NOT NULL AND n IS NULL AND c = 'FLOWER' THEN b ELSE n END AS product_name
FROM (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_brand END AS b,
             CASE WHEN p_size % 3 = 0 THEN p_name END AS n,
             CASE WHEN p_type IN ('SMALL', 'PROMO') THEN 'FLOWER' END AS c FROM part)
""")
def house_products(spark, sf_dir) -> DataFrame:
    """Unknown products become HOUSE; nameless flower takes its brand."""
    rows = star.load(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("brand_name"),
        F.when(F.col("p_size") % 3 == 0, F.col("p_name")).alias("product_name"),
        F.when(F.col("p_type").isin("SMALL", "PROMO"), "FLOWER").alias("category"))
    return house_rules(rows)


@query(f"WITH {ORDS} " + """
SELECT date_trunc('week', order_time_utc)::TIMESTAMP AS week, count(*) AS orders,
       count(DISTINCT sha256(org_uuid || chr(31) || store_id || chr(31) || order_id)) AS keys,
       min(sha256(org_uuid || chr(31) || store_id || chr(31) || order_id)) AS first_key
FROM ords GROUP BY 1
""")
def weekly_order_keys(spark, sf_dir) -> DataFrame:
    """Orders per week (from Monday) with their stable keys."""
    o = star.orders(spark, sf_dir)
    key = orders.order_key(F.col("org_uuid"), F.col("store_id"), F.col("order_id"))
    return (o.select(dates.week_start(F.col("order_time_utc")).alias("week"), key.alias("k"))
            .groupBy("week").agg(F.count(F.lit(1)).alias("orders"),
                                 F.count_distinct("k").alias("keys"),
                                 F.min("k").alias("first_key")))


_WORDS = r"trim(regexp_replace(regexp_replace(text, '[^\pL\pN]', ' ', 'g'), ' +', ' ', 'g'))"


@query(rf"""
SELECT conv_id, turn, stop, start, w_stop, w_start FROM (SELECT conv_id, turn,
  regexp_matches(w, 'stop|unsubscribe|cancel|remove|end|quit|stoo|fuck off') AS stop,
  regexp_matches(w, 'start|yes|unstop') AS start,
  regexp_matches(w, '(^| )(stop|unsubscribe|cancel|remove|end|quit|stoo|fuck off)( |$)')
    AS w_stop,
  regexp_matches(w, '(^| )(start|yes|unstop)( |$)') AS w_start
  FROM (SELECT *, lower({_WORDS}) AS w FROM (
    SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'Please STOP!' WHEN 1 THEN text
      WHEN 2 THEN 'my fri-end, yes' ELSE text || ' un-stop unstop' END AS text
    FROM conversations)))
""")
def opt_keywords(spark, sf_dir) -> DataFrame:
    """Stop and start words in replies, inside words and as whole words."""
    reply = (F.when(F.col("turn") % 4 == 0, "Please STOP!").when(F.col("turn") % 4 == 1,
                                                                F.col("text"))
             .when(F.col("turn") % 4 == 2, "my fri-end, yes")
             .otherwise(F.concat("text", F.lit(" un-stop unstop"))))
    return star.load(spark, sf_dir, "conversations").select(
        "conv_id", "turn", text.opt_out_flag(reply).alias("stop"),
        text.opt_in_flag(reply).alias("start"),
        text.opt_out_flag(reply, whole_word=True).alias("w_stop"),
        text.opt_in_flag(reply, whole_word=True).alias("w_start"))


@query(r"""
SELECT conv_id, turn, body, CAST(length(body) AS BIGINT) AS text_length FROM (
  SELECT conv_id, turn, trim(regexp_replace(text, '[\s\pZ]+', ' ', 'g')) AS body
  FROM conversations)
""")
def message_bodies(spark, sf_dir) -> DataFrame:
    """Message text on one line and its length."""
    body = text.clean_body(F.col("text"))
    return star.load(spark, sf_dir, "conversations").select(
        "conv_id", "turn", body.alias("body"), F.length(body).cast("bigint").alias("text_length"))


@query("""
SELECT event_id, CASE WHEN event_type = 'view' THEN 'Promoted Categories'
  WHEN event_type = 'click' THEN 'Lost Customer Outreach'
  WHEN event_type = 'signup' THEN 'New Engagements'
  WHEN event_type = 'error' THEN 'Custom Segment' ELSE 'Other Key Opportunity' END
  AS grouped_source FROM events
""")
def campaign_groups(spark, sf_dir) -> DataFrame:
    """Campaign title, or its source without one, to reporting group."""
    title = (F.when(F.col("event_type") == "view", "We Promote Custom")
             .when(F.col("event_type") == "click", "Lost ones"))
    source = (F.when(F.col("event_type") == "signup", "New Customers")
              .when(F.col("event_type") == "error", "Custom list").otherwise("Lost?"))
    source = F.when(F.col("event_type") == "purchase", "none").otherwise(source)
    return star.load(spark, sf_dir, "events").select(
        "event_id", orders.campaign_group(title, source).alias("grouped_source"))


@query("""
SELECT c_custkey, least(CAST(floor(date_diff('day',
    DATE '1900-01-01' + CAST(c_custkey * 37 % 40000 AS INTEGER), DATE '2001-08-02') / 365.25)
    AS INTEGER), 100) AS age FROM customer
""")
def customer_ages(spark, sf_dir) -> DataFrame:
    """Whole years, never above 100."""
    birthday = F.date_add(F.lit("1900-01-01").cast("date"),
                          (F.col("c_custkey") * 37 % 40000).cast("int"))
    return star.load(spark, sf_dir, "customer").select(
        "c_custkey", dates.age_on(birthday, F.lit("2001-08-02").cast("date")).alias("age"))


@query(f"WITH {CUST} " + """
SELECT customer_id, CASE WHEN CAST(customer_id AS BIGINT) % 3 <> 0 THEN
    'Main St ' || CASE WHEN CAST(customer_id AS BIGINT) % 2 = 0 THEN 'Apt 4 ' ELSE '' END
    || store || ' ' || org || ' 9000' END AS long_address,
  CASE WHEN CAST(customer_id AS BIGINT) % 4 = 0 THEN 'Smith'
       ELSE full_name || ' Smith' END AS full_name
FROM cust WHERE CAST(customer_id AS BIGINT) % 7 <> 0
""")
def addresses_without_tests(spark, sf_dir) -> DataFrame:
    """One-line address and name; test profiles left out."""
    key = F.col("customer_id").cast("bigint")
    first = F.when(key % 7 == 0, "mr Tester").otherwise(F.col("full_name"))
    c = star.customers(spark, sf_dir).where(~people.is_test_name(first))
    return c.select("customer_id", people.long_address(
        F.lit("Main  St"), F.when(key % 2 == 0, " Apt 4"), F.col("store"), F.col("org"),
        F.when(key % 3 != 0, "9000")).alias("long_address"),
        people.full_name(F.when(key % 4 != 0, F.col("full_name")), F.lit("Smith"))
        .alias("full_name"))


@query("""
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'sativa' WHEN 1 THEN 'indica' WHEN 2 THEN 'cbd'
  ELSE 'hybrid' END AS product_class,
  CASE WHEN p_size % 4 = 3 THEN upper(p_name) ELSE 'ACME 2' END AS brand_name FROM part
""")
def strain_classes(spark, sf_dir) -> DataFrame:
    """Plant class and brand named in a product title."""
    size = F.col("p_size") % 4
    title = F.concat(F.when(size == 3, F.upper("p_name")).otherwise("ACME #2 - "), (
        F.when(size == 0, "SATIVA AND INDICA").when(size == 1, "INDICA CBD").when(size == 2, "CBD")
        .otherwise("")))
    return star.load(spark, sf_dir, "part").select(
        "p_partkey", orders.strain_class(title).alias("product_class"),
        text.brand_from_title(title).alias("brand_name"))


@query("""
SELECT p_partkey, CASE WHEN r IS NULL AND n IS NULL AND p_size % 5 = 0 THEN 'NO STOCK'
    WHEN r IS NULL THEN 'UNKNOWN' ELSE r END AS room_id,
  CASE WHEN r IS NULL AND n IS NULL AND p_size % 5 = 0 THEN 'NO STOCK'
    WHEN n IS NULL THEN 'UNKNOWN' ELSE n END AS room_name
FROM (SELECT *, CASE WHEN p_partkey % 2 = 0 THEN 'r1' END AS r,
             CASE WHEN p_partkey % 3 = 0 THEN 'front' END AS n FROM part)
""")
def stock_room_labels(spark, sf_dir) -> DataFrame:
    """Labels for stock without a room."""
    rid = F.when(F.col("p_partkey") % 2 == 0, "r1")
    name = F.when(F.col("p_partkey") % 3 == 0, "front")
    labelled = orders.room_id_label(rid, name, F.col("p_size") % 5)
    return star.load(spark, sf_dir, "part").select(
        "p_partkey", labelled.alias("room_id"),
        orders.room_name_label(labelled, name).alias("room_name"))


@query(f"WITH {POP} " + """
SELECT order_line_id, order_id, CASE WHEN org_uuid = 'org-1' AND raw_category_name = 'PROMO'
    THEN 'own' WHEN raw_category_name IN ('PROMO', 'SMALL') THEN 'default' END AS mapped FROM pop
""")
def mapped_categories(spark, sf_dir) -> DataFrame:
    """An organisation's own category map before the default map."""
    part = star.load(spark, sf_dir, "part")
    names = part.select(F.col("p_type").alias("raw_category_name")).distinct()
    default = names.where("raw_category_name IN ('PROMO', 'SMALL')").withColumn(
        "mapped", F.lit("default"))
    own = names.where("raw_category_name = 'PROMO'").select(
        F.lit("org-1").alias("org_uuid"), "raw_category_name", F.lit("own").alias("mapped"))
    pop = star.population(spark, sf_dir).select("order_line_id", "order_id", "org_uuid",
                                                "raw_category_name")
    return map_with_override(pop, default, own, key="raw_category_name", org="org_uuid",
                             value="mapped", name="mapped").select("order_line_id", "order_id",
                                                                   "mapped")
