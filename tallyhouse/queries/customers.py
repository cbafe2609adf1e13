"""Customer behaviour, profiles, points, segments."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import customers as ops
from ..operators.reshape import stack
from ..session import cut_lineage, cut_lineage_columns
from ..sources import star
from . import event_sales
from .registry import AS_OF, LINES, ORDS, POP, TOTALS, at, digits, query


def _orders(spark, sf_dir) -> DataFrame:
    """Order totals under the names the behaviour operators use."""
    return star.order_totals(spark, sf_dir).withColumns({
        "order_total": F.col("order_tot"), "order_discount": -F.col("order_disc"),
        "order_facility": F.col("store")})


@query(f"WITH {TOTALS} " + """
SELECT org, customer_id, count(*) AS num_orders, min(order_time_utc) AS first_order_date,
  max(order_time_utc) AS last_order_date, sum(order_tot) AS total_purchases_usd,
  sum(-order_disc) AS total_discounts_usd, avg(order_tot) AS avg_order_size,
  sum(-order_disc) / (sum(order_tot) + sum(-order_disc)) AS tot_discount_pct,
  count(*) FILTER (WHERE order_type = 'Delivery') / count(*) AS pct_delivery,
  avg(coalesce(gap, 0)) AS avg_time_between_orders, avg(hour(order_time_local)) AS avg_order_time,
  arg_max(store, (order_time_utc, order_id)) AS last_order_facility,
  arg_max(coalesce(order_source, '?'), (order_time_utc, order_id)) AS last_order_source
FROM (SELECT *, date_diff('day', lag(CAST(order_time_local AS DATE)) OVER (PARTITION BY customer_id
        ORDER BY order_time_local, order_id), CAST(order_time_local AS DATE)) AS gap FROM totals)
GROUP BY ALL
""", digits={**digits(2, "total_purchases_usd", "total_discounts_usd"),
             **digits(4, "avg_order_size"), **digits(6, "tot_discount_pct", "pct_delivery",
                      "avg_time_between_orders", "avg_order_time")})
def customer_order_behavior(spark, sf_dir) -> DataFrame:
    """Orders, spend, shares, gap, hour, last shop and source per customer."""
    o = _orders(spark, sf_dir).withColumn("order_source",
                                          F.coalesce("order_source", F.lit("?")))
    return ops.order_behavior(o)


@query(f"WITH {POP} " + """
SELECT org, customer_id, string_agg(brand_name, ', ' ORDER BY brand_name) AS all_order_descr,
  count(brand_name) AS unique_brands
FROM (SELECT DISTINCT org, customer_id, brand_name FROM pop) GROUP BY ALL
""")
def customer_brands(spark, sf_dir) -> DataFrame:
    """List and number of brands per customer."""
    return ops.product_behavior(star.population(spark, sf_dir), brand="brand_name")


@query(f"WITH {POP} " + """
SELECT org, customer_id, """ + ", ".join(
    f"count(*) FILTER (WHERE raw_category_name = '{c}') / count(*) AS \"pct_{c}\""
    for c in ("ECONOMY", "SMALL", "PROMO")) + """
FROM pop GROUP BY org, customer_id
""", digits=digits(6, "pct_ECONOMY", "pct_SMALL", "pct_PROMO"))
def customer_preferences(spark, sf_dir) -> DataFrame:
    """Share of lines per category, one column each."""
    return ops.preference_shares(star.population(spark, sf_dir), "raw_category_name",
                                 ["ECONOMY", "SMALL", "PROMO"])


@query(f"WITH {POP} " + """
SELECT org_uuid, customer_id, phone, product_name, brand_name, raw_category_name AS category2,
  upper(lower(order_type)) AS classification2, max(order_time_utc) AS last_order_utc,
  arg_max(sales, order_time_utc) AS sales_last_order, sum(sales) AS sales_all_time,
  sum(qty) AS product_qty
FROM (SELECT org_uuid, customer_id, phone, product_name, brand_name, raw_category_name,
        order_type, order_time_utc, sum(item_total) AS sales, sum(product_qty) AS qty
      FROM pop GROUP BY ALL) GROUP BY ALL
""", digits=digits(4, "sales_last_order", "sales_all_time"))
def customer_order_summaries(spark, sf_dir) -> DataFrame:
    """Per customer and product: last order and all-time sales."""
    pop = star.population(spark, sf_dir).withColumns({
        "category2": F.col("raw_category_name"), "classification2": F.lower("order_type")})
    return ops.customer_order_summaries(pop)


def t_tail(t: float, df: int) -> float:
    """P(|T| > t) for Student's t by the finite trigonometric sum for whole degrees of freedom."""
    theta = math.atan2(t, math.sqrt(df))
    square, term, total = math.cos(theta) ** 2, math.cos(theta) if df % 2 else 1.0, 0.0
    for j in range(1, df // 2 + 1 if df % 2 == 0 else (df - 1) // 2 + 1):
        total += term
        term *= square * (2 * j / (2 * j + 1) if df % 2 else (2 * j - 1) / (2 * j))
    if df % 2 == 0:
        return 1 - math.sin(theta) * total
    return 1 - 2 / math.pi * (theta + (math.sin(theta) * total if df > 1 else 0.0))


def critical_t(df: int, p: float) -> float:
    low, high = 0.0, 1e6
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if t_tail(mid, df) > p else (low, mid)
    return (low + high) / 2


# The check's own way to the decision: a table of critical values, for more degrees of freedom than the tables' customers have.
_CRIT = "([" + ", ".join(repr(critical_t(k, 0.15)) for k in range(1, 301)) + "]::DOUBLE[])"
_SENSITIVE = f"""
SELECT customer_id, phone, n >= 3 AND sxx > 0 AND syy > 0 AND
  abs(slope) / sqrt(greatest(syy - slope * sxy, 0) / (n - 2) / sxx)
    > {_CRIT}[n - 2] AS is_disc_sensitive
FROM (SELECT customer_id, phone, CAST(regr_count(order_subtot, order_disc) AS BIGINT) AS n,
        regr_slope(order_subtot, order_disc) AS slope, regr_sxx(order_subtot, order_disc) AS sxx,
        regr_syy(order_subtot, order_disc) AS syy, regr_sxy(order_subtot, order_disc) AS sxy
      FROM kept WHERE order_disc < 0 GROUP BY ALL)"""


@query(f"WITH {TOTALS}, kept AS (SELECT * FROM totals) SELECT customer_id, phone, "
       f"coalesce(is_disc_sensitive, false) AS is_disc_sensitive FROM ({_SENSITIVE})")
def discount_sensitivity(spark, sf_dir) -> DataFrame:
    """Regression of spend on discount per customer, slope significant at .15."""
    return ops.discount_sensitivity(star.order_totals(spark, sf_dir), ["customer_id", "phone"])


_FAVOURITES = """
fav AS (SELECT customer_id, phone, c, min(brand_name) AS b FROM (
  SELECT *, max(s) OVER (PARTITION BY customer_id, phone, c) AS top FROM (
    SELECT customer_id, phone, raw_category_name AS c, brand_name, round(sum(item_total), 6) AS s
    FROM pop GROUP BY ALL)) WHERE s = top GROUP BY ALL),
favs AS (SELECT customer_id, phone, max(b) FILTER (WHERE c = 'PROMO') AS promo,
           max(b) FILTER (WHERE c = 'SMALL') AS small FROM fav GROUP BY ALL)"""


@query(f"WITH {POP}, {_FAVOURITES} SELECT * FROM favs")
def favourite_brands(spark, sf_dir) -> DataFrame:
    """Top brand by spend per category, pivoted."""
    pop = star.population(spark, sf_dir)
    return ops.favourite_brands(pop, ["customer_id", "phone"], ["PROMO", "SMALL"],
                                category="raw_category_name")


_PROFILE = f"""WITH {TOTALS}, {LINES},
pop AS (SELECT l.*, o.* EXCLUDE (order_id, sold_by_id) FROM lines l JOIN totals o
        ON o.order_id = l.order_id), {_FAVOURITES},
gaps AS (SELECT *, date_diff('microsecond', lag(order_time_utc) OVER (PARTITION BY customer_id,
           phone ORDER BY order_time_utc), order_time_utc) / 86400000000.0 AS gap FROM totals),
prof AS (
  SELECT customer_id, phone, org_uuid, max(order_time_utc) AS last_purchase_date,
    date_diff('microsecond', max(order_time_utc), TIMESTAMP '{AS_OF}') / 86400000000.0
      AS days_since_last_purchase,
    avg(gap) AS ave_days_between, stddev_samp(gap) AS sd_days_between,
    quantile_cont(order_tot, 0.5) AS med_order_total, count(*) AS tot_orders,
    sum(order_tot) AS tot_dollars
  FROM gaps GROUP BY org_uuid, customer_id, phone HAVING count(*) > 3),
prof2 AS (SELECT *, days_since_last_purchase > ave_days_between + sd_days_between * 5
            AS cust_is_lost, 2.65 * sd_days_between / sqrt(tot_orders) AS fac FROM prof),
kept AS (SELECT * FROM totals JOIN (SELECT customer_id, phone FROM prof2 WHERE NOT cust_is_lost)
         USING (customer_id, phone)),
sens AS ({_SENSITIVE})
SELECT p.* EXCLUDE (fac), coalesce(s.is_disc_sensitive, CASE WHEN s.customer_id IS NOT NULL
    THEN false END) AS is_disc_sensitive,
  DATE '2001-08-02' + CAST(greatest(floor(ave_days_between - fac), 0) AS INTEGER)
    AS next_start_utc,
  DATE '2001-08-02' + CAST(floor(ave_days_between + fac) AS INTEGER) AS next_stop_utc,
  promo, small
FROM prof2 p LEFT JOIN sens s USING (customer_id, phone) LEFT JOIN favs USING (customer_id, phone)
"""


@query(_PROFILE, digits={**digits(6, "days_since_last_purchase", "ave_days_between",
                                  "sd_days_between"),
                         **digits(4, "med_order_total"), **digits(2, "tot_dollars")})
def customer_profile(spark, sf_dir) -> DataFrame:
    """Purchase rhythm, loss, next purchase window, sensitivity and favourites."""
    heads = star.order_totals(spark, sf_dir)
    pop = (star.lines(spark, sf_dir).drop("sold_by_id").join(heads, "order_id")
           .withColumn("category2", F.col("raw_category_name")))
    return ops.customer_profile(pop, at(AS_OF), ["PROMO", "SMALL"], stage=cut_lineage)


def _cut_sql(values, name):
    return (f"CASE WHEN {name} > {values}[3] THEN 3 WHEN {name} > {values}[2] THEN 2 "
            f"WHEN {name} > {values}[1] THEN 1 ELSE 0 END")


_VIP = f"""WITH {TOTALS}, {LINES},
pop AS (SELECT l.*, o.* EXCLUDE (order_id, sold_by_id) FROM lines l JOIN totals o
        ON o.order_id = l.order_id),
o1 AS (SELECT org_uuid, customer_id, phone, order_id, min(order_tot) AS tot,
         min(order_disc) AS disc, sum(product_qty) AS qty, max(order_time_utc) AS newest
       FROM pop GROUP BY ALL),
s1 AS (SELECT org_uuid, customer_id, phone,
         CAST(floor(date_diff('microsecond', max(newest), TIMESTAMP '{AS_OF}') / 86400000000.0)
              AS BIGINT) AS days_since_last_order, avg(tot) AS avg_order_total,
         avg(abs(disc) / (tot + abs(disc))) AS avg_discount_to_date,
         round_even(avg(qty), 0) AS avg_order_items, sum(qty) AS total_items,
         count(*) AS total_orders, sum(tot) AS total_dollars FROM o1 GROUP BY ALL),
price AS (SELECT org_uuid, customer_id, phone, avg(p) AS avg_item_price FROM (
            SELECT org_uuid, customer_id, phone, product_id, arg_max(item_subtotal,
              (order_time_utc, order_line_id, item_subtotal)) AS p FROM pop GROUP BY ALL)
          GROUP BY ALL),
gap AS (SELECT org_uuid, customer_id, phone, avg(ceil(g)) AS avg_days_between_orders FROM (
          SELECT *, date_diff('microsecond', lag(t) OVER (PARTITION BY customer_id ORDER BY t), t)
            / 86400000000.0 AS g FROM (SELECT DISTINCT org_uuid, customer_id, phone,
              order_time_utc AS t FROM pop)) GROUP BY ALL),
seen AS (SELECT org_uuid, customer_id, phone, arg_max(order_type, t) AS first_name FROM (
           SELECT org_uuid, customer_id, phone, order_type, min(order_time_utc) AS t
           FROM pop GROUP BY ALL) GROUP BY ALL),
cut AS (SELECT org_uuid, quantile_cont(total_items, [0.5, 0.85, 0.98]) AS i,
          quantile_cont(total_orders, [0.45, 0.7, 0.85]) AS o,
          quantile_cont(total_dollars, [0.45, 0.7, 0.95]) AS d FROM s1 GROUP BY 1),
v AS (SELECT s1.*, {_cut_sql('i', 'total_items')} AS vip_items,
        {_cut_sql('o', 'total_orders')} AS vip_orders,
        {_cut_sql('d', 'total_dollars')} AS vip_dollars FROM s1 JOIN cut USING (org_uuid))
SELECT v.*, vip_items + vip_orders + vip_dollars AS vip_points, first_name,
  avg_days_between_orders, avg_item_price
FROM v JOIN seen USING (org_uuid, customer_id, phone) JOIN gap USING (org_uuid, customer_id, phone)
JOIN price USING (org_uuid, customer_id, phone)
"""


@query(_VIP, digits={**digits(4, "avg_item_price", "avg_order_total"),
                     **digits(6, "avg_discount_to_date", "avg_days_between_orders"),
                     **digits(2, "total_dollars")})
def vip_points(spark, sf_dir) -> DataFrame:
    """Points for items, orders and dollars against the organisation's percentiles."""
    heads = star.order_totals(spark, sf_dir)
    pop = star.lines(spark, sf_dir).drop("sold_by_id").join(heads, "order_id").withColumns({
        "pos_product_id": F.col("product_id"), "pos_order_line_id": F.col("order_line_id"),
        "first_name": F.col("order_type"), "last_name": F.lit("x"), "birthday": F.lit(None)
        .cast("date")})
    return ops.vip_points(pop, at(AS_OF), stage=cut_lineage).drop("last_name", "birthday")


_LOYALTY_CUTS = {"spend": ("spend", (0.45, 0.70, 0.95)), "items": ("items", (0.50, 0.85, 0.98)),
                 "orders": ("orders", (0.45, 0.70, 0.85)), "disc": ("rate", (0.25, 0.60, 0.95))}
_LOYALTY_SQL = ", ".join(
    f"coalesce(quantile_cont({expr}, {p}), 0) AS {m}_{level}"
    for m, (expr, ps) in _LOYALTY_CUTS.items()
    for level, p in zip(("silver", "gold", "platinum"), ps))


@query(f"WITH {POP} " + f"""
SELECT org_uuid, {_LOYALTY_SQL} FROM (
  SELECT *, CASE WHEN disc / spend > 0.01 THEN disc / spend END AS rate FROM (
    SELECT org_uuid, customer_id, sum(item_total) AS spend, sum(product_qty) AS items,
      CAST(count(DISTINCT order_id) AS DOUBLE) AS orders, abs(sum(item_discount)) AS disc
    FROM pop GROUP BY ALL)) GROUP BY org_uuid
""", digits={f"{m}_{level}": 6 if m == "disc" else 2 for m in _LOYALTY_CUTS
             for level in ("silver", "gold", "platinum")})
def loyalty_benchmarks(spark, sf_dir) -> DataFrame:
    """Percentiles of spend, items, orders and discount rate per organisation."""
    return ops.loyalty_benchmarks(star.population(spark, sf_dir), stage=cut_lineage)


def _segments_sql(by: str) -> str:
    return f"""
SELECT org_uuid, '{by}' AS segment_type, customer_id, {by} AS contact, n > n_hi AS is_long_term,
  days_ave < ave_lo AND days_sd < sd_lo AS is_most_frequent, size > size_hi AS is_high_spender,
  pre > 0.75 AS is_preroll_only, edi > 0.75 AS is_edible_only, ext > 0.75 AS is_extract_only,
  flo > 0.75 AS is_flower_only, vap > 0.75 AS is_vape_only, rate > rate_hi AS is_disc_sensitive
FROM (
  SELECT *, quantile_cont(n, 0.75) OVER w AS n_hi, quantile_cont(days_ave, 0.25) OVER w AS ave_lo,
    quantile_cont(days_sd, 0.25) OVER w AS sd_lo, quantile_cont(size, 0.75) OVER w AS size_hi,
    quantile_cont(rate, 0.75) OVER w AS rate_hi
  FROM (
    SELECT org_uuid, {by}, customer_id, CAST(count(*) AS DOUBLE) AS n, avg(tot) AS size,
      sum(disc) / sum(tot) AS rate, ceil(sum(g) / count(g)) AS days_ave,
      ceil(sqrt((count(g) * sum(g * g) - sum(g) * sum(g)) / (count(g) * (count(g) - 1))))
        AS days_sd
    FROM (SELECT *, date_diff('day', lag(d) OVER (PARTITION BY org_uuid, {by}, customer_id
            ORDER BY d), d) AS g
          FROM (SELECT org_uuid, {by}, customer_id, CAST(order_time_utc AS DATE) AS d,
                  sum(item_subtotal) AS tot, -sum(item_discount) AS disc
                FROM seg WHERE {by} IS NOT NULL GROUP BY ALL))
    GROUP BY org_uuid, {by}, customer_id HAVING count(*) > 2)
  WINDOW w AS (PARTITION BY org_uuid)) q
JOIN (SELECT org_uuid AS o2, {by} AS b2, customer_id AS c2, """ + ", ".join(
        f"coalesce(sum(item_subtotal) FILTER (WHERE category3 = '{c}') / sum(item_subtotal), 0) "
        f"AS {a}" for a, c in (("pre", "PREROLLS"), ("edi", "EDIBLES"), ("ext", "EXTRACTS"),
                               ("flo", "FLOWER"), ("vap", "VAPES"))) + f"""
      FROM seg GROUP BY ALL) ON org_uuid = o2 AND {by} = b2 AND customer_id = c2
WHERE org_uuid IN (SELECT org_uuid FROM seg WHERE {by} IS NOT NULL GROUP BY 1
                   HAVING count(DISTINCT customer_id) >= 20)"""


_SEG = f"""WITH {POP},
seg AS (SELECT * FROM pop WHERE order_time_utc > TIMESTAMP '1995-06-01'
        AND item_subtotal > 100 AND item_subtotal < 60000)
{_segments_sql('phone')} UNION ALL {_segments_sql('email')}"""


def _segments(spark, sf_dir) -> DataFrame:
    lines = ops.segment_lines(star.population(spark, sf_dir), since="1995-06-01", low=100,
                              high=60000)
    days = cut_lineage(ops.segment_days(lines))
    return stack(*[ops.customer_segments(days, by, min_customers=20, stage=cut_lineage)
                   for by in ("phone", "email")])


@query(_SEG)
def customer_segments(spark, sf_dir) -> DataFrame:
    """Segment flags per phone and per email."""
    return _segments(spark, sf_dir)


@query("SELECT segment, segment_type, count(*) FILTER (WHERE v) AS in_segment, "
       "count(*) FILTER (WHERE NOT v) AS not_in_segment FROM (UNPIVOT (" + _SEG + ") ON "
       + ", ".join(ops.SEGMENT_FLAGS) + " INTO NAME segment VALUE v) GROUP BY ALL")
def segment_summary(spark, sf_dir) -> DataFrame:
    """Customers in and not in each segment."""
    return ops.segment_summary(_segments(spark, sf_dir))


_CONVERTED = """
SELECT org, customer_id, """ + ", ".join(
    f"count(*) FILTER (WHERE is_{h}) AS tot_{h}_conversion"
    for h in ("24hr", "72hr", "7day", "2wk", "30day")) + """
FROM (SELECT *, min(time_since_last_order) OVER (PARTITION BY org, customer_id,
        last_sms_campaign_id) AS best
      FROM (SELECT DISTINCT org, customer_id, last_sms_campaign_id, time_since_last_order,
              order_id, is_24hr, is_72hr, is_7day, is_2wk, is_30day FROM credited))
WHERE time_since_last_order = best GROUP BY ALL
"""


@query(f"WITH {event_sales.SMS_CTES} " + _CONVERTED)
def conversion_counts(spark, sf_dir) -> DataFrame:
    """Converted orders per horizon from each campaign's smallest-gap orders."""
    from .campaigns import attributed
    return ops.conversion_counts(attributed(spark, sf_dir))


def behavior_lines(spark, sf_dir) -> DataFrame:
    """Lines for the behaviour table: some without a brand, some accessories, classes by product."""
    key = F.col("product_id").cast("bigint")
    heads = star.order_totals(spark, sf_dir).select(
        "org", "customer_id", "order_id", "order_time_local", "order_time_utc", "order_type", "order_source",
        F.col("order_tot").alias("order_total"), (-F.col("order_disc")).alias("order_discount"),
        F.col("store").alias("order_facility"))
    return star.lines(spark, sf_dir).join(heads, "order_id").withColumns({
            "brand_name": F.when(key % 7 != 0, F.col("brand_name")),
            "category3": F.when(key % 11 == 0, "ACCESSORIES").otherwise(F.col("category3")),
            "product_class": F.when(key % 3 == 0, "indica").when(key % 3 == 1, "sativa")})


def behavior(spark, sf_dir) -> DataFrame:
    from .campaigns import attributed
    return ops.customer_behavior(behavior_lines(spark, sf_dir), attributed(spark, sf_dir), stage=cut_lineage_columns)


_SHARES = [(c, f"c = '{c}'") for c in ops.BEHAVIOR_CATEGORIES]
BEHAVIOR_CTES = f"""{TOTALS}, {LINES},
bl AS (
  SELECT t.*, l.order_line_id, coalesce(CASE WHEN CAST(product_id AS BIGINT) % 7 <> 0 THEN brand_name END, product_name) AS brand,
    CASE WHEN CAST(product_id AS BIGINT) % 11 = 0 THEN 'accessories' ELSE CASE category3 WHEN 'PREROLLS' THEN 'preroll'
      WHEN 'EDIBLES' THEN 'edible' WHEN 'EXTRACTS' THEN 'extract' ELSE lower(category3) END END AS c,
    CASE CAST(product_id AS BIGINT) % 3 WHEN 0 THEN 'indica' WHEN 1 THEN 'sativa' END AS k
  FROM lines l JOIN totals t ON l.order_id = t.order_id),
b_orders AS (
  SELECT org, customer_id, count(*) AS num_orders, min(order_time_utc) AS first_order_date,
    max(order_time_utc) AS last_order_date, sum(order_tot) AS total_purchases_usd,
    sum(-order_disc) AS total_discounts_usd, avg(order_tot) AS avg_order_size,
    sum(-order_disc) / (sum(order_tot) + sum(-order_disc)) AS tot_discount_pct,
    count(*) FILTER (WHERE order_type = 'Delivery') / count(*) AS pct_delivery,
    avg(coalesce(gap, 0)) AS avg_time_between_orders, avg(hour(order_time_local)) AS avg_order_time,
    arg_max(store, (order_time_utc, order_id)) AS last_order_facility,
    nullif(arg_max(coalesce(order_source, '?'), (order_time_utc, order_id)), '?') AS last_order_source
  FROM (SELECT *, date_diff('day', lag(CAST(order_time_local AS DATE)) OVER (PARTITION BY customer_id
          ORDER BY order_time_local, order_id), CAST(order_time_local AS DATE)) AS gap FROM totals)
  GROUP BY ALL),
b_brands AS (SELECT org, customer_id, string_agg(brand, ', ' ORDER BY brand) AS all_order_descr, count(*) AS unique_brands
             FROM (SELECT DISTINCT org, customer_id, brand FROM bl) GROUP BY ALL),
b_cats AS (SELECT org, customer_id, {", ".join(f"count(*) FILTER (WHERE {w}) / count(*) AS pct_{c}" for c, w in _SHARES)}
           FROM bl WHERE c IS NULL OR c <> 'accessories' GROUP BY ALL HAVING count(c) > 0),
b_classes AS (SELECT org, customer_id, {", ".join(f"count(*) FILTER (WHERE k = '{k}') / count(*) AS pct_{k}"
                                                 for k in ops.BEHAVIOR_CLASSES)}
              FROM bl GROUP BY ALL HAVING count(k) > 0),
behavior AS (SELECT * FROM b_orders LEFT JOIN b_brands USING (org, customer_id) LEFT JOIN b_cats USING (org, customer_id)
             LEFT JOIN b_classes USING (org, customer_id))"""
_PARTS = digits(6, "tot_discount_pct", "pct_delivery", "avg_time_between_orders", "avg_order_time",
                *[f"pct_{c}" for c in (*ops.BEHAVIOR_CATEGORIES, *ops.BEHAVIOR_CLASSES)])


@query(f"""SELECT b.*, s.* EXCLUDE (org, customer_id) FROM (WITH {BEHAVIOR_CTES} SELECT * FROM behavior) b
LEFT JOIN (WITH {event_sales.SMS_CTES} {_CONVERTED}) s ON b.org = s.org AND b.customer_id = s.customer_id""",
       digits={**digits(2, "total_purchases_usd", "total_discounts_usd"), **digits(4, "avg_order_size"), **_PARTS})
def customer_behavior(spark, sf_dir) -> DataFrame:
    """Orders, brands, shares and conversions of every customer."""
    return behavior(spark, sf_dir)
