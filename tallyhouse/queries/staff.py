"""Order view, staff figures, training return, order dashboard, file imports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import staff as ops
from ..operators.joins import touch_both_ways
from ..plans.orders import flatfile_order_lines as flatfile
from ..plans.orders import flatfile_orders as file_orders
from ..plans.orders import order_dashboard as dashboard
from ..session import cut_lineage
from ..sources import star
from .registry import AS_OF, LINES, POP, TOTALS, at, digits, query


def _sales(spark, sf_dir) -> DataFrame:
    """Lines under the names of the order view; the seller is the order's first."""
    heads = star.order_totals(spark, sf_dir).select(
        "org_uuid", "order_id", "order_source", "order_type", "store", F.col("store_id").alias("store_uuid"),
        "order_time_local", "order_time_utc", F.concat(F.lit("sam "), "sold_by_id")
        .alias("sold_by"), "sold_by_id", "customer_id", "user_type", "phone",
        F.col("order_tot").alias("order_total"), F.col("order_disc").alias("order_discount"),
        F.col("order_subtot").alias("order_subtotal"), F.lit(0.0).alias("order_tax"))
    return star.lines(spark, sf_dir).drop("sold_by_id").join(heads, "order_id")


def _preorders(spark, sf_dir) -> DataFrame:
    """What customers had ordered ahead: app orders, at the price before discount."""
    o = star.order_totals(spark, sf_dir).where("order_source = 'app'")
    return o.groupBy("org_uuid", "store", "phone", F.to_date("order_time_local").alias("order_dt")).agg(
        F.sum("order_tot").alias("amount"), F.sum("order_subtot").alias("item_lvl_list_price"),
        F.lit(4.0).alias("item_qty"))


_INFO = f"""WITH {TOTALS}, {LINES},
pre AS (SELECT org_uuid, store, phone, CAST(order_time_local AS DATE) AS order_dt, sum(order_tot) AS amount,
          sum(order_subtot) AS list_price, 4.0 AS item_qty
        FROM totals WHERE order_source = 'app' GROUP BY ALL),
cnt AS (SELECT order_id, count(DISTINCT order_line_id) AS order_lines,
          count(DISTINCT product_id) AS products, count(DISTINCT brand_name) AS brands,
          count(DISTINCT raw_category_name) AS categories FROM lines GROUP BY 1),
info AS (
  SELECT t.org_uuid, t.order_id, t.store, t.store_id AS store_uuid, t.order_time_local, t.order_type,
    'SAM ' || t.sold_by_id AS sold_by, t.sold_by_id, t.customer_id, t.order_subtot AS order_subtotal,
    t.order_disc AS order_discount, c.order_lines, c.products, c.brands, c.categories,
    CAST(t.order_time_local AS DATE) AS order_dt,
    CAST(t.order_time_local AS DATE) >= DATE '2001-08-02' - 400 AS in_eval_period,
    coalesce(order_source, '') = 'app' AS was_pickup,
    round_even(t.order_subtot - t.order_disc, 0) > round_even(pre.list_price, 0) AS is_upsell,
    t.order_subtot - t.order_disc - pre.list_price AS preorder_change_dollars,
    c.order_lines - pre.item_qty AS preorder_change_units,
    CASE WHEN order_type = 'Retail' THEN CASE WHEN coalesce(order_source, '') <> 'app' THEN 'WALK-IN'
           WHEN pre.amount IS NOT NULL THEN 'PREORDER' ELSE 'PREORDER - NO ECOMM' END
         WHEN order_type = 'Delivery' THEN 'DELIVERY' ELSE 'OTHER' END AS channel
  FROM totals t JOIN cnt c USING (order_id)
  LEFT JOIN pre ON pre.org_uuid = t.org_uuid AND pre.store = t.store AND pre.phone = t.phone
    AND pre.order_dt = CAST(t.order_time_local AS DATE))"""


def _info(spark, sf_dir) -> DataFrame:
    return ops.order_info(_sales(spark, sf_dir), at(AS_OF), preorders=_preorders(spark, sf_dir),
                          eval_days=400)


@query(_INFO + """
SELECT order_id, sold_by, order_lines, products, brands, categories, order_dt, in_eval_period,
  was_pickup, is_upsell, preorder_change_dollars, preorder_change_units::DOUBLE
  AS preorder_change_units, channel FROM info
""", digits=digits(4, "preorder_change_dollars"))
def order_info(spark, sf_dir) -> DataFrame:
    """Orders with distinct counts, channel and change against the preorder."""
    return _info(spark, sf_dir).select(
        "order_id", "sold_by", "order_lines", "products", "brands", "categories", "order_dt",
        "in_eval_period", "was_pickup", "is_upsell", "preorder_change_dollars",
        "preorder_change_units", "channel")


_KPIS = _INFO + """,
recent AS (SELECT DISTINCT org_uuid, sold_by_id FROM info
           WHERE CAST(order_time_local AS DATE) > DATE '2001-08-02' - 400),
k0 AS (
  SELECT org_uuid, sold_by, sold_by_id, in_eval_period, store, store_uuid, min(order_dt) AS first_dt,
    count(DISTINCT order_dt) AS tenure_days, count(DISTINCT order_id) AS orders,
    sum(order_subtotal) AS pretax_sales,
    count(DISTINCT order_id) FILTER (WHERE was_pickup) AS preorders,
    quantile_cont(hour(order_time_local), 0.5) AS busiest_hr,
    avg(order_subtotal) FILTER (WHERE channel = 'WALK-IN') AS ticket_size,
    avg(order_discount / nullif(order_subtotal - order_discount, 0))
      FILTER (WHERE channel = 'WALK-IN') AS pct_disc,
    count(*) FILTER (WHERE channel = 'PREORDER' AND is_upsell)
      / nullif(count(DISTINCT order_id) FILTER (WHERE channel = 'PREORDER'), 0)::DOUBLE
      AS pct_upsold,
    coalesce(sum(preorder_change_dollars) FILTER (WHERE channel = 'PREORDER' AND is_upsell), 0)
      / nullif(count(*) FILTER (WHERE channel = 'PREORDER' AND is_upsell), 0)::DOUBLE
      AS mean_upsell
  FROM info WHERE order_dt > DATE '2001-08-02' - 2000 AND order_discount <= 0
    AND order_subtotal >= 0 AND order_type = 'Retail' AND (org_uuid, sold_by_id) IN (SELECT (org_uuid, sold_by_id) FROM recent)
  GROUP BY ALL),
kpis AS (SELECT * FROM (
  SELECT *, lag(orders) OVER w AS starting_vol,
    ticket_size / lag(ticket_size) OVER w - 1 AS ticket_size_chng,
    pct_disc / nullif(lag(pct_disc) OVER w, 0) - 1 AS pct_disc_chng,
    pct_upsold / nullif(lag(pct_upsold) OVER w, 0) - 1 AS pct_upsold_chng
  FROM k0 WINDOW w AS (PARTITION BY org_uuid, sold_by, sold_by_id, store ORDER BY in_eval_period))
  WHERE in_eval_period)"""


def _kpis(spark, sf_dir) -> DataFrame:
    return ops.staff_kpis(_info(spark, sf_dir), at(AS_OF), history_days=2000, recent_days=400)


@query(_KPIS + """
SELECT sold_by, store, first_dt, tenure_days, orders, pretax_sales, preorders, busiest_hr,
  ticket_size, pct_disc, pct_upsold, mean_upsell, starting_vol, ticket_size_chng, pct_disc_chng,
  pct_upsold_chng FROM kpis
""", digits={**digits(2, "pretax_sales"),
             **digits(6, "ticket_size", "pct_disc", "pct_upsold", "mean_upsell",
                      "ticket_size_chng", "pct_disc_chng", "pct_upsold_chng")})
def staff_kpis(spark, sf_dir) -> DataFrame:
    """Tenure, volume, ticket, discount and upsell per staff member, with change."""
    return _kpis(spark, sf_dir).select(
        "sold_by", "store", "first_dt", "tenure_days", "orders", "pretax_sales", "preorders",
        "busiest_hr", "ticket_size", "pct_disc", "pct_upsold", "mean_upsell", "starting_vol",
        "ticket_size_chng", "pct_disc_chng", "pct_upsold_chng")


@query(_KPIS + """,
t AS (SELECT *, avg(ticket_size) OVER w AS mean, stddev_samp(ticket_size) OVER w AS sd
      FROM kpis WINDOW w AS (PARTITION BY org_uuid, store))
SELECT org_uuid, sold_by AS staff, sold_by_id AS pos_id, store, store_uuid, 'ticket_size' AS kpi,
  ticket_size AS current_value, ticket_size_chng AS change, ticket_size / mean - 1 AS distance,
  (mean - ticket_size) * (orders - preorders) AS rev_opportunity, mean - sd AS threshold, mean
FROM t WHERE ticket_size < mean - sd
""", digits=digits(4, "current_value", "change", "distance", "rev_opportunity", "threshold",
                   "mean"))
def training_targets(spark, sf_dir) -> DataFrame:
    """Staff with tickets far below their shop's mean."""
    return ops.training_targets(_kpis(spark, sf_dir), "ticket_size")


@query(_KPIS + """,
t AS (SELECT *, avg(pct_disc) OVER w AS mean, stddev_samp(pct_disc) OVER w AS sd
      FROM kpis WINDOW w AS (PARTITION BY org_uuid, store))
SELECT sold_by AS staff, store, pct_disc AS current_value,
  pretax_sales / 1 + mean - pretax_sales AS rev_opportunity, mean + 1.5 * sd AS threshold
FROM t WHERE pct_disc > mean + 1.5 * sd
""", digits={**digits(6, "current_value", "threshold"), **digits(4, "rev_opportunity")})
def discount_training_targets(spark, sf_dir) -> DataFrame:
    """Staff who give far more discount than their shop's mean."""
    return ops.training_targets(_kpis(spark, sf_dir), "pct_disc", sensitivity=1.5,
                                direction="over").select(
        "staff", "store", "current_value", "rev_opportunity", "threshold")


def _trained(spark, sf_dir) -> DataFrame:
    """Orders around courses; large orders of another channel stand for courses."""
    o = cut_lineage(_info(spark, sf_dir)).withColumn("posId", F.col("sold_by_id"))
    courses = o.where("channel = 'OTHER' AND order_subtotal > 300000").select(
        "org_uuid", "posId", F.col("order_id").alias("course_id"), F.col("order_time_utc").alias("done"))
    return touch_both_ways(
        o.select("org_uuid", "posId", "order_id", "order_time_utc", "sold_by", "store", "store_uuid",
                 "order_subtotal", "is_upsell", "preorder_change_dollars"), courses, ["org_uuid", "posId"],
        order_time="order_time_utc", course_time="done", course_id="course_id",
        order_tie=["order_id"], bucket="year", stage=cut_lineage)


_DAYS = (7, 14, 30, 60, 90)
_TRAINED = _INFO + """,
course AS (SELECT org_uuid, sold_by_id, order_id AS cid, order_time_local AS done FROM info
           WHERE channel = 'OTHER' AND order_subtotal > 300000),
pairs AS (
  SELECT i.*, (SELECT max(done) FROM course c WHERE c.org_uuid = i.org_uuid
                 AND c.sold_by_id = i.sold_by_id AND c.done < i.order_time_local) AS last_done,
    (SELECT min(done) FROM course c WHERE c.org_uuid = i.org_uuid AND c.sold_by_id = i.sold_by_id
       AND c.done >= i.order_time_local) AS next_done
  FROM info i WHERE (i.org_uuid, i.sold_by_id) IN (SELECT (org_uuid, sold_by_id) FROM course)),
t AS (SELECT *, coalesce(last_done, next_done) AS course_ts_utc,
        date_diff('microsecond', last_done, order_time_local) / 86400000000.0 AS since,
        date_diff('microsecond', order_time_local, next_done) / 86400000000.0 AS until
      FROM pairs)"""
_TICKET = ", ".join(
    f"count(DISTINCT order_id) FILTER (WHERE since <= {d}) AS n{d}, "
    f"avg(order_subtotal) FILTER (WHERE since <= {d}) AS post{d}, "
    f"avg(order_subtotal) FILTER (WHERE until <= {d}) AS pre{d}" for d in _DAYS)
_REPORT = ", ".join(
    f"pre{d} AS pre_{d}day, post{d} AS post_{d}day, (post{d} - pre30) / nullif(pre30, 0) "
    f"AS uplift_{d}day, (post{d} - pre30) * {{worth}} AS dollars_added_{d}day".replace(
        "{worth}", f"w{d}") for d in _DAYS)
_NAMES = [f"{n}_{d}day" for d in _DAYS for n in ("pre", "post", "uplift", "dollars_added")]
_HEAD = ("'demo' AS org_uuid, 'c1' AS course_id, store, store_uuid, sold_by, "
         "sold_by_id AS pos_id, course_ts_utc, date_diff('day', CAST(course_ts_utc AS DATE), "
         "DATE '2001-08-02') AS days_since_course")


@query(_TRAINED + f"""
SELECT {_HEAD}, 'ticket_size' AS kpi, {_REPORT} FROM (
  SELECT *, {", ".join(f"n{d} AS w{d}" for d in _DAYS)} FROM (
    SELECT sold_by, sold_by_id, course_ts_utc, store, store_uuid, {_TICKET} FROM t GROUP BY ALL))
""", digits=digits(4, *_NAMES))
def ticket_roi(spark, sf_dir) -> DataFrame:
    """Ticket before and after a course in five horizons."""
    return ops.ticket_roi(_trained(spark, sf_dir), at(AS_OF), course="c1", org="demo")


_UPSELL = ", ".join(
    f"count(DISTINCT order_id) FILTER (WHERE since <= {d}) AS n{d}, "
    f"count(DISTINCT order_id) FILTER (WHERE since <= {d} AND is_upsell) AS u{d}, "
    f"count(DISTINCT order_id) FILTER (WHERE until <= {d}) AS bn{d}, "
    f"count(DISTINCT order_id) FILTER (WHERE until <= {d} AND is_upsell) AS bu{d}, "
    f"coalesce(sum(preorder_change_dollars) FILTER (WHERE since <= {d} AND is_upsell), 0) AS g{d}"
    for d in _DAYS)
_UPSOLD = ", ".join(
    f"u{d} / nullif(n{d}, 0)::DOUBLE AS post{d}, bu{d} / nullif(bn{d}, 0)::DOUBLE AS pre{d}, "
    f"n{d} * (g{d} / nullif(u{d}, 0)::DOUBLE) AS w{d}" for d in _DAYS)


@query(_TRAINED + f"""
SELECT {_HEAD}, 'pct_upsold' AS kpi, {_REPORT} FROM (SELECT *, {_UPSOLD} FROM (
  SELECT sold_by, sold_by_id, course_ts_utc, store, store_uuid, {_UPSELL} FROM t GROUP BY ALL))
""", digits=digits(4, *_NAMES))
def upsell_roi(spark, sf_dir) -> DataFrame:
    """Share of preorders sold up before and after a course."""
    return ops.upsell_roi(_trained(spark, sf_dir), at(AS_OF), course="c1", org="demo")


# The same for all courses at once: course -> figure, sensitivity, direction, bounds, organisation.
_COURSES = {
    "c-ticket": ("ticket_size", 0.5, "under", [("starting_vol", 2.0, None), ("walk_in_orders", 1.0, None),
                                               ("ticket_size_chng", -1.0, 1.0)], None),
    "c-upsell": ("pct_upsold", 0.5, "under", [("starting_vol", 1.0, None), ("preorders", 0.0, None)], None),
    "c-discount": ("pct_disc", 1.0, "over", [], "org-1")}


def _rules(spark) -> DataFrame:
    return spark.createDataFrame([(org, course, kpi, sensitivity, direction, bounds) for course, (
        kpi, sensitivity, direction, bounds, org) in _COURSES.items()], ops.RULE_DDL)


def _rule_sql(course: str) -> str:
    kpi, sensitivity, direction, bounds, org = _COURSES[course]
    names = {"walk_in_orders": "orders - preorders"}
    kept = [f"org_uuid = '{org}'"] if org else []
    for figure, low, high in bounds:
        kept += [f"{names.get(figure, figure)} > {low}"] if low is not None else []
        kept += [f"{names.get(figure, figure)} < {high}"] if high is not None else []
    sign, beyond = ("-", "<") if direction == "under" else ("+", ">")
    worth = {"ticket_size": "(mean - ticket_size) * (orders - preorders)",
             "pct_upsold": "(mean - pct_upsold) * preorders * mean_upsell",
             "pct_disc": "pretax_sales / 1 + mean - pretax_sales"}[kpi]
    return f"""
SELECT org_uuid, '{course}' AS course_id, sold_by AS staff, sold_by_id AS pos_id, store, store_uuid, '{kpi}' AS kpi,
  {kpi} AS current_value, {kpi}_chng AS change, {kpi} / nullif(mean, 0) - 1 AS distance, {worth} AS rev_opportunity,
  mean {sign} {sensitivity} * sd AS threshold, mean
FROM (SELECT *, avg({kpi}) OVER w AS mean, stddev_samp({kpi}) OVER w AS sd FROM kpis WHERE {" AND ".join(kept) or "true"}
      WINDOW w AS (PARTITION BY org_uuid, store))
WHERE {kpi} {beyond} mean {sign} {sensitivity} * sd"""


@query(_KPIS + " UNION ALL ".join(map(_rule_sql, _COURSES)),
       digits=digits(4, "current_value", "change", "distance", "rev_opportunity", "threshold", "mean"))
def course_targets(spark, sf_dir) -> DataFrame:
    """Training targets of every course in every organisation, rules as a table."""
    return ops.course_targets(cut_lineage(_kpis(spark, sf_dir)), _rules(spark))


_RESULTS = _INFO + """,
done AS (SELECT DISTINCT org_uuid, sold_by_id, CASE WHEN CAST(order_id AS BIGINT) % 2 = 0 THEN 'c-ticket' ELSE 'c-upsell' END
           AS course_id, order_time_local AS done FROM info WHERE channel = 'OTHER' AND order_subtotal > 200000),
sold AS (SELECT i.*, d.course_id FROM info i JOIN (SELECT DISTINCT org_uuid, sold_by_id, course_id FROM done) d
         USING (org_uuid, sold_by_id) WHERE was_pickup = (d.course_id = 'c-upsell')),
pairs AS (
  SELECT s.*, (SELECT max(done) FROM done c WHERE c.org_uuid = s.org_uuid AND c.sold_by_id = s.sold_by_id
                 AND c.course_id = s.course_id AND c.done < s.order_time_local) AS last_done,
    (SELECT min(done) FROM done c WHERE c.org_uuid = s.org_uuid AND c.sold_by_id = s.sold_by_id
       AND c.course_id = s.course_id AND c.done >= s.order_time_local) AS next_done
  FROM sold s),
t AS (SELECT *, coalesce(last_done, next_done) AS course_ts_utc,
        date_diff('microsecond', last_done, order_time_local) / 86400000000.0 AS since,
        date_diff('microsecond', order_time_local, next_done) / 86400000000.0 AS until
      FROM pairs)"""
_RESULT_HEAD = ("org_uuid, course_id, store, store_uuid, sold_by, sold_by_id AS pos_id, course_ts_utc, "
                "date_diff('day', CAST(course_ts_utc AS DATE), DATE '2001-08-02') AS days_since_course")
_RESULT_KEYS = "org_uuid, course_id, sold_by, sold_by_id, course_ts_utc, store, store_uuid"


@query(_RESULTS + f"""
SELECT {_RESULT_HEAD}, 'ticket_size' AS kpi, {_REPORT} FROM (
  SELECT *, {", ".join(f"n{d} AS w{d}" for d in _DAYS)} FROM (
    SELECT {_RESULT_KEYS}, {_TICKET} FROM t WHERE course_id = 'c-ticket' GROUP BY ALL))
UNION ALL SELECT {_RESULT_HEAD}, 'pct_upsold' AS kpi, {_REPORT} FROM (SELECT *, {_UPSOLD} FROM (
  SELECT {_RESULT_KEYS}, {_UPSELL} FROM t WHERE course_id = 'c-upsell' GROUP BY ALL))
""", digits=digits(4, *_NAMES))
def course_results(spark, sf_dir) -> DataFrame:
    """Before and after of every course in every organisation."""
    info = cut_lineage(_info(spark, sf_dir))
    even = F.col("order_id").cast("bigint") % 2 == 0
    done = info.where("channel = 'OTHER' AND order_subtotal > 200000").select(
        "org_uuid", F.col("sold_by_id").alias("posId"), F.when(even, "c-ticket").otherwise("c-upsell").alias("course_id"),
        F.col("order_time_utc").alias("done"))
    return ops.course_results(info, done, _rules(spark), at(AS_OF), bucket="year", stage=cut_lineage)


@query(f"""WITH {TOTALS}, {LINES}
SELECT org_uuid, order_id, order_line_id, coalesce(CASE WHEN order_type <> 'Delivery' THEN order_disc END, line_sum) AS order_discount
FROM (SELECT t.org_uuid, t.order_id, l.order_line_id, t.order_type, t.order_disc, t.store_id, t.sold_by_id, sum(l.item_discount) OVER (
        PARTITION BY t.org_uuid, t.order_id) AS line_sum FROM lines l JOIN totals t ON l.order_id = t.order_id)
WHERE NOT (org_uuid = 'org-2' AND CAST(sold_by_id AS BIGINT) < 20)
  AND NOT (store_id = 'store-3' AND CAST(sold_by_id AS BIGINT) < 60)
""", digits=digits(4, "order_discount"))
def training_lines(spark, sf_dir) -> DataFrame:
    """Lines without excluded staff, order discounts filled from the lines."""
    sales = _sales(spark, sf_dir).withColumnRenamed("item_discount", "order_line_discount").withColumn(
        "order_discount", F.when(F.col("order_type") != "Delivery", F.col("order_discount")))
    staff = star.load(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("sold_by_id"), "s_suppkey")
    here = sales.where("store_uuid = 'store-3' AND CAST(sold_by_id AS BIGINT) < 60")
    excluded = staff.where("s_suppkey < 20").select(F.lit("org-2").alias("org_uuid"), F.lit(None).cast("string").alias(
        "store_uuid"), "sold_by_id").unionByName(here.select("org_uuid", "store_uuid", "sold_by_id").distinct())
    return ops.fill_order_discount(ops.without_excluded(sales, excluded)).select(
        "org_uuid", "order_id", "order_line_id", "order_discount")


_ZONES = {"org-0": "America/New_York", "org-1": "America/Los_Angeles"}


def zone_of(org: str):
    """Each organisation's time zone; Tokyo for the others."""
    return F.coalesce(*[F.when(F.col(org) == o, z) for o, z in _ZONES.items()], F.lit("Asia/Tokyo"))


_ZONE = "CASE org_uuid " + " ".join(f"WHEN '{o}' THEN '{z}'" for o, z in _ZONES.items()) + " ELSE 'Asia/Tokyo' END"


@query(f"WITH {TOTALS} " + f"""
SELECT org_uuid, store AS facility, phone, CAST((order_time_utc AT TIME ZONE 'UTC')
    AT TIME ZONE {_ZONE} AS DATE) AS order_dt, sum(order_tot) AS amount,
  count(DISTINCT order_id) AS orders, count(*) AS items, sum(order_subtot) AS item_lvl_list_price,
  sum(order_subtot + order_disc) AS item_lvl_subtotal, sum(2.0::DOUBLE) AS item_qty
FROM totals WHERE order_source = 'app' GROUP BY ALL
""", digits={**digits(2, "amount", "item_lvl_list_price"), **digits(4, "item_lvl_subtotal"),
             **digits(1, "item_qty")})
def preorder_summary(spark, sf_dir) -> DataFrame:
    """Pickup orders per facility, phone and the organisation's local day."""
    o = star.order_totals(spark, sf_dir)
    rows = o.select(
        "org_uuid", F.col("store").alias("facility"), "phone", F.col("order_id").alias("pickup_id"),
        F.when(F.col("order_source") == "app", "pickup").otherwise("delivery")
        .alias("reservation_mode"), F.col("order_time_utc").alias("reservation_start_window"),
        F.col("order_tot").alias("amount"), F.lit(1).alias("items"),
        F.col("order_subtot").alias("item_lvl_list_price"),
        (F.col("order_subtot") + F.col("order_disc")).alias("item_lvl_subtotal"),
        F.lit(2.0).alias("item_qty"))
    return ops.preorder_summary(rows, zone_of("org_uuid"))


@query("""
SELECT o_orderkey, (o_orderkey % 90)::DOUBLE AS update_to_res, -30.0::DOUBLE AS res_to_checkout,
  40.0::DOUBLE AS created_to_checkout FROM orders
""")
def reservation_durations(spark, sf_dir) -> DataFrame:
    """Minutes between the stages of a reservation."""
    def later(minutes):
        return F.timestamp_seconds(F.unix_timestamp("o_orderdate") + minutes * 60)

    rows = star.load(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("reservation_start_window"),
        later(F.col("o_orderkey") % 90).alias("updated_at_time"),
        later(F.lit(30)).alias("checked_out_time"), later(F.lit(-10)).alias("created_at"))
    return ops.reservation_durations(rows).select("o_orderkey", "update_to_res",
                                                  "res_to_checkout", "created_to_checkout")


@query(f"WITH {POP} " + """
SELECT order_id, order_line_id, customer_id, full_name || ' Smith' AS full_name,
  CASE WHEN order_type = 'Delivery' THEN 15.0::DOUBLE END AS dur_process,
  CASE WHEN order_type = 'Delivery' THEN 45.0::DOUBLE END AS dur_total,
  CAST(order_time_utc AS DATE) = first AS is_first_order,
  CASE WHEN order_type = 'Retail' THEN upper(org)
       WHEN CAST(customer_id AS BIGINT) % 10 < 5 THEN 'TOWN ' || CAST(customer_id AS BIGINT) % 10
       ELSE 'FAR' END AS city
FROM (SELECT *, min(CAST(order_time_utc AS DATE)) OVER (PARTITION BY org, customer_id) AS first FROM pop)
WHERE order_type <> 'Other'
""")
def order_dashboard(spark, sf_dir) -> DataFrame:
    """Lines with durations, first-order flag and city."""
    pop = star.population(spark, sf_dir)
    t = F.unix_timestamp("order_time_utc")
    sent = F.col("order_type") == "Delivery"
    rows = pop.withColumns({
        "first_name": F.col("full_name"), "last_name": F.lit("Smith"),
        "delivery_order_received_local": F.when(sent, F.timestamp_seconds(t)),
        "delivery_order_started_local": F.when(sent, F.timestamp_seconds(t + 900)),
        "delivery_order_complete_local": F.when(sent, F.timestamp_seconds(t + 2700)),
        "customer_city": F.when(F.col("order_type") == "Retail", F.lower("org")),
        "delivery_order_city": F.lit("far"),
        "delivery_order_zipcode": (F.col("customer_id").cast("bigint") % 10).cast("string"),
        "order_facility": F.when(F.col("order_type") != "Other", F.col("store"))}).drop("full_name")
    zips = star.load(spark, sf_dir, "nation").where("n_nationkey < 5").select(
        F.col("n_nationkey").cast("string").alias("zipcode"),
        F.concat(F.lit("Town "), "n_nationkey").alias("zipcity"))
    return dashboard(rows, zips).select("order_id", "order_line_id", "customer_id", "full_name",
                                        "dur_process", "dur_total", "is_first_order", "city")


@query("""
WITH latest AS (
  SELECT l_orderkey, product_name, row_no, q, price, cat FROM (
    SELECT l.l_orderkey, upper(p_name) || ' ' || l_partkey AS product_name,
           l.l_orderkey * 100 + 10 + l.l_linenumber AS row_no, l_quantity AS q,
           l_extendedprice AS price, lower(p_type) AS cat, row_number() OVER (
             PARTITION BY l_orderkey, l_partkey ORDER BY l_orderkey * 100 + 10 + l_linenumber DESC,
             CAST(l_quantity AS VARCHAR) DESC, CAST(l_extendedprice AS VARCHAR) DESC) AS rn
    FROM lineitem l JOIN part ON l_partkey = p_partkey) WHERE rn = 1)
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(row_number() OVER (PARTITION BY l_orderkey
    ORDER BY product_name, row_no) AS VARCHAR) AS order_line_id, product_name,
  product_name AS brand_name, q AS product_qty, price AS order_line_list_price,
  CAST(o_custkey AS VARCHAR) AS customer_id, upper(cat) AS product_category_name
FROM latest JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus <> 'P' AND c_mktsegment <> 'BUILDING'
""")
def flatfile_order_lines(spark, sf_dir) -> DataFrame:
    """Lines of an exported file whose order fields stand on one row only."""
    o, li = star.load(spark, sf_dir, "orders"), star.load(spark, sf_dir, "lineitem")
    p, c = star.load(spark, sf_dir, "part"), star.load(spark, sf_dir, "customer")
    none = F.lit(None).cast("string")
    sold = li.select("l_orderkey").distinct()
    heads = o.join(sold, o["o_orderkey"] == sold["l_orderkey"], "left_semi").join(
        c, o["o_custkey"] == c["c_custkey"]).select(
        (F.col("o_orderkey") * 100).alias("row_no"),
        F.col("o_orderkey").cast("string").alias("order_number"),
        F.concat(F.lit("Pat "), "c_name").alias("patient"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("created_at"),
        F.when(F.col("o_orderstatus") == "P", "Returned").otherwise("Completed").alias("status"),
        none.alias("qty"), none.alias("product"), none.alias("product_category"),
        none.alias("amount"), none.alias("price"), none.alias("uom"))
    lines = li.join(p, li["l_partkey"] == p["p_partkey"]).select(
        (F.col("l_orderkey") * 100 + 10 + F.col("l_linenumber")).alias("row_no"),
        none.alias("order_number"), none.alias("patient"), none.alias("created_at"),
        none.alias("status"), F.col("l_quantity").cast("string").alias("qty"),
        F.concat_ws(" ", "p_name", "l_partkey").alias("product"),
        F.initcap("p_type").alias("product_category"), none.alias("amount"),
        F.col("l_extendedprice").cast("string").alias("price"), F.lit("g").alias("uom"))
    raw = heads.unionByName(lines).withColumn("run_date_utc",
                                              F.lit("2001-08-01").cast("timestamp"))
    patients = c.select(F.lit("Pat").alias("first_name"), F.col("c_name").alias("last_name"),
                        F.when(F.col("c_mktsegment") != "BUILDING",
                               F.col("c_custkey").cast("string")).alias("patient_id"),
                        F.lit(1).alias("total_completed_orders"))
    cats = p.select(F.lower("p_type").alias("raw_category_name"),
                    F.col("p_type").alias("product_category_name")).distinct()
    return flatfile(raw, patients, cats, org="demo", source_system="file").select(
        "order_id", "order_line_id", "product_name", "brand_name", "product_qty",
        "order_line_list_price", "customer_id", "product_category_name")


@query("""
SELECT 'demo' AS org, 'file' AS source_system, CAST(o_orderkey AS VARCHAR) AS order_id, CAST(c_custkey AS VARCHAR) AS customer_id,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'Delivery' ELSE 'Retail' END AS order_type, lower(o_orderpriority) AS order_source,
  o_orderdate + to_minutes(o_orderkey % 1440) AS order_time_local,
  ((o_orderdate + to_minutes(o_orderkey % 1440)) AT TIME ZONE 'America/Phoenix') AT TIME ZONE 'UTC' AS order_time_utc,
  CASE WHEN c_custkey % 3 > 0 THEN '1 Main St AZ ' || c_custkey END AS delivery_order_address,
  CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate + to_minutes(o_orderkey % 1440) END AS delivery_order_received_local,
  o_totalprice - 8.5 AS order_subtotal, 8.5::DOUBLE AS order_tax, o_totalprice AS order_total, -2.25::DOUBLE AS order_discount
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus <> 'P' AND c_mktsegment <> 'BUILDING'
""", digits=digits(2, "order_subtotal", "order_total", "order_discount"))
def flatfile_orders(spark, sf_dir) -> DataFrame:
    """Orders of an exported file: header rows first, total rows last, an older copy of every order in another export."""
    o, c = star.load(spark, sf_dir, "orders"), star.load(spark, sf_dir, "customer")
    rows = o.join(c, o["o_custkey"] == c["c_custkey"])
    none = F.lit(None).cast("string")
    at = F.timestamp_seconds(F.unix_timestamp("o_orderdate") + F.col("o_orderkey") % 1440 * 60)
    written = F.when(F.col("o_orderkey") % 2 == 0, F.date_format(at, "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format(at, "M/d/yyyy H:mm"))
    heads = rows.select(
        (F.col("o_orderkey") * 10).alias("row_no"), F.col("o_orderkey").cast("string").alias("order_number"),
        F.concat(F.lit("Pat "), "c_name").alias("patient"), written.alias("created_at"),
        F.when(F.col("o_orderstatus") == "P", "Returned").otherwise("Completed").alias("status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Home Delivery").otherwise("Store").alias("type"),
        F.lower("o_orderpriority").alias("order_source"), F.lit("1").alias("qty"), none.alias("subtotal"), none.alias("sales_tax"),
        none.alias("total"))
    ends = rows.select(
        (F.col("o_orderkey") * 10 + 5).alias("row_no"), *[none.alias(n) for n in (
            "order_number", "patient", "created_at", "status", "type", "order_source", "qty")],
        (F.col("o_totalprice") - 8.5 + 2.25).cast("string").alias("subtotal"), F.lit("8.5").alias("sales_tax"),
        F.col("o_totalprice").cast("string").alias("total"))
    file = heads.unionByName(ends).withColumn("run_date_utc", F.lit("2001-08-01").cast("timestamp"))
    older = heads.withColumn("created_at", F.lit("0")).unionByName(ends.withColumn("total", F.lit("0"))).withColumn(
        "run_date_utc", F.lit("2001-07-01").cast("timestamp"))
    patients = c.select(
        F.lit("Pat").alias("first_name"), F.col("c_name").alias("last_name"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey").cast("string")).alias("patient_id"),
        F.lit(1).alias("total_completed_orders"), F.lit("1  Main St ").alias("address"), none.alias("city"), F.lit("AZ").alias("state"),
        F.when(F.col("c_custkey") % 3 > 0, F.col("c_custkey").cast("string")).alias("zip"))
    return file_orders(file.unionByName(older), patients, org="demo", source_system="file", zone="America/Phoenix").drop(
        "source_run_date_utc", "sold_by", "sold_by_id", "delivery_order_started_local", "delivery_order_complete_local")
