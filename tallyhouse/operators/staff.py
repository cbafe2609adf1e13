"""Staff: order view, key figures, training targets and training return."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import distinct_days, minutes_between
from ..functions.orders import channel, is_pickup
from ..session import Stage, lazily
from .joins import touch_both_ways
from .ordered import Bucket, with_group_stats


def fill_order_discount(lines: DataFrame, org: str = "org_uuid") -> DataFrame:
    """Where an order has no discount of its own, the sum of its lines' discounts; a line without one counts 0."""
    lines = with_group_stats(lines, [org, "order_id"], F.coalesce(F.sum("order_line_discount"), F.lit(0.0)).alias("__sum"))
    return lines.withColumn("order_discount", F.coalesce("order_discount", "__sum")).drop("__sum", "order_line_discount")


def without_excluded(lines: DataFrame, excluded: DataFrame, org: str = "org_uuid") -> DataFrame:
    """Lines of sellers who are not excluded, from one store or, where the list names no store, from all of the organisation's.

    Lines without a seller stay.
    """
    everywhere = excluded.where(F.col("store_uuid").isNull()).select(org, "sold_by_id").distinct()
    somewhere = excluded.where(F.col("store_uuid").isNotNull()).select(org, "store_uuid", "sold_by_id").distinct()
    return lines.join(everywhere, [org, "sold_by_id"], "left_anti").join(
        somewhere, [org, "store_uuid", "sold_by_id"], "left_anti")


def order_info(population: DataFrame, as_of: Column, *, preorders: DataFrame | None = None,
               eval_days: int = 30, org: str = "org_uuid") -> DataFrame:
    """One row per order with distinct counts, pickup flag and sales channel.

    With a preorder table each order is compared with what its customer had
    ordered ahead for that shop of the organisation and day.
    """
    attributes = [org, "order_id", "order_source", "order_type", "store", "store_uuid",
                  "order_time_local", "order_time_utc", "sold_by", "sold_by_id", "customer_id",
                  "user_type", "phone", "order_total", "order_discount", "order_subtotal",
                  "order_tax"]

    def different(column):
        # The sets of one order are small, and several of them share one pass.
        return F.size(F.collect_set(column)).cast("long")

    orders = (population.withColumn("sold_by", F.upper("sold_by")).groupBy(*attributes)
              .agg(different("order_line_id").alias("order_lines"),
                   different("product_id").alias("products"),
                   different("brand_name").alias("brands"),
                   different("raw_category_name").alias("categories"))
              .withColumn("order_dt", F.to_date("order_time_local"))
              .withColumn("in_eval_period", F.col("order_dt")
                          >= F.date_sub(F.to_date(as_of), eval_days))
              .withColumn("was_pickup", is_pickup(F.col("order_type"), F.col("order_source"))))
    if preorders is None:
        return (orders.withColumn("is_upsell", F.lit(None).cast("boolean"))
                .withColumn("preorder_change_dollars", F.lit(None).cast("double"))
                .withColumn("channel", channel(F.col("order_type"), F.col("was_pickup"))))
    paid, listed = F.col("order_subtotal") - F.col("order_discount"), F.col("item_lvl_list_price")
    return (orders.join(preorders, [org, "store", "phone", "order_dt"], "left")
            .withColumn("is_upsell", F.bround(paid) > F.bround(listed))
            .withColumn("is_downsell", F.bround(paid) < F.bround(listed))
            .withColumn("is_unit_upsell", F.col("order_lines") > F.col("item_qty"))
            .withColumn("is_unit_downsell", F.col("order_lines") < F.col("item_qty"))
            .withColumn("preorder_change_dollars", paid - listed)
            .withColumn("preorder_change_units", F.col("order_lines") - F.col("item_qty"))
            .withColumn("channel", channel(F.col("order_type"), F.col("was_pickup"),
                                           F.col("amount"))))


def preorder_summary(reservations: DataFrame, zone: str | Column = "America/New_York",
                     org: str = "org_uuid") -> DataFrame:
    """Pickup orders per organisation, facility, phone and local day; ``zone`` may be a column, so each organisation has its own."""
    pickups = reservations.where(F.col("reservation_mode").isin("pickup", "kiosk")
                                 & F.col("phone").isNotNull())
    local_day = F.to_date(F.from_utc_timestamp("reservation_start_window", zone))
    return pickups.groupBy(org, "facility", "phone", local_day.alias("order_dt")).agg(
        F.sum("amount").alias("amount"), F.count_distinct("pickup_id").alias("orders"),
        F.sum("items").alias("items"), F.sum("item_lvl_list_price").alias("item_lvl_list_price"),
        F.sum("item_lvl_subtotal").alias("item_lvl_subtotal"),
        F.sum("item_qty").alias("item_qty"))


def reservation_durations(reservations: DataFrame) -> DataFrame:
    """Minutes between a reservation's stages."""
    at = F.col
    return (reservations
            .withColumn("update_to_res", minutes_between(at("reservation_start_window"),
                                                         at("updated_at_time")))
            .withColumn("res_to_checkout", minutes_between(at("checked_out_time"),
                                                           at("reservation_start_window")))
            .withColumn("created_to_checkout", minutes_between(at("created_at"),
                                                               at("checked_out_time"))))


def staff_kpis(orders: DataFrame, as_of: Column, *, history_days: int = 180,
               recent_days: int = 30, org: str = "org_uuid") -> DataFrame:
    """Key figures of staff who sold recently, with change against the time before.

    Orders are counted once each: a first roll-up per order keeps the times of its rows, a second one spreads them
    and takes the order's own figures from its first row.
    """
    today = F.to_date(as_of)
    recent = (orders.where(F.to_date("order_time_local") > F.date_sub(today, recent_days))
              .select(org, "sold_by_id").distinct())
    sample = (orders.where((F.col("order_dt") > F.date_sub(today, history_days))
                           & F.col("sold_by").isNotNull() & (F.col("order_discount") <= 0)
                           & (F.col("order_subtotal") >= 0) & F.col("customer_id").isNotNull()
                           & (F.col("order_type") == "Retail"))
              .join(recent, [org, "sold_by_id"], "left_semi")
              .withColumn("sold_by", F.upper("sold_by")))
    walk_in, ahead = F.col("channel") == "WALK-IN", F.col("channel") == "PREORDER"
    upsold = ahead & F.col("is_upsell")
    ticket = F.when(walk_in, F.col("order_subtotal"))
    part = F.when(walk_in, F.try_divide(F.col("order_discount"), F.col("order_subtotal")
                                        - F.col("order_discount")))
    group = [org, "sold_by", "sold_by_id", "in_eval_period", "store", "store_uuid"]
    per_order = sample.groupBy(*group, "order_id").agg(
        F.collect_list(F.struct(F.col("order_dt").alias("dt"), F.hour("order_time_local").alias("hr"))).alias("at"),
        F.sum("order_subtotal").alias("sales"), F.bool_or("was_pickup").alias("pickup"),
        F.bool_or(ahead).alias("ahead"), F.count_if(upsold).alias("upsold"),
        F.sum(F.when(upsold, F.col("preorder_change_dollars"))).alias("gain"),
        F.sum(ticket).alias("ticket"), F.count(ticket).alias("tickets"),
        F.sum(part).alias("part"), F.count(part).alias("parts"))
    rows = per_order.select("*", F.posexplode("at").alias("i", "t"))
    first = F.col("i") == 0
    counted = first & F.col("order_id").isNotNull()

    def once(column):
        return F.sum(F.when(first, F.col(column)))

    figures = rows.groupBy(*group).agg(
        F.min("t.dt").alias("first_dt"), F.max("t.dt").alias("last_dt"),
        distinct_days(F.col("t.dt")).alias("tenure_days"),
        F.count_if(counted).alias("orders"), once("sales").alias("pretax_sales"),
        F.count_if(counted & F.col("pickup")).alias("preorders"),
        F.min("t.hr").alias("earliest_hr"), F.max("t.hr").alias("latest_hr"),
        # At most 24 distinct values, so the built-in keeps a small state.
        F.percentile("t.hr", F.lit(0.5)).alias("busiest_hr"),
        F.try_divide(once("ticket"), once("tickets")).alias("ticket_size"),
        F.try_divide(once("part"), once("parts")).alias("pct_disc"),
        once("upsold").alias("__upsold"),
        F.count_if(counted & F.col("ahead")).alias("__ahead"),
        F.coalesce(once("gain"), F.lit(0.0)).alias("__gain"))
    figures = (figures
               .withColumn("orders_per_day", F.try_divide("orders", "tenure_days"))
               .withColumn("preorders_per_day", F.try_divide("preorders", "tenure_days"))
               .withColumn("pct_upsold", F.try_divide("__upsold", "__ahead"))
               .withColumn("mean_upsell", F.try_divide("__gain", "__upsold"))
               .drop("__upsold", "__ahead", "__gain"))
    # Two rows per staff member and shop: before the evaluation period and in it.
    w = Window.partitionBy(org, "sold_by", "sold_by_id", "store").orderBy("in_eval_period",
                                                                           "store_uuid")

    def change(name):
        return F.try_divide(F.col(name), F.lag(name).over(w)) - 1

    return (figures.select(
        "*", F.lag("orders").over(w).alias("starting_vol"),
        F.lag("preorders").over(w).alias("starting_preorder_vol"),
        *[change(k).alias(f"{k}_chng")
          for k in ("ticket_size", "pct_disc", "pct_upsold", "mean_upsell")])
        .where("in_eval_period"))


TARGET_KPIS = ("ticket_size", "pct_disc", "pct_upsold")


def training_targets(kpis: DataFrame, kpi: str, *, sensitivity: float = 1,
                     direction: str = "under", org: str = "org_uuid") -> DataFrame:
    """Staff outside mean ± sensitivity·sd of their organisation's shop, with money at stake.

    A staff member without the figure is ignored in the shop's mean. The amount
    for ``pct_disc`` follows the source formula as written, in which the
    division by one binds first: (sales / 1 + mean) − sales, i.e. the mean.
    """
    if kpi not in TARGET_KPIS:
        raise ValueError(f"kpi must be one of {TARGET_KPIS}, got {kpi!r}")
    if direction not in ("under", "over"):
        raise ValueError(f"direction must be 'under' or 'over', got {direction!r}")
    rows = kpis.withColumns({"kpi": F.lit(kpi), "sensitivity": F.lit(float(sensitivity)),
                             "direction": F.lit(direction)})
    return _outside(rows, [org, "store"])


def _outside(rows: DataFrame, group: list[str]) -> DataFrame:
    """Rows outside their own ``kpi``, ``sensitivity`` and ``direction``, against the other rows of the group."""
    def of_kpi(suffix=""):
        return F.coalesce(*[F.when(F.col("kpi") == k, F.col(k + suffix)) for k in TARGET_KPIS])

    rows = rows.withColumns({"current_value": of_kpi(), "change": of_kpi("_chng")})
    value, mean = F.col("current_value"), F.col("mean")
    sales = F.col("pretax_sales")
    at_stake = (F.when(F.col("kpi") == "ticket_size", (mean - value) * (F.col("orders") - F.col("preorders")))
                .when(F.col("kpi") == "pct_upsold", (mean - value) * F.col("preorders") * F.col("mean_upsell"))
                .otherwise((sales / 1 + mean) - sales))
    under = F.col("direction") == "under"
    out = with_group_stats(rows, group, F.avg("current_value").alias("mean"),
                           F.stddev_samp("current_value").alias("sd"))
    out = out.withColumn("threshold", mean + F.col("sd") * F.col("sensitivity") * F.when(under, -1).otherwise(1))
    outside = F.when(under, value < F.col("threshold")).otherwise(value > F.col("threshold"))
    lead = [c for c in group if c != "store"]
    return out.where(outside).select(
        *lead, F.col("sold_by").alias("staff"), F.col("sold_by_id").alias("pos_id"), "store",
        "store_uuid", "kpi", "current_value", "change",
        (F.try_divide(value, mean) - 1).alias("distance"), at_stake.alias("rev_opportunity"), "threshold", "mean")


#: A course's rule: for which figure it is, how far outside the shop's mean a staff member must be, and which bounds (exclusive) of
#: figures they must keep to be compared at all. ``walk_in_orders`` stands for orders without preorders. A NULL organisation means all.
RULE_DDL = ("org_uuid string, course_id string, kpi string, sensitivity double, direction string, "
            "bounds array<struct<figure: string, low: double, high: double>>")
_FIGURES = ("starting_vol", "starting_preorder_vol", "orders", "preorders", "tenure_days", "pretax_sales", "ticket_size",
            "pct_disc", "pct_upsold", "mean_upsell", "ticket_size_chng", "pct_disc_chng", "pct_upsold_chng", "mean_upsell_chng")


def _with_rules(df: DataFrame, rules: DataFrame, org: str, keys: list[str] = []) -> DataFrame:
    """Each row with every rule of its organisation and every rule for all."""
    everyone = "for all organisations"
    named = rules.withColumn("__for", F.coalesce("org_uuid", F.lit(everyone))).drop("org_uuid")
    return df.withColumn("__for", F.explode(F.array(F.col(org), F.lit(everyone)))).join(
        named, ["__for", *keys]).drop("__for")


def course_targets(kpis: DataFrame, rules: DataFrame, org: str = "org_uuid") -> DataFrame:
    """Targets of all courses of all organisations: ``training_targets`` with the rules as a table (``RULE_DDL``).

    A missing figure keeps no bound. Rows that a course's bounds leave out do not count in its mean.
    """
    figures = {f: F.col(f).cast("double") for f in _FIGURES} | {
        "walk_in_orders": (F.col("orders") - F.col("preorders")).cast("double")}
    rows = _with_rules(kpis.withColumn("__figures", F.map_from_arrays(
        F.array(*[F.lit(f) for f in figures]), F.array(*figures.values()))), rules, org)

    def kept(bound: Column) -> Column:
        value = F.try_element_at("__figures", bound["figure"])
        return F.coalesce(value.isNotNull() & (bound["low"].isNull() | (value > bound["low"]))
                          & (bound["high"].isNull() | (value < bound["high"])), F.lit(False))

    rows = rows.where(F.coalesce(F.forall("bounds", kept), F.lit(True))).drop("__figures", "bounds")
    return _outside(rows, [org, "course_id", "store"])


ROI_DAYS = (7, 14, 30, 60, 90)
_ROI_KEYS = ["sold_by", "posId", "course_ts_utc", "store", "store_uuid"]


def _roi_report(figures: DataFrame, as_of: Column, head: list[Column], kpi: str,
                worth) -> DataFrame:
    """Common layout: before, after, uplift and money for each number of days.

    Every horizon is measured against the 30 days before the course.
    """
    base = F.col("pre_30")
    columns = []
    for d in ROI_DAYS:
        post = F.col(f"post_{d}")
        columns += [F.col(f"pre_{d}").alias(f"pre_{d}day"), post.alias(f"post_{d}day"),
                    F.try_divide(post - base, base).alias(f"uplift_{d}day"),
                    ((post - base) * worth(d)).alias(f"dollars_added_{d}day")]
    since = F.datediff(F.to_date(as_of), F.to_date("course_ts_utc"))
    return figures.select(
        *head, "store", "store_uuid",
        "sold_by", F.col("posId").alias("pos_id"), "course_ts_utc",
        since.alias("days_since_course"), F.lit(kpi).alias("kpi"), *columns)


def _heading(course: str | None, org: str | None) -> tuple[list[str], list[Column]]:
    """Grouping columns and leading columns: of one named course, or of the rows' own."""
    if course is None:
        return ["org_uuid", "course_id", *_ROI_KEYS], [F.col("org_uuid"), F.col("course_id")]
    return _ROI_KEYS, [F.lit(org).alias("org_uuid"), F.lit(course).alias("course_id")]


def ticket_roi(attributed: DataFrame, as_of: Column, *, course: str | None = None, org: str | None = None) -> DataFrame:
    """Average ticket before and after a course, per staff member.

    Without ``course`` the rows name theirs in ``org_uuid`` and ``course_id``.
    """
    keys, head = _heading(course, org)
    before, after = F.col("time_to_next_course"), F.col("time_since_last_course")
    spend = F.col("order_subtotal")
    # Orders are counted once each: first per order, then per staff member.
    keyed = attributed.withColumn("sold_by", F.upper("sold_by"))
    per_order = keyed.groupBy(*keys, "order_id").agg(
        *[F.bool_or(after <= d).alias(f"o{d}") for d in ROI_DAYS],
        *[F.struct(F.sum(F.when(t <= d, spend)).alias("s"),
                   F.count(F.when(t <= d, spend)).alias("n")).alias(f"{side}{d}")
          for side, t in (("a", after), ("b", before)) for d in ROI_DAYS])
    figures = per_order.groupBy(*keys).agg(
        *[F.count_if(F.col(f"o{d}") & F.col("order_id").isNotNull()).alias(f"orders_{d}")
          for d in ROI_DAYS],
        *[F.try_divide(F.sum(f"{side}{d}.s"), F.sum(f"{side}{d}.n")).alias(f"{name}_{d}")
          for side, name in (("a", "post"), ("b", "pre")) for d in ROI_DAYS])
    return _roi_report(figures, as_of, head, "ticket_size",
                       lambda d: F.col(f"orders_{d}"))


def upsell_roi(attributed: DataFrame, as_of: Column, *, course: str | None = None, org: str | None = None) -> DataFrame:
    """Share of preorders sold up before and after a course, per staff member; see ``ticket_roi``."""
    keys, head = _heading(course, org)
    before, after = F.col("time_to_next_course"), F.col("time_since_last_course")
    up, gain = F.col("is_upsell"), F.col("preorder_change_dollars")
    keyed = attributed.withColumn("sold_by", F.upper("sold_by"))
    per_order = keyed.groupBy(*keys, "order_id").agg(
        *[F.bool_or(t <= d).alias(f"{side}o{d}")
          for side, t in (("a", after), ("b", before)) for d in ROI_DAYS],
        *[F.bool_or((t <= d) & up).alias(f"{side}u{d}")
          for side, t in (("a", after), ("b", before)) for d in ROI_DAYS],
        *[F.sum(F.when((after <= d) & up, gain)).alias(f"g{d}") for d in ROI_DAYS])
    named = F.col("order_id").isNotNull()
    figures = per_order.groupBy(*keys).agg(
        *[F.count_if(F.col(f"{side}{kind}{d}") & named).alias(f"{side}{kind}{d}")
          for side in "ab" for kind in "ou" for d in ROI_DAYS],
        *[F.coalesce(F.sum(f"g{d}"), F.lit(0.0)).alias(f"g{d}") for d in ROI_DAYS])
    figures = figures.select("*", *[F.try_divide(f"{side}u{d}", f"{side}o{d}").alias(f"{name}_{d}")
                                    for side, name in (("a", "post"), ("b", "pre"))
                                    for d in ROI_DAYS])
    return _roi_report(figures, as_of, head, "pct_upsold",
                       lambda d: F.col(f"ao{d}") * F.try_divide(f"g{d}", f"au{d}"))


def course_results(orders: DataFrame, completions: DataFrame, rules: DataFrame, as_of: Column, *, org: str = "org_uuid",
                   bucket: Bucket | None = "month", stage: Stage = lazily) -> DataFrame:
    """Before and after of all courses of all organisations, from ``order_info`` rows and ``org, posId, course_id, done``.

    A ticket course looks at orders that were no pickups, an upsell course at pickups. Orders get a row per course that their
    seller completed in the organisation, so one attribution serves them all.
    """
    kinds = rules.select("org_uuid", "course_id", "kpi").distinct()
    done = stage(_with_rules(completions, kinds, org, ["course_id"]).select(org, "posId", "course_id", "done", "kpi").distinct())
    taken = done.select(org, "posId", "course_id", "kpi").distinct()
    sold = orders.where(F.col("was_pickup").isNotNull()).withColumn("posId", F.col("sold_by_id")).join(taken, [org, "posId"]).where(
        F.col("was_pickup") == (F.col("kpi") == "pct_upsold"))
    columns = [org, "posId", "course_id", "kpi", "order_id", "order_time_utc", "sold_by", "store", "store_uuid",
               "order_subtotal", "is_upsell", "preorder_change_dollars"]
    # Within one course its completions are told apart by their time.
    attributed = stage(touch_both_ways(
        sold.select(*columns), done.select(org, "posId", "course_id", "done", F.col("done").cast("string").alias("__done")),
        [org, "posId", "course_id"], order_time="order_time_utc", course_time="done", course_id="__done",
        order_tie=["order_id"], bucket=bucket, stage=stage).withColumnRenamed(org, "org_uuid"))
    return ticket_roi(attributed.where("kpi = 'ticket_size'"), as_of).unionByName(
        upsell_roi(attributed.where("kpi = 'pct_upsold'"), as_of))
