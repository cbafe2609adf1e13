"""Customer behaviour, profiles, points and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import days_between
from ..functions.orders import all_of
from ..session import Stage, lazily
from .ordered import fill_ordered
from .quantiles import exact_percentiles
from .reshape import pivot_levels
from .statistics import slope_is_significant


def order_behavior(population: DataFrame, keys: list[str] = ["org", "customer_id"]) -> DataFrame:
    """Orders, spend, discount and delivery share, timing, last shop per customer.

    Works on distinct order rows. The mean gap between orders needs no sort: the
    gaps, with 0 for the first order, add up to last day minus first day.
    """
    orders = population.select(
        *keys, "order_id", "order_time_local", "order_time_utc", "order_discount", "order_total",
        "order_type", "order_facility", "order_source").distinct()
    newest = F.struct("order_time_utc", "order_id")
    per_order = orders.groupBy(*keys, "order_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("order_total").alias("priced_rows"),
        F.sum("order_total").alias("total"),
        F.sum("order_discount").alias("discount"),
        F.min("order_time_utc").alias("first_utc"), F.max("order_time_utc").alias("last_utc"),
        F.min(F.to_date("order_time_local")).alias("first_day"),
        F.max(F.to_date("order_time_local")).alias("last_day"),
        F.count("order_time_local").alias("timed_rows"),
        F.sum(F.hour("order_time_local")).alias("hours"),
        F.bool_or(F.col("order_type") == "Delivery").alias("delivered"),
        F.max_by("order_facility", newest).alias("facility"),
        F.max_by("order_source", newest).alias("source"))
    known = F.col("order_id").isNotNull()
    latest = F.struct("last_utc", "order_id")
    out = per_order.groupBy(*keys).agg(
        F.count_if(known).alias("num_orders"),
        F.min("first_utc").alias("first_order_date"),
        F.max("last_utc").alias("last_order_date"),
        F.coalesce(F.sum("total"), F.lit(0.0)).alias("total_purchases_usd"),
        F.coalesce(F.sum("discount"), F.lit(0.0)).alias("total_discounts_usd"),
        F.try_divide(F.sum("total"), F.sum("priced_rows")).alias("avg_order_size"),
        F.count_if(known & F.col("delivered")).alias("__delivered"),
        (F.coalesce(F.datediff(F.max("last_day"), F.min("first_day")), F.lit(0))
         / F.sum("rows")).alias("avg_time_between_orders"),
        F.try_divide(F.sum("hours"), F.sum("timed_rows")).alias("avg_order_time"),
        F.max_by("facility", latest).alias("last_order_facility"),
        F.max_by("source", latest).alias("last_order_source"))
    gross = F.col("total_purchases_usd") + F.col("total_discounts_usd")
    return (out.withColumn("tot_discount_pct",
                           F.coalesce(F.try_divide("total_discounts_usd", gross), F.lit(0.0)))
            .withColumn("pct_delivery", F.try_divide("__delivered", "num_orders"))
            .drop("__delivered"))


def product_behavior(population: DataFrame, keys: list[str] = ["org", "customer_id"],
                     brand: str = "brand") -> DataFrame:
    """Sorted list and number of distinct brands per customer.

    Brands become a set before the one shuffle: what a customer's task gets is bounded by the list it returns.
    """
    return (population.groupBy(*keys).agg(F.collect_set(brand).alias("__b"))
            .select(*keys, F.array_join(F.sort_array("__b"), ", ").alias("all_order_descr"),
                    F.size("__b").cast("long").alias("unique_brands")))


def preference_shares(population: DataFrame, column: str, levels: list[str],
                      keys: list[str] = ["org", "customer_id"]) -> DataFrame:
    """Share of a customer's lines per value, one ``pct_`` column per level.

    Lines with no value count in the total but get no column. Customers that
    have no named value at all have no row.
    """
    cells = [F.try_divide(F.count_if(F.col(column) == level), F.count(F.lit(1))).alias(f"pct_{level}") for level in levels]
    named = F.count_if(F.coalesce(F.col(column), F.lit("NA")) != "NA").alias("__named")
    return population.groupBy(*keys).agg(*cells, named).where("__named > 0").drop("__named")


def conversion_counts(attributed: DataFrame, *, campaign: str = "last_sms_campaign_id",
                      keys: list[str] = ["org", "customer_id"]) -> DataFrame:
    """Converted orders per horizon, from each campaign's smallest-gap orders."""
    flags = ["is_24hr", "is_72hr", "is_7day", "is_2wk", "is_30day"]
    gap = "time_since_last_order"
    orders = attributed.select(*keys, campaign, gap, "order_id", *flags).distinct()
    per_gap = (orders.where(F.col(gap).isNotNull()).groupBy(*keys, campaign, gap)
               .agg(F.struct(*[F.count_if(F.col(f)).alias(f) for f in flags]).alias("n")))
    best = per_gap.groupBy(*keys, campaign).agg(F.min_by("n", gap).alias("n"))
    return best.groupBy(*keys).agg(*[
        F.sum(f"n.{f}").alias(f"tot_{f.removeprefix('is_')}_conversion") for f in flags])


# Categories under their own names in the behaviour table, those without a share, and the shares it has.
_BEHAVIOR_NAMES = {"PREROLLS": "preroll", "EDIBLES": "edible", "EXTRACTS": "extract", "TOPICALS": "topical"}
_WITHOUT_SHARE = ["accessories", "other"]
BEHAVIOR_CATEGORIES = ["preroll", "edible", "extract", "topical", "flower", "vapes", "drinks", "tinctures", "tablets_capsules"]
BEHAVIOR_CLASSES = ["indica", "sativa", "hybrid", "cbd"]


def customer_behavior(population: DataFrame, attributed: DataFrame, *, categories: list[str] = BEHAVIOR_CATEGORIES,
                      classes: list[str] = BEHAVIOR_CLASSES, stage: Stage = lazily) -> DataFrame:
    """One row per customer: orders, brands, shares of categories and product classes, conversions of messages.

    A line without a brand counts by the first 100 characters of its product name. Accessories and other products have
    no share and do not count in the categories' total. A customer without any message has NULL conversions.
    """
    keys = ["org", "customer_id"]
    category = F.lower("category3")
    for name, own in _BEHAVIOR_NAMES.items():
        category = F.when(F.col("category3") == name, own).otherwise(category)
    lines = stage(population.where(F.col("customer_id").isNotNull()).select(
        *keys, "order_id", "order_time_local", "order_time_utc", "order_discount", "order_total", "order_type",
        "order_facility", "order_source", "product_class", category.alias("category3"),
        F.coalesce("brand_name", F.substring("product_name", 1, 100)).alias("brand")))
    shared = lines.where(~F.coalesce(F.col("category3").isin(_WITHOUT_SHARE), F.lit(False)))
    out = order_behavior(lines, keys)
    for part in (product_behavior(lines, keys), preference_shares(shared, "category3", categories, keys),
                 preference_shares(lines, "product_class", classes, keys), conversion_counts(attributed, keys=keys)):
        out = out.join(part, keys, "left")
    return out


def customer_order_summaries(population: DataFrame) -> DataFrame:
    """Per customer and product: last order, sales then, sales and units in all."""
    keys = ["org_uuid", "customer_id", "phone", "product_name", "brand_name", "category2",
            "classification2"]
    lines = (population.where(F.col("phone").isNotNull() | F.col("customer_id").isNotNull())
             .where(F.col("item_total").isNotNull() & F.col("product_qty").isNotNull())
             .withColumn("classification2", F.upper("classification2")))
    per_time = lines.groupBy(*keys, "order_time_utc").agg(
        F.sum("item_total").alias("sales"), F.sum("product_qty").alias("qty"))
    return per_time.groupBy(*keys).agg(
        F.max("order_time_utc").alias("last_order_utc"),
        F.max_by("sales", "order_time_utc").alias("sales_last_order"),
        F.sum("sales").alias("sales_all_time"), F.sum("qty").alias("product_qty"))


def one_row_per_order(lines: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Order-level columns repeat on every line of an order; keep them once."""
    return lines.groupBy(*keys, "order_id").agg(*[F.min(c).alias(c) for c in columns])


def discount_sensitivity(orders: DataFrame, keys: list[str], *, spend: str = "order_subtot",
                         discount: str = "order_disc") -> DataFrame:
    """Does a customer's discount move their spend? Regression slope with p < .15.

    Orders without a discount are left out. Fewer than three orders, or no
    variation, give FALSE.
    """
    x, y = F.col(discount), F.col(spend)
    sums = (orders.where(F.col(discount) < 0).groupBy(*keys)
            .agg(F.regr_count(y, x).alias("n"), F.regr_sxx(y, x).alias("sxx"),
                 F.regr_syy(y, x).alias("syy"), F.regr_sxy(y, x).alias("sxy")))
    return sums.select(*keys, slope_is_significant(
        F.col("n"), F.col("sxx"), F.col("syy"), F.col("sxy")).alias("is_disc_sensitive"))


def favourite_brands(lines: DataFrame, keys: list[str], categories: list[str], *,
                     category: str = "category2", brand: str = "brand_name",
                     spend: str = "item_total") -> DataFrame:
    """Top brand by spend in each category, one column per category.

    Equal spend goes to the brand first in the alphabet. Lines of other categories only give their key a row, so they
    travel without brand and spend.
    """
    named = lines.where(F.col(category).isNotNull())
    listed = F.lower(category).isin([c.lower() for c in categories])
    spent = named.select(*keys, *[F.when(listed, F.col(c)).alias(n) for c, n in (
        (category, "__c"), (brand, "__b"), (spend, "__s"))]).groupBy(*keys, "__c", "__b").agg(
        F.coalesce(F.sum("__s"), F.lit(0.0)).alias("spend"))
    # The least by falling spend, NaN being the highest, then by name, no name last.
    top = spent.groupBy(*keys, "__c").agg(F.min(F.struct(
        ~F.isnan("spend"), -F.col("spend"), F.col("__b").isNull(), F.col("__b").alias("b"))).alias("__top"))
    levels = top.withColumn("__c", F.lower("__c"))
    return pivot_levels(levels, keys, "__c", [c.lower() for c in categories], F.col("__top.b"))


def customer_profile(population: DataFrame, as_of: Column, categories: list[str],
                     keys: list[str] = ["org_uuid", "customer_id", "phone"],
                     stage: Stage = lazily) -> DataFrame:
    """Purchase rhythm of an organisation's customers with more than three orders.

    Mean and spread of the gap between orders, median ticket, whether the
    customer is lost (five spreads late), when the next order is due, discount
    sensitivity of those not lost and favourite brand per category. ``stage`` holds the orders and the customers' rhythm, both
    of which are read twice.
    """
    lines = population.where(all_of([F.col(k).isNotNull() for k in keys]))
    orders = stage(one_row_per_order(lines, keys, [
        "order_time_utc", "order_tot", "order_subtot", "order_disc"]))
    # Customers have few orders a month: by the month, nearly every order would have a carry row of its own.
    gaps = fill_ordered(orders.select(*keys, "order_time_utc", "order_id", "order_tot"), keys, ["order_time_utc", "order_id"],
                        {"prev": "order_time_utc"}, include_current=False, bucket="year")
    gaps = gaps.withColumn("gap", days_between(F.col("prev"), F.col("order_time_utc")))
    rhythm = (gaps.groupBy(*keys).agg(
        F.max("order_time_utc").alias("last_purchase_date"),
        F.avg("gap").alias("ave_days_between"), F.stddev_samp("gap").alias("sd_days_between"),
        F.count(F.lit(1)).alias("tot_orders"), F.sum("order_tot").alias("tot_dollars"),
        # Many small groups of amounts in cents: their different values fit a task.
        F.percentile("order_tot", 0.5).alias("med_order_total"))
        .where((F.col("tot_orders") > 3) & F.col("sd_days_between").isNotNull())
        .withColumn("days_since_last_purchase", days_between(F.col("last_purchase_date"), as_of)))
    profile = stage(rhythm.withColumn("cust_is_lost", F.col("days_since_last_purchase")
                                      > F.col("ave_days_between") + F.col("sd_days_between") * 5))
    kept = profile.where(~F.col("cust_is_lost")).select(*keys)
    sensitive = discount_sensitivity(orders.join(kept, keys, "left_semi"), keys)
    # A customer without such lines has no favourites, whether or not there is a row to join.
    named = F.lower("category2").isin([c.lower() for c in categories])
    favourites = favourite_brands(lines.where(named), keys, categories)
    slack = F.lit(2.65) * F.col("sd_days_between") / F.sqrt(F.col("tot_orders"))
    today = F.to_date(as_of)
    return (profile.join(sensitive, keys, "left")
            .withColumn("next_start_utc", F.date_add(today, F.greatest(
                F.floor(F.col("ave_days_between") - slack), F.lit(0)).cast("int")))
            .withColumn("next_stop_utc", F.date_add(
                today, F.floor(F.col("ave_days_between") + slack).cast("int")))
            .join(favourites, keys, "left"))


# Percentile cuts per measure, and the points above each cut.
VIP_CUTS = {"items": (0.50, 0.85, 0.98), "orders": (0.45, 0.70, 0.85),
            "dollars": (0.45, 0.70, 0.95)}


def _last_new_value(orders: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Per column the value that was first seen latest (not the latest value:
    going back to an earlier name does not bring it back)."""
    seen = orders.groupBy(*keys, *columns).agg(F.min("at").alias("__t"))
    long = seen.select(*keys, "__t", F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("v"))
        for c in columns])).alias("x")).select(*keys, "__t", "x.*")
    first = long.groupBy(*keys, "field", "v").agg(F.min("__t").alias("__t"))
    types = dict(orders.dtypes)
    return first.groupBy(*keys).agg(*[
        F.max_by("v", F.when(F.col("field") == c, F.struct("__t", "v"))).cast(types[c]).alias(c)
        for c in columns])


def vip_points(population: DataFrame, as_of: Column, stage: Stage = lazily) -> DataFrame:
    """0 to 3 points each for items, orders and dollars, against the organisation.

    Order time and personal data are the same on all lines of an order.
    """
    person = ["first_name", "last_name", "birthday"]
    keys = ["org_uuid", "customer_id", "phone"]
    lines = (population.where(F.col("phone").isNotNull() | F.col("customer_id").isNotNull())
             .where(all_of([F.col(c).isNotNull()
                            for c in ("item_subtotal", "product_qty", "order_time_utc")])))
    per_order = stage(lines.groupBy(*keys, "order_id").agg(
        F.min("order_tot").alias("tot"), F.min("order_disc").alias("disc"),
        F.sum("product_qty").alias("qty"), F.max("order_time_utc").alias("at"),
        *[F.max(c).alias(c) for c in person]))
    cut = F.abs("disc")
    spend = stage(per_order.groupBy(*keys).agg(
        F.floor(days_between(F.max("at"), as_of)).alias("days_since_last_order"),
        F.avg("tot").alias("avg_order_total"),
        F.avg(F.try_divide(cut, F.col("tot") + cut)).alias("avg_discount_to_date"),
        F.bround(F.avg("qty")).alias("avg_order_items"),
        F.sum("qty").alias("total_items"), F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(F.sum("tot"), F.lit(0.0)).alias("total_dollars")))
    prices = (lines.groupBy(*keys, "pos_product_id")
              .agg(F.max_by("item_subtotal", F.struct("order_time_utc", "pos_order_line_id",
                                                      "item_subtotal")).alias("p"))
              .groupBy(*keys).agg(F.avg("p").alias("avg_item_price")))
    times = per_order.select(*keys, "at").distinct()
    gaps = (fill_ordered(times, keys, ["at"], {"prev": "at"}, include_current=False)
            .groupBy(*keys).agg(F.avg(F.ceil(days_between(F.col("prev"), F.col("at"))))
                                .alias("avg_days_between_orders")))
    people = _last_new_value(per_order, keys, person)

    cuts = exact_percentiles(spend, ["org_uuid"], [
        (f"{measure}_{i}", f"total_{measure}", p)
        for measure, ps in VIP_CUTS.items() for i, p in enumerate(ps)])
    measured = spend.join(cuts, "org_uuid", "left")
    measured = measured.withColumns({f"vip_{measure}": sum(
        (F.when(F.col(f"total_{measure}") > F.col(f"{measure}_{i}"), 1).otherwise(0)
         for i in range(3)), F.lit(0)) for measure in VIP_CUTS})
    measured = measured.drop(*cuts.columns[1:]).withColumn(
        "vip_points", F.col("vip_items") + F.col("vip_orders") + F.col("vip_dollars"))
    for extra in (people, gaps, prices):
        side = extra.select(*[F.col(k).alias(f"__k_{k}") for k in keys],
                            *[c for c in extra.columns if c not in keys])
        match = all_of([measured[k].eqNullSafe(side[f"__k_{k}"]) for k in keys])
        measured = measured.join(side, match, "left").drop(*[f"__k_{k}" for k in keys])
    return measured


def loyalty_benchmarks(population: DataFrame, org: str = "org_uuid", stage: Stage = lazily
                       ) -> DataFrame:
    """Percentiles over an organisation's customers that mark loyalty levels."""
    def finite(c):
        return F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))

    lines = population.where(finite("item_total") & finite("item_discount")
                             & finite("product_qty"))
    per_order = lines.groupBy(org, "customer_id", "order_id").agg(
        F.sum("item_total").alias("spend"), F.sum("product_qty").alias("qty"),
        F.sum("item_discount").alias("disc"))
    customers = per_order.groupBy(org, "customer_id").agg(
        F.sum("spend").alias("spend"), F.sum("qty").alias("items"),
        F.count(F.lit(1)).alias("orders"), F.abs(F.sum("disc")).alias("disc"))
    rate = F.try_divide("disc", "spend")
    customers = stage(customers.withColumn("disc", F.when(rate > 0.01, rate)))
    levels = ("silver", "gold", "platinum")
    # Percentile per measure and level.
    cuts = {"spend": (0.45, 0.70, 0.95), "items": (0.50, 0.85, 0.98),
            "orders": (0.45, 0.70, 0.85), "disc": (0.25, 0.60, 0.95)}
    targets = [(f"{measure}_{level}", measure, p)
               for measure, ps in cuts.items() for level, p in zip(levels, ps)]
    out = exact_percentiles(customers, [org], targets)
    return out.select(org, *[F.coalesce(F.col(n), F.lit(0.0)).alias(n) for n, _, _ in targets])


# The categories a segment can be about, and the share that makes one.
SEGMENT_CATEGORIES = ["EDIBLES", "VAPES", "FLOWER", "PREROLLS", "EXTRACTS", "TOPICALS", "DRINKS",
                      "TINCTURES", "TABLETS_CAPSULES"]
SINGLE_CATEGORY_FLAGS = {"is_preroll_only": "PREROLLS", "is_edible_only": "EDIBLES",
                         "is_extract_only": "EXTRACTS", "is_flower_only": "FLOWER",
                         "is_vape_only": "VAPES"}
SEGMENT_FLAGS = ["is_long_term", "is_most_frequent", "is_high_spender", *SINGLE_CATEGORY_FLAGS,
                 "is_disc_sensitive"]


def segment_lines(population: DataFrame, *, since: str = "2017-01-01", low: float = 5,
                  high: float = 1000) -> DataFrame:
    """Lines that count for segments: recent, contactable, plausible amount."""
    contact = ((F.col("email").isNotNull() & (F.col("email") != ""))
               | F.col("phone").isNotNull())
    return population.where(
        (F.col("order_time_utc") > F.lit(since).cast("timestamp")) & contact
        & F.col("category3").isin(SEGMENT_CATEGORIES)
        & (F.col("item_subtotal") < high) & (F.col("item_subtotal") > low))


def segment_days(lines: DataFrame, org: str = "org_uuid") -> DataFrame:
    """Lines summed per contact, customer, day and category.

    All segment figures follow from these sums, so a stored result replaces the
    lines as input of ``customer_segments`` for every contact kind.
    """
    return lines.groupBy(org, "phone", "email", "customer_id",
                         F.date_trunc("day", "order_time_utc").alias("order_time_utc"),
                         "category3").agg(
        F.sum("item_subtotal").alias("item_subtotal"),
        F.sum("item_discount").alias("item_discount"))


def customer_segments(lines: DataFrame, by: str, *, min_customers: int = 100,
                      org: str = "org_uuid", stage: Stage = lazily) -> DataFrame:
    """Segment flags per contact (``phone`` or ``email``) and customer.

    Needs three order days. Organisations with fewer than ``min_customers``
    customers that have the contact are left out. Thresholds are quartiles
    within the organisation.
    """
    lines = lines.where(F.col(by).isNotNull())
    keys = [org, by, "customer_id"]
    daily = (lines.groupBy(*keys, F.to_date("order_time_utc").alias("order_date"))
             .agg(F.coalesce(F.sum("item_subtotal"), F.lit(0.0)).alias("order_tot"),
                  (-F.coalesce(F.sum("item_discount"), F.lit(0.0))).alias("order_disc")))
    gaps = fill_ordered(daily, keys, ["order_date"], {"prev": "order_date"},
                        include_current=False, bucket="year")
    gap = F.datediff("order_date", "prev").cast("long")
    # Whole-number sums keep the standard deviation exact, which matters
    # because it is rounded up to full days afterwards.
    summ = stage(gaps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("order_tot").alias("spend"),
        F.sum("order_disc").alias("disc"), F.avg("order_tot").alias("size"),
        F.count(gap).alias("g"), F.sum(gap).alias("gap_sum"),
        F.sum(gap * gap).alias("gap_sq"))
        .where("n > 2")
        .withColumn("days_ave", F.ceil(F.col("gap_sum") / F.col("g")).cast("double"))
        .withColumn("days_sd", F.ceil(F.sqrt(F.try_divide(
            F.col("g") * F.col("gap_sq") - F.col("gap_sum") * F.col("gap_sum"),
            F.col("g") * (F.col("g") - 1)))).cast("double"))
        .withColumn("disc_rate", F.try_divide("disc", "spend")))
    cuts = exact_percentiles(summ, [org], [
        ("n_hi", "n", 0.75), ("days_ave_lo", "days_ave", 0.25), ("days_sd_lo", "days_sd", 0.25),
        ("size_hi", "size", 0.75), ("rate_hi", "disc_rate", 0.75)])
    big_enough = (daily.select(org, "customer_id").distinct().groupBy(org).count()
                  .where(F.col("count") >= min_customers).select(org))

    spent = lines.groupBy(*keys, "category3").agg(F.sum("item_subtotal").alias("s"))
    shares = spent.groupBy(*keys).agg(F.sum("s").alias("__all"), *[
        F.sum(F.when(F.col("category3") == c, F.col("s"))).alias(c)
        for c in SINGLE_CATEGORY_FLAGS.values()])
    shares = shares.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[
        (F.coalesce(F.try_divide(c, "__all"), F.lit(0.0)) > 0.75).alias(flag)
        for flag, c in SINGLE_CATEGORY_FLAGS.items()])
    match = all_of([summ[k].eqNullSafe(shares[f"__k_{k}"]) for k in keys])
    return (summ.join(shares, match)
            .join(cuts, org).join(big_enough, org, "left_semi")
            .select(org, F.lit(by).alias("segment_type"), "customer_id",
                    F.col(by).alias("contact"),
                    (F.col("n") > F.col("n_hi")).alias("is_long_term"),
                    ((F.col("days_ave") < F.col("days_ave_lo"))
                     & (F.col("days_sd") < F.col("days_sd_lo"))).alias("is_most_frequent"),
                    (F.col("size") > F.col("size_hi")).alias("is_high_spender"),
                    *SINGLE_CATEGORY_FLAGS,
                    (F.col("disc_rate") > F.col("rate_hi")).alias("is_disc_sensitive")))


def segment_summary(segments: DataFrame) -> DataFrame:
    """Customers in and not in each segment."""
    flags = [c for c in segments.columns if c.startswith("is_")]
    counted = segments.groupBy("segment_type").agg(
        *[F.struct(F.count_if(F.col(f)).alias("in_segment"),
                   F.count_if(~F.col(f)).alias("not_in_segment")).alias(f) for f in flags])
    return (counted.unpivot(["segment_type"], flags, "segment", "n")
            .select("segment", "segment_type", "n.in_segment", "n.not_in_segment"))
