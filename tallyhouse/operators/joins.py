"""Joins of sales tables.

Strategy hints are left out on purpose. Small sides are broadcast by Spark when
their measured size is under ``spark.sql.autoBroadcastJoinThreshold``; large
sides meet in a sort-merge join whose hot partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Stage, lazily
from .ordered import Bucket, fill_both_ways, fill_ordered, latest_row, number_rows

def left_join_sparse(left: DataFrame, right: DataFrame, keys: list[str], sparse_key: str,
                     spread_by: list[str]) -> DataFrame:
    """Left join on keys of which one is often NULL (sales without a customer).

    NULL never matches, yet a plain join sends all such rows to one partition.
    Adding a salt to the key that is constant wherever the key is known spreads
    them over as many values as there are shuffle partitions and changes no result.
    """
    spread = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = (F.when(F.col(sparse_key).isNull(),
                   F.pmod(F.hash(*spread_by), F.lit(spread)))
            .otherwise(F.lit(0)))
    return (left.withColumn("__salt", salt)
            .join(right.withColumn("__salt", F.lit(0)), [*keys, "__salt"], "left")
            .drop("__salt"))


def lines_with_orders(items: DataFrame, orders: DataFrame, keys: list[str]) -> DataFrame:
    """Every line, with its order's columns where the order is known."""
    return items.join(orders, keys, "left")


def with_customers(lines: DataFrame, customers: DataFrame, keys: list[str],
                   spread_by: list[str]) -> DataFrame:
    """Every line, with its customer's columns where there is a customer."""
    return left_join_sparse(lines, customers, keys, keys[-1], spread_by)


def fill_from_products(lines: DataFrame, products: DataFrame, keys: list[str],
                       columns: list[str]) -> DataFrame:
    """Set ``columns`` from the product table, one product row per key.

    Should a key have several rows, the one that sorts last by all columns is
    used, so the number of lines never changes.
    """
    one_each = latest_row(products.select(*keys, *columns), keys, columns)
    return lines.drop(*columns).join(one_each, keys, "left")


def complete_lines(lines: DataFrame, orders: DataFrame, customers: DataFrame,
                   order_keys: list[str], customer_keys: list[str],
                   spread_by: list[str]) -> DataFrame:
    """Lines that have an order, with the customer if there is one.

    Where the orders name the customer, they get the customer's columns before they meet the lines, which are then not shuffled by
    customer. Customer columns named like others are left to the join after the lines.
    """
    shared = {*lines.columns, *orders.columns}
    added = [c for c in customers.columns if c not in customer_keys]
    if not shared.isdisjoint(added) or not set(customer_keys) <= set(orders.columns):
        return left_join_sparse(lines.join(orders, order_keys, "inner"), customers, customer_keys,
                                customer_keys[0], spread_by)
    known = left_join_sparse(orders, customers, customer_keys, customer_keys[0], order_keys)
    first = [*customer_keys, *[c for c in order_keys if c not in customer_keys]]
    rest = [c for c in [*lines.columns, *orders.columns] if c not in first]
    return lines.join(known, order_keys, "inner").select(*first, *rest, *added)


def only_new(df: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in ``existing``; a NULL key part equals a stored NULL."""
    known = existing.select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)]).distinct()
    same = F.lit(True)
    for i, key in enumerate(keys):
        same = same & df[key].eqNullSafe(F.col(f"__{i}"))
    return df.join(known, same, "left_anti")


def only_listed(df: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(listed.select(*keys).distinct(), keys, "left_semi")


def flag_listed(df: DataFrame, listed: DataFrame, key: str, name: str) -> DataFrame:
    """True where the key is in the list; a NULL key is not in it."""
    marks = listed.select(F.col(key)).distinct().withColumn(name, F.lit(True))
    return (df.join(marks, key, "left")
            .select(*df.columns, F.coalesce(F.col(name), F.lit(False)).alias(name)))


def full_history(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of either side, matched on keys."""
    return left.join(right, keys, "full")


def null_safe_lookup(df: DataFrame, lookup: DataFrame, keys: list[str],
                     columns: list[str]) -> DataFrame:
    """Left join in which a NULL key finds the lookup row whose key is NULL."""
    side = lookup.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *columns)
    match = F.lit(True)
    for key in keys:
        match = match & df[key].eqNullSafe(side[f"__k_{key}"])
    return df.join(side, match, "left").drop(*[f"__k_{k}" for k in keys])


def last_touch(orders: DataFrame, touches: DataFrame, keys: list[str], *, order_time: str,
               touch_time: str, touch_columns: dict[str, str], order_tie: list[str],
               touch_tie: list[str], bucket: Bucket | None = "month", stage: Stage = lazily
               ) -> DataFrame:
    """As-of join: the latest touch strictly before each order.

    ``touch_columns`` maps output column -> touch column. Both sides are stacked
    and sorted by time with orders first, so a touch at the same instant does
    not count. Columns are filled one by one and each skips its own NULLs: they
    may come from different touches. What crosses a time bucket is found from keys, times and touches alone;
    ``stage`` holds the touches, which are read twice.
    """
    touches = stage(touches)
    ties = [f"__tie_{i}" for i in range(max(len(order_tie), len(touch_tie)))]

    def tie_columns(names):
        return [(F.col(names[i]).cast("string") if i < len(names)
                 else F.lit(None).cast("string")).alias(t) for i, t in enumerate(ties)]

    left = orders.select("*", F.col(order_time).alias("__time"), F.lit(0).alias("__side"),
                         *tie_columns(order_tie))
    right = touches.select(*keys, F.col(touch_time).alias("__time"), F.lit(1).alias("__side"),
                           *tie_columns(touch_tie),
                           *[F.col(src).alias(f"__src_{new}")
                             for new, src in touch_columns.items()])
    stacked = left.unionByName(right, allowMissingColumns=True)
    filled = fill_ordered(stacked, keys, ["__time", "__side", *ties],
                          {new: f"__src_{new}" for new in touch_columns}, bucket=bucket)
    return filled.where(F.col("__side") == 0).select(*orders.columns, *touch_columns)


def touch_both_ways(orders: DataFrame, courses: DataFrame, keys: list[str], *, order_time: str,
                    course_time: str, course_id: str, order_tie: list[str],
                    bucket: Bucket | None = "month", stage: Stage = lazily) -> DataFrame:
    """Previous and next course around each order of the same staff member.

    Here an order and a course at the same instant see each other in stacking
    order: the course is after the order. Only staff with any course stay.
    """
    numbered = stage(number_rows(courses.select(*keys, course_id, course_time).distinct(), keys,
                                 [course_time, course_id], "n_course", bucket=bucket))
    ties = [f"__tie_{i}" for i in range(len(order_tie) or 1)]
    left = orders.select("*", F.col(order_time).alias("__time"), F.lit(0).alias("__side"),
                         *[F.col(c).cast("string").alias(t) for c, t in zip(order_tie, ties)])
    right = numbered.select(*keys, F.col(course_time).alias("__time"), F.lit(1).alias("__side"),
                            F.col(course_id).cast("string").alias(ties[0]),
                            F.col(course_id).alias("__c_id"), F.col(course_time).alias("__c_ts"),
                            F.col("n_course").alias("__c_n"))
    order_by = ["__time", "__side", *ties]
    stacked = left.unionByName(right, allowMissingColumns=True)
    both = fill_both_ways(
        stacked, keys, order_by,
        {"last_course_id": "__c_id", "last_course_completed_utc": "__c_ts", "last_n_course": "__c_n"},
        {"next_course_id": "__c_id", "next_course_completed_utc": "__c_ts", "next_n_course": "__c_n"}, bucket=bucket)
    day = F.lit(86_400_000_000)
    event, last, nxt = (F.unix_micros(F.col(c)) for c in
                        ("__time", "last_course_completed_utc", "next_course_completed_utc"))
    return (both.where(F.col("__side") == 0)
            # A trained staff member has a course on at least one side of any order.
            .where(F.col("last_n_course").isNotNull() | F.col("next_n_course").isNotNull())
            .withColumn("last_n_course", F.coalesce(F.col("last_n_course"), F.lit(0)))
            .withColumn("time_to_next_course", (nxt - event) / day)
            .withColumn("time_since_last_course", (event - last) / day)
            .withColumn("time_normalized", F.coalesce(-F.col("time_to_next_course"),
                                                      F.col("time_since_last_course")))
            .withColumn("course_ts_utc", F.coalesce("last_course_completed_utc",
                                                    "next_course_completed_utc"))
            .select(*orders.columns, "last_course_id", "last_course_completed_utc",
                    "last_n_course", "next_course_id", "next_course_completed_utc",
                    "next_n_course", "time_to_next_course", "time_since_last_course",
                    "time_normalized", "course_ts_utc"))


# Attribution horizons, name -> hours after the touch.
HORIZON_HOURS = {"24hr": 24, "72hr": 72, "7day": 168, "2wk": 336, "30day": 720}


def horizon_flags(event_time: Column, touch_time: Column) -> list[Column]:
    """One boolean per horizon; a later horizon includes the earlier ones."""
    gap = F.unix_micros(event_time) - F.unix_micros(touch_time)
    return [(gap <= F.lit(hours * 3_600_000_000)).alias(f"is_{name}")
            for name, hours in HORIZON_HOURS.items()]


def lookup_deliveries(lines: DataFrame, deliveries: DataFrame, *, order_id: str = "order_id",
                      short_id: str = "pos_short_order_id", created: str = "created_at_utc",
                      within: list[str] = ["org"]) -> DataFrame:
    """Delivery times on each line; the delivery system's value wins.

    A delivery names either the short or the full order id. It is matched on
    the short id first; one that matches none is taken as a full id. Ids name
    an order among those that share the ``within`` columns. Of several rows for
    an id, and of several ids for an order, the one created last counts, so a
    correction replaces what it corrects.
    """
    deliveries = latest_row(deliveries.select(*within, short_id, created, "delivery_start_utc",
                                              "delivery_complete_utc", "timezone"),
                            [*within, short_id], [created])
    ids = lines.select(*within, short_id, F.col(order_id).alias("__oid")).distinct()
    keyed = (deliveries.join(ids, [*within, short_id], "left")
             .select(*within, F.coalesce(F.col("__oid"), F.col(short_id)).alias("__oid"),
                     F.col(created).alias("__created"),
                     F.date_format(F.from_utc_timestamp("delivery_start_utc", F.col("timezone")),
                                   "yyyy-MM-dd HH:mm:ss").alias("__started"),
                     F.date_format(F.from_utc_timestamp("delivery_complete_utc",
                                                        F.col("timezone")),
                                   "yyyy-MM-dd HH:mm:ss").alias("__complete")))
    keyed = latest_row(keyed, [*within, "__oid"], ["__created"]).drop("__created")
    started, complete = "delivery_order_started_local", "delivery_order_complete_local"
    keyed = keyed.withColumnRenamed("__oid", order_id)
    out = (left_join_sparse(lines, keyed, [*within, order_id], order_id, lines.columns)
           .withColumn(started, F.coalesce("__started", started))
           .withColumn(complete, F.coalesce("__complete", complete))
           .drop("__started", "__complete"))
    took = (F.unix_timestamp(F.try_to_timestamp(complete))
            - F.unix_timestamp(F.try_to_timestamp(started))) / F.lit(60.0)
    return out.withColumn("delivery_drive_minutes", took)


def merge_customers(primary: DataFrame, secondary: DataFrame, *, phone: str = "phone",
                    customer_id: str = "customer_id", updated: str = "last_updated_utc",
                    prefix: str = "other_", linked_as: str = "other_customer_id",
                    within: list[str] = ["org"]) -> DataFrame:
    """Link a second system's customers to the first system's by phone.

    Per phone the second system's latest row counts. Phones several primary
    customers share are left out on the second side. What finds no primary
    customer is added with a prefixed id. A phone only links customers that share
    the ``within`` columns.
    """
    keys = [*within, phone]
    shared = (primary.where(F.col(phone).isNotNull()).groupBy(*keys).count()
              .where(F.col("count") > 1).select(*keys))
    newest = latest_row(secondary.where(F.col(phone).isNotNull())
                        .join(shared, keys, "left_anti"), keys, [updated])
    newest = newest.withColumn(customer_id, F.concat(F.lit(prefix), F.col(customer_id)))
    newest = newest.withColumn(linked_as, F.col(customer_id))
    linked = primary.join(newest.select(*keys, linked_as), keys, "left")
    unmatched = newest.join(primary.select(*keys).distinct(), keys, "left_anti")
    return linked.unionByName(unmatched, allowMissingColumns=True)


def drop_never_ordered_dupes(customers: DataFrame, *, customer_id: str = "customer_id",
                             phone: str = "phone", ordered: str = "last_order_facility",
                             within: list[str] = ["org"]) -> DataFrame:
    """Remove never-ordered profiles whose phone belongs to one that ordered.

    As in the source system the removal is by customer id, so other rows of the
    same id go as well. Phones and ids are compared among rows that share the
    ``within`` columns.
    """
    buyers = (customers.where(F.col(ordered).isNotNull() & F.col(phone).isNotNull())
              .select(*within, phone).distinct())
    dupes = (customers.where(F.col(ordered).isNull() & F.col(phone).isNotNull())
             .join(buyers, [*within, phone], "left_semi").select(*within, customer_id).distinct())
    return customers.join(dupes, [*within, customer_id], "left_anti")


def email_delivery_stats(send_log: DataFrame, stats: DataFrame, *, key: str = "campaign_id",
                         updated: str = "updated_at") -> DataFrame:
    """First and last send time per campaign, with rates of the total."""
    times = send_log.groupBy(key).agg(F.min(updated).alias("sent_at_utc"),
                                      F.max(updated).alias("end_at_utc"))
    return times.join(stats, key, "full").select(
        key, "sent_at_utc", "end_at_utc", F.col("total").alias("customers_reached"),
        F.try_divide("delivered", "total").alias("delivery_rate"),
        F.try_divide("opened", "total").alias("open_rate"),
        F.try_divide("clicked", "total").alias("click_rate"))


def missing_dates(expected: DataFrame, landing: DataFrame, keys: list[str], *, ts: str,
                  first_day: Column, last_day: Column) -> DataFrame:
    """(key, date) pairs of the expected keys for which nothing has landed."""
    spine = expected.select(*keys, F.explode(F.sequence(first_day, last_day)).alias("date"))
    seen = (landing.where(F.to_date(ts) >= first_day)
            .select(*keys, F.to_date(ts).alias("date")).distinct())
    return spine.join(seen, [*keys, "date"], "left_anti")


def map_with_override(df: DataFrame, default_map: DataFrame, org_map: DataFrame, *, key: str,
                      org: str, value: str, name: str) -> DataFrame:
    """Mapped value of a key, an organisation's own mapping before the default."""
    default_map = default_map.select(key, F.col(value).alias("__default"))
    org_map = org_map.select(org, key, F.col(value).alias("__own"))
    return (df.join(default_map, key, "left").join(org_map, [org, key], "left")
            .withColumn(name, F.coalesce("__own", "__default")).drop("__own", "__default"))


def first_row_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key after a sort; give an order without ties."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("__rank", F.row_number().over(w))
            .where(F.col("__rank") == 1).drop("__rank"))
