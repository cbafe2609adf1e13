"""The same ids in two organisations stay apart."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tallyhouse.operators import customers, joins, staff
from tallyhouse.plans.orders import order_dashboard
from tallyhouse.plans.population import population_multi

T0 = dt.datetime(2024, 1, 1)


def test_seller_names_and_customers(spark):
    lines = spark.createDataFrame(
        [(o, "till", "1", "1-1", None, "soda", "drinks") for o in "ab"],
        "org string, source_system string, order_id string, order_line_id string, "
        "brand_name string, product_name string, raw_category_name string")
    orders = spark.createDataFrame(
        [("a", "till", "1", "c", T0, "7", "ANN"), ("b", "till", "1", "c", T0 + dt.timedelta(1), "7", "BOB")],
        "org string, source_system string, order_id string, customer_id string, "
        "order_time_utc timestamp, sold_by_id string, sold_by string")
    people = spark.createDataFrame([("a", "c", "1", "F", 30), ("b", "c", "2", "M", 40)],
                                   "org string, customer_id string, phone string, gender string, age int")
    got = population_multi(lines, orders, people)
    assert rows(got, "org", "sold_by", "phone") == [("a", "ANN", "1"), ("b", "BOB", "2")]


def test_customer_profile(spark):
    data = [(o, "c", "p", str(i), T0 + dt.timedelta(days=i * i * (1 + (o == "b"))), 10.0 + i, 9.0, -1.0,
             "PROMO", o, 5.0) for o in "ab" for i in range(5)]
    pop = spark.createDataFrame(
        data, "org_uuid string, customer_id string, phone string, order_id string, "
        "order_time_utc timestamp, order_tot double, order_subtot double, order_disc double, "
        "category2 string, brand_name string, item_total double")
    got = customers.customer_profile(pop, F.lit(T0 + dt.timedelta(days=40)), ["PROMO"])
    assert rows(got, "org_uuid", "tot_orders", "ave_days_between", "promo") == [
        ("a", 5, 4.0, "a"), ("b", 5, 8.0, "b")]


def test_first_order(spark):
    text = "first_name last_name gender customer_city delivery_order_city delivery_order_zipcode"
    stages = [f"delivery_order_{s}_local" for s in ("received", "started", "complete")]
    pop = spark.createDataFrame([("a", "c", T0, "f"), ("b", "c", T0 + dt.timedelta(days=3), "f")],
                                "org string, customer_id string, order_time_local timestamp, "
                                "order_facility string")
    pop = pop.withColumns({**{c: F.lit(None).cast("string") for c in text.split()},
                           **{c: F.lit(None).cast("timestamp") for c in stages}})
    zips = spark.createDataFrame([], "zipcode string, zipcity string")
    assert rows(order_dashboard(pop, zips), "org", "is_first_order") == [("a", True), ("b", True)]


def test_deliveries_and_dupes(spark):
    lines = spark.createDataFrame([("a", "1", "s1", None, None), ("b", "1", "s1", None, None)],
                                  "org string, order_id string, pos_short_order_id string, "
                                  "delivery_order_started_local string, "
                                  "delivery_order_complete_local string")
    sent = spark.createDataFrame([("b", "s1", T0 + dt.timedelta(1), T0, T0 + dt.timedelta(minutes=9), "UTC"),
                                  ("b", "s1", T0, T0, T0 + dt.timedelta(minutes=99), "UTC")],
                                 "org string, pos_short_order_id string, created_at_utc timestamp, "
                                 "delivery_start_utc timestamp, "
                                 "delivery_complete_utc timestamp, timezone string")
    got = joins.lookup_deliveries(lines, sent)
    assert rows(got, "org", "delivery_drive_minutes") == [("a", None), ("b", 9.0)]
    people = spark.createDataFrame([("a", "1", "p", "shop"), ("a", "2", "p", None), ("b", "2", "p", None)],
                                   "org string, customer_id string, phone string, last_order_facility string")
    assert rows(joins.drop_never_ordered_dupes(people), "org", "customer_id") == [("a", "1"), ("b", "2")]


def test_staff_of_two_organisations_with_the_same_ids(spark):
    """Equal seller, shop, phone and order ids in two organisations stay apart in every staff figure."""
    as_of = F.lit("2024-02-01").cast("timestamp")
    at = dt.datetime(2024, 1, 25, 12)
    lines = []
    for org, price, days in (("a", 10.0, 3), ("b", 100.0, 1)):
        for d in range(days):
            for seller in ("1", "2"):
                when = at - dt.timedelta(days=d)
                lines.append((org, f"o{d}{seller}", "app", "Retail", "shop", "s", when, when, f"sam {seller}", seller, "c", "u", "555",
                              price + int(seller), None, price + int(seller), 0.0, f"l{d}", "p", "br", "cat", -1.0))
    ddl = ("org_uuid string, order_id string, order_source string, order_type string, store string, store_uuid string, "
           "order_time_local timestamp, order_time_utc timestamp, sold_by string, sold_by_id string, customer_id string, user_type string, "
           "phone string, order_total double, order_discount double, order_subtotal double, order_tax double, order_line_id string, "
           "product_id string, brand_name string, raw_category_name string, order_line_discount double")
    pop = spark.createDataFrame(lines, ddl)
    assert rows(staff.fill_order_discount(pop).select("order_discount").distinct()) == [(-1.0,)]
    gone = spark.createDataFrame([("a", None, "2"), ("b", "other shop", "1")], "org_uuid string, store_uuid string, sold_by_id string")
    kept = staff.without_excluded(staff.fill_order_discount(pop), gone)
    assert rows(kept.select("org_uuid", "sold_by_id").distinct()) == [("a", "1"), ("b", "1"), ("b", "2")]
    pre = spark.createDataFrame([("a", "shop", "555", at.date(), 5.0, 4.0, 1.0)],
                                "org_uuid string, store string, phone string, order_dt date, amount double, item_lvl_list_price double, item_qty double")
    info = staff.order_info(staff.fill_order_discount(pop), as_of, preorders=pre)
    assert info.count() == 8 and info.where("channel = 'PREORDER'").select("org_uuid").distinct().collect() == [("a",)]
    kpis = staff.staff_kpis(info, as_of)
    assert rows(kpis, "org_uuid", "sold_by_id", "orders", "tenure_days") == [("a", "1", 3, 3), ("a", "2", 3, 3), ("b", "1", 1, 1), ("b", "2", 1, 1)]
    assert "Expand" not in info._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in kpis._jdf.queryExecution().executedPlan().toString()
    rules = spark.createDataFrame([(None, "all", "ticket_size", 0.1, "under", []), ("a", "only a", "ticket_size", 0.1, "over", [("orders", 2.0, 4.0)]),
                                   ("b", "too few", "ticket_size", 0.1, "under", [("walk_in_orders", 5.0, None)]),
                                   (None, "no figure", "ticket_size", 0.1, "under", [("ticket_size_chng", -1.0, None)])], staff.RULE_DDL)
    info = staff.order_info(staff.fill_order_discount(pop.withColumn("order_source", F.lit("walk-in"))), as_of)
    kpis = staff.staff_kpis(info, as_of)
    assert rows(staff.course_targets(kpis, rules), "org_uuid", "course_id", "pos_id") == [
        ("a", "all", "1"), ("a", "only a", "2"), ("b", "all", "1")]
    done = spark.createDataFrame([("a", "1", "t", at - dt.timedelta(days=1)), ("b", "2", "t", at)],
                                 "org_uuid string, posId string, course_id string, done timestamp")
    ticket = spark.createDataFrame([(None, "t", "ticket_size", 1.0, "under", [])], staff.RULE_DDL)
    got = staff.course_results(info, done, ticket, as_of)
    assert rows(got, "org_uuid", "course_id", "pos_id", "post_7day", "pre_7day") == [
        ("a", "t", "1", 11.0, 11.0), ("b", "t", "2", None, 102.0)]


def test_each_organisation_has_its_own_day(spark):
    late = dt.datetime(2024, 1, 2, 2)  # still the first in New York, the second in Tokyo
    one = spark.createDataFrame([(o, "f", "p", "k", "pickup", late, 1.0, 1, 1.0, 1.0, 1.0) for o in ("us", "jp")],
                                "org_uuid string, facility string, phone string, pickup_id string, reservation_mode string, "
                                "reservation_start_window timestamp, amount double, items int, item_lvl_list_price double, "
                                "item_lvl_subtotal double, item_qty double")
    zone = F.when(F.col("org_uuid") == "us", "America/New_York").otherwise("Asia/Tokyo")
    assert rows(staff.preorder_summary(one, zone), "org_uuid", "order_dt") == [("jp", dt.date(2024, 1, 2)), ("us", dt.date(2024, 1, 1))]
