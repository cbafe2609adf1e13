import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyhouse.operators import campaigns, contacts, customers, extract, logs, staff
from tallyhouse.operators import statistics
from tallyhouse.queries.customers import t_tail
from tallyhouse.plans.attribution import sms_attribution
from tallyhouse.schemas import SCHEMA_NAMES, SchemaMismatch, conform_schema, pos_schema
from tallyhouse.sources.payloads import (parse_pos_json, read_pos_json, rejected_payloads,
                                          rejected_pos_json)

T0 = dt.datetime(2024, 1, 1)


def day(n):
    return T0 + dt.timedelta(days=n)


def test_t_probabilities(spark):
    # Quantiles of printed tables, and the finite sum for whole degrees of freedom.
    known = [(2.228139, 10, .05), (12.706205, 1, .05), (1.979930, 120, .05), (2.750, 30, .01)]
    assert all(t_tail(t, df) == pytest.approx(p, abs=1e-5) for t, df, p in known)
    cases = [(t, df) for df in (1, 2, 3, 30, 49, 51, 52, 201, 10_000, 99_999)
             for t in (0.0, 1e-9, 1e-3, .3, 1.0, 1.44, 1.7, 2.5, 5.0, 12.7, 40.0, 1e4)]
    df = spark.createDataFrame(cases, "t double, df long")
    got = df.select("t", "df", statistics.t_two_sided(F.col("t"), F.col("df")).alias("p")).collect()
    for t, k, p in got:
        assert p == pytest.approx(t_tail(t, k), abs=1e-9), (t, k)
    # Far degrees of freedom come to the normal distribution; any real number is allowed.
    far = df.limit(1).select(*[statistics.t_two_sided(F.lit(z), F.lit(1e9)).alias(str(i)) for i, z in enumerate((.5, 1.44, 3.))])
    assert list(far.first()) == pytest.approx([math.erfc(z / math.sqrt(2)) for z in (.5, 1.44, 3.)], abs=1e-8)


def test_slope_p_values(spark):
    # n, sxx, syy, sxy: a perfect fit, none at all, few rows, no variation.
    cases = [(5, 10.0, 10.0, 10.0), (300, 4.0, 9.0, 0.0), (2, 1.0, 1.0, 1.0), (9, 0.0, 1.0, 0.0), (400, 10.0, 10.0, .72), (4, 5.0, 5.0, 3.9)]
    f = spark.createDataFrame(cases, "n long, sxx double, syy double, sxy double")
    cols = [F.col(c) for c in ("n", "sxx", "syy", "sxy")]
    got = [r[0] for r in f.select(statistics.slope_p_value(*cols)).collect()]
    t = .072 / math.sqrt((1 - .072**2) / 398)
    assert got[0] == 0 and got[1] == 1 and got[2] is None and got[3] is None and got[4] == pytest.approx(t_tail(t, 398), abs=1e-9)
    assert [r[0] for r in f.select(statistics.slope_is_significant(*cols)).collect()] == [True, False, False, False, False, False]


def test_discount_sensitivity_edges(spark):
    data = ([("line", -float(i), 10.0 * i) for i in range(1, 6)]
            + [("flat", -1.0, 5.0), ("flat", -1.0, 9.0), ("flat", -1.0, 7.0)]
            + [("few", -1.0, 5.0), ("few", -2.0, 9.0)]
            + [("same", -float(i), 5.0) for i in range(1, 5)]
            + [("noise", -1.0, 5.0), ("noise", -2.0, 1.0), ("noise", -3.0, 6.0),
               ("noise", -4.0, 2.0)] + [("free", 0.0, 1.0)])
    df = spark.createDataFrame(data, "c string, order_disc double, order_subtot double")
    assert rows(customers.discount_sensitivity(df, ["c"])) == [
        ("few", False), ("flat", False), ("line", True), ("noise", False), ("same", False)]


def test_two_phones_double_orders_before_the_gap(spark):
    pop = spark.createDataFrame(
        [("c", "o", "till", p, "1", "Retail", "s", day(10), day(10), 5.0, "1-1")
         for p in ("p1", "p2")],
        "customer_id string, org string, source_system string, phone string, order_id string, "
        "order_type string, order_facility string, order_time_utc timestamp, "
        "order_time_local timestamp, order_total double, order_line_id string")
    sms = spark.createDataFrame([("o", "p1", " hi\nyou ", day(9), "k")],
                                "org string, to string, body string, date_sent timestamp, "
                                "campaign_id string")
    camps = spark.createDataFrame([("o", "k", None)], "org string, campaign_id string, "
                                  "campaign_body string")
    got = sms_attribution(sms, camps, pop, line_columns=["order_line_id"])
    assert rows(got, "phone", "time_since_last_order", "last_sms_body", "is_24hr", "was_lost") == [
        ("p1", None, "hi you", True, None), ("p2", 0, "hi you", True, False)]


def test_optin_strongest_channel(spark):
    def frame(data, ddl):
        return spark.createDataFrame(data, ddl)

    sms = frame([("o", "1", True, day(1), day(2)), ("o", "9", True, None, None)],
                "orguuid string, phone string, is_subscribed boolean, "
                "unsubscribed_at_utc timestamp, resubscribed_at_utc timestamp")
    custom = frame([("o", "1", day(3), "opt_out"), ("o", "2", day(3), "opt_out"),
                    ("o", "2", day(4), "opt_in")],
                   "orguuid string, phone string, ts timestamp, status string")
    hook = frame([("o", "2", day(5)), ("o", "3", day(5)), ("x", "3", day(5))],
                 "orguuid string, phone string, ts_gmt timestamp")
    imported = frame([("o", "4", day(6), False)],
                     "orguuid string, phone string, time timestamp, opted_in boolean")
    pos = frame([("o", "4", day(7), True), ("o", "5", day(1), True), ("o", "5", day(2), None),
                 ("o", "6", None, True)],
                "orguuid string, phone string, last_updated_utc timestamp, "
                "pos_is_subscribed boolean")
    active = frame([("o",)], "orguuid string")
    got = contacts.optin_status(sms, custom, hook, imported, pos, active)
    assert rows(got, "phone", "channel", "status") == [
        ("1", "sms_response", "opt_in"), ("2", "custom_code", "opt_in"),
        ("2", "custom_code", "opt_out"), ("3", "webhook", "opt_in"),
        ("4", "file_import", "opt_out"), ("5", "pos", "opt_out"), ("6", "pos", "opt_in")]
    latest = contacts.optin_status(sms, custom, hook, imported, pos, active, latest_only=True)
    assert latest.where("phone = '2'").collect()[0]["status"] == "opt_in"


def test_joined_person_ids_gather_a_shared_phone_in_parts(spark):
    from tallyhouse.queries import QUERIES
    rows = [("o", "555", f"c{i:03}", "p") for i in range(50)] + [("o", "556", "x", "q"), ("o", "556", "w", "q")]
    ids = spark.createDataFrame(rows, "org_uuid string, phone string, customer_id string, person_id string")
    got = {r["phone"]: r["pos_customer_id"] for r in contacts.joined_person_ids(ids, part=10).collect()}
    assert got == {"555": "|".join(f"c{i:03}" for i in range(50)), "556": "w|x"}
    assert "person_id_rows" in QUERIES


def test_person_ids_keep_every_id_of_a_shared_phone(spark):
    data = [("o", "hot", str(i)) for i in range(10_001)] + [("o", "p", "b"), ("o", "p", "a"),
                                                        ("o", "known", "z"), ("o", None, "n")]
    df = spark.createDataFrame(data, "org_uuid string, phone string, customer_id string")
    known = spark.createDataFrame([("o", "known")], "org_uuid string, phone string")
    got = contacts.person_ids(df, known)
    assert {r["phone"] for r in got.collect()} == {"hot", "p"}
    assert got.where("phone = 'hot'").select("customer_id").distinct().count() == 10_001
    assert got.where("phone = 'hot'").select("person_id").distinct().count() == 1
    joined = {r["phone"]: r["pos_customer_id"] for r in contacts.joined_person_ids(got).collect()}
    assert joined["p"] == "a|b" and len(joined["hot"].split("|")) == 10_001 and len(joined) == 2


def test_message_state(spark):
    out, back = True, False
    data = [("1", "s", "p", "deal", day(1), out, "k1"), ("2", "p", "s", "Stop", day(2), back, None),
            ("3", "s", "p", "deal2", day(3), out, None), ("4", "s", "q", "deal", day(1), out, "k1"),
            ("5", "q", "s", "no end", day(2), back, None), ("6", "q", "s", "YES", day(3), back, None)]
    df = spark.createDataFrame(
        [(m, f, t, "o", b, d, s, c) for m, f, t, b, d, s, c in data],
        "msg_id string, from string, to string, org_uuid string, body string, "
        "date_sent timestamp, sent_from_messaging_service boolean, campaign_id string")
    got = contacts.customer_sms(df)
    assert rows(got, "phone", "is_subscribed", "last_msg_received", "last_customer_resp",
                "last_campaign_id", "tot_sms_received") == [
        ("p", False, "deal2", "stop", "k1", 2), ("q", True, "deal", "yes", "k1", 1)]


def test_training_target_arguments(spark):
    df = spark.createDataFrame([("x",)], "store string")
    with pytest.raises(ValueError):
        staff.training_targets(df, "speed")
    with pytest.raises(ValueError):
        staff.training_targets(df, "ticket_size", direction="sideways")


def test_conform_schema(spark):
    df = spark.createDataFrame([(1, "b", "o", "s", 9)],
                               "brandId long, brandName string, org string, store string, x int")
    assert conform_schema(df, "Brand").columns == ["brandId", "brandName", "org", "store"]
    with pytest.raises(SchemaMismatch, match="brandName"):
        conform_schema(df.drop("brandName"), "Brand")
    assert len(SCHEMA_NAMES) == 16
    assert pos_schema("Customer").names[0] == "customerId"


def test_orders_without_children(spark, tmp_path):
    path = tmp_path / "org=o" / "store=s"
    path.mkdir(parents=True)
    (path / "day.json").write_text(
        '{"transactionId": 1, "items": [{"transactionId": 1, "transactionItemId": 11, '
        '"discounts": [], "taxes": [{"rateName": "t", "amount": 1.5}]}], '
        '"discounts": [{"discountId": 0, "amount": 2.0}], "taxSummary": []}\n'
        '{"transactionId": 2, "items": [], "discounts": null}\n')
    df = read_pos_json(spark, str(tmp_path), "Transaction")
    parts = extract.extract_transactions(df)
    counts = {name: part.count() for name, part in parts.items()}
    assert counts == {"order_summary": 2, "order_tax": 0, "order_discount": 1, "order_items": 1,
                      "order_items_tax": 1, "order_items_discount": 0}
    assert rows(parts["order_discount"], "org", "discountId", "amount") == [("o", None, 2.0)]
    check = extract.validate_batch(df).collect()[0]
    assert (check["order_items"], check["order_items_tax"], check["order_discount"]) == (1, 1, 1)


def test_unreadable_payload_gives_no_rows(spark):
    df = spark.createDataFrame([("o", "s", "oops"), ("o", "s", '[{"brandId": 3}]')],
                               "org string, store string, payload string")
    assert rows(parse_pos_json(df, "payload", "Brand"), "brandId", "brandName") == [(3, None)]


def test_rejected_payloads_are_returned(spark, tmp_path):
    df = spark.createDataFrame([("o", "s", "oops"), ("o", "s", '[{"brandId": 3}]'), ("o", "t", None)],
                               "org string, store string, payload string")
    assert rows(rejected_payloads(df, "payload", "Brand"), "store", "payload") == [
        ("s", "oops"), ("t", None)]
    path = tmp_path / "org=o" / "store=s"
    path.mkdir(parents=True)
    (path / "day.json").write_text('{"brandId": 1}\n{"brandId": \n{"brandId": 2}\n')
    assert rows(read_pos_json(spark, str(tmp_path), "Brand"), "brandId") == [(1,), (2,)]
    assert rows(rejected_pos_json(spark, str(tmp_path), "Brand"), "org", "store", "text") == [
        ("o", "s", '{"brandId": ')]


def test_send_exclusions(spark):
    kept = [("o", "k", p, t) for p, t in (("ok", day(9)), ("old", day(1)), ("refused", day(9)),
                                           ("lost", day(9)), ("timeless", None))]
    df = spark.createDataFrame(kept, "org string, campaign_id string, phone string, timestamp timestamp")
    log = spark.createDataFrame(
        [("o", "k", p, f"m-{p}", day(9), c) for p, c in (("ok", "200"), ("refused", "500"), ("lost", "200"))]
        + [("o", "k", "ok", "m-x", day(2), "500")],
        "org string, campaign_id string, to string, msg_id string, created_at_utc timestamp, "
        "http_code string")
    carrier = spark.createDataFrame([("m-lost", "outbound", "sending_failed"),
                                     ("m-ok", "inbound", "sending_failed")],
                                    "id string, direction string, status string")
    got = campaigns.keep_send_exclusions(df, log, carrier, F.lit(day(9)) + F.expr("INTERVAL 1 HOUR"))
    assert rows(got, "phone") == [("ok",), ("timeless",)]


def test_addresses_and_tags(spark):
    df = spark.createDataFrame(
        [("o", "a", '[{"type": "x", "street1": "", "primary": true}, {"type": "y", "primary": false}]',
          day(2)), ("o", "a", '[{"type": "old", "primary": true}]', day(1)),
         ("o", "b", None, day(1)), ("p", "a", '[{"type": "z"}]', day(1))],
        "org string, customer_id string, addresses string, run_date_utc timestamp")
    assert rows(extract.explode_addresses(df), "org", "customer_id", "address_type",
                "address_street1") == [("o", "a", "x", None), ("o", "b", None, None),
                                       ("p", "a", "z", None)]
    tags = spark.createDataFrame(
        [("a", '["Flyer", "$5 Reward", "7.5 Reward"]', day(2)), ("b", "[]", day(2)),
         ("c", None, day(2)), ("c", '["x"]', day(1)), ("d", '["1","2","3","4","flyer"]', day(1))],
        "customer_id string, tags string, run_date_utc timestamp")
    assert rows(extract.extract_tags(tags, keys=["customer_id"], keep=())) == [
        ("a", "flyer", 5.0), ("a", "flyer", 7.5), ("b", None, None), ("d", "regular", None)]


def test_event_counts_show_every_level(spark):
    df = spark.createDataFrame([("ERROR", "p", "GET")], "level string, pos string, step string")
    assert rows(logs.event_counts(df), "level", "Get") == [
        ("Error", 1), ("Info", 0), ("Success", 0), ("Warning", 0)]


def test_vip_name_is_the_last_new_one(spark):
    data = [("o", "c", "p", str(i), n, "l", day(i), 10.0, -1.0, 9.0, 1.0, "x", str(i))
            for i, n in enumerate(["Ann", "Bea", "Ann"])]
    df = spark.createDataFrame(
        data, "org_uuid string, customer_id string, phone string, order_id string, "
        "first_name string, last_name string, order_time_utc timestamp, order_tot double, "
        "order_disc double, item_subtotal double, product_qty double, pos_product_id string, "
        "pos_order_line_id string").withColumn("birthday", F.lit(None).cast("date"))
    got = customers.vip_points(df, F.lit(day(5))).collect()[0]
    assert (got["first_name"], got["total_orders"], got["days_since_last_order"]) == ("Bea", 3, 3)
    assert got["avg_days_between_orders"] == 1.0
