"""What large tables go through: work that must not be done twice or on rows that need not take part."""

import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tallyhouse.functions.category import IGNORE_CASE_RULES, STRICT_RULES, apply_rules, ignore_case_category, strict_category
from tallyhouse.operators import customers as customer_ops
from tallyhouse.operators import joins
from tallyhouse.plans.orders import flatfile_order_lines
from tallyhouse.plans.population import population_multi
from tallyhouse.queries import campaigns, customers, extraction, payloads, products
from tallyhouse.queries.registry import QUERIES
from tallyhouse.session import cut_lineage_columns
from tallyhouse.sources import star, variants

DAY = dt.datetime(2001, 7, 25)
ROWS = {
    "region": [(1, "R")], "nation": [(7, "N", 1)], "customer": [(3, "C3", 7, 1.0, "AUTO")],
    "supplier": [(5, "S5", 7, 1.0)], "part": [(1, "cold widget", "Brand#11", "PROMO", 1, 2.0), (2, "hat", "Brand#2", "SMALL", 1, 2.0)],
    "orders": [(10, 3, "O", 9.0, DAY, "5-LOW"), (11, 3, "O", 4.0, DAY, "5-LOW"), (12, 99, "O", 4.0, DAY, "5-LOW")],
    "lineitem": [(10, 1, 5, 1, 2.0, 3.0, 0.1, 0.0, "R", "F", DAY), (10, 2, 5, 2, 1.0, 3.0, 0.0, 0.0, "N", "F", DAY),
                 (10, 2, 5, 3, 1.0, 3.0, 0.0, 0.0, "N", "F", DAY), (12, 1, 5, 1, 1.0, 3.0, 0.0, 0.0, "N", "F", DAY)],
}


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("star"))
    for name, data in ROWS.items():
        spark.createDataFrame(data, star.TABLES[name]).write.parquet(f"{folder}/{name}.parquet")
    return folder


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_landing_builds_its_text_once(spark, small, monkeypatch):
    seen = []
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: seen.append(self._df))
    variants.land_payloads(payloads.transaction_text(spark, small), "payload", "nowhere")
    assert plan(seen[0]).count("StructsToJsonEvaluator") == 1


def test_landing_of_odd_text(spark, tmp_path):
    texts = ['{"a": 1}', '[{"a": 1}, {}]', "[]", "  ", None, "[1]", "[null]", "null", "3", '[{"a": 1}, [2]]', "{broken"]
    path = str(tmp_path / "t")
    variants.land_payloads(spark.createDataFrame([(t, "o", "s") for t in texts], "t string, org string, store string"), "t", path)
    got = spark.read.parquet(path).select(F.to_json("payload"), "rejected")
    assert rows(got) == rows(spark.createDataFrame(
        [('{"a":1}', None), ('{"a":1}', None), ("{}", None), *[(None, t) for t in texts[5:]]], "p string, rejected string"))


def test_baskets_travel_as_plain_lines(spark, small):
    text = payloads.transaction_text(spark, small)
    collected = next(line for line in plan(text).splitlines() if "Aggregate" in line and "collect_list" in line)
    assert "promo" not in collected
    got = {r.orderkey: json.loads(r.payload)[0]["items"] for r in text.collect()}
    assert got[11] == [] and sorted(i["transactionItemId"] for i in got[10]) == [101, 102, 103]
    assert [i for i in got[10] if i["transactionItemId"] == 101] == [{
        "transactionId": 10, "productId": 1, "transactionItemId": 101, "quantity": 2.0, "totalPrice": 3.0, "isReturned": True,
        "returnDate": "2001-07-25T00:00:00", "vendor": "vendor 5",
        "discounts": [{"discountId": 1, "discountName": "promo", "discountReason": "sale", "amount": 0.1}],
        "taxes": [{"rateName": "sales", "rate": 0.0, "amount": 2.0}]}]


def test_sold_products_need_no_product_table(spark, small):
    sold = payloads.sold_products(spark, small)
    assert rows(sold) == [("R", "N", 1), ("R", "N", 2)]
    assert not [f for f in sold.inputFiles() if "part.parquet" in f]


def test_brands_are_cleaned_without_the_lines(spark, small, monkeypatch):
    seen = []
    monkeypatch.setattr(extraction, "cut_lineage", lambda df: seen.append(df) or df)
    got = QUERIES["population_from_payloads"](spark, small)
    assert seen and not any("transactionItemId" in plan(df) for df in seen)
    assert rows(got, "order_line_id", "brand_name") == [(102, "DUO"), (103, "DUO")]


def test_register_lines_need_no_order_sums(spark, small):
    lines, _, _ = products._register(spark, small)
    assert "Aggregate" not in plan(lines)
    assert rows(lines, "order_line_id", "org", "brand_name") == [
        ("10-1-1-5", "R", None), ("10-2-2-5", "R", "Brand#2"), ("10-3-2-5", "R", "Brand#2")]


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_stored_columns_are_read_alone(spark):
    frame = spark.createDataFrame([(1, None, DAY), (None, "x", None), (1, None, DAY)], "a long, `b c` string, t timestamp")
    kept = cut_lineage_columns(frame)
    assert kept.schema == frame.schema and rows(kept) == rows(frame)
    assert "ReadSchema: struct<a:bigint>" in kept.groupBy("a").count()._jdf.queryExecution().executedPlan().toString()


def test_brands_and_shares_are_shuffled_once(spark):
    lines = spark.createDataFrame([("o", "1", "x", "a"), ("o", "1", None, "a"), ("o", "1", "x", "b"), ("o", "1", "w", None),
                                   ("o", "2", None, None), (None, None, "x", "NA")], "org string, customer_id string, brand string, c string")
    brands, shares = customer_ops.product_behavior(lines), customer_ops.preference_shares(lines, "c", ["a", "z"])
    assert shuffles(brands) == 1 and shuffles(shares) == 1
    assert rows(brands) == [("o", "1", "w, x", 2), ("o", "2", "", 0), (None, None, "x", 1)]
    assert rows(shares) == [("o", "1", 0.5, 0.0)]


def test_behavior_lines_are_stored_by_column(spark, small, monkeypatch):
    used, operator = {}, customer_ops.customer_behavior
    monkeypatch.setattr(customers.ops, "customer_behavior", lambda lines, attributed, stage: used.update(stage=stage))
    monkeypatch.setattr(campaigns, "attributed", lambda spark, sf_dir: None)
    customers.behavior(spark, small)
    lines = customers.behavior_lines(spark, small)
    messages = spark.createDataFrame([], "org string, customer_id string, last_sms_campaign_id string, time_since_last_order int, "
                                     "order_id string, " + ", ".join(f"is_{h} boolean" for h in ("24hr", "72hr", "7day", "2wk", "30day")))
    kept = []
    got = operator(lines, messages, stage=lambda df: kept.append(used["stage"](df)) or kept[-1])
    assert kept[0].inputFiles()
    assert rows(got, "customer_id", "num_orders", "all_order_descr", "unique_brands") == [("3", 1, "Brand#11, Brand#2", 2)]


def test_favourites_need_no_grouping_by_spend(spark):
    nan = float("nan")
    lines = spark.createDataFrame(
        [("1", "A", "b", 2.0), ("1", "A", "b", 1.0), ("1", "A", "a", 3.0), ("1", "A", None, 3.0), ("1", "Z", "z", 9.0), ("1", None, "n", 9.0),
         ("2", "A", None, 5.0), ("2", "A", "a", 4.0), ("2", "B", "low", -1.0), ("2", "B", "none", None), ("3", "A", "a", 7.0), ("3", "A", "n", nan),
         ("4", "Z", "z", 1.0), ("5", None, "n", 1.0), ("6", "a", "x", 1.0), ("6", "A", "w", 9.0), (None, "B", "b", 1.0)],
        "customer_id string, category2 string, brand_name string, item_total double")
    got = customer_ops.favourite_brands(lines, ["customer_id"], ["A", "B"])
    assert shuffles(got) == 3
    # Lines of other categories travel without brand and spend.
    assert plan(got).count("CASE WHEN") >= 3
    assert rows(got) == [("1", "a", None), ("2", None, "none"), ("3", "n", None), ("4", None, None), ("6", "x", None), (None, None, "b")]


def test_profile_works_out_the_rhythm_once(spark):
    data = [("o", "c", "p", str(i), dt.datetime(1998 + i % 4, 1 + i, 5), 10.0 + i, 9.0 + i * i, -1.0 - i, c, b, 5.0)
            for i in range(6) for c, b in (("PROMO", "a"), ("OTHER", "b"))]
    pop = spark.createDataFrame(
        data, "org_uuid string, customer_id string, phone string, order_id string, order_time_utc timestamp, order_tot double, "
        "order_subtot double, order_disc double, category2 string, brand_name string, item_total double")
    kept = []
    got = customer_ops.customer_profile(pop, F.lit(dt.datetime(2001, 8, 2)), ["PROMO", "SMALL"],
                                        stage=lambda df: kept.append(df.columns) or df.localCheckpoint())
    assert len(kept) == 2 and "cust_is_lost" in kept[1]
    assert "percentile" not in plan(got)
    times = sorted(d[4] for d in data[::2])
    gaps = [(b - a).total_seconds() / 86400 for a, b in zip(times, times[1:])]
    [row] = got.collect()
    assert (row.tot_orders, row.promo, row.small) == (6, "a", None)
    assert row.ave_days_between == pytest.approx(sum(gaps) / 5) and row.med_order_total == 12.5


def test_flatfile_lines_are_shuffled_by_order_once(spark):
    head = [("1", "Ann B", "2021-01-01", "Completed"), ("2", "Ann B", "2021-01-02", "Returned"), ("3", "No One", "2021-01-03", "Completed"),
            ("1", "Ann B", "2021-01-05", "Completed")]
    sold = [[("tea", "1"), ("Bun", "2"), ("tea", "3")], [("tea", "4")], [("tea", "5")], [("tea", "6"), ("ale", "7"), (None, "8")]]
    data, n = [], 0
    for h, lines in zip(head, sold):
        for r in [(*h, None, None), *[(None,) * 4 + line for line in lines]]:
            n += 1
            data.append((dt.datetime(2021, 2, 1), n, *r))
    raw = spark.createDataFrame(data, "run_date_utc timestamp, row_no long, order_number string, patient string, created_at string, "
                                "status string, product string, qty string")
    raw = raw.withColumns({"product_category": F.lit("Drinks"), "amount": F.lit(None).cast("string"), "price": F.lit("2"), "uom": F.lit("g")})
    people = spark.createDataFrame([("Ann", "B", "a1", 2), ("Ann", "B", "a0", 1)],
                                   "first_name string, last_name string, patient_id string, total_completed_orders int")
    cats = spark.createDataFrame([("drinks", "DRINKS")], "raw_category_name string, product_category_name string")
    got = flatfile_order_lines(raw, people, cats, org="o", source_system="s", rows_per_bucket=3)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(order_number") == 1
    assert rows(got, "order_id", "order_line_id", "product_name", "product_qty", "customer_id", "product_category_name") == [
        ("1", "1", "ALE", 7.0, "a1", "DRINKS"), ("1", "2", "BUN", 2.0, "a1", "DRINKS"), ("1", "3", "TEA", 6.0, "a1", "DRINKS"),
        ("1", "4", None, 8.0, "a1", "DRINKS")]


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_meet_orders_and_customers_in_one_shuffle(spark):
    lines = spark.createDataFrame(
        [("a", "1", "1-1", "soda", "drinks"), ("a", "1", "1-1", "soda", "drinks"), ("a", "1", "1-2", "hat", None), ("b", "1", "1-1", "soda", ""),
         ("a", "2", "2-1", "hat", "x"), ("a", None, "3-1", "hat", "x"), ("a", "9", "9-1", "hat", "x")],
        "org string, order_id string, order_line_id string, product_name string, raw_category_name string").withColumn(
        "source_system", F.lit("till")).withColumn("brand_name", F.lit(None).cast("string"))
    orders = spark.createDataFrame(
        [("a", "1", "c", DAY, "7", "ANN"), ("a", "1", "c", DAY, "7", "ANN"), ("b", "1", "c", DAY, "7", "BOB"), ("a", "2", None, DAY, None, None)],
        "org string, order_id string, customer_id string, order_time_utc timestamp, sold_by_id string, sold_by string").withColumn(
        "source_system", F.lit("till"))
    people = spark.createDataFrame([("a", "c", "1", "F", 30), ("a", "c", "2", "F", 30), ("b", "d", "3", "M", 40)],
                                   "org string, customer_id string, phone string, gender string, age int")
    got = population_multi(lines, orders, people)
    steps = [line for line in executed(got).splitlines() if "Exchange hashpartitioning" in line]
    assert sum("order_line_id" in line for line in steps) == 0
    assert sum("hashpartitioning(org" in line and "order_id" in line for line in steps) == 2
    assert rows(got, "org", "order_id", "order_line_id", "phone", "category3") == [
        ("a", "1", "1-1", "1", "DRINKS"), ("a", "1", "1-1", "2", "DRINKS"), ("a", "1", "1-2", "1", "OTHER"), ("a", "1", "1-2", "2", "OTHER"),
        ("a", "2", "2-1", None, "OTHER"), ("b", "1", "1-1", None, "OTHER")]


@pytest.mark.parametrize("people", ["c string, name string", "c string, x string", "l string, name string"])
def test_complete_lines_in_either_order(spark, people):
    lines = spark.createDataFrame([("1", "l1", "x1"), ("1", "l2", "x2"), ("2", "l1", "x3"), ("3", "l1", "x4")], "o string, l string, x string")
    orders = spark.createDataFrame([("1", "c1", 5), ("2", None, 6)], "o string, c string, t int")
    key, other = people.replace(" string", "").split(", ")
    names = spark.createDataFrame([("c1", "n1"), ("l1", "n2"), (None, "n3")], people)
    got = joins.complete_lines(lines, orders, names, ["o"], [key], ["o", "l"])
    want = joins.left_join_sparse(lines.join(orders, "o"), names, [key], key, ["o", "l"])
    assert got.columns == want.columns and rows(got) == rows(want)


def test_categories_read_each_text_once(spark):
    texts = [None, "", "Beverage", "pill box", "Non-Edible gifts", "edible", "bud", "BUD", "Live Resin", "prepack", "14g special", "battery",
             "C-Cell cartridge", "syrup", "cream/lotion", "Flower", "pre roll", "preroll flower", "shake sativa", "gear"]
    frame = spark.createDataFrame([(a, b, c) for a in texts for b in texts for c in (None, "Topical", "flower")], "r string, p string, c string")
    r, p, c = F.col("r"), F.col("p"), F.col("c")

    def merged(of):
        return F.when(of == "BATTERIES", "ACCESSORIES").otherwise(of)

    up = F.nullif(F.upper(r), F.lit(""))
    plain = frame.select(merged(apply_rules(F.lower(r), F.upper(p), F.upper(c), STRICT_RULES)), merged(F.coalesce(
        apply_rules(up, F.upper(p), rules=IGNORE_CASE_RULES, ignore_case=True), F.lit("OTHER"))))
    got = frame.select(strict_category(r, p, c).alias("s"), ignore_case_category(r, p).alias("i"))
    assert plan(got.select("s")).count("upper(p") <= 2 and got.select("s").distinct().count() > 8
    assert [tuple(x) for x in got.collect()] == [tuple(x) for x in plain.collect()]


def test_products_are_parsed_once(spark, small, monkeypatch):
    kept = []
    monkeypatch.setattr(extraction, "cut_lineage_columns", lambda df: kept.append(cut_lineage_columns(df)) or kept[-1], raising=False)
    got = QUERIES["population_from_payloads"](spark, small)
    # Customers' payloads are the only text left to parse for the lines.
    assert len(kept) == 1 and plan(got).count("from_json") == 1
    assert rows(got, "order_line_id", "product_name", "raw_brand_name") == [(102, "GUMMIES HAT", "BRAND#2"), (103, "GUMMIES HAT", "BRAND#2")]
