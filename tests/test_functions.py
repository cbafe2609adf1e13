import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tallyhouse.functions import brand, category, dates, orders, people, text
from tallyhouse.plans.population import fill_amounts, standardize_brand


def one(spark, values, fn, ddl="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {ddl}")
    return [r[1] for r in sorted(df.select("i", fn(F.col("v"))).collect())]


def test_gender_golden_vector(spark):
    given = [None, "Male", "male", "m", "M", "MALE", "feMale", "F", "f", "RANDO"]
    want = [None, "M", "M", "M", "M", "M", "F", "F", "F", None]
    assert one(spark, given, people.clean_gender) == want
    assert one(spark, ["01", "12", "2", "u1", ""], people.gender_or_unknown) == [
        "M", "F", "U", "U", "U"]


def test_clean_text(spark):
    given = ["  a   b ", "N/A", "n/a", "", " \t ", None, "x  y"]
    assert one(spark, given, text.clean_text) == ["a b", None, "n/a", None, None, None, "x y"]
    assert one(spark, given, lambda c: text.clean_text(c, "upper"))[:3] == ["A B", None, None]
    assert one(spark, given, lambda c: text.clean_text(c, "lower"))[:3] == ["a b", "n/a", "n/a"]


def test_dates(spark):
    got = one(spark, ["1900-01-01T00:00:00", "2020-02-03T04:05:06", "soon", None],
              dates.parse_timestamp)
    assert got == [None, dt.datetime(2020, 2, 3, 4, 5, 6), None, None]
    kept = one(spark, ["1900-01-01"], lambda c: dates.parse_date(c, keep_1900=True))
    assert kept == [dt.date(1900, 1, 1)]
    ages = one(spark, ["2000-08-03", "1850-01-01", None], lambda c: dates.age_on(
        c.cast("date"), F.lit("2020-08-02").cast("date")))
    assert ages == [19, 100, 100]
    week = one(spark, ["2024-01-07 10:00:00"], lambda c: dates.week_start(c.cast("timestamp")))
    assert week == [dt.datetime(2024, 1, 1)]
    bins = one(spark, ["2024-01-07 10:29:59", "2024-01-07 10:30:00"],
               lambda c: dates.floor_to(c.cast("timestamp"), 30))
    assert [b.minute for b in bins] == [0, 30]


def test_category_variants(spark):
    data = [("Batteries", "x", None), ("Non-Edible", "gummies", None), (None, "gummies", None),
            ("beverage joint", "x", None), ("bud", "x", None), ("misc", "my flower", None),
            ("misc", "x", "Flower"), ("vape", "capsule", None), ("BUD", "x", None),
            ("eighths", "x", None), ("", "cartridge", None)]
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(data)],
                               "i int, raw string, name string, master string")
    got = [tuple(r)[1:] for r in sorted(df.select(
        "i", category.strict_category(F.col("raw"), F.col("name"), F.col("master")),
        category.ignore_case_category(F.col("raw"), F.col("name"))).collect())]
    assert got == [
        ("ACCESSORIES", "ACCESSORIES"), (None, "OTHER"), ("EDIBLES", "EDIBLES"),
        ("PREROLLS", "PREROLLS"), ("FLOWER", "OTHER"), (None, "FLOWER"), ("FLOWER", "OTHER"),
        # The product title only wins over an earlier rule when case is ignored.
        ("TABLETS_CAPSULES", "TABLETS_CAPSULES"), ("FLOWER", "OTHER"), ("FLOWER", "FLOWER"),
        (None, "VAPES")]


def test_brand_rules_see_earlier_output(spark):
    rules = [("^A", "BEE"), ("^BEE$", "CEE"), ("^C", "$DEE"), ("^A", "NEVER")]
    assert one(spark, ["APPLE", "BEE", "Z", None, "$x"],
               lambda c: brand.apply_brand_rules(c, rules)) == ["HOUSE", "HOUSE", "Z", None,
                                                                "HOUSE"]
    assert one(spark, ["x  Acme's (1/4) oz", "acme.", " (1/8)"], brand.tidy_brand) == [
        "ACMES", "ACME", "(1/8)"]


def test_long_brand_table(spark):
    df = spark.createDataFrame([("acme", "p"), (None, "acme"), (None, None), ("b. x", "q")],
                               "brand_name string, product_name string")
    # Unicode classes are read by Spark's regex dialect, also in what earlier rules gave.
    rules = [(r"^\p{L}CME$", "TOP"), ("X", "EX"), *[(f"^NAME{i}$", f"N{i}") for i in range(199)]]
    assert rows(standardize_brand(df, rules), "brand_name") == [("EX",), ("TOP",), ("TOP",), (None,)]


def test_opt_words_match_inside_words(spark):
    given = ["my friend", "STOP!", "unstop", "hello"]
    assert one(spark, given, text.opt_out_flag) == [True, True, True, False]
    assert one(spark, given, lambda c: text.opt_out_flag(c, whole_word=True)) == [
        False, True, False, False]
    assert one(spark, given, text.opt_in_flag) == [False, False, True, False]


def test_channel_and_pickup(spark):
    df = spark.createDataFrame([("Retail", "app"), ("Retail", None), ("Delivery", "web"),
                                (None, "app")], "t string, s string")
    pickup = orders.is_pickup(F.col("t"), F.col("s"))
    got = [tuple(r) for r in df.select(pickup, orders.channel(F.col("t"), pickup)).collect()]
    assert got == [(True, "PREORDER - NO ECOMM"), (False, "WALK-IN"), (False, "DELIVERY"),
                   (True, "OTHER")]


def test_amount_repair_order(spark):
    df = spark.createDataFrame([(None, None, None, None, None, 10.0),
                                (None, 1.0, -2.0, 5.0, None, None)],
                               "order_disc double, item_tax double, item_discount double, "
                               "item_subtotal double, item_total double, item_list_price double")
    got = rows(fill_amounts(df))
    # The second line has no list price, so its total stays unknown.
    assert got == [(0.0, 0.0, 0.0, 10.0, 10.0, 10.0), (0.0, 1.0, -2.0, 5.0, None, 5.0)]
