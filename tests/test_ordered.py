import math
import struct
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyhouse.operators import joins, ordered
from tallyhouse.operators.quantiles import exact_percentiles, order_bits


@pytest.fixture(scope="module")
def history(spark):
    """One key holds a third of the rows; NULL keys, times and values; equal times."""
    rnd = random.Random(7)
    data = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", None])
        at = None if rnd.random() < .03 else dt.datetime(2024, 1, 1) + dt.timedelta(
            hours=rnd.randrange(24 * 120))
        data.append((i, key, at, rnd.choice([None, None, float(i)])))
    return data, spark.createDataFrame(data, "i int, k string, t timestamp, v double").cache()


def brute_fill(data, down, current):
    out = {}
    for key in {d[1] for d in data}:
        group = sorted((d for d in data if d[1] == key),
                       key=lambda d: (d[2] is None, d[2] or dt.datetime.min, d[0]))
        if not down:
            group.reverse()
        seen = None
        for d in group:
            if current and d[3] is not None:
                seen = d[3]
            out[d[0]] = seen
            if d[3] is not None:
                seen = d[3]
    return out


@pytest.mark.parametrize("bucket", [None, "day", "month", "year"])
@pytest.mark.parametrize("down", [True, False])
@pytest.mark.parametrize("current", [True, False])
def test_fill_matches_brute_force(history, bucket, down, current):
    data, df = history
    got = ordered.fill_ordered(df, ["k"], ["t", "i"], {"f": "v"}, include_current=current,
                               direction="down" if down else "up", bucket=bucket)
    assert {r["i"]: r["f"] for r in got.collect()} == brute_fill(data, down, current)


def test_number_rows_in_buckets(history):
    _, df = history
    plain = rows(ordered.number_rows(df, ["k"], ["t", "i"], "n", bucket=None), "i", "n")
    assert plain == rows(ordered.number_rows(df, ["k"], ["t", "i"], "n", bucket="week"), "i", "n")


def test_latest_row_and_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 1, "n"),
                                ("b", None, "q")], "k string, t int, v string")
    assert rows(ordered.latest_row(df, ["k"], ["t"]), "k", "v") == [
        ("a", "z"), ("b", "q"), (None, "n")]
    assert rows(ordered.keep_at_max(df, ["k"], "t"), "k", "v") == [
        ("a", "y"), ("a", "z"), (None, "n")]


def test_touch_at_the_same_instant_does_not_count(spark):
    t = dt.datetime(2024, 1, 1)
    orders = spark.createDataFrame([("c", "o1", t), ("c", "o2", t + dt.timedelta(hours=1))],
                                   "c string, o string, at timestamp")
    touches = spark.createDataFrame([("c", t, "first", None)],
                                    "c string, sent timestamp, body string, camp string")
    got = joins.last_touch(orders, touches, ["c"], order_time="at", touch_time="sent",
                           touch_columns={"last_body": "body", "last_camp": "camp"},
                           order_tie=["o"], touch_tie=["body"])
    assert rows(got, "o", "last_body", "last_camp") == [("o1", None, None), ("o2", "first", None)]


def test_columns_of_a_touch_fill_independently(spark):
    t = dt.datetime(2024, 1, 1)
    orders = spark.createDataFrame([("c", t + dt.timedelta(days=70))], "c string, at timestamp")
    touches = spark.createDataFrame(
        [("c", t, "old", "k1"), ("c", t + dt.timedelta(days=65), "new", None)],
        "c string, sent timestamp, body string, camp string")
    got = joins.last_touch(orders, touches, ["c"], order_time="at", touch_time="sent",
                           touch_columns={"b": "body", "k": "camp"}, order_tie=["c"],
                           touch_tie=["body"])
    assert rows(got, "b", "k") == [("new", "k1")]


def test_courses_around_orders(spark):
    t = dt.datetime(2024, 1, 1)

    def day(n):
        return t + dt.timedelta(days=n)

    orders = spark.createDataFrame([("s", "a", day(0)), ("s", "b", day(5)), ("u", "c", day(1))],
                                   "s string, o string, at timestamp")
    courses = spark.createDataFrame([("s", "k1", day(0)), ("s", "k2", day(9))],
                                    "s string, k string, done timestamp")
    got = joins.touch_both_ways(orders, courses, ["s"], order_time="at", course_time="done",
                                course_id="k", order_tie=["o"])
    assert rows(got, "o", "last_course_id", "last_n_course", "next_course_id",
                "time_normalized") == [("a", None, 0, "k1", -0.0), ("b", "k1", 1, "k2", -4.0)]


def test_sparse_join_keeps_rows(spark):
    left = spark.createDataFrame([(i, None if i % 3 else i) for i in range(60)], "i int, k int")
    right = spark.createDataFrame([(0, "z"), (3, "t")], "k int, v string")
    got = joins.left_join_sparse(left, right, ["k"], "k", ["i"])
    assert got.count() == 60
    assert rows(got.where("v is not null"), "i", "v") == [(0, "z"), (3, "t")]


def test_merge_customers(spark):
    one = spark.createDataFrame([("o", "1", "p"), ("o", "2", "q"), ("o", "3", "q"),
                                 ("o", "4", None), ("b", "1", "q")],
                                "org string, customer_id string, phone string")
    two = spark.createDataFrame([("o", "9", "p", 1), ("o", "8", "p", 2), ("o", "7", "q", 1),
                                 ("o", "6", "r", 1), ("o", "5", None, 1), ("b", "3", "q", 1)],
                                "org string, customer_id string, phone string, last_updated_utc int")
    got = joins.merge_customers(one, two, prefix="x_")
    assert rows(got, "org", "customer_id", "other_customer_id") == [
        ("b", "1", "x_3"), ("o", "1", "x_8"), ("o", "2", None), ("o", "3", None), ("o", "4", None),
        ("o", "x_6", "x_6")]


def test_exact_percentiles(spark):
    rnd = np.random.default_rng(3)
    groups = {"big": rnd.lognormal(3, 2, 30_000).round(2), "ties": rnd.integers(0, 3, 500) * 1.0,
              "two": np.array([1.0, 4.0]), "one": np.array([7.0])}
    data = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("none", None), ("two", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    ps = [0.0, .1, .25, .45, .5, .85, .98, 1.0]
    got = exact_percentiles(df, ["g"], [(f"p{i}", "v", p) for i, p in enumerate(ps)])
    found = {r["g"]: [r[f"p{i}"] for i in range(len(ps))] for r in got.collect()}
    assert found.pop("none") == [None] * len(ps)
    for g, vs in groups.items():
        np.testing.assert_allclose(found[g], np.quantile(vs, ps), rtol=1e-12, err_msg=g)


def test_order_bits(spark):
    tiny = 5e-324
    values = [-math.inf, -1.7976931348623157e308, -2.0, -1.0000000000000002, -1.0, -2.2250738585072014e-308, -3 * tiny, -tiny, 0.0,
              tiny, 2 * tiny, 2.2250738585072009e-308, 2.2250738585072014e-308, 1e-300, .1, 1.0, 1.0000000000000002, 3.0,
              4.0 - 4e-16, 4.0, 1e22, 2.0**1023, 1.7976931348623157e308, math.inf, math.nan]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(order_bits(F.col("v"))).collect()]
    assert got == [(b if (b := struct.unpack("<q", struct.pack("<d", abs(v)))[0]) and v > 0 else -b) if v == v
                   else (2047 << 52) + 1 for v in values]
    rnd = np.random.default_rng(1)
    many = np.concatenate([np.exp(rnd.uniform(-700, 700, 5000)), 2.0 ** rnd.integers(-1070, 1020, 2000)])
    got = spark.createDataFrame([(float(v),) for v in many], "v double").select(order_bits(F.col("v"))).collect()
    assert [r[0] for r in got] == many.view(np.int64).tolist()


def test_percentiles_by_digits(spark):
    rnd = np.random.default_rng(8)
    # Neighbours in the last bit, one value for a third of the rows, both signs, very wide and infinite values.
    close = np.nextafter(1.0, 2.0) + np.arange(200) * 2.0**-52
    groups = {"close": close, "hot": np.r_[np.full(500, 7.5), rnd.normal(0, 1e3, 1000)], "wide": np.exp(rnd.uniform(-600, 600, 999)),
              "signs": np.r_[-close, 0.0, -0.0, close], "ends": np.array([-math.inf, -math.inf, 0.0, math.inf]), None: np.array([2.0, 3.0])}
    rows_ = [(g, float(v), float(-v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows_, "g string, v double, w double").repartition(7)
    ps = [0.0, .01, .25, .5, .6, .98, 1.0]
    targets = [(f"{c}{i}", c, p) for c in ("v", "w") for i, p in enumerate(ps)]
    for r in exact_percentiles(df, ["g"], targets).collect():
        if r["g"] == "ends":
            assert (r["v0"], r["v2"], r["v6"]) == (-math.inf, -math.inf, math.inf)
            continue
        vs = groups[r["g"]]
        np.testing.assert_allclose([r[f"v{i}"] for i in range(len(ps))], np.quantile(vs, ps), rtol=1e-13)
        np.testing.assert_allclose([r[f"w{i}"] for i in range(len(ps))], np.quantile(-vs, ps), rtol=1e-13)
    assert exact_percentiles(df.limit(0), ["g"], targets).count() == 0


def test_share_of_zero_total_is_null(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 1.0), ("b", 3.0)], "k string, v double")
    got = ordered.share_of_total(df, ["k"], "v", "s").orderBy("k", "v").select("s").collect()
    assert [r[0] for r in got] == [None, .25, .75]


def test_group_stats_null_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 3)], "k string, v int")
    assert rows(ordered.with_group_stats(df, ["k"], F.max("v").alias("m")), "v", "m") == [
        (1, 3), (3, 3)]


@pytest.mark.parametrize("bucket", [None, 3, 1000])
def test_fill_both_ways_equals_two_fills(spark, bucket):
    rnd = random.Random(bucket)
    data = [(rnd.choice(["a", "b", None]), t if rnd.random() > .02 else None, i, rnd.choice([None, None, None, f"v{i}"]), rnd.choice([None, None, i]))
            for i, t in enumerate(rnd.randrange(60) for _ in range(300))]
    df = spark.createDataFrame(data, "k string, t int, i int, x string, y int")
    args = (df, ["k"], ["t", "i"])
    got = ordered.fill_both_ways(*args, {"x_before": "x"}, {"x_after": "x", "y_after": "y"}, bucket=bucket)
    assert got.columns == ["k", "t", "i", "x", "y", "x_before", "x_after", "y_after"]
    want = {}
    for key in {r[0] for r in data}:
        rows_ = sorted((r for r in data if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        for n, r in enumerate(rows_):
            first = lambda part, c: next((v[c] for v in part if v[c] is not None), None)
            want[r[2]] = (first(rows_[n::-1], 3), first(rows_[n:], 3), first(rows_[n:], 4))
    assert {r["i"]: (r["x_before"], r["x_after"], r["y_after"]) for r in got.collect()} == want
