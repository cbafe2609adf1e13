"""Twelve stock layouts in one plan; orders of an exported file."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyhouse.plans.orders import flatfile_orders
from tallyhouse.plans.stock_layouts import STOCK_COLUMNS, STOCK_SYSTEMS, stacked_stock, stock_mapping


def landed(spark, system, path):
    """Two snapshots under the system's own names, partitioned by time."""
    sources = list(dict.fromkeys(src for s, _, src, _ in stock_mapping() if s == system and src and src != "snapshot_utc"))
    frame = spark.createDataFrame([(f"{system} {day}", day) for day in (1, 2)], "v string, day int")
    frame = frame.select(*[F.col("v").alias(c) for c in sources], F.expr("timestamp '2024-01-01' + make_dt_interval(day)").alias("snapshot_utc"))
    frame.write.partitionBy("snapshot_utc").parquet(path)
    return spark.read.parquet(path)


def test_all_layouts_newest_snapshot_only(spark, tmp_path):
    tables = {s: landed(spark, s, str(tmp_path / s)) for s in STOCK_SYSTEMS}
    got = stacked_stock(tables)
    assert got.columns == ["pos", *STOCK_COLUMNS] and len(stock_mapping()) == 12 * 18
    assert rows(got, "pos", "product_name", "brand_id") == sorted((s, f"{s} 2", f"{s} 2") for s in STOCK_SYSTEMS)
    plan = stacked_stock({"treez": tables["treez"]}).select("sku")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_utc" in plan and "price_sell" not in plan
    with pytest.raises(ValueError, match="no layout"):
        stacked_stock({"other": tables["treez"]})
    with pytest.raises(ValueError, match="price_sell"):
        stacked_stock({"treez": tables["treez"].drop("price_sell")})


def test_flatfile_orders_odd_rows(spark):
    run = dt.datetime(2024, 1, 1)
    ddl = ("row_no int, run_date_utc timestamp, order_number string, patient string, created_at string, status string, type string, "
           "order_source string, qty string, subtotal string, sales_tax string, total string")
    data = [(1, run, "1", "A B", "3/5/2021 14:30", None, "Express Delivery", "web", "2", None, None, None),
            (2, run, None, None, None, None, None, None, None, "10", "1.005", "10.5"),
            (3, run, "2", "A B", "2021-12-31 23:30:00", "Cancelled", "Store", "web", None, "1", "1", "1"),
            (4, run, "3", "No Body", "2021-12-31 23:30:00", "Done", "Store", "web", None, "1", "1", "1"),
            (5, run, "4", "A B", "soon", "Done", None, None, None, "x", "1", "3")]
    patients = [("A", "B", "7", 1, "old street", None, None, "1"), ("A", "B", "8", 5, " 1  Main ", None, "AZ", "850"), ("C", "D", None, 1, None, None, None, None)]
    people = spark.createDataFrame(patients, "first_name string, last_name string, patient_id string, total_completed_orders int, "
                                             "address string, city string, state string, zip string")
    got = flatfile_orders(spark.createDataFrame(data, ddl), people, org="o", source_system="s", zone="America/Phoenix")
    first, last = sorted(got.collect(), key=lambda r: r["order_id"])
    assert (first["order_id"], first["customer_id"], first["order_type"], first["delivery_order_address"]) == ("1", "8", "Delivery", "1 Main AZ 850")
    assert first["order_time_local"] == dt.datetime(2021, 3, 5, 14, 30) and first["order_time_utc"] == dt.datetime(2021, 3, 5, 21, 30)
    assert first["delivery_order_received_local"] == first["order_time_local"] and first["order_total"] == 10.5
    assert first["order_discount"] == pytest.approx(-.5, abs=.011) and first["order_tax"] == 1.005
    assert (last["order_id"], last["order_time_local"], last["order_type"], last["order_discount"]) == ("4", None, "Retail", None)  # the type is the row above's
    assert last["order_subtotal"] == 2.0
