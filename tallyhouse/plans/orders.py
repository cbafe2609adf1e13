"""Order dashboard and flat-file order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import minutes_between
from ..functions.orders import strain_class
from ..functions.people import full_name
from ..functions.text import brand_from_title, squish
from ..operators.ordered import fill_both_ways, is_first_day, latest_row, number_rows


def order_dashboard(population: DataFrame, zip_city: DataFrame, *, org: str = "org"
                    ) -> DataFrame:
    """Lines with delivery durations, first-order flag and one city column.

    A customer's first order is the first one in the organisation.
    """
    received = F.col("delivery_order_received_local")
    df = population.withColumns({
        "full_name": full_name(F.col("first_name"), F.col("last_name")),
        "gender": F.coalesce("gender", F.lit("U")),
        "dur_process": minutes_between(received, F.col("delivery_order_started_local")),
        "dur_total": minutes_between(received, F.col("delivery_order_complete_local"))})
    df = is_first_day(df, [org, "customer_id"], "order_time_local", "is_first_order")
    cities = zip_city.select(F.col("zipcode").alias("delivery_order_zipcode"), "zipcity")
    return (df.join(cities, "delivery_order_zipcode", "left")
            .withColumn("city", F.upper(F.coalesce("customer_city", "zipcity",
                                                   "delivery_order_city")))
            .drop("zipcity", "customer_city", "first_name", "last_name")
            .withColumnRenamed("delivery_order_zipcode", "delivery_zip")
            .where(F.col("order_facility").isNotNull() & F.col("order_time_local").isNotNull()))


# Header fields written once per order in the file, and order states left out.
_DOWN = ["type", "order_number", "order_source", "patient", "customer_type", "created_at",
         "status", "fulfillment", "metrc", "metrc_status"]
_UP = ["subtotal", "sales_tax", "shipping", "total", "total_discount_amount"]
_LEFT_OUT = ["Cancelled", "Declined", "Rejected", "Returned"]


def _filled(raw: DataFrame, row: str, rows_per_bucket: int) -> DataFrame:
    """The file's rows with order fields filled down and totals filled up, within one export."""
    down = {f"__{c}": c for c in _DOWN if c in raw.columns}
    up = {f"__{c}": c for c in _UP if c in raw.columns}
    filled = fill_both_ways(raw, ["run_date_utc"], [row], down, up, bucket=rows_per_bucket)
    return filled.withColumns({src: F.col(new) for new, src in {**down, **up}.items()}).drop(*down, *up)


def _not_left_out(rows: DataFrame) -> DataFrame:
    return rows.where(~F.coalesce(F.col("status"), F.lit("")).isin(_LEFT_OUT))


def flatfile_orders(raw: DataFrame, patients: DataFrame, *, org: str, source_system: str, zone: str, row: str = "row_no",
                    rows_per_bucket: int = 100_000) -> DataFrame:
    """Orders from an exported file: the rows without a quantity, in one layout.

    The latest copy of an order stands (by ``created_at`` as written, then by file row); cancelled and returned orders are
    left out, and so are customers who are not found by name. Times are written ``2021-03-05 14:30:00`` or ``3/5/2021 14:30`` in
    the shop's ``zone``; an unreadable one is NULL. The discount is what the total lacks against subtotal and tax.
    """
    totals = _filled(raw, row, rows_per_bucket).where(F.col("qty").isNull())
    orders = _not_left_out(latest_row(totals, ["order_number"], ["created_at", row]))
    at = F.coalesce(F.try_to_timestamp("created_at", F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp("created_at", F.lit("M/d/yyyy H:mm")),
                    F.try_to_timestamp("created_at", F.lit("M/d/yyyy h:mm a")))
    total, tax, subtotal = (F.col(c).try_cast("double") for c in ("total", "sales_tax", "subtotal"))
    orders = orders.withColumns({
        "order_type": F.when(F.col("type").contains("Delivery"), "Delivery").when(F.col("type").isNotNull(), "Retail"),
        "order_time_local": at, "order_time_utc": F.to_utc_timestamp(at, zone)})
    names = latest_row(patients, ["first_name", "last_name"], ["total_completed_orders"])
    address = squish(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("address", "city", "state", "zip")]))
    people = names.where(F.col("patient_id").isNotNull()).select(
        F.concat_ws(" ", "first_name", "last_name").alias("patient"), F.col("patient_id").cast("string").alias("customer_id"),
        F.when(F.col("zip").isNotNull(), address).alias("delivery_order_address"))
    none = F.lit(None).cast("string")
    return orders.join(people, "patient").select(
        F.lit(org).alias("org"), F.lit(source_system).alias("source_system"), F.col("run_date_utc").alias("source_run_date_utc"),
        F.col("order_number").alias("order_id"), "customer_id", "order_type", "order_source", none.alias("sold_by"),
        none.alias("sold_by_id"), "order_time_local", "order_time_utc", "delivery_order_address",
        F.when(F.col("order_type") == "Delivery", F.col("order_time_local")).alias("delivery_order_received_local"),
        F.lit(None).cast("timestamp").alias("delivery_order_started_local"),
        F.lit(None).cast("timestamp").alias("delivery_order_complete_local"),
        (total - tax).alias("order_subtotal"), tax.alias("order_tax"), total.alias("order_total"),
        F.round(total - (subtotal + tax), 2).alias("order_discount"))


def flatfile_order_lines(raw: DataFrame, patients: DataFrame, categories: DataFrame, *,
                         org: str, source_system: str, row: str = "row_no",
                         rows_per_bucket: int = 100_000) -> DataFrame:
    """Order lines from an exported file in which headers stand on one row only.

    ``row`` numbers the file's rows. Order fields are filled down, totals up,
    within one export; a file of any length is worked on in row buckets. Rows
    without a quantity are totals. The latest copy of a line stands, customers
    are found by name (most orders first) and lines without one left out. Lines are shuffled by order once, for their latest
    copies and their numbers; an order's lines are sorted in one task.
    """
    filled = _filled(raw, row, rows_per_bucket).where(F.col("qty").isNotNull()).repartition("order_number")
    lines = _not_left_out(latest_row(filled, ["order_number", "product"], ["created_at", row]))
    names = latest_row(patients, ["first_name", "last_name"], ["total_completed_orders"])
    ids = names.select(F.concat_ws(" ", "first_name", "last_name").alias("patient"),
                       F.col("patient_id").alias("customer_id"))
    lines = lines.withColumns({
        "product_name": F.upper("product"), "raw_category_name": F.lower("product_category"),
        "product_qty": F.col("qty").try_cast("double"),
        "order_line_total": F.col("amount").try_cast("double"),
        "order_line_list_price": F.col("price").try_cast("double")})
    lines = number_rows(lines, ["order_number"], ["product_name", row], "order_line_id", bucket=None)
    out = lines.join(ids.where(F.col("customer_id").isNotNull()), "patient").join(
        categories, "raw_category_name", "left")
    none = F.lit(None)
    return out.select(
        F.lit(org).alias("org"), F.lit(source_system).alias("source_system"),
        F.col("run_date_utc").alias("source_run_date_utc"), "customer_id",
        F.col("order_number").alias("order_id"),
        F.col("order_line_id").cast("string").alias("order_line_id"),
        none.cast("string").alias("product_id"), "product_name",
        none.cast("string").alias("brand_id"),
        brand_from_title(F.col("product_name")).alias("brand_name"),
        F.col("uom").alias("product_uom"), F.col("product_qty").alias("product_unit_count"),
        "product_qty", "product_category_name",
        strain_class(F.col("product_name")).alias("product_class"),
        none.cast("double").alias("order_line_discount"),
        none.cast("double").alias("order_line_subtotal"),
        none.cast("double").alias("order_line_tax"), "order_line_total",
        "order_line_list_price", "raw_category_name",
        none.cast("string").alias("raw_product_class"),
        none.cast("string").alias("product_sku"))
