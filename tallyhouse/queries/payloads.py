"""The star tables written the way the register sends them: nested JSON text.

Names get retail words by key, so that the category and brand rules have
something to find. The JSON goes through the declared schemas, like a file would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import star
from ..sources.payloads import parse_pos_json
from ..sources.variants import land_payloads, read_landed
from .registry import new_path

RAW_NAMES = ["Beverages", "pill box", "Edibles", "Non-Edible gifts", "gummies", "Vape Carts",
             "battery", "Pre-Roll pack", "joints with beverage", "bud", "Flower", "eighths",
             "Live Resin", "distillate", "tincture", "Bath Bombs", "Non Cannabis merch",
             "sugar", "shake sativa", "sublingual strips", "hash", "clones", "cream/lotion",
             "unsorted", ""]
TITLES = ["", "CAPSULE ", "gummies ", "cartridge ", "Syrup ", "shake ", "batteries ",
          "Transdermal "]
MASTERS = ["Flower", "Topical", "misc"]
SQL_RAW = "CASE WHEN p_partkey % 26 = 25 THEN NULL ELSE [{}][p_partkey % 26 + 1] END".format(
    ", ".join(f"'{n}'" for n in RAW_NAMES))
SQL_TITLE = "[{}][p_partkey % 8 + 1] || p_name".format(", ".join(f"'{n}'" for n in TITLES))
SQL_MASTER = "[{}][p_partkey % 3 + 1]".format(", ".join(f"'{n}'" for n in MASTERS))


def _pick(names: list[str], key: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), key.cast("int"))


def retail_names(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    return part.select(
        "*", _pick(RAW_NAMES, key % 26).alias("raw_category_name"),
        F.concat(_pick(TITLES, key % 8), "p_name").alias("product_name"),
        _pick(MASTERS, key % 3).alias("product_category_name"))


def as_text(df: DataFrame, fields: dict[str, Column], *keep: Column) -> DataFrame:
    """Rows as one-element JSON arrays of text."""
    body = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    return df.select("org", "store", F.concat(F.lit("["), body, F.lit("]")).alias("payload"), *keep)


def parsed(df: DataFrame, schema: str, fields: dict[str, Column]) -> DataFrame:
    """Rows as one-element JSON arrays of text, parsed with the declared schema."""
    return parse_pos_json(as_text(df, fields), "payload", schema)


def locations(spark, sf_dir) -> DataFrame:
    return star.stores(spark, sf_dir).select("org", "store", "org_uuid",
                                             F.col("store_id").alias("store_uuid"))


def transactions(spark, sf_dir, *, landed: bool = False) -> DataFrame:
    """Orders with their lines, line discounts, line taxes and order sums; ``landed`` reads them from variants."""
    if landed:
        return read_landed(spark, land_transactions(spark, sf_dir), "Transaction")
    return parse_pos_json(transaction_text(spark, sf_dir), "payload", "Transaction")


def land_transactions(spark, sf_dir, *, extra: bool = False) -> str:
    path = new_path(spark)
    land_payloads(transaction_text(spark, sf_dir, extra=extra), "payload", path)
    return path


def transaction_text(spark, sf_dir, *, extra: bool = False) -> DataFrame:
    """The orders as the register sends them; an order without lines has an empty list. ``extra`` adds fields that no schema
    declares."""
    li = star.load(spark, sf_dir, "lineitem")
    col = F.col
    raw = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
           "l_shipdate"]

    def item(of: Column) -> Column:
        return F.struct(
            col("l_orderkey").alias("transactionId"), of["l_partkey"].alias("productId"),
            (col("l_orderkey") * 10 + of["l_linenumber"]).alias("transactionItemId"),
            of["l_quantity"].alias("quantity"), of["l_extendedprice"].alias("totalPrice"),
            (of["l_returnflag"] == "R").alias("isReturned"),
            F.when(of["l_returnflag"] == "R", F.date_format(of["l_shipdate"], "yyyy-MM-dd'T'HH:mm:ss"))
            .alias("returnDate"),
            F.concat(F.lit("vendor "), of["l_suppkey"]).alias("vendor"),
            F.when(of["l_discount"] > 0, F.array(F.struct(
                of["l_linenumber"].cast("bigint").alias("discountId"),
                F.lit("promo").alias("discountName"), F.lit("sale").alias("discountReason"),
                of["l_discount"].alias("amount")))).otherwise(F.array()).alias("discounts"),
            F.array(F.struct(F.lit("sales").alias("rateName"), of["l_tax"].alias("rate"),
                             of["l_quantity"].alias("amount"))).alias("taxes"),
            *([F.lit("mint").alias("flavour")] if extra else []))

    # Only the lines' own columns are shuffled, and they meet the orders last, where they already lie by order.
    baskets = li.groupBy("l_orderkey").agg(F.collect_list(F.struct(*raw)).alias("items"))
    orders = star.load(spark, sf_dir, "orders")
    where = star.customers(spark, sf_dir).select("customer_id", "org", "store")
    rows = (orders.join(where, where["customer_id"] == orders["o_custkey"].cast("string"))
            .join(baskets, orders["o_orderkey"] == baskets["l_orderkey"], "left")
            .withColumn("items", F.transform("items", item)))
    key = col("o_orderkey")
    return as_text(rows, {
        "transactionId": key, "customerId": col("o_custkey"),
        "transactionDate": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
        "isVoid": F.lit(False), "isReturn": col("o_orderstatus") == "P",
        "total": col("o_totalprice"), "transactionType": F.lit("Retail sale"),
        "orderType": col("o_orderpriority"), "items": F.coalesce("items", F.array()),
        "discounts": F.when(key % 3 != 0, F.array(F.struct(
            (key % 4).alias("discountId"), F.lit("loyal").alias("discountName"),
            F.lit("card").alias("discountReason"), F.lit(1.5).alias("amount"),
            key.alias("transactionItemId")))).otherwise(F.array()),
        "taxSummary": F.array(F.struct(F.lit("sales").alias("rateName"),
                                       (key % 100).cast("double").alias("amount"))),
        "feesAndDonations": F.array(), "orderIds": F.array(key),
        **({"customField": key, "loyalty": F.struct(F.lit(1).alias("tier"))} if extra else {})},
        key.alias("orderkey"), col("o_orderstatus").alias("orderstatus"))


def customers(spark, sf_dir) -> DataFrame:
    c = star.load(spark, sf_dir, "customer")
    where = star.customers(spark, sf_dir).select("customer_id", "org", "store", "phone", "email")
    rows = c.join(where, where["customer_id"] == c["c_custkey"].cast("string"))
    key = F.col("c_custkey")
    day = F.date_add(F.lit("1900-11-01").cast("date"), (key % 30000).cast("int"))
    return parsed(rows, "Customer", {
        "customerId": key, "firstName": F.concat(F.lit("  pat   "), key), "lastName": F.lit("N/A"),
        "city": F.when(key % 5 == 0, " ").otherwise("  new   york "),
        "cellPhone": F.col("phone"), "emailAddress": F.upper("email"),
        "gender": _pick(["Male", "f", "2", "unknown", "x", ""], key % 6),
        "dateOfBirth": F.date_format(day, "yyyy-MM-dd"),
        "creationDate": F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"),
        "lastModifiedDateUTC": F.date_format(day, "MM/dd/yyyy HH:mm:ss"),
        "customerType": F.lower("c_mktsegment"), "springBigMemberId": key % 3,
        "discountGroups": F.when(key % 2 == 0, F.array(F.lit("Staff"), F.lit("VIP")))
        .otherwise(F.array()),
        "secondaryQualifyingConditions": F.when(key % 3 == 0, F.array(F.lit("A"), F.lit("B")))
        .otherwise(F.array()),
        "isLoyaltyMember": key % 2 == 1})


def sold_products(spark, sf_dir) -> DataFrame:
    """``org, store, p_partkey``: the products of a store's order lines, in one row each; what no product table knows is still in."""
    lines = star.load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("order_id"),
                                                        F.col("l_partkey").alias("p_partkey"))
    where = star.orders(spark, sf_dir).select("order_id", "org", "store")
    return lines.join(where, "order_id").select("org", "store", "p_partkey").distinct()


def products(spark, sf_dir) -> DataFrame:
    """Product details per store, for the products the store has sold."""
    part = retail_names(star.load(spark, sf_dir, "part"))
    rows = sold_products(spark, sf_dir).join(part, "p_partkey")
    key = F.col("p_partkey")
    return parsed(rows, "ProductDetail", {
        "productId": key, "sku": F.concat(F.lit("SKU"), key), "productName": F.col("product_name"),
        "category": F.col("raw_category_name"), "masterCategory": F.col("product_category_name"),
        "brandId": F.when(key % 7 != 0, key % 25),
        "brandName": F.when(key % 7 != 0, F.col("p_brand")),
        "vendorId": F.when(key % 14 != 0, key % 10), "vendorName": F.lit("b vendor's (1/4)"),
        "price": F.col("p_retailprice"),
        "pricingTierData": F.when(key % 2 == 0, F.array(F.struct(
            F.lit(1.0).alias("startWeight"), F.lit(2.0).alias("endWeight"),
            F.col("p_retailprice").alias("price")))).otherwise(F.array())})


def inventory(spark, sf_dir) -> DataFrame:
    """Stock of every product a store has sold, in one or two rooms."""
    part = star.load(spark, sf_dir, "part")
    rows = sold_products(spark, sf_dir).join(part, "p_partkey")
    key = F.col("p_partkey")
    room = [F.struct(F.lit(i).cast("bigint").alias("roomId"), F.lit(name).alias("room"),
                     (key % (7 + i)).cast("double").alias("quantityAvailable"))
            for i, name in ((1, "front"), (2, "vault"))]
    return parsed(rows, "ReportingInventoryItem", {
        "productId": key, "sku": F.concat(F.lit("SKU"), key), "productName": F.col("p_name"),
        "packageId": F.concat(F.lit("PK"), key), "brandName": F.col("p_brand"),
        "category": F.lower("p_type"), "unitPrice": F.col("p_retailprice"),
        "quantityAvailable": (key % 50).cast("double"),
        "lastModifiedDateUtc": F.lit("2001-08-01T10:00:00"),
        "sampleDate": F.lit("2001-07-01T00:00:00"), "testedDate": F.lit("2001-07-02T00:00:00"),
        "labResults": F.when(key % 3 != 0, F.array(F.struct(
            F.lit("thc").alias("labTest"), F.col("p_size").cast("double").alias("value"),
            F.lit("pct").alias("labResultUnit")))).otherwise(F.array()),
        "roomQuantities": F.when(key % 2 == 0, F.array(*room)).otherwise(F.array(room[0]))})


SQL_SOLD = """
sold AS (SELECT DISTINCT org, store, org_uuid, store_id, CAST(product_id AS BIGINT) AS p_partkey
         FROM pop)"""
