"""The wide order-line table, in its three forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.brand import tidy_brand
from ..functions.category import ignore_case_category, strict_category
from ..functions.dates import week_start
from ..functions.orders import order_key
from ..functions.people import gender_initial, numeric_name_to_null
from ..functions.text import clean_text
from ..operators.joins import (complete_lines, fill_from_products, lines_with_orders,
                               left_join_sparse, lookup_deliveries, null_safe_lookup, with_customers)
from ..operators.ordered import latest_row
from ..operators.patterns import fold_rules
from ..session import Stage, lazily

def standardize_brand(df: DataFrame, patterns: list[tuple[str, str]], *, brand: str = "brand_name",
                      product: str = "product_name", stage: Stage = lazily) -> DataFrame:
    """Clean brand names; a missing brand takes the product's name.

    ``patterns`` is the ordered (regex, name) rule table. It runs on the
    distinct names, each tried only with the patterns whose literals it holds, and
    the result is joined back to the lines. A value left starting with ``$`` is HOUSE. ``stage`` holds the distinct names,
    which are read several times.
    """
    tidied = df.withColumn("__tidy", tidy_brand(F.coalesce(F.col(brand), F.col(product))))
    mapping = fold_rules(stage(tidied.select("__tidy").distinct()), patterns, "__tidy", "__brand")
    mapping = mapping.withColumn("__brand", F.when(F.col("__brand").startswith("$"), "HOUSE").otherwise(F.col("__brand")))
    out = null_safe_lookup(tidied, mapping, ["__tidy"], ["__brand"])
    return out.withColumn(brand, F.col("__brand")).drop("__tidy", "__brand")


def category_cached(df: DataFrame, saved: DataFrame, *, raw: str = "raw_category_name",
                    product: str = "product_name", name: str = "category3"
                    ) -> tuple[DataFrame, DataFrame]:
    """Category from saved (raw, product) pairs; only missing pairs are derived.

    Returns the frame with the category and the newly derived pairs to save.
    """
    raw_key = F.nullif(F.upper(raw), F.lit(""))
    keyed = df.withColumn("__raw", raw_key).withColumn("__product", F.upper(product))
    pairs = keyed.select("__raw", "__product").distinct()
    saved = saved.select(F.col(raw).alias("__raw"), F.col(product).alias("__product"),
                         F.col(name).alias("__cat")).distinct()
    missing = pairs.join(saved, pairs["__raw"].eqNullSafe(saved["__raw"])
                         & pairs["__product"].eqNullSafe(saved["__product"]), "left_anti")
    derived = missing.withColumn("__cat", ignore_case_category(F.col("__raw"),
                                                               F.col("__product")))
    mapping = saved.unionByName(derived)
    out = null_safe_lookup(keyed, mapping, ["__raw", "__product"], ["__cat"])
    out = out.withColumn(name, F.col("__cat")).drop("__raw", "__product", "__cat")
    return out, derived.select(F.col("__raw").alias(raw), F.col("__product").alias(product),
                               F.col("__cat").alias(name))


_LOCATION = ["org_uuid", "store_uuid", "org", "store"]


def _pick(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rename to output names; ids that are numbers again become whole numbers."""
    numbers = {"customer_id", "order_id", "order_line_id", "product_id", "brand_id", "sold_by_id"}
    return df.select(*_LOCATION, *[
        (F.col(src).try_cast("bigint") if out in numbers else F.col(src)).alias(out)
        for out, src in columns.items()])


# Output column -> register column.
_CUSTOMER = {
    "customer_id": "customerId", "customer_created_at_utc": "creationDate",
    "customer_last_updated_utc": "lastModifiedDateUTC", "first_name": "firstName",
    "last_name": "lastName", "phone": "cellPhone", "email": "emailAddress",
    "user_type": "customerType", "gender": "gender", "birthday": "dateOfBirth",
    "has_loyalty": "isLoyaltyMember", "customer_address_street1": "address1",
    "customer_address_street2": "address2", "customer_city": "city", "customer_state": "state",
    "customer_zipcode": "postalCode"}
_ORDER = {
    "order_id": "transactionId", "customer_id": "customerId", "sold_by_id": "employeeId",
    "sold_by": "completedByUser", "order_type": "orderType", "order_source": "orderSource",
    "order_method": "orderMethod", "was_preorder": "wasPreOrdered",
    "checkin_time_utc": "checkInDate", "order_time_utc": "transactionDate",
    "order_time_local": "transactionDateLocalTime", "arrival_time_local": "estTimeArrivalLocal",
    "deliver_time_local": "estDeliveryDateLocal", "is_medical": "isMedical",
    "transact_type": "transactionType", "order_subtotal": "subtotal",
    "order_discount": "totalDiscount", "order_total_pretax": "totalBeforeTax",
    "order_tax": "tax", "order_total": "total", "total_paid": "paid",
    "total_change": "changeDue", "order_qty": "totalItems", "loyalty_spent": "loyaltySpent",
    "loyalty_earned": "loyaltyEarned"}
_ITEM = {
    "order_id": "transactionId", "order_line_id": "transactionItemId", "product_id": "productId",
    "pkg_id": "packageId", "src_pkg_id": "sourcePackageId", "product_qty": "quantity",
    "product_uom": "unitWeightUnit", "product_unit_count": "unitWeight",
    "price_per_qty": "unitPrice", "cost_per_qty": "unitCost", "order_line_total": "totalPrice",
    "order_line_discount": "totalDiscount"}
_PRODUCT = {
    "product_id": "productId", "product_sku": "sku", "product_name": "productName",
    "product_category_name": "masterCategory", "raw_category_name": "category",
    "product_class": "strainType", "product_strain": "strain", "brand_id": "brandId",
    "brand_name": "brandName", "product_grams": "productGrams"}


def population(customers: DataFrame, orders: DataFrame, items: DataFrame, products: DataFrame,
               brand_patterns: list[tuple[str, str]], stage: Stage = lazily, stage_products: Stage = lazily) -> DataFrame:
    """Lines with order, customer and product, from the clean register tables.

    Returned items are left out; so are returned orders, but their remaining
    items stay, with the order's columns NULL. ``stage_products`` holds the clean products, which are read for their brands and
    again for the lines.
    """
    orders = _pick(orders.where(~F.col("isReturn")), _ORDER).fillna(
        0, ["loyalty_spent", "loyalty_earned"])
    items = _pick(items.where(~F.col("isReturned")), _ITEM)
    by_vendor = F.col("brandId").isNull() & F.col("vendorId").isNotNull() \
        & F.col("brandName").isNull()
    products = _pick(products.withColumns({
        "brandId": F.when(by_vendor, F.col("vendorId")).otherwise(F.col("brandId")),
        "brandName": F.when(by_vendor, F.col("vendorName")).otherwise(F.col("brandName"))}),
        _PRODUCT)
    lines = lines_with_orders(items, orders, [*_LOCATION, "order_id"])
    lines = with_customers(lines, _pick(customers, _CUSTOMER), [*_LOCATION, "customer_id"],
                           ["order_id", "order_line_id"])
    # A line's brand is its product's, so names are cleaned on the products; a line without a product has no brand.
    products = stage_products(products)
    named = standardize_brand(products.withColumns({"__name": F.upper("product_name"), "__own": F.col("brand_name")}),
                              brand_patterns, brand="__own", product="__name", stage=stage)
    lines = fill_from_products(lines, named, [*_LOCATION, "product_id"],
                               [*[c for c in _PRODUCT if c != "product_id"], "__own"])
    lines = lines.withColumns({
        "category3": strict_category(F.col("raw_category_name"), F.col("product_name"),
                                     F.col("product_category_name")),
        "raw_category_name": F.lower("raw_category_name"),
        "product_name": F.upper("product_name"),
        "product_category_name": F.upper("product_category_name"),
        "raw_brand_name": F.col("brand_name"), "brand": F.col("brand_name"),
        "raw_product_name": F.upper("product_name"),
        "gender": F.coalesce("gender", F.lit("U"))})
    return lines.withColumn("brand_name", F.col("__own")).drop("__own")


# Customer columns that carry a prefix in the wide table.
_CUSTOMER_PREFIXED = ["created_at_utc", "last_updated_utc", "geocode_type", "long_address",
                      "address_street1", "address_street2", "city", "state", "zipcode",
                      "latitude", "longitude"]


def population_multi(lines: DataFrame, orders: DataFrame, customers: DataFrame, *,
                     deliveries: DataFrame | None = None, saved_categories: DataFrame | None = None
                     ) -> DataFrame:
    """Population over several register systems.

    Lines without an order are left out, lines without a customer kept. The
    seller's newest name in the organisation stands on all their orders there. Orders get their seller and customer before they
    meet the lines, which are shuffled once, by order.
    """
    keys = ["org", "source_system", "order_id"]
    lines = lines.where(F.col("org").isNotNull() & F.col("order_line_id").isNotNull()
                        & F.col("order_id").isNotNull()
                        & F.col("source_system").isNotNull())
    # Different lines and their orders meet in one shuffle. Only ``org`` and ``order_id``: Spark takes a ``source_system`` of one
    # fixed value out of the join's keys, and keys that differ from the join's would be shuffled again.
    lines = lines.repartition("org", "order_id").distinct()
    seller = ["org", "sold_by_id"]
    sellers = latest_row(orders.where(F.col("sold_by_id").isNotNull())
                         .select(*seller, "sold_by", "order_time_utc"), seller,
                         ["order_time_utc"]).drop("order_time_utc")
    orders = left_join_sparse(orders.drop("sold_by").distinct(), sellers, seller, "sold_by_id",
                              ["order_id"])
    customers = customers.distinct().withColumnsRenamed(
        {c: f"customer_{c}" for c in _CUSTOMER_PREFIXED if c in customers.columns})
    pop = complete_lines(lines, orders, customers, keys, ["customer_id", "org"],
                         ["order_id", "order_line_id"])
    if deliveries is not None:
        pop = lookup_deliveries(pop, deliveries).drop("pos_short_order_id")
    pop = pop.withColumns({"gender": F.coalesce("gender", F.lit("U")),
                           "age": F.coalesce("age", F.lit(0)),
                           "brand_name": F.coalesce("brand_name", F.lit("NO_VALUE"))})
    if saved_categories is None:
        pop = pop.withColumn("category3", ignore_case_category(F.col("raw_category_name"),
                                                               F.col("product_name")))
    else:
        pop, _ = category_cached(pop, saved_categories)
    return pop.withColumns({c: F.col(c).cast("string") for c in pop.columns if c.endswith("_id")})


def fill_amounts(df: DataFrame) -> DataFrame:
    """Repair missing amounts, each step seeing the one before.

    Discounts are negative. The line total is repaired only where a list price
    was there to begin with.
    """
    subtotal, total = F.col("item_subtotal"), F.col("item_total")
    listed, disc, tax = F.col("item_list_price"), F.col("item_discount"), F.col("item_tax")
    return (df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0))
                            for c in ("order_disc", "item_tax", "item_discount")})
            .withColumn("item_subtotal", F.coalesce(subtotal, listed + disc))
            .withColumn("item_total", F.when(total.isNull() & listed.isNotNull(),
                                             subtotal + disc + tax).otherwise(total))
            .withColumn("item_list_price", F.coalesce(listed, subtotal)))


def house_rules(df: DataFrame) -> DataFrame:
    """Nothing known about the product: HOUSE. Flower without a name: its brand."""
    unknown = (F.col("category").isNull() & F.col("brand_name").isNull()
               & F.col("product_name").isNull())
    df = df.withColumn("__unknown", unknown)
    df = df.withColumns({c: F.when(F.col("__unknown"), "HOUSE").otherwise(F.col(c))
                         for c in ("brand_name", "product_name", "category")}).drop("__unknown")
    return df.withColumn("product_name", F.when(
        F.col("brand_name").isNotNull() & F.col("product_name").isNull()
        & (F.col("category") == "FLOWER"), F.col("brand_name")).otherwise(F.col("product_name")))


# New names, the text columns that are cleaned, and the columns of the result in order.
_RENAMED = {
    "order_line_total": "item_total", "order_line_subtotal": "item_subtotal",
    "order_line_discount": "item_discount", "order_line_tax": "item_tax",
    "order_line_list_price": "item_list_price", "order_total": "order_tot",
    "order_subtotal": "order_subtot", "order_discount": "order_disc",
    "order_id": "pos_order_id", "order_line_id": "pos_order_line_id",
    "product_id": "pos_product_id", "raw_category_name": "pos_category",
    "product_category_name": "category", "product_class": "classification"}
_CLEANED = ["phone", "email", "first_name", "last_name", "product_name", "brand_name", "category",
            "classification", "order_facility", "order_type"]
POPULATION2_COLUMNS = [
    "org_uuid", "order_id", "order_facility", "facility", "store_id", "order_type",
    "order_time_utc", "customer_id", "first_name", "last_name", "gender", "birthday", "age",
    "phone", "product_name", "product_sku", "brand_name", "category2", "category3",
    "classification2", "product_qty", "item_total", "item_subtotal", "item_list_price",
    "item_discount", "order_tot", "order_subtot", "order_disc", "pos_order_id",
    "pos_order_line_id", "pos_product_id", "pos_category", "wk_start_date"]


def population2(pop: DataFrame, *, category2: Column | None = None,
                classification2: Column | None = None) -> DataFrame:
    """Population with clean text, repaired amounts, order key and week start.

    ``category2`` and ``classification2`` are expressions over the cleaned
    ``category`` and ``classification``; by default those are taken as they are.
    """
    df = pop.withColumnsRenamed(_RENAMED)
    df = df.withColumns({c: clean_text(F.col(c)) for c in _CLEANED})
    df = df.withColumn("order_id", order_key(F.col("org_uuid"), F.col("store_id"),
                                             F.col("pos_order_id")))
    df = house_rules(df.withColumn("product_name", F.upper("product_name")))
    df = fill_amounts(df.withColumns({
        "category2": F.col("category") if category2 is None else category2,
        "classification2": F.col("classification") if classification2 is None
        else classification2,
        "gender": gender_initial(F.col("gender")),
        "first_name": numeric_name_to_null(F.col("first_name"))}))
    return (df.withColumn("wk_start_date", week_start(F.col("order_time_utc")))
            .select(*POPULATION2_COLUMNS))
