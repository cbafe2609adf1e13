"""Product history and stock views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.orders import room_id_label, room_name_label
from ..functions.text import clean_text
from .joins import first_row_per_key
from .ordered import with_group_stats
from .reshape import stack


def product_history(population: DataFrame, keys: list[str] = ["org_uuid", "store_id",
                                                              "product_sku"]) -> DataFrame:
    """First and last sale date per store and product."""
    sold = population.where((F.col("item_subtotal") > 0) & F.col("product_sku").isNotNull())
    return sold.groupBy(*keys).agg(F.to_date(F.min("order_time_utc")).alias("first_order_date"),
                                   F.to_date(F.max("order_time_utc")).alias("last_order_date"))


def recent_product_sales(population: DataFrame, as_of: Column, days: int = 100) -> DataFrame:
    """Latest line per customer and product in the last days, amounts summed per line.

    The latest by time stands; equal times go to the greater order and line id.
    """
    group = ["order_time_utc", "pos_order_line_id", "order_id", "org_uuid", "store_id",
             "product_sku", "customer_id", "phone", "category3", "brand_name", "product_name"]
    since = F.date_sub(F.to_date(as_of), days).cast("timestamp")
    lines = population.where((F.col("order_time_utc") > since)
                             & F.col("product_sku").isNotNull() & F.col("order_id").isNotNull()
                             & F.col("pos_order_line_id").isNotNull())
    summed = lines.groupBy(*group).agg(
        F.sum("product_qty").alias("product_qty"), F.sum("item_subtotal").alias("item_subtotal"),
        F.sum("item_discount").alias("item_discount"),
        F.sum("item_list_price").alias("item_list_price"),
        F.avg("order_subtot").alias("order_subtotal"), F.avg("order_disc").alias("order_disc"))
    keys = ["customer_id", "phone", "category3", "brand_name", "product_name"]
    return first_row_per_key(summed, keys, [
        F.col(c).desc_nulls_last() for c in ("order_time_utc", "order_id", "pos_order_line_id",
                                             "org_uuid", "store_id", "product_sku")])


def product_index(lines: DataFrame, columns: list[str] = ["org_uuid", "store_uuid", "product_sku",
                                                          "category3", "brand_name", "image_url"]
                  ) -> DataFrame:
    return lines.select(*columns).distinct()


def tier_price(products: DataFrame, tiers: str = "pricingTierData") -> DataFrame:
    """Fill a missing price with the mean of the product's tier prices."""
    prices = F.filter(F.transform(F.col(tiers), lambda t: t["price"]), lambda p: p.isNotNull())
    mean = F.try_divide(F.aggregate(prices, F.lit(0.0), lambda a, p: a + p), F.size(prices))
    return products.withColumn("price", F.coalesce(F.col("price"), mean))


# Output column -> inventory column, each the first known value, newest row first.
_STOCK_ATTRIBUTES = {
    "product_id": "productId", "unit_price": "unitPrice", "unit_of_measure": "unitWeightUnit",
    "raw_category_name": "category", "brand_id": "brandId", "brand": "brandName",
    "product_name": "productName", "image": "imageUrl", "cost_per_unit": "unitCost",
    "raw_product_class": "strainType"}


def stock_by_sku(inventory: DataFrame, products: DataFrame, rooms: DataFrame,
                 keys: list[str] = ["org", "store"]) -> DataFrame:
    """Units per product, with attributes, per room, with products out of stock.

    ``rooms`` holds (keys, sku, roomId, room, quantityAvailable). Equal update
    times take the greatest value of an attribute.
    """
    priced = products.select(*keys, "productId", F.col("price").alias("__list")).groupBy(
        *keys, "productId").agg(F.max("__list").alias("__list"))
    stocked = (inventory.join(priced, [*keys, "productId"], "left")
               .withColumn("unitPrice", F.greatest("unitPrice", "__list")).drop("__list"))
    none_left = (products.join(inventory.select(*keys, "sku").distinct(), [*keys, "sku"],
                               "left_anti")
                 .select(*keys, "sku", "productId", F.lit(0.0).alias("quantityAvailable"),
                         F.col("price").alias("unitPrice"),
                         F.col("defaultUnit").alias("unitWeightUnit"), "category", "brandId",
                         "brandName", "productName", "imageUrl", "unitCost", "strainType"))
    rows = stack(stocked.select(*none_left.columns, "lastModifiedDateUtc"), none_left)
    totals = rows.groupBy(*keys, "sku").agg(
        F.sum("quantityAvailable").alias("units_in_stock"),
        *[F.max_by(F.col(src), F.when(F.col(src).isNotNull(),
                                      F.struct("lastModifiedDateUtc", src))).alias(out)
          for out, src in _STOCK_ATTRIBUTES.items()])
    per_room = rooms.groupBy(*keys, "sku", F.col("roomId").alias("room_id"),
                             F.col("room").alias("room_name")).agg(
        F.sum("quantityAvailable").alias("room_quantity"))
    return (totals.join(per_room, [*keys, "sku"], "left")
            .withColumn("room_quantity", F.coalesce(F.col("room_quantity"), F.lit(0.0))))


ROOM_ATTRIBUTES = ["product_name", "brand_id", "brand", "image", "unit_price", "unit_of_measure",
                   "cost_per_unit", "raw_category_name", "raw_product_class"]


def rooms_stock(snapshot: DataFrame, order_by: list[str]) -> DataFrame:
    """Units per room with one set of attributes per product and organisation.

    Rows missing a room get a label. Within (system, snapshot, organisation,
    sku) every row takes the last known attribute by ``order_by``. Rows without
    a sku or whose units are unknown are dropped.
    """
    labelled = (snapshot
                .withColumn("room_id", room_id_label(F.col("room_id"), F.col("room_name"),
                                                     F.col("units_in_stock")))
                .withColumn("room_name", room_name_label(F.col("room_id"), F.col("room_name"))))
    product = ["pos", "snapshot_utc", "org_uuid", "sku"]
    attributes = [c for c in ROOM_ATTRIBUTES if c in snapshot.columns]
    position = F.struct(*order_by)
    unified = with_group_stats(
        labelled, product,
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), position)).alias(f"__{c}")
          for c in attributes])
    group = [*product, "store_uuid", "facility", "room_id", "room_name"]
    out = unified.groupBy(*group, *[F.col(f"__{c}").alias(c) for c in attributes]).agg(
        F.coalesce(F.sum("units_in_stock"), F.lit(0.0)).alias("units_in_stock"))
    return out.where(F.col("sku").isNotNull() & (F.col("sku") != ""))


# Categories of things that have no product class.
_NO_CLASS = ["GLASS_PARAPH", "ACCESSORY_MERCH"]


def map_stock_categories(stock: DataFrame, default_categories: DataFrame,
                         org_categories: DataFrame, classes: DataFrame, *,
                         category2: Column | None = None,
                         classification2: Column | None = None) -> DataFrame:
    """Category and class of stock rows from the organisation's and the default mapping.

    Raw names are looked up in lower case. ``default_categories`` has
    (raw_category_name, product_category_name), ``org_categories`` the same with
    org_uuid and precedence, ``classes`` (raw_product_class, product_class); a
    raw name stands once in each, a NULL name is mapped to nothing.
    ``category2`` and ``classification2`` are expressions over the mapped
    ``category`` and ``classification``, by default these two; accessories have
    the class "None".
    """
    default = default_categories.select(
        "raw_category_name", F.col("product_category_name").alias("__default"))
    own = org_categories.where(F.col("org_uuid").isNotNull()).select(
        "org_uuid", "raw_category_name", F.col("product_category_name").alias("__own"))
    mapped = (stock.withColumns({c: F.lower(c) for c in ("raw_category_name", "raw_product_class")})
              .join(default, "raw_category_name", "left")
              .join(own, ["org_uuid", "raw_category_name"], "left")
              .join(classes.select("raw_product_class", "product_class"), "raw_product_class",
                    "left"))
    mapped = mapped.withColumns({
        "category": clean_text(F.coalesce("__own", "__default"), "upper"),
        "classification": clean_text(F.col("product_class"), "upper"),
    }).drop("__own", "__default", "product_class")
    mapped = mapped.withColumn("category2", F.col("category") if category2 is None else category2)
    plain = F.col("classification") if classification2 is None else classification2
    return mapped.withColumn("classification2", F.when(F.col("category2").isin(_NO_CLASS), "None")
                             .otherwise(plain))
