"""Population forms, product history and stock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import extract, stock
from ..plans.population import population2 as build_population2
from ..plans.population import population_multi as build_population_multi
from ..plans.population import standardize_brand
from ..plans.stock_layouts import STOCK_SYSTEMS, STOCK_WITHOUT_COST, stacked_stock, stock_mapping
from ..session import cut_lineage
from ..sources import star
from . import payloads
from .registry import AS_OF, LINES, POP, TOTALS, at, digits, query

BRAND_RULES = [(r"^BRAND#1[0-9]$", "TEENS"), (r"^BRAND#(2|3)$", "DUO")]


@query(f"WITH {POP} " + """
SELECT org_uuid, store_id, product_sku, category3, CASE
    WHEN regexp_matches(upper(brand_name), '^BRAND#1[0-9]$') THEN 'TEENS'
    WHEN upper(brand_name) IN ('BRAND#2', 'BRAND#3') THEN 'DUO' ELSE upper(brand_name) END
    AS brand_name,
  CAST(min(order_time_utc) AS DATE) AS first_order_date,
  CAST(max(order_time_utc) AS DATE) AS last_order_date
FROM pop WHERE item_subtotal > 0 GROUP BY ALL
""")
def product_history(spark, sf_dir) -> DataFrame:
    """First and last sale per store and product, on the categorised population."""
    pop = standardize_brand(star.population(spark, sf_dir), BRAND_RULES, stage=cut_lineage)
    return stock.product_history(pop, ["org_uuid", "store_id", "product_sku", "category3",
                                       "brand_name"])


@query(f"WITH {TOTALS}, {LINES}, " + """
g AS (
  SELECT order_time_utc, order_line_id AS pos_order_line_id, l.order_id, org_uuid, store_id,
    product_sku, customer_id, phone, category3, brand_name, product_name,
    sum(product_qty) AS product_qty, sum(item_subtotal) AS item_subtotal,
    sum(item_discount) AS item_discount, sum(item_list_price) AS item_list_price,
    avg(order_subtot) AS order_subtotal, avg(order_disc) AS order_disc
  FROM lines l JOIN totals t ON l.order_id = t.order_id
  WHERE order_time_utc > TIMESTAMP '2001-08-02' - INTERVAL 500 DAY GROUP BY ALL)
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY customer_id, phone, category3, brand_name, product_name
  ORDER BY order_time_utc DESC, order_id DESC, pos_order_line_id DESC) AS rn FROM g) WHERE rn = 1
""", digits=digits(4, "item_subtotal", "item_discount", "item_list_price", "order_subtotal",
                   "order_disc"))
def recent_product_sales(spark, sf_dir) -> DataFrame:
    """Latest line per customer and product in the last days."""
    heads = star.order_totals(spark, sf_dir)
    pop = (star.lines(spark, sf_dir).drop("sold_by_id").join(heads, "order_id")
           .withColumnRenamed("order_line_id", "pos_order_line_id"))
    return stock.recent_product_sales(pop, at(AS_OF), days=500)


@query(f"WITH {POP} SELECT DISTINCT org_uuid, store_id, product_sku, category3, brand_name "
       "FROM pop")
def product_index(spark, sf_dir) -> DataFrame:
    """Distinct products per store."""
    return stock.product_index(star.population(spark, sf_dir), [
        "org_uuid", "store_id", "product_sku", "category3", "brand_name"])


_STOCK = f"""WITH {POP}, {payloads.SQL_SOLD}, prod AS (SELECT * FROM sold JOIN part USING (p_partkey)),
inv AS (SELECT * FROM prod WHERE p_size < 40)"""


@query(_STOCK + """
SELECT p.org, p.store, 'SKU' || p_partkey AS sku, p_partkey AS product_id,
  CASE WHEN p_size < 40 THEN CAST(p_partkey % 50 AS DOUBLE) ELSE 0.0::DOUBLE END AS units_in_stock,
  CASE WHEN p_size < 40 THEN greatest(p_retailprice, p_retailprice * CASE WHEN p_size % 2 = 0 THEN 2
         ELSE 0.5 END) ELSE p_retailprice * CASE WHEN p_size % 2 = 0 THEN 2 ELSE 0.5 END END
    AS unit_price,
  CASE WHEN p_size < 40 THEN lower(p_type) ELSE p_type END AS raw_category_name, p_brand AS brand,
  p_name AS product_name, CAST(i AS BIGINT) AS room_id, ['front', 'vault'][i] AS room_name,
  CASE WHEN i IS NULL THEN 0.0::DOUBLE ELSE CAST(p_partkey % (7 + i) AS DOUBLE) END
    AS room_quantity
FROM prod p LEFT JOIN (SELECT unnest([1, 2]) AS i) ON p_size < 40 AND (i = 1 OR p_partkey % 2 = 0)
""", digits=digits(4, "unit_price"))
def stock_by_sku(spark, sf_dir) -> DataFrame:
    """Units and attributes per product and room, products out of stock added."""
    inventory = payloads.inventory(spark, sf_dir)
    part = star.load(spark, sf_dir, "part")
    size = part.select(F.col("p_partkey").alias("productId"), "p_size")
    inventory = cut_lineage(inventory.join(size, "productId").where("p_size < 40").drop("p_size"))
    rooms = extract.extract_inventory(inventory)["stock_by_room"]
    sold = star.population(spark, sf_dir).select(
        "org", "store", F.col("product_id").cast("bigint").alias("p_partkey")).distinct()
    none = F.lit(None)
    products = sold.join(part, "p_partkey").select(
        "org", "store", F.col("p_partkey").alias("productId"),
        F.concat(F.lit("SKU"), "p_partkey").alias("sku"),
        # The price comes from the tiers, whose mean it is.
        none.cast("double").alias("price"), F.array(*[
            F.struct((F.col("p_retailprice") * f * F.when(F.col("p_size") % 2 == 0, 2.0)
                      .otherwise(0.5)).alias("price")) for f in (0.5, 1.5)])
        .alias("pricingTierData"), F.lit("g").alias("defaultUnit"),
        F.col("p_type").alias("category"), none.cast("bigint").alias("brandId"),
        F.col("p_brand").alias("brandName"), F.col("p_name").alias("productName"),
        none.cast("string").alias("imageUrl"), none.cast("double").alias("unitCost"),
        none.cast("string").alias("strainType"))
    return stock.stock_by_sku(inventory, stock.tier_price(products), rooms).select(
        "org", "store", "sku", "product_id", "units_in_stock", "unit_price", "raw_category_name",
        "brand", "product_name", "room_id", "room_name", "room_quantity")


@query("""
WITH s AS (
  SELECT CASE WHEN l_partkey % 50 <> 0 THEN 'SKU' || l_partkey ELSE '' END AS sku,
    CASE WHEN l_linenumber % 2 = 0 THEN 'r' || l_linenumber END AS rid,
    CASE WHEN l_linenumber % 3 = 0 THEN 'room' END AS rname,
    CASE WHEN l_linenumber = 5 THEN 0 ELSE l_quantity END AS units,
    CASE WHEN l_returnflag = 'A' THEN p_brand || l_linestatus END AS brand,
    l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_linestatus
  FROM lineitem JOIN part ON l_partkey = p_partkey),
lab AS (
  SELECT *, CASE WHEN rid IS NULL AND rname IS NULL AND units = 0 THEN 'NO STOCK'
      WHEN rid IS NULL THEN 'UNKNOWN' ELSE rid END AS room_id FROM s),
att AS (SELECT sku, arg_max(brand, (l_shipdate, l_orderkey, l_linenumber, l_linestatus))
          FILTER (WHERE brand IS NOT NULL) AS brand FROM lab GROUP BY sku)
SELECT sku, room_id, CASE WHEN room_id = 'NO STOCK' THEN 'NO STOCK' WHEN rname IS NULL
    THEN 'UNKNOWN' ELSE rname END AS room_name, att.brand, sum(units) AS units_in_stock
FROM lab JOIN att USING (sku) WHERE sku <> '' GROUP BY ALL
""", digits=digits(2, "units_in_stock"))
def rooms_stock(spark, sf_dir) -> DataFrame:
    """Units per room with each product's last known brand."""
    li, p = star.load(spark, sf_dir, "lineitem"), star.load(spark, sf_dir, "part")
    n = F.col("l_linenumber")
    rows = li.join(p, li["l_partkey"] == p["p_partkey"]).select(
        F.lit("till").alias("pos"), F.lit("2001-08-01").cast("timestamp").alias("snapshot_utc"),
        F.lit("o").alias("org_uuid"), F.lit("s").alias("store_uuid"), F.lit("f").alias("facility"),
        F.when(F.col("l_partkey") % 50 != 0, F.concat(F.lit("SKU"), "l_partkey")).otherwise("")
        .alias("sku"), F.when(n % 2 == 0, F.concat(F.lit("r"), n)).alias("room_id"),
        F.when(n % 3 == 0, "room").alias("room_name"),
        F.when(n == 5, 0.0).otherwise(F.col("l_quantity")).alias("units_in_stock"),
        F.when(F.col("l_returnflag") == "A", F.concat("p_brand", "l_linestatus")).alias("brand"),
        "l_shipdate", "l_orderkey", "l_linenumber", "l_linestatus")
    return stock.rooms_stock(rows, ["l_shipdate", "l_orderkey", "l_linenumber", "l_linestatus"]
                             ).select("sku", "room_id", "room_name", "brand", "units_in_stock")


@query("""
SELECT l_orderkey, l_linenumber, lower(p_type) AS raw_category_name,
  lower(p_brand) AS raw_product_class,
  CASE WHEN p_type = 'PROMO' AND l_suppkey % 2 = 0 THEN 'ACCESSORY_MERCH'
       WHEN p_type <> 'LARGE' THEN 'CAT ' || upper(p_type) END AS category2,
  CASE WHEN p_type = 'PROMO' AND l_suppkey % 2 = 0 THEN 'None'
       WHEN length(p_brand) % 2 = 0 THEN 'CLASS ' || upper(p_brand) END AS classification2
FROM lineitem JOIN part ON l_partkey = p_partkey
""")
def stock_categories(spark, sf_dir) -> DataFrame:
    """Category and class of stock rows by the organisation's map, then the default one."""
    li, p = star.load(spark, sf_dir, "lineitem"), star.load(spark, sf_dir, "part")
    rows = li.join(p, li["l_partkey"] == p["p_partkey"]).select(
        "l_orderkey", "l_linenumber", F.col("p_type").alias("raw_category_name"),
        F.col("p_brand").alias("raw_product_class"),
        F.concat(F.lit("o"), F.col("l_suppkey") % 2).alias("org_uuid"))
    kind, brand = F.lower("p_type"), F.lower("p_brand")
    default = p.where("p_type <> 'LARGE'").select(
        kind.alias("raw_category_name"), F.concat(F.lit(" cat  "), kind).alias(
            "product_category_name")).distinct()
    own = p.where("p_type = 'PROMO'").select(
        F.lit("o0").alias("org_uuid"), kind.alias("raw_category_name"),
        F.lit("accessory_merch").alias("product_category_name")).distinct()
    classes = p.where("length(p_brand) % 2 = 0").select(
        brand.alias("raw_product_class"), F.concat(F.lit("Class "), brand).alias(
            "product_class")).distinct()
    return stock.map_stock_categories(rows, default, own, classes).select(
        "l_orderkey", "l_linenumber", "raw_category_name", "raw_product_class", "category2",
        "classification2")


def _register(spark, sf_dir):
    """Lines, orders and customers as three consolidated tables."""
    # The order's organisation goes on the bare lines, before products widen them.
    bare, where = star.load(spark, sf_dir, "lineitem"), star.orders(spark, sf_dir).select("order_id", "org")
    bare = bare.join(where, bare["l_orderkey"].cast("string") == where["order_id"]).drop("order_id")
    li, o = star.lines(spark, sf_dir, bare, ("org",)), star.order_totals(spark, sf_dir)
    lines = li.select(
        F.lit("till").alias("source_system"), "order_id", "order_line_id", "product_id",
        "product_name", F.when(F.col("raw_category_name") != "PROMO", F.col("brand_name"))
        .alias("brand_name"), "product_qty", "raw_category_name", "product_sku",
        F.col("item_total").alias("order_line_total"),
        F.col("item_subtotal").alias("order_line_subtotal"), "org")
    orders = o.where("status <> 'P'").select(
        "org", F.lit("till").alias("source_system"), "order_id",
        F.when(F.col("order_type") != "Delivery", F.col("customer_id")).alias("customer_id"),
        "order_time_utc", "order_tot", "sold_by_id",
        F.concat("sold_by_id", F.lit(" "), F.date_format("order_time_utc", "yyyy")).alias("sold_by"))
    customers = star.customers(spark, sf_dir).where("user_type <> 'BUILDING'").select(
        "org", "customer_id", "phone", F.when(F.col("gender") == "M", "M").alias("gender"),
        F.lit(None).cast("int").alias("age"), F.col("store").alias("city"))
    return lines, orders, customers


@query(f"WITH {TOTALS}, {LINES}, " + """
sellers AS (SELECT org, sold_by_id, sold_by_id || ' ' || year(max(order_time_utc)) AS sold_by
            FROM totals WHERE status <> 'P' GROUP BY 1, 2)
SELECT DISTINCT l.order_id, l.order_line_id, o.org, CASE WHEN order_type <> 'Delivery'
    THEN o.customer_id END AS customer_id, c.phone, coalesce(CASE WHEN c.gender = 'M' THEN 'M' END,
    'U') AS gender, 0 AS age, c.store AS customer_city, s.sold_by,
  CASE WHEN l.raw_category_name <> 'PROMO' THEN l.brand_name ELSE 'NO_VALUE' END AS brand_name,
  'OTHER' AS category3, l.product_qty, l.item_total AS order_line_total
FROM lines l JOIN totals o ON l.order_id = o.order_id AND o.status <> 'P'
LEFT JOIN cust c ON c.customer_id = CASE WHEN order_type <> 'Delivery' THEN o.customer_id END
  AND c.org = o.org AND c.user_type <> 'BUILDING'
LEFT JOIN sellers s ON s.sold_by_id = o.sold_by_id AND s.org = o.org
""", digits=digits(4, "order_line_total"))
def population_multi(spark, sf_dir) -> DataFrame:
    """Population over consolidated tables: lines with an order, customer if known."""
    return build_population_multi(*_register(spark, sf_dir)).select(
        "order_id", "order_line_id", "org", "customer_id", "phone", "gender", "age",
        "customer_city", "sold_by", "brand_name", "category3", "product_qty", "order_line_total")


@query(f"WITH {TOTALS}, {LINES} " + """
SELECT sha256(org_uuid || chr(31) || store_id || chr(31) || l.order_id) AS order_id,
  l.order_id AS pos_order_id, order_line_id AS pos_order_line_id, upper(product_name) AS product_name,
  CASE WHEN raw_category_name = 'PROMO' THEN NULL ELSE brand_name END AS brand_name,
  raw_category_name AS category2, CASE WHEN gender IN ('M', 'F') THEN gender ELSE 'U' END AS gender,
  CASE WHEN CAST(customer_id AS BIGINT) % 2 = 0 THEN full_name END AS first_name,
  item_list_price + item_discount AS item_subtotal,
  item_list_price + item_discount + item_discount + item_tax AS item_total, item_list_price,
  date_trunc('week', order_time_utc)::TIMESTAMP AS wk_start_date
FROM lines l JOIN totals o ON l.order_id = o.order_id
""", digits=digits(4, "item_subtotal", "item_total", "item_list_price"))
def population2(spark, sf_dir) -> DataFrame:
    """Population with clean text, repaired amounts, order key and week start."""
    heads = star.order_totals(spark, sf_dir)
    pop = star.lines(spark, sf_dir).drop("sold_by_id").join(heads, "order_id")
    none = F.lit(None)
    rows = pop.select(
        "org_uuid", "store_id", F.col("store").alias("facility"),
        F.col("store").alias("order_facility"), "order_id", "order_line_id", "product_id",
        "order_type", "order_time_utc", "customer_id", "phone", "email", "gender",
        F.when(F.col("customer_id").cast("bigint") % 2 == 0, F.col("full_name"))
        .otherwise("007").alias("first_name"), F.lit(" x  y ").alias("last_name"),
        none.cast("date").alias("birthday"), none.cast("int").alias("age"),
        F.concat(F.lit("  "), "product_name").alias("product_name"), "product_sku",
        F.when(F.col("raw_category_name") == "PROMO", "N/A").otherwise(F.col("brand_name"))
        .alias("brand_name"), "category3", "raw_category_name",
        F.col("raw_category_name").alias("product_category_name"),
        F.lit("").alias("product_class"), "product_qty",
        none.cast("double").alias("order_line_total"),
        none.cast("double").alias("order_line_subtotal"),
        F.col("item_discount").alias("order_line_discount"),
        F.col("item_tax").alias("order_line_tax"),
        F.col("item_list_price").alias("order_line_list_price"),
        F.col("order_tot").alias("order_total"), F.col("order_subtot").alias("order_subtotal"),
        F.col("order_disc").alias("order_discount"))
    return build_population2(rows).select(
        "order_id", "pos_order_id", "pos_order_line_id", "product_name", "brand_name", "category2",
        "gender", "first_name", "item_subtotal", "item_total", "item_list_price", "wk_start_date")


def _landed_stock(spark, sf_dir, system: str, place: int) -> DataFrame:
    """A system's landing table under its own column names: the lines of every twelfth supplier."""
    li, part = star.load(spark, sf_dir, "lineitem"), star.load(spark, sf_dir, "part")
    rows = li.where(F.col("l_suppkey") % len(STOCK_SYSTEMS) == place).join(part, li["l_partkey"] == part["p_partkey"])
    values = {
        "snapshot_utc": F.col("l_shipdate").cast("timestamp"), "org_uuid": F.lit("org"), "store_uuid": F.col("l_suppkey").cast("string"),
        "facility": F.lit("shop"), "room_id": F.col("l_linenumber"), "product_id": F.col("p_partkey"),
        "sku": F.concat(F.lit("SKU"), "p_partkey"), "product_name": F.col("p_name"), "brand_id": F.col("p_size"),
        "brand": F.col("p_brand"), "room_name": F.col("l_linestatus"), "units_in_stock": F.col("l_quantity"),
        "image": F.lit(None).cast("string"), "unit_price": F.col("p_retailprice"), "unit_of_measure": F.lit("g"),
        "cost_per_unit": F.col("l_extendedprice"), "raw_category_name": F.col("p_type"), "raw_product_class": F.col("l_returnflag")}
    # A source column that feeds two outputs exists once.
    own = {src: values["brand" if src.startswith("brand") else out] if src in ("brand", "brand_name") else values[out]
           for s, out, src, _ in stock_mapping() if s == system and src is not None}
    return rows.select(*[c.alias(src) for src, c in own.items()])


def _stock_sql(system: str, place: int) -> str:
    brand_id = "p_brand" if system in ("treez", "webjoint") else "CAST(p_size AS VARCHAR)"
    cost = "NULL" if system in STOCK_WITHOUT_COST else "l_extendedprice"
    mine = f"l_suppkey % {len(STOCK_SYSTEMS)} = {place}"
    return f"""SELECT '{system}' AS pos, CAST(l_shipdate AS TIMESTAMP) AS snapshot_utc, CAST(l_suppkey AS VARCHAR) AS store_uuid,
  CAST(l_linenumber AS VARCHAR) AS room_id, CAST(p_partkey AS VARCHAR) AS product_id, 'SKU' || p_partkey AS sku, p_name AS product_name,
  {brand_id} AS brand_id, p_brand AS brand, l_linestatus AS room_name, l_quantity AS units_in_stock, p_retailprice AS unit_price,
  'g' AS unit_of_measure, {cost}::DOUBLE AS cost_per_unit, p_type AS raw_category_name, l_returnflag AS raw_product_class
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE {mine} AND l_shipdate = (SELECT max(l_shipdate) FROM lineitem JOIN part ON l_partkey = p_partkey WHERE {mine})"""


@query(" UNION ALL ".join(_stock_sql(system, i) for i, system in enumerate(STOCK_SYSTEMS)))
def stacked_stock_layouts(spark, sf_dir) -> DataFrame:
    """The newest stock of twelve systems, each with its own columns, in one layout."""
    landing = {system: _landed_stock(spark, sf_dir, system, i) for i, system in enumerate(STOCK_SYSTEMS)}
    return stacked_stock(landing).drop("org_uuid", "facility", "image")
