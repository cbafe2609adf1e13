"""Payload extraction and the clean register tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import extract
from ..plans import pos_tables
from ..plans.population import population as build_population
from ..schemas import add_location_ids, conform_schema, location_problems
from ..session import cut_lineage, cut_lineage_columns
from ..sources import star, variants
from ..sources.payloads import parse_pos_json
from . import payloads
from .registry import CUST, POP, STORES, digits, new_path, query

_PLACE = """
place AS (SELECT CAST(customer_id AS BIGINT) AS c_custkey, org, store, org_uuid, store_id
          FROM cust),
tx AS (SELECT o_orderkey, o_custkey, org, store, org_uuid, store_id, o_orderstatus,
              o_totalprice, o_orderdate, o_orderpriority FROM orders JOIN place
              ON o_custkey = c_custkey),
item AS (SELECT * FROM lineitem JOIN tx ON l_orderkey = o_orderkey)"""
_TX = f"WITH {CUST}, {_PLACE}"


def _parts(spark, sf_dir):
    return extract.extract_transactions(payloads.transactions(spark, sf_dir))


@query(_TX + """
SELECT o_orderkey AS "transactionId", o_custkey AS "customerId", o_totalprice AS total,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS "transactionDate", org, store FROM tx
""")
def extract_order_summary(spark, sf_dir) -> DataFrame:
    """Order headers out of nested JSON text."""
    return _parts(spark, sf_dir)["order_summary"].select(
        "transactionId", "customerId", "total", "transactionDate", "org", "store")


@query(_TX + """
SELECT o_orderkey AS "transactionId", o_custkey AS "customerId", o_totalprice AS total,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS "transactionDate", org, store,
       coalesce(n, 0) AS n_items FROM tx LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
       ON o_orderkey = l_orderkey
""")
def landed_orders(spark, sf_dir) -> DataFrame:
    """Order headers from landed variants; a scan reads the asked fields only."""
    return payloads.transactions(spark, sf_dir, landed=True).select(
        "transactionId", "customerId", "total", "transactionDate", "org", "store",
        F.size("items").cast("long").alias("n_items"))


@query(_TX + """
SELECT * FROM (VALUES ('customField', 'BIGINT'), ('items[].flavour', 'STRING'), ('loyalty', 'OBJECT')) AS t(field, type)
WHERE EXISTS (SELECT 1 FROM tx)
""")
def undeclared_order_fields(spark, sf_dir) -> DataFrame:
    """Fields of the orders' payloads that their schema does not declare."""
    path = payloads.land_transactions(spark, sf_dir, extra=True)
    return variants.undeclared_fields(spark, path, "Transaction")


@query(_TX + """
SELECT org, store, 'order ' || o_orderkey AS rejected FROM tx WHERE o_orderstatus = 'P'
""")
def rejected_landed_orders(spark, sf_dir) -> DataFrame:
    """Payload text that is no JSON object, as landed beside the good rows."""
    text = payloads.transaction_text(spark, sf_dir)
    broken = F.when(F.col("orderstatus") == "P", F.concat(F.lit("order "), "orderkey")).otherwise(F.col("payload"))
    path = new_path(spark)
    variants.land_payloads(text.withColumn("payload", broken), "payload", path)
    return variants.rejected_landed(spark, path)


@query(_TX + """
SELECT o_orderkey AS "transactionId", org, store, 'sales' AS "rateName",
       CAST(o_orderkey % 100 AS DOUBLE) AS amount FROM tx
""")
def extract_order_tax(spark, sf_dir) -> DataFrame:
    return _parts(spark, sf_dir)["order_tax"]


@query(_TX + """
SELECT o_orderkey AS "transactionId", org, store, nullif(o_orderkey % 4, 0) AS "discountId",
       'loyal' AS "discountName", 'card' AS "discountReason", 1.5::DOUBLE AS amount
FROM tx WHERE o_orderkey % 3 <> 0
""")
def extract_order_discount(spark, sf_dir) -> DataFrame:
    """Order discounts; the id 0 is no id."""
    return _parts(spark, sf_dir)["order_discount"]


@query(_TX + """
SELECT o_orderkey AS "transactionId", org, store, l_partkey AS "productId",
       l_orderkey * 10 + l_linenumber AS "transactionItemId", l_quantity AS quantity,
       l_extendedprice AS "totalPrice", l_returnflag = 'R' AS "isReturned" FROM item
""")
def extract_order_items(spark, sf_dir) -> DataFrame:
    return _parts(spark, sf_dir)["order_items"].select(
        "transactionId", "org", "store", "productId", "transactionItemId", "quantity",
        "totalPrice", "isReturned")


@query(_TX + """
SELECT o_orderkey AS "transactionId", org, store, 'sales' AS "rateName", l_tax AS rate,
       l_quantity AS amount, CAST(NULL AS BIGINT) AS "transactionItemId" FROM item
""")
def extract_order_items_tax(spark, sf_dir) -> DataFrame:
    return _parts(spark, sf_dir)["order_items_tax"]


@query(_TX + """
SELECT o_orderkey AS "transactionId", org, store, CAST(l_linenumber AS BIGINT) AS "discountId",
       'promo' AS "discountName", 'sale' AS "discountReason", l_discount AS amount,
       CAST(NULL AS BIGINT) AS "transactionItemId" FROM item WHERE l_discount > 0
""")
def extract_order_items_discount(spark, sf_dir) -> DataFrame:
    return _parts(spark, sf_dir)["order_items_discount"]


@query(_TX + """
SELECT org, store, coalesce(order_items, 0) AS order_items, coalesce(order_items_discount, 0) AS order_items_discount,
       coalesce(order_items, 0) AS order_items_tax, order_discount, order_tax
FROM (SELECT org, store, count(*) FILTER (WHERE o_orderkey % 3 <> 0) AS order_discount, count(*) AS order_tax
      FROM tx GROUP BY org, store)
LEFT JOIN (SELECT org, store, count(*) AS order_items, count(*) FILTER (WHERE l_discount > 0) AS order_items_discount
           FROM item GROUP BY org, store) USING (org, store)
""")
def validate_order_batch(spark, sf_dir) -> DataFrame:
    """Child rows of each kind per store."""
    return extract.validate_batch(payloads.transactions(spark, sf_dir))


_SOLD = f"WITH {POP}, {payloads.SQL_SOLD}, stock AS (SELECT * FROM sold JOIN part USING (p_partkey))"


def _stock(spark, sf_dir):
    return extract.extract_inventory(payloads.inventory(spark, sf_dir))


@query(_SOLD + """
SELECT org, store, p_partkey AS "productId", 'SKU' || p_partkey AS sku,
       CAST(p_partkey % 50 AS DOUBLE) AS "quantityAvailable", p_retailprice AS "unitPrice"
FROM stock
""")
def extract_stock_summary(spark, sf_dir) -> DataFrame:
    return _stock(spark, sf_dir)["stock_summary"].select(
        "org", "store", "productId", "sku", "quantityAvailable", "unitPrice")


@query(_SOLD + """
SELECT org, store, p_partkey AS "productId", 'SKU' || p_partkey AS sku,
       'PK' || p_partkey AS "packageId", '2001-08-01T10:00:00' AS "lastModifiedDateUtc",
       '2001-07-01T00:00:00' AS "sampleDate", '2001-07-02T00:00:00' AS "testedDate",
       'thc' AS "labTest", CAST(p_size AS DOUBLE) AS value, 'pct' AS "labResultUnit"
FROM stock WHERE p_partkey % 3 <> 0
""")
def extract_lab_results(spark, sf_dir) -> DataFrame:
    return _stock(spark, sf_dir)["stock_lab_results"]


@query(_SOLD + """
SELECT org, store, p_partkey AS "productId", 'SKU' || p_partkey AS sku,
       'PK' || p_partkey AS "packageId", '2001-08-01T10:00:00' AS "lastModifiedDateUtc",
       CAST(i AS BIGINT) AS "roomId", ['front', 'vault'][i] AS room,
       CAST(p_partkey % (7 + i) AS DOUBLE) AS "quantityAvailable"
FROM stock, (SELECT unnest([1, 2]) AS i) WHERE i = 1 OR p_partkey % 2 = 0
""")
def extract_room_quantities(spark, sf_dir) -> DataFrame:
    return _stock(spark, sf_dir)["stock_by_room"]


@query("""
SELECT DISTINCT CAST(NULL AS BIGINT) AS "brandId", p_brand AS "brandName", 'demo' AS org,
       'main' AS store FROM part
""")
def extract_flat_brands(spark, sf_dir) -> DataFrame:
    """Payload without children, location added."""
    text = star.load(spark, sf_dir, "part").select(
        F.concat(F.lit("["), F.to_json(F.struct(F.col("p_brand").alias("brandName"))),
                 F.lit("]")).alias("payload"))
    rows = parse_pos_json(text, "payload", "Brand", keep=())
    return extract.extract_flat(rows, "demo", "main").distinct()


_LOG_SCHEMA = ("status string, data struct<k: bigint, cost: struct<amount: double>, "
               "to: array<struct<phone: string>>>")


@query("""
SELECT event_id, event_type AS resp_status, CAST(props->>'k' AS BIGINT) AS resp_data_k,
       value AS resp_data_cost_amount, '[{"phone":"555' || user_id || '"}]' AS resp_data_to
FROM events WHERE event_type <> 'error'
""")
def unnest_response_log(spark, sf_dir) -> DataFrame:
    """JSON responses to prefixed columns, recursively; lists stay JSON text."""
    events = star.load(spark, sf_dir, "events")
    nested = F.to_json(F.struct(
        F.col("event_type").alias("status"), F.struct(
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
            F.struct(F.col("value").alias("amount")).alias("cost"),
            F.array(F.struct(F.concat(F.lit("555"), "user_id").alias("phone"))).alias("to"))
        .alias("data")))
    text = events.select("event_id", F.when(F.col("event_type") == "error", "failed")
                         .otherwise(nested).alias("resp"))
    return extract.parse_response_log(text, "resp", T.StructType.fromDDL(_LOG_SCHEMA))


@query("SELECT event_id, props->>'k' AS campaign, props->>'missing' AS title FROM events")
def hoist_event_props(spark, sf_dir) -> DataFrame:
    """Named fields out of JSON text."""
    return extract.hoist(star.load(spark, sf_dir, "events").select("event_id", "props"), "props",
                         {"campaign": "$.k", "title": "$.missing"}).drop("props")


@query(f"WITH {CUST} " + """
SELECT customer_id, TIMESTAMP '2001-08-01 00:00:00' AS run_date_utc,
       CASE WHEN CAST(customer_id AS BIGINT) % 4 <> 0 THEN true END AS address_primary,
       CASE WHEN CAST(customer_id AS BIGINT) % 4 <> 0 THEN 'home' END AS address_type,
       CASE WHEN CAST(customer_id AS BIGINT) % 4 <> 0 THEN store END AS address_city,
       CAST(NULL AS VARCHAR) AS address_street1
FROM cust
""")
def explode_customer_addresses(spark, sf_dir) -> DataFrame:
    """One address per customer: of the newest run, the primary one."""
    c = star.customers(spark, sf_dir)

    def address(kind, city, primary):
        return F.struct(F.lit(kind).alias("type"), F.lit("").alias("street1"),
                        city.alias("city"), F.lit(primary).alias("primary"))

    text = F.to_json(F.array(address("home", F.col("store"), True),
                             address("work", F.col("org"), False)))
    rows = c.select("org", "customer_id", F.when(F.col("customer_id").cast("bigint") % 4 != 0, text)
                    .alias("addresses"),
                    F.explode(F.array(F.lit("2001-07-01"), F.lit("2001-08-01"))).alias("run"))
    rows = rows.withColumn("run_date_utc", F.col("run").cast("timestamp")).drop("run")
    return extract.explode_addresses(rows).select(
        "customer_id", "run_date_utc", "address_primary", "address_type", "address_city",
        "address_street1")


@query(f"WITH {CUST} " + """
SELECT customer_id, store AS shop,
       CASE WHEN CAST(customer_id AS BIGINT) % 3 = 0 THEN 'flyer' ELSE 'regular' END AS tags,
       CASE WHEN CAST(customer_id AS BIGINT) % 2 = 0
            THEN CAST(customer_id AS DOUBLE) + 0.5 END AS loyalty_pts
FROM cust WHERE CAST(customer_id AS BIGINT) % 5 <> 0
""")
def extract_customer_tags(spark, sf_dir) -> DataFrame:
    """Tag array to flyer class and reward points; no tags, no row."""
    key = F.col("customer_id").cast("bigint")
    rows = star.customers(spark, sf_dir).select(
        "org", "customer_id", F.col("store").alias("shop"),
        F.when(key % 5 != 0, F.to_json(F.array(
            F.when(key % 3 == 0, "April FLYER").otherwise("walk-in"),
            F.when(key % 2 == 0, F.concat(F.lit("$"), key, F.lit(".5 Reward"))).otherwise("x"))))
        .alias("tags"), F.lit("2001-08-01").cast("timestamp").alias("run_date_utc"))
    return extract.extract_tags(rows, keep=("shop",)).drop("org")


@query(_TX + """
SELECT l_orderkey AS order_id, CAST(to_json(list({'discount': l_discount, 'line': l_linenumber}
         ORDER BY l_linenumber, l_discount)) AS VARCHAR) AS discounts_json
FROM lineitem WHERE l_discount > 0 GROUP BY l_orderkey
""")
def nest_discounts_json(spark, sf_dir) -> DataFrame:
    """Child rows to one JSON array per order."""
    rows = star.load(spark, sf_dir, "lineitem").where("l_discount > 0").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_discount").alias("discount"),
        F.col("l_linenumber").alias("line"))
    return extract.nest_json(rows, ["order_id"], "discounts_json", ["line"])


@query(f"WITH {CUST} SELECT CAST(customer_id AS BIGINT) AS \"customerId\", org, store FROM cust")
def conform_customer_schema(spark, sf_dir) -> DataFrame:
    """Declared columns in declared order, extra columns dropped."""
    rows = payloads.customers(spark, sf_dir).withColumn("surprise", F.lit(1))
    return conform_schema(rows, "Customer").select("customerId", "org", "store")


@query(f"WITH {CUST} SELECT count(*) AS total_rows, 0 AS rows_without_location FROM cust")
def check_locations(spark, sf_dir) -> DataFrame:
    """Rows and rows without a location."""
    return location_problems(payloads.customers(spark, sf_dir))


@query(f"WITH {CUST} SELECT customer_id, org_uuid, store_id AS store_uuid FROM cust")
def location_ids(spark, sf_dir) -> DataFrame:
    """Location ids by org and store name."""
    rows = star.customers(spark, sf_dir).select("customer_id", "org", "store")
    return add_location_ids(rows, payloads.locations(spark, sf_dir)).select(
        "customer_id", "org_uuid", "store_uuid")


_C = "CAST(customer_id AS BIGINT)"
_DAY = f"(DATE '1900-11-01' + CAST({_C} % 30000 AS INTEGER))"


@query(f"WITH {CUST} " + f"""
SELECT org_uuid, store_id AS store_uuid, customer_id AS "customerId",
       'PAT ' || customer_id AS "firstName", CAST(NULL AS VARCHAR) AS "lastName",
       CASE WHEN {_C} % 5 <> 0 THEN 'NEW YORK' END AS city, lower(email) AS "emailAddress",
       ['M', 'F', 'U', 'U', 'U', 'U'][{_C} % 6 + 1] AS gender,
       CASE WHEN year({_DAY}) <> 1900 THEN {_DAY} END AS "dateOfBirth",
       CASE WHEN year({_DAY}) <> 1900 THEN CAST({_DAY} AS TIMESTAMP) END AS "creationDate",
       CASE WHEN year({_DAY}) <> 1900 THEN CAST({_DAY} AS TIMESTAMP) END
         AS "lastModifiedDateUTC",
       nullif(CAST({_C} % 3 AS VARCHAR), '0') AS "springBigMemberId",
       CASE WHEN {_C} % 2 = 0 THEN 'staff,vip' END AS "discountGroups",
       CASE WHEN {_C} % 3 = 0 THEN 'a, b' END AS "secondaryQualifyingConditions"
FROM cust
""")
def table_customer_summary(spark, sf_dir) -> DataFrame:
    """Clean customers from the register payload."""
    return pos_tables.customer_summary(payloads.customers(spark, sf_dir),
                                       payloads.locations(spark, sf_dir)).select(
        "org_uuid", "store_uuid", "customerId", "firstName", "lastName", "city", "emailAddress",
        "gender", "dateOfBirth", "creationDate", "lastModifiedDateUTC", "springBigMemberId",
        "discountGroups", "secondaryQualifyingConditions")


@query(_TX + """
SELECT org_uuid, store_id AS store_uuid, CAST(o_orderkey AS VARCHAR) AS "transactionId",
       CAST(o_custkey AS VARCHAR) AS "customerId", o_orderdate AS "transactionDate",
       'RETAIL SALE' AS "transactionType", o_orderstatus = 'P' AS "isReturn",
       CASE WHEN o_orderkey % 3 <> 0 THEN
         CASE WHEN o_orderkey % 4 = 0 THEN '[{"discountName":"loyal",'
              ELSE '[{"discountId":"' || o_orderkey % 4 || '","discountName":"loyal",' END
         || '"discountReason":"card","amount":1.5}]' END AS order_discount_json,
       '[{"rateName":"sales","amount":' || CAST(o_orderkey % 100 AS DOUBLE) || '}]'
         AS order_tax_json,
       '[' || o_orderkey || ']' AS "orderIds_json", '[]' AS "feesAndDonations_json"
FROM tx
""")
def table_order_summary(spark, sf_dir) -> DataFrame:
    """Clean order headers; child arrays become JSON in place."""
    return pos_tables.order_summary(payloads.transactions(spark, sf_dir),
                                    payloads.locations(spark, sf_dir)).select(
        "org_uuid", "store_uuid", "transactionId", "customerId", "transactionDate",
        "transactionType", "isReturn", "order_discount_json", "order_tax_json", "orderIds_json",
        "feesAndDonations_json")


@query(_TX + """
SELECT org_uuid, CAST(o_orderkey AS VARCHAR) AS "transactionId",
       CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS "transactionItemId",
       CAST(l_partkey AS VARCHAR) AS "productId", 'VENDOR ' || l_suppkey AS vendor,
       CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS "returnDate",
       CASE WHEN l_discount > 0 THEN '[{"discountId":"' || l_linenumber
         || '","discountName":"promo","discountReason":"sale","amount":' || l_discount || '}]' END
         AS order_item_discount_json,
       '[{"rateName":"sales","rate":' || l_tax || ',"amount":' || l_quantity || '}]'
         AS order_item_tax_json
FROM item
""")
def table_order_items(spark, sf_dir) -> DataFrame:
    """Clean order lines."""
    return pos_tables.order_items(payloads.transactions(spark, sf_dir),
                                  payloads.locations(spark, sf_dir)).select(
        "org_uuid", "transactionId", "transactionItemId", "productId", "vendor", "returnDate",
        "order_item_discount_json", "order_item_tax_json")


@query(_SOLD + f"""
SELECT org_uuid, store_id AS store_uuid, CAST(p_partkey AS VARCHAR) AS "productId",
       upper({payloads.SQL_TITLE}) AS "productName",
       nullif(upper({payloads.SQL_RAW}), '') AS category,
       upper({payloads.SQL_MASTER}) AS "masterCategory",
       CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_partkey % 25 AS VARCHAR) END AS "brandId",
       CASE WHEN p_partkey % 7 <> 0 THEN upper(p_brand) END AS "brandName",
       CASE WHEN p_partkey % 2 = 0 THEN '[{{"startWeight":1.0,"endWeight":2.0,"price":'
         || p_retailprice || '}}]' END AS "pricingTierData_json"
FROM stock
""")
def table_product_summary(spark, sf_dir) -> DataFrame:
    """Clean products."""
    return pos_tables.product_summary(payloads.products(spark, sf_dir),
                                      payloads.locations(spark, sf_dir)).select(
        "org_uuid", "store_uuid", "productId", "productName", "category", "masterCategory",
        "brandId", "brandName", "pricingTierData_json")


@query(_SOLD + """
SELECT org_uuid, CAST(p_partkey AS VARCHAR) AS "productId", upper(p_name) AS "productName",
       upper(p_type) AS category, upper(p_brand) AS "brandName",
       CAST(p_partkey % 50 AS DOUBLE) AS "quantityAvailable",
       TIMESTAMP '2001-08-01 10:00:00' AS "lastModifiedDateUtc"
FROM stock
""")
def table_stock_summary(spark, sf_dir) -> DataFrame:
    return pos_tables.stock_summary(_stock(spark, sf_dir)["stock_summary"],
                                    payloads.locations(spark, sf_dir)).select(
        "org_uuid", "productId", "productName", "category", "brandName", "quantityAvailable",
        "lastModifiedDateUtc")


@query(_SOLD + """
SELECT store_id AS store_uuid, CAST(p_partkey AS VARCHAR) AS "productId",
       CAST(i AS VARCHAR) AS "roomId", ['FRONT', 'VAULT'][i] AS room,
       CAST(p_partkey % (7 + i) AS DOUBLE) AS "quantityAvailable"
FROM stock, (SELECT unnest([1, 2]) AS i) WHERE i = 1 OR p_partkey % 2 = 0
""")
def table_stock_by_room(spark, sf_dir) -> DataFrame:
    return pos_tables.stock_by_room(_stock(spark, sf_dir)["stock_by_room"],
                                    payloads.locations(spark, sf_dir)).select(
        "store_uuid", "productId", "roomId", "room", "quantityAvailable")


@query(_SOLD + """
SELECT store_id AS store_uuid, CAST(p_partkey AS VARCHAR) AS "productId", 'THC' AS "labTest",
       CAST(p_size AS DOUBLE) AS labvalue, TIMESTAMP '2001-07-02 00:00:00' AS "testedDate"
FROM stock WHERE p_partkey % 3 <> 0
""")
def table_stock_lab_results(spark, sf_dir) -> DataFrame:
    labs = _stock(spark, sf_dir)["stock_lab_results"].withColumn("labResultUnitId",
                                                                 F.lit(1).cast("bigint"))
    return pos_tables.stock_lab_results(labs, payloads.locations(spark, sf_dir)).select(
        "store_uuid", "productId", "labTest", "labvalue", "testedDate")


@query(f"WITH {STORES} " + """
SELECT org_uuid, CAST(s_suppkey AS BIGINT) AS "userId", upper(s_name) AS "fullName",
       'till' AS groups, CAST(NULL AS TIMESTAMP) AS "mmjExpiration"
FROM supplier JOIN stores ON s_nationkey = n_nationkey
""")
def table_store_employees(spark, sf_dir) -> DataFrame:
    """Staff, with the filler year 1900 taken out."""
    s, where = star.load(spark, sf_dir, "supplier"), star.stores(spark, sf_dir)
    rows = s.join(where, s["s_nationkey"] == where["n_nationkey"])
    staff = payloads.parsed(rows, "Employee", {
        "userId": F.col("s_suppkey"), "fullName": F.col("s_name"), "groups": F.lit("TILL"),
        "mmjExpiration": F.lit("1900-01-01")})
    return pos_tables.store_employees(staff, payloads.locations(spark, sf_dir)).select(
        "org_uuid", "userId", "fullName", "groups", "mmjExpiration")


@query(f"WITH {CUST} SELECT org_uuid, customer_id AS \"customerId\", "
       "balance AS \"loyaltyBalance\" FROM cust")
def table_customer_loyalty(spark, sf_dir) -> DataFrame:
    rows = star.customers(spark, sf_dir)
    points = payloads.parsed(rows, "LoyaltySnapshot", {
        "customerId": F.col("customer_id").cast("bigint"), "loyaltyBalance": F.col("balance")})
    return pos_tables.customer_loyalty(points, payloads.locations(spark, sf_dir)).select(
        "org_uuid", "customerId", "loyaltyBalance")


@query(_SOLD + """
SELECT DISTINCT org_uuid, CAST(CAST(regexp_extract(p_brand, '[0-9]+') AS BIGINT) AS VARCHAR)
       AS "brandId", upper(p_brand) AS "brandName" FROM stock
""")
def table_brand_index(spark, sf_dir) -> DataFrame:
    rows = star.population(spark, sf_dir).select("org", "store", "brand_name").distinct()
    brands = payloads.parsed(rows, "Brand", {
        "brandId": F.regexp_extract("brand_name", "[0-9]+", 0).cast("bigint"),
        "brandName": F.col("brand_name")})
    return pos_tables.brand_index(brands, payloads.locations(spark, sf_dir)).select(
        "org_uuid", "brandId", "brandName").distinct()


@query(_SOLD + """
SELECT DISTINCT org_uuid, store_id AS store_uuid, p_type AS category,
       CASE WHEN p_type <> 'PROMO' THEN 'GOODS' END AS "masterCategory" FROM stock
""")
def table_category_index(spark, sf_dir) -> DataFrame:
    rows = star.population(spark, sf_dir).select("org", "store", "raw_category_name").distinct()
    names = payloads.parsed(rows, "ProductCategory", {
        "productCategoryName": F.lower("raw_category_name"),
        "masterCategory": F.when(F.col("raw_category_name") == "PROMO", "").otherwise("goods")})
    return pos_tables.category_index(names, payloads.locations(spark, sf_dir)).select(
        "org_uuid", "store_uuid", "category", "masterCategory")


@query(_SOLD + """
SELECT org_uuid, CAST(p_partkey AS BIGINT) AS "productId", upper(p_name) AS product,
       'FRONT' AS room, CAST(p_size AS DOUBLE) AS quantity,
       TIMESTAMP '2001-08-01 00:00:00' AS "snapshotDate" FROM stock
""")
def table_stock_snapshot(spark, sf_dir) -> DataFrame:
    part = star.load(spark, sf_dir, "part")
    snap = payloads.parsed(payloads.sold_products(spark, sf_dir).join(part, "p_partkey"), "InventorySnapshot", {
        "productId": F.col("p_partkey"), "product": F.col("p_name"), "room": F.lit("front"),
        "quantity": F.col("p_size").cast("double"), "snapshotDate": F.lit("2001-08-01T00:00:00")})
    return pos_tables.stock_snapshot(snap, payloads.locations(spark, sf_dir)).select(
        "org_uuid", "productId", "product", "room", "quantity", "snapshotDate")


BRAND_RULES = [(r"^BRAND#1[0-9]$", "TEENS"), (r"^BRAND#(2|3)$", "DUO"), (r"^TEENS$", "TEEN GROUP"),
               (r"VENDORS", "$VENDOR"), (r"WIDGET", "WIDGETS")]
_BRAND_STEPS = """CASE WHEN regexp_matches(b, '^BRAND#1[0-9]$') THEN 'TEEN GROUP'
            WHEN regexp_matches(b, '^BRAND#(2|3)$') THEN 'DUO'
            WHEN regexp_matches(b, 'VENDORS') THEN 'HOUSE'
            WHEN regexp_matches(b, 'WIDGET') THEN 'WIDGETS' ELSE b END"""


@query(_TX + f""", c2 AS (
  SELECT CAST(customer_id AS BIGINT) AS customer_id,
         ['M', 'F', 'U', 'U', 'U', 'U'][{_C} % 6 + 1] AS gender, phone FROM cust),
p2 AS (
  SELECT p_partkey, upper({payloads.SQL_TITLE}) AS product_name,
         CASE WHEN p_partkey % 7 <> 0 THEN upper(p_brand)
              WHEN p_partkey % 14 <> 0 THEN 'B VENDOR''S (1/4)' END AS raw_brand_name FROM part),
lines AS (
  SELECT org_uuid, store_id AS store_uuid, l_orderkey AS order_id,
         l_orderkey * 10 + l_linenumber AS order_line_id, l_partkey AS product_id,
         CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS customer_id,
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS order_total,
         CASE WHEN o_orderstatus <> 'P' THEN 0.0::DOUBLE END AS loyalty_spent,
         l_quantity AS product_qty
  FROM item WHERE l_returnflag <> 'R')
SELECT org_uuid, store_uuid, order_id, order_line_id, product_id, l.customer_id, order_total,
       loyalty_spent, product_qty, coalesce(gender, 'U') AS gender, phone, product_name,
       raw_brand_name, {_BRAND_STEPS} AS brand_name
FROM (SELECT l.*, c2.gender, c2.phone, p2.product_name, p2.raw_brand_name,
             CASE WHEN p2.raw_brand_name = 'B VENDOR''S (1/4)' THEN 'VENDORS'
                  ELSE regexp_replace(coalesce(p2.raw_brand_name, p2.product_name),
                                      '^[A-Z] ', '') END AS b
      FROM lines l LEFT JOIN c2 USING (customer_id) LEFT JOIN p2 ON product_id = p_partkey) l
""", digits=digits(2, "order_total"))
def population_from_payloads(spark, sf_dir) -> DataFrame:
    """Wide line table built from nested JSON: extract, clean, join, categorise."""
    where = payloads.locations(spark, sf_dir)
    tx = payloads.transactions(spark, sf_dir, landed=True)
    pop = build_population(
        pos_tables.customer_summary(payloads.customers(spark, sf_dir), where),
        pos_tables.order_summary(tx, where), pos_tables.order_items(tx, where),
        pos_tables.product_summary(payloads.products(spark, sf_dir), where), BRAND_RULES, stage=cut_lineage,
        stage_products=cut_lineage_columns)
    return pop.select("org_uuid", "store_uuid", "order_id", "order_line_id", "product_id",
                      "customer_id", "order_total", "loyalty_spent", "product_qty", "gender",
                      "phone", "product_name", "raw_brand_name", "brand_name")
