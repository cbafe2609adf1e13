"""Clean tables from the register's payloads (one function per table).

The column names listed here are fixed values: those of the payloads and of the tables made from them.
Each takes rows with ``org`` and ``store`` and the location dimension. No plan
here shuffles its payload: child arrays are turned into JSON in place and the
location join is with a small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_date, parse_timestamp
from ..functions.people import gender_or_unknown
from ..functions.text import blank_to_null, clean_text, csv_or_null, list_to_csv
from ..operators.extract import array_to_json
from ..schemas import add_location_ids, conform_schema

_IDS_FIRST = ["org_uuid", "store_uuid", "org", "store"]


def _replace(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """Replace columns in one projection."""
    return df.withColumns(changes) if changes else df


def _text_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


def ids_to_string(df: DataFrame) -> DataFrame:
    """Every column whose name ends in ``Id`` as text."""
    return _replace(df, {c: F.col(c).cast("string") for c in df.columns if c.endswith("Id")})


def _upper(df: DataFrame, columns: list[str]) -> DataFrame:
    return _replace(df, {c: F.upper(c) for c in columns})


def _timestamps(df: DataFrame, columns: list[str]) -> DataFrame:
    return _replace(df, {c: parse_timestamp(F.col(c), keep_1900=True) for c in columns})


def _finish(df: DataFrame, locations: DataFrame, lead: list[str]) -> DataFrame:
    out = add_location_ids(df, locations)
    first = [*_IDS_FIRST, *lead]
    return out.select(*first, *[c for c in out.columns if c not in first])


# Columns of the customer payload set to upper and to lower case.
_CUSTOMER_UPPER = ["name", "firstName", "lastName", "middleName", "nameSuffix", "namePrefix",
                   "address1", "address2", "city", "state", "status", "customerType", "gender",
                   "createdByIntegrator", "referralSource", "customIdentifier",
                   "otherReferralSource"]
_CUSTOMER_LOWER = ["createdAtLocation", "primaryQualifyingCondition",
                   "secondaryQualifyingConditions", "discountGroups", "notes", "emailAddress"]


def customer_summary(customers: DataFrame, locations: DataFrame) -> DataFrame:
    df = conform_schema(customers, "Customer")
    df = _replace(df, {
        "secondaryQualifyingConditions": csv_or_null(F.col("secondaryQualifyingConditions")),
        "discountGroups": list_to_csv(F.col("discountGroups")),
        "lastModifiedDateUTC": parse_timestamp(F.col("lastModifiedDateUTC"),
                                               "MM/dd/yyyy HH:mm:ss"),
        "creationDate": parse_timestamp(F.col("creationDate")),
        "dateOfBirth": parse_date(F.col("dateOfBirth")),
        "mmjidExpirationDate": parse_date(F.col("mmjidExpirationDate"))})

    def case(c):
        return "upper" if c in _CUSTOMER_UPPER else "lower" if c in _CUSTOMER_LOWER else None

    df = _replace(df, {c: clean_text(F.col(c), case(c)) for c in _text_columns(df)})
    df = ids_to_string(df)
    df = _replace(df, {"springBigMemberId": F.nullif(F.col("springBigMemberId"), F.lit("0")),
                       "gender": gender_or_unknown(F.col("gender"))})
    return _finish(df, locations, ["customerId", "lastModifiedDateUTC", "creationDate",
                                   "externalCustomerId", "mergedIntoCustomerId"])


def store_employees(employees: DataFrame, locations: DataFrame) -> DataFrame:
    df = conform_schema(employees, "Employee")
    df = _replace(df, {
        "mmjExpiration": parse_timestamp(F.col("mmjExpiration")),
        **{c: F.upper(c) for c in ("status", "fullName", "stateId", "loginId")},
        **{c: F.lower(c) for c in ("permissionsLocation", "groups")}})
    return _finish(df, locations, ["userId", "loginId", "fullName"])


def customer_loyalty(loyalty: DataFrame, locations: DataFrame) -> DataFrame:
    df = conform_schema(loyalty, "LoyaltySnapshot")
    return _finish(_replace(df, {"customerId": F.col("customerId").cast("string")}), locations,
                   ["customerId"])


def order_summary(transactions: DataFrame, locations: DataFrame) -> DataFrame:
    """Order headers; discounts, taxes, fees and order ids as JSON text."""
    named = F.transform("discounts", lambda d: d.withField(
        "discountId", F.nullif(d["discountId"], F.lit(0))))
    extra = transactions.select(
        "*", array_to_json(named, ["discountId", "discountName", "discountReason", "amount"],
                           ids=("discountId",)).alias("order_discount_json"),
        array_to_json(F.col("taxSummary"), ["rateName", "amount"]).alias("order_tax_json"))
    json_columns = ["order_discount_json", "order_tax_json"]
    df = conform_schema(extra, "Transaction", include=json_columns,
                        ignore=["items", "discounts", "taxSummary"])
    df = (df.withColumn("feesAndDonations_json", F.to_json("feesAndDonations"))
          .withColumn("orderIds_json", F.to_json("orderIds"))
          .drop("feesAndDonations", "orderIds"))
    df = _timestamps(df, ["transactionDate", "voidDate", "checkInDate", "lastModifiedDateUTC",
                          "transactionDateLocalTime", "estDeliveryDateLocal"])
    df = _upper(df, ["transactionType", "orderType", "orderSource", "completedByUser",
                     "terminalName", "orderMethod", "invoiceName"])
    return _finish(ids_to_string(df), locations, ["transactionId", "customerId", "employeeId"])


def order_items(transactions: DataFrame, locations: DataFrame) -> DataFrame:
    """Order lines; their discounts and taxes as JSON text."""
    rows = transactions.select("org", "store", F.explode("items").alias("i"))
    rows = rows.select(
        "i.*", "org", "store",
        array_to_json(F.col("i.discounts"), ["discountId", "discountName", "discountReason",
                                             "amount"], ids=("discountId",))
        .alias("order_item_discount_json"),
        array_to_json(F.col("i.taxes"), ["rateName", "rate", "amount"])
        .alias("order_item_tax_json"))
    df = conform_schema(rows, "TransactionItem",
                        include=["order_item_discount_json", "order_item_tax_json"],
                        ignore=["discounts", "taxes"])
    df = _timestamps(df, ["returnDate"])
    df = _upper(df, ["vendor", "returnReason", "unitWeightUnit", "flowerEquivalentUnit"])
    return _finish(ids_to_string(df), locations, ["transactionId", "transactionItemId",
                                                  "productId", "sourcePackageId"])


def product_summary(products: DataFrame, locations: DataFrame) -> DataFrame:
    df = conform_schema(products, "ProductDetail").drop("tags")
    for c in ("imageUrls", "taxCategories", "pricingTierData"):
        df = df.withColumn(f"{c}_json", F.when(F.size(c) > 0, F.to_json(c))).drop(c)
    df = _timestamps(df, ["lastModifiedDateUTC", "createdDate"])
    df = _upper(df, ["productName", "onlineTitle", "vendorName", "brandName", "strainType",
                     "strain", "internalName", "masterCategory", "category"])
    df = _replace(df, {c: clean_text(F.col(c)) for c in _text_columns(df)
                       if not c.endswith("_json")})
    return _finish(ids_to_string(df), locations, ["productId", "sku"])


def stock_lab_results(labs: DataFrame, locations: DataFrame) -> DataFrame:
    df = conform_schema(labs, "LabResult", include=[
        "packageId", "sampleDate", "testedDate", "productId", "sku", "labResultUnitId",
        "lastModifiedDateUtc"])
    df = _timestamps(df, ["sampleDate", "lastModifiedDateUtc", "testedDate"])
    df = ids_to_string(_upper(df, ["labTest", "labResultUnit"]))
    return _finish(df.withColumnRenamed("value", "labvalue"), locations, ["lastModifiedDateUtc"])


def stock_by_room(rooms: DataFrame, locations: DataFrame) -> DataFrame:
    df = conform_schema(rooms, "InventoryRoomQuantity",
                        include=["packageId", "productId", "sku", "lastModifiedDateUtc"])
    df = ids_to_string(_upper(_timestamps(df, ["lastModifiedDateUtc"]), ["room"]))
    return _finish(df, locations, ["lastModifiedDateUtc"])


def stock_summary(inventory: DataFrame, locations: DataFrame) -> DataFrame:
    df = conform_schema(inventory, "ReportingInventoryItem", ignore=[
        "tags", "description", "lineage", "labResults", "roomQuantities"])
    df = df.drop("sampleDate", "testedDate", "labTestStatus", "alternateName")
    df = _timestamps(df, ["packagedDate", "manufacturingDate", "lastModifiedDateUtc",
                          "expirationDate"])
    df = _upper(df, ["productName", "category", "quantityUnits", "strain", "strainType", "vendor",
                     "brandName", "masterCategory"])
    return _finish(ids_to_string(df), locations, ["lastModifiedDateUtc"])


def stock_snapshot(snapshot: DataFrame, locations: DataFrame) -> DataFrame:
    df = conform_schema(snapshot, "InventorySnapshot")
    df = _upper(_timestamps(df, ["snapshotDate"]), ["product", "room", "vendor", "unit"])
    df = _replace(df, {"packageId": F.col("packageId").cast("string"),
                       "batchId": F.col("batchId").cast("string")})
    return _finish(df, locations, ["snapshotDate"])


def brand_index(brands: DataFrame, locations: DataFrame) -> DataFrame:
    df = conform_schema(brands, "Brand")
    return _finish(ids_to_string(_upper(df, ["brandName"])), locations, ["brandId"])


def category_index(categories: DataFrame, locations: DataFrame) -> DataFrame:
    df = conform_schema(categories, "ProductCategory")
    df = ids_to_string(_upper(df, ["productCategoryName", "masterCategory"]))
    df = _replace(df, {c: blank_to_null(F.col(c)) for c in _text_columns(df)})
    df = (df.withColumnRenamed("productCategoryId", "categoryId")
          .withColumnRenamed("productCategoryName", "category"))
    return _finish(df, locations, ["categoryId"])
