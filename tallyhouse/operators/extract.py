"""Nested payloads to relational tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LOCATION
from .joins import first_row_per_key
from .ordered import latest_row


def extract_transactions(df: DataFrame) -> dict[str, DataFrame]:
    """Six tables from nested orders; children carry ``transactionId``, org, store.

    An order without children of a kind just has no rows there.
    """
    parent = ["transactionId", *LOCATION]

    def children(source: DataFrame, column: str, keep: list[str]) -> DataFrame:
        rows = source.select(*keep, F.explode(column).alias("__c"))
        inner = rows.schema["__c"].dataType.names
        return rows.select(*keep, *[F.col(f"__c.{c}").alias(c) for c in inner if c not in keep])

    items = children(df, "items", parent)
    discounts = children(df, "discounts", parent).drop("transactionItemId")
    return {
        "order_summary": df.drop("items", "discounts", "taxSummary"),
        "order_tax": children(df, "taxSummary", parent),
        # Discount 0 stands for "no named discount".
        "order_discount": discounts.withColumn("discountId",
                                               F.nullif(F.col("discountId"), F.lit(0))),
        "order_items": items.drop("discounts", "taxes"),
        "order_items_tax": children(items, "taxes", parent),
        "order_items_discount": children(items, "discounts", parent),
    }


def validate_batch(df: DataFrame) -> DataFrame:
    """Number of child rows of each kind per store; a zero marks a suspect batch."""
    def inside(column: str) -> Column:
        per_item = F.transform("items", lambda i: F.coalesce(F.size(i[column]), F.lit(0)))
        return F.aggregate(per_item, F.lit(0), lambda a, n: a + n)

    def total(n: Column) -> Column:
        return F.sum(F.greatest(F.coalesce(n, F.lit(0)), F.lit(0)))

    return df.groupBy(*LOCATION).agg(
        total(F.size("items")).alias("order_items"),
        total(inside("discounts")).alias("order_items_discount"),
        total(inside("taxes")).alias("order_items_tax"),
        total(F.size("discounts")).alias("order_discount"),
        total(F.size("taxSummary")).alias("order_tax"))


def extract_inventory(df: DataFrame) -> dict[str, DataFrame]:
    """Stock summary, lab results and room quantities with their package's keys."""
    package = [*LOCATION, "productId", "sku", "packageId", "lastModifiedDateUtc"]
    labs = (df.select(*package, "sampleDate", "testedDate", F.explode("labResults").alias("__c"))
            .select(*package, "sampleDate", "testedDate", "__c.*"))
    rooms = df.select(*package, F.explode("roomQuantities").alias("__c")).select(*package, "__c.*")
    return {"stock_summary": df.drop("labResults", "roomQuantities", "tags", "description"),
            "stock_lab_results": labs, "stock_by_room": rooms}


def extract_flat(df: DataFrame, org: str | None = None, store: str | None = None) -> DataFrame:
    """Payload without children: add the location when the rows lack it."""
    for name, value in (("org", org), ("store", store)):
        if value is not None:
            df = df.withColumn(name, F.lit(value))
    return df


def unnest_wide(df: DataFrame, column: str, *, separator: str = "_",
                prefix: str | None = None) -> DataFrame:
    """Struct column to one column per leaf, names joined by ``separator``.

    ``prefix=""`` leaves the top-level field names bare. Arrays and maps cannot
    become columns and are kept as JSON text.
    """
    leaves: list[Column] = []

    def walk(value: Column, kind: T.DataType, name: str) -> None:
        if isinstance(kind, T.StructType):
            for field in kind.fields:
                walk(value[field.name], field.dataType,
                     f"{name}{separator}{field.name}" if name else field.name)
        elif isinstance(kind, (T.ArrayType, T.MapType)):
            leaves.append(F.to_json(value).alias(name))
        else:
            leaves.append(value.alias(name))

    walk(F.col(column), df.schema[column].dataType, column if prefix is None else prefix)
    return df.select(*[c for c in df.columns if c != column], *leaves)


def parse_response_log(df: DataFrame, column: str, schema: T.StructType, **kwargs) -> DataFrame:
    """Rows whose text is a JSON object, parsed and spread into columns."""
    rows = df.where(F.substring(column, 1, 1) == "{")
    return unnest_wide(rows.withColumn(column, F.from_json(column, schema)), column, **kwargs)


def hoist(df: DataFrame, column: str, paths: dict[str, str]) -> DataFrame:
    """Pull single fields out of JSON text: new column -> path (``$.title``)."""
    return df.select("*", *[F.get_json_object(column, path).alias(new)
                            for new, path in paths.items()])


# Fields of an address object.
_ADDRESS_TEXT = ["type", "street1", "street2", "city", "state", "zipcode"]
_ADDRESS_DDL = ("array<struct<" + ", ".join(f"{f}: string" for f in _ADDRESS_TEXT)
                + ", primary: boolean>>")


def explode_addresses(df: DataFrame, *, column: str = "addresses",
                      keys: list[str] = ["org", "customer_id"],
                      run_ts: str = "run_date_utc") -> DataFrame:
    """Customer rows with one address: of the newest run, the last by primary flag.

    Customers without an address stay. Among one run's addresses the order is
    other, primary, unmarked, and the last one stands.
    """
    rows = df.select("*", F.explode_outer(F.from_json(
        F.coalesce(column, F.lit("[]")), _ADDRESS_DDL)).alias("__a"))
    rows = rows.select(
        *[c for c in df.columns if c != column], F.col("__a.primary").alias("address_primary"),
        *[F.nullif(F.col(f"__a.{f}"), F.lit("")).alias(f"address_{f}") for f in _ADDRESS_TEXT])
    rest = [c for c in rows.columns if c not in (*keys, run_ts, "address_primary")]
    return first_row_per_key(rows, keys, [
        F.col(run_ts).desc_nulls_last(), F.col("address_primary").desc_nulls_first(),
        *[F.col(c).desc_nulls_last() for c in rest]])


def extract_tags(df: DataFrame, *, keys: list[str] = ["org", "customer_id"], column: str = "tags",
                 run_ts: str = "run_date_utc", keep: tuple[str, ...] = ("shop", "shop_id"),
                 flyer_label: str = "flyer", other_label: str = "regular") -> DataFrame:
    """Per customer the class and reward points its tags speak of.

    Only the newest row counts, and only when it has tags. A customer is of the
    flyer class when one of the first four tags says so; each reward tag gives
    one row with its number.
    """
    newest = latest_row(df, keys, [run_ts]).where(F.col(column).isNotNull())
    tags = F.from_json(column, T.ArrayType(T.StringType()))
    parsed = newest.select(*keys, *keep, tags.alias("__tags"))
    head = F.lower(F.array_join(F.slice("__tags", 1, 4), " ", "NA"))
    group = F.when(F.size("__tags") > 0, F.when(head.contains("flyer"), flyer_label)
                   .otherwise(other_label))
    rewards = F.filter("__tags", lambda t: t.contains("Reward"))
    points = F.transform(rewards, lambda t: F.regexp_replace(t, "[^0-9.]", "").try_cast("double"))
    return parsed.select(*keys, *keep, group.alias("tags"), F.explode_outer(points)
                         .alias("loyalty_pts"))


def nest_json(children: DataFrame, keys: list[str], name: str, order_by: list[str]) -> DataFrame:
    """Child rows to one JSON array per key, in a given order.

    For children that are already apart. While they are still nested in their
    parent, ``array_to_json`` does the same without a shuffle.
    """
    fields = [c for c in children.columns if c not in keys]
    ordered = F.sort_array(F.collect_list(F.struct(*order_by, F.struct(*fields).alias("__row"))))
    return children.groupBy(*keys).agg(
        F.to_json(F.transform(ordered, lambda r: r["__row"])).alias(name))


def array_to_json(column: Column, fields: list[str], ids: tuple[str, ...] = ()) -> Column:
    """Array of structs to JSON text with the given fields; empty gives NULL.

    Fields in ``ids`` become text. NULL fields are left out of their object.
    """
    def row(item: Column) -> Column:
        return F.struct(*[(item[f].cast("string") if f in ids else item[f]).alias(f)
                          for f in fields])

    return F.when(F.size(column) > 0, F.to_json(F.transform(column, row)))
