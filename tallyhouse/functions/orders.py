"""Order, line and product attributes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order sources that mean the customer was in the shop.
IN_SHOP_SOURCES = ["walk in", "in_store", "in-store", "ios-instore", "walk_in", "walk-in",
                   "unknown", ""]


def is_pickup(order_type: Column, order_source: Column) -> Column:
    """Ordered ahead and collected: not a delivery, not an in-shop source."""
    not_pickup = ((F.coalesce(order_type, F.lit("")) == "Delivery")
                  | order_source.isNull() | F.lower(order_source).isin(IN_SHOP_SOURCES))
    return ~not_pickup


def channel(order_type: Column, pickup: Column, preorder_amount: Column | None = None) -> Column:
    """How the order reached the shop. Without preorder data no row is PREORDER."""
    retail = order_type == "Retail"
    known = preorder_amount.isNotNull() if preorder_amount is not None else F.lit(False)
    return (F.when(~pickup & retail, "WALK-IN")
            .when(pickup & retail & known, "PREORDER")
            .when(pickup & retail, "PREORDER - NO ECOMM")
            .when(order_type == "Delivery", "DELIVERY")
            .otherwise("OTHER"))


def order_key(*parts: Column) -> Column:
    """Stable id of an order: the same (org, store, order) gives the same key."""
    marked = [F.coalesce(p.cast("string"), F.lit("\u0000")) for p in parts]
    return F.sha2(F.concat_ws("\u001f", *marked), 256)


def strain_class(product_name: Column) -> Column:
    """Plant class named in the product title, hybrid when none is."""
    return (F.when(product_name.contains("SATIVA"), "sativa")
            .when(product_name.contains("INDICA"), "indica")
            .when(product_name.contains("CBD"), "cbd")
            .otherwise("hybrid"))


# Word in the campaign title -> reporting group, first match wins.
CAMPAIGN_GROUPS = [
    ("Promote", "Promoted Categories"),
    ("Lost", "Lost Customer Outreach"),
    ("New Customers", "New Engagements"),
    ("Custom", "Custom Segment"),
]


def campaign_group(title: Column, source: Column,
                   groups: list[tuple[str, str]] = CAMPAIGN_GROUPS,
                   default: str = "Other Key Opportunity") -> Column:
    label = F.coalesce(title, source)
    chosen = [F.when(label.contains(word), F.lit(name)) for word, name in groups]
    return F.coalesce(*chosen, F.lit(default))


def room_id_label(room_id: Column, room_name: Column, units: Column) -> Column:
    """Missing room: NO STOCK when nothing is there, otherwise UNKNOWN."""
    return (F.when(room_id.isNull() & room_name.isNull() & (units == 0), "NO STOCK")
            .when(room_id.isNull(), "UNKNOWN")
            .otherwise(room_id))


def room_name_label(labelled_room_id: Column, room_name: Column) -> Column:
    return (F.when(labelled_room_id == "NO STOCK", "NO STOCK")
            .when(room_name.isNull(), "UNKNOWN")
            .otherwise(room_name))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
