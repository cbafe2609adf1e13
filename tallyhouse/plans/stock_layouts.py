"""The latest stock snapshots of all register systems in one layout, from a table of mappings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.reshape import stack_snapshots

# The common layout, and for each system the columns that have other names there. The register whose payloads this
# library reads is called `register`.
STOCK_COLUMNS = {
    "snapshot_utc": "timestamp", "org_uuid": "string", "store_uuid": "string", "facility": "string", "room_id": "string",
    "product_id": "string", "sku": "string", "product_name": "string", "brand_id": "string", "brand": "string",
    "room_name": "string", "units_in_stock": "double", "image": "string", "unit_price": "double",
    "unit_of_measure": "string", "cost_per_unit": "double", "raw_category_name": "string", "raw_product_class": "string"}
STOCK_RENAMED = {
    "blaze": {"room_id": "inventoryId", "product_id": "id", "product_name": "name", "brand_id": "brandId",
              "room_name": "inventory_room", "units_in_stock": "quantity", "unit_price": "unitPrice",
              "unit_of_measure": "unitType", "raw_category_name": "category", "raw_product_class": "flowerType"},
    "treez": {"product_name": "name", "brand_id": "brand", "room_name": "inventory_room", "units_in_stock": "room_quantity",
              "image": "primary_image", "unit_price": "price_sell", "unit_of_measure": "uom",
              "raw_category_name": "category_type", "raw_product_class": "classification"},
    "webjoint": {"product_name": "name", "brand_id": "brand_name", "brand": "brand_name", "units_in_stock": "room_quantity",
                 "raw_category_name": "category_name", "raw_product_class": "lineage"},
    "register": {"units_in_stock": "room_quantity"}}
STOCK_SYSTEMS = ["blaze", "treez", "webjoint", "register", "flowhub", "akerna", "greenbits", "lightspeed", "meadow",
                 "posabit", "proteus", "growflow"]
STOCK_WITHOUT_COST = ["treez", "akerna", "greenbits", "proteus", "growflow"]


def stock_mapping() -> list[tuple[str, str, str | None, str]]:
    """The table: system, output column, source column (None where the system has none), type."""
    return [(system, out, None if out == "cost_per_unit" and system in STOCK_WITHOUT_COST
             else STOCK_RENAMED.get(system, {}).get(out, out), kind)
            for system in STOCK_SYSTEMS for out, kind in STOCK_COLUMNS.items()]


def stacked_stock(landing: dict[str, DataFrame], mapping: list[tuple[str, str, str | None, str]] | None = None) -> DataFrame:
    """``pos`` and the common columns of every landed system's newest snapshot, as one plan.

    Each system's newest ``snapshot_utc`` is a scalar subquery, so a landing table partitioned by it is pruned to one
    partition; only the mapped columns are read. Systems that did not land are left out; an unknown system or a missing source
    column is an error.
    """
    mapping = stock_mapping() if mapping is None else mapping
    unknown = set(landing) - {system for system, *_ in mapping}
    if unknown:
        raise ValueError(f"no layout for {', '.join(sorted(unknown))}")
    sources = {}
    for system, rows in landing.items():
        own = {out: (src, kind) for s, out, src, kind in mapping if s == system}
        missing = sorted({src for src, _ in own.values() if src is not None} - set(rows.columns))
        if missing:
            raise ValueError(f"{system}: columns not found: {', '.join(missing)}")
        sources[system] = (rows, {out: (F.lit(None) if src is None else F.col(src)).cast(kind) for out, (src, kind) in own.items()})
    return stack_snapshots(sources, ts="snapshot_utc").select("pos", *dict.fromkeys(out for _, out, _, _ in mapping))
