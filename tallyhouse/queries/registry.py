"""Query registry and the SQL the checks share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, reliable_checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _nudge(n: int) -> float:
    return 0.0137 * 10.0 ** -n


def query(sql: str | None, *, digits: dict[str, int] | None = None):
    """Register a query under its function name.

    ``digits`` rounds floating columns on both sides: sums of doubles differ in
    the last bits with the order of addition. A hundredth of the last digit is
    added first, so that a mean that lies exactly half-way (as a sum of cents by
    eight can) is no toss-up. Adding zero turns -0.0 into 0.0.
    """
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(configure(spark), sf_dir)
            return df.withColumns({c: F.round(F.col(c) + F.lit(_nudge(n)), n) + F.lit(0.0)
                                   for c, n in (digits or {}).items()})

        run.__name__, run.__doc__, run.__module__ = fn.__name__, fn.__doc__, fn.__module__
        if fn.__name__ in QUERIES:
            raise ValueError(f"query {fn.__name__} is registered twice")
        QUERIES[fn.__name__] = run
        if sql is not None:
            text = sql.strip()
            if digits:
                swaps = ", ".join(f'round("{c}" + {_nudge(n)!r}, {n}) + 0.0 AS "{c}"'
                              for c, n in digits.items())
                text = f"SELECT * REPLACE ({swaps}) FROM ({text})"
            ORACLE[fn.__name__] = text
        return run

    return register


def digits(n: int, *columns: str) -> dict[str, int]:
    return dict.fromkeys(columns, n)


def new_path(spark: SparkSession) -> str:
    """Where a query writes a table of its own: a fresh folder on the shared storage."""
    return f"{reliable_checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"


# The day all reports are made for.
AS_OF = "2001-08-02 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"


def at(text: str):
    return F.lit(text).cast("timestamp")


# Common table expressions that mirror the star adapter.
STORES = """
stores AS (
  SELECT n_nationkey, r_name AS org, n_name AS store, 'org-' || r_regionkey AS org_uuid,
         'store-' || n_nationkey AS store_id
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
CUST = STORES + """,
cust AS (
  SELECT org_uuid, org, store_id, store, CAST(c_custkey AS VARCHAR) AS customer_id,
         '555' || CAST(CASE WHEN c_custkey % 9 = 0 THEN c_custkey // 81 ELSE c_custkey END
                       AS VARCHAR) AS phone,
         CASE WHEN c_custkey % 4 <> 0 THEN 'u' || c_custkey || '@example.com' END AS email,
         c_name AS full_name, c_mktsegment AS user_type, substr(c_mktsegment, 1, 1) AS gender,
         c_acctbal AS balance
  FROM customer JOIN stores ON c_nationkey = n_nationkey)"""
ORDS = CUST + """,
ords AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, c.*,
         o_orderdate + to_seconds(o_orderkey * 7919 % 43200 + 28800) AS order_time_utc,
         o_orderdate + to_seconds(o_orderkey * 7919 % 43200 + 28800) AS order_time_local,
         o_totalprice AS order_tot, o_orderstatus AS status,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Delivery' WHEN '5-LOW' THEN 'Other'
              ELSE 'Retail' END AS order_type,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'web' WHEN '2-HIGH' THEN 'Walk-In'
              WHEN '3-MEDIUM' THEN 'app' WHEN '5-LOW' THEN 'Unknown' END AS order_source
  FROM orders JOIN cust c ON c.customer_id = CAST(o_custkey AS VARCHAR))"""
LINES = """
lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
         l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
           AS order_line_id,
         CAST(l_partkey AS VARCHAR) AS product_id, 'SKU' || l_partkey AS product_sku,
         p_name AS product_name, p_brand AS brand_name, p_type AS raw_category_name,
         l_quantity AS product_qty, l_extendedprice AS item_list_price,
         -l_extendedprice * l_discount AS item_discount,
         l_extendedprice * (1 - l_discount) AS item_subtotal,
         l_extendedprice * (1 - l_discount) * l_tax AS item_tax,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS item_total,
         CAST(l_suppkey AS VARCHAR) AS sold_by_id, l_returnflag = 'R' AS is_returned,
         CASE p_type WHEN 'ECONOMY' THEN 'EDIBLES' WHEN 'SMALL' THEN 'VAPES'
              WHEN 'MEDIUM' THEN 'FLOWER' WHEN 'PROMO' THEN 'PREROLLS'
              WHEN 'STANDARD' THEN 'EXTRACTS' WHEN 'LARGE' THEN 'DRINKS' END AS category3
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
POP = ORDS + "," + LINES + """,
pop AS (SELECT * FROM lines JOIN ords USING (order_id))"""
TOTALS = ORDS + """,
totals AS (
  SELECT o.*, s.* EXCLUDE (k)
  FROM ords o JOIN (
    SELECT CAST(l_orderkey AS VARCHAR) AS k, sum(l_extendedprice) AS order_subtot,
           -sum(l_extendedprice * l_discount) AS order_disc,
           CAST(min(l_suppkey) AS VARCHAR) AS sold_by_id
    FROM lineitem GROUP BY 1) s ON o.order_id = s.k)"""
