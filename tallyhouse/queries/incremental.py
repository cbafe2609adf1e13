"""Landing-table reads and incremental writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks import incremental as inc
from ..sinks import tables
from ..sources import landing, star
from .registry import AS_OF, CUST, at, new_path, query


@query("""
SELECT user_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY ts DESC, value DESC, event_type DESC) AS rn
  FROM events WHERE event_type <> 'error') WHERE rn = 1
""")
def latest_event_per_user(spark, sf_dir) -> DataFrame:
    """Newest row per key of an append-only table."""
    return landing.read_latest(star.load(spark, sf_dir, "events"), ["user_id"], "ts",
                               columns=["user_id", "value", "event_type"],
                               where=F.col("event_type") != "error").select(
        "user_id", "ts", "event_type", "value")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem)
""")
def latest_snapshot_rows(spark, sf_dir) -> DataFrame:
    """Rows of the table's newest snapshot."""
    return landing.read_latest_snapshot(star.load(spark, sf_dir, "lineitem"), "l_shipdate").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
""")
def append_new_lines(spark, sf_dir) -> DataFrame:
    """Lines whose order is not stored yet (finished orders are)."""
    stored = star.load(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("l_orderkey"))
    return inc.new_rows(star.load(spark, sf_dir, "lineitem"), stored, ["l_orderkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


_NEWER = """
SELECT DISTINCT e.event_id, e.user_id, e.ts FROM events e LEFT JOIN (
  SELECT user_id, max(ts) AS stored FROM events WHERE event_type = 'signup' AND value > 20
  GROUP BY 1) s USING (user_id) WHERE e.ts > s.stored
"""


def _newer(spark, sf_dir, include_unseen):
    events = star.load(spark, sf_dir, "events")
    stored = events.where((F.col("event_type") == "signup") & (F.col("value") > 20))
    return inc.newer_rows(events.select("event_id", "user_id", "ts"), stored, ["user_id"], "ts",
                          include_unseen=include_unseen)


@query(_NEWER + " OR s.stored IS NULL")
def append_newer_events(spark, sf_dir) -> DataFrame:
    """Rows newer than the stored maximum of their key, and unseen keys."""
    return _newer(spark, sf_dir, True)


@query(_NEWER)
def append_newer_known_keys(spark, sf_dir) -> DataFrame:
    """The same without keys that are not stored."""
    return _newer(spark, sf_dir, False)


# Organisations whose names look like numbers, or are missing.
_ORG = """CASE WHEN c_nationkey = 3 THEN NULL WHEN c_nationkey = 4 THEN 'a/b=c'
               ELSE substr('000', 1, c_nationkey % 3) || c_nationkey END"""


@query(f"""
SELECT o_orderkey, {_ORG} AS org, o_totalprice * CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS total
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def append_new_read_back(spark, sf_dir) -> DataFrame:
    """A partitioned table after a first write of the finished orders and an append of all, with changed totals."""
    orders = star.load(spark, sf_dir, "orders").join(
        star.load(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.expr(_ORG).alias("org"), F.col("o_totalprice").alias("total"), "o_orderstatus")
    path = new_path(spark)
    tables.append_new(orders.where("o_orderstatus = 'F'").drop("o_orderstatus"), path, ["org", "o_orderkey"], ["org"])
    tables.append_new(orders.withColumn("total", F.col("total") * 2).drop("o_orderstatus"), path, ["org", "o_orderkey"])
    return tables.read_table(spark, path).select("o_orderkey", "org", "total")


@query("""
WITH s AS (SELECT DISTINCT l_orderkey AS packageid, l_partkey AS productid, 'SKU' || l_suppkey AS sku,
             CAST(l_shipdate AS TIMESTAMP) AS snapshotdate, CASE WHEN l_returnflag <> 'N' THEN l_linenumber END AS batchid,
             CASE WHEN l_returnflag <> 'N' THEN 'b' || l_linenumber END AS batchname, l_shipmode AS mode
           FROM (SELECT *, CASE WHEN l_linestatus = 'F' THEN 'old' ELSE 'new' END AS l_shipmode FROM lineitem)),
first AS (SELECT * FROM s WHERE mode = 'old'),
top AS (SELECT productid, sku, packageid, max(snapshotdate) AS latest FROM first GROUP BY ALL),
second AS (SELECT s.* FROM s LEFT JOIN top USING (productid, sku, packageid) WHERE latest IS NULL OR snapshotdate > latest),
runs AS (SELECT 1 AS run, * FROM first UNION ALL SELECT 2, * FROM second),
numbered AS (SELECT *, CAST(epoch(snapshotdate) AS BIGINT) + row_number() OVER (PARTITION BY run ORDER BY packageid, productid,
  sku, snapshotdate, batchid NULLS FIRST, batchname NULLS FIRST, mode) AS made FROM runs)
SELECT packageid, productid, sku, snapshotdate, coalesce(batchid, made) AS batchid,
       coalesce(batchname, made::VARCHAR) AS batchname, mode FROM numbered
""")
def append_newer_batches_read_back(spark, sf_dir) -> DataFrame:
    """Stock snapshots after two appends of what is newer than stored; rows without a batch get a numbered one."""
    rows = star.load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("packageid"), F.col("l_partkey").alias("productid"),
        F.concat(F.lit("SKU"), "l_suppkey").alias("sku"), F.col("l_shipdate").cast("timestamp").alias("snapshotdate"),
        F.when(F.col("l_returnflag") != "N", F.col("l_linenumber").cast("long")).alias("batchid"),
        F.when(F.col("l_returnflag") != "N", F.concat(F.lit("b"), "l_linenumber")).alias("batchname"),
        F.when(F.col("l_linestatus") == "F", "old").otherwise("new").alias("mode"))
    path, keys = new_path(spark), ["packageid", "productid", "sku"]
    for batch in (rows.where("mode = 'old'"), rows):
        tables.append_newer(batch, path, keys, "snapshotdate", partition_by=["mode"], batch_id="batchid",
                            batch_name="batchname")
    return tables.read_table(spark, path).select(*keys, "snapshotdate", "batchid", "batchname", "mode")


@query("""
SELECT DISTINCT p_brand, p_type, DATE '2001-08-02' AS date_added FROM part
WHERE (p_brand, p_type) NOT IN (SELECT (p_brand, p_type) FROM part WHERE p_size > 45)
""")
def append_new_brands(spark, sf_dir) -> DataFrame:
    """Unseen dimension members with the day they were added."""
    part = star.load(spark, sf_dir, "part")
    known = part.where("p_size > 45").select("p_brand", "p_type")
    return inc.new_members(part.select("p_brand", "p_type").distinct(), known,
                           ["p_brand", "p_type"], at(AS_OF))


def _repriced(spark, sf_dir):
    """A later delivery of finished orders, with a changed total."""
    orders = star.load(spark, sf_dir, "orders")
    return orders, orders.where("o_orderstatus = 'F'").withColumn("o_totalprice",
                                                                  F.col("o_totalprice") * 2)


_BATCH = """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice * 2 FROM orders WHERE o_orderstatus = 'F'
"""


@query(_BATCH)
def replace_partition_rows(spark, sf_dir) -> DataFrame:
    """Table after the batch's partitions replaced the stored ones."""
    target, batch = _repriced(spark, sf_dir)
    return inc.replaced(target, batch, "o_orderstatus").select("o_orderkey", "o_orderstatus",
                                                               "o_totalprice")


@query(_BATCH)
def upsert_orders(spark, sf_dir) -> DataFrame:
    """Table after all rows of the batch's keys were replaced."""
    target, batch = _repriced(spark, sf_dir)
    return inc.merged(target, batch, ["o_orderkey"]).select("o_orderkey", "o_orderstatus",
                                                            "o_totalprice")


@query("""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey,
       CASE WHEN p.p_partkey IS NULL THEN l.l_returnflag ELSE p.p_type END AS l_returnflag,
       CASE WHEN p.p_partkey IS NULL THEN l.l_linestatus ELSE p.note END AS l_linestatus,
       p.p_partkey IS NOT NULL AND (l.l_returnflag IS DISTINCT FROM p.p_type
         OR l.l_linestatus IS DISTINCT FROM p.note) AS changed
FROM lineitem l LEFT JOIN (
  SELECT p_partkey, CASE WHEN p_size > 25 THEN p_type ELSE 'R' END AS p_type,
         CASE WHEN p_type = 'PROMO' THEN NULL ELSE 'F' END AS note
  FROM part WHERE p_type <> 'LARGE') p ON l.l_partkey = p.p_partkey
""")
def update_lines_from_products(spark, sf_dir) -> DataFrame:
    """Columns overwritten from a source, NULL included, with a change mark."""
    source = star.load(spark, sf_dir, "part").where("p_type <> 'LARGE'").select(
        F.col("p_partkey").alias("l_partkey"),
        F.when(F.col("p_size") > 25, F.col("p_type")).otherwise("R").alias("l_returnflag"),
        F.when(F.col("p_type") != "PROMO", "F").alias("l_linestatus"))
    out = inc.updated_from(star.load(spark, sf_dir, "lineitem"), source, "l_partkey",
                           ["l_returnflag", "l_linestatus"], mark="changed")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus",
                      "changed")


@query("WITH" + CUST + """
SELECT customer_id, org, balance FROM cust
WHERE org IN (SELECT r_name FROM region WHERE r_name LIKE 'A%')
""")
def drop_inactive_orgs(spark, sf_dir) -> DataFrame:
    """Rows of active organisations."""
    active = star.load(spark, sf_dir, "region").where("r_name LIKE 'A%'").select(
        F.col("r_name").alias("org"))
    return inc.active_rows(star.customers(spark, sf_dir), active, "org").select(
        "customer_id", "org", "balance")


@query("""
SELECT time_bucket(INTERVAL '30 minutes', ts) AS snapshot_utc, event_type, count(*) AS n
FROM events GROUP BY ALL
""")
def snapshot_bins(spark, sf_dir) -> DataFrame:
    """Events per half hour."""
    return (star.load(spark, sf_dir, "events")
            .groupBy(inc.snapshot_bin(F.col("ts")).alias("snapshot_utc"), "event_type")
            .agg(F.count(F.lit(1)).alias("n")))
