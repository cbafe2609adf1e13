"""What to write: pure DataFrame selections that need no target system."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import floor_to
from ..operators.joins import only_listed, only_new
from ..operators.ordered import number_all_rows


def new_rows(df: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not stored yet."""
    return only_new(df, existing, keys)


def newer_rows(df: DataFrame, existing: DataFrame, keys: list[str], ts: str, *,
               include_unseen: bool = True) -> DataFrame:
    """Distinct rows newer than the stored maximum of their key.

    ``include_unseen=False`` also leaves out keys that are not stored at all,
    as a comparison with their missing maximum would.
    """
    stored = existing.groupBy(*[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)]).agg(
        F.max(ts).alias("__stored"))
    rows, same = df.distinct(), F.lit(True)
    for i, key in enumerate(keys):
        same = same & rows[key].eqNullSafe(F.col(f"__{i}"))
    newer = F.col(ts) > F.col("__stored")
    if include_unseen:
        newer = newer | F.col("__stored").isNull()
    return rows.join(stored, same, "left").where(newer).select(*df.columns)


def with_batch_ids(df: DataFrame, ts: str, order_by: list[str], batch_id: str = "batchid",
                   batch_name: str | None = "batchname") -> DataFrame:
    """Rows without a batch id get their time as a number (seconds of a timestamp, days of a date) plus the
    row's number among all rows in ``order_by``; the name becomes the same number.

    The same rows get the same ids at every run and partitioning.
    """
    kind = df.schema[ts].dataType.typeName()
    start = {"date": F.datediff(F.col(ts), F.lit("1970-01-01").cast("date")),
             "timestamp": F.unix_timestamp(ts)}.get(kind, F.col(ts).cast("long"))
    numbered = number_all_rows(df, order_by, "__row")
    made, missing = start.cast("long") + F.col("__row"), F.col(batch_id).isNull()
    filled = {batch_id: F.when(missing, made.cast(df.schema[batch_id].dataType)).otherwise(F.col(batch_id))}
    if batch_name:
        filled[batch_name] = F.when(missing, made.cast(df.schema[batch_name].dataType)).otherwise(F.col(batch_name))
    return numbered.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def new_members(df: DataFrame, existing: DataFrame, key: str | list[str], as_of: Column
                ) -> DataFrame:
    """Unseen dimension members with the day they were added."""
    keys = [key] if isinstance(key, str) else key
    return only_new(df, existing, keys).withColumn("date_added", F.to_date(as_of))


def merged(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Target with all rows of the updated keys replaced by the batch."""
    return only_new(target, updates, keys).unionByName(updates)


def updated_from(target: DataFrame, source: DataFrame, key: str | list[str],
                 columns: list[str], *, mark: str | None = None) -> DataFrame:
    """Target with ``columns`` overwritten where the source knows the key.

    Also a NULL in the source overwrites. ``mark`` adds a column that says
    whether any value changed. The source has one row per key.
    """
    keys = [key] if isinstance(key, str) else key
    side = source.select(*keys, F.struct(*columns).alias("__new"))
    out = target.join(side, keys, "left")
    changed = F.col("__new").isNotNull() & ~F.struct(*columns).eqNullSafe(F.col("__new"))
    picked = [F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c)
              if c in columns else F.col(c) for c in target.columns]
    return out.select(*picked, *([changed.alias(mark)] if mark else []))


def active_rows(df: DataFrame, active: DataFrame, org: str) -> DataFrame:
    return only_listed(df, active, [org])


def snapshot_bin(ts: Column, minutes: int = 30) -> Column:
    """Snapshot label: time floored to the half hour."""
    return floor_to(ts, minutes)


def replaced(target: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """Target with the partitions the batch has rows for replaced by the batch."""
    return only_new(target, batch, [column]).unionByName(batch)
