"""Reading append-only landing tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import latest_row


def read_latest(df: DataFrame, keys: list[str], order_col: str, columns: list[str] | None = None,
                where: Column | None = None) -> DataFrame:
    """Newest row per key; columns and filter apply first, so they reach the scan."""
    if where is not None:
        df = df.where(where)
    if columns is not None:
        df = df.select(*dict.fromkeys([*keys, *columns, order_col]))
    return latest_row(df, keys, [order_col])


def read_latest_snapshot(df: DataFrame, ts_col: str) -> DataFrame:
    """Rows of the newest snapshot in the table.

    The maximum is a scalar subquery: it is known before the scan starts, which
    then skips files and row groups (and partitions, when ``ts_col`` is one).
    """
    return df.where(F.col(ts_col) == df.select(F.max(ts_col)).scalar())
