"""Stacking, pivoting and unpivoting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack(*frames: DataFrame) -> DataFrame:
    """Union all by column name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stack_distinct(*frames: DataFrame) -> DataFrame:
    return stack(*frames).distinct()


def minus(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of the left side that the right side does not have."""
    return left.subtract(right)


def pivot_levels(df: DataFrame, keys: list[str], levels_col: str, levels: list[str],
                 value: Column, prefix: str = "", fill=None) -> DataFrame:
    """One column per listed level, present whether or not the data has it.

    The level list is given, so no extra job looks for the levels, and the
    conditional aggregates combine on the map side.
    """
    cells = []
    for level in levels:
        cell = F.max(F.when(F.col(levels_col) == level, value))
        if fill is not None:
            cell = F.coalesce(cell, F.lit(fill))
        cells.append(cell.alias(f"{prefix}{level}"))
    return df.groupBy(*keys).agg(*cells)


def unpivot_columns(df: DataFrame, keys: list[str], columns: list[str], name: str,
                    value: str) -> DataFrame:
    return df.unpivot(keys, columns, name, value)


def map_columns(df: DataFrame, mapping: dict[str, str | Column]) -> DataFrame:
    """Select output columns from old names or expressions."""
    return df.select(*[(F.col(src) if isinstance(src, str) else src).alias(out)
                       for out, src in mapping.items()])


def stack_snapshots(sources: dict[str, tuple[DataFrame, dict[str, str | Column]]], *,
                    ts: str, label: str = "pos") -> DataFrame:
    """Latest snapshot of several systems in one layout.

    ``sources`` maps system name -> (landing table, column mapping); the ``ts``
    column keeps its name in every system.
    """
    parts = []
    for system, (df, mapping) in sources.items():
        latest = df.where(F.col(ts) == df.select(F.max(ts)).scalar())
        parts.append(map_columns(latest, mapping).withColumn(label, F.lit(system)))
    return stack(*parts)


def checked_in_customers(*systems: DataFrame) -> DataFrame:
    """Customers checked in now, from all systems, in one spelling."""
    return (stack(*systems).withColumn("full_name", F.upper("full_name"))
            .withColumn("email", F.lower("email")))
