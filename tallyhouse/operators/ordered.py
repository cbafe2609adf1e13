"""Row-order operators that survive a hot key.

A plain ``Window.partitionBy(customer)`` sorts all rows of one customer in one
task. Here a group is cut into time buckets instead. Each bucket is its own
window partition, and what crosses a bucket edge (the last or next known value,
the number of rows so far) travels as one extra *carry row* per bucket. The
carry rows come from a map-side combined ``groupBy``, so the only unbounded data
that is shuffled is shuffled by (key, bucket).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

_BUCKET = "__bucket"
_REAL = "__is_row"


# A date_trunc unit, a width for number columns, or any non-decreasing function
# of the leading order column.
Bucket = str | int | Callable[[Column], Column]


def _bucket_of(leading: str, bucket: Bucket) -> Column:
    if callable(bucket):
        return bucket(F.col(leading))
    if isinstance(bucket, int):
        return F.floor(F.col(leading) / bucket)
    return F.date_trunc(bucket, F.col(leading))


def fill_ordered(df: DataFrame, keys: list[str], order_by: list[str], fills: dict[str, str], *,
                 direction: str = "down", include_current: bool = True,
                 bucket: Bucket | None = "month") -> DataFrame:
    """Add, per row, the nearest non-NULL value before (or after) it in order.

    ``fills`` maps new column -> source column; every column is filled on its
    own. ``order_by`` starts with the column that is cut into buckets, usually a
    time, followed by the columns that break ties. ``include_current=False``
    looks only at the other rows, which for a time column is ``lag`` (down) or
    ``lead`` (up). ``bucket=None`` uses one window per key.
    """
    if not fills:
        return df
    down = direction == "down"
    time_col = order_by[0]
    in_order = [F.col(c).asc() if down else F.col(c).desc() for c in order_by]
    reach = 0 if include_current else -1

    if bucket is None:
        # NULL times come last in time, hence first when walking backwards.
        lead_in = F.col(time_col).asc_nulls_last() if down else F.col(time_col).desc_nulls_first()
        w = (Window.partitionBy(*keys).orderBy(lead_in, *in_order[1:])
             .rowsBetween(Window.unboundedPreceding, reach))
        return df.select("*", *[F.last(src, ignorenulls=True).over(w).alias(new)
                                for new, src in fills.items()])

    pick = F.max_by if down else F.min_by
    position = F.struct(*order_by)
    edges = (df.withColumn(_BUCKET, _bucket_of(time_col, bucket))
             .groupBy(*keys, _BUCKET)
             .agg(*[pick(F.col(src), F.when(F.col(src).isNotNull(), position)).alias(new)
                    for new, src in fills.items()]))
    across = (Window.partitionBy(*keys)
              .orderBy(F.col(_BUCKET).asc_nulls_last() if down
                       else F.col(_BUCKET).desc_nulls_first())
              .rowsBetween(Window.unboundedPreceding, -1))
    carried = edges.select(*keys, _BUCKET, F.lit(False).alias(_REAL),
                           *[F.last(new, ignorenulls=True).over(across).alias(f"__v_{new}")
                             for new in fills])
    rows = df.select("*", _bucket_of(time_col, bucket).alias(_BUCKET), F.lit(True).alias(_REAL),
                     *[F.col(src).alias(f"__v_{new}") for new, src in fills.items()])
    within = (Window.partitionBy(*keys, _BUCKET).orderBy(F.col(_REAL).asc(), *in_order)
              .rowsBetween(Window.unboundedPreceding, reach))
    return (rows.unionByName(carried, allowMissingColumns=True)
            .select(*df.columns, _REAL,
                    *[F.last(f"__v_{new}", ignorenulls=True).over(within).alias(new)
                      for new in fills])
            .where(_REAL).drop(_REAL))


def fill_both_ways(df: DataFrame, keys: list[str], order_by: list[str], down: dict[str, str], up: dict[str, str], *,
                   bucket: Bucket | None = "month") -> DataFrame:
    """``fill_ordered`` in both directions from one shuffle and one sort, each row's own value included.

    One carry row per bucket, before the bucket's rows, holds what comes into it from either side: the last known values of
    earlier buckets for ``down``, the first of later ones for ``up``. NULL order values come first.
    """
    spread = [F.lit(None).cast("string").alias(_BUCKET)] if bucket is None else [_bucket_of(order_by[0], bucket).alias(_BUCKET)]
    position = F.struct(*order_by)

    def known(src):
        return F.when(F.col(src).isNotNull(), position)

    rows = df.select("*", *spread, F.lit(True).alias(_REAL), *[F.col(src).alias(f"__d_{n}") for n, src in down.items()],
                     *[F.col(src).alias(f"__u_{n}") for n, src in up.items()])
    if bucket is not None:
        edges = df.withColumn(_BUCKET, spread[0]).groupBy(*keys, _BUCKET).agg(
            *[F.max_by(F.col(src), known(src)).alias(f"__d_{n}") for n, src in down.items()],
            *[F.min_by(F.col(src), known(src)).alias(f"__u_{n}") for n, src in up.items()])
        # Few rows: one per key and bucket.
        w = Window.partitionBy(*keys)
        before = w.orderBy(F.col(_BUCKET).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
        after = w.orderBy(F.col(_BUCKET).desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
        carried = edges.select(*keys, _BUCKET, F.lit(False).alias(_REAL),
                               *[F.last(f"__d_{n}", ignorenulls=True).over(before).alias(f"__d_{n}") for n in down],
                               *[F.last(f"__u_{n}", ignorenulls=True).over(after).alias(f"__c_{n}") for n in up])
        rows = rows.unionByName(carried, allowMissingColumns=True)
    else:
        rows = rows.select("*", *[F.lit(None).cast(df.schema[src].dataType).alias(f"__c_{n}") for n, src in up.items()])
    spec = Window.partitionBy(*keys, _BUCKET).orderBy(F.col(_REAL).asc(), *[F.col(c).asc() for c in order_by])
    so_far = spec.rowsBetween(Window.unboundedPreceding, 0)

    def quoted(c):
        return "`" + c.replace("`", "``") + "`"

    # The next known value by offset: a frame that runs to the end would be folded anew for every row.
    over = (f"OVER (PARTITION BY {', '.join(map(quoted, [*keys, _BUCKET]))} "
            f"ORDER BY {', '.join(map(quoted, [_REAL, *order_by]))})")
    filled = rows.select("*", *[F.last(f"__d_{n}", ignorenulls=True).over(so_far).alias(n) for n in down], *[
        F.coalesce(F.col(f"__u_{n}"), F.expr(f"lead({quoted('__u_' + n)}) IGNORE NULLS {over}"),
                   F.last(f"__c_{n}", ignorenulls=True).over(so_far)).alias(n) for n in up])
    return filled.where(_REAL).select(*df.columns, *down, *up)


def number_rows(df: DataFrame, keys: list[str], order_by: list[str], name: str, *,
                bucket: Bucket | None = "month") -> DataFrame:
    """Running number 1, 2, 3 … of each key's rows in order."""
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(F.col(order_by[0]).asc_nulls_last(), *order_by[1:])
        return df.withColumn(name, F.row_number().over(w))
    before = (Window.partitionBy(*keys).orderBy(F.col(_BUCKET).asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (df.withColumn(_BUCKET, _bucket_of(order_by[0], bucket))
               .groupBy(*keys, _BUCKET).agg(F.count(F.lit(1)).alias("__n"))
               .select(*keys, _BUCKET, F.lit(False).alias(_REAL),
                       F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")))
    rows = df.select("*", _bucket_of(order_by[0], bucket).alias(_BUCKET),
                     F.lit(True).alias(_REAL))
    within = (Window.partitionBy(*keys, _BUCKET)
              .orderBy(F.col(_REAL).asc(), *[F.col(c).asc() for c in order_by]))
    # The carry row is number 1 of its bucket, so real rows start at 2.
    number = F.row_number().over(within) - 1 + F.first("__offset", ignorenulls=True).over(within)
    return (rows.unionByName(offsets, allowMissingColumns=True)
            .select(*df.columns, _REAL, number.cast("int").alias(name))
            .where(_REAL).drop(_REAL))


def number_all_rows(df: DataFrame, order_by: list[str], name: str) -> DataFrame:
    """Running number 1, 2, 3 … over the whole frame in order, NULLs first; the columns not named break ties.

    No task sees more than its range: rows are sorted within range partitions and written once with their place in the
    partition, and a prefix sum over one count per partition gives each range its first number. The numbers
    depend on the rows alone, not on how they are cut into ranges.
    """
    order = [F.col(c).asc_nulls_first() for c in [*order_by, *[c for c in df.columns if c not in order_by]]]
    placed = written(df.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("__place", F.monotonically_increasing_id()))
    # The upper bits of the place are the partition, the lower 33 the row in it.
    placed = placed.withColumn("__range", F.shiftright("__place", 33)).withColumn(
        "__place", F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__n")).select(
        "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return placed.join(starts, "__range").select(
        *df.columns, (F.col("__start") + F.col("__place") + 1).alias(name))


def latest_row(df: DataFrame, keys: list[str], order_by: list[str], *,
               oldest: bool = False) -> DataFrame:
    """One row per key: the newest by ``order_by``, remaining columns break ties.

    ``row_number() = 1`` is a group limit to Spark: every map task sends at most
    one row per key into the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    direction = (lambda c: F.col(c).asc_nulls_last()) if oldest else (
        lambda c: F.col(c).desc_nulls_last())
    w = Window.partitionBy(*keys).orderBy(*[direction(c) for c in [*order_by, *rest]])
    return (df.withColumn("__rank", F.row_number().over(w))
            .where(F.col("__rank") == 1).drop("__rank"))


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Join condition on equal keys in which NULL matches NULL."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def keep_at_max(df: DataFrame, keys: list[str], column: str, *, smallest: bool = False) -> DataFrame:
    """All rows whose ``column`` equals its group's maximum; ties all stay."""
    best = (F.min if smallest else F.max)(column).alias("__best")
    top = df.groupBy(*keys).agg(best).select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__best")
    match = df[column] == top["__best"]
    for key in keys:
        match = match & df[key].eqNullSafe(top[f"__k_{key}"])
    return df.join(top, match, "left_semi")


def with_group_stats(df: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """Group aggregates kept on every row, also those a window cannot compute.

    An aggregation combines on the map side and its join can be split by AQE,
    where a window over the same key would sort the whole group in one task.
    """
    renamed = [F.col(k).alias(f"__k_{k}") for k in keys]
    stats = df.groupBy(*keys).agg(*aggregates)
    added = [c for c in stats.columns if c not in keys]
    stats = stats.select(*renamed, *added)
    match = F.lit(True)
    for key in keys:
        match = match & df[key].eqNullSafe(stats[f"__k_{key}"])
    return df.join(stats, match, "left").select(*[df[c] for c in df.columns], *added)


def share_of_total(df: DataFrame, keys: list[str], amount: str, name: str) -> DataFrame:
    """Each row's part of its group's total; a zero total gives NULL."""
    out = with_group_stats(df, keys, F.sum(amount).alias("__total"))
    return out.withColumn(name, F.try_divide(F.col(amount), F.col("__total"))).drop("__total")


def is_first_day(df: DataFrame, keys: list[str], ts: str, name: str) -> DataFrame:
    """True on rows of the day of the group's first row."""
    out = with_group_stats(df, keys, F.min(F.to_date(ts)).alias("__first"))
    return out.withColumn(name, F.to_date(ts) == F.col("__first")).drop("__first")
