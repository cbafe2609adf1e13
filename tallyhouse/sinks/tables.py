"""Parquet tables that are appended to and replaced by partition."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import written as _detached
from . import incremental as inc

log = logging.getLogger(__name__)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(files.exists(location))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A partitioned table with its partition values as they were written, as text (``007`` stays ``007``)."""
    setting = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(setting, before)


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns a stored table is partitioned by, in the order of its folders."""
    jvm = spark.sparkContext._jvm
    at, names = jvm.org.apache.hadoop.fs.Path(path), []
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    utils = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    while True:
        inner = next((f.getPath() for f in files.listStatus(at) if f.isDirectory() and "=" in f.getPath().getName()), None)
        if inner is None:
            return names
        names.append(utils.unescapePathName(inner.getName().split("=")[0]))
        at = inner


def _typed(stored: DataFrame, like: DataFrame, *columns: str) -> DataFrame:
    """Partition values, read as text, in the types of the frame that is compared with them."""
    return stored.withColumns({c: F.col(c).cast(like.schema[c].dataType) for c in columns if c in like.columns})


def _layout(spark: SparkSession, path: str, partition_by: list[str]) -> list[str]:
    """The partition columns of an append: those of the stored table, which the caller may leave out."""
    stored = partition_columns(spark, path)
    if partition_by and partition_by != stored:
        raise ValueError(f"the table is partitioned by {stored}, not {partition_by}")
    return stored


def _as_stored(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Folders cannot tell an empty text from NULL: such partition values are NULL from the start."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in partition_by
                           if df.schema[c].dataType.typeName() == "string"})


def _having(df: DataFrame, listed: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Semi or anti join in which NULL equals NULL."""
    names = {k: f"__{i}" for i, k in enumerate(keys)}
    listed = listed.select(*[F.col(k).alias(n) for k, n in names.items()]).distinct()
    same = F.lit(True)
    for k, n in names.items():
        same = same & df[k].eqNullSafe(F.col(n))
    return df.join(listed, same, how)


def _write(df: DataFrame, path: str, mode: str, partition_by: list[str]) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_rows(df: DataFrame, path: str, partition_by: list[str] = []) -> None:
    _write(df, path, "append", partition_by)


def append_new(df: DataFrame, path: str, keys: list[str], partition_by: list[str] = []) -> None:
    """Append rows whose key is not in the table; logs how many were dropped.

    NULL counts as a key value. Rows that share a new key inside the batch are all appended. Stored partition
    values are compared in the batch's types, as they were written.
    """
    spark = df.sparkSession
    if not _exists(spark, path):
        return _write(_as_stored(df, partition_by), path, "append", partition_by)
    partition_by = _layout(spark, path, partition_by)
    df = _as_stored(df, partition_by)
    # Both counts come out of the job that writes: an append does not touch the files that it reads.
    given, kept = Observation("given"), Observation("kept")
    n = F.count(F.lit(1)).alias("n")
    stored = _typed(read_table(spark, path), df, *partition_by)
    fresh = inc.new_rows(df.observe(given, n), stored, keys).observe(kept, n)
    _write(fresh, path, "append", partition_by)
    log.info("dropped %d rows already stored", given.get["n"] - kept.get["n"])


def append_newer(df: DataFrame, path: str, keys: list[str], ts: str, *, include_unseen: bool = True,
                 partition_by: list[str] = [], batch_id: str | None = None, batch_name: str | None = None) -> None:
    """Append distinct rows newer than the newest stored row of their key.

    With ``batch_id`` the appended rows that have none get one, see ``incremental.with_batch_ids``; their order is
    that of ``keys``. Stored partition values are compared in the batch's types, as they were written.
    """
    spark = df.sparkSession
    if _exists(spark, path):
        partition_by = _layout(spark, path, partition_by)
        df = _as_stored(df, partition_by)
        df = inc.newer_rows(df, _typed(read_table(spark, path), df, *partition_by), keys, ts, include_unseen=include_unseen)
    else:
        df = _as_stored(df, partition_by).distinct()
    if batch_id:
        df = inc.with_batch_ids(df, ts, keys, batch_id, batch_name)
    _write(df, path, "append", partition_by)


def append_dimension(df: DataFrame, path: str, key: str | list[str], as_of: Column) -> None:
    spark = df.sparkSession
    if _exists(spark, path):
        df = inc.new_members(df, spark.read.parquet(path), key, as_of)
    else:
        df = df.withColumn("date_added", F.to_date(as_of))
    _write(df, path, "append", [])


def replace_partition(df: DataFrame, path: str, column: str) -> None:
    """Replace the partitions the frame has rows for; others stay untouched."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).parquet(path))


def upsert_by_key(updates: DataFrame, path: str, keys: list[str], partition: str) -> None:
    """Replace all rows of the batch's keys.

    Only partitions that hold such a key, or get a new row, are rewritten.
    """
    spark = updates.sparkSession
    if not _exists(spark, path):
        return replace_partition(updates, path, partition)
    target = _typed(read_table(spark, path), updates, partition)
    touched = (_having(target, updates, keys, "left_semi").select(partition)
               .union(updates.select(partition)).distinct())
    affected = _having(target, touched, [partition], "left_semi")
    result = _detached(inc.merged(affected, updates, keys))
    # A partition whose last row moved elsewhere has no row to overwrite it, so
    # it is emptied by name.
    gone = _detached(_having(touched, result, [partition], "left_anti").select(F.col(partition).cast("string")))
    gone = [r[0] for r in gone.toLocalIterator()]
    replace_partition(result, path, partition)
    for value in gone:
        _drop_partition(spark, path, partition, value)


def _drop_partition(spark: SparkSession, path: str, column: str, value: str | None) -> None:
    """Delete a partition's folder, named and escaped as Spark does it; a folder that is not there is an error."""
    jvm = spark.sparkContext._jvm
    name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(column, value)
    location = jvm.org.apache.hadoop.fs.Path(path, name)
    files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(location):
        raise FileNotFoundError(f"no partition folder {name} in {path}")
    files.delete(location, True)


def update_from(source: DataFrame, path: str, key: str | list[str], columns: list[str],
                partition: str) -> None:
    """Overwrite columns of stored rows from a source; rewrites changed partitions only."""
    spark = source.sparkSession
    marked = inc.updated_from(read_table(spark, path), source, key, columns, mark="__changed")
    result = _detached(_having(marked, marked.where("__changed"), [partition], "left_semi").drop("__changed"))
    replace_partition(result, path, partition)


def drop_inactive(active: DataFrame, path: str, org: str) -> None:
    """Delete the partitions of organisations that are not active."""
    spark = active.sparkSession
    stored = read_table(spark, path).select(org).distinct()
    listed = active.select(F.col(org).cast("string"))
    for row in _having(stored, listed, [org], "left_anti").toLocalIterator():
        _drop_partition(spark, path, org, row[0])
