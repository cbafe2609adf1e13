"""The incremental writers behind a stream, one micro-batch at a time.

``ingest_new`` looks up the stored keys, so a micro-batch that is retried after a failure finds its own rows stored and
appends nothing. ``ingest_newer`` keeps the newest time of every key in the stream's state instead and never looks at
the stored rows again: the table's newest times enter once, as a first input of the stream. Each micro-batch leaves a
mark before and after its append; one that was begun but not finished is compared with the stored rows when it is repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.ordered import latest_row
from ..sinks import tables

_SEED = "__seed"


def ingest_new(stream: DataFrame, path: str, keys: list[str], checkpoint: str, *, order_by: list[str] = [],
               partition_by: list[str] = [], available_now: bool = False) -> StreamingQuery:
    """Append each micro-batch's unseen keys; of a key's rows in the batch the last by ``order_by`` (then by the
    remaining columns) stands."""
    def write(batch: DataFrame, _epoch: int) -> None:
        tables.append_new(latest_row(batch, keys, order_by), path, keys, partition_by)

    return _start(stream, write, checkpoint, available_now)


def ingest_newer(stream: DataFrame, path: str, keys: list[str], ts: str, checkpoint: str, *, include_unseen: bool = True,
                 partition_by: list[str] = [], available_now: bool = False) -> StreamingQuery:
    """Append each micro-batch's distinct rows that are newer than anything known of their key before the batch.

    ``include_unseen=False`` leaves keys out that the table did not hold when the stream began. A row without a time is never newer;
    it is appended only for a key that nothing is known of, and does not make the key known. A key's rows of one
    micro-batch are held together.
    """
    spark = stream.sparkSession
    seed = f"{checkpoint}/seed"
    if not tables._exists(spark, f"{seed}/_SUCCESS"):
        _newest(spark, stream, path, keys, ts, partition_by).write.mode("overwrite").parquet(seed)
    kinds = T.StructType([stream.schema[c] for c in [*dict.fromkeys([*keys, ts])]])
    known = spark.readStream.schema(kinds).parquet(seed).withColumn(_SEED, F.lit(True))
    both = stream.withColumn(_SEED, F.lit(False)).unionByName(known, allowMissingColumns=True)
    names, out = stream.columns, T.StructType(stream.schema.fields)

    def newer(_key: tuple[Any, ...], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        newest = pd.Timestamp(state.get[0]) if state.exists else None
        live = []
        for part in parts:
            stored = part[_SEED].to_numpy(bool)
            if stored.any():  # the stored maximum, in the first micro-batch only
                newest = part.loc[stored, ts].max()
            live.append(part.loc[~stored, names])
        rows = pd.concat(live)
        keep = rows[ts] > newest if newest is not None else pd.Series(include_unseen, index=rows.index)
        latest = rows.loc[keep, ts].max()
        latest = newest if pd.isna(latest) else latest
        if latest is not None and not pd.isna(latest):
            state.update((latest.to_pydatetime(),))
        if keep.any():
            yield rows[keep].drop_duplicates()

    fresh = both.groupBy(*keys).applyInPandasWithState(newer, out, T.StructType([T.StructField("newest", T.TimestampType())]),
                                                       "append", GroupStateTimeout.NoTimeout)

    def write(batch: DataFrame, epoch: int) -> None:
        begun, ended = f"{checkpoint}/appends/{epoch}.begun", f"{checkpoint}/appends/{epoch}.ended"
        if tables._exists(spark, ended):
            return
        rows = batch
        if tables._exists(spark, begun) and tables._exists(spark, path):
            # Begun before and perhaps written: what is stored already stays out.
            stored = tables._typed(tables.read_table(spark, path), batch, *tables.partition_columns(spark, path))
            rows = tables._having(batch, stored, batch.columns, "left_anti")
        _mark(spark, begun)
        if not rows.isEmpty():
            tables.append_rows(rows, path, tables.partition_columns(spark, path) if tables._exists(spark, path) else partition_by)
        _mark(spark, ended)

    return _start(fresh, write, checkpoint, available_now)


def _newest(spark: SparkSession, stream: DataFrame, path: str, keys: list[str], ts: str, partition_by: list[str]) -> DataFrame:
    """One row per stored key with its newest time; none if there is no table yet."""
    kinds = T.StructType([stream.schema[c] for c in [*dict.fromkeys([*keys, ts])]])
    if not tables._exists(spark, path):
        return spark.createDataFrame([], kinds)
    stored = tables.read_table(spark, path).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kinds])
    return stored.groupBy(*keys).agg(F.max(ts).alias(ts)).where(F.col(ts).isNotNull())


def _mark(spark: SparkSession, path: str) -> None:
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(location, True).close()


def _start(stream, write, checkpoint, available_now) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
