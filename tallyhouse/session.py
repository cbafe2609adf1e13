"""Session settings every operator in this package relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# AQE does three jobs here: it splits hot join partitions, merges small
# shuffle partitions, and turns a sort-merge join into a broadcast join only
# after it has seen the real size of the small side.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "tallyhouse", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def reliable_checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder, taken from the session.

    A cluster names the folder in ``spark.checkpoint.dir``. A local master with
    nothing configured gets a temporary folder; any other master without the
    setting has none.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            return None
        folder = tempfile.mkdtemp(prefix="tallyhouse-ckpt-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


# What an operator does with an intermediate result it reads more than once.
Stage = Callable[[DataFrame], DataFrame]


def lazily(df: DataFrame) -> DataFrame:
    """Leave the plan as it is; Spark computes the intermediate per use."""
    return df


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store the frame once on shared storage and go on from there.

    For compact intermediates of large inputs: every later use reads the stored
    rows instead of the inputs, and a lost executor loses none of them. Without
    a shared folder the frame stays lazy.
    """
    if reliable_checkpoint_dir(df.sparkSession) is None:
        return df
    return df.checkpoint(eager=True)


def cut_lineage_columns(df: DataFrame) -> DataFrame:
    """``cut_lineage`` as a Parquet table: for frames of many rows whose uses read a few columns each.

    A checkpoint stores whole rows uncompressed, and every use reads all of them. The table stays in the shared folder.
    """
    folder = reliable_checkpoint_dir(df.sparkSession)
    if folder is None:
        return df
    path = f"{folder}/stored/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame) -> DataFrame:
    """``cut_lineage`` that fails without a shared folder: for frames whose values a second run would not repeat, or that read
    what is about to be overwritten."""
    if reliable_checkpoint_dir(df.sparkSession) is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return df.checkpoint(eager=True)
