"""Summaries of a run log kept as a table.

Columns: level, pos, step (GET, EXT, BLD), data, location (``org.store``),
ts. One row per logged event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Log codes and their report names.
LEVELS = {"SUCCESS": "Success", "ERROR": "Error", "WARNING": "Warning", "INFO": "Info"}
STEPS = {"GET": "Get", "EXT": "Extract", "BLD": "Build"}


def event_counts(log: DataFrame) -> DataFrame:
    """Events per level and system, one column per step; every level has a row."""
    per_pos = log.groupBy("pos").agg(*[
        F.struct(F.lit(label).alias("level"), *[
            F.count_if((F.col("level") == level) & (F.col("step") == step)).alias(name)
            for step, name in STEPS.items()]).alias(label)
        for level, label in LEVELS.items()])
    return (per_pos.select("pos", F.explode(F.array(*LEVELS.values())).alias("n"))
            .select("pos", "n.*"))


def log_summary(log: DataFrame, step: str, *, with_info: bool = True) -> DataFrame:
    """Events of one step per system and data set, one column per level.

    For the build step a remark in brackets after the data name is cut off.
    """
    rows = log.where(F.col("step") == step)
    if step == "BLD":
        rows = rows.withColumn("data", F.regexp_replace("data", r" \(.+\)", ""))
    levels = {c: n for c, n in LEVELS.items() if with_info or c != "INFO"}
    rows = rows.where(F.col("level").isin(list(levels)))
    return rows.groupBy(F.lit(STEPS[step]).alias("process"), "pos", "data").agg(*[
        F.count_if(F.col("level") == code).alias(name) for code, name in levels.items()])


def fail_summary(log: DataFrame, io_map: DataFrame) -> DataFrame:
    """Tables per location whose get, extract or build did not succeed.

    ``io_map`` holds (endpoint, extracted, db_table). Get and extract are logged
    under the endpoint, build under the table. 1 is success, 0 an error. A build
    that never ran shows as 0, but is no failure by itself: the row is listed
    only when an earlier step failed.
    """
    data = F.when(F.col("data").startswith("/"),
                  F.regexp_replace("data", r"...20.+$", "")).otherwise(F.col("data"))
    parts = F.split("location", r"\.", 2)
    ended = (log.where(F.col("level").isin("SUCCESS", "ERROR"))
             .select("pos", "level", "step", data.alias("data"), parts[0].alias("org"),
                     F.get(parts, F.lit(1)).alias("store")))
    names = (io_map.withColumn("data", F.explode(F.array_distinct(F.array("endpoint",
                                                                          "db_table")))))
    found = ended.join(names, "data")
    ok = F.col("level") == "SUCCESS"
    steps = found.groupBy("pos", "org", "store", "endpoint", "extracted", "db_table").agg(*[
        F.min(F.when(F.col("step") == code, ok.cast("int"))).alias(name)
        for code, name in STEPS.items()])
    failed = (F.col("Get") == 0) | (F.col("Extract") == 0) | (F.col("Build") == 0)
    return (steps.where(F.coalesce(failed, F.lit(False)))
            .withColumn("Build", F.coalesce("Build", F.lit(0))))
