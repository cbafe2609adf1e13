"""Run-log summaries, with events as the log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import logs
from ..sources import star
from .registry import query

_LEVELS = {"view": "SUCCESS", "click": "SUCCESS", "error": "ERROR", "signup": "WARNING",
           "purchase": "INFO"}
_STEPS = ["GET", "EXT", "BLD"]


def run_log(spark, sf_dir) -> DataFrame:
    """Event type is the level; user and event number give step, data and place."""
    level = F.lit(None).cast("string")
    for kind, name in _LEVELS.items():
        level = F.when(F.col("event_type") == kind, name).otherwise(level)
    n = F.col("event_id") % 3
    table = F.col("user_id") % 2
    step = F.get(F.array(*[F.lit(s) for s in _STEPS]), n.cast("int"))
    data = F.when(n == 2, F.concat(F.lit("t_"), table.cast("string"), F.when(
        F.col("event_id") % 2 == 0, " (Orders)").otherwise(""))).otherwise(
        F.concat(F.lit("/e"), table.cast("string"), F.when(
            F.col("event_id") % 2 == 0, "...2024-01-01").otherwise("")))
    return star.load(spark, sf_dir, "events").select(
        level.alias("level"), F.concat(F.lit("pos"), (F.col("user_id") % 3).cast("string"))
        .alias("pos"), step.alias("step"), data.alias("data"),
        F.concat(F.lit("o"), (F.col("user_id") % 5).cast("string"), F.lit(".s.x"))
        .alias("location"), F.col("ts"))


_LOG = """log AS (
  SELECT CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING'
           WHEN 'purchase' THEN 'INFO' ELSE 'SUCCESS' END AS level,
         'pos' || user_id % 3 AS pos, ['GET', 'EXT', 'BLD'][event_id % 3 + 1] AS step,
         CASE WHEN event_id % 3 = 2 THEN 't_' ELSE '/e' END || user_id % 2 AS data,
         event_id % 2 = 0 AS remark, 'o' || user_id % 5 AS org FROM events)"""


@query(f"WITH {_LOG}" + """
SELECT l AS level, p.pos, count(*) FILTER (WHERE step = 'GET') AS "Get",
  count(*) FILTER (WHERE step = 'EXT') AS "Extract", count(*) FILTER (WHERE step = 'BLD') AS "Build"
FROM (SELECT level[1] || lower(level[2:]) AS l, pos, step FROM log) p GROUP BY ALL
""")
def log_event_counts(spark, sf_dir) -> DataFrame:
    """Events per level and system, one column per step."""
    return logs.event_counts(run_log(spark, sf_dir))


@query(f"WITH {_LOG}" + """
SELECT 'Build' AS process, pos, data, count(*) FILTER (WHERE level = 'SUCCESS') AS "Success",
  count(*) FILTER (WHERE level = 'ERROR') AS "Error",
  count(*) FILTER (WHERE level = 'WARNING') AS "Warning"
FROM log WHERE step = 'BLD' AND level <> 'INFO' GROUP BY ALL
""")
def log_build_summary(spark, sf_dir) -> DataFrame:
    """Build events per table, one column per level."""
    return logs.log_summary(run_log(spark, sf_dir), "BLD", with_info=False)


@query(f"WITH {_LOG}" + """
SELECT 'Get' AS process, pos, data || CASE WHEN remark THEN '...2024-01-01' ELSE '' END AS data,
  count(*) FILTER (WHERE level = 'SUCCESS') AS "Success",
  count(*) FILTER (WHERE level = 'ERROR') AS "Error",
  count(*) FILTER (WHERE level = 'WARNING') AS "Warning",
  count(*) FILTER (WHERE level = 'INFO') AS "Info"
FROM log WHERE step = 'GET' GROUP BY ALL
""")
def log_get_summary(spark, sf_dir) -> DataFrame:
    """Get events per endpoint, one column per level."""
    return logs.log_summary(run_log(spark, sf_dir), "GET")


@query(f"WITH {_LOG}" + """
SELECT pos, org, 's.x' AS store, '/e' || n AS endpoint, 'x' || n AS extracted, 't_' || n AS db_table,
  g AS "Get", e AS "Extract", coalesce(b, 0) AS "Build"
FROM (SELECT pos, org, CAST(right(data, 1) AS VARCHAR) AS n,
        min((level = 'SUCCESS')::INT) FILTER (WHERE step = 'GET') AS g,
        min((level = 'SUCCESS')::INT) FILTER (WHERE step = 'EXT') AS e,
        min((level = 'SUCCESS')::INT) FILTER (WHERE step = 'BLD' AND NOT remark) AS b
      FROM log WHERE level IN ('SUCCESS', 'ERROR') AND NOT (step = 'BLD' AND remark) GROUP BY ALL)
WHERE g = 0 OR e = 0 OR b = 0
""")
def log_fail_summary(spark, sf_dir) -> DataFrame:
    """Tables per location with a failed step."""
    log = run_log(spark, sf_dir)
    names = log.select(F.regexp_extract("data", r"(\d)", 1).alias("n")).distinct()
    io_map = names.select(F.concat(F.lit("/e"), "n").alias("endpoint"),
                          F.concat(F.lit("x"), "n").alias("extracted"),
                          F.concat(F.lit("t_"), "n").alias("db_table"))
    return logs.fail_summary(log, io_map)
