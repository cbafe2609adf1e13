"""Raw register payloads: JSON text to nested rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import pos_schema


def read_pos_json(spark: SparkSession, path: str, schema_name: str, *,
                  multiline: bool = False) -> DataFrame:
    """Read payload files, one object or one array of objects per line (or file).

    Files carry ``org`` and ``store`` as fields or as partition folders. Text
    that is neither is left out; ``rejected_pos_json`` returns it.
    """
    lines, folders = _payload_text(spark, path, multiline)
    schema = pos_schema(schema_name)
    for name in ("org", "store"):
        if name not in folders:
            schema = schema.add(name, T.StringType())
    rows = lines.select(*folders, F.explode(F.from_json("value", T.ArrayType(schema))).alias("__r"))
    names = [c for c in schema.names if c not in ("org", "store")]
    return rows.select(*[f"__r.{c}" for c in names], *[
        F.col(c if c in folders else f"__r.{c}") for c in ("org", "store")])


def rejected_pos_json(spark: SparkSession, path: str, schema_name: str, *,
                      multiline: bool = False) -> DataFrame:
    """What ``read_pos_json`` leaves out: text, file and the partition folders."""
    lines, folders = _payload_text(spark, path, multiline)
    return lines.where(_parsed("value", schema_name).isNull()).select(
        *folders, F.col("value").alias("text"), F.col("_metadata.file_path").alias("file"))


def _payload_text(spark: SparkSession, path: str, multiline: bool) -> tuple[DataFrame, list[str]]:
    """Lines (or whole files) that are not blank, and the names of the partition folders."""
    folders = [c for c in spark.read.text(path).columns if c in ("org", "store")]
    # A declared schema keeps folder values such as 007 as text.
    kinds = ", ".join(f"{c} string" for c in ("value", *folders))
    lines = spark.read.schema(kinds).option("wholetext", multiline).text(path)
    return lines.where(F.trim("value") != ""), folders


def parse_pos_json(df: DataFrame, column: str, schema_name: str,
                   keep: tuple[str, ...] = ("org", "store")) -> DataFrame:
    """Text column holding a JSON array of objects to one row per object.

    Text that is no such array gives no rows; ``rejected_payloads`` returns it.
    """
    return (df.select(*keep, F.explode(_parsed(column, schema_name)).alias("__r"))
            .select("__r.*", *keep))


def rejected_payloads(df: DataFrame, column: str, schema_name: str) -> DataFrame:
    """The rows of ``df`` whose text is missing or no JSON array of objects."""
    return df.where(_parsed(column, schema_name).isNull())


def _parsed(column: str, schema_name: str) -> Column:
    return F.from_json(column, T.ArrayType(pos_schema(schema_name)))
