"""Payloads landed as variants: the text is parsed once, every later read takes only the fields it asks for.

``land_payloads`` writes the objects of payload text as a variant column in Parquet. Spark shreds the common fields into
columns of the file, so ``read_landed`` and everything built on it reads the asked paths alone (see ``ReadSchema`` in the plan). Nothing is lost:
fields that no schema declares stay in the variant, ``undeclared_fields`` lists them, and text that is no payload is landed as it is.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LOCATION, pos_schema

PAYLOAD, REJECTED = "payload", "rejected"


def land_payloads(df: DataFrame, column: str, path: str, keep: list[str] = LOCATION, mode: str = "errorifexists") -> None:
    """Write ``keep``, ``payload`` and ``rejected``: one row per object of a JSON object or array of objects.

    Text that is neither gives one row with a NULL payload and the text in ``rejected``; so does an array with an element that is no
    object, as a whole. NULL and empty text and an empty array give no row.
    """
    # Each step is named once and read by name: no filter on the text, which Spark would push below whatever builds the text and
    # so build it twice. A cast to the wrong shape is NULL; the cast to a struct without fields only asks for objects.
    parsed = df.select(*keep, F.col(column).alias(REJECTED), F.try_parse_json(column).alias("__v"))
    alone = F.try_variant_get("__v", "$", "struct<>").isNotNull()
    objects = F.forall(F.try_variant_get("__v", "$", "array<struct<>>"), lambda v: v.isNotNull())
    listed = parsed.select(*keep, REJECTED, F.when(objects, F.try_variant_get("__v", "$", "array<variant>")).when(
        alone, F.array("__v")).alias("__list"))
    blank = F.coalesce(F.trim(REJECTED) == "", F.lit(True))
    none = F.lit(None).cast("variant")
    rows = listed.select(*keep, REJECTED, F.col("__list").isNull().alias("__bad"), F.explode(
        F.when(blank, F.array().cast("array<variant>")).otherwise(F.coalesce("__list", F.array(none)))).alias(PAYLOAD))
    rows.select(*keep, PAYLOAD, F.when(F.col("__bad"), F.col(REJECTED)).alias(REJECTED)).write.mode(mode).parquet(path)


def field(path: str, kind: str, column: str = PAYLOAD) -> Column:
    """One field of a variant in a type; NULL where it is missing or has another shape."""
    return F.try_variant_get(column, path, kind)


def read_landed(spark: SparkSession, path: str, schema_name: str, keep: list[str] = LOCATION) -> DataFrame:
    """The landed objects with the columns of a declared schema."""
    rows = spark.read.parquet(path).where(F.col(REJECTED).isNull())
    return rows.select(*[field(f"$['{f.name}']", f.dataType.simpleString()).alias(f.name)
                         for f in pos_schema(schema_name).fields], *keep)


def rejected_landed(spark: SparkSession, path: str) -> DataFrame:
    """The text that is no payload."""
    rows = spark.read.parquet(path)
    return rows.where(F.col(REJECTED).isNotNull()).drop(PAYLOAD)


def _shape(text: str) -> dict[str, str]:
    """Paths and types of a variant schema such as ``OBJECT<a: BIGINT, b: ARRAY<OBJECT<c: STRING>>>``."""
    out: dict[str, str] = {}
    position = 0

    def value(path: str) -> None:
        nonlocal position
        if text.startswith(("OBJECT<", "ARRAY<"), position):
            listed = text[position] == "A"
            position = text.index("<", position) + 1
            out[path] = "ARRAY" if listed else "OBJECT"
            if listed:
                value(path + "[]")
            while not listed and text[position] != ">":
                if text[position] == "`":  # names with unusual letters are quoted, a quote in them is doubled
                    quoted = re.compile("`((?:[^`]|``)*)`: ").match(text, position)
                    name, position = quoted[1].replace("``", "`"), quoted.end()
                else:
                    end = text.index(": ", position)
                    name, position = text[position:end], end + 2
                value(f"{path}.{name}" if path else name)
                if text.startswith(", ", position):
                    position += 2
            position += 1
        else:
            found = re.compile(r"\w+(\([^)]*\))?").match(text, position)
            out[path], position = found[0], found.end()

    value("")
    return out


def undeclared_fields(spark: SparkSession, path: str, schema_name: str) -> DataFrame:
    """``field, type``: paths (``items[].flavour``) that payloads hold and the declared schema does not.

    One schema per task is merged by Spark; a field of several types has type VARIANT.
    """
    found = spark.read.parquet(path).agg(F.schema_of_variant_agg(PAYLOAD)).first()[0]
    declared: set[str] = set()

    def walk(kind, at: str) -> None:
        declared.add(at)
        if kind.typeName() == "struct":
            for f in kind.fields:
                walk(f.dataType, f"{at}.{f.name}" if at else f.name)
        elif kind.typeName() == "array":
            walk(kind.elementType, at + "[]")

    walk(pos_schema(schema_name), "")
    fields = _shape(found) if found else {}
    # A field inside an undeclared one is not listed again.
    extra = {p: t for p, t in fields.items() if p not in declared and (
        re.sub(r"(\[\]|\.[^.\[\]]*)$", "", p) if "." in p or "[]" in p else "") in declared}
    return spark.createDataFrame(sorted(extra.items()), "field string, type string")
