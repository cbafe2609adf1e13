"""Brand names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import squish


def tidy_brand(brand: Column) -> Column:
    """Upper, squish, drop one leading single letter, pack sizes and quotes."""
    name = F.regexp_replace(squish(F.upper(brand)), "^[A-Z] ", "")
    # `NAME (1/4)...` keeps the text before the last such size, when there is
    # text before it; the extraction of an empty name gives NULL.
    size = r" \(1/[248]\)"
    name = (F.when(name.rlike(size),
                   F.nullif(F.regexp_extract(name, rf"(.+){size}", 1), F.lit("")))
            .otherwise(name))
    return F.regexp_replace(name, "[\"'.]", "")


def apply_brand_rules(brand: Column, patterns: list[tuple[str, str]]) -> Column:
    """Sequential (regex -> name) rules, each seeing the previous output.

    The rules are one array that is folded over the name, so all patterns are
    read by the same regex dialect. A value left starting with ``$`` is HOUSE.
    """
    if not patterns:
        settled = brand
    else:
        rules = F.array(*[F.struct(F.lit(pattern).alias("pattern"), F.lit(name).alias("name"))
                          for pattern, name in patterns])
        settled = F.aggregate(rules, brand, lambda seen, rule: F.when(
            F.rlike(seen, rule["pattern"]), rule["name"]).otherwise(seen))
    return F.when(settled.startswith("$"), "HOUSE").otherwise(settled)
