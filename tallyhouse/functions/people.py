"""Customer attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import squish


def clean_gender(col: Column) -> Column:
    """Any spelling or code of a gender to M, F, U or NULL.

    Digit codes count wherever they stand, 0 before 1 before 2. Text starting
    with U is unknown whatever follows it; unknown and unrecognised are NULL.
    """
    text = F.upper(col.cast("string"))
    return (F.when(text.isNull() | (text == "") | text.startswith("U"), F.lit(None).cast("string"))
            .when(text.contains("0"), "M")
            .when(text.contains("1"), "F")
            .when(text.contains("2"), "U")
            .when(text.isin("F", "FEMALE"), "F")
            .when(text.isin("M", "MALE"), "M"))


def gender_or_unknown(col: Column) -> Column:
    return F.coalesce(clean_gender(col), F.lit("U"))


def gender_initial(col: Column) -> Column:
    """Leading M or F, otherwise U."""
    return F.coalesce(F.when(col.rlike("^[MF]"), F.substring(col, 1, 1)), F.lit("U"))


def full_name(first: Column, last: Column) -> Column:
    """First and last name; a missing part is left out."""
    return F.concat_ws(" ", first, last)


def is_test_name(first: Column) -> Column:
    return F.upper(first).contains("TEST")


def numeric_name_to_null(first: Column) -> Column:
    """A first name that is only digits is not a name."""
    return F.when(~first.rlike("^[0-9]+$"), first)


def long_address(street1: Column, street2: Column, city: Column, state: Column,
                 zipcode: Column) -> Column:
    """One-line address, NULL without a zip code."""
    return F.when(zipcode.isNotNull(), squish(F.concat_ws(" ", street1, street2, city, state, zipcode)))
