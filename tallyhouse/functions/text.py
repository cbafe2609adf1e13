"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squish(col: Column) -> Column:
    """Collapse runs of whitespace, also non-ASCII, to one blank and trim both ends."""
    return F.trim(F.regexp_replace(col, r"[\s\p{Z}]+", " "))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def clean_text(col: Column, case: str | None = None) -> Column:
    """Squish, optionally change case; ``N/A`` and blank become NULL.

    Only an exact upper-case ``N/A`` counts. It is looked for after the case
    change, so a lower-cased column keeps ``n/a``, and before the last squish,
    so a padded `` N/A `` survives in a column whose case is left alone.
    """
    if case == "upper":
        col = squish(F.upper(col))
    elif case == "lower":
        col = squish(F.lower(col))
    return blank_to_null(squish(F.nullif(col, F.lit("N/A"))))


def clean_body(col: Column) -> Column:
    """Message body on one line."""
    return squish(F.regexp_replace(col, "\n", " "))


def list_to_csv(col: Column, separator: str = ",") -> Column:
    """Array of text to one separated string; an empty or NULL array to NULL."""
    return F.when(F.size(col) > 0, F.array_join(col, separator))


def csv_or_null(col: Column) -> Column:
    """Array to ``a, b`` text with a blank after each comma, empty text to NULL."""
    return blank_to_null(F.array_join(col, ", "))


def list_to_json(col: Column) -> Column:
    """Array column to JSON text; NULL stays NULL."""
    return F.to_json(col)


def alnum_words(col: Column) -> Column:
    """Keep letters and digits only, single-blank separated, lower case."""
    return F.lower(squish(F.regexp_replace(col, r"[^\p{L}\p{N}]", " ")))


# The reply words that change a subscription.
STOP_WORDS = ["stop", "unsubscribe", "cancel", "remove", "end", "quit", "stoo", "fuck off"]
START_WORDS = ["start", "yes", "unstop"]


def _any_word(col: Column, words: list[str], whole_word: bool) -> Column:
    alternatives = "|".join(words)
    return col.rlike(rf"\b(?:{alternatives})\b" if whole_word else alternatives)


def opt_out_flag(body: Column, whole_word: bool = False) -> Column:
    """Does a reply ask to stop? Matches inside words unless ``whole_word``."""
    return _any_word(alnum_words(body), STOP_WORDS, whole_word)


def opt_in_flag(body: Column, whole_word: bool = False) -> Column:
    """Does a reply ask to start again? ``unstop`` counts for both flags."""
    return _any_word(alnum_words(body), START_WORDS, whole_word)


def brand_from_title(product: Column) -> Column:
    """Text before the first `` - `` of a product title, without punctuation."""
    head = F.when(F.instr(product, " - ") > 0, F.substring_index(product, " - ", 1))
    # With no separator the whole title is used.  The separator's own first
    # blank belongs to the slice, and squishing removes it again.
    return squish(F.regexp_replace(F.coalesce(head, product), r"\p{P}", ""))
