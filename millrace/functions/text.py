"""Text and number expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace.schemas import (
    DIRECT_DOWNLOAD,
    GREETING,
    IN_STOCK_PHRASE,
    NA_TEXT,
    PERSON_MESSAGE,
    RATING_WORDS,
    SHARE_LINK_ID,
    WHITESPACE,
)

# a decimal number with optional sign and exponent, or an infinity
NUMBER = r"(?i)^\s*[+-]?(?:(?:\d++\.?\d*+|\.\d++)(?:e[+-]?\d++)?|inf|infinity)\s*$"


def strip_ws(c: Column | str) -> Column:
    """Remove leading and trailing white space of any kind, NBSP included.

    ``trim`` removes blanks only. A character-set trim keeps this out of the regex engine.
    """
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    """NULL or the empty string. Text of blanks only does not count."""
    return c.isNull() | (c == "")


def na_to_null(c: Column, words=NA_TEXT) -> Column:
    """Text that stands for a missing value becomes NULL."""
    return F.when(c.isin(*words), F.lit(None)).otherwise(c)


def coerce_numeric(c: Column, missing: str = "null") -> Column:
    """Text to double; whatever is no number is missing.

    Spark's own cast also takes Java literals such as ``1.5d``, so the text is matched first. A number
    too large for a double is missing too; only text that says infinity is infinite.
    ``missing="null"`` gives NULL, ``missing="keep"`` gives NaN, which sorts above every number.
    """
    text = c.cast("string")
    number = F.when(text.rlike(NUMBER), text.try_cast("double"))
    overflown = (F.abs(number) == float("inf")) & ~F.lower(text).contains("inf")
    return missing_number(F.when(~overflown, number), missing)


def missing_number(c: Column, missing: str = "null") -> Column:
    """Put NULL and NaN of a double column into one form."""
    if missing == "null":
        return F.nanvl(c, F.lit(None).cast("double"))
    if missing == "keep":
        return F.coalesce(c, F.lit(float("nan")))
    raise ValueError(f"missing must be 'null' or 'keep', not {missing!r}")


def parse_money(c: Column) -> Column:
    """Keep digits and points, then read a double. Sign and thousands comma are lost."""
    return F.regexp_replace(c, r"[^\d.]", "").try_cast("double")


def rating_from_word(c: Column) -> Column:
    """``One`` .. ``Five`` to 1 .. 5, any other word to 0."""
    pairs = [F.lit(x) for pair in RATING_WORDS.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), c), F.lit(0))


def in_stock(c: Column) -> Column:
    """Does the text hold the in-stock phrase, in any case? NULL counts as no."""
    return F.coalesce(F.lower(c).contains(IN_STOCK_PHRASE), F.lit(False))


def has_suffix(c: Column, suffix: str) -> Column:
    """Case-insensitive suffix test."""
    return F.lower(c).endswith(suffix.lower())


def direct_download_url(c: Column) -> Column:
    """Share links become direct-download links, other URLs stay."""
    share_id = F.regexp_extract(c, SHARE_LINK_ID, 1)
    return F.when(share_id != "", F.concat(F.lit(DIRECT_DOWNLOAD), share_id)).otherwise(c)


def person_message(name: Column, craft: Column, greeting: str = GREETING) -> Column:
    return F.format_string(PERSON_MESSAGE, name, craft, F.lit(greeting))
