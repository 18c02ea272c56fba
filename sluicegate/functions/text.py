"""Text and number helpers whose rules differ from Spark's defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters a trim removes, every one up to and including the space.
_TRIMMED = "".join(map(chr, range(0x21)))
_NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def strip(text: Column) -> Column:
    """Trim spaces, tabs, line ends and other control characters on both sides."""
    return F.btrim(text, F.lit(_TRIMMED))


def is_blank(text: Column) -> Column:
    return text.isNull() | (strip(text) == "")


def to_whole_number(text: Column) -> Column:
    """Number text as BIGINT, fractions cut; NULL for anything else, such as ``12d``, which a cast would take.

    Whole numbers are read as such first, so digits beyond a double's precision survive.
    """
    number = F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))
    return F.when(strip(text).rlike(_NUMBER), number)


def is_number_or_absent(text: Column) -> Column:
    """True for NULL, empty text and the text ``null``, which all mean 'not given', and for numbers."""
    return text.isNull() | (text == "") | (F.lower(text) == "null") | to_whole_number(text).isNotNull()
