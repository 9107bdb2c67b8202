"""Conversions from text that give NULL instead of an error on bad input."""

from pyspark.sql import functions as F

from tabq.functions.predicates import as_column, is_empty, text

DATE_TIME = r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{2}:\d{2})$"  # day/month/year hour:minute
WHOLE_NUMBER = r"^\s*([+-]?[0-9]+)(\.[0-9]*)?\s*$"


def to_number(c, dtype="double"):
    return as_column(c).try_cast(dtype)


def to_whole(c):
    """Text to int, decimals cut off; anything else is NULL.

    The pattern keeps bad text away from the cast, which would raise and catch an error per value.
    """
    digits = F.regexp_extract(text(c), WHOLE_NUMBER, 1)
    return F.nullif(digits, F.lit("")).try_cast("int")


def money(c, dtype="float"):
    """Price text to double: empty or negative text is 0, a decimal comma is read as a point.

    ``dtype="float"`` rounds to single precision first, ``"double"`` keeps the written value.
    """
    t = text(c)
    value = F.replace(t, F.lit(","), F.lit(".")).try_cast(dtype).cast("double")
    return F.when(is_empty(t) | t.contains("-"), F.lit(0.0)).otherwise(value)


def quantity(c):
    """Count text to int: empty text is 0, text that is no number is NULL."""
    return F.when(is_empty(c), F.lit(0)).otherwise(to_whole(c))


def date_time(c):
    """Date text to a timestamp without zone: empty or unreadable text is NULL.

    Without a zone the hour is the one that is written, whatever the session's zone.
    """
    ordered = F.regexp_replace(text(c), DATE_TIME, "$3-$2-$1 $4:00")
    return F.when(text(c).rlike(DATE_TIME), ordered.try_cast("timestamp_ntz"))
