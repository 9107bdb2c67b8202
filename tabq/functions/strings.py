"""Text helpers that need no Python worker."""

from pyspark.sql import functions as F

from tabq.functions.predicates import as_column, contains_any, text


def without_digits_and_first(c):
    """Drop all digits, then the first character that is left."""
    return F.substr(F.regexp_replace(text(c), r"[0-9]", ""), F.lit(2))


def captured(c, pattern):
    """First group of a case-insensitive search, in upper case; empty if nothing matches."""
    return F.upper(F.regexp_extract(text(c), "(?i)" + pattern, 1))


def known_or(name, keywords, label="M"):
    """The value itself if it holds one of the keywords, else the label (also for NULL)."""
    return F.when(contains_any(name, keywords), text(name)).otherwise(F.lit(label))


def occurrences_json(*columns, sep=","):
    """Count how often each value occurs among the columns of a row, as a JSON object.

    The values are joined and split again, so a value that holds the separator counts as several.
    """
    parts = F.split(F.concat_ws(sep, *[as_column(c) for c in columns]), sep)
    counts = F.transform(
        F.array_distinct(parts),
        lambda v: F.struct(
            v.alias("key"), F.size(F.filter(parts, lambda p: p == v)).alias("value")
        ),
    )
    return F.to_json(F.map_from_entries(counts))
