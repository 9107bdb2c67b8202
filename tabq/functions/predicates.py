"""Boolean column builders. Each one accepts a column name or a Column unless it says otherwise.

Building a Column takes a call to the JVM per step. Where a table is wide or a word list long, the
builders here write one SQL expression instead.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabq.functions import patterns


def as_column(c):
    return c if isinstance(c, Column) else F.col(quoted(c))


def quoted(name):
    """Protect names such as ``hours-per-week``; an already quoted name is kept."""
    return name if name.startswith("`") else f"`{name}`"


def literal(value):
    """A text literal for a SQL expression."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def text(c):
    """The value as text. Emptiness is decided on this, so that typed columns survive ANSI mode."""
    return as_column(c).cast("string")


def is_empty(c):
    """NULL, the empty text, or text that ends in tabs or blanks."""
    t = text(c)
    return t.isNull() | (t == "") | t.rlike(patterns.EMPTY_TAIL)


def is_empty_sql(name):
    """``is_empty`` of a named column as SQL text."""
    t = f"CAST({quoted(name)} AS STRING)"
    return f"({t} IS NULL OR {t} = '' OR {t} RLIKE {literal(patterns.EMPTY_TAIL)})"


def is_blank(c):
    """NULL, the empty text, or text with a tab or blank anywhere in it."""
    t = text(c)
    return t.isNull() | (t == "") | has_blank(t)


def has_blank(c):
    t = text(c)
    return t.contains("\t") | t.contains(" ")


def is_missing(c):
    """NULL or the empty text."""
    t = text(c)
    return t.isNull() | (t == "")


def in_range(c, low, high, include_low=False, include_high=False):
    """Range test with a choice of open or closed ends."""
    c = as_column(c)
    above = c >= low if include_low else c > low
    below = c <= high if include_high else c < high
    return above & below


def outside(c, low, high):
    """Below ``low`` or above ``high``; both bounds are inside."""
    c = as_column(c)
    return (c < low) | (c > high)


def contains_any(name, words):
    """True if any word occurs literally in the named text column; NULL stays NULL."""
    return F.expr(" OR ".join(f"contains({quoted(name)}, {literal(w)})" for w in words))


def first_char(c):
    return F.substring(text(c), 1, 1)


def not_in(c, values):
    return ~as_column(c).isin(list(values))
