"""Quality labels: one text column per rule, the first matching branch wins."""

from pyspark.sql import functions as F

from tabq.functions.predicates import is_empty, text


class Rule:
    """A ladder of (condition, label) that ends in the value itself, a constant or NULL.

    >>> Rule("QA-P2", "qa_year").when(is_missing("year"), "M").keep("year")
    """

    def __init__(self, id, output):
        self.id = id
        self.output = output
        self._ladder = None
        self._default = None

    def when(self, condition, label):
        label = F.lit(label) if isinstance(label, str) else label.cast("string")
        step = F if self._ladder is None else self._ladder
        self._ladder = step.when(condition, label)
        return self

    def keep(self, source):
        """Values that no branch catches pass through as text."""
        self._default = text(source)
        return self

    def otherwise(self, label):
        self._default = F.lit(label)
        return self

    def expression(self, sql):
        """The whole rule as one SQL expression, for rules that repeat over many columns."""
        self._default = F.expr(sql)
        return self

    def column(self):
        if self._ladder is None:
            return self._default
        if self._default is None:
            return self._ladder
        return self._ladder.otherwise(self._default)


def label(df, rules):
    """Append all label columns in a single projection."""
    return df.withColumns({r.output: r.column() for r in rules})


def backfill(df, column, value="M"):
    """Replace missing labels; a second pass because it reads a label column."""
    return df.withColumn(column, F.when(is_empty(column), F.lit(value)).otherwise(text(column)))
