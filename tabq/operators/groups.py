"""Ranking and per-group selection.

Per-group winners are found by aggregation, not by sorting each group: partial results are merged
on the map side, so a group that holds a large part of the table costs no more than any other.
"""

from pyspark.sql import functions as F

from tabq.functions.predicates import as_column

SALTS = 8


def top(df, by, n=1, ties=(), descending=True):
    """The n rows with the highest (or lowest) value; ``ties`` orders equal ones."""
    by = as_column(by)
    order = by.desc_nulls_last() if descending else by.asc_nulls_first()
    return df.orderBy(order, *[as_column(t).asc_nulls_first() for t in ties]).limit(n)


def ranked(df, value, output, decimals=2, rank_on="numeric", n=1, ties=(), descending=True):
    """Top n by a number that is shown as formatted text.

    ``rank_on="numeric"`` orders by the number. ``"formatted"`` orders by the text, where
    ``9.50`` comes after ``1,000.00``.
    """
    shown = df.withColumn(output, F.format_number(as_column(value), decimals))
    key = {"numeric": value, "formatted": output}[rank_on]
    picked = top(shown, key, n, ties, descending)
    return picked if value == output else picked.drop(value)


def mode_per_group(df, group, value, output=None):
    """Most frequent value of each group; the smaller value wins a tie. NULL never wins."""
    return mode_of_counts(df.groupBy(*_list(group), value).agg(_count(value)), group, value, output)


def mode_of_counts(counts, group, value, output=None, n="n", with_count=False):
    """The same from (group, value, n) rows. An empty group list gives one row for the table.

    NULL wins only with a count that no other value has.
    """
    value_column = as_column(value)
    best = F.min(
        F.struct((-F.col(n)).alias("n"), value_column.isNull().alias("none"),
                 value_column.alias("value"))
    )
    winners = counts.groupBy(*_list(group)).agg(best.alias("_best"))
    kept = [as_column(c) for c in _list(group)] + [F.col("_best.value").alias(output or value)]
    if with_count:
        kept.append((-F.col("_best.n")).alias(n))
    return winners.select(*kept)


def top_per_group(df, group, value, salts=1):
    """All rows whose value is the highest of their group, ties included.

    The group maxima are joined back on (group, value). With ``salts`` above 1 the rows of a group
    are spread over that many parts by their number, so that many equal rows do not meet in one
    task. Rows that come out of a groupBy need none.
    """
    keys = _list(group)
    best = df.groupBy(*keys).agg(F.max(value).alias(value))
    left, best = _spread(df, best, salts)
    left, right = left.alias("l"), best.alias("r")
    same = F.col("l._salt") == F.col("r._salt")
    for c in keys:
        same = same & F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`"))
    same = same & (F.col(f"l.`{value}`") == F.col(f"r.`{value}`"))
    return left.join(right, same, "left_semi").drop("_salt")


def matches_any_group_max(df, group, value, copies="copies", salts=SALTS):
    """Rows whose value equals the highest value of any group, their own or not.

    Joining on the value alone yields each row once per matching group. Those equal rows are kept
    as one with their number in ``copies``, so the output does not grow with the square. A value
    that very many rows share is spread over ``salts`` parts.
    """
    maxima = df.groupBy(*_list(group)).agg(F.max(value).alias("_max"))
    per_value = maxima.groupBy("_max").agg(F.count(F.lit(1)).alias(copies))
    left, right = _spread(df, per_value, salts, "_salt2")
    same = (F.col(value) == F.col("_max")) & (F.col("_salt") == F.col("_salt2"))
    return left.join(right, same).drop("_max", "_salt", "_salt2")


def _spread(df, other, salts, other_name="_salt"):
    """df with a salt by row number, and other once for each salt."""
    number = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    all_salts = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return (df.withColumn("_salt", number if salts > 1 else F.lit(0)),
            other.withColumn(other_name, all_salts if salts > 1 else F.lit(0)))


def ratio(df, part, whole, output="ratio"):
    """Rows that fulfil one condition per row that fulfils another; NULL if there are none."""
    return df.agg(F.try_divide(F.count_if(part), F.count_if(whole)).alias(output))


def correlation(df, a, b, null_policy="zero", output="corr"):
    """Pearson correlation. ``"zero"`` reads NULL as 0, ``"skip"`` leaves such pairs out."""
    a, b = as_column(a).cast("double"), as_column(b).cast("double")
    if null_policy == "zero":
        a, b = F.coalesce(a, F.lit(0.0)), F.coalesce(b, F.lit(0.0))
    elif null_policy != "skip":
        raise ValueError(f"unknown null policy {null_policy!r}")
    return df.agg(F.corr(a, b).alias(output))


def _count(value):
    return F.count(as_column(value)).alias("n")


def _list(names):
    return [names] if isinstance(names, str) else list(names)
