"""Dataset expectations: all checks of a table in one pass, as a result table."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tabq.functions import patterns
from tabq.functions.predicates import as_column, literal, text

def to_exist(column):
    return ("to_exist", column, None)


def not_null(column):
    return ("not_null", column, lambda c: as_column(c).isNull())


def not_match(column, pattern=patterns.QUESTION_MARK):
    """NULL values are not unexpected; the percentage is of all rows."""
    return ("not_match", column, lambda c: text(c).rlike(pattern))


def check(df, expectations):
    """One row per expectation. Value checks on columns the table lacks are left out.

    Existence is read off the schema, all other counts come from a single aggregation.
    """
    counters, results = _plan(df, expectations)
    return df.agg(*counters).selectExpr(results)


def observe(df, expectations, name="expectations"):
    """The table, to be written or otherwise used, and a function for the results of ``check``.

    The counts are taken from the rows as they pass by in the first action on the table, so they cost
    no job and no scan of their own; the function waits for that action and gives the results as a
    table. Put it last, right before the write: rows that a task of an earlier stage has to repeat
    would be counted again. An action that reads only a part of the table counts that part.
    """
    counters, results = _plan(df, expectations)
    seen = Observation(name)
    spark = df.sparkSession

    def outcome():
        counts = {c: int(n) for c, n in seen.get.items()}
        fields = ", ".join(f"{c} bigint" for c in counts)
        return spark.createDataFrame([tuple(counts.values())], fields).selectExpr(results)

    return df.observe(seen, *counters), outcome


def _plan(df, expectations):
    """The counts to take, and the results from them."""
    counters, results = {"total": F.count(F.lit(1))}, []
    for i, (kind, column, unexpected) in enumerate(expectations):
        present = column in df.columns
        if unexpected is None:
            results.append(_result(column, kind, str(present), "NULL", "NULL"))
        elif present:
            bad = f"bad_{i}"
            counters[bad] = F.count_if(unexpected(column))
            results.append(_result(column, kind, f"{bad} = 0", "total", bad))
    return [c.alias(n) for n, c in counters.items()], f"inline(array({', '.join(results)}))"


def _result(column, kind, success, total, bad):
    return (
        f"struct({literal(column)} AS column, {literal(kind)} AS expectation, "
        f"{success} AS success, CAST({total} AS BIGINT) AS element_count, "
        f"CAST({bad} AS BIGINT) AS unexpected_count, "
        f"try_divide(CAST({bad} AS DOUBLE) * 100, {total}) AS unexpected_percent)"
    )


def mandatory(columns):
    """Every column must exist, hold no NULL and no question mark."""
    return [make(c) for c in columns for make in (to_exist, not_null, not_match)]


def check_mandatory(df, columns):
    return check(df, mandatory(columns))


def report(results):
    """One line per column: the first failed check, else PASSED."""
    failed = F.when(
        ~F.col("success"),
        F.when(F.col("expectation") == "to_exist", F.lit("column is missing"))
        .when(
            F.col("expectation") == "not_null",
            F.format_string("%d of %d values are NULL", "unexpected_count", "element_count"),
        )
        .otherwise(
            F.format_string(
                "%d values look unknown, %.1f%% of all", "unexpected_count", "unexpected_percent"
            )
        ),
    )
    order = (
        F.when(F.col("expectation") == "to_exist", 0)
        .when(F.col("expectation") == "not_null", 1)
        .otherwise(2)
    )
    first = F.min_by(failed, F.when(~F.col("success"), order))
    return results.groupBy("column").agg(
        F.when(F.bool_and("success"), "PASSED").otherwise("FAILED").alias("status"),
        first.alias("reason"),
    )
