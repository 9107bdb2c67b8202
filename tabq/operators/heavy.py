"""Heavy hitters: the few key values that hold a large part of all rows.

A sketch of frequent items holds at most ``TRACKED`` values whatever the table's size. Sketches of
parts (files, days, batches) are rows that can be stored and merged, so a table that grows is never
read again for them.
"""

from pyspark.sql import functions as F

from tabq.functions.predicates import quoted

TRACKED = 4096  # items in a sketch; what it misses holds less than about 1/TRACKED of the rows


def sketch(df, columns, by=(), tracked=TRACKED):
    """One row for each group of ``by``: a sketch of each column and the number of rows."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.expr(f"approx_top_k_accumulate(CAST({quoted(c)} AS STRING), {tracked})").alias(c)
          for c in columns])


def merge(sketches, columns, by=(), tracked=TRACKED):
    """Sketches of parts as those of the whole."""
    return sketches.groupBy(*by).agg(
        F.sum("rows").alias("rows"),
        *[F.expr(f"approx_top_k_combine({quoted(c)}, {tracked})").alias(c) for c in columns])


def hitters(sketches, columns, share, most=TRACKED):
    """(column, value, n, rows) of values that hold at least ``share`` of the rows, by estimate.

    At most 1/share values can hold as much. NULL is left out; it joins nothing.
    """
    k = min(most, int(1 / share) + 1)
    found = None
    for c in columns:
        one = sketches.select("rows", F.expr(f"inline(approx_top_k_estimate({quoted(c)}, {k}))"))
        one = one.select(F.lit(c).alias("column"), F.col("item").alias("value"),
                         F.col("count").alias("n"), "rows")
        found = one if found is None else found.unionByName(one)
    return found.filter(F.col("value").isNotNull() & (F.col("n") >= F.col("rows") * share))
