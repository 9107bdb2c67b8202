"""All correlations of a table from one scan: counts, sums and products of each pair of columns.

Moments are rows that add up, so those of batches can be stored and merged.
"""

from itertools import combinations

from pyspark.sql import functions as F

from tabq.functions.predicates import literal, quoted

PARTS = ["n", "sum_a", "sum_b", "sum_aa", "sum_bb", "sum_ab"]


def moments(df, columns, null_policy="zero", by=()):
    """(a, b, PARTS) of every pair, for each group of ``by``.

    ``null_policy="zero"`` reads NULL as 0; ``"skip"`` leaves a row out of the pairs it has a NULL in,
    so every pair has its own count.
    """
    values = {c: F.col(quoted(c)).cast("double") for c in columns}
    if null_policy == "zero":
        values = {c: F.coalesce(v, F.lit(0.0)) for c, v in values.items()}
    pairs, aggregates = list(combinations(columns, 2)), []
    for i, (a, b) in enumerate(pairs):
        x, y = values[a], values[b]
        both = x.isNotNull() & y.isNotNull()
        terms = {"sum_a": x, "sum_b": y, "sum_aa": x * x, "sum_bb": y * y, "sum_ab": x * y}
        aggregates.append(F.count_if(both).alias(f"n_{i}"))
        aggregates += [F.sum(F.when(both, t)).alias(f"{name}_{i}") for name, t in terms.items()]
    wide = df.groupBy(*by).agg(*aggregates)
    structs = ", ".join(
        f"struct({literal(a)} AS a, {literal(b)} AS b, {', '.join(f'{p}_{i} AS {p}' for p in PARTS)})"
        for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(*[quoted(c) for c in by], f"inline(array({structs}))")


def merge(parts, by=()):
    """Moments of batches as those of the whole."""
    return parts.groupBy(*by, "a", "b").agg(*[F.sum(p).alias(p) for p in PARTS])


def correlations(found):
    """(a, b, n, corr); NULL where a column does not vary."""
    def spread(x):
        return F.col("n") * F.col(f"sum_{x}{x}") - F.col(f"sum_{x}") * F.col(f"sum_{x}")

    together = F.col("n") * F.col("sum_ab") - F.col("sum_a") * F.col("sum_b")
    scale = F.sqrt(F.greatest(spread("a") * spread("b"), F.lit(0.0)))
    kept = [c for c in found.columns if c not in PARTS]
    return found.select(*kept, "n", F.try_divide(together, scale).alias("corr"))
