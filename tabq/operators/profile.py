"""Profiles of label columns."""

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tabq.functions.predicates import as_column, literal, quoted
from tabq.functions.strings import occurrences_json
from tabq.operators.groups import top

# The labels that are counted.
LABELS = ["M", "F", "I", "S", "T"]
ALL_LABELS = ["M", "MN", "F", "I", "S", "T", "A", "C", "N"]
PASSED = "passed"


def label_columns(df):
    return [c for c in df.columns if "qa" in c]


def label_counts(df, labels=LABELS, columns=None, weight=None, start=0):
    """(label, column, position, n): exact matches for every label and column, zeros included.

    Values that are no label are left out before rows are made of them. With ``weight`` each row counts as that many. Positions are numbered from ``start``.
    """
    columns = df.columns if columns is None else columns
    held = _can_hold(df, columns, labels)
    held = [c for c in columns if c in held]
    wanted = ", ".join(literal(l) for l in labels)
    hits = ", ".join(
        f"CASE WHEN CAST({quoted(c)} AS STRING) IN ({wanted}) THEN "
        f"named_struct('place', {i}, 'label', CAST({quoted(c)} AS STRING)) END"
        for i, c in enumerate(held)
    )
    rows = "1" if weight is None else quoted(weight)
    counts = (
        df.selectExpr(f"explode(array_compact(array({hits}))) AS hit", f"CAST({rows} AS BIGINT) AS n")
        .groupBy("hit.place", "hit.label")
        .agg(F.sum("n").alias("found"))
        .select(name_of(held), "label", "found")
        if held
        else df.sparkSession.createDataFrame([], "column string, label string, found bigint")
    )
    cells = ", ".join(
        f"({literal(l)}, {literal(c)}, {i})" for i, c in enumerate(columns, start) for l in labels
    )
    grid = df.sparkSession.sql(f"SELECT * FROM VALUES {cells} AS cells(label, column, position)")
    n = F.coalesce("found", F.lit(0).cast("bigint")).alias("n")
    return grid.join(counts, ["label", "column"], "left").select("label", "column", "position", n)


def _can_hold(df, columns, labels):
    """Leave out numbers if all labels are single letters, which no number is written as.

    Text of any collation can hold labels; they are compared byte by byte.
    """
    if not all(len(l) == 1 and l.isalpha() for l in labels):
        return set(columns)
    return {f.name for f in df.schema if isinstance(f.dataType, StringType)} & set(columns)


def star_label_counts(star, labels=LABELS, only_labels=False):
    """Label counts of the joined star without joining it row by row."""
    result, start = None, 0
    for df, columns, weight in star.slices():
        columns = [c for c in columns if "qa" in c] if only_labels else columns
        counts = label_counts(df, labels, columns, weight, start)
        result = counts if result is None else result.unionByName(counts)
        start += len(columns)
    return result


def worst_column(counts, label):
    """The column where the label is most frequent; the first column wins a tie.

    No row if the label does not occur at all.
    """
    found = counts.filter((F.col("label") == label) & (F.col("n") > 0))
    return top(found, "n", 1, ties=["position"]).select("column", "n")


def melt(df, columns, weight=None):
    """(place, value, weight) rows of the named columns, values as text.

    ``place`` is the index in ``columns``; ``name_of`` turns it into the name after grouping, so
    that no names are carried through the aggregation.
    """
    values = ", ".join(f"CAST({quoted(c)} AS STRING)" for c in columns)
    rows = "1" if weight is None else quoted(weight)
    return df.selectExpr(
        f"posexplode(array({values})) AS (place, value)", f"CAST({rows} AS BIGINT) AS weight"
    )


def name_of(columns):
    names = ", ".join(literal(c) for c in columns)
    return F.expr(f"element_at(array({names}), place + 1) AS column")


def frequency(df, columns=None, labels=ALL_LABELS, full=False):
    """How often each label occurs in each label column; all other values count as PASSED.

    ``full`` counts every value by itself. Label columns pass the source's values through, so that
    result can be as large as the table.
    """
    columns = label_columns(df) if columns is None else columns
    values = melt(df, columns)
    if not full:
        known = F.col("value").isin(list(labels))
        values = values.withColumn("value", F.when(known, F.col("value")).otherwise(PASSED))
    counts = values.groupBy("place", "value").agg(F.sum("weight").alias("n"))
    return counts.select(name_of(columns), "value", "n")


def starts_with_own_name(df, columns=None, weight=None):
    """Per label column: rows by whether the value starts with the column's own name."""
    columns = label_columns(df) if columns is None else columns
    own = melt(df, columns, weight).select("*", name_of(columns))
    starts = F.startswith(F.col("value"), F.col("column")).alias("starts")
    counts = own.groupBy("place", starts).agg(F.sum("weight").alias("n"))
    return counts.select(name_of(columns), "starts", "n")


def star_starts_with_own_name(star):
    """The same for the label columns of a joined star."""
    result = None
    for df, columns, weight in star.slices():
        counts = starts_with_own_name(df, [c for c in columns if "qa" in c], weight)
        result = counts if result is None else result.unionByName(counts)
    return result


def row_counts(**frames):
    """(table, n) for each named table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n")
        for name, df in frames.items()
    ]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return result


def value_occurrences(df, a, b, output="counts"):
    """Per row, how often each value occurs in two columns, as JSON."""
    joined = F.concat_ws(",", as_column(a), as_column(b))
    return df.withColumns({"concat": joined, output: occurrences_json(a, b)})


def merge_counts(*parts):
    """Label counts of batches as those of the whole table.

    Counts are stored for each batch of files (``label_counts`` and a handoff); a new batch then costs
    its own scan and this sum over a few rows.
    """
    rows = parts[0]
    for other in parts[1:]:
        rows = rows.unionByName(other)
    return rows.groupBy("label", "column", "position").agg(F.sum("n").alias("n"))
