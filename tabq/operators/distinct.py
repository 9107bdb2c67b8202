"""Distinct counts that add up: exact bitmaps over dictionary numbers.

A plain distinct count of a whole cannot be formed from those of its parts. Bitmaps can: they are
merged bit by bit, so one pass over the rows serves every level, and those of batches can be stored.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabq.functions.predicates import quoted

PARTS = 64


def dictionary(df, column):
    """(value, number): a number from 1 on for each value that is not NULL.

    Values are numbered in PARTS parts at once, so numbers are dense but for the parts' differences.
    """
    values = df.select(F.col(quoted(column)).alias("value")).distinct().filter("value IS NOT NULL")
    part = F.pmod(F.xxhash64("value"), F.lit(PARTS))
    place = F.row_number().over(Window.partitionBy(part).orderBy("value"))
    return values.select("value", ((place - 1) * PARTS + part + 1).alias("number"))


def bitmaps(df, column, numbers, by=()):
    """One row for each group and block of 32,768 numbers: which of them occur.

    Values are reduced to one row for each group before they meet their numbers.
    """
    met = df.select(*[F.col(quoted(c)) for c in by], F.col(quoted(column)).alias("value")).distinct()
    numbered = met.join(numbers, "value")
    return numbered.groupBy(*by, F.expr("bitmap_bucket_number(number)").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def merge(parts, by=()):
    """Bitmaps of parts, or of finer groups, as those of the groups of ``by``."""
    return parts.groupBy(*by, "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def count(parts, by=()):
    """The number of distinct values of each group; groups without any have no row."""
    return merge(parts, by).groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias("n"))
