"""A fact table with the dimensions it refers to.

No join carries a broadcast hint: Catalyst broadcasts a dimension only if its size is below
``spark.sql.autoBroadcastJoinThreshold`` and adaptive execution checks again at run time.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tabq.operators import heavy as hitters
from tabq.sources import files

NULL_PARTS = 64
HEAVY_PARTS = 256  # a key is heavy if it holds more than this part of all rows


def prefixed(df, prefix):
    return df.toDF(*[prefix + c for c in df.columns])


@dataclass(frozen=True)
class Dimension:
    """``key`` must be unique, else fact rows multiply. All columns start with ``prefix``."""

    prefix: str
    table: DataFrame
    foreign_key: str
    key: str


@dataclass(frozen=True)
class Measure:
    kind: str
    column: str = None


_PLAIN = {"sum": F.sum, "avg": F.avg, "count": F.count}


def total(column):
    return Measure("sum", column)


def mean(column):
    return Measure("avg", column)


def count():
    return Measure("count")


class Star:
    def __init__(self, fact, dimensions):
        self.fact = fact
        self.dimensions = {d.prefix: d for d in dimensions}

    def heavy_keys(self, *prefixes, parts=HEAVY_PARTS, sketches=None):
        """{foreign key: {value: parts}} of the key values that hold over 1/parts of all fact rows.

        One pass over the fact for all keys, or none if ``sketches`` (``heavy.sketch`` of the foreign
        keys, merged) are at hand. The result has at most ``parts`` values for each key.
        """
        keys = list(dict.fromkeys(d.foreign_key for d in self._dims(prefixes)))
        if sketches is None:
            sketches = hitters.sketch(self.fact, keys)
        found = {k: {} for k in keys}
        for r in hitters.hitters(sketches, keys, 1 / parts).collect():
            found[r.column][r.value] = -(-r.n * parts // r.rows)
        return found

    def laid_out(self, prefix, buckets, base=None):
        """The star with its fact laid out by one dimension's foreign key and that dimension by its
        key, both in ``buckets`` parts: joins and groups on it shuffle neither, in every report.

        Rows of a heavy key stay in one bucket; ``join(heavy=...)`` is the way for such a key.
        """
        d = self.dimensions[prefix]
        fact = files.bucketed(self.fact, "fact", [d.foreign_key], buckets, base)
        table = files.bucketed(d.table, "dimension", [d.key], buckets, base)
        laid = Dimension(d.prefix, table, d.foreign_key, d.key)
        return Star(fact, [laid if p == prefix else other for p, other in self.dimensions.items()])

    def bucketed_join(self, prefix):
        """All fact rows with one dimension's columns, by key alone, as ``laid_out`` supports it."""
        return Star(self.fact, [self.dimensions[prefix]])._reduced_join()

    def join(self, *prefixes, salts=1, heavy=None):
        """All fact rows with the columns of the named dimensions (default: of all of them).

        Rows whose foreign key is NULL are spread over NULL_PARTS parts; they match nothing.
        Adaptive execution splits other skewed keys. ``salts`` above 1 spreads every key over that
        many parts beforehand, at the price of as many copies of each dimension. ``heavy`` (from
        ``heavy_keys``) spreads only the key values it names, each over its own number of parts; all
        other dimension rows stay single. Rows are spread by their number, so equal rows are spread
        too.
        """
        joined = self.fact.withColumn("_number", F.monotonically_increasing_id())
        for d in self._dims(prefixes):
            named = (heavy or {}).get(d.foreign_key, {})
            spread = F.pmod("_number", _parts_of(d.foreign_key, named, salts))
            nulls = F.lit(-1) - F.pmod("_number", F.lit(NULL_PARTS))
            part = F.when(F.col(d.foreign_key).isNull(), nulls).otherwise(spread).cast("int")
            copies = F.explode(F.sequence(F.lit(0), _parts_of(d.key, named, salts) - 1))
            parts = copies if salts > 1 or named else F.lit(0)
            table = d.table.withColumn(f"{d.prefix}_part", parts)
            same = (F.col(d.foreign_key) == F.col(d.key)) & (part == F.col(f"{d.prefix}_part"))
            joined = joined.join(table, same, "left").drop(f"{d.prefix}_part")
        return joined.drop("_number")

    def combinations(self, *prefixes):
        """The distinct foreign keys of the fact, joined to their dimensions."""
        dims = self._dims(prefixes)
        keys = self.fact.select(*[d.foreign_key for d in dims]).distinct()
        return Star(keys, dims)._reduced_join()

    def aggregate(self, by, measures, where=None, reduce_first=True):
        """Group by fact and dimension columns; dimensions no output needs are not joined.

        ``by`` maps output names to a column name or, for fact columns, an expression.

        The fact is first summed up per foreign key, on the map side too, so the joins see one row
        per key and a key that holds a large part of all rows (or NULL) is as light as any other.
        Results have the types of the same aggregates over the plain join. ``reduce_first=False`` sums
        up after a row-level join (``join``), in one aggregation: for groups that are so fine that hardly
        two rows share both a group and a foreign key, where reducing only adds a shuffle.
        """
        fact = self.fact if where is None else self.fact.filter(where)
        wanted = [c for c in by.values() if isinstance(c, str)]
        wanted += [m.column for m in measures.values() if m.column]
        dims = [d for d in self.dimensions.values() if any(c in d.table.columns for c in wanted)]
        if not reduce_first:
            joined = Star(fact, dims).join() if dims else fact
            groups = [F.col(c).alias(n) if isinstance(c, str) else c.alias(n) for n, c in by.items()]
            return joined.groupBy(*groups).agg(
                *[_PLAIN[m.kind](m.column or F.lit(1)).alias(n) for n, m in measures.items()])
        home = {c: d.table for d in dims for c in d.table.columns}

        local = {
            name: c if isinstance(c, Column) else F.col(c)
            for name, c in by.items()
            if isinstance(c, Column) or c not in home
        }
        keys = list(dict.fromkeys(d.foreign_key for d in dims))
        groups = [c.alias(name) for name, c in local.items()] + [F.col(k) for k in keys]
        plans = {name: _Plan(m, home.get(m.column, fact), m.column in home)
                 for name, m in measures.items()}
        parts = {"_rows": F.count(F.lit(1))}
        for plan in plans.values():
            parts |= plan.parts()
        reduced = fact.groupBy(*groups).agg(*[c.alias(name) for name, c in parts.items()])
        if not dims:
            return reduced.select(
                *local, *[plan.result(lambda part: part).alias(name) for name, plan in plans.items()]
            )
        joined = Star(reduced, dims)._reduced_join()
        final = [F.col(name) if name in local else F.col(by[name]).alias(name) for name in by]
        return joined.groupBy(*final).agg(
            *[plan.result(F.sum).alias(name) for name, plan in plans.items()]
        )

    def _reduced_join(self):
        """A join of few rows per key, which need no spreading."""
        joined = self.fact
        for d in self.dimensions.values():
            joined = joined.join(d.table, F.col(d.foreign_key) == F.col(d.key), "left")
        return joined

    def slices(self):
        """The joined star as separate parts: (rows, columns, weight).

        The fact stands for itself. A dimension comes with the number of fact rows it meets as
        weight, unmatched ones as a row of NULLs, so that counts add up to those of the join.
        """
        yield self.fact, self.fact.columns, None
        for d in self.dimensions.values():
            met = self.fact.groupBy(d.foreign_key).agg(F.count(F.lit(1)).alias("_rows"))
            yield Star(met, [d])._reduced_join(), d.table.columns, "_rows"

    def _dims(self, prefixes):
        return [self.dimensions[p] for p in prefixes or self.dimensions]


def _parts_of(key, named, others):
    """Over how many parts a key value is spread."""
    if not named:
        return F.lit(others)
    table = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
    return F.coalesce(F.element_at(table, F.col(key).cast("string")), F.lit(others)).cast("int")


class _Plan:
    """One measure: what is summed up per foreign key, and the result from those parts."""

    def __init__(self, measure, table, on_dimension):
        self.kind, self.column, self.weighted = measure.kind, measure.column, on_dimension
        if self.column:
            kinds = table.select(F.sum(self.column).alias("sum"), F.avg(self.column).alias("avg"))
            self.type = kinds.schema[self.kind].dataType
            self.exact = isinstance(self.type, DecimalType)

    def _value(self):
        """Means of other numbers than decimals are formed from doubles, which do not overflow."""
        value = F.col(self.column)
        return value if self.kind == "sum" or self.exact else value.cast("double")

    def _names(self):
        return f"_{self.kind}_{self.column}", f"_count_{self.column}"

    def parts(self):
        if not self.column or self.weighted:
            return {}
        total_name, count_name = self._names()
        return {total_name: F.sum(self._value()), count_name: F.count(self.column)}

    def result(self, merged):
        """``merged`` sums the parts of many groups, or reads those of one."""
        if self.kind == "count":
            return F.coalesce(merged(F.col("_rows")), F.lit(0).cast("bigint"))
        if self.weighted:
            present = F.when(F.col(self.column).isNotNull(), F.col("_rows"))
            whole, rows = merged(self._value() * F.col("_rows")), merged(present)
        else:
            whole, rows = (merged(F.col(name)) for name in self._names())
        if self.kind == "sum":
            return whole.cast(self.type)
        return F.try_divide(whole, rows.cast("decimal(20,0)") if self.exact else rows).cast(self.type)
