"""Ranking, groups, star joins, profiles and expectations, against plain Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabq.operators import expect, groups, profile
from tabq.operators.star import Dimension, Star, count, mean, prefixed, total


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one group, and one group is NULL."""
    rng = random.Random(7)
    data = []
    for i in range(600):
        group = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        data.append((group, rng.choice(["x", "y", "z", None])))
    return data, spark.createDataFrame(data, "g string, v string").cache()


def test_mode_per_group(skewed):
    data, df = skewed
    expected = Counter()
    for g in {g for g, _ in data}:
        counts = Counter(v for h, v in data if h == g and v is not None)
        expected[(g, min(counts, key=lambda v: (-counts[v], v)))] += 1
    assert bag(groups.mode_per_group(df, "g", "v")) == expected


def test_mode_ties_take_the_smaller_value(spark):
    df = spark.createDataFrame([("a", "z"), ("a", "b"), ("b", None)], "g string, v string")
    assert bag(groups.mode_per_group(df, "g", "v")) == Counter([("a", "b"), ("b", None)])


@pytest.mark.parametrize("salts", [1, 3, 8])
def test_top_per_group_keeps_ties(skewed, salts):
    data, df = skewed
    counts = Counter(data)
    best = {g: max(n for (h, _), n in counts.items() if h == g) for g, _ in data}
    expected = Counter((g, v, n) for (g, v), n in counts.items() if n == best[g])
    found = groups.top_per_group(df.groupBy("g", "v").agg(F.count("*").alias("n")), "g", "n", salts)
    assert bag(found) == expected
    same = df.groupBy("g").agg(F.lit(1).alias("n"))
    assert bag(groups.top_per_group(same, "g", "n")) == Counter((g, 1) for g in best)


def test_matches_any_group_max(spark):
    data = [("a", "x", 3), ("a", "y", 2), ("b", "x", 2), ("c", "x", 2), ("c", "y", 1)]
    df = spark.createDataFrame(data, "g string, v string, n int")
    best = {"a": 3, "b": 2, "c": 2}
    expected = Counter()
    for g, v, n in data:
        copies = sum(1 for m in best.values() if m == n)
        if copies:
            expected[(g, v, n, copies)] += 1
    assert bag(groups.matches_any_group_max(df, "g", "n")) == expected


def test_ranking_on_text_and_number(spark):
    df = spark.createDataFrame([("a", 9.5), ("b", 1000.0), ("c", 88.25)], "k string, x double")
    by_text = groups.ranked(df, "x", "shown", rank_on="formatted", n=3)
    assert [r.shown for r in by_text.collect()] == ["9.50", "88.25", "1,000.00"]
    by_number = groups.ranked(df, "x", "shown", n=2)
    assert [r.shown for r in by_number.collect()] == ["1,000.00", "88.25"]
    lowest = groups.ranked(df, "x", "shown", descending=False)
    assert [r.shown for r in lowest.collect()] == ["9.50"]


def test_top_breaks_ties_and_puts_null_last(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", None)], "k string, n int")
    assert rows(groups.top(df, "n", 3, ["k"])) == [("a", 2), ("b", 2), ("c", None)]


def test_correlation_policies(spark):
    df = spark.createDataFrame(
        [(1, 2), (2, 1), (3, None), (None, 9), (5, 7)], "a int, b int")
    assert groups.correlation(df, "a", "b").first()[0] == pytest.approx(-0.09184327291171529)
    skip = groups.correlation(df, "a", "b", "skip").first()[0]
    assert skip == pytest.approx(0.921550640565428)
    with pytest.raises(ValueError):
        groups.correlation(df, "a", "b", "other")


def test_ratio_without_whole_is_null(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert groups.ratio(df, F.col("a") == 1, F.col("a") == 2).first()[0] is None


@pytest.fixture(scope="module")
def star(spark):
    rng = random.Random(3)
    codes = ["A", "A", "A", "B", "C", None, "?"]
    trips = [(rng.choice(codes), rng.choice(codes), rng.choice([None, -3, 0, 5, 9]))
             for _ in range(300)]
    fact = spark.createDataFrame(trips, "fl_origin string, fl_dest string, fl_delay int")
    place = spark.sql("SELECT * FROM VALUES ('A', 'r1', 10), ('B', 'r1', 20), ('C', 'r2', NULL) "
                      "AS places(code, region, size)")
    dims = [Dimension("o_", prefixed(place, "o_"), "fl_origin", "o_code"),
            Dimension("d_", prefixed(place, "d_"), "fl_dest", "d_code")]
    return Star(fact, dims)


def test_star_keeps_every_fact_row(star):
    assert bag(star.join().select(*star.fact.columns)) == bag(star.fact)
    assert bag(star.join(salts=5)) == bag(star.join())


@pytest.mark.parametrize("by", [
    {"region": "d_region"},
    {"origin": "fl_origin", "region": "d_region"},
    {"from": "o_region", "to": "d_region"},
    {"origin": "fl_origin"},
])
def test_star_aggregate_equals_aggregate_of_join(star, by):
    where = F.col("fl_delay") >= 0
    measures = {"n": count(), "sum": total("fl_delay"), "mean": mean("fl_delay")}
    direct = star.join().filter(where).groupBy(*[F.col(c).alias(n) for n, c in by.items()]).agg(
        F.count("*").alias("n"), F.sum("fl_delay").alias("sum"), F.avg("fl_delay").alias("mean"))
    assert bag(star.aggregate(by, measures, where)) == bag(direct)


def test_star_aggregate_of_dimension_measures(star):
    measures = {"sum": total("d_size"), "mean": mean("d_size")}
    direct = star.join().groupBy(F.col("o_region").alias("region")).agg(
        F.sum("d_size").alias("sum"), F.avg("d_size").alias("mean"))
    assert bag(star.aggregate({"region": "o_region"}, measures)) == bag(direct)


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
@pytest.mark.parametrize("column", ["fl_price", "fl_big", "fl_real", "d_price", "d_big"])
def test_star_aggregate_has_the_types_of_the_plain_join(spark, column, threshold):
    fact = spark.sql("""SELECT * FROM VALUES ('A', 1.25, 9000000000000000000, 0.5F),
        ('A', 2.50, 9000000000000000000, 1.5F), ('B', NULL, NULL, NULL), (NULL, 7.77, 1, 2F)
        AS t(fl_at, fl_price, fl_big, fl_real)""")
    place = spark.sql("""SELECT * FROM VALUES ('A', 'r', 10.10, 5), ('B', 'r', NULL, 7)
        AS t(d_code, d_region, d_price, d_big)""").withColumn("d_big", F.col("d_big").cast("long"))
    star = Star(fact, [Dimension("d_", place, "fl_at", "d_code")])
    measures = {"mean": mean(column)}
    direct = [F.avg(column).alias("mean")]
    if column != "fl_big":  # its sum does not fit
        measures["sum"] = total(column)
        direct.append(F.sum(column).alias("sum"))
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, threshold)
        found = star.aggregate({"region": "d_region"}, measures)
        plain = star.join().groupBy(F.col("d_region").alias("region")).agg(*direct)
        assert found.dtypes == plain.dtypes
        assert bag(found) == bag(plain)
    finally:
        spark.conf.set(name, before)


def test_equal_rows_and_null_keys_are_spread(spark):
    """A join by (key, part) sends the rows of one key to as many tasks as it has parts."""
    equal = spark.range(1000).select(F.lit("A").alias("k"), F.lit(1).alias("v"))
    left, right = groups._spread(equal, equal.limit(1), 8)
    assert left.select("_salt").distinct().count() == 8 == right.count()
    place = spark.sql("SELECT 'A' AS d_k")
    star = Star(spark.range(1000).select(F.lit(None).cast("string").alias("f_k")),
                [Dimension("d_", place, "f_k", "d_k")])
    assert star.join().count() == 1000
    assert bag(groups.top_per_group(equal, "k", "v", salts=8)) == bag(equal)


def test_null_wins_no_tie(spark):
    df = spark.createDataFrame([("x", None, 2), ("x", "b", 2), ("y", None, 3), ("y", "b", 1)],
                               "g string, v string, n int")
    assert bag(groups.mode_of_counts(df, "g", "v")) == Counter([("x", "b"), ("y", None)])


def test_star_aggregate_joins_only_what_it_needs(star):
    plan = star.aggregate({"origin": "fl_origin"}, {"n": count()})
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_combinations(star):
    expected = star.join().select("fl_origin", "fl_dest", "o_region", "d_region").distinct()
    found = star.combinations().select("fl_origin", "fl_dest", "o_region", "d_region")
    assert bag(found) == bag(expected)


def test_label_counts(spark):
    df = spark.createDataFrame(
        [("M", "F", 1), ("M", "MY", 2), (None, "F", 3)], "qa_a string, qa_b string, c int")
    counts = {(r.label, r.column): r.n for r in profile.label_counts(df).collect()}
    assert len(counts) == 15
    assert {k: n for k, n in counts.items() if n} == {("M", "qa_a"): 2, ("F", "qa_b"): 2}
    empty = profile.label_counts(df.limit(0), ["M"])
    assert [r.n for r in empty.collect()] == [0, 0, 0]
    two = profile.label_counts(df, ["MY", "3"])
    assert {(r.label, r.column) for r in two.collect() if r.n} == {("MY", "qa_b"), ("3", "c")}


def test_label_counts_of_collated_text(spark):
    df = spark.sql("SELECT qa_a COLLATE UTF8_LCASE AS qa_a FROM VALUES ('M'), ('m') AS t(qa_a)")
    counts = {r.label: r.n for r in profile.label_counts(df, ["M", "F"]).collect()}
    assert counts == {"M": 1, "F": 0}


def test_worst_column(spark):
    df = spark.createDataFrame([("M", "M"), ("M", "M")], "qa_b string, qa_a string")
    counts = profile.label_counts(df)
    assert rows(profile.worst_column(counts, "M")) == [("qa_b", 2)]
    assert rows(profile.worst_column(counts, "F")) == []


def test_star_profile_equals_profile_of_join(spark, star):
    labelled = Star(
        star.fact.withColumn("fl_qa_delay", F.when(F.col("fl_delay") < 0, "I")),
        [Dimension(d.prefix, d.table.withColumn(f"{d.prefix}qa_size", F.when(
            F.col(f"{d.prefix}size").isNull(), "M").otherwise("I")), d.foreign_key, d.key)
         for d in star.dimensions.values()])
    assert bag(profile.star_label_counts(labelled)) == bag(profile.label_counts(labelled.join()))
    whole = profile.starts_with_own_name(labelled.join())
    assert bag(profile.star_starts_with_own_name(labelled)) == bag(whole)


def test_frequency_and_own_name(spark):
    df = spark.createDataFrame([("M", "qa_b1"), ("M", None)], "qa_a string, qa_b string")
    assert bag(profile.frequency(df, full=True)) == Counter(
        [("qa_a", "M", 2), ("qa_b", "qa_b1", 1), ("qa_b", None, 1)])
    assert bag(profile.frequency(df)) == Counter([("qa_a", "M", 2), ("qa_b", "passed", 2)])
    assert bag(profile.starts_with_own_name(df)) == Counter(
        [("qa_a", False, 2), ("qa_b", True, 1), ("qa_b", None, 1)])


def test_value_occurrences_and_row_counts(spark):
    df = spark.createDataFrame([("A", "A"), ("34", "N"), (None, "M")], "dst string, qa string")
    found = profile.value_occurrences(df, "dst", "qa").select("concat", "counts")
    assert rows(found) == [("A,A", '{"A":2}'), ("34,N", '{"34":1,"N":1}'), ("M", '{"M":1}')]
    assert bag(profile.row_counts(a=df, b=df.limit(1))) == Counter([("a", 3), ("b", 1)])


def test_expectations(spark):
    df = spark.createDataFrame([("a", 1), ("?", None), (None, 3), ("b", 4)], "x string, n int")
    results = {(r.column, r.expectation): r for r in
               expect.check_mandatory(df, ["x", "n", "gone"]).collect()}
    assert set(results) == {("x", "to_exist"), ("x", "not_null"), ("x", "not_match"),
                            ("n", "to_exist"), ("n", "not_null"), ("n", "not_match"),
                            ("gone", "to_exist")}
    assert results["x", "not_null"].unexpected_count == 1
    assert results["x", "not_match"].unexpected_percent == 25.0
    assert results["n", "not_match"].success and not results["gone", "to_exist"].success
    lines = {r.column: (r.status, r.reason) for r in
             expect.report(expect.check_mandatory(df, ["x", "n", "gone"])).collect()}
    assert lines["x"] == ("FAILED", "1 of 4 values are NULL")
    assert lines["gone"] == ("FAILED", "column is missing")
    clean = expect.report(expect.check_mandatory(df.limit(1), ["x"]))
    assert rows(clean) == [("x", "PASSED", None)]
