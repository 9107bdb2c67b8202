"""Files and layouts: what is scanned, shuffled and counted, besides the results."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from tabq.operators import distinct, expect, heavy, moments, profile
from tabq.operators.star import Dimension, Star
from tabq.plans import analogues, cleaning
from tabq.plans.registry import QUERIES, Source
from tabq.plans.reports import retail
from tabq.sources import files, schemas

PLACE = schemas.typed({"code": "string", "alt": "int", "lat": "float"})


def plan(df):
    """The physical plan, before it is adapted to real sizes."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def unadapted(spark):
    """No adaptive plans and no broadcasts, so that the plan says what is shuffled."""
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


# CSV ------------------------------------------------------------------------------------------------


def test_csv_round_trip_keeps_null_empty_text_and_blanks(spark, tmp_path):
    rows = [("", None, " a "), (None, "", 'say "hi", \\n'), ("\\", "x,y", "ß 中")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    files.write_csv(df, str(tmp_path / "out"))
    back = files.read_csv(spark, str(tmp_path / "out"), df.schema, null_text=files.NULL_TEXT)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    with pytest.raises(Exception, match="(?i)exists"):
        files.write_csv(df, str(tmp_path / "out"))


def test_records_that_do_not_fit_are_kept_apart(spark, tmp_path):
    path = tmp_path / "places.csv"
    path.write_text('code,alt,lat\nA,1,2.5\nB,,\nC,1x,2.5\nD,2x,"1,5"\nE,3\nF,4,5.0,6\n"G,H",7,8.0\n')
    landed = files.land_csv(spark, str(path), PLACE, "places", str(tmp_path / "out"))
    assert sorted(map(tuple, landed.accepted.collect())) == [("A", 1, 2.5), ("B", None, None), ("G,H", 7, 8.0)]
    found = {r.code: (r.line, r.reason, r.alt, r.lat) for r in landed.rejected.collect()}
    assert found == {
        "C": ("C,1x,2.5", "alt", None, 2.5),
        "D": ('D,2x,"1,5"', "alt, lat", None, None),
        "E": ("E,3", "number of fields", 3, None),
        "F": ("F,4,5.0,6", "number of fields", 4, 5.0)}
    assert landed.accepted.columns == PLACE.fieldNames()


def test_accepted_records_are_read_without_the_others(spark, tmp_path):
    path = tmp_path / "places.csv"
    path.write_text("code,alt,lat\nA,1,2.5\nC,1x,2.5\n")
    landed = files.land_csv(spark, str(path), PLACE, "places", str(tmp_path / "out"))
    assert "PartitionFilters: [isnotnull(_rejected" in plan(landed.accepted).replace("\n", "")
    empty = tmp_path / "empty.csv"
    empty.write_text("code,alt,lat\n")
    landed = files.land_csv(spark, str(empty), PLACE, "none", str(tmp_path / "out"))
    assert landed.accepted.count() == landed.rejected.count() == 0


# Expectations -------------------------------------------------------------------------------------


def jobs(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_observed_expectations_cost_no_job(spark, tmp_path):
    rows = [(i, None if i % 3 else "x", "?" if i % 4 == 0 else "y") for i in range(40)]
    df = spark.createDataFrame(rows, "n int, a string, b string")
    wanted = expect.mandatory(["n", "a", "b", "c"])
    watched, outcome = expect.observe(df, wanted)
    _, plain = jobs(spark, "plain", lambda: files.write_parquet(df, str(tmp_path / "plain")))
    _, seen = jobs(spark, "watched", lambda: files.write_parquet(watched, str(tmp_path / "watched")))
    assert plain == seen > 0
    results, more = jobs(spark, "results", lambda: sorted(map(str, outcome().collect())))
    assert results == sorted(map(str, expect.check(df, wanted).collect()))
    assert spark.read.parquet(str(tmp_path / "watched")).count() == 40
    report = {r.column: r.status for r in expect.report(outcome()).collect()}
    assert report == {"n": "PASSED", "a": "FAILED", "b": "FAILED", "c": "FAILED"}


def test_observed_expectations_of_an_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "n int")
    watched, outcome = expect.observe(df, expect.mandatory(["n"]))
    files.write_parquet(watched, str(tmp_path / "out"))
    assert [(r.success, r.element_count, r.unexpected_percent) for r in outcome().collect()][1:] == [
        (True, 0, None), (True, 0, None)]


# Heavy keys ---------------------------------------------------------------------------------------


def skewed(spark, rows=20000):
    """Half of the rows have one key, a tenth no key."""
    key = F.when(F.col("n") % 10 < 5, "hot").when(F.col("n") % 10 < 9, F.concat(F.lit("k"), F.col("n") % 701))
    fact = spark.range(rows).toDF("n").select("n", key.alias("key"))
    dim = spark.range(701).select(F.concat(F.lit("k"), "id").alias("d_key"), F.col("id").alias("d_id"))
    dim = dim.union(spark.createDataFrame([("hot", -1)], "d_key string, d_id long"))
    return Star(fact, [Dimension("d_", dim, "key", "d_key")])


def test_heavy_keys_are_found_and_spread(unadapted):
    spark, star = unadapted, skewed(unadapted)
    found = star.heavy_keys(parts=128)
    assert list(found["key"]) == ["hot"] and 60 <= found["key"]["hot"] <= 70
    joined = star.join(heavy=found)
    plain = star.join()
    assert sorted(map(str, joined.collect())) == sorted(map(str, plain.collect()))

    def largest(df):
        sizes = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
        return max(r["count"] for r in sizes) / (sum(r["count"] for r in sizes) / 8)

    assert largest(plain) > 4 and largest(joined) < 2
    copies = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in copies  # only the named key's row is copied
    assert star.heavy_keys(parts=2, sketches=heavy.sketch(star.fact.filter("key <> 'hot'"), ["key"])) == {"key": {}}


def test_sketches_of_parts_merge(spark, tmp_path):
    fact = skewed(spark).fact.withColumn("day", F.col("n") % 3)
    parts = files.handoff(heavy.sketch(fact, ["key"], ["day"]), "sketches", str(tmp_path))
    whole = heavy.hitters(heavy.sketch(fact, ["key"]), ["key"], 0.2).collect()
    merged = heavy.hitters(heavy.merge(parts, ["key"]), ["key"], 0.2).collect()
    assert whole == merged and [(r.value, r.n, r.rows) for r in whole] == [("hot", 10000, 20000)]


# Layouts ------------------------------------------------------------------------------------------


def test_bucketed_fact_is_not_shuffled(unadapted, tmp_path):
    star = skewed(unadapted, 3000)
    laid = star.laid_out("d_", 4, str(tmp_path))
    joined = laid.bucketed_join("d_")
    assert "Exchange" not in plan(joined)
    assert "Exchange" not in plan(joined.groupBy("key").agg(F.max("d_id")))
    assert "Exchange" in plan(star.bucketed_join("d_"))
    assert sorted(map(str, joined.collect())) == sorted(map(str, star.join().collect()))


def test_partitions_are_pruned_by_value_and_by_another_table(spark, tmp_path):
    fact = spark.range(1000).select("id", (F.col("id") % 7).cast("int").alias("year"))
    table = files.partitioned(fact, "facts", ["year"], str(tmp_path), files=2)
    one = table.filter("year = 3")
    assert "year#" in plan(one).split("PartitionFilters: [")[1].split("]")[0]
    assert len(table.inputFiles()) == 7 and one.count() == 143  # small parts of a value share a file
    years = spark.createDataFrame([(y, y % 2 == 0) for y in range(7)], "y int, even boolean")
    met = table.join(years.filter("even AND y > 4"), F.col("year") == F.col("y"), "left_semi")
    assert "dynamicpruning" in plan(met) and met.count() == 142


@pytest.fixture
def small_parts(spark):
    """Adaptive execution with an advisory size of a few hundred rows."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "4k")
    yield spark
    spark.conf.set(name, before)


def test_a_large_value_is_written_by_several_tasks(small_parts, tmp_path):
    fact = small_parts.range(40000).repartition(8).select(
        F.xxhash64("id").alias("id"), F.when(F.col("id") % 40 > 0, 1995).alias("year"))
    table = files.partitioned(fact, "facts", ["year"], str(tmp_path))
    assert sorted(map(tuple, table.collect()), key=str) == sorted(map(tuple, fact.collect()), key=str)
    of_year = table.filter("year = 1995").groupBy(F.input_file_name()).count().collect()
    assert len(of_year) >= 6 and max(r["count"] for r in of_year) <= 39000 / 4


def test_a_large_bucket_is_written_by_several_tasks(small_parts, tmp_path):
    fact = small_parts.range(40000).repartition(8).select(
        F.xxhash64("id").alias("id"), F.when(F.col("id") % 40 > 0, "hot").alias("key"))
    table = files.bucketed(fact, "facts", ["key"], 4, str(tmp_path))
    assert sorted(map(tuple, table.collect()), key=str) == sorted(map(tuple, fact.collect()), key=str)
    of_key = table.filter("key = 'hot'").groupBy(F.input_file_name()).count().collect()
    assert len(of_key) >= 6 and max(r["count"] for r in of_key) <= 39000 / 4
    assert "Exchange" not in plan(table.groupBy("key").count())


def test_buckets_grow_with_the_table(spark):
    assert [files.buckets_for(spark.range(n), 4, rows=100) for n in (0, 400, 401, 5000)] == [4, 4, 5, 50]


def test_wide_places_are_spread_from_a_small_file(spark, tmp_path):
    customers = spark.range(2 * files.SPREAD_ROWS + 1).select(
        F.col("id").alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey"))
    customers.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    source = Source(spark, str(tmp_path))
    assert source.table("customer").rdd.getNumPartitions() == 1
    for name in ("clean_places", "clean_places_float"):
        cleaned = QUERIES[name](spark, str(tmp_path))
        parts = cleaned.groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) == 3 and max(r["count"] for r in parts) < files.SPREAD_ROWS
    chosen = ["communityname", "state", "population", "ViolentCrimesPerPop"]
    plain = cleaning.type_all(analogues.PLACES.frame(source.table))
    hashed = [df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*chosen).cast("decimal(38,0)"))).first()
              for df in (source.typed_places(), plain)]
    assert hashed[0] == hashed[1] and hashed[0][0] == customers.count()


def test_scalar_subquery_prunes_the_best_years_folder(spark, tmp_path):
    rows = [(datetime.datetime(2010 + i % 3, 1 + i % 4, 1), f"p{i % 5}", float(i % 3), i % 9)
            for i in range(200)]
    sales = spark.createDataFrame(rows, "InvoiceDate timestamp_ntz, Description string, UnitPrice double, "
                                        "Quantity int")
    stored = files.partitioned(sales.withColumn("year", F.year("InvoiceDate")), "sales", ["year"], str(tmp_path))
    best = retail.rq08_of_partitions(stored)
    assert best.collect() == retail.rq08_best_product_of_best_year(sales).collect()
    assert "scalar-subquery" in plan(best) or "Subquery" in plan(best)
    assert any("ubquery" in p.split("]")[0] for p in plan(best).split("PartitionFilters: [")[1:])


# Aggregates that add up -----------------------------------------------------------------------------


@pytest.mark.parametrize("policy", ["zero", "skip"])
def test_correlations_of_all_pairs(spark, policy):
    rows = [(i % 2, float(i), None if i % 5 == 0 else i * i % 17 + 0.5, None if i % 7 == 0 else -i % 13, 4)
            for i in range(100)]
    df = spark.createDataFrame(rows, "part int, a double, b double, c int, same int")
    columns = ["a", "b", "c", "same"]
    found = {(r.a, r.b): r.corr for r in moments.correlations(moments.moments(df, columns, policy)).collect()}
    read = df.fillna(0.0).fillna(0) if policy == "zero" else df
    for (a, b), value in found.items():
        if "same" in (a, b):
            assert value is None
        else:
            expected = read.dropna(subset=[a, b]).agg(F.corr(a, b)).first()[0]
            assert math.isclose(value, expected, abs_tol=1e-9)
    parts = moments.moments(df, columns, policy, ["part"])
    merged = {(r.a, r.b): r.corr for r in moments.correlations(moments.merge(parts)).collect()}
    assert merged.keys() == found.keys() and all(
        merged[k] == found[k] or math.isclose(merged[k], found[k], abs_tol=1e-9) for k in found)


def test_correlations_of_nothing(spark):
    none = spark.createDataFrame([], "a double, b double")
    assert [(r.n, r.corr) for r in moments.correlations(moments.moments(none, ["a", "b"])).collect()] == [(0, None)]


def test_distinct_counts_add_up(spark, tmp_path):
    df = spark.range(5000).select(
        (F.col("id") % 3).alias("region"), (F.col("id") % 2).alias("day"),
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("v"), F.col("id") * 7 % 1234)).alias("value"))
    numbers = files.handoff(distinct.dictionary(df, "value"), "numbers", str(tmp_path))
    used = [r.number for r in numbers.collect()]
    assert len(set(used)) == len(used) == df.select("value").distinct().count() - 1
    assert min(used) >= 1 and max(used) < 2 * len(used) + 64 * 20
    days = [distinct.bitmaps(df.filter(F.col("day") == d), "value", numbers, ["region"]) for d in (0, 1)]
    parts = days[0].unionByName(days[1])
    exact = {r.region: r.n for r in df.groupBy("region").agg(F.count_distinct("value").alias("n")).collect()}
    assert {r.region: r.n for r in distinct.count(parts, ["region"]).collect()} == exact
    assert distinct.count(parts).first().n == df.agg(F.count_distinct("value")).first()[0]


def test_profiles_of_batches_add_up(spark):
    rows = [("M", "F"), ("M", None), ("I", "x"), ("F", "F")]
    df = spark.createDataFrame(rows, "qa_a string, qa_b string")
    halves = [spark.createDataFrame(part, df.schema) for part in (rows[:1], rows[1:])]
    merged = profile.merge_counts(*map(profile.label_counts, halves))
    assert sorted(map(str, merged.select("label", "column", "position", "n").collect())) == sorted(
        map(str, profile.label_counts(df).select("label", "column", "position", "n").collect()))


# Schemas ------------------------------------------------------------------------------------------


def test_schema_differences(spark):
    df = spark.createDataFrame([(1, None, "x")], "code int, alt int, more string")
    found = {r.column: (r.declared, r.actual, r.nulls, r.status)
             for r in schemas.differences(df, PLACE, ["alt", "lat"]).collect()}
    assert found == {"code": ("string", "int", None, "type"), "alt": ("int", "int", 1, "null"),
                     "lat": ("float", None, None, "missing"), "more": (None, "string", None, "extra")}
    assert tuple(schemas.conform(df, PLACE).first()) == ("1", None, None)
    with pytest.raises(Exception):
        schemas.conform(spark.createDataFrame([("1x",)], "alt string"), PLACE).collect()
