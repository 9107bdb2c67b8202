import datetime

import pytest
from pyspark.sql import functions as F

from tabq.functions import convert, patterns, predicates, strings
from tabq.plans import cleaning

DIRTY = [
    (None, None, None, None, None, None, None),
    ("", "", "", "", "", "", ""),
    ("   ", None, "12O.12", "-80.Aa6195833", "1044Aa", "-2x", "34"),
    ("222", None, None, "-80.Aa6195833", "-100", "-14", "K"),
    ("AAA", "City Field", "45.0", "-100.0", "12", "-6", "U"),
]
AIRPORT_TEXT = "faa string, name string, lat string, lon string, alt string, tz string, dst string"


def values(df, column):
    return [r[column] for r in df.collect()]


def column_of(spark, rows, expression, type="string"):
    df = spark.createDataFrame([(r,) for r in rows], f"x {type}")
    return values(df.select(expression.alias("y")), "y")


def test_clamp_altitude(spark):
    df = spark.createDataFrame(DIRTY, AIRPORT_TEXT)
    assert values(cleaning.clamp_altitude(df), "alt") == ["M", "M", "1044Aa", "0", "12"]
    assert values(cleaning.clamp_altitude(df, empty=""), "alt") == ["", "", "1044Aa", "0", "12"]
    numeric = cleaning.clamp_altitude(df, "numeric")
    assert values(numeric, "alt") == [None, None, None, 0.0, 12.0]


def test_dst(spark):
    df = spark.createDataFrame(DIRTY, AIRPORT_TEXT)
    assert values(cleaning.dst_from_timezone(df), "dst") == [None, "", "34", "K", "A"]
    assert values(cleaning.dst_unknown_to_a(df), "dst") == [None, "", "34", "K", "A"]


@pytest.mark.parametrize("lon, lat, expected", [
    (-150.0, 61.0, "ALASKA"), (-40.0, 30.0, "OFFSHORE"), (-100.0, 20.0, "OFFSHORE"),
    (-95.0, 40.0, "MAINLAND-WEST"), (-80.0, 40.0, "MAINLAND-EAST"), (None, 40.0, "NaN"),
    (None, 20.0, "OFFSHORE"), (None, None, "NaN"),
])
def test_region(spark, lon, lat, expected):
    df = spark.createDataFrame([(lon, lat)], "lon float, lat float")
    assert values(cleaning.region(df), "region") == [expected]


def test_names(spark):
    names = ["X Airport", "X AERODROME", "X Airpark", "X Fld", "X", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert values(cleaning.facility_type(df), "type") == ["AP", "AD", "AS", "FL", "NaN", "NaN"]
    flagged = cleaning.military(spark.createDataFrame([("X Afb",), ("X",), (None,)], "name string"))
    assert values(flagged, "military") == [True, False, False]
    assert values(cleaning.only_military(flagged), "name") == ["X Afb"]
    names = ["A International", "A Natl", "A County", "A Muni", "A Metro", "MetroMetropolitan", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    plain = values(cleaning.administration(df), "administration")
    assert plain == ["I", "N", "R", "M", "NaN", "R", "NaN"]
    meant = values(cleaning.administration(df, intended=True), "administration")
    assert meant == ["I", "N", "R", "M", "R", "R", "NaN"]


def test_money_and_quantity(spark):
    prices = ["2,55", "-1", "", "3.5", None, "x", "1,2,3"]
    assert column_of(spark, prices, convert.money("x")) == [
        2.549999952316284, 0.0, 0.0, 3.5, 0.0, None, None]
    assert column_of(spark, ["2,55"], convert.money("x", "double")) == [2.55]
    counts = ["3", "", None, "-2", "x", "2.9", "99999999999"]
    assert column_of(spark, counts, convert.quantity("x")) == [3, 0, 0, -2, None, 2, None]


def test_hours_do_not_depend_on_the_zone(spark):
    df = spark.createDataFrame([("27/3/2011 01:30",)], "x string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Europe/London"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert df.select(F.hour(convert.date_time("x"))).first()[0] == 1
            made = F.try_make_timestamp_ntz(*map(F.lit, (2011, 3, 27, 1, 30)), F.lit(0))
            assert df.select(F.hour(made)).first()[0] == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_date_time(spark):
    dates = ["1/12/2010 08:26", "1/12/2010 8:26", "", None, "31/2/2010 08:26", "text"]
    assert column_of(spark, dates, convert.date_time("x")) == [
        datetime.datetime(2010, 12, 1, 8, 26), None, None, None, None, None]


def test_type_all(spark):
    df = spark.createDataFrame(
        [("?", "a city", "0.19", "?"), ("8", "?", " ", "x"), (None, None, "5", "y")],
        "state string, communityname string, share string, qa_share string")
    assert [tuple(r) for r in cleaning.type_all(df).collect()] == [
        (None, "a city", 0.19, "?"), (8.0, "?", None, "x"), (None, None, 5.0, "y")]
    single = values(cleaning.type_all(df, dtype="float"), "share")
    assert single[0] != 0.19 and abs(single[0] - 0.19) < 1e-8


@pytest.mark.parametrize("shares, expected", [
    ((0.5, 0.2, 0.1, 0.1), "Black"), ((0.1, 0.5, 0.2, 0.1), "Caucasian"),
    ((0.1, 0.2, 0.5, 0.1), "Asian"), ((0.1, 0.2, 0.1, 0.5), "Hisp"),
    ((0.4, 0.4, 0.1, 0.1), None), ((0.5, None, 0.1, 0.1), None),
])
def test_dominant(spark, shares, expected):
    names = ", ".join(f"{c} double" for c in cleaning.RACE_SHARES.values())
    df = spark.createDataFrame([shares], names)
    assert values(cleaning.dominant_race(df), "max_pctRace") == [expected]


def test_people_flags(spark):
    df = spark.createDataFrame(
        [(" Self-emp-not-inc", " Married-AF-spouse"), ("Self-emp-inc", " Divorced"),
         (" Self-emp-inc", None)], "workclass string, `marital-status` string")
    assert values(cleaning.self_employed(df), "self-employed") == [
        "self-employed", None, "self-employed"]
    assert values(cleaning.married(df), "married_status") == [
        "married", "not_married", "not_married"]


def test_flight_columns(spark):
    df = spark.createDataFrame(
        [(2014, 2, 28, 13, 45, 180, 0), (2014, 2, 30, 1, 1, 181, 15), (2014, 13, 1, 1, 1, 400, 61),
         (None, None, None, None, None, None, None)],
        "year int, month int, day int, hour int, minute int, air_time int, dep_delay int")
    rows = cleaning.derive_flight_columns(df).collect()
    assert [r.dep_datetime for r in rows] == [
        datetime.datetime(2014, 2, 28, 13, 45), None, None, None]
    assert [r.haul_duration for r in rows] == ["SHORT-HAUL", "MEDIUM-HAUL", "LONG-HAUL", None]
    assert [r.dep_season for r in rows] == ["WINTER", "WINTER", None, None]
    assert [r.dep_delay_category for r in rows] == ["ON TIME", "MINOR", "SEVERE", None]


def test_clean_sales_drops_rows_and_labels_raw_text(spark):
    columns = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
               "CustomerID", "Country"]
    rows = [("536365", "71053", "d", "6", "1/12/2010 08:26", "2,50", "17850", "UK"),
            ("536365", "PADS", "d", "6", "1/12/2010 08:26", "2,50", "17850", "UK"),
            ("536365", None, "d", "6", "1/12/2010 08:26", "2,50", "17850", "UK")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    row, = cleaning.clean_sales(df).collect()
    assert (row.qa_UnitPrice, row.UnitPrice, row.Quantity) == ("2,50", 2.5, 6)


def test_predicates(spark):
    texts = [None, "", "abc ", "a c", "abc", "\t"]
    assert column_of(spark, texts, predicates.is_empty("x")) == [
        True, True, True, False, False, True]
    assert column_of(spark, texts, F.expr(predicates.is_empty_sql("x"))) == [
        True, True, True, False, False, True]
    assert column_of(spark, texts, predicates.is_blank("x")) == [
        True, True, True, True, False, True]
    assert column_of(spark, [1, 2, 3], predicates.in_range("x", 1, 3), "int") == [
        False, True, False]
    assert column_of(spark, [1, 2, 3], predicates.in_range("x", 1, 3, True), "int") == [
        True, True, False]
    assert column_of(spark, [1, 2, 3], predicates.in_range("x", 1, 3, True, True), "int") == [
        True, True, True]
    words = ["it's", "b\\c"]
    assert column_of(spark, ["it's", "b\\c", "d", None], predicates.contains_any("x", words)) == [
        True, True, False, None]
    assert column_of(spark, ["xab", "c"], F.col("x").rlike(patterns.any_of(["a", "b"]))) == [
        True, False]


def test_strings(spark):
    assert column_of(spark, ["N12AB", "12", None], strings.without_digits_and_first("x")) == [
        "AB", "", None]
    assert column_of(spark, ["xboeing", "y"], strings.captured("x", "(boe)")) == ["BOE", ""]
    assert column_of(spark, ["A", "BC", None], strings.known_or("x", ["B"])) == ["M", "BC", "M"]
    assert column_of(spark, ["a,b", "c", None], strings.occurrences_json("x", "x")) == [
        '{"a":2,"b":2}', '{"c":2}', '{"":1}']
