"""Cleaning and enrichment steps, each a DataFrame-to-DataFrame function."""

from functools import reduce

from pyspark.sql import functions as F

from tabq.functions.convert import date_time, money, quantity, to_number
from tabq.functions.predicates import (
    as_column,
    contains_any,
    is_empty,
    is_empty_sql,
    quoted,
    text,
)
from tabq.operators.labels import label
from tabq.plans.rules import communities, retail

# Words that tell what an airport is.
AIRPORT_WORDS = ["Airport", "Tradeport", "Heliport", "Airpor", "Arpt"]
AERODROME_WORDS = ["AERODROME"]
AIRPARK_WORDS = ["Airpark", "Aero Park"]
FIELD_WORDS = ["Field", "Fld"]
MILITARY_WORDS = [
    "Base", "Aaf", "AFs", "Ahp", "Afb", "LRRS", "Lrrs", "Arb", "Naf", "NAS", "Nas", "Jrb", "Ns",
    "As", "Cgas", "Angb",
]
INTERNATIONAL_WORDS = ["International", "Intl", "Intercontinental"]
NATIONAL_WORDS = ["National", "Natl"]
REGIONAL_WORDS = ["Regional", "Reigonal", "Rgnl", "County"]
MUNICIPAL_WORDS = ["Municipal", "Muni", "City"]
SELF_EMPLOYED_WORDS = ["Self-emp-not-inc", " Self-emp-inc"]
MARRIED_WORDS = ["Married-civ-spouse", "Married-AF", "Married-spouse-absent"]

NO_CLASS = "NaN"


# Airports ---------------------------------------------------------------------------------------


def clamp_altitude(df, mode="text", empty="M"):
    """Raise negative altitudes to 0. In text mode empty values get a label, else they are NULL."""
    value = to_number("alt")
    if mode == "numeric":
        clamped = F.when(value < 0, F.lit(0.0)).otherwise(value)
    else:
        clamped = F.when(value < 0, F.lit("0")).when(is_empty("alt"), F.lit(empty))
        clamped = clamped.otherwise(text("alt"))
    return df.withColumn("alt", clamped)


def dst_from_timezone(df):
    """Zones -7 to -5 use class A."""
    zone = to_number("tz")
    return df.withColumn("dst", F.when(zone.between(-7, -5), "A").otherwise(F.col("dst")))


def dst_unknown_to_a(df):
    return df.withColumn("dst", F.when(F.col("dst") == "U", "A").otherwise(F.col("dst")))


def region(df):
    """Region from the coordinates; a missing longitude can still be OFFSHORE by latitude."""
    lon, lat = to_number("lon"), to_number("lat")
    return df.withColumn(
        "region",
        F.when(lon < -124, "ALASKA")
        .when((lon > -50) | (lat < 24), "OFFSHORE")
        .when(lon <= -95, "MAINLAND-WEST")
        .when(lon > -95, "MAINLAND-EAST")
        .otherwise(NO_CLASS),
    )


def classify(column, classes, default=NO_CLASS):
    """First class with one of its words in the named text column."""
    ladder = F
    for name, words in classes:
        ladder = ladder.when(contains_any(column, words), name)
    return ladder.otherwise(default)


def facility_type(df):
    classes = [
        ("AP", AIRPORT_WORDS),
        ("AD", AERODROME_WORDS),
        ("AS", AIRPARK_WORDS),
        ("FL", FIELD_WORDS),
    ]
    return df.withColumn("type", classify("name", classes))


def military(df):
    flag = F.coalesce(contains_any("name", MILITARY_WORDS), F.lit(False))
    return df.withColumn("military", flag)


def only_military(df):
    return df.filter(F.col("military"))


def administration(df, intended=False):
    """Who runs the airport. Two regional words were run together by a lost comma; ``intended``
    reads them apart."""
    joined = ["Metro", "Metropolitan"] if intended else ["MetroMetropolitan"]
    classes = [
        ("I", INTERNATIONAL_WORDS),
        ("N", NATIONAL_WORDS),
        ("R", REGIONAL_WORDS + joined),
        ("M", MUNICIPAL_WORDS),
    ]
    return df.withColumn("administration", classify("name", classes))


def clean_airports(df, altitude_mode="text"):
    return reduce(
        lambda d, step: step(d),
        [dst_from_timezone, dst_unknown_to_a, region, facility_type, military, administration],
        clamp_altitude(df, altitude_mode),
    )


# Flights ----------------------------------------------------------------------------------------

# Own choices: upper bounds in minutes. The source tables name these columns but not their rules.
HAULS = [("SHORT-HAUL", 180), ("MEDIUM-HAUL", 360)]
LONGEST_HAUL = "LONG-HAUL"
DELAYS = [("ON TIME", 0), ("MINOR", 15), ("MAJOR", 60)]
LONGEST_DELAY = "SEVERE"
SEASONS = [("WINTER", (12, 1, 2)), ("SPRING", (3, 4, 5)), ("SUMMER", (6, 7, 8)),
           ("AUTUMN", (9, 10, 11))]


def up_to(c, bounds, beyond):
    """Name of the first bound that is not exceeded; NULL stays NULL."""
    c = as_column(c)
    ladder = F
    for name, bound in bounds:
        ladder = ladder.when(c <= bound, name)
    return ladder.when(c.isNotNull(), beyond)


def season(month, seasons=SEASONS):
    ladder = F
    for name, months in seasons:
        ladder = ladder.when(as_column(month).isin(*months), name)
    return ladder


def derive_flight_columns(df, hauls=HAULS, delays=DELAYS, seasons=SEASONS):
    """Departure time, haul, season and delay class; NULL where the parts are missing or invalid."""
    parts = [to_number(c, "int") for c in ("year", "month", "day", "hour", "minute")]
    return df.withColumns(
        {
            "dep_datetime": F.try_make_timestamp_ntz(*parts, F.lit(0)),
            "haul_duration": up_to(to_number("air_time", "int"), hauls, LONGEST_HAUL),
            "dep_season": season(to_number("month", "int"), seasons),
            "dep_delay_category": up_to(to_number("dep_delay", "int"), delays, LONGEST_DELAY),
        }
    )


# Retail -----------------------------------------------------------------------------------------


def drop_value(df, column, value):
    """Keep rows whose value differs; NULL rows go too."""
    return df.filter(F.col(column) != value)


def type_sales(df, dtype="float"):
    """Typed UnitPrice, InvoiceDate and Quantity; columns the table does not have are skipped."""
    typed = {
        "UnitPrice": money("UnitPrice", dtype),
        "InvoiceDate": date_time("InvoiceDate"),
        "Quantity": quantity("Quantity"),
    }
    return df.withColumns({c: v for c, v in typed.items() if c in df.columns})


def clean_sales(df, variant="df", dtype="float"):
    """Filter, then label the raw text, then type it."""
    return type_sales(label(drop_value(df, "StockCode", "PADS"), retail.rules(variant)), dtype)


# Census -----------------------------------------------------------------------------------------


def self_employed(df):
    flag = F.when(contains_any("workclass", SELF_EMPLOYED_WORDS), "self-employed")
    return df.withColumn("self-employed", flag)


def married(df):
    flag = F.when(contains_any("marital-status", MARRIED_WORDS), "married")
    return df.withColumn("married_status", flag.otherwise("not_married"))


# Communities ------------------------------------------------------------------------------------


def type_all(df, keep=("communityname",), dtype="double"):
    """Type every column but the kept and the label ones; empty text and ``?`` are NULL.

    One projection, whatever the number of columns.
    """

    def typed(c):
        name = quoted(c)
        if c in keep or c.startswith("qa_"):
            return name
        usable = f"NOT {is_empty_sql(c)} AND {name} != '?'"
        return f"CASE WHEN {usable} THEN TRY_CAST({name} AS {dtype}) END AS {name}"

    return df.selectExpr([typed(c) for c in df.columns])


def clean_places(df, dtype="double"):
    return type_all(label(df, communities.rules(df.columns)), dtype=dtype)


def dominant(shares):
    """Name of the strictly greatest share; NULL on a tie for the top or if a share is NULL.

    ``shares`` maps a name to a column.
    """
    columns = [as_column(c) for c in shares.values()]
    top = F.greatest(*columns)
    at_top = reduce(lambda a, b: a + b, [(c == top).cast("int") for c in columns])
    ladder = F
    for name, c in zip(shares, columns):
        ladder = ladder.when((at_top == 1) & (c == top), name)
    return ladder


# Share columns and the names reported for them.
RACE_SHARES = {
    "Black": "racepctblack",
    "Caucasian": "racePctWhite",
    "Asian": "racePctAsian",
    "Hisp": "racePctHisp",
}


def dominant_race(df, output="max_pctRace"):
    return df.withColumn(output, dominant(RACE_SHARES))
