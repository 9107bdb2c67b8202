"""Common table expressions: the stand-in tables, typed tables and the star."""

import re

from tabq.plans import analogues


def missing(c):
    return f"({c} IS NULL OR CAST({c} AS VARCHAR) = '')"


def blank(c):
    return f"({missing(c)} OR regexp_matches(CAST({c} AS VARCHAR), '[\t ]'))"


def empty(c):
    return f"({missing(c)} OR regexp_matches(CAST({c} AS VARCHAR), '[\t ]+$'))"


def any_word(c, words):
    return "(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ")"


def classes(c, pairs, default="'NaN'"):
    branches = " ".join(f"WHEN {any_word(c, words)} THEN '{name}'" for name, words in pairs)
    return f"CASE {branches} ELSE {default} END"


def float_text(c):
    """Floats as Spark writes them; only one stand-in value needs an exponent."""
    return f"CASE WHEN {c} = CAST(0.0001 AS FLOAT) THEN '1.0E-4' ELSE CAST({c} AS VARCHAR) END"


WHOLE = "CASE WHEN regexp_matches({0}, '^ *[-+]?[0-9]+$') THEN CAST({0} AS INT) END"


def price(dtype):
    return (
        f"CASE WHEN {empty('UnitPrice')} OR contains(UnitPrice, '-') THEN 0.0::DOUBLE "
        f"ELSE CAST(TRY_CAST(replace(UnitPrice, ',', '.') AS {dtype}) AS DOUBLE) END"
    )


QUANTITY = f"CASE WHEN {empty('Quantity')} THEN 0 ELSE {WHOLE.format('Quantity')} END"
DATE = (
    "CASE WHEN regexp_matches(InvoiceDate, '^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} [0-9]{2}:[0-9]{2}$') "
    "THEN strptime(InvoiceDate, '%d/%m/%Y %H:%M') END"
)


def typed_sales(dtype="FLOAT"):
    return (
        f"SELECT InvoiceNo, StockCode, Description, {QUANTITY} AS Quantity, "
        f"{DATE} AS InvoiceDate, {price(dtype)} AS UnitPrice, CustomerID, Country "
        "FROM raw_sales WHERE StockCode <> 'PADS'"
    )


def typed_number(c, dtype="DOUBLE"):
    usable = f"NOT {empty(c)} AND {c} <> '?'"
    return f"CASE WHEN {usable} THEN TRY_CAST({c} AS {dtype}) END"


PLACE_NAMES = list(analogues.PLACES.columns)


def typed_places(dtype="DOUBLE"):
    return ", ".join(
        c if c == "communityname" else f"{typed_number(c, dtype)} AS {c}" for c in PLACE_NAMES
    )


TYPED_PLACES = f"SELECT {typed_places()} FROM raw_places"

AIRPORT_WORDS = [
    ("AP", ["Airport", "Tradeport", "Heliport", "Airpor", "Arpt"]),
    ("AD", ["AERODROME"]),
    ("AS", ["Airpark", "Aero Park"]),
    ("FL", ["Field", "Fld"]),
]
# Words in the names of military fields.
MILITARY = ["Base", "Aaf", "AFs", "Ahp", "Afb", "LRRS", "Lrrs", "Arb", "Naf", "NAS", "Nas", "Jrb",
            "Ns", "As", "Cgas", "Angb"]


def administration(regional):
    return [
        ("I", ["International", "Intl", "Intercontinental"]),
        ("N", ["National", "Natl"]),
        ("R", ["Regional", "Reigonal", "Rgnl", "County", *regional]),
        ("M", ["Municipal", "Muni", "City"]),
    ]


def region(lon="lon", lat="lat"):
    return (
        f"CASE WHEN {lon} < -124 THEN 'ALASKA' WHEN {lon} > -50 OR {lat} < 24 THEN 'OFFSHORE' "
        f"WHEN {lon} <= -95 THEN 'MAINLAND-WEST' WHEN {lon} > -95 THEN 'MAINLAND-EAST' "
        "ELSE 'NaN' END"
    )


def _padded(c):
    return f"lpad(CAST({c} AS VARCHAR), 2, '0')"


DERIVED = f"""
    CASE WHEN hour BETWEEN 0 AND 23 AND minute BETWEEN 0 AND 59 THEN TRY_CAST(
        CAST(year AS VARCHAR) || '-' || {_padded('month')} || '-' || {_padded('day')} || ' ' ||
        {_padded('hour')} || ':' || {_padded('minute')} || ':00' AS TIMESTAMP)
    END AS dep_datetime,
    CASE WHEN air_time <= 180 THEN 'SHORT-HAUL' WHEN air_time <= 360 THEN 'MEDIUM-HAUL'
         WHEN air_time > 360 THEN 'LONG-HAUL' END AS haul_duration,
    CASE WHEN month IN (12, 1, 2) THEN 'WINTER' WHEN month IN (3, 4, 5) THEN 'SPRING'
         WHEN month IN (6, 7, 8) THEN 'SUMMER' WHEN month IN (9, 10, 11) THEN 'AUTUMN'
    END AS dep_season,
    CASE WHEN dep_delay <= 0 THEN 'ON TIME' WHEN dep_delay <= 15 THEN 'MINOR'
         WHEN dep_delay <= 60 THEN 'MAJOR' WHEN dep_delay > 60 THEN 'SEVERE'
    END AS dep_delay_category
"""

VIEWS = {
    "raw_sales": analogues.SALES.sql(),
    "people": analogues.PEOPLE.sql(),
    "raw_places": analogues.PLACES.sql(),
    "flights": analogues.FLIGHTS.sql(),
    "airports": analogues.AIRPORTS.sql(),
    "dirty_airports": analogues.AIRPORTS_DIRTY.sql(),
    "planes": analogues.PLANES.sql(),
    "dirty_planes": analogues.PLANES_DIRTY.sql(),
    "sales": typed_sales(),
    "places": TYPED_PLACES,
    "derived": f"SELECT *, {DERIVED} FROM flights",
    "located": f"SELECT *, CAST(greatest(alt, 0) AS DOUBLE) AS height, {region()} AS region FROM airports",
    "trips": """
        SELECT f.*, a.region AS air_region, a.height AS air_alt, a.name AS air_name,
               b.region AS air2_region, b.height AS air2_alt, b.name AS air2_name,
               p.model AS pl_model, p.seats AS pl_seats, p.engines AS pl_engines
        FROM derived f LEFT JOIN located a ON f.origin = a.faa LEFT JOIN located b ON f.dest = b.faa
        LEFT JOIN planes p ON f.tailnum = p.tailnum""",
}
# Views that read other views, in dependency order.
_NEEDS = {
    "sales": ["raw_sales"],
    "places": ["raw_places"],
    "derived": ["flights"],
    "located": ["airports"],
    "trips": ["flights", "derived", "airports", "located", "planes"],
}


def with_views(sql, extra=None):
    """Put the views a statement mentions in front of it; ``extra`` adds views of its own."""
    extra = extra or {}
    text = sql + " ".join(extra.values())
    wanted = []
    for name in VIEWS:
        if re.search(rf"\b{name}\b", text):
            wanted += [*_NEEDS.get(name, []), name]
    parts = [f"{n} AS ({VIEWS[n]})" for n in dict.fromkeys(wanted)]
    parts += [f"{n} AS ({v})" for n, v in extra.items()]
    return f"WITH {', '.join(parts)} {sql}"
