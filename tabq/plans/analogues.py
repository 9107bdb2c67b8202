"""Stand-ins for the course tables, derived from the order-entry tables.

The retail, census, communities and flight files are not available, so each is imitated by a
projection of tables that are. The expressions are plain SQL that Spark and other engines read the
same way. Dirt (missing, malformed and out-of-range values) follows from remainders of the keys, so
it grows with the data and is the same on every run.

A table joins only what the requested columns need, and keeps rows without a match.
"""

from pyspark.sql import functions as F

from tabq.sources import schemas


def pick(index, values):
    """A list lookup as a CASE; None is NULL."""
    branches = " ".join(f"WHEN {i} THEN {_literal(v)}" for i, v in enumerate(values))
    return f"CASE ({index}) % {len(values)} {branches} END"


def dirty(key, modulus, wrong, clean):
    """Wrong values at some remainders of the key, else the clean value."""
    branches = " ".join(f"WHEN {r} THEN {_literal(v)}" for r, v in wrong.items())
    return f"CASE {key} % {modulus} {branches} ELSE {clean} END"


def _literal(v):
    if v is None:
        return "NULL"
    return "'" + v + "'" if isinstance(v, str) else str(v)


def _whole(expression):
    return f"CAST({expression} AS INT)"


def _text(expression):
    return f"CAST({expression} AS STRING)"


def _two_digits(expression):
    return f"substr({_text(f'100 + {expression}')}, 2)"


def airport_code(key):
    """A unique code per key: three digits or letters while there are fewer than 1000."""
    digits = f"CASE WHEN {key} < 1000 THEN substr({_text(f'1000 + {key}')}, 2) ELSE {_text(key)} END"
    letters = f"translate({digits}, '0123456789', 'ABCDEFGHIJ')"
    return f"CASE WHEN {key} = 7 THEN 'PDX' WHEN {key} % 4 = 0 THEN {letters} ELSE {digits} END"


class Analogue:
    """Columns as expressions, each with the joined table it reads (None: the base table)."""

    def __init__(self, base, joins, columns):
        self.base = base
        self.joins = joins
        self.columns = columns

    def frame(self, tables, columns=None):
        """``tables`` is a function from a table name to a DataFrame."""
        columns = list(self.columns) if columns is None else list(columns)
        df = tables(self.base)
        for table in self._needed(columns):
            other, left, right = self.joins[table]
            df = df.join(tables(table), F.col(left) == F.col(right), "left")
        return df.selectExpr([f"{self.columns[c][0]} AS `{c}`" for c in columns])

    def sql(self):
        """The whole table as ANSI SQL."""
        joins = " ".join(f"LEFT JOIN {t} ON {l} = {r}" for t, (_, l, r) in self.joins.items())
        listed = ", ".join(f'{e} AS "{c}"' for c, (e, _) in self.columns.items())
        return f"SELECT {listed} FROM {self.base} {joins}"

    def _needed(self, columns):
        """The joins the columns ask for, with the joins those need, in their listed order."""
        needed, todo = set(), [self.columns[c][1] for c in columns]
        while todo:
            table = todo.pop()
            if table not in (None, self.base) and table not in needed:
                needed.add(table)
                todo.append(self.joins[table][0])
        return [t for t in self.joins if t in needed]


# Retail -----------------------------------------------------------------------------------------

_HOUR, _MINUTE = "l_orderkey % 24", "l_orderkey % 60"
_DAY = (
    f"{_text('day(o_orderdate)')} || '/' || {_text('month(o_orderdate)')} || '/' || "
    f"{_text('year(o_orderdate)')} || ' '"
)

SALES = Analogue(
    "lineitem",
    {
        "orders": ("lineitem", "l_orderkey", "o_orderkey"),
        "customer": ("orders", "o_custkey", "c_custkey"),
        "nation": ("customer", "c_nationkey", "n_nationkey"),
        "part": ("lineitem", "l_partkey", "p_partkey"),
    },
    {
        "InvoiceNo": (
            f"CASE l_orderkey % 50 WHEN 7 THEN 'C' || {_text('l_orderkey + 100000')} "
            f"WHEN 11 THEN '' WHEN 13 THEN 'A' || {_text('10000 + l_orderkey % 90000')} "
            f"ELSE {_text('l_orderkey + 100000')} END",
            None,
        ),
        "StockCode": (
            "CASE WHEN l_partkey % 100 = 17 THEN 'gift_0001_' || "
            f"{_text('l_partkey % 30')} WHEN l_partkey % 100 = 29 THEN 'PADS' "
            "WHEN l_partkey % 100 = 41 THEN NULL WHEN l_partkey % 100 = 45 THEN '' "
            "WHEN l_partkey % 100 = 51 THEN 'ABCDE' WHEN l_partkey % 100 = 59 THEN '1234A' "
            f"WHEN l_partkey % 10 = 3 THEN {_text('l_partkey + 10000')} || 'S' "
            f"WHEN l_partkey % 10 = 4 THEN {_text('l_partkey + 10000')} || 'M' "
            f"WHEN l_partkey % 10 = 5 THEN '0' || {_text('1000 + l_partkey % 9000')} "
            f"ELSE {_text('l_partkey + 10000')} END",
            None,
        ),
        "Description": (dirty("p_partkey", 40, {9: "", 19: None, 29: "lost  "}, "p_name"), "part"),
        "Quantity": (
            "CASE WHEN l_linenumber = 7 AND l_orderkey % 5 = 0 THEN '' "
            "WHEN l_partkey % 90 = 31 THEN 'x' "
            f"WHEN l_orderkey % 50 = 7 THEN '-' || {_text(_whole('l_quantity'))} "
            f"ELSE {_text(_whole('l_quantity'))} END",
            None,
        ),
        "InvoiceDate": (
            f"CASE WHEN l_orderkey % 37 = 5 THEN '' "
            f"WHEN l_orderkey % 41 = 3 THEN {_DAY} || {_text(_HOUR)} || ':' || "
            f"{_two_digits(_MINUTE)} "
            f"ELSE {_DAY} || {_two_digits(_HOUR)} || ':' || {_two_digits(_MINUTE)} END",
            "orders",
        ),
        "UnitPrice": (
            "CASE WHEN l_partkey % 60 = 7 THEN '  ' "
            f"WHEN l_orderkey % 50 = 9 THEN '-' || {_text('l_extendedprice')} "
            f"WHEN l_linenumber % 2 = 0 THEN replace({_text('l_extendedprice')}, '.', ',') "
            f"ELSE {_text('l_extendedprice')} END",
            None,
        ),
        "CustomerID": (
            "CASE o_custkey % 10 WHEN 3 THEN NULL WHEN 5 THEN '' "
            f"WHEN 7 THEN {_text('o_custkey % 10000')} ELSE {_text('o_custkey + 10000')} END",
            "orders",
        ),
        "Country": (dirty("c_custkey", 25, {4: "", 14: None}, "n_name"), "nation"),
    },
)


# Census -----------------------------------------------------------------------------------------

# Domains of the census columns; the files put a blank before each.
WORKCLASSES = [" Private", " Self-emp-not-inc", " Self-emp-inc", " Federal-gov", " Local-gov",
               " State-gov", " Without-pay", " Never-worked", " ?"]
EDUCATIONS = [" Bachelors", " Some-college", " 11th", " HS-grad", " Prof-school", " Assoc-acdm",
              " Assoc-voc", " 9th", " 7th-8th", " 12th", " Masters", " 1st-4th", " 10th",
              " Doctorate", " 5th-6th", " Preschool"]
MARITAL = [" Married-civ-spouse", " Divorced", " Never-married", " Separated", " Widowed",
           " Married-spouse-absent", " Married-AF-spouse"]
OCCUPATIONS = [" Tech-support", " Craft-repair", " Other-service", " Sales", " Exec-managerial",
               " Prof-specialty", " Handlers-cleaners", " Machine-op-inspct", " Adm-clerical",
               " Farming-fishing", " Transport-moving", " Priv-house-serv", " Protective-serv",
               " Armed-Forces", " ?"]
RELATIONSHIPS = [" Wife", " Own-child", " Husband", " Not-in-family", " Other-relative",
                 " Unmarried"]
RACES = [" White", " Asian-Pac-Islander", " Amer-Indian-Eskimo", " Other", " Black"]

_CENTS = _whole("floor(abs(c_acctbal) * 100)")

PEOPLE = Analogue(
    "customer",
    {"nation": ("customer", "c_nationkey", "n_nationkey")},
    {
        "age": (_whole("17 + c_custkey % 73"), None),
        "workclass": (pick(f"{_CENTS} + c_nationkey", WORKCLASSES), None),
        "fnlwgt": ("CAST(12285 + c_custkey % 100000 AS FLOAT)", None),
        "education": (pick(f"{_CENTS} * 7 + c_custkey", EDUCATIONS), None),
        "education-num": (
            dirty("c_custkey", 31, {5: None}, _whole("1 + c_custkey % 16")), None),
        "marital-status": (dirty("c_custkey", 67, {8: None}, pick(f"{_CENTS} + 3", MARITAL)), None),
        "occupation": (pick(f"{_CENTS} * 11 + c_nationkey * 3", OCCUPATIONS), None),
        "relationship": (pick("c_custkey * 5", RELATIONSHIPS), None),
        "race": (pick("n_regionkey", RACES), "nation"),
        "sex": (dirty("c_custkey", 53, {3: " ?", 4: None},
                      f"CASE WHEN {_CENTS} % 3 = 0 THEN ' Female' ELSE ' Male' END"), None),
        "capital-gain": ("CAST(c_custkey % 9999 AS FLOAT)", None),
        "capital-loss": ("CAST(0 AS FLOAT)", None),
        "hours-per-week": (
            dirty("c_custkey", 47, {6: None}, f"CAST({_CENTS} % 99 + 1 AS FLOAT)"), None),
        "native-country": (dirty("c_custkey", 43, {7: " ?"}, "' ' || n_name"), "nation"),
        "income": ("CASE WHEN c_acctbal > 4000 THEN ' >50K' ELSE ' <=50K' END", None),
    },
)


# Communities ------------------------------------------------------------------------------------


def _share(i):
    """A number from 0.0 to 1.0 as text, with gaps; every column has its own pattern."""
    number = _text(f"CAST((c_custkey * {2 * i + 3} + c_nationkey * {i}) % 101 AS DOUBLE) / 100")
    if i % 5 == 1:  # not the shares that are compared with each other
        number = f"CASE WHEN c_custkey % 5 < 3 THEN '?' ELSE {number} END"
    return dirty(f"(c_custkey + {i})", 61, {9: None, 19: "", 29: "?", 39: "1", 49: "0.5 "}, number)


_PLACE_COLUMNS = {
    "state": (_text("1 + (CAST(floor(c_custkey / 40) AS BIGINT) + c_custkey % 3) % 50"), None),
    "county": (dirty("c_custkey", 3, {1: "?"}, _text("c_custkey % 300")), None),
    "community": (dirty("c_custkey", 97, {1: "?"}, _text("c_custkey % 90000")), None),
    "communityname": (
        f"'Place' || {_text('CAST(floor(c_custkey / 40) AS BIGINT)')} || 'city'", None),
    "fold": (_text("1 + c_custkey % 10"), None),
}

PLACES = Analogue(
    "customer",
    {"nation": ("customer", "c_nationkey", "n_nationkey")},
    {
        c: _PLACE_COLUMNS.get(c, (_share(i), None))
        for i, c in enumerate(schemas.COMMUNITIES.fieldNames())
    },
)


# Flights ----------------------------------------------------------------------------------------

_MILES = "50 + (l_partkey * 13) % 2950"

FLIGHTS = Analogue(
    "lineitem",
    {},
    {
        c: (e, None)
        for c, e in {
            "year": dirty("l_orderkey", 97, {5: None, 6: 1949}, _whole("year(l_shipdate)")),
            "month": dirty("l_orderkey", 89, {7: None, 8: 13}, _whole("month(l_shipdate)")),
            "day": dirty("l_orderkey", 83, {9: None, 10: 32, 11: 30}, _whole("day(l_shipdate)")),
            "dep_time": dirty("l_orderkey", 79, {3: None, 4: 2512, 5: 45},
                              _whole("(l_orderkey % 24) * 100 + l_partkey % 60")),
            "dep_delay": dirty("l_partkey", 71, {2: None, 4: 240},
                               _whole("l_quantity - 15 + l_linenumber")),
            "arr_time": dirty("l_orderkey", 73, {3: None, 4: 1275, 5: 999},
                              _whole("((l_orderkey + 2) % 24) * 100 + l_partkey % 60")),
            "arr_delay": dirty("l_partkey", 71, {3: None, 4: 260}, _whole("l_quantity - 22")),
            "carrier": dirty("l_orderkey", 67, {1: None, 2: "AAA", 3: ""},
                             "l_returnflag || l_linestatus"),
            "tailnum": dirty("l_partkey", 61, {1: None, 2: "X12AB", 3: "I12AB", 4: "XABCD",
                                               5: "N12 B", 6: ""}, f"'N' || {_text('l_partkey')}"),
            "flight": dirty("l_orderkey", 59, {1: None}, _whole("l_orderkey % 5000")),
            "origin": dirty("l_orderkey", 53, {1: None, 2: "A1", 3: "__!"},
                            airport_code("l_suppkey")),
            "dest": dirty("l_orderkey", 4700, {48: None}, dirty(
                "l_orderkey", 4700, {2: "ABCD", 3: "__!"},
                airport_code("CAST(floor(l_suppkey / (1 + l_linenumber % 3)) AS BIGINT)"))),
            "air_time": dirty("l_orderkey", 41, {1: None, 2: 19, 3: 501},
                              _whole(f"floor(({_MILES}) / 10) + 5 + l_orderkey % 40")),
            "distance": dirty("l_orderkey", 43, {1: None, 2: 49, 3: 3001}, _whole(_MILES)),
            "hour": dirty("l_orderkey", 37, {1: None, 2: 25, 3: -1, 4: 123},
                          _whole("l_orderkey % 24")),
            "minute": dirty("l_orderkey", 31, {1: None, 2: 61, 3: 5}, _whole("l_partkey % 60")),
        }.items()
    },
)

_AIRPORT_NAMES = [" Airport", " Intl", " Muni Field", " Regional Airport", " AERODROME", " Airpark",
                  " Afb", " NAS", " Heliport", " City Arpt", " County Fld", " Natl", " Strip",
                  " LRRS Base", " MetroMetropolitan", " Aero Park"]


def _airports(code, name, lat, lon, alt, tz):
    return Analogue(
        "supplier",
        {},
        {
            "faa": (code, None),
            "name": (name, None),
            "lat": (f"CAST({lat} AS FLOAT)", None),
            "lon": (f"CAST({lon} AS FLOAT)", None),
            "alt": (_whole(alt), None),
            "tz": (f"CAST({tz} AS FLOAT)", None),
            "dst": (pick("s_suppkey", ["A", "U", "N", "34", "K", " ", None, "E", "S"]), None),
        },
    )


_NAME = f"'S' || {_text('s_suppkey')} || {pick('s_suppkey', _AIRPORT_NAMES)}"
_LAT = "(s_suppkey * 37 % 180) / 2.0 - 10"
_LON = "-10 - (s_suppkey * 53 % 320) / 2.0"
_ALT = "floor(s_acctbal)"
_TZ = "-5 - s_suppkey % 8"

AIRPORTS = _airports(airport_code("s_suppkey"), _NAME, _LAT, _LON, _ALT, _TZ)
AIRPORTS_DIRTY = _airports(
    dirty("s_suppkey", 29, {3: None, 4: "", 5: "A B", 6: "__!", 7: "1R", 8: "12345X"},
          airport_code("s_suppkey")),
    dirty("s_suppkey", 31, {3: None, 4: ""}, _NAME),
    dirty("s_suppkey", 23, {1: None, 2: 200.5, 3: 0.0001, 4: 0.0}, _LAT),
    dirty("s_suppkey", 19, {1: None, 2: -200.5, 3: 0.0001}, _LON),
    dirty("s_suppkey", 17, {1: None}, _ALT),
    dirty("s_suppkey", 13, {1: None, 2: 14.0}, _TZ),
)

# Domains of the plane columns, with wrong ones among them.
_TYPES = ["Fixed wing multi engine", "fixed wing single engine", "Rotorcraft", "Glider", None, ""]
_MAKERS = ["AIRBUS", "BOEING", "AIRBUS INDUSTRIE", "CANADAIR", "BOMBARDIER", "MCDONNELL DOUGLAS",
           "BOEING%", "CESSNA", "ACME", None, "", "BARKER JACK"]
_MODELS = ["A320", "320", "737", "A320", "CL-600", "MD-88", "DC 9", None, "DC-9", "", "747", "A319",
           "A320"]
_ENGINES = ["Turbo-fan", "Turbo-jet", "Turbo-prop", "Turbo-shaft", "4 Cycle", "Reciprocating",
            "Turbo-fan%", None, ""]
_TAIL = f"'N' || {_text('p_partkey')}"


def _planes(tail):
    return Analogue(
        "part",
        {},
        {
            "tailnum": (tail, None),
            "year": (dirty("p_partkey", 41, {1: None}, _whole("1940 + p_partkey % 75")), None),
            "type": (pick("p_partkey", _TYPES), None),
            "manufacturer": (pick("p_partkey + p_size", _MAKERS), None),
            "model": (pick("p_partkey", _MODELS), None),
            "engines": (dirty("p_partkey", 23, {1: None}, _whole("p_size % 6")), None),
            "seats": (dirty("p_partkey", 29, {1: None, 2: 1}, _whole("p_size * 12")), None),
            "speed": (dirty("p_partkey", 31, {1: None}, _whole("p_size * 4")), None),
            "engine": (pick("p_partkey + 2 * p_size", _ENGINES), None),
        },
    )


PLANES = _planes(_TAIL)
PLANES_DIRTY = _planes(
    dirty("p_partkey", 61, {1: None, 2: "X12AB", 3: "I12AB", 4: "XABCD", 5: "N12 B", 6: "",
                            7: "012AB"}, _TAIL)
)
