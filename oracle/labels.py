"""Label rules as CASE expressions, and the profiles built on them."""

from oracle.views import PLACE_NAMES, any_word, blank, empty, float_text, missing, with_views
from tabq.plans.registry import DIRTY_AIRPORTS

# Known makers, words for engines, kinds of daylight saving.
MAKERS = ["AIRBUS", "BOEING", "BOMBARDIER", "CESSNA", "EMBRAER", "SIKORSKY", "CANADAIR", "PIPER",
          "MCDONNELL DOUGLAS", "CIRRUS", "BELL", "KILDALL GARY", "LAMBERT RICHARD", "BARKER JACK",
          "ROBINSON HELICOPTER", "GULFSTREAM", "MARZ BARRY"]
DST = ["E", "A", "S", "O", "Z", "N", "U"]
ENGINE_WORDS = ["Turbo-fan", "Turbo-jet", "Turbo-prop", "Turbo-shaft", "Cycle"]


def case(*branches, rest="NULL"):
    return "CASE " + " ".join(f"WHEN {c} THEN '{l}'" for c, l in branches) + f" ELSE {rest} END"


def txt(c):
    return f"CAST({c} AS VARCHAR)"


def found(c, pattern):
    return f"regexp_matches({c}, '{pattern}')"


def in_list(c, values):
    return f"{c} IN ({', '.join(repr(v) for v in values)})"


def degrees(c, variant, as_text, number):
    wide = f"{number} > 180 OR {number} < -180"
    if variant == "sql":
        key = "faa = ''" if c == "lat" else "FALSE"
        return case((f"{c} IS NULL OR {key}", "M"), (wide, "I"), rest=as_text)
    if variant == "rdd" and c == "lat":
        decimal = "^([1-9][0-9]*[.,][0-9]*|0?[.,][0-9]*[1-9][0-9]*|[1-9][0-9]*)$"
        return case((f"{c} IS NULL OR {c} = 0", "M"), (f"NOT {found(as_text, decimal)}", "A"),
                    rest=as_text)
    ranged = [(wide, "I")] if variant == "intended" else []
    return case((blank(as_text), "M"), *ranged, (found(as_text, "[a-zA-Z ]"), "A"), rest=as_text)


def airports(variant, raw=False):
    digit_free = f"NOT {found('faa', '[0-9]')}"
    if variant == "sql":
        short = f"({digit_free} AND length(faa) BETWEEN 3 AND 5)"
        faa = case((missing("faa"), "M"), (f"{found('faa', '^[a-zA-Z ]*$')} OR {short}", "F"),
                   rest="faa")
        name = case(("name IS NULL OR faa = ''", "M"), rest="name")
        dst = case((missing("dst"), "M"), (f"NOT {in_list('dst', DST)}", "C"))
    else:
        bad = digit_free
        if variant == "intended":
            bad += " OR NOT length(faa) BETWEEN 3 AND 5"
        faa = case((blank("faa"), "M"), (bad, "F"), rest="faa")
        if variant == "rdd":
            faa = case((missing("faa"), "M"), (found("faa", "[0-9a-zA-Z]"), "F"), rest="faa")
        key = "FALSE" if variant == "rdd" else "coalesce(regexp_matches(faa, '[\t ]'), FALSE)"
        name = case((f"{missing('name')} OR {key}", "M"), rest="name")
        dst = case((blank("dst"), "M"), (found("dst", "^[0-9]*$"), "N"),
                   (f"NOT {in_list('dst', DST)}", "C"), rest="dst")
    number = (lambda c: f"TRY_CAST({c} AS DOUBLE)") if raw else (lambda c: c)
    shown = txt if raw else float_text
    alt_letters = [] if variant == "sql" else [(found(txt("alt"), "[a-zA-Z ]"), "A")]
    alt_gap = missing("alt") if variant == "sql" else blank("alt")
    alt = case((alt_gap, "M"), (f"{number('alt')} < 0", "I"), *alt_letters, rest=txt("alt"))
    beyond = (f"{number('tz')} <= -11 OR {number('tz')} >= 14", "I")
    tz_ranged = [beyond] if variant in ("sql", "intended") else []
    tz_letters = [] if variant == "sql" else [(found(shown("tz"), "[a-zA-Z ]"), "A")]
    tz = case((blank(shown("tz")), "M"), *tz_ranged, *tz_letters, rest=shown("tz"))
    return {
        "qa_faa": faa,
        "qa_name": name,
        "qa_lat": degrees("lat", variant, shown("lat"), number("lat")),
        "qa_lon": degrees("lon", variant, shown("lon"), number("lon")),
        "qa_alt": alt,
        "qa_tz": tz,
        "qa_dst": dst,
    }


def tail_number(variant):
    sql = variant == "sql"
    return case(
        (missing("tailnum") if sql else blank("tailnum"), "M"),
        ("length(tailnum) <> 5", "S"),
        ("tailnum[1] <> 'N' AND NOT regexp_matches(substr(tailnum, 2, 4), '[0-9]')", "F"),
        ("tailnum[1] IN ('I', 'O', '0')", "FE"),
        (f"tailnum[1] <> '{'I' if sql else 'N'}'", "FN"),
        rest="tailnum",
    )


def planes(variant):
    sql, meant = variant == "sql", variant == "intended"
    types = ["Fixed wing multi engine", "fixed wing single engine", "Rotorcraft"]
    type_gap = missing("type") if sql else empty("type") if meant else blank("type")
    if variant == "rdd":
        maker = f"CASE WHEN {any_word('manufacturer', MAKERS)} THEN manufacturer ELSE 'M' END"
    else:
        listed = {"AIRBUS": "%AIRBUS%", "LAMBERT RICHARD": "LAMBERT RICHARD%"}
        wrong = any_word("manufacturer", [m + "%" for m in MAKERS])
        if sql:
            wrong = f"NOT {in_list('manufacturer', [listed.get(m, m) for m in MAKERS])}"
        if meant:
            wrong = f"NOT {any_word('manufacturer', MAKERS)}"
        maker = case((missing("manufacturer"), "M"), (wrong, "C"), rest="manufacturer")
    canadair = "manufacturer IN ('BOMBARDIER', 'CANADAIR')"
    douglas = "manufacturer = 'MCDONNELL DOUGLAS'"
    if meant:
        canadair += " AND model[1:2] <> 'CL'"
        douglas += " AND model[1:2] NOT IN ('MD', 'DC')"
    model = case(
        (missing("model") if sql else blank("model"), "M"),
        ("manufacturer = 'AIRBUS' AND model[1] <> 'A'", "F"),
        ("manufacturer = 'BOEING' AND model[1] <> '7'", "F"),
        (canadair, "F"),
        (douglas, "F"),
        rest="model",
    )

    def sized(c, low, high):
        digits = [] if sql or meant else [(found(txt(c), "[0-9]"), "F")]
        return case((f"{c} IS NULL", "M"), (f"{c} < {low} OR {c} > {high}", "S"), *digits,
                    rest=txt(c))

    wrong_engine = any_word("engine", [w + "%" for w in ENGINE_WORDS])
    if sql:
        wrong_engine = "engine NOT IN ('Turbo-fan', 'Turbo-jet', 'Turbo-prop', '4 Cycle')"
    if meant:
        wrong_engine = f"NOT {any_word('engine', ENGINE_WORDS)}"
    return {
        "qa_tailnum": tail_number(variant),
        "qa_year": case(("year IS NULL", "M"), ("year < 1950", "I"), rest=txt("year")),
        "qa_type": case((type_gap, "M"), (f"NOT {in_list('type', types)}", "C"), rest="type"),
        "qa_manufacturer": maker,
        "qa_model": model,
        "qa_engines": case(("engines IS NULL", "M"),
                           ("engines < 1 OR engines > 4", "S" if sql else "I"),
                           rest=txt("engines")),
        "qa_seats": sized("seats", 2, 500),
        "qa_speed": sized("speed", 50, 150),
        "qa_engine": case((missing("engine"), "M"), (wrong_engine, "C"), rest="engine"),
    }


def flights(variant):
    sql = variant == "sql"
    carrier = case((missing("carrier"), "M"), ("length(carrier) <> 2", "F"), rest="carrier")
    date = case(
        ("year IS NULL", "MY"), ("month IS NULL", "MM"), ("day IS NULL", "MD"),
        ("year < 1950", "IY"), ("month NOT BETWEEN 1 AND 12", "IM"),
        ("day NOT BETWEEN 1 AND CASE WHEN month = 2 THEN 29 ELSE 31 END", "ID"),
    )

    def piece(c, start, size):
        return f"TRY_CAST(substr({txt(c)}, {start}, {size}) AS INT)"

    def of_length(c, n, condition):
        return f"(length({txt(c)}) = {n} AND ({condition}))"

    def beyond(value, high):
        return f"{value} < 0 OR {value} > {high}"

    hour = case(
        ("hour IS NULL", "MH"), ("minute IS NULL", "MM"),
        (f"{of_length('hour', 1, beyond(piece('hour', 1, 1), 24))} OR "
         f"{of_length('hour', 2, beyond(piece('hour', 1, 2), 24))}", "IH"),
        (f"{of_length('minute', 1, beyond(piece('hour', 2, 3), 9))} OR "
         f"{of_length('minute', 2, beyond(piece('hour', 3, 4), 59))}", "IM"),
    )
    if variant == "intended":
        hour = case(("hour IS NULL", "MH"), ("minute IS NULL", "MM"),
                    ("hour NOT BETWEEN 0 AND 24", "IH"), ("minute NOT BETWEEN 0 AND 59", "IM"))
    times = case(
        ("dep_time IS NULL", "MD"), ("arr_time IS NULL", "MA"),
        (f"{of_length('dep_time', 3, beyond(piece('dep_time', 1, 1), 24))} OR "
         f"{of_length('dep_time', 4, beyond(piece('dep_time', 1, 2), 24))}", "FD"),
        (f"{of_length('arr_time', 3, beyond(piece('arr_time', 2, 3), 59))} OR "
         f"{of_length('arr_time', 4, beyond(piece('arr_time', 3, 4), 59))}", "FA"),
    )

    def bad_code(c):
        size = f"length({c}) <> 3"
        return size if sql else f"NOT {found(c, '[A-Za-z]|[0-9]{3}')} OR {size}"

    four = [] if sql else [(f"NOT {found(txt('flight'), '[0-9]{4}')}", "F")]
    return {
        "qa_year_month_day": date,
        "qa_hour_minute": carrier if sql else hour,
        "qa_dep_arr_time": carrier if sql else times,
        "qa_dep_arr_delay": case(("dep_delay IS NULL", "MD"), ("arr_delay IS NULL", "MA")),
        "qa_carrier": carrier,
        "qa_tailnum": tail_number(variant),
        "qa_flight": case(("flight IS NULL", "M"), *four, rest=txt("flight")),
        "qa_origin_dest": case(
            (missing("origin"), "M" if sql else "MO"), (missing("dest"), "M" if sql else "MD"),
            (bad_code("origin"), "FO"), (bad_code("dest"), "FD")),
        "qa_air_time": case(("air_time IS NULL", "M"), ("air_time NOT BETWEEN 20 AND 500", "I"),
                            rest=txt("air_time")),
        "qa_distance": case(("distance IS NULL", "M"), ("distance NOT BETWEEN 50 AND 3000", "I"),
                            rest=txt("distance")),
        "qa_airtime": case(
            ("air_time IS NULL", "M"),
            ("air_time >= CAST(distance AS DOUBLE) * CAST(0.1 AS DOUBLE) + 30", "TL"),
            ("air_time <= CAST(distance AS DOUBLE) * CAST(0.1 AS DOUBLE) + 10", "TS"),
            ("distance IS NOT NULL", "TR")),
    }


def sales(variant):
    meant = variant == "intended"
    whole = f"CASE WHEN {found('StockCode', '^[0-9]+$')} THEN {txt('CAST(StockCode AS INT)')} END"
    invoice = case((empty("InvoiceNo"), "M"), ("length(InvoiceNo) <> 6", "S"),
                   (f"NOT {found('InvoiceNo', '[0-9]{6}')}", "F"), rest="InvoiceNo")
    customer = case((empty("CustomerID"), "M"), ("length(CustomerID) = 5", "S"))
    if meant:
        invoice = case((empty("InvoiceNo"), "M"),
                       (f"NOT {found('InvoiceNo', '^[cC]?[0-9]{6}$')}", "F"), rest="InvoiceNo")
        customer = case((empty("CustomerID"), "M"), ("length(CustomerID) <> 5", "S"),
                        (f"NOT {found('CustomerID', '[0-9]')}", "x"), rest="CustomerID")
    return {
        "qa_InvoiceNo": invoice,
        "qa_StockCode": case((empty("StockCode"), "M"), ("length(StockCode) <> 5", "S"),
                             (f"NOT {found('StockCode', '[0-9]')}", "F"), rest=whole),
        "qa_Description": case((empty("Description"), "M"), rest="Description"),
        "qa_Quantity": case((empty("Quantity"), "M"), (f"NOT {found('Quantity', '[0-9]')}", "F"),
                            rest="Quantity"),
        "qa_UnitPrice": case((empty("UnitPrice"), "M"), ("contains(UnitPrice, '-')", "I"),
                             rest="UnitPrice"),
        "qa_CustomerID": customer,
        "qa_Country": case((empty("Country"), "M"), rest="Country"),
    }


def places():
    return {
        f"qa_{c}": case((empty(c), "MN"), (f"{c} = '?'", "M"), rest=c) for c in PLACE_NAMES
    }


TABLES = {
    "airports": (airports, "dirty_airports", ("df", "sql", "rdd", "intended"), "a"),
    "planes": (planes, "dirty_planes", ("df", "sql", "rdd", "intended"), "p"),
    "flights": (flights, "flights", ("df", "sql", "intended"), "f"),
    "sales": (sales, "raw_sales", ("df", "intended"), "r"),
}


def listed(columns, prefix=""):
    return ", ".join(f'{e} AS "{prefix}{c}"' for c, e in columns.items())


def text_airports():
    """The dirty rows in front of the airports, all text."""
    columns = ["faa", "name", "lat", "lon", "alt", "tz", "dst"]

    def quoted(v):
        return "NULL" if v is None else f"'{v}'"

    rows = ", ".join("(" + ", ".join(map(quoted, r)) + ")" for r in DIRTY_AIRPORTS)
    shown = [float_text(c) if c in ("lat", "lon", "tz") else txt(c) for c in columns]
    return (
        f"SELECT * FROM (VALUES {rows}) AS t({', '.join(columns)}) "
        f"UNION ALL SELECT {', '.join(shown)} FROM dirty_airports"
    )


def labelled_star():
    """Fact and dimensions with labels, under the names of the joined star."""
    tables = {
        "fl": ("flights", flights("df")),
        "air": ("airports", airports("df")),
        "pl": ("planes", planes("df")),
    }
    return {
        f"labelled_{p}": f"SELECT *, {listed(rules)} FROM {t}" for p, (t, rules) in tables.items()
    }


STAR_COLUMNS = {
    "fl": "year month day dep_time dep_delay arr_time arr_delay carrier tailnum flight origin dest "
          "air_time distance hour minute".split() + list(flights("df")),
    "air": "faa name lat lon alt tz dst".split() + list(airports("df")),
    "air2": "faa name lat lon alt tz dst".split() + list(airports("df")),
    "pl": "tailnum year type manufacturer model engines seats speed engine".split()
          + list(planes("df")),
}
STAR = (
    "SELECT {} FROM labelled_fl fl LEFT JOIN labelled_air air ON fl.origin = air.faa "
    "LEFT JOIN labelled_air air2 ON fl.dest = air2.faa "
    "LEFT JOIN labelled_pl pl ON fl.tailnum = pl.tailnum"
)


def star_cells(only_labels=False):
    """(alias, column) of every joined column in order."""
    cells = [(a, c) for a, columns in STAR_COLUMNS.items() for c in columns]
    return [(a, c) for a, c in cells if not only_labels or "qa_" in c]


def melted(cells):
    """The joined star as (position, column, value) rows."""
    values = ", ".join(
        f"{{'position': {i}, 'column': '{a}_{c}', 'value': {txt(f'{a}.{c}')}}}"
        for i, (a, c) in enumerate(cells)
    )
    return STAR.format(f"unnest([{values}]) AS cell")


def star_counts(labels, only_labels=False):
    cells = star_cells(only_labels)
    extra = {**labelled_star(), "melted": melted(cells)}
    counts = " UNION ALL ".join(
        f"SELECT '{l}' AS label, cell['column'] AS \"column\", "
        "CAST(cell['position'] AS INT) AS position, "
        f"count(*) FILTER (WHERE cell['value'] = '{l}') AS n FROM melted GROUP BY ALL"
        for l in labels
    )
    return counts, extra


def worst(label):
    counts, extra = star_counts([label], True)
    sql = f'SELECT "column", n FROM ({counts}) WHERE n > 0 ORDER BY n DESC, position LIMIT 1'
    return with_views(sql, extra)


def statements():
    result = {}
    for table, (rules, view, variants, letter) in TABLES.items():
        for variant in variants:
            suffix = "" if variant == "df" else f"_{variant}"
            sql = f"SELECT {listed(rules(variant))} FROM {view}"
            result[f"label_{table}{suffix}"] = with_views(sql)
        for i, e in enumerate(rules("df").values(), 1):
            sql = f"SELECT {e} AS label, count(*) AS n FROM {view} GROUP BY 1"
            result[f"qa_{letter}{i}"] = with_views(sql)
    raw = {"text_airports": text_airports()}
    result["label_airports_raw_text"] = with_views(
        f"SELECT {listed(airports('df', raw=True))} FROM text_airports", raw
    )
    result["label_places_all_columns"] = with_views(f"SELECT {listed(places())} FROM raw_places")
    delay = f"coalesce({flights('df')['qa_dep_arr_delay']}, 'M')"
    result["qa_f12"] = with_views(
        f"SELECT {delay} AS qa_dep_arr_delay, count(*) AS n FROM flights GROUP BY 1"
    )
    result["profile_label_counts"] = with_views(*star_counts("MFIST"))
    flight_labels = list(flights("df"))
    result["profile_label_counts_flights"] = with_views(
        " UNION ALL ".join(
            f"SELECT '{l}' AS label, '{c}' AS \"column\", {i} AS position, "
            f"count(*) FILTER (WHERE {c} = '{l}') AS n FROM labelled"
            for l in "MFIST"
            for i, c in enumerate(flight_labels)
        ),
        {"labelled": f"SELECT {listed(flights('df'))} FROM flights"},
    )
    for label in "MFI":
        result[f"profile_worst_{label.lower()}"] = worst(label)
    result["profile_self_name"] = with_views(
        "SELECT cell['column'] AS \"column\", "
        "starts_with(cell['value'], cell['column']) AS starts, count(*) AS n "
        "FROM melted GROUP BY 1, 2",
        {**labelled_star(), "melted": melted(star_cells(True))},
    )
    result["profile_row_counts"] = with_views(
        "SELECT 'trips' AS \"table\", count(*) AS n FROM trips "
        "UNION ALL SELECT 'airports', count(*) FROM airports"
    )
    dst = airports("df")["qa_dst"]
    result["profile_value_json"] = with_views(
        "SELECT faa, dst, qa_dst, concat_ws(',', dst, qa_dst) AS concat, CASE "
        """WHEN dst IS NULL THEN '{"' || qa_dst || '":1}' """
        """WHEN dst = qa_dst THEN '{"' || dst || '":2}' """
        """ELSE '{"' || dst || '":1,"' || qa_dst || '":1}' END AS counts """
        f"FROM (SELECT faa, dst, {dst} AS qa_dst FROM dirty_airports)"
    )
    cells = ", ".join(f"{{'column': 'qa_{c}', 'value': {e}}}" for c, e in
                      zip(PLACE_NAMES, places().values()))
    result["profile_frequency"] = with_views(
        "SELECT cell['column'] AS \"column\", CASE WHEN cell['value'] IN ('M', 'MN', 'F', 'I', 'S', 'T', "
        "'A', 'C', 'N') THEN cell['value'] ELSE 'passed' END AS value, count(*) AS n "
        f"FROM (SELECT unnest([{cells}]) AS cell FROM raw_places) GROUP BY 1, 2"
    )
    return result
