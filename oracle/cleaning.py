"""Expectations, cleaning, joins, scalar functions and aggregates."""

from oracle.labels import MAKERS, airports, flights, listed, places, sales, text_airports, txt
from oracle.views import (
    AIRPORT_WORDS,
    DATE,
    MILITARY,
    QUANTITY,
    administration,
    any_word,
    blank,
    classes,
    empty,
    missing,
    price,
    region,
    typed_places,
    with_views,
)
from tabq.plans.analogues import PEOPLE

PEOPLE_COLUMNS = list(PEOPLE.columns)


def people_checks():
    """One row per check over the people table; the last column is not there."""
    rows = []
    for c in [*PEOPLE_COLUMNS, "no-such-column"]:
        present = c in PEOPLE_COLUMNS
        rows.append(
            f"SELECT '{c}' AS \"column\", 'to_exist' AS expectation, {present} AS success, "
            "NULL::BIGINT AS element_count, NULL::BIGINT AS unexpected_count, "
            "NULL::DOUBLE AS unexpected_percent"
        )
        if not present:
            continue
        for kind, bad in (
            ("not_null", f'"{c}" IS NULL'),
            ("not_match", f"""contains(CAST("{c}" AS VARCHAR), '?')"""),
        ):
            n = f"count(*) FILTER (WHERE {bad})"
            rows.append(
                f"SELECT '{c}', '{kind}', {n} = 0, count(*), {n}, "
                f"round({n} * 100.0::DOUBLE / count(*), 6) FROM people"
            )
    return " UNION ALL ".join(rows)


REPORT = """
SELECT "column", CASE WHEN bool_and(success) THEN 'PASSED' ELSE 'FAILED' END AS status,
  CASE WHEN bool_or(NOT success AND expectation = 'to_exist') THEN 'column is missing'
    WHEN bool_or(NOT success AND expectation = 'not_null') THEN
      max(CASE WHEN expectation = 'not_null'
          THEN unexpected_count || ' of ' || element_count || ' values are NULL' END)
    WHEN bool_or(NOT success) THEN
      max(CASE WHEN expectation = 'not_match'
          THEN unexpected_count || ' values look unknown, ' ||
               format('{:.1f}', unexpected_percent) || '% of all' END)
  END AS reason
FROM checks GROUP BY 1
"""

STAR = """
SELECT f.origin AS fl_origin, f.dest AS fl_dest, f.tailnum AS fl_tailnum,
       f.distance AS fl_distance, air_name, air2_name, pl_model FROM trips f
"""

CLAMPED = (
    f"CASE WHEN alt < 0 THEN '0' WHEN alt IS NULL THEN 'M' ELSE {txt('alt')} END AS alt"
)


def number(c):
    return f"TRY_CAST({c} AS DOUBLE)"


CLEAN_TEXT_AIRPORTS = f"""
SELECT faa, name, lat, lon,
  CASE WHEN {number('alt')} < 0 THEN '0' WHEN {empty('alt')} THEN 'M' ELSE alt END AS alt, tz,
  CASE WHEN {number('tz')} BETWEEN -7 AND -5 OR dst = 'U' THEN 'A' ELSE dst END AS dst,
  {region(number('lon'), number('lat'))} AS region,
  {classes('name', AIRPORT_WORDS)} AS type,
  coalesce({any_word('name', MILITARY)}, FALSE) AS military,
  {classes('name', administration(['MetroMetropolitan']))} AS administration
FROM text_airports
"""

MARRIED = (
    """CASE WHEN regexp_matches("marital-status", 'Married-(civ-spouse|AF|spouse-absent)') """
    "THEN 'married' ELSE 'not_married' END"
)
SELF_EMPLOYED = (
    "CASE WHEN contains(workclass, 'Self-emp-not-inc') OR contains(workclass, ' Self-emp-inc') "
    "THEN 'self-employed' END"
)
SHARES = {"Black": "racepctblack", "Caucasian": "racePctWhite", "Asian": "racePctAsian",
          "Hisp": "racePctHisp"}


def dominant():
    branches = " ".join(
        f"WHEN {' AND '.join(f'{c} > {o}' for o in SHARES.values() if o != c)} THEN '{name}'"
        for name, c in SHARES.items()
    )
    return f"CASE {branches} END"


PREDICATES = {
    "empty": empty("UnitPrice"),
    "blank": blank("Description"),
    "missing": missing("StockCode"),
    "is_null": "StockCode IS NULL",
    "is_not_null": "StockCode IS NOT NULL",
    "contains": "UnitPrice LIKE '%,%'",
    "starts": "StockCode LIKE 'gift%'",
    "ends": "StockCode LIKE '%S'",
    "like": "StockCode LIKE 'PADS'",
    "not_like": "StockCode NOT LIKE 'PADS'",
    "in_list": "StockCode IN ('PADS', 'ABCDE')",
    "not_in_list": "StockCode NOT IN ('PADS', 'ABCDE')",
    "any_word": "Description LIKE '%bolt%' OR Description LIKE '%ring%'",
    "any_pattern": "regexp_matches(Description, 'bolt|r.ng')",
    "alpha": "regexp_matches(StockCode, '[a-zA-Z]')",
    "integer": "regexp_matches(StockCode, '[0-9]')",
    "float": "regexp_matches(UnitPrice, '[0-9]\\.[0-9]')",
    "alphanum": "regexp_matches(StockCode, '[0-9a-zA-Z]')",
    "special": "regexp_matches(StockCode, '[!@#$%&*()_]')",
    "both": "StockCode LIKE 'gift%' AND UnitPrice LIKE '%-%'",
    "either": "StockCode LIKE '%S' OR StockCode LIKE '%M'",
}


def counted(conditions):
    return ", ".join(f'count(*) FILTER (WHERE {c}) AS "{n}"' for n, c in conditions.items())


def sales_columns():
    """Typed columns next to the labels of the raw text."""
    typed = {
        "InvoiceNo": "InvoiceNo",
        "StockCode": "StockCode",
        "Description": "Description",
        "Quantity": QUANTITY,
        "InvoiceDate": f"strftime({DATE}, '%Y-%m-%d %H:%M')",
        "UnitPrice": price("FLOAT"),
        "CustomerID": "CustomerID",
        "Country": "Country",
    }
    return listed({**typed, **sales("df")})


def grouped(columns, key, view="flights"):
    return f"SELECT {columns}, count(*) AS n FROM {view} GROUP BY {key}"


TOP_CARRIERS = grouped("origin, carrier", "1, 2")


def corr(a, b, zero):
    if zero:
        a, b = f"coalesce({a}, 0)", f"coalesce({b}, 0)"
    return f"round(corr({b}, {a}), 6) AS corr"


def statements():
    raw = {"text_airports": text_airports()}
    q = {
        "expect_people": people_checks(),
        "clamp_altitude": f"SELECT faa, {CLAMPED} FROM dirty_airports",
        "clamp_altitude_numeric":
            "SELECT faa, CASE WHEN alt IS NOT NULL THEN CAST(greatest(alt, 0) AS DOUBLE) END "
            "AS alt FROM dirty_airports",
        "dst_from_timezone":
            "SELECT faa, tz, CASE WHEN tz BETWEEN -7 AND -5 THEN 'A' ELSE dst END AS dst "
            "FROM dirty_airports",
        "dst_unknown_to_a":
            "SELECT faa, CASE WHEN dst = 'U' THEN 'A' ELSE dst END AS dst FROM dirty_airports",
        "enrich_places_region": f"SELECT faa, lat, lon, {region()} AS region FROM dirty_airports",
        "classify_names":
            f"SELECT faa, name, {classes('name', AIRPORT_WORDS)} AS type FROM dirty_airports",
        "flag_military":
            f"SELECT faa, name, coalesce({any_word('name', MILITARY)}, FALSE) AS military "
            "FROM dirty_airports",
        "only_military":
            "SELECT faa, name, TRUE AS military FROM dirty_airports "
            f"WHERE {any_word('name', MILITARY)}",
        "administration":
            f"SELECT faa, name, {classes('name', administration(['MetroMetropolitan']))} "
            "AS administration FROM dirty_airports",
        "administration_intended":
            f"SELECT faa, name, {classes('name', administration(['Metro', 'Metropolitan']))} "
            "AS administration FROM dirty_airports",
        "clean_sales": f"SELECT {sales_columns()} FROM raw_sales WHERE StockCode <> 'PADS'",
        "clean_sales_double":
            f"SELECT StockCode, {price('DOUBLE')} AS UnitPrice, {QUANTITY} AS Quantity "
            "FROM raw_sales WHERE StockCode <> 'PADS'",
        "clean_places": f"SELECT {typed_places()}, {listed(places())} FROM raw_places",
        "clean_places_float": f"SELECT {typed_places('FLOAT')} FROM raw_places",
        "flag_self_employed":
            f'SELECT workclass, {SELF_EMPLOYED} AS "self-employed", count(*) AS n '
            "FROM people GROUP BY 1, 2",
        "flag_married":
            f'SELECT "marital-status", {MARRIED} AS married_status, count(*) AS n '
            "FROM people GROUP BY 1, 2",
        "dominant_share":
            f"SELECT communityname, {', '.join(SHARES.values())}, {dominant()} AS \"max_pctRace\" "
            "FROM places",
        "derive_trip_columns":
            "SELECT strftime(dep_datetime, '%Y-%m-%d %H:%M') AS dep_datetime, haul_duration, "
            "dep_season, dep_delay_category FROM derived",
        "star_trips": STAR,
        "star_trips_salted": STAR,
        "role_playing_airports":
            "SELECT DISTINCT origin AS fl_origin, dest AS fl_dest, air_region, air2_region "
            "FROM trips",
        "predicates_on_text": f"SELECT {counted(PREDICATES)} FROM raw_sales",
        "patterns_on_codes":
            "SELECT " + counted({
                "tail_number":
                    "regexp_matches(tailnum, '^N[1-9][0-9]{2,3}([A-HJ-NP-Z]{1,2})')",
                "tail_number_invalid": "regexp_matches(tailnum, '(N0.*$)|(.*[IO].*)')",
                "clock": "dep_time // 100 BETWEEN 0 AND 23 AND dep_time % 100 BETWEEN 0 AND 59",
            }) + " FROM flights",
        "range_predicates":
            "SELECT " + counted({
                "open": "dep_delay > 0 AND dep_delay < 20",
                "low": "dep_delay >= 0 AND dep_delay < 20",
                "high": "dep_delay > 0 AND dep_delay <= 20",
                "closed": "dep_delay BETWEEN 0 AND 20",
            }) + " FROM flights",
        "scalar_text": f"""
            SELECT CAST(length(StockCode) AS INT) AS size, StockCode[2:4] AS middle,
                   replace(UnitPrice, ',', '.') AS point, StockCode || ' pcs' AS with_unit,
                   concat_ws('-', StockCode, Description) AS joined,
                   replace(Description, 'red', '') AS stripped,
                   format('{{:,.1f}}', CAST(CASE WHEN regexp_matches(Quantity, '^-?[0-9]+$')
                       THEN CAST(Quantity AS INT) END * 1000 AS DOUBLE)) AS formatted
            FROM raw_sales""",
        "scalar_dates_and_numbers": """
            SELECT CAST(year(InvoiceDate) AS INT) AS year, CAST(month(InvoiceDate) AS INT) AS month,
                   CAST(hour(InvoiceDate) AS INT) AS hour, CAST(ceil(UnitPrice) AS BIGINT) AS up,
                   round(UnitPrice) AS nearest,
                   round(CASE WHEN length(StockCode) > 0 THEN Quantity / length(StockCode) END, 4)
                       AS share,
                   CASE WHEN regexp_matches(StockCode, '^[0-9]+$') THEN CAST(StockCode AS INT) END
                       AS code
            FROM sales""",
        "udf_free_tail_characters":
            "SELECT tailnum, substr(regexp_replace(tailnum, '[0-9]', '', 'g'), 2) AS characters "
            "FROM dirty_planes",
        "udf_free_capture":
            "SELECT manufacturer, CASE WHEN manufacturer IS NOT NULL THEN "
            "upper(regexp_extract(manufacturer, '(air[a-z]+|boe)', 1, 'i')) END AS captured "
            "FROM dirty_planes",
        "udf_free_known_manufacturer":
            f"SELECT manufacturer, CASE WHEN {any_word('manufacturer', MAKERS)} "
            "THEN manufacturer ELSE 'M' END AS known FROM dirty_planes",
        "udf_free_occurrences": """
            SELECT tailnum, engine, type, '{' || list_aggregate(list_transform(
                list_filter(parts, lambda v, i: list_position(parts, v) = i),
                lambda v: '"' || v || '":' || len(list_filter(parts, lambda p: p = v))
            ), 'string_agg', ',') || '}' AS counts
            FROM (SELECT tailnum, engine, type,
                  string_split(concat_ws(',', tailnum, engine, type, engine), ',') AS parts
                  FROM dirty_planes)""",
        "sql_over_view":
            f"SELECT {airports('sql')['qa_tz']} AS qa_tz, count(*) AS n FROM dirty_airports "
            "GROUP BY 1",
        "aggregates_by_country": """
            SELECT Country, count(*) AS n, count(Quantity) AS n_quantity,
                   count(DISTINCT StockCode) AS codes, CAST(sum(Quantity) AS BIGINT) AS quantity,
                   round(avg(Quantity), 6) AS mean, max(Quantity) AS largest,
                   round(max(Quantity * UnitPrice), 2) AS largest_amount,
                   count(*) FILTER (WHERE Quantity < 0) AS returned,
                   CAST(sum(Quantity) + sum(length(StockCode)) AS BIGINT) AS sum_of_sums
            FROM sales GROUP BY 1""",
        "aggregates_global": """
            SELECT count(*) AS n, count(DISTINCT StockCode) AS codes,
                   CAST(sum(Quantity) AS BIGINT) AS quantity,
                   CAST(ceil(avg(Quantity)) AS BIGINT) AS mean_up,
                   format('{:,.1f}', CAST(sum(Quantity) AS DOUBLE)) AS shown
            FROM sales""",
        "top_k": """
            SELECT StockCode, CAST(sum(Quantity) AS BIGINT) AS quantity FROM sales GROUP BY 1
            ORDER BY 2 DESC NULLS LAST, 1 LIMIT 10""",
        "rank_formatted": """
            SELECT StockCode, format('{:,.2f}', max(UnitPrice)) AS shown FROM sales GROUP BY 1
            ORDER BY 2 DESC NULLS LAST, 1 LIMIT 10""",
        "rank_numeric": """
            SELECT StockCode, format('{:,.2f}', max(UnitPrice)) AS shown FROM sales GROUP BY 1
            ORDER BY max(UnitPrice) DESC NULLS LAST, 1 LIMIT 10""",
        "mode_per_group": """
            SELECT origin, carrier FROM (
              SELECT origin, carrier, row_number() OVER (
                  PARTITION BY origin ORDER BY count(carrier) DESC, carrier NULLS FIRST) AS place
              FROM flights GROUP BY 1, 2) WHERE place = 1""",
        "top_per_group":
            f"SELECT origin, carrier, n FROM (SELECT *, rank() OVER (PARTITION BY origin "
            f"ORDER BY n DESC) AS place FROM ({TOP_CARRIERS})) WHERE place = 1",
        "max_join_compat":
            f"SELECT c.origin, c.carrier, c.n, count(*) AS copies FROM ({TOP_CARRIERS}) c "
            f"JOIN (SELECT origin, max(n) AS m FROM ({TOP_CARRIERS}) GROUP BY 1) g ON c.n = g.m "
            "GROUP BY 1, 2, 3",
        "ratio":
            "SELECT round(count(*) FILTER (WHERE dep_delay > 0) / "
            "CAST(count(*) FILTER (WHERE dep_delay <= 0) AS DOUBLE), 6) AS ratio FROM flights",
        "corr_zero": f"SELECT {corr('air_time', 'distance', True)} FROM flights",
        "corr_skip": f"SELECT {corr('air_time', 'distance', False)} FROM flights",
    }
    result = {name: with_views(sql) for name, sql in q.items()}
    result["expect_people_report"] = with_views(REPORT, {"checks": people_checks()})
    result["union_test_rows"] = with_views("SELECT * FROM text_airports", raw)
    result["clean_airports_raw_text"] = with_views(CLEAN_TEXT_AIRPORTS, raw)
    return result
