"""Files, layouts and aggregates that add up: the same tables and reports, said plainly."""

from itertools import combinations

from oracle import cleaning, labels, reports
from oracle.views import with_views

# The columns of the planes as text.
PLANES_AS_TEXT = ["tailnum", "year", "type", "manufacturer", "model", "engines", "seats", "speed", "engine"]
CORRELATED = ["population", "medIncome", "PctPolicWhite", "PolicOperBudg", "PolicBudgPerPop",
              "ViolentCrimesPerPop"]
_BAD_QUANTITY = "Quantity IS NOT NULL AND NOT regexp_full_match(Quantity, '[-+]?[0-9]+')"
_BAD_PRICE = "UnitPrice IS NOT NULL AND NOT regexp_full_match(UnitPrice, ' *[-+]?[0-9]+([.][0-9]+)? *')"
_FITTING = f"""SELECT Country, TRY_CAST(Quantity AS INT) AS Quantity, TRY_CAST(UnitPrice AS FLOAT) AS UnitPrice
  FROM raw_sales WHERE NOT ({_BAD_QUANTITY}) AND NOT ({_BAD_PRICE})"""


def correlations(zero):
    rows = []
    for a, b in combinations(CORRELATED, 2):
        x, y = (f"coalesce({c}, 0)" if zero else c for c in (a, b))
        n = "count(*)" if zero else f"count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
        rows.append(f"SELECT '{a}' AS a, '{b}' AS b, {n} AS n, round(corr({y}, {x}), 6) AS corr FROM places")
    return " UNION ALL ".join(rows)


def differences():
    def row(column, declared, actual, nulls, status):
        shown = [f"'{v}'" if v else "NULL::VARCHAR" for v in (declared, actual)]
        return (f"SELECT '{column}' AS \"column\", {shown[0]} AS declared, {shown[1]} AS actual, "
                f"{nulls} AS nulls, {status} AS status FROM dirty_planes")

    def counted(column, kind):
        nulls = f"count(*) FILTER (WHERE {column} IS NULL)"
        return row(column, kind, kind, nulls, f"CASE WHEN {nulls} > 0 THEN 'null' ELSE 'same' END")

    def plain(column, declared, actual, status):
        return row(column, declared, actual, "NULL::BIGINT", f"'{status}'") + " LIMIT 1"

    rows = [counted("tailnum", "string"), counted("engines", "int"),
            plain("year", "float", "int", "type"), plain("type", "string", "string", "same"),
            plain("model", "string", "string", "same"), plain("owner", "string", None, "missing"),
            plain("manufacturer", None, "string", "extra"), plain("seats", None, "int", "extra")]
    return " UNION ALL ".join(f"({r})" for r in rows)


def statements():
    q = {
        "csv_typed": "SELECT * FROM dirty_airports",
        "csv_landed": "SELECT * FROM raw_sales",
        "csv_header_only":
            "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in PLANES_AS_TEXT)
            + " FROM dirty_planes",
        "csv_quarantine": f"""
            SELECT InvoiceNo, StockCode, CASE WHEN NOT ({_BAD_QUANTITY}) THEN CAST(Quantity AS INT) END
                     AS Quantity,
                   CASE WHEN NOT ({_BAD_PRICE}) THEN CAST(UnitPrice AS FLOAT) END AS UnitPrice, Country,
                   concat_ws(', ', CASE WHEN {_BAD_QUANTITY} THEN 'Quantity' END,
                             CASE WHEN {_BAD_PRICE} THEN 'UnitPrice' END) AS reason
            FROM raw_sales WHERE {_BAD_QUANTITY} OR {_BAD_PRICE}""",
        "csv_accepted":
            "SELECT Country, count(*) AS n, CAST(sum(Quantity) AS BIGINT) AS quantity, "
            f"max(UnitPrice) AS highest FROM ({_FITTING}) GROUP BY 1",
        "schema_differences": differences(),
        "schema_conformed":
            "SELECT tailnum, CAST(year AS FLOAT) AS year, type, model, engines, "
            "NULL::VARCHAR AS owner FROM dirty_planes",
        "partitioned_year":
            "SELECT month, count(*) AS n, CAST(sum(distance) AS BIGINT) AS distance "
            "FROM flights WHERE year = 1995 GROUP BY 1",
        "partitioned_years_of_dimension":
            "SELECT year, count(*) AS n, CAST(sum(distance) AS BIGINT) AS distance FROM flights "
            "WHERE year IN (SELECT year(o_orderdate) FROM orders WHERE o_totalprice > 400000) GROUP BY 1",
        "heavy_origins":
            "SELECT origin AS value, count(*) AS n FROM flights WHERE origin IS NOT NULL GROUP BY 1 "
            "HAVING count(*) >= (SELECT count(*) FROM flights) * 0.01::DOUBLE",
        "star_trips_bucketed":
            "SELECT origin AS fl_origin, count(*) AS n, CAST(sum(distance) AS BIGINT) AS distance, "
            "max(air_region) AS region FROM trips GROUP BY 1",
        "corr_matrix_zero": correlations(True),
        "corr_matrix_skip": correlations(False),
        "corr_matrix_merged": correlations(False),
        "distinct_destinations":
            "SELECT air_region AS region, count(DISTINCT dest) AS n, FALSE AS of_all FROM trips GROUP BY 1 "
            "HAVING count(dest) > 0 UNION ALL SELECT NULL, count(DISTINCT dest), TRUE FROM trips",
    }
    result = {name: with_views(sql) for name, sql in q.items()}
    known = {**labels.statements(), **cleaning.statements(), **reports.statements()}
    same = {"profile_merged": "profile_label_counts_flights", "parquet_sink": "label_sales",
            "expect_people_on_write": "expect_people", "star_trips_heavy": "star_trips",
            "expect_people_report_on_write": "expect_people_report", "rq08_scalar": "rq08"}
    return result | {name: known[other] for name, other in same.items()}
