"""Every branch of every rule, on hand-written rows."""

import pytest

from tabq.plans.rules import airports, check_variant, communities, flights, planes, retail


def single(make, schema, cases, variant="df"):
    return (make, variant, schema, [c[:-1] for c in cases], [c[-1] for c in cases])


def by_output(module, output, **options):
    return lambda v: next(r for r in module.rules(v, **options) if r.output == output)


AIRPORT = "faa string, name string, lat float, lon float, alt int, tz float, dst string"


def airport(**values):
    order = ["faa", "name", "lat", "lon", "alt", "tz", "dst"]
    return tuple(values.get(c) for c in order)


CASES = {
    "A1": single(by_output(airports, "qa_faa"), "faa string", [
        (None, "M"), ("", "M"), ("A B", "M"), ("A\tB", "M"), ("JFK", "F"), ("222", "222"),
        ("1RL", "1RL"), ("__!", "F"), ("123456", "123456")]),
    "A1 sql": single(by_output(airports, "qa_faa"), "faa string", [
        (None, "M"), ("", "M"), ("A B", "F"), ("__!", "F"), ("__", "__"), ("1RL", "1RL")], "sql"),
    "A1 rdd": single(by_output(airports, "qa_faa"), "faa string", [
        (None, "M"), ("JFK", "F"), ("__!", "__!"), ("_1_", "F")], "rdd"),
    "A1 intended": single(by_output(airports, "qa_faa"), "faa string", [
        ("1R", "F"), ("1RL", "1RL"), ("123456", "F"), ("JFK", "F")], "intended"),
    "A2": single(by_output(airports, "qa_name"), "faa string, name string", [
        ("X", None, "M"), ("X", "", "M"), ("A B", "n", "M"), (None, "n", "n"), ("X", "n m", "n m")]),
    "A2 sql": single(by_output(airports, "qa_name"), "faa string, name string", [
        ("X", None, "M"), ("X", "", ""), ("", "n", "M"), (None, "n", "n")], "sql"),
    "A2 rdd": single(by_output(airports, "qa_name"), "faa string, name string", [
        ("A B", "n", "n"), ("X", "", "M")], "rdd"),
    "A3": single(by_output(airports, "qa_lat"), "faa string, lat float", [
        ("X", None, "M"), ("X", 200.0, "200.0"), ("X", 0.0001, "A"), ("X", 40.5, "40.5")]),
    "A3 text": single(by_output(airports, "qa_lat"), "faa string, lat string", [
        ("X", "", "M"), ("X", "1 2", "M"), ("X", "12O.12", "A"), ("X", "40.5", "40.5")]),
    "A3 sql": single(by_output(airports, "qa_lat"), "faa string, lat float", [
        ("", 1.5, "M"), ("X", 200.0, "I"), ("X", -180.5, "I"), ("X", 0.0001, "1.0E-4")], "sql"),
    "A3 rdd": single(by_output(airports, "qa_lat"), "faa string, lat float", [
        ("X", 0.0, "M"), ("X", -1.5, "A"), ("X", 200.5, "200.5"), ("X", 0.0001, "A")], "rdd"),
    "A3 intended": single(by_output(airports, "qa_lat"), "faa string, lat float", [
        ("X", 200.0, "I"), ("X", -200.0, "I"), ("X", 180.0, "180.0")], "intended"),
    "A4": single(by_output(airports, "qa_lon"), "lon float", [
        (None, "M"), (-200.0, "-200.0"), (0.0001, "A"), (-80.5, "-80.5")]),
    "A4 sql": single(by_output(airports, "qa_lon"), "lon float", [
        (None, "M"), (-200.0, "I"), (-80.5, "-80.5")], "sql"),
    "A5": single(by_output(airports, "qa_alt"), "alt int", [(None, "M"), (-1, "I"), (0, "0")]),
    "A5 text": single(by_output(airports, "qa_alt"), "alt string", [
        ("1044Aa", "A"), ("-100", "I"), (" ", "M")]),
    "A6": single(by_output(airports, "qa_tz"), "alt int, tz float", [
        (1, None, "M"), (1, -12.0, "-12.0"), (1, 0.0001, "A"), (None, 5.0, "5.0")]),
    "A6 sql": single(by_output(airports, "qa_tz"), "alt int, tz float", [
        (1, -11.0, "I"), (1, 14.0, "I"), (1, 13.5, "13.5")], "sql"),
    "A7": single(by_output(airports, "qa_dst"), "dst string", [
        (None, "M"), ("34", "N"), ("K", "C"), ("U", "U"), (" ", "M")]),
    "A7 sql": single(by_output(airports, "qa_dst"), "dst string", [
        (None, "M"), ("34", "C"), ("K", "C"), ("U", None)], "sql"),
    "P1": single(by_output(planes, "qa_tailnum"), "tailnum string", [
        (None, "M"), ("N12 B", "M"), ("N12", "S"), ("XABCD", "F"), ("I12AB", "FE"), ("012AB", "FE"),
        ("X12AB", "FN"), ("NABCD", "NABCD"), ("N12AB", "N12AB")]),
    "P1 sql": single(by_output(planes, "qa_tailnum"), "tailnum string", [
        ("N12 B", "FN"), ("N12AB", "FN"), ("I12AB", "FE"), ("", "M")], "sql"),
    "P2": single(by_output(planes, "qa_year"), "year int", [
        (None, "M"), (1949, "I"), (1950, "1950")]),
    "P3": single(by_output(planes, "qa_type"), "type string", [
        ("Rotorcraft", "Rotorcraft"), ("Fixed wing multi engine", "M"), ("Glider", "C"),
        (None, "M")]),
    "P3 sql": single(by_output(planes, "qa_type"), "type string", [
        ("Fixed wing multi engine", "Fixed wing multi engine"),
        ("Fixed wing single engine", "C"), ("", "M")], "sql"),
    "P4": single(by_output(planes, "qa_manufacturer"), "manufacturer string", [
        (None, "M"), ("", "M"), ("BOEING", "BOEING"), ("THE BOEING% CO", "C"), ("ACME", "ACME")]),
    "P4 sql": single(by_output(planes, "qa_manufacturer"), "manufacturer string", [
        ("AIRBUS", "C"), ("%AIRBUS%", "%AIRBUS%"), ("BOEING", "BOEING"), ("ACME", "C")], "sql"),
    "P4 rdd": single(by_output(planes, "qa_manufacturer"), "manufacturer string", [
        (None, "M"), ("AIRBUS INDUSTRIE", "AIRBUS INDUSTRIE"), ("ACME", "M")], "rdd"),
    "P4 intended": single(by_output(planes, "qa_manufacturer"), "manufacturer string", [
        ("AIRBUS INDUSTRIE", "AIRBUS INDUSTRIE"), ("ACME", "C")], "intended"),
    "P5": single(by_output(planes, "qa_model"), "manufacturer string, model string", [
        ("AIRBUS", "A320", "A320"), ("AIRBUS", "320", "F"), ("BOEING", "737", "737"),
        ("BOEING", "A320", "F"), ("CANADAIR", "CL-600", "F"), ("MCDONNELL DOUGLAS", "MD-88", "F"),
        ("X", "DC 9", "M"), (None, "DC-9", "DC-9"), ("X", None, "M")]),
    "P5 intended": single(by_output(planes, "qa_model"), "manufacturer string, model string", [
        ("CANADAIR", "CL-600", "CL-600"), ("CANADAIR", "600", "F"),
        ("MCDONNELL DOUGLAS", "MD-88", "MD-88"), ("MCDONNELL DOUGLAS", "88", "F")], "intended"),
    "P6": single(by_output(planes, "qa_engines"), "engines int", [
        (0, "I"), (1, "1"), (4, "4"), (5, "I"), (None, "M")]),
    "P6 text": single(by_output(planes, "qa_engines"), "engines string", [("2a", "A")]),
    "P6 sql": single(by_output(planes, "qa_engines"), "engines int", [(5, "S"), (2, "2")], "sql"),
    "P7": single(by_output(planes, "qa_seats"), "seats int", [
        (1, "S"), (100, "F"), (501, "S"), (None, "M")]),
    "P7 sql": single(by_output(planes, "qa_seats"), "seats int", [(1, "S"), (100, "100")], "sql"),
    "P7 intended": single(by_output(planes, "qa_seats"), "seats string", [
        ("100", "100"), ("x", "F")], "intended"),
    "P8": single(by_output(planes, "qa_speed"), "speed int", [
        (49, "S"), (100, "F"), (151, "S"), (None, "M")]),
    "P9": single(by_output(planes, "qa_engine"), "engine string", [
        (None, "M"), ("Turbo-fan", "Turbo-fan"), ("Turbo-fan%", "C"), ("4 Cycle", "4 Cycle")]),
    "P9 sql": single(by_output(planes, "qa_engine"), "engine string", [
        ("Turbo-shaft", "C"), ("4 Cycle", "4 Cycle")], "sql"),
    "P9 intended": single(by_output(planes, "qa_engine"), "engine string", [
        ("Turbo-shaft", "Turbo-shaft"), ("Reciprocating", "C")], "intended"),
    "F1": single(by_output(flights, "qa_year_month_day"), "year int, month int, day int", [
        (None, 1, 1, "MY"), (2014, None, 1, "MM"), (2014, 1, None, "MD"), (1949, 1, 1, "IY"),
        (2014, 13, 1, "IM"), (2014, 2, 30, "ID"), (2014, 2, 29, None), (2014, 4, 31, None),
        (2014, 4, 32, "ID"), (2014, 4, 0, "ID")]),
    "F2": single(by_output(flights, "qa_hour_minute"), "hour int, minute int", [
        (None, 1, "MH"), (1, None, "MM"), (25, 1, "IH"), (-1, 1, "IH"), (12, 61, None),
        (123, 5, "IM"), (5, 5, None)]),
    "F2 intended": single(by_output(flights, "qa_hour_minute"), "hour int, minute int", [
        (25, 1, "IH"), (12, 61, "IM"), (123, 5, "IH"), (24, 59, None)], "intended"),
    "F2 sql": single(by_output(flights, "qa_hour_minute"), "carrier string", [
        ("UA", "UA"), ("AAA", "F")], "sql"),
    "F3": single(by_output(flights, "qa_dep_arr_time"), "dep_time int, arr_time int", [
        (None, 1, "MD"), (1, None, "MA"), (2512, 100, "FD"), (900, 1275, "FA"), (900, 175, "FA"),
        (658, 935, None), (45, 45, None)]),
    "F4": single(by_output(flights, "qa_dep_arr_delay"), "dep_delay int, arr_delay int", [
        (None, 1, "MD"), (1, None, "MA"), (1, 1, None)]),
    "F5": single(by_output(flights, "qa_carrier"), "carrier string", [
        (None, "M"), ("", "M"), ("AAA", "F"), ("UA", "UA")]),
    "F6": single(by_output(flights, "qa_tailnum"), "tailnum string", [
        (None, "M"), ("X12AB", "FN"), ("N12AB", "N12AB")]),
    "F7": single(by_output(flights, "qa_flight"), "flight int", [
        (None, "M"), (12, "F"), (1234, "1234")]),
    "F7 sql": single(by_output(flights, "qa_flight"), "flight int", [(12, "12")], "sql"),
    "F8": single(by_output(flights, "qa_origin_dest"), "origin string, destiny string", [
        (None, "JFK", "MO"), ("JFK", "", "MD"), ("JF", "JFK", "FO"), ("__!", "JFK", "FO"),
        ("JFK", "JFKX", "FD"), ("JFK", "123", None), ("1_2", "JFK", "FO")]),
    "F8 sql": single(by_output(flights, "qa_origin_dest"), "origin string, destiny string", [
        (None, "JFK", "M"), ("JFK", None, "M"), ("__!", "JFK", None)], "sql"),
    "F9": single(by_output(flights, "qa_air_time"), "air_time int", [
        (None, "M"), (19, "I"), (20, "20"), (500, "500"), (501, "I")]),
    "F10": single(by_output(flights, "qa_distance"), "distance int", [
        (None, "M"), (49, "I"), (50, "50"), (3000, "3000"), (3001, "I")]),
    "F11": single(by_output(flights, "qa_airtime"), "air_time int, distance int", [
        (130, 1000, "TL"), (110, 1000, "TS"), (120, 1000, "TR"), (120, None, None), (None, 1, "M")]),
    "R1": single(by_output(retail, "qa_InvoiceNo"), "InvoiceNo string", [
        ("", "M"), (None, "M"), ("53636 ", "M"), ("C536379", "S"), ("536365", "536365"),
        ("A12345", "F")]),
    "R1 intended": single(by_output(retail, "qa_InvoiceNo"), "InvoiceNo string", [
        ("C536379", "C536379"), ("A536379", "F"), ("53636", "F")], "intended"),
    "R2": single(by_output(retail, "qa_StockCode"), "StockCode string", [
        ("", "M"), ("85123A", "S"), ("71053", "71053"), ("01053", "1053"), ("1234A", None),
        ("ABCDE", "F")]),
    "R3": single(by_output(retail, "qa_Description"), "Description string", [
        ("", "M"), ("a b", "a b"), ("a ", "M")]),
    "R4": single(by_output(retail, "qa_Quantity"), "Quantity string", [
        ("x", "F"), ("-3", "-3"), (None, "M")]),
    "R5": single(by_output(retail, "qa_UnitPrice"), "UnitPrice string", [
        ("-1,5", "I"), ("2,55", "2,55"), ("\t", "M")]),
    "R6": single(by_output(retail, "qa_CustomerID"), "CustomerID string", [
        ("", "M"), ("17850", "S"), ("1785", None)]),
    "R6 intended": single(by_output(retail, "qa_CustomerID"), "CustomerID string", [
        ("17850", "17850"), ("1785", "S"), ("abcde", None)], "intended"),
    "R7": single(by_output(retail, "qa_Country"), "Country string", [(None, "M"), ("UK", "UK")]),
    "C1": single(lambda v: communities.rules(["x"], v)[0], "x string", [
        (None, "MN"), ("abc ", "MN"), ("", "MN"), ("?", "M"), ("0.19", "0.19")]),
}



@pytest.mark.parametrize("name", CASES)
def test_rule(name, labels_of):
    make, variant, schema, rows, expected = CASES[name]
    assert labels_of(make(variant), schema, rows) == expected


def test_unknown_variant():
    with pytest.raises(ValueError):
        check_variant("other")


def test_backfill(spark):
    from tabq.operators.labels import backfill

    df = spark.createDataFrame([("MD",), (None,), (" ",)], "x string")
    assert [r[0] for r in backfill(df, "x").collect()] == ["MD", "M", "M"]


def test_labels_leave_rows_and_columns_alone(spark):
    """Any text: same rows, same source columns, each label known or the value itself."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    from tabq.operators.labels import label

    value = st.one_of(st.none(), st.text(alphabet="ab 09.?-,\t_N", max_size=6))

    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(*[value] * 7), min_size=1, max_size=20))
    def check(rows):
        columns = ["faa", "name", "lat", "lon", "alt", "tz", "dst"]
        schema = ", ".join(f"{c} string" for c in columns)
        labelled = label(spark.createDataFrame(rows, schema), airports.rules()).collect()
        assert [tuple(r[c] for c in columns) for r in labelled] == rows
        for r in labelled:
            for c in columns:
                assert r[f"qa_{c}"] in {"M", "F", "I", "A", "N", "C", r[c]}

    check()


def test_rules_work_on_streams(spark, tmp_path):
    """The rules keep no state, so they also apply to a streaming table."""
    from tabq.operators.labels import label
    from tabq.sources import schemas

    stream = spark.readStream.schema(schemas.RETAIL).csv(str(tmp_path))
    labelled = label(stream, retail.rules())
    assert labelled.isStreaming and "qa_Country" in labelled.columns
