"""Rules for flights."""

from pyspark.sql import functions as F

from tabq.functions import patterns
from tabq.functions.convert import to_number
from tabq.functions.predicates import is_missing, outside, text
from tabq.operators.labels import Rule
from tabq.plans.rules import check_variant
from tabq.plans.rules.planes import tail_number


def rules(variant="df", dest="destiny"):
    """``dest`` is the name of the destination column, which differs between the file versions."""
    check_variant(variant)
    return [
        calendar_date(),
        carrier("QA-F2", "qa_hour_minute") if variant == "sql" else hour_minute(variant),
        carrier("QA-F3", "qa_dep_arr_time") if variant == "sql" else clock_times(),
        delays(),
        carrier("QA-F5", "qa_carrier"),
        tail_number("QA-F6", variant),
        flight_number(variant),
        route(variant, dest),
        value_in("QA-F9", "air_time", 20, 500),
        value_in("QA-F10", "distance", 50, 3000),
        pace(),
    ]


def calendar_date():
    month, day = to_number("month"), to_number("day")
    last_day = F.when(month == 2, 29).otherwise(31)
    return (
        Rule("QA-F1", "qa_year_month_day")
        .when(is_missing("year"), "MY")
        .when(is_missing("month"), "MM")
        .when(is_missing("day"), "MD")
        .when(to_number("year") < 1950, "IY")
        .when(outside(month, 1, 12), "IM")
        .when(outside(day, 1, last_day), "ID")
    )


def _piece(c, start, size):
    """Part of a number's text, as a number again; NULL when nothing is left."""
    return F.nullif(F.substring(c, start, size), F.lit("")).try_cast("int")


def hour_minute(variant):
    """The contract takes the minute from the tail of the hour text."""
    hour, minute = text("hour"), text("minute")
    rule = (
        Rule("QA-F2", "qa_hour_minute")
        .when(is_missing(hour), "MH")
        .when(is_missing(minute), "MM")
    )
    if variant == "intended":
        return rule.when(outside(to_number("hour"), 0, 24), "IH").when(
            outside(to_number("minute"), 0, 59), "IM"
        )
    hours = F.length(hour)
    bad_hour = ((hours == 1) & outside(_piece(hour, 1, 1), 0, 24)) | (
        (hours == 2) & outside(_piece(hour, 1, 2), 0, 24)
    )
    minutes = F.length(minute)
    bad_minute = ((minutes == 1) & outside(_piece(hour, 2, 3), 0, 9)) | (
        (minutes == 2) & outside(_piece(hour, 3, 4), 0, 59)
    )
    return rule.when(bad_hour, "IH").when(bad_minute, "IM")


def clock_times():
    """Times are written hmm or hhmm: the hour of departure and the minute of arrival count."""
    dep, arr = text("dep_time"), text("arr_time")
    bad_hour = ((F.length(dep) == 3) & outside(_piece(dep, 1, 1), 0, 24)) | (
        (F.length(dep) == 4) & outside(_piece(dep, 1, 2), 0, 24)
    )
    bad_minute = ((F.length(arr) == 3) & outside(_piece(arr, 2, 3), 0, 59)) | (
        (F.length(arr) == 4) & outside(_piece(arr, 3, 4), 0, 59)
    )
    return (
        Rule("QA-F3", "qa_dep_arr_time")
        .when(is_missing(dep), "MD")
        .when(is_missing(arr), "MA")
        .when(bad_hour, "FD")
        .when(bad_minute, "FA")
    )


def delays():
    return (
        Rule("QA-F4", "qa_dep_arr_delay")
        .when(is_missing("dep_delay"), "MD")
        .when(is_missing("arr_delay"), "MA")
    )


def carrier(id, output):
    """Also stands in for two other rules in the SQL twin."""
    code = text("carrier")
    return Rule(id, output).when(is_missing(code), "M").when(F.length(code) != 2, "F").keep(code)


def flight_number(variant):
    rule = Rule("QA-F7", "qa_flight").when(is_missing("flight"), "M")
    if variant != "sql":
        rule = rule.when(~text("flight").rlike(patterns.FOUR_DIGITS), "F")
    return rule.keep("flight")


def route(variant, dest):
    def bad(code):
        wrong_size = F.length(code) != 3
        return wrong_size if variant == "sql" else ~code.rlike(patterns.AIRPORT_CODE) | wrong_size

    origin, dest = text("origin"), text(dest)
    no_origin, no_dest = ("M", "M") if variant == "sql" else ("MO", "MD")
    return (
        Rule("QA-F8", "qa_origin_dest")
        .when(is_missing(origin), no_origin)
        .when(is_missing(dest), no_dest)
        .when(bad(origin), "FO")
        .when(bad(dest), "FD")
    )


def value_in(id, source, low, high):
    out = outside(to_number(source), low, high)
    return Rule(id, f"qa_{source}").when(is_missing(source), "M").when(out, "I").keep(source)


def pace():
    """Air time against distance: a tenth of the distance plus 10 to 30 minutes is regular."""
    minutes, base = to_number("air_time"), to_number("distance") * F.lit(0.1)
    return (
        Rule("QA-F11", "qa_airtime")
        .when(is_missing("air_time"), "M")
        .when(minutes >= base + 30, "TL")
        .when(minutes <= base + 10, "TS")
        .when(base.isNotNull(), "TR")
    )
