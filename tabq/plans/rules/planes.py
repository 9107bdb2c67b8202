"""Rules for planes: tailnum, year, type, manufacturer, model, engines, seats, speed, engine."""

from pyspark.sql import functions as F

from tabq.functions import patterns
from tabq.functions.convert import to_number
from tabq.functions.predicates import (
    contains_any,
    first_char,
    is_blank,
    is_empty,
    is_missing,
    not_in,
    outside,
    text,
)
from tabq.functions.strings import known_or
from tabq.operators.labels import Rule
from tabq.plans.rules import check_variant

# Category lists.
TYPES = ["Fixed wing multi engine", "fixed wing single engine", "Rotorcraft"]
MANUFACTURERS = [
    "AIRBUS", "BOEING", "BOMBARDIER", "CESSNA", "EMBRAER", "SIKORSKY", "CANADAIR", "PIPER",
    "MCDONNELL DOUGLAS", "CIRRUS", "BELL", "KILDALL GARY", "LAMBERT RICHARD", "BARKER JACK",
    "ROBINSON HELICOPTER", "GULFSTREAM", "MARZ BARRY",
]
ENGINES = ["Turbo-fan", "Turbo-jet", "Turbo-prop", "4 Cycle"]
ENGINE_KEYWORDS = ["Turbo-fan", "Turbo-jet", "Turbo-prop", "Turbo-shaft", "Cycle"]

# In the SQL twin two names carry a percent sign that an IN list takes literally.
MANUFACTURERS_SQL = [
    {"AIRBUS": "%AIRBUS%", "LAMBERT RICHARD": "LAMBERT RICHARD%"}.get(m, m) for m in MANUFACTURERS
]


def rules(variant="df"):
    check_variant(variant)
    return [
        tail_number("QA-P1", variant),
        year(),
        type_(variant),
        manufacturer(variant),
        model(variant),
        engines(variant),
        size_in("QA-P7", "seats", 2, 500, variant),
        size_in("QA-P8", "speed", 50, 150, variant),
        engine(variant),
    ]


def tail_number(id, variant):
    code = text("tailnum")
    first = first_char(code)
    sql = variant == "sql"
    digit_free = F.substring(code, 2, 4).rlike(patterns.NO_DIGIT)
    # the SQL twin compares with I, which the branch before has already taken
    wrong_first = first != ("I" if sql else "N")
    return (
        Rule(id, "qa_tailnum")
        .when(is_missing(code) if sql else is_blank(code), "M")
        .when(F.length(code) != 5, "S")
        .when((first != "N") & digit_free, "F")
        .when(first.isin("I", "O", "0"), "FE")
        .when(wrong_first, "FN")
        .keep(code)
    )


def year():
    too_old = to_number("year") < 1950
    return Rule("QA-P2", "qa_year").when(is_blank("year"), "M").when(too_old, "I").keep("year")


def type_(variant):
    missing = {"sql": is_missing, "intended": is_empty}.get(variant, is_blank)("type")
    return Rule("QA-P3", "qa_type").when(missing, "M").when(not_in("type", TYPES), "C").keep("type")


def manufacturer(variant):
    maker = text("manufacturer")
    rule = Rule("QA-P4", "qa_manufacturer")
    if variant == "rdd":
        return rule.keep(known_or("manufacturer", MANUFACTURERS))
    if variant == "sql":
        unknown = not_in(maker, MANUFACTURERS_SQL)
    elif variant == "intended":
        unknown = ~contains_any("manufacturer", MANUFACTURERS)
    else:
        unknown = contains_any("manufacturer", [m + "%" for m in MANUFACTURERS])
    return rule.when(is_missing(maker), "M").when(unknown, "C").keep(maker)


def model(variant):
    """Model names must start as the maker's do.

    The contract compares one character with two-character prefixes, so it rejects every model of
    the last two groups.
    """
    maker, code = text("manufacturer"), text("model")
    first, first_two = first_char(code), F.substring(code, 1, 2)
    canadair = maker.isin("BOMBARDIER", "CANADAIR")
    douglas = maker == "MCDONNELL DOUGLAS"
    if variant == "intended":
        canadair = canadair & (first_two != "CL")
        douglas = douglas & ~first_two.isin("MD", "DC")
    return (
        Rule("QA-P5", "qa_model")
        .when(is_missing(code) if variant == "sql" else is_blank(code), "M")
        .when((maker == "AIRBUS") & (first != "A"), "F")
        .when((maker == "BOEING") & (first != "7"), "F")
        .when(canadair | douglas, "F")
        .keep(code)
    )


def engines(variant):
    rule = Rule("QA-P6", "qa_engines").when(is_missing("engines"), "M")
    out = outside(to_number("engines"), 1, 4)
    if variant == "sql":
        return rule.when(out, "S").keep("engines")
    not_digits = ~text("engines").rlike(patterns.DIGITS_ONLY)
    return rule.when(out, "I").when(not_digits, "A").keep("engines")


def size_in(id, source, low, high, variant):
    """The contract marks every value that has a digit as F; the SQL twin lets it pass."""
    out = outside(to_number(source), low, high)
    rule = Rule(id, f"qa_{source}").when(is_missing(source), "M").when(out, "S")
    if variant == "df" or variant == "rdd":
        rule = rule.when(~text(source).rlike(patterns.NO_DIGIT), "F")
    elif variant == "intended":
        rule = rule.when(~text(source).rlike(patterns.DIGITS_ONLY), "F")
    return rule.keep(source)


def engine(variant):
    kind = text("engine")
    if variant == "sql":
        unknown = not_in(kind, ENGINES)
    elif variant == "intended":
        unknown = ~contains_any("engine", ENGINE_KEYWORDS)
    else:
        unknown = contains_any("engine", [k + "%" for k in ENGINE_KEYWORDS])
    return Rule("QA-P9", "qa_engine").when(is_missing(kind), "M").when(unknown, "C").keep(kind)
