"""Rules for airports: faa, name, lat, lon, alt, tz, dst."""

from pyspark.sql import functions as F

from tabq.functions import patterns
from tabq.functions.convert import to_number
from tabq.functions.predicates import has_blank, is_blank, is_missing, not_in, outside, text
from tabq.operators.labels import Rule
from tabq.plans.rules import check_variant

# Daylight saving classes.
DST_CLASSES = ["E", "A", "S", "O", "Z", "N", "U"]


def rules(variant="df"):
    check_variant(variant)
    return [
        faa(variant),
        name(variant),
        degrees("QA-A3", "lat", variant),
        degrees("QA-A4", "lon", variant),
        alt(variant),
        tz(variant),
        dst(variant),
    ]


def faa(variant):
    code = text("faa")
    size = F.length(code)
    no_digit = code.rlike(patterns.NO_DIGIT)
    rule = Rule("QA-A1", "qa_faa")
    if variant == "sql":
        bad = code.rlike(patterns.LETTERS_ONLY) | (no_digit & size.between(3, 5))
        return rule.when(is_missing(code), "M").when(bad, "F").keep(code)
    if variant == "rdd":
        bad = ~code.rlike(patterns.NO_ALPHANUM)
        return rule.when(is_missing(code), "M").when(bad, "F").keep(code)
    if variant == "intended":
        no_digit = no_digit | ~size.between(3, 5)
    return rule.when(is_blank(code), "M").when(no_digit, "F").keep(code)


def name(variant):
    rule = Rule("QA-A2", "qa_name")
    if variant == "sql":
        missing = text("name").isNull() | (text("faa") == "")
    elif variant == "rdd":
        missing = is_missing("name")
    else:
        missing = is_missing("name") | has_blank("faa")
    return rule.when(missing, "M").keep("name")


def degrees(id, source, variant):
    """Latitude and longitude. The contract asks for >180 and <-180 at once, so never says I."""
    value = to_number(source)
    letters = text(source).rlike("[a-zA-Z ]")
    rule = Rule(id, f"qa_{source}")
    if variant == "sql":
        no_key = text("faa") == "" if source == "lat" else is_missing(source)
        missing = text(source).isNull() | no_key
        return rule.when(missing, "M").when(outside(value, -180, 180), "I").keep(source)
    if variant == "rdd" and source == "lat":
        # zero counts as missing here, and every negative value as not numeric
        missing = is_missing(source) | F.coalesce(value == 0, F.lit(False))
        odd = ~text(source).rlike(patterns.POSITIVE_DECIMAL)
        return rule.when(missing, "M").when(odd, "A").keep(source)
    rule = rule.when(is_blank(source), "M")
    if variant == "intended":
        rule = rule.when(outside(value, -180, 180), "I")
    return rule.when(letters, "A").keep(source)


def alt(variant):
    negative = to_number("alt") < 0
    rule = Rule("QA-A5", "qa_alt")
    if variant == "sql":
        return rule.when(is_missing("alt"), "M").when(negative, "I").keep("alt")
    return (
        rule.when(is_blank("alt"), "M")
        .when(negative, "I")
        .when(text("alt").rlike("[a-zA-Z ]"), "A")
        .keep("alt")
    )


def tz(variant):
    value = to_number("tz")
    beyond = (value <= -11) | (value >= 14)
    rule = Rule("QA-A6", "qa_tz")
    if variant == "sql":
        missing = text("tz").isNull() | (text("alt") == "")
        return rule.when(missing, "M").when(beyond, "I").keep("tz")
    rule = rule.when(is_blank("tz"), "M")
    if variant == "intended":
        rule = rule.when(beyond, "I")
    return rule.when(text("tz").rlike("[a-zA-Z ]"), "A").keep("tz")


def dst(variant):
    unknown = not_in("dst", DST_CLASSES)
    rule = Rule("QA-A7", "qa_dst")
    if variant == "sql":
        return rule.when(is_missing("dst"), "M").when(unknown, "C")
    numeric = text("dst").rlike(patterns.DIGITS_ONLY)
    return rule.when(is_blank("dst"), "M").when(numeric, "N").when(unknown, "C").keep("dst")
