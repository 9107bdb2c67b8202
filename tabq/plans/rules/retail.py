"""Rules for online retail, all columns text."""

from pyspark.sql import functions as F

from tabq.functions import patterns
from tabq.functions.convert import to_whole
from tabq.functions.predicates import is_empty, text
from tabq.operators.labels import Rule
from tabq.plans.rules import check_variant

INVOICE_OR_CANCELLATION = r"^[cC]?[0-9]{6}$"


def rules(variant="df"):
    check_variant(variant)
    return [
        invoice(variant),
        stock_code(),
        present("QA-R3", "Description"),
        present("QA-R4", "Quantity").when(~text("Quantity").rlike(patterns.INTEGER), "F"),
        present("QA-R5", "UnitPrice").when(text("UnitPrice").contains("-"), "I"),
        customer(variant),
        present("QA-R7", "Country"),
    ]


def present(id, source):
    return Rule(id, f"qa_{source}").when(is_empty(source), "M").keep(source)


def invoice(variant):
    code = text("InvoiceNo")
    rule = Rule("QA-R1", "qa_InvoiceNo").when(is_empty(code), "M")
    if variant == "intended":
        return rule.when(code.rlike(INVOICE_OR_CANCELLATION), code).otherwise("F")
    return (
        rule.when(F.length(code) != 6, "S").when(code.rlike(patterns.INVOICE), code).otherwise("F")
    )


def stock_code():
    """A code with a digit is shown as a whole number, so mixed codes become NULL."""
    code = text("StockCode")
    return (
        Rule("QA-R2", "qa_StockCode")
        .when(is_empty(code), "M")
        .when(F.length(code) != 5, "S")
        .when(code.rlike(patterns.INTEGER), to_whole(code))
        .otherwise("F")
    )


def customer(variant):
    """The contract marks the right length as wrong and gives NULL for all else."""
    code = text("CustomerID")
    rule = Rule("QA-R6", "qa_CustomerID").when(is_empty(code), "M")
    if variant == "intended":
        return rule.when(F.length(code) != 5, "S").when(code.rlike(patterns.INTEGER), code)
    return rule.when(F.length(code) == 5, "S")
