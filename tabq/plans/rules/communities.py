"""One rule for every column of a wide text table."""

from tabq.functions.predicates import is_empty_sql, quoted
from tabq.operators.labels import Rule
from tabq.plans.rules import check_variant


def rules(columns, variant="df"):
    check_variant(variant)
    return [Rule("QA-C1", f"qa_{c}").expression(_ladder(c)) for c in columns]


def _ladder(name):
    return (
        f"CASE WHEN {is_empty_sql(name)} THEN 'MN' WHEN {quoted(name)} = '?' THEN 'M' "
        f"ELSE CAST({quoted(name)} AS STRING) END"
    )
