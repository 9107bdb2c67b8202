"""Quality rules per table.

Each module has ``rules(variant)``. Variants of a rule:

``df``        the contract, the default
``sql``       the SQL twin, where it differs
``rdd``       the row-function twin, where one exists
``intended``  the rule as it was meant, where the contract has a defect

A rule without the requested variant falls back to ``df``.
"""

VARIANTS = ("df", "sql", "rdd", "intended")


def check_variant(variant):
    if variant not in VARIANTS:
        raise ValueError(f"unknown variant {variant!r}, expected one of {VARIANTS}")
    return variant
