"""The registered queries as ANSI SQL, to compare results with another engine."""

from oracle import cleaning, labels, reports, storage


def statements():
    return {**labels.statements(), **cleaning.statements(), **reports.statements(),
            **storage.statements()}
