"""Business reports. Every report returns a DataFrame and runs nothing itself."""


def answers(reports, table):
    """All reports of a family over one table, by name; nothing runs until an answer is used.

    Hand over a table that has been written once (``sources.files.handoff``): each answer reads it
    again.
    """
    return {name: report(table) for name, report in reports.items()}
