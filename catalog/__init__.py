"""Registered queries: each operator on the given tables, with the SQL that checks it."""


def load():
    """The registry with every query module imported."""
    from catalog import classes, cleaning, joins, jobs, registry, rollups, scans, windows  # noqa: F401

    return registry
