"""Small helpers of the tests, in a module that no conftest of another folder can hide."""

from __future__ import annotations


def rows(df):
    """All rows as sorted tuples of (column, value), for comparing small results."""
    names = sorted(df.columns)
    return sorted((tuple((n, r[n]) for n in names) for r in df.collect()), key=repr)


def values(df, name="check_name", value="value"):
    return {r[name]: r[value] for r in df.collect()}
