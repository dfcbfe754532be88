"""Names of helper columns that no column of the input has."""

from __future__ import annotations

from collections.abc import Iterable


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """Each name, with as many underscores before it as make it differ from all columns, whatever their case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
