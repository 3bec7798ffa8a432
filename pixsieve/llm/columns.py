"""Column names that an operator needs beside those of its input."""

from __future__ import annotations

from collections.abc import Iterable


def unused(taken: Iterable[str], *wanted: str) -> list[str]:
    """A name like each of ``wanted`` that no other column has; Spark does not tell upper from lower case."""
    known, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in known:
            name = f"_{name}"
        known.add(name.lower())
        out.append(name)
    return out
