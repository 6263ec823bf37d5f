"""Column helpers for the driver side."""

from __future__ import annotations

from collections.abc import Iterable


def free_name(taken: Iterable[str], wanted: str = "_work") -> str:
    """`wanted`, lengthened until no column of the caller has that name."""
    taken = {name.lower() for name in taken}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
