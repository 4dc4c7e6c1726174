"""Small helpers to accept column names or (alias, Column) pairs as keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(items, prefix: str) -> list[tuple[str, Column, bool]]:
    """Normalise keys/measures to ``(name, expr, is_plain_column)``.

    ``items`` holds column names, ``(alias, Column)`` pairs, or a dict.
    Plain names keep their name; expressions get a private alias.
    """
    if isinstance(items, dict):
        items = list(items.items())
    out = []
    for i, it in enumerate(items):
        if isinstance(it, str):
            out.append((it, F.col(it), True))
        elif isinstance(it, tuple):
            name, expr = it
            expr = F.col(expr) if isinstance(expr, str) else expr
            out.append((f"{prefix}{i}_{name}", expr, False))
        else:
            out.append((f"{prefix}{i}", it, False))
    return out
