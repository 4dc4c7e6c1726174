"""Parent joins.  Which side is broadcast is left to the planner, which knows sizes in bytes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parent_exists(child: DataFrame, parent: DataFrame, on, parent_filter=None) -> DataFrame:
    """Child rows having a parent row (inner join whose right side is unused).

    Written as LEFT SEMI: no fan-out when the parent key repeats, and the
    parent side contributes only its key columns.
    """
    if parent_filter is not None:
        parent = parent.filter(parent_filter)
    if isinstance(on, str):
        on = [on]
    if isinstance(on, list) and all(isinstance(x, str) for x in on):
        parent = parent.select(*on)
        return child.join(parent, on, "left_semi")
    if isinstance(on, list) and all(isinstance(x, tuple) for x in on):
        p = parent.select(*[F.col(r).alias(f"__p_{r}") for _, r in on])
        cond = reduce(lambda a, b: a & b, [child[lk] == p[f"__p_{r}"] for lk, r in on])
        return child.join(p, cond, "left_semi")
    return child.join(parent, on, "left_semi")


def join_parents(child: DataFrame, parents) -> DataFrame:
    """Inner-join a chain of parents: ``[(parent_df, on, filter_or_None), ...]``.

    Parent filters (soft delete, positive facility code) are applied before
    the join so they push down to the parent scan.
    """
    out = child
    for parent, on, flt in parents:
        if flt is not None:
            parent = parent.filter(flt)
        out = out.join(parent, on, "inner")
    return out
