"""Query catalogue over the test tables.

Each entry is a Spark implementation built from the package's operators and,
where the semantics are SQL-expressible, an independent DuckDB oracle text
over the pre-registered views (region nation customer supplier part orders
lineitem events ...).  Column names are aliased identically on both sides.

The test tables carry no dirt, so queries derive dirty values
deterministically inside the query (blank strings, NULL keys, text numbers);
the oracle derives the same values with its own SQL.  "Today" is a fixed
parameter (``AS_OF``) so answers are stable.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle, (fn.__doc__ or "").strip())
        return fn
    return deco


def all_queries() -> dict[str, Query]:
    from wardflow.queries import basic, cleaning, composite, forms, relational  # noqa: F401
    return dict(REGISTRY)
