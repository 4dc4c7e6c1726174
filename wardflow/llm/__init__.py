"""Operators of a training-data pipeline, and the queries that apply them to the given tables.

Every module holds one operator (general interface, real outputs), the thin
query ``opN_<name>`` that applies it to a whole table, and its DuckDB oracle
where SQL can express the operator.  Nothing outside this package imports it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


def _modules():
    from wardflow.llm import (
        backtrack, chat, contamination, divergence, fixity, htmltext, negatives, packing, secrets, simhash, tokencount, toxicity, weighted,
    )
    return (fixity, packing, secrets, toxicity, htmltext, tokencount, simhash, chat, contamination, weighted, negatives, backtrack,
            divergence)


def queries() -> dict[str, QueryFn]:
    return {name: fn for m in _modules() for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _modules() for name, sql in m.ORACLES.items()}
