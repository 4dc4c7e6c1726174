"""Declarative load specs.

One ``LoadSpec`` describes one incremental load job end to end:

    scan form -> latest-version rule -> parent joins -> filters -> DISTINCT
      -> column rules -> lookups -> new records vs target -> output contract
      -> digests -> write

Expressions are SQL expression strings (``"cast(DateExtracted as date)"``) or
plain column names, so a spec is pure data: it can be listed, diffed and
tested without running anything.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Latest:
    """Joint-maxima rule: keep rows holding all ``maxes`` per ``keys``.

    ``maxes`` may be a tuple of tuples: independent rules ANDed.
    ``join_keys`` – coarser join back (subset of keys).
    """
    keys: tuple
    maxes: tuple
    join_keys: tuple | None = None
    stage: str = "form"   # "form": over the form alone; "joined": after the parent joins
    over: tuple | None = None  # parents the maxima are computed over, if other than the load's own


@dataclass(frozen=True)
class Parent:
    """Inner join to a parent table (``kind='inner'``) or existence only (``'semi'``).

    ``on`` – ((child_col, parent_col), ...); ``where`` – SQL predicate on the
    parent applied before the join (soft delete); ``columns`` – parent columns
    carried into the child as ``{parent_col: output_name}``.
    """
    table: str
    on: tuple
    kind: str = "inner"
    where: str | None = None
    columns: tuple = ()


@dataclass(frozen=True)
class Rule:
    """Column rule: ``kind`` in blank | sentinel | date | number | cap | recode |
    present | negative | default, ``params`` as keyword arguments."""
    column: str
    kind: str
    params: tuple = ()

    def kwargs(self) -> dict:
        return dict(self.params)


@dataclass(frozen=True)
class Lookup:
    column: str
    table: str
    source: str = "source_name"
    target: str = "target_name"
    case_insensitive: bool = False
    default: str | None = None     # None: keep the raw value; else coalesce(target, raw, default)


@dataclass(frozen=True)
class LoadSpec:
    name: str
    source: str
    target: str
    columns: tuple
    delta_keys: tuple = ()
    delta_plain_keys: tuple = ()
    parents: tuple = ()
    where: tuple = ()
    latest: Latest | None = None
    distinct: bool = True
    rules: tuple = ()
    lookups: tuple = ()
    hashes: tuple = ()             # ((id column, digest column), ...)
    write_partitions: int | str | None = None   # int, "config" or None
    derived: tuple = ()            # ((name, sql expr), ...) computed right after the scan;
                                   # "{as_of}" in an expression is the injected load date
    select: tuple = ()             # ((column, sql expr), ...): the select list's own expressions, inside DISTINCT
    select_rules: tuple = ()       # column rules of the select list (CASE maps), inside DISTINCT
    nulls: tuple = ()              # contract columns that the select list fills with NULL, whatever the form holds
    sample_limit: int | None = None  # the source texts' TOP n, off unless set
    group_by: tuple = ()           # scan-level GROUP BY (names or "expr AS name")
    aggregates: tuple = ()         # ((name, sql aggregate expr), ...) for group_by
    notes: str = ""
    module: str = field(default="", compare=False)


def rules_of(kind: str, columns, **params) -> tuple:
    """Same rule on several columns, e.g. ``rules_of('blank', [...])``."""
    items = tuple(sorted(params.items()))
    return tuple(Rule(c, kind, items) for c in columns)


def rule(column: str, kind: str, **params) -> Rule:
    return Rule(column, kind, tuple(sorted(params.items(), key=lambda kv: kv[0])))


def date_casts(*names: str) -> tuple:
    """``cast(name as date)`` select items."""
    return tuple((n, f"CAST(`{n}` AS DATE)") for n in names)


def cols(text: str) -> tuple:
    """'A, B,C' -> ('A', 'B', 'C')."""
    return tuple(c.strip() for c in text.split(",") if c.strip())
