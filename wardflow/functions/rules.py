"""The cleaning algebra: every column rule of the load jobs as Column -> Column.

All rules are built-in expressions (no UDFs) so they stay inside whole-stage
codegen, and all are ANSI-safe: text that should hold a number or date is read
with ``try_cast`` / ``try_to_timestamp`` so a dirty value never fails a task.
NULL in gives NULL out unless the rule says otherwise.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping
from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Union[Column, str]

#: Marker for ``recode(..., default=KEEP)``: unmatched values are kept.
KEEP = object()

# Fixed values shared with the source systems (sentinels of the load jobs).
SENTINEL_DATE = _dt.date(1900, 1, 1)       # invalid date in care-and-treatment loads
SENTINEL_NUMBER = 999                      # invalid number (age, weight, duration)
BLANK = ""


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _date_lit(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def blank_to_null(c: ColumnOrName) -> Column:
    """'' -> NULL, everything else kept (exact match, no trimming)."""
    c = _c(c)
    return F.when(c.cast("string") == F.lit(BLANK), F.lit(None)).otherwise(c)


def sentinel_to_null(c: ColumnOrName, tokens: Iterable[str]) -> Column:
    """Listed sentinel tokens ('NULL', 'N/A', '0001-01-01', ...) -> NULL."""
    c = _c(c)
    return F.when(c.cast("string").isin(list(tokens)), F.lit(None)).otherwise(c)


def null_default(c: ColumnOrName, default) -> Column:
    """NULL -> default."""
    return F.coalesce(_c(c), F.lit(default))


def clamp_date(c: ColumnOrName, lo=None, hi=None, fill=SENTINEL_DATE,
               blank_is_null: bool = False, text: bool = False) -> Column:
    """Date outside ``[lo, hi]`` -> ``fill`` (a date, or None for NULL).

    ``lo``/``hi`` are dates, ISO strings, Columns or None (open end).  ``hi``
    is usually the injected load date, never a clock call inside the rule.
    NULL stays NULL.  With ``blank_is_null`` a text column's '' is NULL too;
    with ``text`` the column holds dates as text and is compared through
    ``try_cast(... AS DATE)`` (unparseable text is kept).
    """
    c = _c(c)
    v = c.try_cast("date") if text else c
    out = F.lit(False)
    if lo is not None:
        out = out | (v < _date_lit(lo))
    if hi is not None:
        out = out | (v > _date_lit(hi))
    if blank_is_null:
        out = out | (c.cast("string") == F.lit(BLANK))
    fill_col = F.lit(None) if fill is None else _date_lit(fill)
    return F.when(out, fill_col).otherwise(c)


def _num(c: Column) -> Column:
    return c.try_cast("double")


def clamp_number(c: ColumnOrName, lo=None, hi=None, fill=SENTINEL_NUMBER,
                 text: bool = False, lo_open: bool = False) -> Column:
    """Numeric (or numeric-looking text) outside ``[lo, hi]`` (``lo_open``: ``(lo, hi]``) -> ``fill``.

    The comparison reads text with ``try_cast(... AS DOUBLE)``; non-numeric text
    is kept as it is.  The original value (not the parsed one) is returned; for
    a text column pass ``text=True`` so the fill is text too (ANSI would
    otherwise coerce the whole column to a number).
    """
    c = _c(c)
    v = _num(c)
    out = F.lit(False)
    if lo is not None:
        out = out | ((v <= F.lit(lo)) if lo_open else (v < F.lit(lo)))
    if hi is not None:
        out = out | (v > F.lit(hi))
    if fill is None:
        fill_col = F.lit(None)
    else:
        fill_col = F.lit(str(fill)) if text else F.lit(fill)
    return F.when(out, fill_col).otherwise(c)


def cap_to_null(c: ColumnOrName, hi=None, lo=None) -> Column:
    """Numeric value above ``hi`` (or below ``lo``) -> NULL."""
    return clamp_number(c, lo=lo, hi=hi, fill=None)


def negative_label(c: ColumnOrName, label: str) -> Column:
    """Negative numeric text -> a label (e.g. a lab result below zero)."""
    c = _c(c)
    return F.when(_num(c) < F.lit(0), F.lit(label)).otherwise(c)


def present_flag(c: ColumnOrName, no: str = "No", yes: str = "Yes") -> Column:
    """'No' -> 'No'; any other non-NULL -> 'Yes'; NULL -> NULL."""
    c = _c(c)
    return F.when(c == F.lit(no), F.lit(no)).when(c.isNotNull(), F.lit(yes))


def _spelling_pairs(mapping: Mapping) -> list[tuple[str, object]]:
    """{target: [spellings]} -> [(spelling, target)], first listing wins."""
    seen: dict[str, object] = {}
    for target, spellings in mapping.items():
        if isinstance(spellings, str):
            spellings = [spellings]
        for s in spellings:
            seen.setdefault(s, target)
    return list(seen.items())


def recode(c: ColumnOrName, mapping: Mapping, default=KEEP) -> Column:
    """Value recode ``{target: [spelling, ...]}``.

    ``target`` may be None (spelling -> NULL).  Unmatched values: ``KEEP``
    keeps them, None makes them NULL, any other value replaces them (closed
    vocabularies such as ``'Not Done'``).

    Implemented as one map literal probed with ``try_element_at`` instead of a
    CASE chain, so a recode with 150 spellings is a single hash probe per row.
    """
    c = _c(c)
    pairs = _spelling_pairs(mapping)
    to_null = [s for s, t in pairs if t is None]
    to_value = [(s, t) for s, t in pairs if t is not None]
    if to_value:
        m = F.create_map(*[x for s, t in to_value for x in (F.lit(s), F.lit(t))])
        hit = F.try_element_at(m, c)
    else:
        hit = F.lit(None).cast("string")
    if default is KEEP:
        other = c
    elif default is None:
        other = F.lit(None).cast("string")
    else:
        other = F.lit(default)
    res = F.coalesce(hit, other)
    if to_null:
        res = F.when(c.isin(to_null), F.lit(None).cast("string")).otherwise(res)
    return res


def parse_mixed_date(c: ColumnOrName, fallback_formats=("dd/MM/yyyy",),
                     guard_year_at: int = 7) -> Column:
    """Text date in ISO form, else in a day-first form such as 25/12/2023.

    ISO is tried first (``try_cast AS TIMESTAMP_NTZ``); a fallback format is
    only tried when the four characters from position ``guard_year_at`` form a
    4-character year slot.  Deterministic: one candidate per input value.
    Returns DATE.
    """
    c = _c(c)
    iso = c.try_cast("timestamp_ntz")
    guarded = F.length(F.substring(c, guard_year_at, 4)) == F.lit(4)
    alts = [F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz") for fmt in fallback_formats]
    alt = F.coalesce(*alts) if len(alts) > 1 else alts[0]
    return F.coalesce(iso, F.when(c.isNotNull() & guarded, alt)).cast("date")
