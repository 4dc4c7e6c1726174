"""Date arithmetic with the source systems' semantics.

``datediff(year|month, a, b)`` in the source SQL counts calendar *boundaries*
crossed, not elapsed periods (2000-12-31 -> 2001-01-01 is one year).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def month_end(c) -> Column:
    """eomonth(): last day of the month of a date/timestamp."""
    return F.last_day(_c(c))


def month_start(c) -> Column:
    """datefromparts(year(c), month(c), 1)."""
    c = _c(c)
    return F.make_date(F.year(c), F.month(c), F.lit(1))


def day_diff(a, b) -> Column:
    """datediff(day, a, b) = b - a in days."""
    return F.datediff(F.to_date(_c(b)), F.to_date(_c(a)))


def year_diff_boundary(a, b) -> Column:
    """datediff(year, a, b): year boundaries crossed."""
    return F.year(_c(b)) - F.year(_c(a))


def month_diff_boundary(a, b) -> Column:
    """datediff(month, a, b): month boundaries crossed."""
    a, b = _c(a), _c(b)
    return (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))


def end_of_month_instant(c) -> Column:
    """dateadd(s, -1, first instant of next month): last second of the month."""
    return F.add_months(month_start(c), 1).cast("timestamp_ntz") - F.expr("INTERVAL 1 SECOND")
