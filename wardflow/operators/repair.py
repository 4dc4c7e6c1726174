"""Mixed-format date repair of a loaded table (test-kit expiry dates).

The source script updates each text date column in place: a raw value gets one
repaired date (ISO first, else day-first ``dd/mm/yyyy`` when the year slot
holds four characters).  The repaired date depends on the raw value alone, so
it is one expression per column: no shuffle, and a value that fills a third of
the table costs nothing extra.  Write the result to a new path, never over the
path being read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.rules import parse_mixed_date


def repair_dates(df: DataFrame, columns, fallback_formats=("dd/MM/yyyy",)) -> DataFrame:
    """Replace text date columns by repaired DATE values (NULL and unparseable -> NULL)."""
    return df.withColumns({c: parse_mixed_date(F.col(c).cast("string"), fallback_formats) for c in columns})
