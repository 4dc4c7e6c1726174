"""Table access and the deterministic dirt shared by the test queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed "today" of the test queries (injected, never a clock call).
AS_OF = dt.date(2000, 12, 31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def day(c: str):
    return F.to_date(F.col(c))


def ntz(d: dt.datetime):
    """A zone-free TIMESTAMP_NTZ literal (compares with the tables' NTZ columns
    without going through the session time zone)."""
    return F.expr(f"TIMESTAMP_NTZ '{d.isoformat(sep=' ')}'")
