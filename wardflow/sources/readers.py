"""Readers: tables, SQL texts over registered views, key-range scans, targets.

The source systems are relational databases read through a SQL text
(``dbtable="(text) alias"`` or ``query=text``).  On files the same text runs
through ``spark.sql`` over temp views, so the filters and projections in the
text reach the Parquet scan (``PushedFilters`` / ``ReadSchema``).  For live
databases ``jdbc_options`` builds the reader options; nothing here opens a
connection by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register_views(spark: SparkSession, tables: dict[str, DataFrame | str]) -> None:
    """``{name: DataFrame | parquet path}`` -> temp views."""
    for name, t in tables.items():
        df = spark.read.parquet(t) if isinstance(t, str) else t
        df.createOrReplaceTempView(name)


def read_query(spark: SparkSession, text: str, tables: dict | None = None, **args) -> DataFrame:
    """Run a SQL text (a derived table) over views; ``args`` are bound parameters."""
    if tables:
        register_views(spark, tables)
    return spark.sql(text, args=args or None)


def read_key_range(df: DataFrame, column: str, lower, upper, num_partitions: int) -> list[DataFrame]:
    """The strides of a key-range split (JDBC ``partitionColumn/lowerBound/upperBound``), one frame each.

    The bounds set the strides and drop nothing: rows outside ``[lower, upper)``, and NULL
    keys, belong to the first and last stride.  Each stride is a plain range predicate, so it
    reaches the scan; take strides one by one to work through a source in
    pieces.  A whole-table read needs no split on files, whose scan is split by bytes.
    """
    step = max(1, (upper - lower) // num_partitions)
    cuts = [lower + step * i for i in range(1, num_partitions)]
    out = []
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        cond = None if lo is None else F.col(column) >= F.lit(lo)
        if hi is not None:
            cond = F.col(column) < F.lit(hi) if cond is None else cond & (F.col(column) < F.lit(hi))
        if lo is None and cond is not None:
            cond = cond | F.col(column).isNull()
        out.append(df if cond is None else df.where(cond))
    return out


def jdbc_options(url: str, text: str | None = None, table: str | None = None,
                 partition_column: str | None = None, lower=None, upper=None,
                 num_partitions: int | None = None, fetchsize: int = 10_000,
                 **extra) -> dict[str, str]:
    """Options for ``spark.read.format('jdbc')`` – derived-table read by default."""
    opts = {"url": url, "fetchsize": str(fetchsize)}
    if text is not None:
        opts["dbtable"] = f"({text}) src"
    elif table is not None:
        opts["dbtable"] = table
    if partition_column:
        opts.update(partitionColumn=partition_column, lowerBound=str(lower),
                    upperBound=str(upper), numPartitions=str(num_partitions))
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_target_keys(target: DataFrame, keys) -> DataFrame:
    """Only the key columns of a target (column pruning reaches the scan)."""
    return target.select(*keys)
