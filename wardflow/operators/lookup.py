"""Lookup standardisation: raw spelling -> standard term via a two-column table.

``standardise(df, col, lookup)`` = ``LEFT JOIN lookup ON col = source`` then
``coalesce(target, col)``.  Choices (documented deviations):

* the lookup is de-duplicated first (``min(target)`` per source spelling), so a
  duplicated spelling can never multiply rows;
* whether it is broadcast is the planner's choice, by its size in bytes, and
  revised at run time (AQE) – correct at any size;
* the right-hand columns are dropped inside the operator, so several lookups
  on one frame never collide on ``source_name``/``target_name``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.rules import KEEP


def dedupe_lookup(lookup: DataFrame, source: str = "source_name", target: str = "target_name",
                  case_insensitive: bool = False) -> DataFrame:
    src = F.upper(F.col(source)) if case_insensitive else F.col(source)
    return (lookup.select(src.alias("__src"), F.col(target).alias("__tgt"))
            .filter(F.col("__src").isNotNull())
            .groupBy("__src").agg(F.min("__tgt").alias("__tgt")))


def prepare_lookup(lookup: DataFrame, source: str = "source_name", target: str = "target_name",
                   case_insensitive: bool = False) -> DataFrame:
    """De-duplicated lookup ready for ``standardise(..., prepared=True)``;
    prepare once when one lookup serves several columns."""
    return dedupe_lookup(lookup, source, target, case_insensitive)


SHARED_BYTES = 4 << 20


def shared_lookup(lookup: DataFrame, max_bytes: int = SHARED_BYTES) -> DataFrame:
    """A prepared lookup that several columns use, read once.

    Its size is measured first (one aggregate).  Up to ``max_bytes`` its rows are
    held in the plan, so that every use is a hash join with rows at hand; a larger one
    is returned as it is, and every use joins the table again.
    """
    spark = lookup.sparkSession
    rows = lookup.limit(max_bytes // 8 + 1)  # a bound for what may reach the driver, whatever the table holds
    size = rows.agg(F.sum(F.octet_length(F.col("__src").cast("string"))
                          + F.coalesce(F.octet_length(F.col("__tgt").cast("string")), F.lit(0)) + F.lit(8)).alias("b")).first()["b"] or 0
    if size > max_bytes:
        return lookup
    return spark.createDataFrame(rows.collect(), lookup.schema)


def standardise(df: DataFrame, column: str, lookup: DataFrame, source: str = "source_name",
                target: str = "target_name", case_insensitive: bool = False,
                default=KEEP, out: str | None = None,
                prepared: bool = False) -> DataFrame:
    """Replace ``column`` by its lookup target; unmatched -> kept / NULL / default.

    ``default`` – ``KEEP`` (the value is kept), None, or a constant used when
    neither the lookup nor the value itself has one (``coalesce(target, value,
    default)``).
    """
    lk = (lookup if prepared else
          prepare_lookup(lookup, source, target, case_insensitive)).alias("__lk")
    key = F.upper(df[column]) if case_insensitive else df[column]
    joined = df.alias("__df").join(lk, key == F.col("__lk.__src"), "left")
    value = F.col(f"__df.{column}")
    if default is KEEP:
        res = F.coalesce(F.col("__lk.__tgt"), value)
    elif default is None:
        res = F.col("__lk.__tgt")
    else:
        res = F.coalesce(F.col("__lk.__tgt"), value, F.lit(default))
    name = out or column
    cols = [F.col(f"__df.{c}") for c in df.columns if c != name]
    return joined.select(*cols, res.alias(name)).select(*(df.columns if name in df.columns else df.columns + [name]))


def lookup_conflicts(lookup: DataFrame, source: str = "source_name", target: str = "target_name",
                     case_insensitive: bool = False) -> DataFrame:
    """Spellings mapped to more than one target (the rows ``standardise`` resolves
    with ``min(target)``), for reporting alongside a load."""
    src = F.upper(F.col(source)) if case_insensitive else F.col(source)
    return (lookup.select(src.alias("source"), F.col(target).alias("target")).filter(F.col("source").isNotNull())
            .groupBy("source").agg(F.countDistinct("target").alias("n_targets"),
                                   F.sort_array(F.collect_set("target")).alias("targets"))
            .filter(F.col("n_targets") > 1))
