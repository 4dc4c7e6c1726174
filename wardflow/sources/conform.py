"""Target schema contract: ordered columns, types, lengths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _typed(c: Column, source: T.DataType, target: T.DataType) -> Column:
    if isinstance(target, T.DateType) and isinstance(source, T.StringType):
        return F.to_date(c.try_cast("timestamp_ntz"))
    return c.try_cast(target)


def conform(df: DataFrame, schema: T.StructType, lengths: dict[str, int] | None = None,
            missing_as_null: bool = False, misfit: str = "raise") -> DataFrame:
    """Project to ``schema`` (names resolved case-insensitively), typed.

    A value that does not fit its type, or is longer than ``lengths[column]``, stops the
    job (``misfit="raise"``), as the target's insert would; with
    ``misfit="reject"`` it becomes NULL and the number of such values of a row is kept
    in a column ``_misfits``, so that rejected rows can be counted and set
    aside.  Text is never cut.  A column the input lacks is an error unless
    ``missing_as_null``.
    """
    if misfit not in ("raise", "reject"):
        raise ValueError(misfit)
    by_lower = {c.lower(): c for c in df.columns}
    cols, faults = [], []
    for f in schema.fields:
        src = by_lower.get(f.name.lower())
        if src is None:
            if not missing_as_null:
                raise KeyError(f.name)
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        raw = F.col(f"`{src}`")
        typed = _typed(raw, df.schema[src].dataType, f.dataType)
        bad = raw.isNotNull() & typed.isNull()
        if lengths and f.name in lengths:
            bad = bad | (F.length(typed.cast("string")) > lengths[f.name])
        bad = F.coalesce(bad, F.lit(False))
        if misfit == "raise":
            said = F.concat(F.lit(f"{f.name} does not fit {f.dataType.simpleString()}: "), raw.cast("string"))
            typed = F.when(bad, F.raise_error(said).cast(f.dataType)).otherwise(typed)
        else:
            typed = F.when(~bad, typed)
            faults.append(bad.cast("int"))
        cols.append(typed.alias(f.name))
    if misfit == "reject":
        cols.append((sum(faults[1:], faults[0]) if faults else F.lit(0)).alias("_misfits"))
    return df.select(*cols)


MISFITS = "_misfits"


def checked(df: DataFrame, schema: T.StructType, lengths: dict[str, int] | None = None) -> DataFrame:
    """``df`` in the types of ``schema``, and ``_misfits``: the (column, value) pairs of a row that do not fit.

    A misfit is NULL in its column and keeps its raw text in ``_misfits``, so that nothing is
    lost and a row can be set aside and repaired; rows that fit have an empty array.
    A column that the input lacks is an error.
    """
    by_lower = {c.lower(): c for c in df.columns}
    cols, faults = [], []
    for f in schema.fields:
        if f.name.lower() not in by_lower:
            raise KeyError(f.name)
        src = by_lower[f.name.lower()]
        raw, kind = F.col(f"`{src}`"), df.schema[src].dataType
        typed = raw if kind == f.dataType else _typed(raw, kind, f.dataType)
        tests = [] if kind == f.dataType else [raw.isNotNull() & typed.isNull()]
        if lengths and f.name in lengths:
            tests.append(F.length(typed.cast("string")) > lengths[f.name])
        if tests:
            bad = F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))
            faults.append(F.when(bad, F.struct(F.lit(f.name).alias("column"), raw.cast("string").alias("value"))))
            typed = F.when(~bad, typed)
        cols.append(typed.alias(f.name))
    none = F.lit(None).cast("struct<column:string,value:string>")
    return df.select(*cols, F.filter(F.array(none, *faults), lambda m: m.isNotNull()).alias(MISFITS))


def fitting(df: DataFrame) -> DataFrame:
    """The rows of ``checked`` without a misfit."""
    return df.where(F.size(MISFITS) == 0).drop(MISFITS)


def rejected(df: DataFrame) -> DataFrame:
    """The other rows, with their misfits."""
    return df.where(F.size(MISFITS) > 0)
