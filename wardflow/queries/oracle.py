"""Result comparison used by the oracle check script and tests."""

from __future__ import annotations

import datetime as dt
import decimal
import math

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    try:
        import pandas as pd
        if not isinstance(v, (list, tuple, dict)) and pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    try:
        if isinstance(v, float) and math.isnan(v):
            return None
    except TypeError:
        pass
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            v = v.item()
        except Exception:
            pass
    if isinstance(v, bool):
        return v
    if isinstance(v, (int,)):
        return float(v)
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return dt.datetime.combine(v, dt.time()).isoformat()
    try:
        import pandas as pd
        if isinstance(v, pd.Timestamp):
            return v.to_pydatetime().replace(tzinfo=None).isoformat()
        if v is pd.NaT:
            return None
    except Exception:
        pass
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(norm(x) for x in rec))
    out.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return cols, out


def duckdb_views(sf_dir: str):
    import os

    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark_pdf, duck_pdf) -> str | None:
    """None when equal, else a short reason."""
    sc, sr = rows_of(spark_pdf)
    dc, dr = rows_of(duck_pdf)
    if sc != dc:
        return f"columns {sc} vs {dc}"
    if len(sr) != len(dr):
        return f"rows {len(sr)} vs {len(dr)}"
    if sr != dr:
        diff = [(x, y) for x, y in zip(sr, dr) if x != y][:3]
        return f"values differ, e.g. {diff}"
    return None


def duckdb_type_name(t) -> str:
    """Spark DataType -> the DuckDB type name the oracle should produce."""
    from pyspark.sql import types as T
    m = {T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.DoubleType: "DOUBLE", T.StringType: "VARCHAR",
         T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP", T.TimestampType: "TIMESTAMP WITH TIME ZONE",
         T.BooleanType: "BOOLEAN", T.FloatType: "FLOAT", T.ShortType: "SMALLINT", T.ByteType: "TINYINT"}
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    return m.get(type(t), t.simpleString())


def type_differences(spark_schema, duck_relation) -> dict:
    st = {f.name: duckdb_type_name(f.dataType) for f in spark_schema.fields}
    dt_ = {c: str(t) for c, t in zip(duck_relation.columns, duck_relation.types)}
    return {c: (st.get(c), dt_.get(c)) for c in set(st) | set(dt_) if st.get(c) != dt_.get(c)}
