"""Synthetic source tables for a LoadSpec (two rows of one key, parents, lookups, target)."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import types as T

from wardflow.plans.run import FrameIO
from wardflow.plans.spec import LoadSpec

IDENT = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
SQL_WORDS = {"cast", "as", "date", "coalesce", "case", "when", "then", "else", "end", "null", "is", "not", "and",
             "or", "max", "try_cast", "int", "timestamp", "boolean", "timestamp_ntz", "false", "true", "current_date", "DATE", "AS"}
INT_COLS = {"patientpk", "sitecode", "code", "patientpid", "facilityid", "id", "encounterid", "partnerpatientpk",
            "contactpatientpk", "motherpatientpk", "babypatientpk"}
TS_COLS = {"created", "datecreated", "dateextracted", "date_created", "date_last_modified", "loaddate", "refilldate"}


def _idents(e) -> set[str]:
    if isinstance(e, tuple):
        return set().union(*[_idents(x) for x in e])
    if not isinstance(e, str):
        return set()
    e = re.sub(r"'[^']*'", "", e).replace("{as_of}", "")
    return {w for w in IDENT.findall(e) if w.lower() not in {x.lower() for x in SQL_WORDS} and not w.isupper()
            or w in ("SiteCode", "ID", "EDD", "LMP", "BMI", "NUPI", "OTZEnrollmentDate")}


def _ci_add(cols: dict, name: str, typ) -> None:
    if name.lower() not in {c.lower() for c in cols}:
        cols[name] = typ


def _type_for(name: str, date_cols: set[str], text_cols: frozenset = frozenset()):
    low = name.lower()
    if low in INT_COLS:
        return T.IntegerType()
    if low in TS_COLS:
        return T.TimestampType()
    if name in text_cols:
        return T.StringType()
    if name in date_cols or low.endswith("date"):
        return T.DateType()
    return T.StringType()


def _value(name: str, typ, row: int):
    low = name.lower()
    if isinstance(typ, T.IntegerType):
        if low in ("id",):
            return row
        if low == "patientid":
            return 1
        if low in ("sitecode", "code"):
            return 12345
        if low in ("facilityid",):
            return 7
        return 1000
    if isinstance(typ, T.TimestampType):
        return dt.datetime(2020, row, 1, 10, 0)
    if isinstance(typ, T.DateType):
        return dt.date(2020, 1, 1)
    if low == "gender":
        return "F"
    if low.endswith("date"):
        return "2020-01-01"
    if low in ("temp", "oxygensaturation"):
        return "36.6"
    if low in ("pulserate", "respiratoryrate", "muac"):
        return "71"
    if low == "deletedflag":
        return "0"
    if low in ("mfl_code",):
        return "10001"
    if low == "voided":
        return "0"
    if low in ("finaltestresult", "tracingtype", "tracingoutcome"):
        return "Positive"
    return f"{name[:6]}-v"


def build_io(spark, spec: LoadSpec, with_target: bool = True) -> FrameIO:
    parent_out = {out.lower() for p in spec.parents for _, out in p.columns}
    derived_out = {n.lower() for n, _ in spec.derived}
    agg_refs = {x.lower() for _, e in spec.aggregates for x in _idents(e)}
    agg_out = {n.lower() for n, _ in spec.aggregates} - agg_refs
    date_cols = {r.column for r in spec.rules if r.kind == "date" and not r.kwargs().get("text")}
    date_cols |= {c for c, _ in spec.select}
    text_cols = frozenset(r.column for r in spec.rules
                          if (r.kind == "date" and r.kwargs().get("text")) or r.kind in ("blank", "sentinel", "recode"))
    needed: dict[str, object] = {}
    exprs = [spec.derived, spec.where, spec.group_by, spec.aggregates,
             spec.latest.keys if spec.latest else (), spec.latest.maxes if spec.latest else ()]
    names = list(spec.columns) + [r.column for r in spec.rules] + [lk.column for lk in spec.lookups]
    for e in exprs:
        names += sorted(_idents(e))
    for p in spec.parents:
        for cc, pc in p.on:
            needed[cc] = _type_for(pc, date_cols)
    if spec.latest is not None and spec.latest.stage == "form":
        for n in sorted(_idents(spec.latest.keys) | _idents(spec.latest.maxes)):
            _ci_add(needed, n, _type_for(n, date_cols, text_cols))
    for n in names:
        used = n in [x for e in spec.derived for x in _idents(e[1])]
        if n.lower() in agg_out or n in ("__as_of",) or n.lower() in parent_out and not used:
            continue
        if n.lower() in derived_out and n not in [x for e in spec.derived for x in _idents(e[1])]:
            continue
        _ci_add(needed, n, _type_for(n, date_cols, text_cols))
    if spec.latest:
        for m in ("ID",):
            if any("ID" == x for x in _idents(spec.latest.maxes)):
                _ci_add(needed, m, T.IntegerType())
    schema = T.StructType([T.StructField(n, t) for n, t in needed.items()])
    rows = [tuple(_value(f.name, f.dataType, r) for f in schema.fields) for r in (1, 2)]
    tables = {spec.source: spark.createDataFrame(rows, schema)}
    for p in spec.parents:
        pcols: dict[str, object] = {}
        for _, pc in p.on:
            _ci_add(pcols, pc, _type_for(pc, set()))
        for pc, _ in p.columns:
            _ci_add(pcols, pc, _type_for(pc, set()))
        if p.where:
            for w in _idents(p.where):
                _ci_add(pcols, w, T.IntegerType() if w.lower() == "voided" else T.StringType())
        pschema = T.StructType([T.StructField(n, t) for n, t in pcols.items()])
        prow = []
        for f in pschema.fields:
            low = f.name.lower()
            if low == "id":
                prow.append(7 if p.table.lower().startswith("facilit") else 1)
            elif low == "voided":
                prow.append(0)
            elif low == "gender":
                prow.append("F")
            else:
                prow.append(_value(f.name, f.dataType, 1))
        tables[p.table] = spark.createDataFrame([tuple(prow)], pschema)
    # CT forms reference the patient by PatientId = P.ID = 1
    src = tables[spec.source]
    for lk in spec.lookups:
        tables[lk.table] = spark.createDataFrame([("raw", "std")], f"{lk.source} string, {lk.target} string")
    targets = {}
    if with_target and (spec.delta_keys or spec.delta_plain_keys):
        tcols = []
        for k in list(spec.delta_keys) + list(spec.delta_plain_keys):
            name = k[1] if isinstance(k, tuple) else k
            if name not in tcols:
                tcols.append(name)
        src_types = {f.name.lower(): f.dataType for f in src.schema.fields}
        fields, vals = [], []
        for c in tcols:
            t = src_types.get(c.lower(), _type_for(c, set()))
            if isinstance(t, T.TimestampType):
                t = T.DateType()
            fields.append(T.StructField(c, t))
            vals.append(-1 if isinstance(t, T.IntegerType) else dt.date(1900, 1, 1)
                        if isinstance(t, T.DateType) else "zz-not-a-key")
        targets[spec.target] = spark.createDataFrame([tuple(vals)], T.StructType(fields))
    return FrameIO(tables, targets), src
