"""Load specs whose forms are mapped from ``orders`` with every contract column fed.

A fixture's columns are SQL texts over ``orders`` that both engines read (two
words are spelled for Spark by ``_spark``).  A form row exists at two times of its day, so
that a DISTINCT over dates differs from one over times.  The oracles state the
joins, filters, casts and rules of the scan texts; only the names of columns that
pass through unchanged are taken from the spec.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from wardflow.plans.run import FrameIO, build_load
from wardflow.queries import query
from wardflow.queries._data import AS_OF, ntz, table

_DIGEST = "upper(sha256(unhex(regexp_replace(hex(substring(CAST({c} AS VARCHAR), 1, 36)), '(..)', '\\100', 'g'))))"
_LOADED = dt.datetime(1995, 4, 1)
_HOURS = (3, 17)


def _spark(sql: str):
    return F.expr(sql.replace("to_days(", "make_interval(0, 0, 0, ").replace("//", "div"))


class Form:
    """A form over orders: SQL texts by column name; ``ts`` is the order's day at one of two hours."""

    def __init__(self, columns: dict, contract, dates=()):
        self.columns = dict(columns)
        low = {c.lower() for c in columns}
        for c in dates:
            if c.lower() not in low:
                self.columns[c] = f"ts + to_days(CAST(o_orderkey % {sum(map(ord, c)) % 11 + 1} AS INTEGER))"
        low = {c.lower() for c in self.columns}
        for c in contract:
            if c.lower() not in low:
                self.columns[c] = f"'{c} ' || CAST(o_orderkey % {sum(map(ord, c)) % 5 + 2} AS STRING)"

    def frame(self, spark, sf):
        o = table(spark, sf, "orders").withColumn("hr", F.explode(F.array(*map(F.lit, _HOURS))))
        o = o.withColumn("ts", F.date_trunc("day", "o_orderdate").cast("timestamp_ntz") + F.make_interval(hours=F.col("hr")))
        return o.select(*[_spark(e).alias(n) for n, e in self.columns.items()])

    def loaded(self, spark, sf, keys, instead=None):
        o = table(spark, sf, "orders").withColumn("ts", F.col("o_orderdate")).where(F.col("o_orderdate") < ntz(_LOADED))
        return o.select(*[_spark((instead or {}).get(k, self.columns[k])).alias(k) for k in keys])

    def sql(self) -> str:
        cols = ", ".join(f'{e} AS "{n}"' for n, e in self.columns.items())
        hours = ", ".join(f"({h})" for h in _HOURS)
        return (f"(SELECT {cols} FROM (SELECT o.*, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_hours(hr) AS ts "
                f"FROM orders o, (VALUES {hours}) h(hr)) d)")

    def loaded_sql(self, keys, instead=None) -> str:
        cols = ", ".join(f'{(instead or {}).get(k, self.columns[k])} AS "{k}"' for k in keys)
        return f"(SELECT {cols} FROM orders WHERE o_orderdate < TIMESTAMP '{_LOADED}')"


def _spec(name):
    from wardflow.plans.catalog import SPECS
    return SPECS[name]


def _final(spec, body: str, keys, loaded: str) -> str:
    """Select the contract and digests of the rows of ``body`` whose keys are not loaded yet."""
    digests = "".join(f", {_DIGEST.format(c=f'x.{c}')} AS {h}" for c, h in spec.hashes)
    same = " AND ".join(f't."{k}" IS NOT DISTINCT FROM x."{k}"' for k in keys)
    cols = ", ".join(f'x."{c}"' for c in spec.columns)
    return f"{body}\nSELECT {cols}{digests} FROM result x WHERE NOT EXISTS (SELECT 1 FROM {loaded} t WHERE {same})"


# ---------------------------------------------------------------- mother and child forms
_MNCH_OWN = {
    "ID": "o_orderkey", "PatientPk": "o_custkey // 2", "SiteCode": "CAST(o_custkey % 10 + 1 AS INTEGER)",
    "FacilityId": "CASE WHEN o_orderkey % 7 = 0 THEN 99 ELSE CAST(o_custkey % 25 AS INTEGER) END",
    "VisitID": "'V' || CAST(o_orderkey % 3 AS STRING)", "VisitDate": "ts",
    "DateExtracted": "ts + to_days(CAST(o_orderkey % 4 AS INTEGER))",
}


def _mnch(name, source, casts=(), group=("PatientPk", "SiteCode"), day="CAST({t}.DateExtracted AS DATE)",
          facility=None, keys=("PatientPk", "SiteCode"), own=None):
    """Register the query of a mother-and-child spec; ``facility``: the column its facility row gives, and how."""
    spec = _spec(name)
    form = Form(_MNCH_OWN | (own or {}), spec.columns, dates=casts)
    taken = {"FacilityName": "f.n_name", "SiteCode": "f.n_nationkey + 500"}
    cols = []
    for c in spec.columns:
        mine = next(n for n in form.columns if n.lower() == c.lower())
        value = taken[c] if facility == c else f'p."{mine}"'
        cols.append(f'CAST({value} AS DATE) AS "{c}"' if c in casts else f'{value} AS "{c}"')
    same = " AND ".join(f'p."{g}" = tm."{g}"' for g in group)
    body = f"""
WITH form AS {form.sql()},
tm AS (SELECT {', '.join(group)}, max(ID) AS last_id, max({day.format(t='form')}) AS last_day FROM form GROUP BY ALL),
result AS (SELECT DISTINCT {', '.join(cols)}
  FROM form p JOIN tm ON {same} AND p.ID = tm.last_id AND {day.format(t='p')} = tm.last_day
  JOIN nation f ON p.FacilityId = f.n_nationkey)"""
    instead = {"SiteCode": "CAST(o_custkey % 25 + 500 AS BIGINT)"} if facility == "SiteCode" else {}
    loaded_sql = form.loaded_sql(keys, instead)

    @query(f"load_mnch_{name[4:]}", oracle=_final(spec, body, keys, loaded_sql))
    def load(spark, sf):
        n = table(spark, sf, "nation")
        loaded = form.loaded(spark, sf, keys, instead)
        facilities = n.select(F.col("n_nationkey").alias("Id"), F.col("n_name").alias("Name"),
                              (F.col("n_nationkey") + 500).alias("SiteCode"))
        return build_load(spec, FrameIO({source: form.frame(spark, sf), "Facilities": facilities},
                                        {spec.target: loaded}), AS_OF)

    load.__doc__ = f"""The {name} load spec on the test tables: latest rule, facility join, casts, DISTINCT, delta, digests."""
    return load


_mnch("p33_anc_visits", "AncVisits", ("VisitDate", "NextAppointmentANC"), ("PatientPk", "SiteCode", "VisitDate"),
      facility="SiteCode", keys=("PatientPk", "SiteCode", "VisitID", "ANCClinicNumber"))
_mnch("p35_cwc_enrolments", "CwcEnrolments",
      ("DateExtracted", "RegistrationAtCWC", "RegistrationAtHEI", "ARTStartDateMother"), facility="FacilityName")
_mnch("p37_enrolments", "MnchEnrolments",
      ("DateExtracted", "EnrollmentDateAtMnch", "HIVTestDate", "PartnerHIVTestDate"))
_mnch("p38_heis", "Heis")
_mnch("p40_labs", "MnchLabs", group=("PatientPk", "SiteCode", "OrderedbyDate"), day="{t}.DateExtracted",
      keys=("PatientPk", "SiteCode", "VisitID", "TestName", "TestResult"),
      own={"OrderedbyDate": "CAST(ts AS DATE)"})
_mnch("p41_mat_visits", "MatVisits")
_mnch("p43_patients", "MnchPatients")
_mnch("p44_pnc_visits", "PncVisits", ("DateExtracted", "VisitDate", "DeliveryDate", "NextAppointmentPNC"),
      ("SiteCode", "PatientPk", "VisitDate", "VisitID"), facility="FacilityName")

# ---------------------------------------------------------------- care-and-treatment forms
_CT_OWN = {
    "ID": "o_orderkey", "PatientId": "o_custkey", "VisitID": "'V' || CAST(o_orderkey % 11 AS STRING)",
    "VisitDate": "CAST(ts AS DATE)", "Voided": "CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN NULL ELSE 0 END",
    "Created": "ts", "Gender": "'of the form'",
}


def _ct(name, source, forms_own, where, own=None, rules=None, keys=("SiteCode", "PatientPK", "VisitID"), live=True,
        row_id="form", latest=None, computed=()):
    """Register the query of a care-and-treatment spec.

    ``forms_own`` – columns the text takes from the form although the patient or
    facility has them; ``rules`` – SQL of the cleaning rules by column; ``latest``
    – grouping columns of a newest-by-Created rule over the joined rows.
    """
    spec = _spec(name)
    form = Form(_CT_OWN | (own or {}), [c for c in spec.columns if c not in computed])
    given = {"patientid": "'CCC' || CAST(c.c_custkey AS VARCHAR)", "patientpk": "c.c_custkey",
             "sitecode": "n.n_nationkey * 100", "facilityname": "n.n_name", "emr": "'KenyaEMR'",
             "project": "CASE c.c_custkey % 3 WHEN 0 THEN 'Kenya HMIS II' ELSE 'Other' END"}
    cols = []
    for c in spec.columns:
        mine = next((n for n in form.columns if n.lower() == c.lower()), None)
        value = given.get(c.lower())
        if c.lower() == "id" and row_id == "patient":
            value = "c.c_custkey"
        if value is None or c in forms_own:
            value = f'p."{mine}"' if c not in computed else f"DATE '{AS_OF}'"
        cols.append(f'{value} AS "{c}"')
    join = ("form p JOIN customer c ON p.PatientId = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey"
            + (" AND n.n_nationkey % 12 < 10" if live else ""))
    newest = ""
    if latest:
        by = {"SiteCode": "n.n_nationkey", "PatientPK": "c.c_custkey", "voided": "p.Voided"}
        newest = (f"JOIN (SELECT {', '.join(f'{by[k]} AS k{i}' for i, k in enumerate(latest))}, max(p.Created) AS last "
                  f"FROM {join} GROUP BY ALL) tm ON p.Created = tm.last AND "
                  + " AND ".join(f"{by[k]} = tm.k{i}" for i, k in enumerate(latest)))
    clean = ", ".join(f'{sql} AS "{c}"' for c, sql in (rules or {}).items())
    body = f"""
WITH form AS {form.sql()},
scan AS (SELECT DISTINCT {', '.join(cols)} FROM {join} {newest} WHERE {where}),
result AS (SELECT * {f'REPLACE ({clean})' if clean else ''} FROM scan)"""
    tgt = {"SiteCode": "c_nationkey * 100", "PatientPK": "o_custkey"}
    pair = lambda k: tgt.get(k) or form.columns[k if k in form.columns else k.upper()]
    loaded_sql = (f"(SELECT {', '.join(f'{pair(k)} AS {k}' for k in keys)} FROM orders JOIN customer "
                  f"ON o_custkey = c_custkey WHERE o_orderdate < TIMESTAMP '{_LOADED}')")

    @query(f"load_{name[4:]}", oracle=_final(spec, body, keys, loaded_sql))
    def load(spark, sf):
        c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
        ck, nk = F.col("c_custkey"), F.col("n_nationkey")
        patient = c.select(
            ck.alias("ID"), F.concat(F.lit("CCC"), ck.cast("string")).alias("PatientCccNumber"), ck.alias("PatientPID"),
            F.when(ck % 10 == 1, F.lit("Unknown")).when(ck % 10 != 2, F.col("c_mktsegment")).alias("Gender"),
            F.col("c_nationkey").alias("FacilityId"), F.lit("KenyaEMR").alias("Emr"),
            F.when(ck % 3 == 0, F.lit("HMIS")).otherwise(F.lit("Other")).alias("Project"))
        facility = n.select(nk.alias("Id"), (nk * 100).alias("Code"), F.col("n_name").alias("Name"),
                            F.when(nk % 12 == 10, F.lit(1)).when(nk % 12 != 11, F.lit(0)).alias("Voided"))
        o = table(spark, sf, "orders").where(F.col("o_orderdate") < ntz(_LOADED)).withColumn("ts", F.col("o_orderdate"))
        loaded = o.join(c, F.col("o_custkey") == ck).select(*[_spark(pair(k)).alias(k) for k in keys])
        return build_load(spec, FrameIO({source: form.frame(spark, sf), "PatientExtract": patient, "Facility": facility},
                                        {spec.target: loaded}), AS_OF)

    load.__doc__ = f"""The {name} load spec on the test tables: parent joins, filters, DISTINCT, rules, delta, digests."""
    return load


_KNOWN = "CASE c.c_custkey % 10 WHEN 1 THEN 'Unknown' WHEN 2 THEN NULL ELSE 'known' END <> 'Unknown'"


def _window(c: str, lo: str) -> str:
    return f"CASE WHEN \"{c}\" < DATE '{lo}' OR \"{c}\" > DATE '{AS_OF}' THEN DATE '1900-01-01' ELSE \"{c}\" END"


_ct("p04_cancer_screening", "CancerScreeningExtract", ("Emr", "Project"), _KNOWN, live=False, computed=("LoadDate",))
_ct("p05_cervical_cancer_screening", "CervicalCancerScreeningExtract", ("Emr", "Project", "FacilityName"),
    f"{_KNOWN} AND p.Voided = 0")
_ct("p15_iit_risk_scores", "IITRiskScoresExtract", ("Emr", "Project", "FacilityName"),
    f"{_KNOWN} AND n.n_nationkey * 100 > 0", keys=("Id",), computed=("LoadDate",))
_ct("p17_otz", "OtzExtract", (), f"{_KNOWN} AND n.n_nationkey * 100 > 0", row_id="patient",
    own={"OTZEnrollmentDate": "CAST(ts AS DATE) + CAST(o_orderkey % 9000 AS INTEGER)",
         "TransferInStatus": "CAST(o_orderkey % 3 AS STRING)"},
    rules={"OTZEnrollmentDate": _window("OTZEnrollmentDate", "2012-01-01"),
           "TransferInStatus": "CASE TransferInStatus WHEN '1' THEN 'Yes' WHEN '0' THEN 'No' ELSE TransferInStatus END"})
_ct("p19_patient_baselines", "PatientBaselinesExtract", (), f"{_KNOWN} AND n.n_nationkey * 100 > 0",
    keys=("SiteCode", "PatientPK"), latest=("SiteCode", "PatientPK", "voided"),
    own={"bCD4": "CAST(o_orderkey % 40 - 9 AS STRING)",
         "bWHODate": "CAST(ts AS DATE) - CAST(o_orderkey % 9000 AS INTEGER)",
         "bCD4Date": "CAST(ts AS DATE) + CAST(o_orderkey % 4000 AS INTEGER)"},
    rules={"bCD4": "CASE WHEN TRY_CAST(bCD4 AS DOUBLE) < 0 THEN '999' ELSE bCD4 END",
           "bWHODate": _window("bWHODate", "1980-01-01"), "bCD4Date": _window("bCD4Date", "1980-01-01")})

# ---------------------------------------------------------------- testing forms
_HTS_OWN = {
    "ID": "o_orderkey", "PatientPk": "o_custkey // 2", "SiteCode": "CAST(o_custkey % 10 + 1 AS INTEGER)",
    "HtsNumber": "'H' || CAST(o_custkey AS STRING)",
}
_TRACING = Form(_HTS_OWN | {
    "TracingType": "CASE WHEN o_orderkey % 5 <> 0 THEN 'Phone' END",
    "TracingOutcome": "CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END", "TracingDate": "CAST(ts AS DATE)",
}, _spec("p27_client_tracing").columns)
_P27_KEYS = ("PatientPk", "SiteCode", "HtsNumber", "TracingOutcome")


@query("load_hts_client_tracing", oracle=_final(_spec("p27_client_tracing"), f"""
WITH result AS (
  SELECT DISTINCT {', '.join(f'a."{c}"' for c in _spec("p27_client_tracing").columns)}
  FROM {_TRACING.sql()} a JOIN (SELECT c_custkey // 2 AS pk, c_custkey % 10 + 1 AS site FROM customer WHERE c_acctbal > 0) cl
    ON a.PatientPk = cl.pk AND a.SiteCode = cl.site
  WHERE a.TracingType IS NOT NULL AND a.TracingOutcome IS NOT NULL)""", _P27_KEYS, _TRACING.loaded_sql(_P27_KEYS)))
def load_hts_client_tracing(spark, sf):
    """The p27_client_tracing load spec on the test tables: client existence, NOT NULL filters, DISTINCT, delta, digests."""
    spec = _spec("p27_client_tracing")
    c = table(spark, sf, "customer")
    clients = c.where("c_acctbal > 0").select(F.floor(F.col("c_custkey") / 2).cast("long").alias("PatientPk"),
                                              (F.col("c_custkey") % 10 + 1).cast("int").alias("SiteCode"))
    return build_load(spec, FrameIO({"HtsClientTracing": _TRACING.frame(spark, sf), "Clients": clients},
                                    {spec.target: _TRACING.loaded(spark, sf, _P27_KEYS)}), AS_OF)


_CLIENTS = Form(_HTS_OWN | {
    "DateCreated": "ts + to_days(CAST(o_orderkey % 3 AS INTEGER))", "DateExtracted": "ts + to_days(9000)",
    "Dob": "ts - to_days(CAST(o_orderkey % 40000 AS INTEGER))",
    "Gender": "CASE o_orderkey % 3 WHEN 0 THEN 'Female' WHEN 1 THEN 'M' ELSE 'Other' END",
    "PatientDisabled": "CASE o_orderkey % 4 WHEN 0 THEN 'No' WHEN 1 THEN 'D: Deaf' END", "MaritalStatus": "o_orderstatus",
}, [c for c in _spec("p28_clients").columns if c not in ("KeyPopulationType", "DisabilityType")])
_P28_TAKEN = {
    "Dob": "CASE WHEN d >= DATE '1910-01-01' AND d <= DATE '2000-12-31' THEN d END",
    "Gender": "CASE g WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' ELSE g END",
    "KeyPopulationType": "CAST(NULL AS VARCHAR)",
    "PatientDisabled": "CASE WHEN dis = 'No' THEN 'No' ELSE 'Yes' END",
    "DisabilityType": "CASE WHEN dis = 'D: Deaf' THEN 'Deaf' ELSE dis END",
    "MaritalStatus": "CASE WHEN MaritalStatus = 'F' THEN 'Married' ELSE MaritalStatus END",
}
_P28_KEYS = ("PatientPk", "SiteCode")


@query("load_hts_clients", oracle=_final(_spec("p28_clients"), f"""
WITH form AS {_CLIENTS.sql()},
tm AS (SELECT SiteCode, PatientPk, max(ID) AS last_id, max(CAST(DateCreated AS DATE)) AS last_day FROM form GROUP BY ALL),
latest AS (SELECT form.*, CAST(Dob AS DATE) AS d, left(Gender, 1) AS g, coalesce(PatientDisabled, '') AS dis
  FROM form JOIN tm USING (SiteCode, PatientPk)
  WHERE ID = last_id AND CAST(DateCreated AS DATE) = last_day AND DateExtracted > TIMESTAMP '2019-09-08'),
result AS (SELECT DISTINCT {', '.join(f'{_P28_TAKEN.get(c, chr(34) + c + chr(34))} AS "{c}"' for c in _spec("p28_clients").columns)}
  FROM latest)""", _P28_KEYS, _CLIENTS.loaded_sql(_P28_KEYS)))
def load_hts_clients(spark, sf):
    """The p28_clients load spec on the test tables: latest rule, extraction cut-off, casts, recodes, two lookups,
    constant NULL, delta, digests."""
    spec = _spec("p28_clients")
    o = table(spark, sf, "orders")
    marital = o.where("o_orderstatus = 'F'").select(F.lit("F").alias("Source_MaritalStatus"),
                                                    F.lit("Married").alias("Target_MaritalStatus")).distinct()
    disability = o.where("o_orderkey % 4 = 1").select(F.lit("D: Deaf").alias("Source_Disability"),
                                                      F.lit("Deaf").alias("Target_Disability")).distinct()
    return build_load(spec, FrameIO({"Clients": _CLIENTS.frame(spark, sf), "lkp_MaritalStatus": marital,
                                     "lkp_htsDisability": disability},
                                    {spec.target: _CLIENTS.loaded(spark, sf, _P28_KEYS)}), AS_OF)
