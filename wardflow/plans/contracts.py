"""Typed target contracts of the load specs.

The target database states one table, the patient visits.  Its columns and
types are given below; a column of that name has that type in every target.  Of other columns,
those under a date rule or a cast to date are dates, digests are text of 100
characters, and all else is text of 4000.
"""

from __future__ import annotations

from pyspark.sql import types as T

from wardflow.plans.spec import LoadSpec, cols

# FIXED VALUES: column types and lengths of the stated target table
_DATES = cols("VisitDate,OIDate,NextAppointmentDate,DateImported")
_TIMES = cols("RefillDate,Date_Last_Modified,Date_Created,LoadDate")
_FLAGS = cols("DeletedFlag,voided")
_INTS = cols("PulseRate,RespiratoryRate,Muac")
_DECIMALS = cols("Temp,OxygenSaturation")
_TEXT = {
    50: cols("PatientID,SiteCode,PatientPK,VisitID"),
    100: cols("SubstitutionFirstlineReg,SubstitutionSecondLineReg,SecondLineRegChange,Emr,Project,PatientPKHash,PatientIDHash"),
    150: cols("FacilityName,SERVICE,VisitType,WHOStage,WABStage,Pregnant,LMP,EDD,Height,Weight,BP,OI,Adherence,AdherenceCategory,"
              "FamilyPlanningMethod,PwP,GestationAge,SubstitutionFirstLineRegReason,SubstitutionSecondLineRegReason,"
              "SecondLineRegChangeReason,ZScore,ZScoreAbsolute,PaedsDisclosure,RecordUUID"),
}
LONGEST = 4000  # every other text column of that table
DIGEST = 100

_TYPES: dict[str, T.DataType] = {c.lower(): t for names, t in (
    (_DATES, T.DateType()), (_TIMES, T.TimestampNTZType()), (_FLAGS, T.BooleanType()), (_INTS, T.IntegerType()),
    (_DECIMALS, T.DecimalType(18, 2))) for c in names}
_LENGTHS = {c.lower(): n for n, names in _TEXT.items() for c in names}


def contract(spec: LoadSpec) -> tuple[T.StructType, dict[str, int]]:
    """Schema of the spec's target, in its order, and the lengths of its text columns."""
    dates = {r.column.lower() for r in (*spec.rules, *spec.select_rules) if r.kind == "date" and not r.kwargs().get("text")}
    dates |= {c.lower() for c, e in spec.select if e.upper().endswith("AS DATE)")}
    dates |= {n.lower() for n, e in spec.derived if e == "{as_of}"}
    digests = {h for _, h in spec.hashes}
    fields, lengths = [], {}
    for c in (*spec.columns, *[h for _, h in spec.hashes]):
        low = c.lower()
        kind = T.DateType() if low in dates else _TYPES.get(low, T.StringType())
        if isinstance(kind, T.StringType):
            lengths[c] = DIGEST if c in digests else _LENGTHS.get(low, LONGEST)
        fields.append(T.StructField(c, kind))
    return T.StructType(fields), lengths
