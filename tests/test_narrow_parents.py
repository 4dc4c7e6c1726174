"""Distinct loads join their parents on narrow rows; whole rows are shuffled once and those that occur once are not held."""

import dataclasses
import datetime as dt
import itertools

from test_wide_rows import _nodes, large  # noqa: F401
from wardflow.plans.run import FrameIO, build_load
from wardflow.plans.spec import Latest, LoadSpec, Parent, rules_of

NOTES = tuple(f"Note{i}" for i in range(30))
PATIENT = Parent("Patient", (("PatientId", "ID"),), columns=(("Ccc", "PatientID"), ("Gender", "Gender"), ("FacilityId", "FacilityId")))
FACILITY = Parent("Facility", (("FacilityId", "Id"),), columns=(("Code", "Site"),), where="NOT Voided")
KNOWN = Parent("Known", (("Visit", "Visit"),), kind="semi")
SPEC = LoadSpec(name="form", source="Form", target="Target", columns=("PatientID", "Site", "Visit", "Day", *NOTES),
                parents=(PATIENT, FACILITY, KNOWN), where=("Gender <> 'Unknown'", "Code IS NULL OR Code <> Site"),
                delta_keys=("Site", "Visit"), select=(("Day", "CAST(Day AS DATE)"),), rules=rules_of("blank", ["Visit", "PatientID"]))
T = dt.datetime


def _io(spark):
    days = [T(2020, 1, 1, 3), T(2020, 1, 1, 17), T(2020, 1, 2, 3), None]
    rows = [(p, v, d, i, 7 if i % 5 == 0 else None, f"n{i % 2}" if i % 7 else None)
            for i, (p, v, d) in enumerate(itertools.product([1, 2, 3, 4, 9, None], ["a", "b", "", None], days))]
    rows += rows[::3] + [(p, v, d, i + 1, c, n) for p, v, d, i, c, n in rows[::4]]  # again, and again with another number
    form = spark.createDataFrame(rows, "PatientId int, Visit string, Day timestamp_ntz, ID int, Code int, note string")
    form = form.selectExpr("PatientId", "Visit", "Day", "ID", "Code", *[f"note AS {n}" for n in NOTES])
    patients = [(1, "c1", "F", 10), (2, "c1", "F", 10),  # two of one name, whose rows are alike in the target
                (3, "", None, 11), (3, "c3", "F", 11), (3, "c3", "F", 11), (3, "c3", "Unknown", 11), (4, "c4", "M", 12), (None, "c5", "M", 10)]
    tables = {"Form": form, "Patient": spark.createDataFrame(patients, "ID int, Ccc string, Gender string, FacilityId int"),
              "Facility": spark.createDataFrame([(10, 5, False), (11, 7, False), (11, None, False), (12, 8, True)], "Id int, Code int, Voided boolean"),
              "Known": spark.createDataFrame([("a",), ("a",), ("",), (None,), ("b",)], "Visit string")}
    return FrameIO(tables, {"Target": spark.createDataFrame([(5, "a"), (7, None)], "Site int, Visit string")})


def _rows(df):
    return sorted(map(repr, df.collect()))


def _check(spark, spec):
    day = dt.date(2021, 1, 1)
    plain = _rows(build_load(spec, _io(spark), day, split_nulls=True))  # parents, DISTINCT and delta on whole rows
    assert _rows(build_load(spec, _io(spark), day)) == plain
    assert len(plain) > 5


def test_rows_are_those_of_the_plain_joins(spark, large):  # noqa: F811
    _check(spark, SPEC)


def test_rows_with_a_latest_rule(spark, large):  # noqa: F811
    _check(spark, dataclasses.replace(SPEC, latest=Latest(("PatientId", "Visit"), ("ID",))))


def test_parents_meet_no_whole_row(spark, large):  # noqa: F811
    plan = build_load(SPEC, _io(spark), dt.date(2021, 1, 1))._jdf.queryExecution().executedPlan()
    wide = [n for n in _nodes(plan) if n.getClass().getSimpleName() in ("ShuffleExchangeExec", "SortExec")
            and "Note7#" in n.output().mkString(" ")]
    assert len(wide) == 1
