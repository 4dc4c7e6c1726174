"""Parquet-backed load through the command line: first run loads, second appends nothing."""

import datetime as dt
import os
import tempfile

from spec_fixtures import build_io
from wardflow.__main__ import main
from wardflow.plans.catalog import SPECS


def test_cli_load_twice(spark):
    spec = SPECS["p23_patient_visits"]
    io, _ = build_io(spark, spec, with_target=False)
    base = tempfile.mkdtemp(prefix="wf-cli-")
    src, tgt = os.path.join(base, "src"), os.path.join(base, "tgt")
    for name, df in io.tables.items():
        df.write.parquet(os.path.join(src, name))
    args = ["load", "p23", "--source-dir", src, "--target-dir", tgt, "--as-of", "2024-01-31"]
    main(args)
    first = spark.read.parquet(os.path.join(tgt, spec.target))
    n1 = first.count()
    assert n1 == 1
    assert first.columns == list(spec.columns) + [h for _, h in spec.hashes]
    main(args)
    assert spark.read.parquet(os.path.join(tgt, spec.target)).count() == n1


def test_cli_monthly_outcomes(spark):
    """The outcome job over ODS-shaped targets, written partitioned by month."""
    D = dt.date
    base = tempfile.mkdtemp(prefix="wf-out-")
    keys = "PatientPK long, PatientID string, SiteCode int"
    spark.createDataFrame([(1, "P1", 5, D(2020, 1, 10), D(2020, 2, 9)), (2, "P2", 5, D(2020, 3, 1), None)],
                          f"{keys}, VisitDate date, NextAppointmentDate date") \
        .write.parquet(os.path.join(base, "ods", "CT_PatientVisits"))
    spark.createDataFrame([(1, "P1", 5, D(2020, 2, 1), D(2020, 4, 1))],
                          f"{keys}, DispenseDate date, ExpectedReturn date") \
        .write.parquet(os.path.join(base, "ods", "CT_PatientPharmacy"))
    spark.createDataFrame([(2, "P2", 5, D(2020, 5, 5), "DIED", None)],
                          f"{keys}, ExitDate date, ExitReason string, EffectiveDiscontinuationDate date") \
        .write.parquet(os.path.join(base, "ods", "CT_PatientStatus"))
    spark.createDataFrame([(1, "P1", 5, D(2019, 1, 1)), (2, "P2", 5, D(2019, 1, 1))],
                          f"{keys}, StartARTDate date") \
        .write.parquet(os.path.join(base, "ods", "CT_ARTPatients"))
    out = os.path.join(base, "out")
    main(["outcomes", "--target-dir", os.path.join(base, "ods"), "--out", out,
          "--start", "2020-01-01", "--end", "2020-06-30"])
    got = {(r.PatientID, str(r.AsOfDate)[:7]): r.ARTOutcome for r in spark.read.parquet(out).collect()}
    assert got[("P1", "2020-01")] == "V" and got[("P1", "2020-06")] == "uL"
    assert got[("P2", "2020-04")] == "NV" and got[("P2", "2020-05")] == "D"
    assert ("P2", "2020-02") not in got
    # a rebuild over a shorter range leaves no month of the longer one
    main(["outcomes", "--target-dir", os.path.join(base, "ods"), "--out", out,
          "--start", "2020-03-01", "--end", "2020-04-30"])
    assert {str(r.AsOfDate)[:7] for r in spark.read.parquet(out).collect()} == {"2020-03", "2020-04"}


def test_cli_repair_dates(spark):
    base = tempfile.mkdtemp(prefix="wf-rep-")
    rows = [("k1", "2023-12-25", "25/12/2023"), ("k2", "n/a", None), ("k3", "05/12/2023", "2023-01-31")]
    spark.createDataFrame(rows, "id string, TestKitExpiry1 string, TestKitExpiry2 string") \
        .write.parquet(os.path.join(base, "HTS_TestKits"))
    out = os.path.join(base, "repaired")
    main(["repair-dates", "--table", os.path.join(base, "HTS_TestKits"), "--out", out])
    got = {r.id: (r.TestKitExpiry1, r.TestKitExpiry2) for r in spark.read.parquet(out).collect()}
    D = dt.date
    assert got == {"k1": (D(2023, 12, 25), D(2023, 12, 25)), "k2": (None, None),
                   "k3": (D(2023, 12, 5), D(2023, 1, 31))}
