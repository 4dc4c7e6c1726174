"""Command line: run load specs or the monthly outcome job on Parquet folders.

  python -m wardflow list
  python -m wardflow load p23 --source-dir S --target-dir T [--as-of 2024-01-31] [--partitions 50]
  python -m wardflow load all --source-dir S --target-dir T
  python -m wardflow outcomes --target-dir T --out O --start 2017-01-01 --end 2023-03-31
  python -m wardflow repair-dates --table T/HTS_TestKits --out T/HTS_TestKits_repaired

Sources are folders ``S/<table>`` (forms, parents, lookups); targets live in
``T/<target table>``.  Runs under whatever master spark-submit provides.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="wardflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    ld = sub.add_parser("load")
    ld.add_argument("spec")
    ld.add_argument("--source-dir", required=True)
    ld.add_argument("--target-dir", required=True)
    ld.add_argument("--as-of", default=None)
    ld.add_argument("--partitions", type=int, default=None, help="value for specs whose parallelism is configured")
    ld.add_argument("--fixed-partitions", action="store_true",
                    help="honour the specs' fixed writer counts instead of AQE rebalancing")
    ld.add_argument("--versions", action="store_true", help="commit each batch as a version of its target")
    ld.add_argument("--batch", default=None, help="id of this run; with --versions a repeated run adds nothing twice")
    ld.add_argument("--partition-by", default="", help="comma-separated target layout columns, e.g. SiteCode")
    rp = sub.add_parser("repair-dates")
    rp.add_argument("--table", required=True, help="input Parquet folder (e.g. T/HTS_TestKits)")
    rp.add_argument("--out", required=True, help="new folder for the repaired table")
    rp.add_argument("--columns", default="TestKitExpiry1,TestKitExpiry2")
    oc = sub.add_parser("outcomes")
    oc.add_argument("--target-dir", required=True)
    oc.add_argument("--out", required=True)
    oc.add_argument("--start", default="2017-01-01")
    oc.add_argument("--end", default="2023-03-31")
    a = ap.parse_args(argv)

    from wardflow.plans.catalog import SPECS, by_id
    if a.cmd == "list":
        for name, s in SPECS.items():
            print(f"{name:40s} {s.source:40s} -> {s.target}")
        return

    from wardflow.session import build_session
    spark = build_session(app="wardflow")
    if a.cmd == "load":
        from wardflow.plans.run import ParquetIO, VersionedIO, run_load
        as_of = dt.date.fromisoformat(a.as_of) if a.as_of else dt.date.today()
        io = (VersionedIO if a.versions else ParquetIO)(spark, a.source_dir, a.target_dir, default_partitions=a.partitions,
                       fixed_partitions=a.fixed_partitions,
                       partition_by=tuple(c for c in a.partition_by.split(",") if c))
        specs = list(SPECS.values()) if a.spec == "all" else [SPECS.get(a.spec) or by_id(a.spec)]
        for s in specs:
            print(json.dumps(run_load(s, io, as_of, batch=a.batch if a.versions else None)))
    elif a.cmd == "repair-dates":
        from wardflow.operators.repair import repair_dates
        df = spark.read.parquet(a.table)
        repair_dates(df, [c for c in a.columns.split(",") if c]).write.mode("errorifexists").parquet(a.out)
    elif a.cmd == "outcomes":
        from wardflow.operators.asof import monthly_outcomes
        from wardflow.sources.sinks import rebuild
        t = lambda n: spark.read.parquet(f"{a.target_dir}/{n}")
        visits = t("CT_PatientVisits").select("PatientPK", "PatientID", "SiteCode", "VisitDate", "NextAppointmentDate")
        pharm = t("CT_PatientPharmacy").select("PatientPK", "PatientID", "SiteCode", "DispenseDate", "ExpectedReturn")
        status = t("CT_PatientStatus").select("PatientPK", "PatientID", "SiteCode", "ExitDate", "ExitReason",
                                              "EffectiveDiscontinuationDate")
        art = t("CT_ARTPatients").select("PatientPK", "PatientID", "SiteCode", "StartARTDate")
        out = monthly_outcomes(visits, pharm, status, art, dt.date.fromisoformat(a.start),
                               dt.date.fromisoformat(a.end))
        rebuild(out, a.out, ["AsOfDate"])


if __name__ == "__main__":
    main()
