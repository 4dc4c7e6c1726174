"""Typed contracts of all specs, rejects, and versions of targets."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spec_fixtures import build_io
from wardflow.plans.catalog import SPECS
from wardflow.plans.contracts import contract
from wardflow.plans.run import VersionedIO, run_load, typed_load
from wardflow.sources.conform import checked, fitting, rejected
from wardflow.sources.versions import VersionedTable

AS_OF = dt.date(2024, 1, 1)


@pytest.mark.parametrize("name", sorted(SPECS))
def test_every_spec_loads_in_its_types(spark, name):
    spec = SPECS[name]
    schema, lengths = contract(spec)
    assert schema.names == [*spec.columns, *[h for _, h in spec.hashes]]
    assert all(f.name in lengths for f in schema if isinstance(f.dataType, T.StringType))
    io, _ = build_io(spark, spec)
    rows = typed_load(spec, io, AS_OF)
    assert [f.dataType for f in rows.schema][:-1] == [f.dataType for f in schema]
    found = rows.collect()
    assert found and all(r["_misfits"] == [] for r in found)


KINDS = [  # type, values that fit, values that do not
    ("date", T.DateType(), ["2024-02-29", "2024-01-01 10:11:12"], ["2023-02-29", "29/02/2024", "soon", ""]),
    ("time", T.TimestampNTZType(), ["2024-02-29 23:59:59"], ["2024-02-29 25:00:00", "x"]),
    ("flag", T.BooleanType(), ["1", "false", "True"], ["2", "maybe", ""]),
    ("whole", T.IntegerType(), ["0", "-7", "2147483647"], ["2147483648", "1e3x", "a"]),
    ("decimal", T.DecimalType(18, 2), ["36.65", "-1"], ["99999999999999999", "3,5"]),
    ("text", T.StringType(), ["", "ärgerlich!"], ["elevenchars"]),
]


@pytest.mark.parametrize("name,kind,good,bad", KINDS, ids=[k[0] for k in KINDS])
def test_misfits_are_set_aside_and_counted(spark, name, kind, good, bad):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*good, *bad, None])], "k long, c string")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("C", kind)])
    rows = checked(df, schema, {"C": 10} if name == "text" else None)
    assert {r["k"] for r in fitting(rows).collect()} == {*range(len(good)), len(good) + len(bad)}
    aside = {r["k"]: r for r in rejected(rows).collect()}
    assert {k: [tuple(m) for m in r["_misfits"]] for k, r in aside.items()} == {
        len(good) + i: [("C", v)] for i, v in enumerate(bad)}
    assert all(r["C"] is None for r in aside.values())
    with pytest.raises(KeyError):
        checked(df.drop("c"), schema)


def test_load_rejects_and_versions(spark, tmp_path):
    """A visit with a pulse that is no number goes to the rejects; the same batch again changes nothing."""
    spec = SPECS["p23_patient_visits"]
    io, _ = build_io(spark, spec, with_target=False)
    visits = io.tables[spec.source].where("ID = 2")
    bad = visits.withColumns({"VisitID": F.lit("other"), "PulseRate": F.lit("fast"), "Temp": F.lit("36.6")})
    good = visits.withColumns({"PulseRate": F.lit("71"), "Temp": F.lit("36.6")})
    typed = {c: F.lit(None).cast("string") for c in ("OxygenSaturation", "RespiratoryRate", "Muac", "DateImported", "DeletedFlag")
             if c in visits.columns}
    for name, df in {**io.tables, spec.source: good.unionByName(bad).withColumns(typed)}.items():
        df.write.parquet(f"{tmp_path}/source/{name}")
    disk = VersionedIO(spark, f"{tmp_path}/source", f"{tmp_path}/target")
    first = run_load(spec, disk, AS_OF, batch="b1")
    assert (first["new_rows"], first["rejected_rows"]) == (1, 1)
    assert disk.target(spec.target).schema["PulseRate"].dataType == T.IntegerType()
    aside = disk.target(f"{spec.target}_rejects").collect()
    assert [[tuple(m) for m in r["_misfits"]] for r in aside] == [[("PulseRate", "fast")]]
    assert run_load(spec, disk, AS_OF, batch="b1")["new_rows"] == 0
    assert disk.target(spec.target).count() == 1 and disk.target(f"{spec.target}_rejects").count() == 1
    assert run_load(spec, disk, AS_OF, batch="b2")["new_rows"] == 0  # loaded already


def test_a_failed_batch_leaves_the_old_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.read() is None
    table.append(spark.range(0, 10), "one")
    table.append(spark.range(10, 20), "two")
    broken = spark.range(20, 4000, 1, 8).withColumn("id", F.when(F.col("id") == 3999, F.raise_error(F.lit("lost")).cast("long"))
                                                    .otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        table.append(broken, "three")
    with pytest.raises(Exception, match="lost"):
        table.rebuild(broken, "four")
    assert sorted(r[0] for r in table.read().collect()) == list(range(20))
    table.append(spark.range(20, 30), "three")
    for _ in range(2):
        table.append(spark.range(10, 20), "two")  # a retry of a batch that was committed
    assert sorted(r[0] for r in table.read().collect()) == list(range(30))
    table.rebuild(table.read().where("id % 2 = 0"), "four")
    assert sorted(r[0] for r in table.read().collect()) == list(range(0, 30, 2))
    assert [r["kind"] for r in table.log()] == ["append", "append", "append", "rebuild"]
    assert table.read(version=2).count() == 20  # older versions stay readable
    assert table.unlisted([*table.folders(), "data/x"]) == ["data/x"]
    # a log folder that a dead writer left empty is passed over
    (tmp_path / "t" / "log" / "version=5").mkdir()
    assert table.append(spark.range(1), "five") == 6 and table.read().count() == 16


def test_load_counts_what_each_rule_changed(spark):
    """The load's own writes give the counts; the rows are those of a load without them."""
    spec = SPECS["p23_patient_visits"]
    io, _ = build_io(spark, spec, with_target=False)
    form = io.tables[spec.source]
    io.tables[spec.source] = form.withColumns({"Pregnant": F.lit("LIVE BIRTH"), "Weight": F.lit("-1"), "Height": F.lit("")})
    plain = typed_load(spec, io, AS_OF).drop("_misfits")
    n = plain.count()
    counts = run_load(spec, io, AS_OF, audit_rules=True)
    kinds = {f"{r.column} {r.kind}" for r in spec.rules} | {f"{lk.column} lookup" for lk in spec.lookups}
    assert n and counts["new_rows"] == n and kinds == set(counts["rules"])
    changed = {k for k, c in counts["rules"].items() if c}
    assert {"Pregnant recode", "Weight number", "Height blank"} <= changed
    assert {counts["rules"][k] for k in ("Pregnant recode", "Weight number", "Height blank")} == {n}
