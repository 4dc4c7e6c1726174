"""Reader options, schema contract and sink helpers."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from wardflow.sources.conform import conform
from wardflow.sources.readers import jdbc_options, read_key_range
from wardflow.sources.sinks import apply_corrections


def test_jdbc_options_derived_table_and_split():
    o = jdbc_options("jdbc:sqlserver://db;databaseName=x", text="SELECT a FROM t WHERE b > 0",
                     partition_column="SiteCode", lower=10019, upper=28742, num_partitions=18)
    assert o["dbtable"] == "(SELECT a FROM t WHERE b > 0) src"
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == \
        ("SiteCode", "10019", "28742", "18")


def test_conform_types_lengths_missing(spark):
    df = spark.createDataFrame([("7", "2023-12-25", "12.345", "abcdef")], "ID string, d string, x string, s string")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("D", T.DateType()),
                           T.StructField("x", T.DecimalType(18, 2)), T.StructField("s", T.StringType()),
                           T.StructField("missing", T.StringType())])
    r = conform(df, schema, lengths={"s": 6}, missing_as_null=True).first()
    assert (r.id, r.D, float(r.x), r.s, r.missing) == (7, dt.date(2023, 12, 25), 12.35, "abcdef", None)
    with pytest.raises(KeyError):
        conform(df, schema)
    with pytest.raises(Exception, match="s does not fit"):  # text is refused, never cut
        conform(df, schema, lengths={"s": 3}, missing_as_null=True).collect()
    bad = spark.createDataFrame([("x", "n/a", "?", None), ("1", None, "2", "abcd")], "ID string, d string, x string, s string")
    with pytest.raises(Exception, match="id does not fit"):
        conform(bad, schema, missing_as_null=True).collect()
    rows = conform(bad, schema, lengths={"s": 3}, missing_as_null=True, misfit="reject").collect()
    assert [(r.id, r.D, r.s, r._misfits) for r in rows] == [(None, None, None, 3), (1, None, None, 1)]


def test_key_range_strides_cover_every_row_once(spark):
    df = spark.createDataFrame([(None,), (-5,), (0,), (9,), (10,), (35,), (40,), (99,)], "k int")
    parts = read_key_range(df, "k", 0, 40, 4)
    got = [[r.k for r in p.collect()] for p in parts]
    assert got == [[None, -5, 0, 9], [10], [], [35, 40, 99]]


def test_unreadable_target_is_an_error_and_a_missing_one_is_none(spark, tmp_path):
    from wardflow.plans.run import ParquetIO
    io = ParquetIO(spark, str(tmp_path), str(tmp_path))
    assert io.target("none_yet") is None
    torn = tmp_path / "torn"
    torn.mkdir()
    (torn / "part-0.parquet").write_bytes(b"PAR1 torn")
    with pytest.raises(Exception):
        io.target("torn")


def test_rebuild_leaves_no_old_partition(spark, tmp_path):
    from wardflow.sources.sinks import rebuild
    path = str(tmp_path / "t")
    rebuild(spark.createDataFrame([(1, "a"), (2, "b")], "k int, m string"), path, ["m"])
    rebuild(spark.createDataFrame([(3, "b")], "k int, m string"), path, ["m"])
    assert [(r.k, r.m) for r in spark.read.parquet(path).collect()] == [(3, "b")]


def test_apply_corrections_only_matching_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    fixes = spark.createDataFrame([(1, "A"), (3, "C")], "k int, nv string")
    out = sorted(apply_corrections(df, fixes, "k", {"v": "nv"}).collect(), key=lambda r: (r.k is None, r.k or 0))
    assert [(r.k, r.v) for r in out] == [(1, "A"), (2, "b"), (None, "c")]
    assert apply_corrections(df, fixes, "k", {"v": "nv"}).columns == ["k", "v"]


def test_jdbc_io_builds_without_connecting(spark):
    from wardflow.plans.run import JdbcIO
    io = JdbcIO(spark, "jdbc:sqlserver://src", "jdbc:sqlserver://ods",
                sources={"PatientVisitExtract": "SELECT * FROM dbo.PatientVisitExtract"},
                partitioned={"PatientVisitExtract": ("SiteCode", 10019, 28742, 18)})
    assert io.sources and io.partitioned
