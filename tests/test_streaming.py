"""Structured Streaming runner: deliveries arrive as files, the target ends up whole."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from wardflow.plans.run import FrameIO, build_load
from wardflow.plans.spec import Latest, LoadSpec, cols, rule
from wardflow.streaming.incremental import stream_load

SPEC = LoadSpec(name="visits_stream", source="visit_extract", target="visits",
                columns=cols("SiteCode,PatientPK,VisitID,VisitDate,Weight"),
                latest=Latest(("SiteCode", "PatientPK", "VisitID"), ("ID",)),
                rules=(rule("Weight", "number", lo=0, hi=200),),
                delta_keys=("SiteCode", "PatientPK", "VisitID"))


def _extract(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.select(F.col("o_orderkey").alias("ID"), (F.col("o_custkey") % 7).cast("int").alias("SiteCode"),
                    F.col("o_custkey").alias("PatientPK"), (F.col("o_orderkey") % 50).alias("VisitID"),
                    F.to_date("o_orderdate").alias("VisitDate"),
                    (F.col("o_totalprice") / 1000).cast("int").cast("string").alias("Weight"))


def test_stream_two_deliveries_partitioned_target(spark, sf_small):
    ex = _extract(spark, sf_small)
    base = tempfile.mkdtemp(prefix="wf-stream-")
    src, tgt, ck = (os.path.join(base, x) for x in ("src", "tgt", "ck"))
    cut = dt.date(1998, 1, 1)
    ex.filter(F.col("VisitDate") < F.lit(cut)).write.parquet(f"{src}/delivery=1")
    stream_load(spark, SPEC, src, tgt, dt.date(2024, 1, 1), checkpoint=ck, partition_by=("SiteCode",)).awaitTermination()
    ex.filter(F.col("VisitDate") >= F.lit(cut)).write.parquet(f"{src}/delivery=2")
    stream_load(spark, SPEC, src, tgt, dt.date(2024, 1, 1), checkpoint=ck, partition_by=("SiteCode",)).awaitTermination()
    got = spark.read.parquet(tgt).select("SiteCode", "PatientPK", "VisitID")
    # every key exactly once: the second delivery's versions of loaded keys are dropped
    assert got.count() == got.distinct().count()
    # batch-by-batch semantics: run the batch load per delivery against the growing target
    first = build_load(SPEC, FrameIO({"visit_extract": ex.filter(F.col("VisitDate") < F.lit(cut))}), dt.date(2024, 1, 1))
    second = build_load(SPEC, FrameIO({"visit_extract": ex.filter(F.col("VisitDate") >= F.lit(cut))},
                                      {"visits": first}), dt.date(2024, 1, 1))
    want = first.unionByName(second).select("SiteCode", "PatientPK", "VisitID")
    assert sorted(got.collect()) == sorted(want.collect())


def test_stream_keeps_a_layout_column_of_the_contract(spark, tmp_path):
    """An extract laid out by SiteCode=... folders keeps its SiteCode."""
    src, tgt = str(tmp_path / "src"), str(tmp_path / "tgt")
    rows = [(1, 11, 100, 1, dt.date(2023, 1, 1), "50"), (2, 12, 101, 2, dt.date(2023, 1, 2), "60")]
    df = spark.createDataFrame(rows, "ID int, SiteCode int, PatientPK int, VisitID int, VisitDate date, Weight string")
    df.write.partitionBy("SiteCode").parquet(src)
    stream_load(spark, SPEC, src, tgt, dt.date(2024, 1, 1), checkpoint=str(tmp_path / "ck")).awaitTermination()
    assert sorted(r.SiteCode for r in spark.read.parquet(tgt).collect()) == [11, 12]
