"""Plan-shape guards for the scale design, plus a hot-key fixture.

A key holding a third of all rows must be reduced map-side before any
shuffle; no operator may fall back to a cartesian or nested-loop join.
"""

import datetime as dt
import re

from pyspark.sql import functions as F

from wardflow.operators.asof import monthly_outcomes
from wardflow.operators.delta import new_records
from wardflow.operators.latest import last_per_key, latest_joint_max


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot(spark, sf):
    """orders with a third of the rows moved onto one customer."""
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("o_custkey")))


NO_CROSS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def test_latest_is_partial_aggregate_then_semi_join(spark, sf_small):
    o = _hot(spark, sf_small)
    df = latest_joint_max(o, ["o_custkey"], ["o_orderkey", ("day", F.to_date("o_orderdate"))])
    p = _plan(df)
    assert "partial_max" in p and "LeftSemi" in p and "Window" not in p
    assert not any(x in p for x in NO_CROSS)
    # hot key: exactly the rows holding both maxima survive
    hot = o.filter("o_custkey = -1")
    mx = hot.agg(F.max("o_orderkey").alias("i"), F.max(F.to_date("o_orderdate")).alias("d")).first()
    want = hot.filter((F.col("o_orderkey") == mx.i) & (F.to_date("o_orderdate") == mx.d)).count()
    assert df.filter("o_custkey = -1").count() == want


def test_last_per_key_combines_map_side(spark, sf_small):
    p = _plan(last_per_key(_hot(spark, sf_small), ["o_custkey"], ["o_orderdate", "o_orderkey"]))
    assert "partial_max" in p and not any(x in p for x in NO_CROSS)


def test_delta_reads_target_keys_only_and_dedupes(spark, sf_small):
    o = _hot(spark, sf_small)
    tgt = o.unionByName(o)   # every key twice in the target
    df = new_records(o, tgt, ["o_custkey", "o_orderkey"])
    p = _plan(df)
    assert "LeftAnti" in p and "HashAggregate" in p
    # the target side is read with the key columns only
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    assert "struct<o_orderkey:bigint,o_custkey:bigint>" in schemas
    assert df.count() == 0


def test_monthly_outcomes_has_no_join_or_cross_product(spark, sf_small):
    D = dt.date
    keys = "PatientPK long, PatientID string, SiteCode int"
    rows = [(1, "P1", 5, D(2020, 1, 1) + dt.timedelta(days=i), None) for i in range(300)]   # one hot patient
    rows += [(i, f"P{i}", 5, D(2020, 3, 1), D(2020, 4, 1)) for i in range(2, 150)]
    v = spark.createDataFrame(rows, f"{keys}, VisitDate date, NextAppointmentDate date")
    p_ = spark.createDataFrame([], f"{keys}, DispenseDate date, ExpectedReturn date")
    s = spark.createDataFrame([], f"{keys}, ExitDate date, ExitReason string, EffectiveDiscontinuationDate date")
    a = spark.createDataFrame([], f"{keys}, StartARTDate date")
    out = monthly_outcomes(v, p_, s, a, D(2020, 1, 1), D(2020, 12, 31))
    plan = _plan(out)
    assert "Join" not in plan and not any(x in plan for x in NO_CROSS)
    assert "partial_max" in plan
    # hot patient: one row per month, 12 months
    assert out.filter("PatientID = 'P1'").count() == 12
