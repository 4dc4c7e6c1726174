"""Key index beside a target, ranking over ranges, as-of join at arbitrary times."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardflow.operators.asof import asof_join
from wardflow.operators.delta import new_records
from wardflow.operators.latest import row_number, row_number_ranges
from wardflow.sources.keyindex import KeyIndex
from wardflow.sources.versions import VersionedTable

KEYS = {"a": "int", "b": "string"}


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def index(spark, tmp_path):
    return KeyIndex(spark, VersionedTable(spark, str(tmp_path / "t")), KEYS, 8)


ROWS = [(1, "x", 1), (1, None, 2), (None, None, 3), (None, "x", 4), (0, "", 5), (2, "", 6), (1, "x", 7)]


def test_key_index_equals_the_anti_join(spark, index):
    src = spark.createDataFrame(ROWS, "a int, b string, v int")
    assert _rows(index.new_records(src)) == _rows(src)  # no target yet
    index.append(src.where("v in (1, 3)"), "one")
    index.append(src.where("v = 5"), "two")
    got = _rows(index.new_records(src))
    assert got == _rows(new_records(src, index.target.read(), ["a", "b"])) == _rows(src.where("v in (2, 4, 6)"))
    plain = KeyIndex(spark, index.target, KEYS, 8, plain_keys=["b"])
    assert _rows(plain.new_records(src)) == _rows(new_records(src, index.target.read(), ["a"], plain_keys=["b"]))


def test_key_index_counts_only_what_the_log_lists(spark, index, monkeypatch):
    src = spark.createDataFrame(ROWS, "a int, b string, v int")
    index.append(src.where("v = 1"), "one")

    def lost(*_):
        raise OSError("driver lost")
    with monkeypatch.context() as m:  # keys written, batch not committed
        m.setattr(VersionedTable, "publish", lost)
        with pytest.raises(OSError):
            index.append(src.where("v in (2, 3)"), "two")
    assert _rows(index.new_records(src)) == _rows(src.where("v not in (1, 7)"))
    index.append(src.where("v = 2"), "two")
    index.append(src, "two")  # committed already
    assert _rows(index.new_records(src)) == _rows(src.where("v not in (1, 2, 7)"))
    index.rebuild(src.where("v = 4"), "three")
    assert _rows(index.new_records(src)) == _rows(src.where("v <> 4"))
    # a session that does not know the table finds its rows
    spark.sql(f"DROP TABLE {index.name}")
    again = KeyIndex(spark, index.target, KEYS, 8)
    assert _rows(again.new_records(src)) == _rows(src.where("v <> 4"))


def test_key_index_side_is_not_shuffled(spark, index):
    src = spark.range(5000).selectExpr("cast(id as int) as a", "cast(id % 7 as string) as b", "id as v")
    index.append(src.where("v < 4000"), "one")
    index.append(src.where("v between 4000 and 4500"), "two")
    with_threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = index.new_records(src)
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert new.count() == 499
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_threshold)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan, plan


def test_float_keys_are_refused(spark, tmp_path):
    index = KeyIndex(spark, VersionedTable(spark, str(tmp_path / "t")), {"a": "double"}, 8)
    with pytest.raises(ValueError, match="double"):
        index.new_records(spark.createDataFrame([(1.0,)], "a double"))


def test_ranges_rank_one_hot_key(spark):
    n = 2_000_000
    df = spark.range(n).selectExpr("case when id % 50 = 0 then null when id % 50 < 45 then 1 else id % 50 end as k",
                                   "case when id % 1000 = 1 then null else id * 7919 % 1000003 end as o", "id", "'p' as payload")
    got = row_number_ranges(df, ["k"], ["o", "id"], ranges=16)
    want = row_number(df, ["k"], ["o", "id"])
    assert got.columns == want.columns and got.count() == n
    pair = got.select("id", "payload", F.struct("k", "o").alias("x"), F.col("rank").alias("r")).join(
        want.select("id", F.struct("k", "o").alias("y"), F.col("rank").alias("s")), "id")
    assert pair.where("x <=> y and r = s and payload = 'p'").count() == n


def test_ranges_of_few_rows(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (1, None), (None, 7), (2, 1)], "k int, o int")
    assert _rows(row_number_ranges(df, ["k"], ["o"])) == _rows(row_number(df, ["k"], ["o"]))
    assert row_number_ranges(df.limit(0), ["k"], ["o"]).count() == 0
    everywhere = row_number_ranges(spark.createDataFrame([(1, 1)] * 10, "k int, o int"), ["k"], ["o"])
    assert sorted(r["rank"] for r in everywhere.collect()) == list(range(1, 11))


def test_asof_join_against_brute_force(spark):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)

    def time():
        return rng.choice([None, *[start + dt.timedelta(hours=rng.randint(0, 400)) for _ in range(12)]])
    left = [(rng.choice([None, 1, 1, 2, 3]), time(), i) for i in range(300)] + [(1, start, 300), (1, start, 300)]
    right = [(rng.choice([None, 1, 1, 2, 4]), time(), i, f"r{i}") for i in range(80)]

    def match(k, t):
        if k is None or t is None:
            return None
        found = [(s, v, w) for j, s, v, w in right if j == k and s is not None and s <= t]
        return max(found)[2] if found else None
    ldf = spark.createDataFrame(left, "k int, t timestamp_ntz, id int")
    rdf = spark.createDataFrame(right, "k int, s timestamp_ntz, v int, w string")
    want = sorted(((k, t, i, match(k, t)) for k, t, i in left), key=repr)
    assert _rows(asof_join(ldf, rdf, ["k"], "t", "s", {"w": "w"}, tie=["v"])) == want
    finer = asof_join(ldf, rdf, ["k"], "t", "s", {"w": "w"}, tie=["v"], bucket=lambda c: F.date_format(c, "yyyy-MM-dd HH"))
    assert _rows(finer) == want
    inner = asof_join(ldf, rdf, ["k"], "t", "s", {"w": "w"}, tie=["v"], how="inner")
    assert _rows(inner) == [r for r in want if r[3] is not None]
    assert _rows(asof_join(ldf, rdf.limit(0), ["k"], "t", "s", {"w": "w"})) == sorted(((*r, None) for r in left), key=repr)
    assert asof_join(ldf.limit(0), rdf, ["k"], "t", "s", {"w": "w"}).count() == 0
