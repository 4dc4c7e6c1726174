import datetime as dt

from pyspark.sql import functions as F

from wardflow.operators.delta import new_records
from wardflow.operators.latest import last_per_key, latest_joint_max
from wardflow.operators.lookup import standardise

D = dt.date


def _rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_joint_max_traps(spark):
    df = spark.createDataFrame([
        (1, 10, D(2020, 1, 1)), (1, 9, D(2020, 2, 1)),            # max id and max day on different rows -> gone
        (2, 5, D(2020, 1, 1)), (2, 5, D(2020, 1, 1)),             # tie on every max -> both stay
        (3, 7, D(2020, 3, 1)), (3, 6, D(2020, 1, 1)),             # normal
        (None, 8, D(2020, 1, 1)),                                 # NULL key -> gone
    ], "k int, id int, d date")
    for strategy in ("aggregate", "window"):
        got = _rows(latest_joint_max(df, ["k"], ["id", "d"], strategy=strategy), "k", "id")
        assert got == [(2, 5), (2, 5), (3, 7)], strategy


def test_coarser_join_and_double_rule(spark):
    df = spark.createDataFrame([
        ("a", 1, 1, 5, D(2020, 1, 1)), ("a", 2, 2, 6, D(2020, 1, 2)), ("a", 2, 3, 4, D(2020, 1, 2)),
    ], "k string, v int, id int, p int, d date")
    # group by (k, v), join on k only: the row must match the maxima of some (k, v) group
    got = _rows(latest_joint_max(df, ["k", "v"], ["id"], join_keys=["k"]), "id")
    assert got == [(1,), (3,)]
    # two rules ANDed: max id & max day, max p & max day -> id=3 has max id but not max p -> none
    assert latest_joint_max(df, ["k"], [["id", "d"], ["p", "d"]]).count() == 0


def test_last_per_key_matches_window(spark, sf_small):
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    a = last_per_key(li, ["l_orderkey"], order)
    b = last_per_key(li, ["l_orderkey"], order, strategy="window")
    assert _rows(a, *li.columns) == _rows(b, *li.columns)


def test_new_records_null_safe_and_plain(spark):
    src = spark.createDataFrame([(1, 1), (1, None), (2, 2), (3, None)], "a int, b int")
    tgt = spark.createDataFrame([(1, 1), (1, None), (3, None), (3, None)], "a int, b int")
    assert _rows(new_records(src, tgt, ["a", "b"]), "a", "b") == [(2, 2)]
    # plain '=' on b: NULL never matches -> rows with NULL b are always new
    got = _rows(new_records(src, tgt, ["a"], plain_keys=["b"]), "a", "b")
    assert got == sorted([(1, None), (2, 2), (3, None)], key=lambda r: (r[0], r[1] is None, r[1] or 0))


def test_delta_invariants(spark, sf_small):
    o = spark.read.parquet(f"{sf_small}/orders.parquet")
    tgt = o.filter(F.col("o_orderdate") < F.lit(dt.datetime(1999, 1, 1)))
    new = new_records(o, tgt, ["o_orderkey"])
    seen = o.join(tgt.select("o_orderkey").distinct(), "o_orderkey", "left_semi")
    assert new.count() + seen.count() == o.count()
    # loading twice appends nothing
    loaded = tgt.unionByName(new)
    assert new_records(o, loaded, ["o_orderkey"]).count() == 0


def test_cast_key_anti_join(spark):
    src = spark.createDataFrame([(1, dt.datetime(2020, 1, 1, 10)), (1, dt.datetime(2020, 1, 2, 1))], "u int, ts timestamp")
    tgt = spark.createDataFrame([(1, D(2020, 1, 1))], "u int, d date")
    got = new_records(src, tgt, ["u", (F.to_date(src["ts"]), tgt["d"])]).collect()
    assert [r.ts.day for r in got] == [2]


def test_lookup_never_changes_row_count(spark):
    df = spark.createDataFrame([("a",), ("B",), ("c",), (None,)], "v string")
    lk = spark.createDataFrame([("a", "A1"), ("a", "A0"), ("b", "Bee"), (None, "n")], "source_name string, target_name string")
    out = standardise(df, "v", lk)
    assert out.count() == 4
    assert _rows(out.fillna("~"), "v") == sorted([("A0",), ("B",), ("c",), ("~",)])
    ci = standardise(df, "v", lk, case_insensitive=True)
    assert _rows(ci.fillna("~"), "v") == sorted([("A0",), ("Bee",), ("c",), ("~",)])
    dflt = standardise(df, "v", lk, default="Empty")
    assert _rows(dflt, "v") == sorted([("A0",), ("B",), ("c",), ("Empty",)])


def test_row_number_with_payload_and_null_keys(spark, tmp_path):
    """Two million rows over several files, a payload column, NULL keys: every rank against an aggregate check."""
    from wardflow.operators.latest import row_number
    path = str(tmp_path / "big")
    spark.range(0, 2_000_000, 1, 4).select(
        F.when(F.col("id") % 7 != 3, F.col("id") % 7).alias("k"), (F.col("id") * 7919 % 2_000_003).alias("o"),
        F.concat(F.lit("p"), F.col("id").cast("string")).alias("payload")).write.parquet(path)
    df = spark.read.parquet(path)
    got = row_number(df, ["k"], ["o"])
    assert got.count() == 2_000_000 and got.select("payload").distinct().count() == 2_000_000
    per = {r.k: r for r in got.groupBy("k").agg(F.count("*").alias("n"), F.countDistinct("rank").alias("d"),
                                               F.max("rank").alias("m")).collect()}
    assert len(per) == 7 and None in per and all(r.n == r.d == r.m for r in per.values())
    from pyspark.sql import Window
    w = Window.partitionBy("k").orderBy("rank")
    assert got.withColumn("before", F.lag("o").over(w)).where("before <= o").isEmpty()


def test_lookup_conflicts_reported(spark):
    from wardflow.operators.lookup import lookup_conflicts
    lk = spark.createDataFrame([("a", "A1"), ("a", "A0"), ("b", "B"), ("b", "B")], "source_name string, target_name string")
    rows = lookup_conflicts(lk).collect()
    assert [(r.source, r.n_targets, r.targets) for r in rows] == [("a", 2, ["A0", "A1"])]


def test_new_records_split_equals_single(spark, sf_small):
    o = spark.read.parquet(f"{sf_small}/orders.parquet")
    src = o.select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).otherwise(F.col("o_custkey"))
                   .alias("k2"), "o_orderdate")
    tgt = src.filter(F.col("o_orderdate") < F.lit(dt.datetime(1999, 1, 1)))
    a = new_records(src, tgt, ["o_orderkey", "k2"], split_nulls=False)
    b = new_records(src, tgt, ["o_orderkey", "k2"], split_nulls=True)
    key = lambda r: (r[0], r[1] is None, r[1] or 0)
    assert sorted(a.select("o_orderkey", "k2").collect(), key=key) == \
        sorted(b.select("o_orderkey", "k2").collect(), key=key)
