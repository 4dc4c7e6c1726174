import random

from wardflow.llm import fixity
from wardflow.queries.oracle import compare, duckdb_views


def _replicas(n, files, faults, seed):
    rng = random.Random(seed)
    left, right, want = [], [], set()
    at = dict.fromkeys(range(files), 0)
    for i in range(n):
        f = rng.randrange(files)
        size = rng.randrange(1, 4000)
        row = (f, at[f], f"d{i}")
        kind = rng.choice(["changed", "missing", "extra"]) if i in faults else None
        if kind != "extra":
            left.append(row)
        if kind != "missing":
            right.append(row if kind != "changed" else (f, at[f], f"x{i}"))
        if kind:
            want.add((f, at[f], kind))
        at[f] += size
    return left, right, want


def test_faults_are_found_where_they_are(spark):
    schema = "file int, offset long, digest string"
    left, right, want = _replicas(3000, 5, set(range(7, 3000, 311)), 2)
    a, b = (spark.createDataFrame(x, schema) for x in (left, right))
    got = {(r["file"], r["offset"], r["fault"]) for r in fixity.audit(a, b, range_bytes=2048, fan=4).collect()}
    assert got == want
    assert fixity.audit(a, a).count() == 0
    # one tree holds one root per file, whatever the order of its records
    tree = fixity.merkle_tree(a, 2048, 4)
    top = tree.agg({"level": "max"}).first()[0]
    roots = {r["file"]: r["digest"] for r in tree.where(f"level = {top}").collect()}
    again = {r["file"]: r["digest"] for r in fixity.merkle_tree(a.repartition(7, "digest"), 2048, 4).where(f"level = {top}").collect()}
    assert len(roots) == 5 and roots == again


def test_odd_rows(spark):
    schema = "file string, offset long, digest string, idx string, level string, kids string"
    rows = [(None, 0, "a", "x", "x", "x"), (None, 0, "a", "x", "x", "x"), ("f", None, "b", "x", "x", "x"), ("f", 5, None, "x", "x", "x"),
            ("f", 1 << 40, "far", "x", "x", "x")]
    a = spark.createDataFrame(rows, schema)
    assert fixity.audit(a, a).count() == 0
    b = spark.createDataFrame(rows[1:], schema)  # one of two equal records lost
    got = fixity.audit(a, b).collect()
    assert [(r["file"], r["offset"], r["fault"]) for r in got] == [(None, 0, "changed")]
    none = a.limit(0)
    assert fixity.audit(none, none).count() == 0
    assert {(r["file"], r["fault"]) for r in fixity.audit(none, a).collect()} == {(None, "extra"), ("f", "extra")}


def test_query_matches_oracle(spark, sf_small):
    df = fixity.op1_fixity(spark, sf_small)
    want = duckdb_views(sf_small).execute(fixity.ORACLES["op1_fixity"]).df()
    assert len(want) and compare(df.toPandas(), want) is None


def test_pages_with_nulls_and_repeats(spark):
    rows = [(1, "u", "h"), (1, "u", "h"), (None, None, None), (2, "u", ""), (3, "u", "é" * 100_000)]
    first, second = fixity.archive(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert first.select("file", "offset").distinct().count() == first.count()
    assert fixity.audit(first, first).count() == 0 and second.count() >= 3
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert fixity.audit(*fixity.archive(empty)).count() == 0


def test_records_of_one_place_are_one_node(spark):
    """Null files and offsets, and repeats, come to no list of all their records."""
    a = spark.range(60_000).selectExpr("cast(null as string) file", "if(id % 3 = 0, 7L, null) offset", "sha2(string(id % 40000), 256) digest")
    tree = fixity.merkle_tree(a, 2048, 4)
    assert sorted(r["idx"] for r in tree.where("level = 0").collect()) == [-1, 7]
    assert fixity.audit(a, a.repartition(5, "digest")).count() == 0
    twice = a.where("offset is null").groupBy("digest").count().where("count = 2").orderBy("digest").first()["digest"]
    lost = a.where("offset is null").dropDuplicates(["digest"]).where(f"digest = '{twice}'").unionByName(
        a.where(f"offset is not null or digest <> '{twice}'"))  # one of two equal records
    got = fixity.audit(a, lost).collect()
    assert [(r["offset"], r["fault"], r["left_digest"] == r["right_digest"]) for r in got] == [(-1, "changed", True)]
