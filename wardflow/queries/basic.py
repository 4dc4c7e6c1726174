"""Scans, sinks, projections and filters."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.operators.delta import new_records
from wardflow.operators.joins import parent_exists
from wardflow.queries import query
from wardflow.queries._data import AS_OF, ntz, table
from wardflow.session import scratch_path
from wardflow.sources.audit import audited
from wardflow.sources.conform import conform
from wardflow.sources.readers import read_key_range, read_query
from wardflow.sources.sinks import append, apply_corrections, correct_partitions, overwrite_partitions, snapshot
from wardflow.sources.versions import VersionedTable

# ---------------------------------------------------------------- S1 / S2 / S11
_DERIVED = """
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_nationkey, CAST(o.o_orderdate AS DATE) AS order_day
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
WHERE c.c_mktsegment <> 'AUTOMOBILE'
"""


@query("scan_derived_table", oracle=_DERIVED.format(orders="orders", customer="customer"))
def scan_derived_table(spark, sf):
    """A SQL text read as a derived table over views of the source tables."""
    return read_query(spark, _DERIVED.format(orders="wf_s1_orders", customer="wf_s1_customer"),
                      tables={"wf_s1_orders": table(spark, sf, "orders"),
                              "wf_s1_customer": table(spark, sf, "customer")})


@query("scan_key_range", oracle="SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity FROM lineitem")
def scan_key_range(spark, sf):
    """Key-range strides of a scan (JDBC partitionColumn/bounds analogue), each a pushed-down range."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    return reduce(DataFrame.unionAll, read_key_range(li, "l_suppkey", 0, 1_000, 4))


@query("temp_view_sql", oracle="""
SELECT c_mktsegment, count(*) AS n_customers, max(c_acctbal) AS max_acctbal
FROM customer GROUP BY c_mktsegment""")
def temp_view_sql(spark, sf):
    """DataFrame -> temp view -> SQL text (the bridge used by the load jobs)."""
    table(spark, sf, "customer").createOrReplaceTempView("wf_s11_customer")
    return spark.sql("""SELECT c_mktsegment, count(*) AS n_customers, max(c_acctbal) AS max_acctbal
                        FROM wf_s11_customer GROUP BY c_mktsegment""")


# ---------------------------------------------------------------- S6 / S7 / S8 / S10
@query("sink_append_roundtrip", oracle="""
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_day, o_totalprice FROM orders""")
def sink_append_roundtrip(spark, sf):
    """Two appends (fixed 8 partitions, then AQE-rebalanced) read back as one table."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey",
                                          F.to_date("o_orderdate").alias("order_day"), "o_totalprice")
    path = scratch_path(spark, "append")
    cut = dt.date(1998, 1, 1)
    append(o.filter(F.col("order_day") < F.lit(cut)), path, num_partitions=8)
    append(o.filter(F.col("order_day") >= F.lit(cut)), path)
    return spark.read.parquet(path)


@query("sink_overwrite_month", oracle="""
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month,
       CASE WHEN year(o_orderdate) = 1998 THEN round(o_totalprice, 0) ELSE o_totalprice END AS o_totalprice
FROM orders""")
def sink_overwrite_month(spark, sf):
    """Partitioned table; the 1998 months are rebuilt by dynamic partition overwrite."""
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.trunc(F.to_date("o_orderdate"), "MM").alias("order_month"), "o_totalprice")
    path = scratch_path(spark, "months")
    overwrite_partitions(o, path, ["order_month"])
    redo = o.filter(F.year("order_month") == 1998).withColumn("o_totalprice", F.round("o_totalprice", 0))
    overwrite_partitions(redo, path, ["order_month"])
    back = spark.read.parquet(path)
    return back.select("o_orderkey", F.col("order_month").cast("date").alias("order_month"), "o_totalprice")


@query("snapshot_disk_only", oracle="SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def snapshot_disk_only(spark, sf):
    """Source snapshot kept DISK_ONLY for two actions, then released."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus") \
        .filter(F.col("o_orderstatus") != "P")
    with snapshot(o) as kept:
        if kept.count() != kept.distinct().count():
            raise ValueError("order keys repeat")
    return o


# ---------------------------------------------------------------- S9 corrections
@query("update_from_join", oracle="""
SELECT p.p_partkey, p.p_name, CASE WHEN f.k IS NOT NULL THEN f.v ELSE p.p_size END AS p_size
FROM part p LEFT JOIN (SELECT l_partkey AS k, CAST(max(l_quantity) AS INTEGER) AS v
                       FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey) f ON p.p_partkey = f.k""")
def update_from_join(spark, sf):
    """UPDATE part SET p_size = fix FROM (per-part fix derived from lineitem)."""
    fixes = (table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
             .groupBy(F.col("l_partkey").alias("p_partkey"))
             .agg(F.max("l_quantity").cast("int").alias("new_size")))
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    return apply_corrections(part, fixes, "p_partkey", {"p_size": "new_size"})


@query("update_pruned_partitions", oracle="""
SELECT o_orderkey, coalesce(f.fixed, o_totalprice) AS o_totalprice, year(o_orderdate) AS order_year
FROM orders LEFT JOIN (SELECT l_orderkey, max(l_extendedprice) AS fixed FROM lineitem
                       WHERE l_quantity >= 40 GROUP BY l_orderkey) f
  ON o_orderkey = f.l_orderkey AND o_orderpriority = '1-URGENT' AND year(o_orderdate) IN (1996, 1998)""")
def update_pruned_partitions(spark, sf):
    """UPDATE of a versioned table laid out by year: only the two years with a corrected order are rewritten."""
    o = table(spark, sf, "orders")
    year = F.year("o_orderdate").cast("long")
    wrong = o.where((F.col("o_orderpriority") == "1-URGENT") & year.isin(1996, 1998)).select("o_orderkey")
    fixes = (table(spark, sf, "lineitem").where("l_quantity >= 40")
             .groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_extendedprice").alias("fixed"))
             .join(wrong, "o_orderkey", "left_semi"))
    target = VersionedTable(spark, scratch_path(spark, "prices"))
    target.append(o.select("o_orderkey", "o_totalprice", year.alias("order_year")), "load", ("order_year",))
    years = correct_partitions(target, fixes, "o_orderkey", {"o_totalprice": "fixed"}, ("order_year",), "fix")
    if years > 2:
        raise ValueError(f"{years} years rewritten")
    return target.read()


# ---------------------------------------------------------------- S12 audit
@query("load_audit_counts", oracle="""
SELECT (SELECT count(*) FROM orders s WHERE NOT EXISTS
          (SELECT 1 FROM orders t WHERE t.o_orderdate < TIMESTAMP '1999-01-01' AND t.o_orderkey = s.o_orderkey)) AS new_rows,
       (SELECT count(*) FROM orders s WHERE EXISTS
          (SELECT 1 FROM orders t WHERE t.o_orderdate < TIMESTAMP '1999-01-01' AND t.o_orderkey = s.o_orderkey)) AS seen_rows,
       (SELECT count(*) FROM orders) AS total_rows""")
def load_audit_counts(spark, sf):
    """New / seen / total counted by observation during the one write action."""
    src = table(spark, sf, "orders")
    tgt = src.filter(F.col("o_orderdate") < ntz(dt.datetime(1999, 1, 1)))
    src_o, total = audited(src.select("o_orderkey"), "total")
    new_o, new = audited(new_records(src_o, tgt, ["o_orderkey"]), "new")
    new_o.write.format("noop").mode("overwrite").save()
    n_new, n_total = new.get["rows"], total.get["rows"]
    return spark.range(1).select(F.lit(n_new).cast("long").alias("new_rows"),
                                 F.lit(n_total - n_new).cast("long").alias("seen_rows"),
                                 F.lit(n_total).cast("long").alias("total_rows"))


# ---------------------------------------------------------------- S13 conform
_LINE_SCHEMA = T.StructType([
    T.StructField("L_ORDERKEY", T.LongType()),
    T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_extendedprice", T.DecimalType(18, 2)),
    T.StructField("l_shipdate", T.DateType()),
    T.StructField("l_returnflag", T.StringType()),
    T.StructField("l_comment", T.StringType()),
])


@query("conform_schema", oracle="""
SELECT l_orderkey AS L_ORDERKEY, l_linenumber, CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice,
       CAST(l_shipdate AS DATE) AS l_shipdate, l_returnflag, CAST(NULL AS VARCHAR) AS l_comment
FROM lineitem""")
def conform_schema(spark, sf):
    """Cast to a target contract: names case-insensitive, decimal(18,2), date, missing -> NULL."""
    return conform(table(spark, sf, "lineitem"), _LINE_SCHEMA, lengths={"l_returnflag": 1}, missing_as_null=True)


# ---------------------------------------------------------------- F1-F4
@query("project_contract", oracle="SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders")
def project_contract(spark, sf):
    """Ordered output column list (extra source columns dropped)."""
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


@query("project_rename", oracle="""
SELECT c_custkey AS PatientPK, c_name AS PatientName, c_nationkey AS SiteCode FROM customer""")
def project_rename(spark, sf):
    """Rename while projecting."""
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("PatientPK"),
                                               F.col("c_name").alias("PatientName"),
                                               F.col("c_nationkey").alias("SiteCode"))


@query("null_placeholders", oracle="""
SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS County, CAST(NULL AS DATE) AS DateCreated,
       CAST(NULL AS INTEGER) AS Latitude FROM supplier""")
def null_placeholders(spark, sf):
    """Typed constant-NULL placeholder columns."""
    return table(spark, sf, "supplier").select(
        "s_suppkey", "s_name", F.lit(None).cast("string").alias("County"),
        F.lit(None).cast("date").alias("DateCreated"), F.lit(None).cast("int").alias("Latitude"))


@query("audit_stamp", oracle="""
SELECT o_orderkey, TIMESTAMP '2000-12-31 00:00:00' AS LoadDate, DATE '2000-12-31' AS DateAsOf FROM orders""")
def audit_stamp(spark, sf):
    """Load-date stamps from an injected as-of date (no clock call)."""
    return table(spark, sf, "orders").select(
        "o_orderkey", ntz(dt.datetime.combine(AS_OF, dt.time())).alias("LoadDate"),
        F.lit(AS_OF).alias("DateAsOf"))


# ---------------------------------------------------------------- F5-F12
def _gender(c):
    return (F.when(c["c_custkey"] % 10 == 0, F.lit(None))
            .when(c["c_custkey"] % 10 == 1, F.lit("Unknown")).otherwise(c["c_mktsegment"]))


_GENDER_SQL = ("CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN 'Unknown' "
               "ELSE c_mktsegment END")


@query("filter_not_equal_null", oracle=f"""
SELECT c_custkey, gender FROM (SELECT c_custkey, {_GENDER_SQL} AS gender FROM customer) t
WHERE gender <> 'Unknown'""")
def filter_not_equal_null(spark, sf):
    """`gender != 'Unknown'` – also drops NULL genders."""
    c = table(spark, sf, "customer")
    return c.select("c_custkey", _gender(c).alias("gender")).filter(F.col("gender") != "Unknown")


@query("filter_positive_code", oracle="""
SELECT n_nationkey, code FROM (
  SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 0 THEN 'abc' ELSE CAST(n_nationkey - 3 AS VARCHAR) END AS code
  FROM nation) t WHERE TRY_CAST(code AS INTEGER) > 0""")
def filter_positive_code(spark, sf):
    """Positive facility code where the code is text (ANSI-safe try_cast)."""
    n = table(spark, sf, "nation")
    code = F.when(n["n_nationkey"] % 5 == 0, F.lit("abc")).otherwise((n["n_nationkey"] - 3).cast("string"))
    return n.select("n_nationkey", code.alias("code")).filter(F.col("code").try_cast("int") > 0)


@query("filter_not_null", oracle="""
SELECT event_id, event_type_n FROM (
  SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE event_type END AS event_type_n FROM events) t
WHERE event_type_n IS NOT NULL""")
def filter_not_null(spark, sf):
    """IS NOT NULL filter."""
    e = table(spark, sf, "events")
    t = F.when(e["event_id"] % 9 == 0, F.lit(None)).otherwise(e["event_type"])
    return e.select("event_id", t.alias("event_type_n")).filter(F.col("event_type_n").isNotNull())


@query("filter_date_cutoff", oracle="""
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1999-09-08 00:00:00'""")
def filter_date_cutoff(spark, sf):
    """Extraction-date cut-off (pushes to the Parquet scan)."""
    return table(spark, sf, "orders").select("o_orderkey", "o_orderdate") \
        .filter(F.col("o_orderdate") > ntz(dt.datetime(1999, 9, 8)))


@query("filter_non_empty", oracle="""
SELECT p_partkey, brand FROM (
  SELECT p_partkey, CASE WHEN p_partkey % 6 = 0 THEN '' ELSE p_brand END AS brand FROM part) t
WHERE brand <> ''""")
def filter_non_empty(spark, sf):
    """Non-empty code filter."""
    p = table(spark, sf, "part")
    b = F.when(p["p_partkey"] % 6 == 0, F.lit("")).otherwise(p["p_brand"])
    return p.select("p_partkey", b.alias("brand")).filter(F.col("brand") != "")


@query("join_soft_delete", oracle="""
SELECT o.o_orderkey, c.c_custkey, c.c_name
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey AND NOT (c.c_acctbal < 0)""")
def join_soft_delete(spark, sf):
    """Soft-delete flag of the parent inside the join (voided = negative balance)."""
    c = table(spark, sf, "customer")
    live = c.filter(~(F.col("c_acctbal") < 0)).select("c_custkey", "c_name")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return o.join(live, o["o_custkey"] == live["c_custkey"], "inner").select("o_orderkey", "c_custkey", "c_name")


@query("quoted_names", oracle="""
SELECT o_orderkey AS "_3PM", CAST(o_orderdate AS DATE) AS "Start", o_orderstatus AS "End",
       o_orderpriority AS "SERVICE" FROM orders""")
def quoted_names(spark, sf):
    """Non-identifier / reserved column names survive projection (back-ticks)."""
    o = table(spark, sf, "orders").selectExpr("o_orderkey AS `_3PM`", "CAST(o_orderdate AS DATE) AS `Start`",
                                              "o_orderstatus AS `End`", "o_orderpriority AS `SERVICE`")
    return o.select("`_3PM`", "`Start`", "`End`", "`SERVICE`")


@query("select_distinct", oracle="SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem")
def select_distinct(spark, sf):
    """DISTINCT projection."""
    return table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus").distinct()


# ---------------------------------------------------------------- J1 / J2
@query("join_three_way", oracle="""
SELECT o.o_orderkey, o.o_custkey, c.c_name, n.n_name
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_mktsegment <> 'AUTOMOBILE' AND n.n_nationkey > 0""")
def join_three_way(spark, sf):
    """Form -> patient -> facility inner joins; the planner broadcasts the facility side by its size."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").filter(F.col("c_mktsegment") != "AUTOMOBILE") \
        .select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf, "nation").filter(F.col("n_nationkey") > 0).select("n_nationkey", "n_name")
    return (o.join(c, o["o_custkey"] == c["c_custkey"])
            .join(n, c["c_nationkey"] == n["n_nationkey"])
            .select("o_orderkey", "o_custkey", "c_name", "n_name"))


@query("semi_parent_exists", oracle="""
SELECT DISTINCT o.o_orderkey, o.o_custkey FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey WHERE c.c_acctbal > 0""")
def semi_parent_exists(spark, sf):
    """Inner join with unused parent columns + DISTINCT, written as LEFT SEMI."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer")
    return parent_exists(o, c, [("o_custkey", "c_custkey")], parent_filter=F.col("c_acctbal") > 0).distinct()
