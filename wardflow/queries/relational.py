"""Lookups, deltas, latest-version rules, as-of, aggregates, windows, set ops
(SURVEY §2.3 – §2.7)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from wardflow.operators.asof import asof_join, asof_latest, month_spine_of
from wardflow.operators.delta import new_records
from wardflow.operators.latest import last_per_key, latest_joint_max
from wardflow.operators.lookup import prepare_lookup, shared_lookup, standardise
from wardflow.queries import query
from wardflow.queries._data import ntz, table
from wardflow.session import scratch_path
from wardflow.sources.keyindex import KeyIndex
from wardflow.sources.versions import VersionedTable

# ---------------------------------------------------------------- J3-J6 lookups


def _priority_lookup(o):
    """Lookup derived from the data: 'n-WORD' -> 'WORD', '5-LOW' left unmapped,
    and a duplicate spelling for '1-URGENT' (min target wins)."""
    base = o.select(F.col("o_orderpriority").alias("source_name")).distinct() \
        .filter(F.col("source_name") != "5-LOW") \
        .withColumn("target_name", F.upper(F.substring("source_name", 3, 100)))
    dup = base.filter(F.col("source_name") == "1-URGENT").withColumn("target_name", F.lit("ZZZ"))
    return base.unionByName(dup)


_PRIORITY_LOOKUP_SQL = """
(SELECT source_name, min(target_name) AS target_name FROM (
   SELECT DISTINCT o_orderpriority AS source_name, upper(substring(o_orderpriority, 3, 100)) AS target_name
   FROM orders WHERE o_orderpriority <> '5-LOW'
   UNION ALL SELECT '1-URGENT', 'ZZZ' FROM (SELECT DISTINCT o_orderpriority FROM orders
                                            WHERE o_orderpriority = '1-URGENT') d) u
 GROUP BY source_name)"""


@query("lookup_standardise", oracle=f"""
SELECT o.o_orderkey, coalesce(l.target_name, o.o_orderpriority) AS o_orderpriority
FROM orders o LEFT JOIN {_PRIORITY_LOOKUP_SQL} l ON o.o_orderpriority = l.source_name""")
def lookup_standardise(spark, sf):
    """Left join on the raw value, take the target else keep (lookup de-duplicated, broadcast)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return standardise(o, "o_orderpriority", _priority_lookup(o))


_FLAG_LOOKUP_SQL = """
(SELECT DISTINCT l_returnflag AS source_name, 'flag-' || lower(l_returnflag) AS target_name FROM lineitem
 UNION SELECT DISTINCT l_linestatus, 'status-' || lower(l_linestatus) FROM lineitem WHERE l_linestatus <> 'O')"""


@query("lookup_multi_alias", oracle=f"""
SELECT li.l_orderkey, li.l_linenumber,
       coalesce(a.target_name, li.l_returnflag) AS l_returnflag,
       coalesce(b.target_name, li.l_linestatus) AS l_linestatus,
       coalesce(c.target_name, li.l_returnflag) AS flag_again
FROM lineitem li LEFT JOIN {_FLAG_LOOKUP_SQL} a ON li.l_returnflag = a.source_name
LEFT JOIN {_FLAG_LOOKUP_SQL} b ON li.l_linestatus = b.source_name
LEFT JOIN {_FLAG_LOOKUP_SQL} c ON li.l_returnflag = c.source_name""")
def lookup_multi_alias(spark, sf):
    """One lookup joined under three aliases; it is built once and read by every alias."""
    li = table(spark, sf, "lineitem")
    lk = (li.select(F.col("l_returnflag").alias("source_name"),
                    F.concat(F.lit("flag-"), F.lower("l_returnflag")).alias("target_name"))
          .unionByName(li.filter(F.col("l_linestatus") != "O")
                       .select(F.col("l_linestatus").alias("source_name"),
                               F.concat(F.lit("status-"), F.lower("l_linestatus")).alias("target_name")))
          .distinct())
    df = li.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus",
                   F.col("l_returnflag").alias("flag_again"))
    lk = shared_lookup(prepare_lookup(lk))
    for c in ("l_returnflag", "l_linestatus", "flag_again"):
        df = standardise(df, c, lk, prepared=True)
    return df


@query("lookup_case_insensitive", oracle="""
SELECT c.c_custkey, coalesce(l.target_name, c.c_mktsegment) AS c_mktsegment
FROM customer c LEFT JOIN (
  SELECT upper(source_name) AS source_name, min(target_name) AS target_name FROM (
    SELECT DISTINCT lower(c_mktsegment) AS source_name, 'SEG-' || substring(c_mktsegment, 1, 3) AS target_name
    FROM customer WHERE c_mktsegment <> 'BUILDING') s GROUP BY upper(source_name)) l
ON upper(c.c_mktsegment) = l.source_name""")
def lookup_case_insensitive(spark, sf):
    """Lookup whose spellings differ in case from the data (join on upper())."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    lk = (c.filter(F.col("c_mktsegment") != "BUILDING")
          .select(F.lower("c_mktsegment").alias("source_name"),
                  F.concat(F.lit("SEG-"), F.substring("c_mktsegment", 1, 3)).alias("target_name")).distinct())
    return standardise(c, "c_mktsegment", lk, case_insensitive=True)


@query("lookup_coalesce_default", oracle="""
SELECT p.p_partkey, coalesce(l.target_name, p.ptype, 'Empty') AS ptype
FROM (SELECT p_partkey, CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE p_type END AS ptype FROM part) p
LEFT JOIN (SELECT DISTINCT p_type AS source_name, lower(p_type) AS target_name FROM part
           WHERE p_type IN ('SMALL', 'LARGE')) l ON p.ptype = l.source_name""")
def lookup_coalesce_default(spark, sf):
    """coalesce(lookup target, raw value, 'Empty')."""
    p = table(spark, sf, "part")
    src = p.select("p_partkey", F.when(p["p_partkey"] % 8 == 0, F.lit(None)).otherwise(p["p_type"]).alias("ptype"))
    lk = p.filter(F.col("p_type").isin("SMALL", "LARGE")) \
        .select(F.col("p_type").alias("source_name"), F.lower("p_type").alias("target_name")).distinct()
    return standardise(src, "ptype", lk, default="Empty")


# ---------------------------------------------------------------- J7-J10 deltas
def _k2(o, mod):
    return F.when(o["o_orderkey"] % mod == 0, F.lit(None)).otherwise(o["o_custkey"])


@query("delta_anti_nullsafe", oracle="""
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END AS k2, o_orderdate FROM orders)
SELECT s.o_orderkey, s.k2 FROM s WHERE NOT EXISTS (
  SELECT 1 FROM s t WHERE t.o_orderdate < TIMESTAMP '1999-01-01'
    AND t.o_orderkey IS NOT DISTINCT FROM s.o_orderkey AND t.k2 IS NOT DISTINCT FROM s.k2)""")
def delta_anti_nullsafe(spark, sf):
    """New records by null-safe LEFT ANTI join (NULL = NULL counts as loaded)."""
    o = table(spark, sf, "orders")
    src = o.select("o_orderkey", _k2(o, 17).alias("k2"), "o_orderdate")
    tgt = src.filter(F.col("o_orderdate") < ntz(dt.datetime(1999, 1, 1)))
    return new_records(src, tgt, ["o_orderkey", "k2"]).select("o_orderkey", "k2")


@query("delta_key_index", oracle="""
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END AS k2, o_orderdate FROM orders)
SELECT s.o_orderkey, s.k2, s.o_orderdate FROM s WHERE NOT EXISTS (
  SELECT 1 FROM s t WHERE t.o_orderdate < TIMESTAMP '1999-01-01'
    AND t.o_orderkey IS NOT DISTINCT FROM s.o_orderkey AND t.k2 IS NOT DISTINCT FROM s.k2)""")
def delta_key_index(spark, sf):
    """New records against the bucketed keys of a target loaded in two batches, the second one twice."""
    o = table(spark, sf, "orders")
    src = o.select("o_orderkey", _k2(o, 17).alias("k2"), "o_orderdate")
    target = VersionedTable(spark, scratch_path(spark, "indexed"))
    index = KeyIndex(spark, target, {"o_orderkey": "long", "k2": "long"},
                     int(spark.conf.get("spark.sql.shuffle.partitions")))
    index.append(src.filter(F.col("o_orderdate") < ntz(dt.datetime(1997, 1, 1))), "first")
    for _ in range(2):
        index.append(src.filter(F.col("o_orderdate").between(ntz(dt.datetime(1997, 1, 1)), ntz(dt.datetime(1998, 12, 31, 23, 59, 59)))),
                     "second")
    return index.new_records(src)


@query("delta_anti_cast_key", oracle="""
SELECT s.event_id, s.user_id, s.ts FROM events s WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT user_id, CAST(ts AS DATE) AS d FROM events WHERE ts < TIMESTAMP '2024-01-20') t
  WHERE t.user_id IS NOT DISTINCT FROM s.user_id AND t.d IS NOT DISTINCT FROM CAST(s.ts AS DATE))""")
def delta_anti_cast_key(spark, sf):
    """Anti join with a key cast on one side: to_date(ts) <=> date."""
    e = table(spark, sf, "events")
    src = e.select("event_id", "user_id", "ts")
    tgt = e.filter(F.col("ts") < ntz(dt.datetime(2024, 1, 20))).select("user_id", F.to_date("ts").alias("d"))
    return new_records(src, tgt, ["user_id", (F.to_date(src["ts"]), tgt["d"])])


@query("delta_anti_mixed_eq", oracle="""
WITH s AS (SELECT o_custkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey END AS k2, o_orderdate FROM orders)
SELECT s.o_custkey, s.k2 FROM s WHERE NOT EXISTS (
  SELECT 1 FROM s t WHERE t.o_orderdate < TIMESTAMP '1999-01-01'
    AND t.o_custkey IS NOT DISTINCT FROM s.o_custkey AND t.k2 = s.k2)""")
def delta_anti_mixed_eq(spark, sf):
    """Anti join mixing <=> and = keys (a NULL in the '=' key is always new)."""
    o = table(spark, sf, "orders")
    src = o.select("o_custkey", F.when(o["o_orderkey"] % 13 == 0, F.lit(None)).otherwise(o["o_orderkey"]).alias("k2"),
                   "o_orderdate")
    tgt = src.filter(F.col("o_orderdate") < ntz(dt.datetime(1999, 1, 1)))
    return new_records(src, tgt, ["o_custkey"], plain_keys=["k2"]).select("o_custkey", "k2")


@query("delta_anti_single_key", oracle="""
SELECT p_partkey, p_name FROM part s WHERE NOT EXISTS (
  SELECT 1 FROM part t WHERE t.p_size < 25 AND t.p_partkey IS NOT DISTINCT FROM s.p_partkey)""")
def delta_anti_single_key(spark, sf):
    """Anti join on a single surrogate id."""
    p = table(spark, sf, "part")
    return new_records(p.select("p_partkey", "p_name"), p.filter(F.col("p_size") < 25), ["p_partkey"])


# ---------------------------------------------------------------- J11-J13 latest rules
@query("latest_joint_max", oracle="""
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate FROM orders o JOIN (
  SELECT o_custkey, max(o_orderkey) AS mx_id, max(CAST(o_orderdate AS DATE)) AS mx_day FROM orders GROUP BY o_custkey) t
ON o.o_custkey = t.o_custkey AND o.o_orderkey = t.mx_id AND CAST(o.o_orderdate AS DATE) = t.mx_day""")
def latest_joint_max_q(spark, sf):
    """Per customer, the order holding both max id and max day (else the customer vanishes)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return latest_joint_max(o, ["o_custkey"], ["o_orderkey", ("day", F.to_date("o_orderdate"))])


@query("latest_null_sentinel_key", oracle="""
WITH e AS (SELECT event_id, event_type, CASE WHEN event_id % 10 = 0 THEN NULL ELSE user_id END AS ukey, ts FROM events)
SELECT e.event_id, e.event_type, e.ukey, e.ts FROM e JOIN (
  SELECT event_type, ukey, max(event_id) AS mx_id, max(CAST(ts AS DATE)) AS mx_day FROM e GROUP BY event_type, ukey) t
ON e.event_type = t.event_type AND coalesce(e.ukey, -1) = coalesce(t.ukey, -1)
   AND e.event_id = t.mx_id AND CAST(e.ts AS DATE) = t.mx_day""")
def latest_null_sentinel_key(spark, sf):
    """Latest rule with a NULL-tolerant key (coalesce(k, -1) on both sides)."""
    e = table(spark, sf, "events")
    e = e.select("event_id", "event_type",
                 F.when(e["event_id"] % 10 == 0, F.lit(None)).otherwise(e["user_id"]).alias("ukey"), "ts")
    return latest_joint_max(e, ["event_type", ("ukey", F.coalesce(F.col("ukey"), F.lit(-1)))],
                            ["event_id", ("day", F.to_date("ts"))])


@query("latest_double", oracle="""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_shipdate FROM lineitem l
JOIN (SELECT l_orderkey, max(l_linenumber) AS a, max(CAST(l_shipdate AS DATE)) AS b FROM lineitem GROUP BY l_orderkey) t1
  ON l.l_orderkey = t1.l_orderkey AND l.l_linenumber = t1.a AND CAST(l.l_shipdate AS DATE) = t1.b
JOIN (SELECT l_orderkey, max(l_partkey) AS a, max(CAST(l_shipdate AS DATE)) AS b FROM lineitem GROUP BY l_orderkey) t2
  ON l.l_orderkey = t2.l_orderkey AND l.l_partkey = t2.a AND CAST(l.l_shipdate AS DATE) = t2.b""")
def latest_double(spark, sf):
    """Two independent latest rules ANDed, both over the unfiltered input (one aggregate)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    d = ("day", F.to_date("l_shipdate"))
    return latest_joint_max(li, ["l_orderkey"], [["l_linenumber", d], ["l_partkey", d]])


# ---------------------------------------------------------------- J14-J16, W1-W2
def _last_orders(o):
    return last_per_key(o.select("o_custkey", F.to_date("o_orderdate").alias("order_day"), "o_orderkey"),
                        ["o_custkey"], ["order_day", "o_orderkey"])


_LAST_ORDER_SQL = """(SELECT o_custkey, order_day FROM (
   SELECT o_custkey, CAST(o_orderdate AS DATE) AS order_day,
          row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
   FROM orders {where}) r WHERE rn = 1)"""


@query("full_outer_last_events", oracle=f"""
SELECT coalesce(v.o_custkey, d.o_custkey) AS custkey, v.order_day AS last_order_day, d.ship_day AS last_ship_day,
       CASE WHEN v.order_day >= d.ship_day THEN v.order_day ELSE coalesce(d.ship_day, v.order_day) END AS last_encounter
FROM {_LAST_ORDER_SQL.format(where="WHERE o_orderstatus = 'F'")} v
FULL JOIN (SELECT o.o_custkey, max(CAST(l.l_shipdate AS DATE)) AS ship_day
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
           WHERE l.l_returnflag = 'N' AND o.o_orderstatus <> 'F' GROUP BY o.o_custkey) d
ON v.o_custkey = d.o_custkey""")
def full_outer_last_events(spark, sf):
    """FULL OUTER join of two latest-event sets with coalesced keys."""
    o = table(spark, sf, "orders")
    v = _last_orders(o.filter(F.col("o_orderstatus") == "F")).select("o_custkey", "order_day")
    li = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "N")
    d = (li.join(o.filter(F.col("o_orderstatus") != "F"), li["l_orderkey"] == o["o_orderkey"])
         .groupBy("o_custkey").agg(F.max(F.to_date("l_shipdate")).alias("ship_day")))
    j = v.alias("v").join(d.alias("d"), F.col("v.o_custkey") == F.col("d.o_custkey"), "full")
    vd, dd = F.col("v.order_day"), F.col("d.ship_day")
    return j.select(F.coalesce("v.o_custkey", "d.o_custkey").alias("custkey"), vd.alias("last_order_day"),
                    dd.alias("last_ship_day"),
                    F.when(vd >= dd, vd).otherwise(F.coalesce(dd, vd)).alias("last_encounter"))


@query("left_attribute_chain", oracle=f"""
SELECT c.c_custkey, n.n_name, lo.order_day AS last_order_day
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN {_LAST_ORDER_SQL.format(where="")} lo ON lo.o_custkey = c.c_custkey""")
def left_attribute_chain(spark, sf):
    """Left-join chain of patient attributes."""
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    lo = _last_orders(table(spark, sf, "orders")).select("o_custkey", F.col("order_day").alias("last_order_day"))
    return (c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
            .join(lo, c["c_custkey"] == lo["o_custkey"], "left")
            .select("c_custkey", "n_name", "last_order_day"))


@query("asof_last_event", oracle="""
WITH m AS (SELECT last_day(CAST(d AS DATE)) AS AsOfDate
           FROM range(TIMESTAMP '1996-01-01', TIMESTAMP '2001-12-02', INTERVAL 1 MONTH) t(d)),
r AS (SELECT o.o_custkey, m.AsOfDate, o.o_orderkey, CAST(o.o_orderdate AS DATE) AS order_day,
             row_number() OVER (PARTITION BY o.o_custkey, m.AsOfDate
                                ORDER BY CAST(o.o_orderdate AS DATE) DESC, o.o_orderkey DESC) AS rn
      FROM orders o JOIN m ON CAST(o.o_orderdate AS DATE) <= m.AsOfDate)
SELECT o_custkey, AsOfDate, o_orderkey, order_day FROM r WHERE rn = 1""")
def asof_last_event(spark, sf):
    """Newest order with date <= month-end, for every customer and month 1996-01 .. 2001-12."""
    o = table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("order_day"), "o_orderkey")
    return asof_latest(o, ["o_custkey"], "order_day", ["order_day", "o_orderkey"],
                       dt.date(1996, 1, 1), dt.date(2001, 12, 31)) \
        .select("o_custkey", "AsOfDate", "o_orderkey", "order_day")


@query("window_row_number", oracle="""
SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey, o_orderstatus
        ORDER BY o_orderdate DESC, o_orderkey DESC) AS rank FROM orders""")
def window_row_number(spark, sf):
    """row_number() over (patient keys) ordered by date desc (with a tie-break)."""
    from wardflow.operators.latest import row_number
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return row_number(o, ["o_custkey", "o_orderstatus"], ["o_orderdate", "o_orderkey"]) \
        .select("o_orderkey", "o_custkey", F.col("rank").cast("long").alias("rank"))


@query("window_row_number_ranges", oracle="""
SELECT o_orderkey, st, o_custkey, row_number() OVER (PARTITION BY st ORDER BY o_orderdate DESC, o_orderkey DESC) AS rank
FROM (SELECT *, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS st FROM orders) o""")
def window_row_number_ranges(spark, sf):
    """row_number() over few, hot keys (one NULL), their rows spread over ranges."""
    from wardflow.operators.latest import row_number_ranges
    o = table(spark, sf, "orders")
    o = o.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("st"), "o_custkey", "o_orderdate")
    return row_number_ranges(o, ["st"], ["o_orderdate", "o_orderkey"]).select("o_orderkey", "st", "o_custkey", "rank")


@query("asof_join_events", oracle="""
WITH l AS (SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 17 = 0 THEN NULL ELSE user_id END AS k FROM events),
r AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS k, max(o_orderkey) AS o_orderkey,
             TIMESTAMP '2024-01-01' + to_seconds((o_orderkey * 7919) % 2592000) AS at
      FROM orders GROUP BY 1, 3)
SELECT l.event_id, l.k, r.o_orderkey AS last_order, r.at AS last_at FROM l ASOF LEFT JOIN r ON l.k = r.k AND l.ts >= r.at""")
def asof_join_events(spark, sf):
    """The newest order at or before each event, a third of all rows under one key, some keys NULL."""
    e = table(spark, sf, "events")
    e = e.select("event_id", "ts", F.when(F.col("event_id") % 3 == 0, 1).when(F.col("event_id") % 17 == 0, None)
                 .otherwise(F.col("user_id")).cast("long").alias("k"))
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey")).cast("long").alias("k"),
        F.expr("timestampadd(SECOND, (o_orderkey * 7919) % 2592000, TIMESTAMP_NTZ '2024-01-01 00:00:00')").alias("at"))
    return asof_join(e, o, ["k"], "ts", "at", {"o_orderkey": "last_order", "at": "last_at"}, tie=["o_orderkey"]) \
        .select("event_id", "k", "last_order", "last_at")


_LI_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query("last_event_per_key", oracle=f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(c + ' DESC' for c in _LI_ORDER)}) AS rn
  FROM lineitem) r WHERE rn = 1""")
def last_event_per_key(spark, sf):
    """Rank-1 row per key (row_number() = 1) as a map-side combined max(struct)."""
    li = table(spark, sf, "lineitem")
    return last_per_key(li, ["l_orderkey"], _LI_ORDER).select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


# ---------------------------------------------------------------- A1-A3
@query("group_multi_max", oracle="""
SELECT l_orderkey, max(l_linenumber) AS max_line, max(CAST(l_shipdate AS DATE)) AS max_ship
FROM lineitem GROUP BY l_orderkey""")
def group_multi_max(spark, sf):
    """Group by key, several max()."""
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_linenumber").alias("max_line"), F.max(F.to_date("l_shipdate")).alias("max_ship"))


@query("group_max_cast", oracle="SELECT user_id, max(CAST(ts AS DATE)) AS last_day FROM events GROUP BY user_id")
def group_max_cast(spark, sf):
    """max() over a cast expression."""
    return table(spark, sf, "events").groupBy("user_id").agg(F.max(F.to_date("ts")).alias("last_day"))


@query("group_expr_keys", oracle="""
SELECT o_custkey, CAST(o_orderdate AS DATE) AS order_day, max(o_orderkey) AS max_id,
       CAST(max(o_orderdate) AS DATE) AS max_day
FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)""")
def group_expr_keys(spark, sf):
    """Group by expression keys, then cast of a max."""
    return table(spark, sf, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("order_day")).agg(
        F.max("o_orderkey").alias("max_id"), F.to_date(F.max("o_orderdate")).alias("max_day"))


# ---------------------------------------------------------------- L1, U1, U2
@query("top_n_distinct", oracle="""
SELECT DISTINCT l_orderkey, l_partkey FROM lineitem ORDER BY l_orderkey, l_partkey LIMIT 20""")
def top_n_distinct(spark, sf):
    """TOP n after DISTINCT (made deterministic with an ORDER BY; the limit is the feature)."""
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").distinct() \
        .orderBy("l_orderkey", "l_partkey").limit(20)


@query("union_distinct", oracle="""
SELECT n_name AS name FROM nation UNION SELECT r_name FROM region UNION SELECT n_name FROM nation""")
def union_distinct(spark, sf):
    """UNION (distinct) of several inputs."""
    n = table(spark, sf, "nation").select(F.col("n_name").alias("name"))
    r = table(spark, sf, "region").select(F.col("r_name").alias("name"))
    return n.unionByName(r).unionByName(n).distinct()


@query("month_spine", oracle="""
SELECT last_day(CAST(d AS DATE)) AS end_date FROM range(
  (SELECT date_trunc('month', min(o_orderdate)) FROM orders),
  (SELECT date_trunc('month', max(o_orderdate)) FROM orders) + INTERVAL 1 DAY, INTERVAL 1 MONTH) t(d)""")
def month_spine_q(spark, sf):
    """Month-end series spanning the order dates (explode(sequence()), no recursion)."""
    return month_spine_of(table(spark, sf, "orders"), "o_orderdate")
