"""Scalar functions, cleaning rules and digests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from wardflow.functions import dates as D
from wardflow.functions.hashing import hash_columns, hash_utf8, hash_utf16le, hash_varchar
from wardflow.functions.rules import (
    blank_to_null, cap_to_null, clamp_date, clamp_number, negative_label, null_default,
    parse_mixed_date, present_flag, recode, sentinel_to_null,
)
from wardflow.queries import query
from wardflow.queries._data import AS_OF, table

# ---------------------------------------------------------------- C1-C9


@query("scalar_case", oracle="""
SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 'Final' WHEN 'O' THEN 'Open' ELSE 'Other' END AS status_name,
  CASE WHEN o_totalprice >= 300000 THEN 'high' WHEN o_totalprice >= 100000 THEN 'mid' ELSE 'low' END AS band
FROM orders""")
def scalar_case(spark, sf):
    """Simple CASE value map and searched CASE."""
    o = table(spark, sf, "orders")
    status = recode("o_orderstatus", {"Final": ["F"], "Open": ["O"]}, default="Other")
    band = (F.when(F.col("o_totalprice") >= 300000, "high").when(F.col("o_totalprice") >= 100000, "mid")
            .otherwise("low"))
    return o.select("o_orderkey", status.alias("status_name"), band.alias("band"))


@query("scalar_coalesce", oracle="""
SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END,
                            CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderstatus END, 'Empty') AS value
FROM orders""")
def scalar_coalesce(spark, sf):
    """COALESCE / ISNULL chains with a constant default."""
    o = table(spark, sf, "orders")
    a = F.when(o["o_orderkey"] % 4 == 0, F.lit(None)).otherwise(o["o_orderpriority"])
    b = F.when(o["o_orderkey"] % 8 == 0, F.lit(None)).otherwise(o["o_orderstatus"])
    return o.select("o_orderkey", F.coalesce(a, b, F.lit("Empty")).alias("value"))


@query("scalar_casts", oracle="""
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_day,
       TRY_CAST(CASE WHEN l_linenumber = 3 THEN 'n/a' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS DOUBLE) AS qty,
       TRY_CAST(CASE WHEN l_linenumber = 3 THEN 'n/a' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS DOUBLE) > 20 AS big
FROM lineitem""")
def scalar_casts(spark, sf):
    """cast as date; text -> float cast for comparison (ANSI-safe)."""
    li = table(spark, sf, "lineitem")
    txt = F.when(li["l_linenumber"] == 3, F.lit("n/a")).otherwise(li["l_quantity"].cast("bigint").cast("string"))
    return li.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("ship_day"),
                     txt.try_cast("double").alias("qty"), (txt.try_cast("double") > 20).alias("big"))


@query("scalar_strings", oracle="""
SELECT c_custkey, left(c_name, 1) AS initial, substring(c_name, 10, 9) AS digits, length(c_name) AS len,
       upper(lower(c_mktsegment)) AS segment FROM customer""")
def scalar_strings(spark, sf):
    """LEFT, SUBSTRING, LEN, UPPER."""
    c = table(spark, sf, "customer")
    return c.select("c_custkey", F.left("c_name", F.lit(1)).alias("initial"),
                    F.substring("c_name", 10, 9).alias("digits"), F.length("c_name").cast("long").alias("len"),
                    F.upper(F.lower("c_mktsegment")).alias("segment"))


@query("scalar_predicates", oracle="""
SELECT l_orderkey, l_linenumber, l_returnflag IN ('A', 'R') AS flagged, l_quantity < 10 AS small,
       l_quantity <= 10 AS small_eq, l_discount > 0.05 AS disc, l_linestatus <> 'O' AS closed,
       l_tax IS NOT NULL AS has_tax FROM lineitem""")
def scalar_predicates(spark, sf):
    """isin, <, <=, >, <>, IS NOT NULL."""
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.col("l_returnflag").isin("A", "R").alias("flagged"),
                     (F.col("l_quantity") < 10).alias("small"), (F.col("l_quantity") <= 10).alias("small_eq"),
                     (F.col("l_discount") > 0.05).alias("disc"), (F.col("l_linestatus") != "O").alias("closed"),
                     F.col("l_tax").isNotNull().alias("has_tax"))


@query("date_month_end", oracle="""
SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m,
       make_date(year(o_orderdate), month(o_orderdate), 1) AS month_start,
       last_day(CAST(o_orderdate AS DATE)) AS month_end FROM orders""")
def date_month_end(spark, sf):
    """year, month, datefromparts, eomonth."""
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", F.year("o_orderdate").cast("long").alias("y"),
                    F.month("o_orderdate").cast("long").alias("m"),
                    D.month_start("o_orderdate").alias("month_start"), D.month_end("o_orderdate").alias("month_end"))


@query("date_add_units", oracle="""
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS plus_month,
       CAST(o_orderdate AS DATE) + 30 AS plus_30d, o_orderdate - INTERVAL 1 SECOND AS minus_1s,
       CAST(make_date(year(o_orderdate), month(o_orderdate), 1) + INTERVAL 1 MONTH AS TIMESTAMP)
         - INTERVAL 1 SECOND AS month_last_second
FROM orders""")
def date_add_units(spark, sf):
    """dateadd month / day / second."""
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", F.add_months(F.to_date("o_orderdate"), 1).alias("plus_month"),
                    F.date_add(F.to_date("o_orderdate"), 30).alias("plus_30d"),
                    (F.col("o_orderdate") - F.expr("INTERVAL 1 SECOND")).alias("minus_1s"),
                    D.end_of_month_instant("o_orderdate").alias("month_last_second"))


@query("date_diff_boundary", oracle="""
SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-01-01') AS days,
       date_diff('year', CAST(o_orderdate AS DATE), DATE '2000-01-01') AS years,
       date_diff('month', CAST(o_orderdate AS DATE), DATE '2000-01-01') AS months FROM orders""")
def date_diff_boundary(spark, sf):
    """datediff day; year and month as boundary counts."""
    o = table(spark, sf, "orders")
    ref = F.lit(dt.date(2000, 1, 1))
    return o.select("o_orderkey", D.day_diff("o_orderdate", ref).cast("long").alias("days"),
                    D.year_diff_boundary(F.to_date("o_orderdate"), ref).cast("long").alias("years"),
                    D.month_diff_boundary(F.to_date("o_orderdate"), ref).cast("long").alias("months"))


_MIXED_TEXT_SQL = """CASE WHEN o_orderkey % 5 = 0 THEN 'n/a'
     WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
     ELSE strftime(o_orderdate, '%d/%m/%Y') END"""


def _mixed_text(o):
    return (F.when(o["o_orderkey"] % 5 == 0, F.lit("n/a"))
            .when(o["o_orderkey"] % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
            .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")))


@query("parse_mixed_dates", oracle=f"""
SELECT o_orderkey, raw, CAST(coalesce(TRY_CAST(raw AS TIMESTAMP),
       CASE WHEN length(substring(raw, 7, 4)) = 4 THEN try_strptime(raw, '%d/%m/%Y') END) AS DATE) AS parsed
FROM (SELECT o_orderkey, {_MIXED_TEXT_SQL} AS raw FROM orders) t""")
def parse_mixed_dates(spark, sf):
    """Text dates in ISO or dd/mm/yyyy form (try ISO, else style-103 guarded by the year slot)."""
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", _mixed_text(o).alias("raw")).withColumn("parsed", parse_mixed_date("raw"))


# ---------------------------------------------------------------- Q1-Q14
_PRIO_DIRTY_SQL = "CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 7 = 1 THEN NULL ELSE o_orderpriority END"


def _prio_dirty(o):
    return (F.when(o["o_orderkey"] % 7 == 0, F.lit("")).when(o["o_orderkey"] % 7 == 1, F.lit(None))
            .otherwise(o["o_orderpriority"]))


@query("dq_blank_to_null", oracle=f"""
SELECT o_orderkey, CASE WHEN p = '' THEN NULL ELSE p END AS priority
FROM (SELECT o_orderkey, {_PRIO_DIRTY_SQL} AS p FROM orders) t""")
def dq_blank_to_null(spark, sf):
    """'' -> NULL."""
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", blank_to_null(_prio_dirty(o)).alias("priority"))


@query("dq_clamp_date", oracle="""
SELECT o_orderkey, CASE WHEN d < DATE '1996-01-01' OR d > DATE '2000-12-31' THEN DATE '1900-01-01' ELSE d END AS visit_date
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders) t""")
def dq_clamp_date(spark, sf):
    """Date outside [lo, as_of] -> 1900-01-01."""
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", clamp_date(F.to_date("o_orderdate"), "1996-01-01", AS_OF).alias("visit_date"))


@query("dq_date_to_null", oracle="""
SELECT l_orderkey, l_linenumber, CASE WHEN l_shipdate < TIMESTAMP '1996-01-01' THEN NULL ELSE l_shipdate END AS ship
FROM lineitem""")
def dq_date_to_null(spark, sf):
    """Date before the lower bound -> NULL (open upper end)."""
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     clamp_date("l_shipdate", lo=dt.datetime(1996, 1, 1), fill=None).alias("ship"))


@query("dq_future_window", oracle="""
SELECT o_orderkey, CASE WHEN n < DATE '1980-01-01' OR n > DATE '2001-06-30' THEN DATE '1900-01-01' ELSE n END AS next_appt
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) AS n FROM orders) t""")
def dq_future_window(spark, sf):
    """Appointment allowed up to as_of + 12 months."""
    o = table(spark, sf, "orders")
    n = F.date_add(F.to_date("o_orderdate"), (o["o_orderkey"] % 400).cast("int"))
    as_of = dt.date(2000, 6, 30)
    return o.select("o_orderkey", clamp_date(n, "1980-01-01", F.add_months(F.lit(as_of), 12)).alias("next_appt"))


_AGE_TEXT_SQL = ("CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 9 = 1 THEN 'abc' "
                 "ELSE CAST(c_nationkey * 10 - 50 AS VARCHAR) END")


def _age_text(c):
    return (F.when(c["c_custkey"] % 9 == 0, F.lit("")).when(c["c_custkey"] % 9 == 1, F.lit("abc"))
            .otherwise((c["c_nationkey"] * 10 - 50).cast("string")))


@query("dq_clamp_number", oracle=f"""
SELECT c_custkey, CASE WHEN TRY_CAST(a AS DOUBLE) < 0 OR TRY_CAST(a AS DOUBLE) > 120 THEN '999' ELSE a END AS age
FROM (SELECT c_custkey, {_AGE_TEXT_SQL} AS a FROM customer) t""")
def dq_clamp_number(spark, sf):
    """Numeric text outside [0, 120] -> 999; non-numeric text kept."""
    c = table(spark, sf, "customer")
    return c.select("c_custkey", clamp_number(_age_text(c), 0, 120, text=True).alias("age"))


@query("dq_cap_to_null", oracle="""
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity END AS qty FROM lineitem""")
def dq_cap_to_null(spark, sf):
    """Value above a cap -> NULL."""
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", cap_to_null("l_quantity", 45).alias("qty"))


# Fixed recode vocabulary of the part-brand test (spelling lists, in order).
_BRAND_RECODE = {
    "Premium": ["Brand#1", "Brand#2", "Brand#3"],
    "Value": ["Brand#24", "Brand#25"],
    None: ["Brand#13"],
}


@query("dq_recode_keep", oracle="""
SELECT p_partkey, CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'Premium'
                       WHEN p_brand IN ('Brand#24', 'Brand#25') THEN 'Value'
                       WHEN p_brand = 'Brand#13' THEN NULL ELSE p_brand END AS brand FROM part""")
def dq_recode_keep(spark, sf):
    """Recode with a map literal; unmatched spellings kept, one spelling -> NULL."""
    return table(spark, sf, "part").select("p_partkey", recode("p_brand", _BRAND_RECODE).alias("brand"))


@query("dq_recode_closed", oracle="""
SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'Engagement'
                      WHEN event_type = 'purchase' THEN 'Revenue' ELSE 'Not Done' END AS kind FROM events""")
def dq_recode_closed(spark, sf):
    """Closed vocabulary: unmatched -> constant."""
    return table(spark, sf, "events").select(
        "event_id", recode("event_type", {"Engagement": ["click", "view"], "Revenue": ["purchase"]},
                           default="Not Done").alias("kind"))


@query("dq_present_flag", oracle="""
SELECT o_orderkey, CASE WHEN f = 'No' THEN 'No' WHEN f IS NOT NULL THEN 'Yes' END AS disabled
FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'No' WHEN 'P' THEN NULL ELSE o_orderpriority END AS f
      FROM orders) t""")
def dq_present_flag(spark, sf):
    """'No' -> No, other non-NULL -> Yes, NULL -> NULL."""
    o = table(spark, sf, "orders")
    f = (F.when(o["o_orderstatus"] == "F", F.lit("No")).when(o["o_orderstatus"] == "P", F.lit(None))
         .otherwise(o["o_orderpriority"]))
    return o.select("o_orderkey", present_flag(f).alias("disabled"))


@query("dq_negative_label", oracle="""
SELECT c_custkey, CASE WHEN TRY_CAST(r AS DOUBLE) < 0 THEN 'Viral Load' ELSE r END AS result
FROM (SELECT c_custkey, CAST(c_custkey % 200 - 20 AS VARCHAR) AS r FROM customer) t""")
def dq_negative_label(spark, sf):
    """Negative numeric text -> label."""
    c = table(spark, sf, "customer")
    return c.select("c_custkey", negative_label((c["c_custkey"] % 200 - 20).cast("string"), "Viral Load").alias("result"))


@query("dq_sentinel_null", oracle="""
SELECT n_nationkey, CASE WHEN x IN ('NULL', 'null', 'N/A') THEN NULL ELSE x END AS name
FROM (SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'NULL' WHEN 1 THEN 'N/A' ELSE n_name END AS x
      FROM nation) t""")
def dq_sentinel_null(spark, sf):
    """Sentinel tokens -> NULL."""
    n = table(spark, sf, "nation")
    x = (F.when(n["n_nationkey"] % 4 == 0, F.lit("NULL")).when(n["n_nationkey"] % 4 == 1, F.lit("N/A"))
         .otherwise(n["n_name"]))
    return n.select("n_nationkey", sentinel_to_null(x, ["NULL", "null", "N/A"]).alias("name"))


@query("dq_null_default", oracle="""
SELECT s_suppkey, coalesce(CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_nationkey END, 0) AS voided FROM supplier""")
def dq_null_default(spark, sf):
    """NULL -> 0."""
    s = table(spark, sf, "supplier")
    x = F.when(s["s_suppkey"] % 3 == 0, F.lit(None)).otherwise(s["s_nationkey"])
    return s.select("s_suppkey", null_default(x, 0).alias("voided"))


# ---------------------------------------------------------------- H1-H4
_UTF16_SQL = "upper(sha256(unhex(regexp_replace(hex(substring({c}, 1, 36)), '(..)', '\\100', 'g'))))"


@query("hash_utf8", oracle="""
SELECT c_custkey, upper(sha256(c_name)) AS name_hash, upper(sha256(CAST(c_custkey AS VARCHAR))) AS pk_hash
FROM customer""")
def hash_utf8_q(spark, sf):
    """SHA-256 of the UTF-8 text, upper hex."""
    c = table(spark, sf, "customer")
    return c.select("c_custkey", hash_utf8("c_name").alias("name_hash"), hash_utf8("c_custkey").alias("pk_hash"))


@query("hash_utf16le", oracle=f"""
SELECT c_custkey, {_UTF16_SQL.format(c='c_name')} AS name_hash,
       {_UTF16_SQL.format(c='CAST(c_custkey AS VARCHAR)')} AS pk_hash,
       {_UTF16_SQL.format(c="c_name || '-' || c_mktsegment || '-' || c_name")} AS long_hash
FROM customer""")
def hash_utf16le_q(spark, sf):
    """The stored digest: SHA-256 of the first 36 characters as UTF-16LE."""
    c = table(spark, sf, "customer")
    long_id = F.concat_ws("-", "c_name", "c_mktsegment", "c_name")
    return c.select("c_custkey", hash_utf16le("c_name").alias("name_hash"), hash_utf16le("c_custkey").alias("pk_hash"),
                    hash_utf16le(long_id).alias("long_hash"))


@query("hash_varchar30", oracle="""
SELECT c_custkey, upper(sha256(substring(c_name || '-' || c_mktsegment || '-' || c_name, 1, 30))) AS id_hash,
       upper(sha256(CAST(c_custkey AS VARCHAR))) AS pk_hash FROM customer""")
def hash_varchar30(spark, sf):
    """Digest of varchar (30 single-byte characters)."""
    c = table(spark, sf, "customer")
    long_id = F.concat_ws("-", "c_name", "c_mktsegment", "c_name")
    return c.select("c_custkey", hash_varchar(long_id).alias("id_hash"), hash_varchar("c_custkey").alias("pk_hash"))


@query("hash_multi_columns", oracle=f"""
SELECT o_orderkey, o_custkey, {_UTF16_SQL.format(c='CAST(o_orderkey AS VARCHAR)')} AS VisitIDHash,
       {_UTF16_SQL.format(c='CAST(o_custkey AS VARCHAR)')} AS PatientPKHash FROM orders""")
def hash_multi_columns(spark, sf):
    """Column map {id -> id digest} applied in one projection."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return hash_columns(o, {"o_orderkey": "VisitIDHash", "o_custkey": "PatientPKHash"})
