"""End-to-end queries: incremental loads run from specs, monthly outcomes, date repair."""

from __future__ import annotations

import datetime as dt
from contextlib import ExitStack

from pyspark.sql import functions as F

from wardflow.operators.asof import monthly_outcomes
from wardflow.plans.run import FrameIO, build_load
from wardflow.plans.spec import Latest, LoadSpec, Lookup, Parent, rule
from wardflow.queries import query
from wardflow.queries._data import AS_OF, ntz, table
from wardflow.queries.feeds import Feed
from wardflow.operators.repair import repair_dates
from wardflow.sources.audit import RuleAudit

# =============================================================== orders as visits
# Mapping: customer = patient (SiteCode = nation), nation = facility,
# orders = visit extract, orders placed before 1999-07-01 = the existing target.
VISIT_SPEC = LoadSpec(
    name="visits_from_orders",
    source="visit_extract",
    target="visits",
    latest=Latest(keys=("PatientPK", "Status"),
                  maxes=("ID", "cast(DateExtracted as date)")),
    parents=(Parent("patient", (("PatientPK", "PatientPK"),), columns=(("SiteCode", "SiteCode"), ("Gender", "Gender"))),
             Parent("facility", (("SiteCode", "Code"),), where="NOT Voided", columns=(("Name", "FacilityName"),))),
    where=("Gender <> 'Unknown'", "SiteCode > 0"),
    columns=("PatientPK", "SiteCode", "FacilityName", "ID", "VisitDate", "Priority", "Status", "DateExtracted"),
    rules=(rule("Priority", "blank"),
           rule("VisitDate", "date", lo="1996-01-01"),
           rule("Status", "recode", mapping=(("Final", ("F",)), ("Open", ("O",))))),
    lookups=(Lookup("Priority", "lkp_priority"),),
    delta_keys=("PatientPK", "SiteCode", "ID"),
    hashes=(("PatientPK", "PatientPKHash"), ("ID", "VisitIDHash")),
)


def _load(spec, io, as_of=AS_OF):
    """The load over a fixture; plain contract columns that the fixture's form does not feed are NULL texts in it.

    A column with a rule, cast or lookup must be fed, else its rule would run on NULL only."""
    form = io.tables[spec.source]
    made = [o for p in spec.parents for _, o in p.columns] + [n for n, _ in spec.derived] + list(spec.nulls)
    made += [n for n, _ in spec.aggregates]
    have = {c.lower() for c in form.columns + made}
    lack = [c for c in spec.columns if c.lower() not in have]
    ruled = {r.column for r in (*spec.rules, *spec.select_rules, *spec.lookups)} | {c for c, _ in spec.select}
    if ruled & set(lack):
        raise ValueError(f"{spec.name}: the fixture does not feed {sorted(ruled & set(lack))}")
    io.tables[spec.source] = form.withColumns({c: F.lit(None).cast("string") for c in lack})
    return build_load(spec, io, as_of)


def _visit_io(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    extract = o.select(
        F.col("o_orderkey").alias("ID"), F.col("o_custkey").alias("PatientPK"),
        F.to_date("o_orderdate").alias("VisitDate"),
        F.date_add(F.to_date("o_orderdate"), ((F.col("o_orderkey") * 7) % 30).cast("int")).alias("DateExtracted"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("")).otherwise(F.col("o_orderpriority")).alias("Priority"),
        F.col("o_orderstatus").alias("Status"))
    patient = c.select(F.col("c_custkey").alias("PatientPK"), F.col("c_nationkey").alias("SiteCode"),
                       F.when(F.col("c_custkey") % 10 == 1, F.lit("Unknown"))
                       .otherwise(F.col("c_mktsegment")).alias("Gender"))
    facility = n.select(F.col("n_nationkey").alias("Code"), F.col("n_name").alias("Name"),
                        (F.col("n_regionkey") == 4).alias("Voided"))
    lkp = (o.select(F.col("o_orderpriority").alias("source_name")).distinct()
           .filter(F.col("source_name") != "5-LOW")
           .withColumn("target_name", F.upper(F.substring("source_name", 3, 100))))
    target = (o.filter(F.col("o_orderdate") < ntz(dt.datetime(1999, 7, 1)))
              .join(c, o["o_custkey"] == c["c_custkey"])
              .select(F.col("o_custkey").alias("PatientPK"), F.col("c_nationkey").alias("SiteCode"),
                      F.col("o_orderkey").alias("ID")))
    return FrameIO({"visit_extract": extract, "patient": patient, "facility": facility, "lkp_priority": lkp},
                   {"visits": target})


_UTF16 = "upper(sha256(unhex(regexp_replace(hex(substring(CAST({c} AS VARCHAR), 1, 36)), '(..)', '\\100', 'g'))))"

_VISIT_ORACLE = f"""
WITH x AS (
  SELECT o_orderkey AS ID, o_custkey AS PatientPK, CAST(o_orderdate AS DATE) AS VisitDate,
         CAST(o_orderdate AS DATE) + CAST((o_orderkey * 7) % 30 AS INTEGER) AS DateExtracted,
         CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderpriority END AS Priority, o_orderstatus AS Status
  FROM orders),
latest AS (
  SELECT x.* FROM x JOIN (SELECT PatientPK, Status, max(ID) AS mid, max(CAST(DateExtracted AS DATE)) AS mday
                          FROM x GROUP BY PatientPK, Status) t
  ON x.PatientPK = t.PatientPK AND x.Status = t.Status AND x.ID = t.mid AND CAST(x.DateExtracted AS DATE) = t.mday),
scan AS (
  SELECT DISTINCT l.PatientPK, c.c_nationkey AS SiteCode, n.n_name AS FacilityName, l.ID, l.VisitDate, l.Priority,
         l.Status, l.DateExtracted
  FROM latest l JOIN customer c ON l.PatientPK = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey AND NOT (n.n_regionkey = 4)
  WHERE (CASE WHEN c.c_custkey % 10 = 1 THEN 'Unknown' ELSE c.c_mktsegment END) <> 'Unknown'
    AND c.c_nationkey > 0),
clean AS (
  SELECT PatientPK, SiteCode, FacilityName, ID,
         CASE WHEN VisitDate < DATE '1996-01-01' OR VisitDate > DATE '{AS_OF.isoformat()}' THEN DATE '1900-01-01'
              ELSE VisitDate END AS VisitDate,
         CASE WHEN Priority = '' THEN NULL ELSE Priority END AS Priority,
         CASE Status WHEN 'F' THEN 'Final' WHEN 'O' THEN 'Open' ELSE Status END AS Status, DateExtracted
  FROM scan),
lkp AS (SELECT DISTINCT o_orderpriority AS source_name, upper(substring(o_orderpriority, 3, 100)) AS target_name
        FROM orders WHERE o_orderpriority <> '5-LOW'),
std AS (SELECT c.PatientPK, c.SiteCode, c.FacilityName, c.ID, c.VisitDate,
               coalesce(l.target_name, c.Priority) AS Priority, c.Status, c.DateExtracted
        FROM clean c LEFT JOIN lkp l ON c.Priority = l.source_name),
tgt AS (SELECT o.o_custkey AS PatientPK, c.c_nationkey AS SiteCode, o.o_orderkey AS ID
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderdate < TIMESTAMP '1999-07-01')
SELECT s.*, {_UTF16.format(c='s.PatientPK')} AS PatientPKHash, {_UTF16.format(c='s.ID')} AS VisitIDHash
FROM std s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.PatientPK IS NOT DISTINCT FROM s.PatientPK
  AND t.SiteCode IS NOT DISTINCT FROM s.SiteCode AND t.ID IS NOT DISTINCT FROM s.ID)"""


@query("incremental_load_orders", oracle=_VISIT_ORACLE)
def incremental_load_orders(spark, sf):
    """Flagship: a full incremental load (latest rule, parents, cleaning, lookup, delta, digests)."""
    return build_load(VISIT_SPEC, _visit_io(spark, sf), AS_OF)


# =============================================================== events
EVENT_SPEC = LoadSpec(
    name="events_by_day",
    source="event_extract",
    target="events_loaded",
    columns=("EventID", "UserID", "EventTime", "Kind"),
    rules=(rule("Kind", "sentinel", tokens=("N/A", "NULL")),
           rule("Kind", "recode", mapping=(("Engagement", ("click", "view")), ("Revenue", ("purchase",))),
                default="Not Done")),
    delta_keys=("UserID", ("cast(EventTime as date)", "cast(EventTime as date)")),
)


@query("incremental_load_events", oracle="""
WITH x AS (SELECT DISTINCT event_id AS EventID, user_id AS UserID, ts AS EventTime,
                  CASE WHEN event_id % 12 = 0 THEN 'N/A' ELSE event_type END AS Kind FROM events),
c AS (SELECT EventID, UserID, EventTime,
             CASE WHEN Kind IN ('click', 'view') THEN 'Engagement' WHEN Kind = 'purchase' THEN 'Revenue'
                  ELSE 'Not Done' END AS Kind FROM x)
SELECT * FROM c WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT user_id, CAST(ts AS DATE) AS d FROM events WHERE ts < TIMESTAMP '2024-01-15') t
  WHERE t.user_id IS NOT DISTINCT FROM c.UserID AND t.d IS NOT DISTINCT FROM CAST(c.EventTime AS DATE))""")
def incremental_load_events(spark, sf):
    """Load keyed by (user, day of a timestamp): cast-key anti join, sentinels, closed recode."""
    e = table(spark, sf, "events")
    extract = e.select(F.col("event_id").alias("EventID"), F.col("user_id").alias("UserID"),
                       F.col("ts").alias("EventTime"),
                       F.when(F.col("event_id") % 12 == 0, F.lit("N/A")).otherwise(F.col("event_type")).alias("Kind"))
    loaded = e.filter(F.col("ts") < ntz(dt.datetime(2024, 1, 15))) \
        .select(F.col("user_id").alias("UserID"), F.col("ts").alias("EventTime"))
    return build_load(EVENT_SPEC, FrameIO({"event_extract": extract}, {"events_loaded": loaded}), AS_OF)


# =============================================================== lineitem
LINE_SPEC = LoadSpec(
    name="lines_double_latest",
    source="line_extract",
    target="lines_loaded",
    latest=Latest(keys=("OrderKey",),
                  maxes=(("LineNo", "cast(ShipDate as date)"), ("PartKey", "cast(ShipDate as date)"))),
    columns=("OrderKey", "LineNo", "PartKey", "ShipDate", "Quantity"),
    rules=(rule("Quantity", "cap", hi=45),),
    delta_keys=("OrderKey", "LineNo"),
)


@query("incremental_load_lineitem", oracle="""
WITH l AS (SELECT l_orderkey AS OrderKey, l_linenumber AS LineNo, l_partkey AS PartKey, l_shipdate AS ShipDate,
                  l_quantity AS Quantity FROM lineitem),
a AS (SELECT OrderKey, max(LineNo) AS mx1, max(PartKey) AS mx2, max(CAST(ShipDate AS DATE)) AS md FROM l GROUP BY OrderKey),
s AS (SELECT DISTINCT l.OrderKey, l.LineNo, l.PartKey, l.ShipDate,
             CASE WHEN l.Quantity > 45 THEN NULL ELSE l.Quantity END AS Quantity
      FROM l JOIN a ON l.OrderKey = a.OrderKey AND l.LineNo = a.mx1 AND l.PartKey = a.mx2
                    AND CAST(l.ShipDate AS DATE) = a.md)
SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM lineitem t WHERE t.l_shipdate < TIMESTAMP '1999-01-01'
  AND t.l_orderkey IS NOT DISTINCT FROM s.OrderKey AND t.l_linenumber IS NOT DISTINCT FROM s.LineNo)""")
def incremental_load_lineitem(spark, sf):
    """Double latest rule (two joint maxima ANDed), cap rule, two-key delta."""
    li = table(spark, sf, "lineitem")
    extract = li.select(F.col("l_orderkey").alias("OrderKey"), F.col("l_linenumber").alias("LineNo"),
                        F.col("l_partkey").alias("PartKey"), F.col("l_shipdate").alias("ShipDate"),
                        F.col("l_quantity").alias("Quantity"))
    loaded = li.filter(F.col("l_shipdate") < ntz(dt.datetime(1999, 1, 1))) \
        .select(F.col("l_orderkey").alias("OrderKey"), F.col("l_linenumber").alias("LineNo"))
    return build_load(LINE_SPEC, FrameIO({"line_extract": extract}, {"lines_loaded": loaded}), AS_OF)


# =============================================================== monthly outcomes
# Mapping: patient key = (custkey, 'CCC-'||custkey, nation); visits = orders;
# dispenses = lineitem via its order; exits = returned lines with quantity >= 48;
# ART start spread over 1995-06 .. 2000-12; months 1996-01 .. 2001-12.
OUTCOME_START, OUTCOME_END = dt.date(1996, 1, 1), dt.date(2001, 12, 31)


def outcome_inputs(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    li = table(spark, sf, "lineitem")
    pid = F.concat(F.lit("CCC-"), F.col("o_custkey").cast("string"))
    keys = [F.col("o_custkey").alias("PatientPK"), pid.alias("PatientID"), F.col("c_nationkey").alias("SiteCode")]
    oc = o.join(c, o["o_custkey"] == c["c_custkey"])
    vd = F.to_date("o_orderdate")
    visits = oc.select(*keys, vd.alias("VisitDate"),
                       F.when(F.col("o_orderkey") % 11 == 0, F.lit(None))
                       .when(F.col("o_orderkey") % 13 == 0, F.date_add(vd, 500))
                       .otherwise(F.date_add(vd, (30 + F.col("o_orderkey") % 90).cast("int")))
                       .alias("NextAppointmentDate"))
    lines = li.join(oc.select("o_orderkey", "o_custkey", "c_nationkey"), li["l_orderkey"] == oc["o_orderkey"])
    sd = F.to_date("l_shipdate")
    dispenses = lines.select(*keys, sd.alias("DispenseDate"),
                             F.when(F.col("l_orderkey") % 11 == 0, F.lit(None))
                             .when(F.col("l_partkey") % 13 == 0, F.date_add(sd, 500))
                             .otherwise(F.date_add(sd, (20 + F.col("l_partkey") % 60).cast("int")))
                             .alias("ExpectedReturn"))
    ex = F.date_add(sd, 10)
    status = (lines.filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 48))
              .select(*keys, ex.alias("ExitDate"),
                      F.when(F.col("l_linestatus") == "F", F.lit("DIED")).otherwise(F.lit("LOST")).alias("ExitReason"),
                      F.when(F.col("l_discount") >= 0.05, F.date_add(ex, (40 * F.col("l_linenumber")).cast("int")))
                      .alias("EffectiveDiscontinuationDate")))
    art = c.select(F.col("c_custkey").alias("PatientPK"),
                   F.concat(F.lit("CCC-"), F.col("c_custkey").cast("string")).alias("PatientID"),
                   F.col("c_nationkey").alias("SiteCode"),
                   F.date_add(F.lit(dt.date(1995, 6, 1)), ((F.col("c_custkey") * 37) % 2000).cast("int"))
                   .alias("StartARTDate"))
    return visits, dispenses, status, art


_OUTCOME_ORACLE = """
WITH months AS (SELECT last_day(CAST(d AS DATE)) AS m FROM range(TIMESTAMP '1996-01-01', TIMESTAMP '2001-12-02', INTERVAL 1 MONTH) t(d)),
oc AS (SELECT o.*, c.c_nationkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
visits AS (SELECT o_custkey AS PatientPK, 'CCC-' || CAST(o_custkey AS VARCHAR) AS PatientID, c_nationkey AS SiteCode,
                  CAST(o_orderdate AS DATE) AS VisitDate,
                  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN CAST(o_orderdate AS DATE) + 500
                       ELSE CAST(o_orderdate AS DATE) + CAST(30 + o_orderkey % 90 AS INTEGER) END AS NextAppointmentDate
           FROM oc),
lines AS (SELECT l.*, oc.o_custkey, oc.c_nationkey FROM lineitem l JOIN oc ON l.l_orderkey = oc.o_orderkey),
disp AS (SELECT o_custkey AS PatientPK, 'CCC-' || CAST(o_custkey AS VARCHAR) AS PatientID, c_nationkey AS SiteCode,
                CAST(l_shipdate AS DATE) AS DispenseDate,
                CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_partkey % 13 = 0 THEN CAST(l_shipdate AS DATE) + 500
                     ELSE CAST(l_shipdate AS DATE) + CAST(20 + l_partkey % 60 AS INTEGER) END AS ExpectedReturn
         FROM lines),
status AS (SELECT o_custkey AS PatientPK, 'CCC-' || CAST(o_custkey AS VARCHAR) AS PatientID, c_nationkey AS SiteCode,
                  CAST(l_shipdate AS DATE) + 10 AS ExitDate,
                  CASE WHEN l_linestatus = 'F' THEN 'DIED' ELSE 'LOST' END AS ExitReason,
                  CASE WHEN l_discount >= 0.05 THEN CAST(l_shipdate AS DATE) + 10 + CAST(40 * l_linenumber AS INTEGER) END
                    AS EffectiveDiscontinuationDate
           FROM lines WHERE l_returnflag = 'R' AND l_quantity >= 48),
art AS (SELECT c_custkey AS PatientPK, 'CCC-' || CAST(c_custkey AS VARCHAR) AS PatientID, c_nationkey AS SiteCode,
               DATE '1995-06-01' + CAST((c_custkey * 37) % 2000 AS INTEGER) AS StartARTDate FROM customer),
spine AS (
  SELECT * FROM (SELECT PatientPK, PatientID, SiteCode FROM visits WHERE SiteCode > 0
                 UNION SELECT PatientPK, PatientID, SiteCode FROM disp WHERE SiteCode > 0) CROSS JOIN months),
vday AS (SELECT PatientPK, PatientID, SiteCode, VisitDate AS day, max(NextAppointmentDate) AS back FROM visits GROUP BY ALL),
dday AS (SELECT PatientPK, PatientID, SiteCode, DispenseDate AS day, max(ExpectedReturn) AS back FROM disp GROUP BY ALL),
xday AS (SELECT PatientPK, PatientID, SiteCode, ExitDate AS day, max(ExitReason) AS why FROM status GROUP BY ALL),
stop AS (SELECT PatientPK, PatientID, SiteCode,
                max(struct_pack(until := EffectiveDiscontinuationDate, day := ExitDate, why := ExitReason)) AS s
         FROM status WHERE ExitDate IS NOT NULL AND EffectiveDiscontinuationDate IS NOT NULL GROUP BY ALL),
met AS (
  SELECT p.*, greatest(v.day, d.day) AS seen, greatest(v.back, d.back) AS due, x.day AS left_day, x.why AS left_why
  FROM spine p
  ASOF LEFT JOIN vday v ON p.PatientPK = v.PatientPK AND p.PatientID = v.PatientID AND p.SiteCode = v.SiteCode AND p.m >= v.day
  ASOF LEFT JOIN dday d ON p.PatientPK = d.PatientPK AND p.PatientID = d.PatientID AND p.SiteCode = d.SiteCode AND p.m >= d.day
  ASOF LEFT JOIN xday x ON p.PatientPK = x.PatientPK AND p.PatientID = x.PatientID AND p.SiteCode = x.SiteCode AND p.m >= x.day),
late AS (SELECT *, m - if(due - m >= 365, seen + 30, due) AS days FROM met WHERE seen IS NOT NULL)
SELECT PatientID, PatientPK, upper(sha256(PatientID[:30])) AS PatientIDHash,
       upper(sha256(CAST(PatientPK AS VARCHAR))) AS PatientPKHash, SiteCode AS MFLCode,
       coalesce(if(s.why <> 'DIED' AND s.until > m, 'V', NULL), if(StartARTDate > m, 'NP', NULL),
                if(left_day IS NULL, NULL, left_why[:1]),
                if(days IS NULL, 'NV', if(days > 30, 'uL', 'V'))) AS ARTOutcome, m AS AsOfDate
FROM late LEFT JOIN stop USING (PatientPK, PatientID, SiteCode) LEFT JOIN art USING (PatientPK, PatientID, SiteCode)"""


@query("monthly_outcome", oracle=_OUTCOME_ORACLE)
def monthly_outcome(spark, sf):
    """Patient x month-end ART outcome over 72 months in one set-based job."""
    visits, dispenses, status, art = outcome_inputs(spark, sf)
    return monthly_outcomes(visits, dispenses, status, art, OUTCOME_START, OUTCOME_END)


@query("monthly_outcome_incremental", oracle=_OUTCOME_ORACLE)
def monthly_outcome_incremental(spark, sf):
    """The outcomes kept by batches: events up to mid-1998 first, then the later ones with a tenth of the
    early ones late, then everything again; the rows are those of the full job over all events."""
    from wardflow.plans.outcomes import MonthlyOutcomes
    from wardflow.session import scratch_path
    from wardflow.sources.sinks import snapshot
    days = ("VisitDate", "DispenseDate", "ExitDate", "StartARTDate")
    first = [(F.col(d) < dt.date(1998, 7, 1)) & (F.dayofmonth(d) % 10 != 3) for d in days]
    store = MonthlyOutcomes(spark, scratch_path(spark, "outcomes"), OUTCOME_START)
    with ExitStack() as kept:  # the joins that make the events run once for all batches
        inputs = [kept.enter_context(snapshot(df)) for df in outcome_inputs(spark, sf)]
        store.advance("first", *[df.where(f) for df, f in zip(inputs, first, strict=True)], dt.date(1998, 6, 30))
        store.advance("rest", *[df.where(~f) for df, f in zip(inputs, first, strict=True)], OUTCOME_END)
        store.advance("again", *inputs, OUTCOME_END)
    return store.read()


# =============================================================== date repair
_KIT_RAW_SQL = """CASE WHEN l_linenumber = 1 THEN 'n/a'
     WHEN l_linenumber % 2 = 0 THEN strftime(l_shipdate, '%Y-%m-%d')
     ELSE strftime(l_shipdate, '%d/%m/%Y') END"""


@query("repair_mixed_dates", oracle=f"""
WITH k AS (SELECT l_orderkey, l_linenumber, {_KIT_RAW_SQL} AS raw FROM lineitem),
fix AS (SELECT DISTINCT raw, CAST(coalesce(TRY_CAST(raw AS TIMESTAMP),
          CASE WHEN length(substring(raw, 7, 4)) = 4 THEN try_strptime(raw, '%d/%m/%Y') END) AS DATE) AS fixed
        FROM k WHERE raw IS NOT NULL)
SELECT k.l_orderkey, k.l_linenumber, k.raw, f.fixed AS TestKitExpiry
FROM k LEFT JOIN fix f ON k.raw = f.raw""")
def repair_mixed_dates(spark, sf):
    """Keyed in-place correction of text dates: fixes per distinct raw value, joined back."""
    li = table(spark, sf, "lineitem")
    raw = (F.when(F.col("l_linenumber") == 1, F.lit("n/a"))
           .when(F.col("l_linenumber") % 2 == 0, F.date_format("l_shipdate", "yyyy-MM-dd"))
           .otherwise(F.date_format("l_shipdate", "dd/MM/yyyy")))
    kits = li.select("l_orderkey", "l_linenumber", raw.alias("raw"), raw.alias("TestKitExpiry"))
    return repair_dates(kits, ["TestKitExpiry"])


# =============================================================== streaming
@query("streaming_incremental_events", oracle="""
SELECT DISTINCT event_id AS EventID, user_id AS UserID, ts AS EventTime,
       CASE WHEN (CASE WHEN event_id % 12 = 0 THEN 'N/A' ELSE event_type END) IN ('click', 'view') THEN 'Engagement'
            WHEN (CASE WHEN event_id % 12 = 0 THEN 'N/A' ELSE event_type END) = 'purchase' THEN 'Revenue'
            ELSE 'Not Done' END AS Kind
FROM events""")
def streaming_incremental_events(spark, sf):
    """The events load run as a Structured Streaming job: the extract lands as two file
    batches (before / from 2024-01-15), each micro-batch is diffed against the target
    written so far; the target read back holds every row exactly once."""
    from wardflow.session import scratch_path
    from wardflow.streaming.incremental import stream_load
    e = table(spark, sf, "events")
    extract = e.select(F.col("event_id").alias("EventID"), F.col("user_id").alias("UserID"),
                       F.col("ts").alias("EventTime"),
                       F.when(F.col("event_id") % 12 == 0, F.lit("N/A")).otherwise(F.col("event_type")).alias("Kind"))
    src, tgt = scratch_path(spark, "events-src"), scratch_path(spark, "events-tgt")
    ckpt = scratch_path(spark, "events-ckpt")
    cut = ntz(dt.datetime(2024, 1, 15))
    # first delivery, first run of the stream
    extract.filter(F.col("EventTime") < cut).write.parquet(f"{src}/delivery=1")
    stream_load(spark, EVENT_SPEC, src, tgt, AS_OF, checkpoint=ckpt).awaitTermination()
    # second delivery; the restarted stream only picks up the new files
    extract.filter(F.col("EventTime") >= cut).write.parquet(f"{src}/delivery=2")
    stream_load(spark, EVENT_SPEC, src, tgt, AS_OF, checkpoint=ckpt).awaitTermination()
    return spark.read.parquet(tgt)


# =============================================================== audit per rule
@query("load_audit_rules", oracle=f"""{_VISIT_ORACLE[:_VISIT_ORACLE.index("clean AS")].rstrip().rstrip(",")}
SELECT 'Priority blank' AS rule, count(*) FILTER (Priority = '') AS changed FROM scan
UNION ALL SELECT 'Status recode', count(*) FILTER (Status IN ('F', 'O')) FROM scan
UNION ALL SELECT 'VisitDate date', count(*) FILTER (VisitDate < DATE '1996-01-01' OR VisitDate > DATE '{AS_OF}') FROM scan
UNION ALL SELECT 'Priority lookup', count(*) FILTER (Priority <> '' AND Priority <> '5-LOW') FROM scan""")
def load_audit_rules(spark, sf):
    """The orders-as-visits load with the values that each rule and lookup changed, counted by its one action."""
    audit = RuleAudit()
    build_load(VISIT_SPEC, _visit_io(spark, sf), AS_OF, audit=audit).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(sorted(audit.counts.items()), "rule string, changed long")


# =============================================================== the visits job itself
# The real P23 spec on the test tables mapped into its source shape:
# PatientVisitExtract <- orders, PatientExtract <- customer, Facility <- nation,
# the existing CT_PatientVisits <- visits ordered before 1999.
def _p23_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p23_patient_visits"]
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    k = F.col("o_orderkey")
    vd = F.to_date("o_orderdate")
    form = o.select(
        k.alias("ID"), F.col("o_custkey").alias("PatientId"),
        F.concat(F.lit("V"), (k % 7).cast("string")).alias("VisitID"), vd.alias("VisitDate"),
        (k % 97 == 0).alias("voided"),
        (F.col("o_orderdate") + F.make_interval(hours=(k % 5).cast("int"))).alias("Created"),
        F.floor(F.col("o_totalprice") / 1000).cast("string").alias("Weight"),
        F.when(k % 9 == 0, F.lit("")).otherwise((k % 300).cast("string")).alias("Height"),
        F.when(F.col("o_orderstatus") == "F", F.lit("True")).when(F.col("o_orderstatus") == "O", F.lit("UNKNOWN"))
         .otherwise(F.lit("No")).alias("Pregnant"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Express"))
         .when(F.col("o_orderpriority") == "2-HIGH", F.lit("FADG"))
         .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("")).otherwise(F.col("o_orderpriority"))
         .alias("DifferentiatedCare"),
        F.when(k % 2 == 0, F.lit("Stable1")).otherwise(F.lit("Not Stable")).alias("StabilityAssessment"),
        F.date_sub(vd, 300).alias("OIDate"),
        F.date_add(vd, (k % 900).cast("int")).alias("NextAppointmentDate"),
        F.col("o_orderpriority").alias("FamilyPlanningMethod"), F.col("o_orderstatus").alias("PwP"))
    patient = c.select(
        F.col("c_custkey").alias("ID"), F.concat(F.lit("CCC"), F.col("c_custkey").cast("string")).alias("PatientCccNumber"),
        F.col("c_custkey").alias("PatientPID"),
        F.when(F.col("c_custkey") % 10 == 1, F.lit("Unknown")).otherwise(F.col("c_mktsegment")).alias("Gender"),
        F.col("c_nationkey").alias("FacilityId"), F.lit("KenyaEMR").alias("Emr"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("HMIS")).when(F.col("c_custkey") % 3 == 1, F.lit("I-TECH"))
         .otherwise(F.lit("Other")).alias("Project"))
    facility = n.select(F.col("n_nationkey").alias("Id"), (F.col("n_nationkey") * 100).alias("Code"),
                        F.col("n_name").alias("Name"), (F.col("n_regionkey") == 4).cast("int").alias("Voided"))
    fpm = (o.select(F.col("o_orderpriority").alias("source_name")).distinct()
           .filter(F.col("source_name") != "5-LOW").withColumn("target_name", F.lower("source_name")))
    pwp = (o.select(F.col("o_orderstatus").alias("source_name")).distinct()
           .withColumn("target_name", F.concat(F.lit("pwp-"), F.col("source_name"))))
    loaded = (o.filter(F.col("o_orderdate") < ntz(dt.datetime(1999, 1, 1)))
              .join(c, o["o_custkey"] == c["c_custkey"])
              .select(F.col("o_custkey").alias("PatientPK"), (F.col("c_nationkey") * 100).alias("SiteCode"),
                      F.concat(F.lit("V"), (F.col("o_orderkey") % 7).cast("string")).alias("VisitID")))
    io = FrameIO({"PatientVisitExtract": form, "PatientExtract": patient, "Facility": facility,
                  "lkp_family_planning_method": fpm, "lkp_pwp": pwp}, {spec.target: loaded})
    return spec, io


def _p23_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p23_patient_visits"]
    have = {"PatientID", "FacilityName", "SiteCode", "PatientPK", "VisitID", "VisitDate", "Pregnant", "Height",
            "Weight", "OIDate", "FamilyPlanningMethod", "PwP", "NextAppointmentDate", "Emr", "Project",
            "DifferentiatedCare", "StabilityAssessment", "voided"}
    final = ", ".join(c if c in have else f"CAST(NULL AS VARCHAR) AS {c}" for c in spec.columns)
    utf16 = "upper(sha256(unhex(regexp_replace(hex(substring(CAST({c} AS VARCHAR), 1, 36)), '(..)', '\\100', 'g'))))"
    return f"""
WITH form AS (
  SELECT o_orderkey AS ID, o_custkey AS PatientRef, 'V' || CAST(o_orderkey % 7 AS VARCHAR) AS VisitID,
         CAST(o_orderdate AS DATE) AS VisitDate, (o_orderkey % 97 = 0) AS voided,
         o_orderdate + to_hours(CAST(o_orderkey % 5 AS INTEGER)) AS Created,
         CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) AS Weight,
         CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE CAST(o_orderkey % 300 AS VARCHAR) END AS Height,
         CASE o_orderstatus WHEN 'F' THEN 'True' WHEN 'O' THEN 'UNKNOWN' ELSE 'No' END AS Pregnant,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Express' WHEN '2-HIGH' THEN 'FADG' WHEN '3-MEDIUM' THEN ''
              ELSE o_orderpriority END AS DifferentiatedCare,
         CASE WHEN o_orderkey % 2 = 0 THEN 'Stable1' ELSE 'Not Stable' END AS StabilityAssessment,
         CAST(o_orderdate AS DATE) - 300 AS OIDate,
         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 900 AS INTEGER) AS NextAppointmentDate,
         o_orderpriority AS FamilyPlanningMethod, o_orderstatus AS PwP
  FROM orders),
joined AS (
  SELECT f.*, 'CCC' || CAST(c.c_custkey AS VARCHAR) AS PatientID, c.c_custkey AS PatientPK,
         CASE WHEN c.c_custkey % 10 = 1 THEN 'Unknown' ELSE c.c_mktsegment END AS Gender,
         'KenyaEMR' AS Emr,
         CASE c.c_custkey % 3 WHEN 0 THEN 'HMIS' WHEN 1 THEN 'I-TECH' ELSE 'Other' END AS Project,
         n.n_nationkey * 100 AS SiteCode, n.n_name AS FacilityName
  FROM form f JOIN customer c ON f.PatientRef = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey AND NOT (n.n_regionkey = 4)),
latest AS (
  SELECT j.* FROM joined j JOIN (
    SELECT SiteCode, PatientPK, VisitID, VisitDate, voided, max(ID) AS mid, max(Created) AS mcr
    FROM joined GROUP BY SiteCode, PatientPK, VisitID, VisitDate, voided) t
  ON j.SiteCode = t.SiteCode AND j.PatientPK = t.PatientPK AND j.VisitID = t.VisitID
     AND j.VisitDate = t.VisitDate AND j.voided = t.voided AND j.ID = t.mid AND j.Created = t.mcr),
scan AS (
  SELECT DISTINCT PatientID, FacilityName, SiteCode, PatientPK, VisitID, VisitDate, Pregnant, Height, Weight, OIDate,
         FamilyPlanningMethod, PwP, NextAppointmentDate, Emr, Project, DifferentiatedCare, StabilityAssessment, voided
  FROM latest WHERE Gender <> 'Unknown' AND SiteCode > 0),
clean AS (
  SELECT PatientID, FacilityName, SiteCode, PatientPK, VisitID,
         CASE WHEN VisitDate < DATE '1980-01-01' OR VisitDate > DATE '2000-12-31' THEN DATE '1900-01-01' ELSE VisitDate END AS VisitDate,
         CASE WHEN Pregnant IN ('True', 'LIVE BIRTH') THEN 'Yes'
              WHEN Pregnant IN ('No - Miscarriage (mc)', 'No - Induced Abortion (ab)', 'RECENTLY MISCARRIAGED') THEN 'No'
              WHEN Pregnant IN ('UNKNOWN', '') THEN NULL ELSE Pregnant END AS Pregnant,
         CASE WHEN h = '' THEN NULL ELSE h END AS Height,
         CASE WHEN w = '' THEN NULL ELSE w END AS Weight,
         CASE WHEN OIDate < DATE '2000-01-01' OR OIDate > DATE '2000-12-31' THEN DATE '1900-01-01' ELSE OIDate END AS OIDate,
         FamilyPlanningMethod, PwP,
         CASE WHEN NextAppointmentDate < DATE '1980-01-01' OR NextAppointmentDate > DATE '2001-12-31'
              THEN DATE '1900-01-01' ELSE NextAppointmentDate END AS NextAppointmentDate,
         Emr,
         CASE WHEN Project IN ('I-TECH', 'HMIS') THEN 'Kenya HMIS II' ELSE Project END AS Project,
         CASE WHEN DifferentiatedCare = 'Express' THEN 'Fast Track'
              WHEN DifferentiatedCare = 'FADG' THEN 'Facility ART distribution Group'
              WHEN DifferentiatedCare = '' THEN NULL ELSE DifferentiatedCare END AS DifferentiatedCare,
         CASE WHEN StabilityAssessment = 'Stable1' THEN 'Stable' WHEN StabilityAssessment = 'Not Stable' THEN 'Unstable'
              WHEN StabilityAssessment = '' THEN NULL ELSE StabilityAssessment END AS StabilityAssessment,
         voided
  FROM (SELECT *,
          CASE WHEN TRY_CAST(Weight AS DOUBLE) < 0 OR TRY_CAST(Weight AS DOUBLE) > 200 THEN '999' ELSE Weight END AS w,
          CASE WHEN TRY_CAST(Height AS DOUBLE) < 0 OR TRY_CAST(Height AS DOUBLE) > 259 THEN '999' ELSE Height END AS h
        FROM scan) s),
std AS (
  SELECT c.* REPLACE (coalesce(a.t, c.FamilyPlanningMethod) AS FamilyPlanningMethod, coalesce(b.t, c.PwP) AS PwP)
  FROM clean c
  LEFT JOIN (SELECT source_name AS s, min(target_name) AS t FROM (SELECT DISTINCT o_orderpriority AS source_name,
             lower(o_orderpriority) AS target_name FROM orders WHERE o_orderpriority <> '5-LOW') GROUP BY source_name) a
    ON c.FamilyPlanningMethod = a.s
  LEFT JOIN (SELECT DISTINCT o_orderstatus AS s, 'pwp-' || o_orderstatus AS t FROM orders) b ON c.PwP = b.s),
tgt AS (
  SELECT o.o_custkey AS PatientPK, c.c_nationkey * 100 AS SiteCode, 'V' || CAST(o.o_orderkey % 7 AS VARCHAR) AS VisitID
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderdate < TIMESTAMP '1999-01-01')
SELECT {final}, {utf16.format(c='PatientID')} AS PatientIDHash, {utf16.format(c='PatientPK')} AS PatientPKHash
FROM std s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.PatientPK IS NOT DISTINCT FROM s.PatientPK
  AND t.SiteCode IS NOT DISTINCT FROM s.SiteCode AND t.VisitID IS NOT DISTINCT FROM s.VisitID)"""


@query("load_patient_visits", oracle=_p23_oracle())
def load_patient_visits(spark, sf):
    """The patient-visits load spec (P23) end to end on the test tables: latest rule over the
    patient/facility join, gender and facility-code filters, DISTINCT, the visit cleaning rules,
    two lookups, delta against the loaded visits, digests."""
    spec, io = _p23_io(spark, sf)
    return _load(spec, io)


# =============================================================== the HTS client-tests job
# HtsClientTests <- lineitem (patient = order, site = supplier % 10 + 1),
# Clients <- orders, the existing HTS_ClientTests <- lines shipped before 1998.
_P26_FEED = Feed(
    "p26_client_tests", "l_orderkey + l_linenumber",
    "SiteCode,PatientPk,EncounterId,TestDate,FinalTestResult,EntryPoint,TestStrategy,TestResult1,TestResult2,"
    "ClientTestedAs,TbScreening,MonthsSinceLastTest",
    made={
        "ClientSelfTested": ("CASE l_partkey % 6 WHEN 0 THEN '1' WHEN 1 THEN 'Yes' WHEN 2 THEN '0' WHEN 3 THEN 'NA' "
                             "WHEN 4 THEN 'maybe' END",
                             "CASE WHEN ClientSelfTested IN ('1', 'Yes') THEN 'Yes' WHEN ClientSelfTested IN ('0', 'No') "
                             "THEN 'No' WHEN ClientSelfTested = 'NA' THEN 'NA' END"),
        "CoupleDiscordant": ("CASE l_partkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'NA' WHEN 3 THEN '' END",
                             "CASE WHEN CoupleDiscordant IN ('Yes', 'No') THEN CoupleDiscordant END"),
        "TestType": ("CASE l_suppkey % 6 WHEN 0 THEN 'Initial' WHEN 1 THEN 'Initial Test' WHEN 2 THEN 'Repeat' "
                     "WHEN 3 THEN 'Retest' WHEN 4 THEN 'Other' END",
                     "CASE WHEN TestType IN ('Initial', 'Initial Test') THEN 'Initial Test' "
                     "WHEN TestType IN ('Repeat', 'Repeat Test') THEN 'Repeat Test' WHEN TestType = 'Retest' THEN 'Retest' END"),
        "Consent": ("CASE l_partkey % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'NULL' END",
                    "CASE WHEN Consent IN ('Yes', 'No') THEN Consent END"),
        "Setting": ("CASE l_partkey % 7 WHEN 0 THEN 'Tent' WHEN 1 THEN 'Facility' WHEN 2 THEN 'Medical Camp' "
                    "WHEN 3 THEN 'Community' WHEN 4 THEN 'Bus' END",
                    "CASE WHEN Setting IN ('Facility', 'Tent') THEN 'Facility' "
                    "WHEN Setting IN ('Community', 'Medical Camp') THEN 'Community' END"),
        "Approach": ("CASE l_suppkey % 5 WHEN 0 THEN 'CITC' WHEN 1 THEN 'PITC' WHEN 2 THEN 'Client Initiated Testing (CITC)' "
                     "WHEN 3 THEN 'none' END",
                     "CASE WHEN Approach IN ('CITC', 'Client Initiated Testing (CITC)') THEN 'Client Initiated Testing (CITC)' "
                     "WHEN Approach IN ('PITC', 'Provider Initiated Testing(PITC)') THEN 'Provider Initiated Testing(PITC)' END"),
    })


def _p26_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p26_client_tests"]
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    ln = F.col("l_linenumber")
    form = li.select(
        (F.col("l_orderkey") * 10 + ln).alias("ID"), (F.col("l_suppkey") % 10 + 1).cast("int").alias("SiteCode"),
        F.col("l_orderkey").alias("PatientPk"),
        F.when(ln == 1, F.lit(None)).otherwise(ln).alias("EncounterId"),
        F.to_date("l_shipdate").alias("TestDate"),
        F.when(F.col("l_returnflag") == "R", F.lit("Positive")).when(F.col("l_returnflag") == "A", F.lit("Negative"))
         .alias("FinalTestResult"),
        F.date_add(F.to_date("l_shipdate"), (F.col("l_partkey") % 3).cast("int")).alias("DateExtracted"),
        F.col("l_linestatus").alias("EntryPoint"),
        F.when(F.col("l_tax") > 0.05, F.lit("HP")).alias("TestStrategy"),
        F.when(F.col("l_discount") > 0.05, F.lit("Positive")).alias("TestResult1"),
        F.when(ln % 4 != 0, F.lit("Negative")).alias("TestResult2"),
        F.when(ln % 3 == 0, F.lit("Couple")).when(ln % 3 == 1, F.lit("I: Individual")).otherwise(F.lit("x"))
         .alias("ClientTestedAs"),
        F.when(F.col("l_partkey") % 4 == 0, F.lit("TB Rx")).when(F.col("l_partkey") % 4 == 1, F.lit("Yes"))
         .otherwise(F.lit("zzz")).alias("TbScreening"),
        (F.col("l_quantity") * 40).cast("int").cast("string").alias("MonthsSinceLastTest"), *_P26_FEED.columns())
    clients = o.select(F.col("o_orderkey").alias("PatientPk"),
                       (F.col("o_custkey") % 10 + 1).cast("int").alias("SiteCode"))
    src_lkp = li.filter(F.col("l_linestatus") == "F").select(
        F.col("l_linestatus").alias("source_name"), F.lit("OPD").alias("target_name")).distinct()
    strat = li.filter(F.col("l_tax") > 0.05).select(
        F.lit("HP").alias("Source_htsStrategy"), F.lit("Home Based").alias("Target_htsStrategy")).distinct()
    loaded = li.filter(F.col("l_shipdate") < ntz(dt.datetime(1998, 1, 1))).select(
        F.col("l_orderkey").alias("PatientPk"), (F.col("l_suppkey") % 10 + 1).cast("int").alias("SiteCode"),
        F.coalesce(F.when(ln == 1, F.lit(None)).otherwise(ln), F.lit(-1)).alias("EncounterId"))
    io = FrameIO({"HtsClientTests": form, "Clients": clients, "lkp_patient_source": src_lkp,
                  "lkp_htsStrategy": strat}, {spec.target: loaded})
    return spec, io


def _p26_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p26_client_tests"]
    final = ", ".join(spec.columns)
    utf16 = "upper(sha256(unhex(regexp_replace(hex(substring(CAST({c} AS VARCHAR), 1, 36)), '(..)', '\\100', 'g'))))"
    return f"""
WITH a AS (
  SELECT l_orderkey * 10 + l_linenumber AS ID, CAST(l_suppkey % 10 + 1 AS INTEGER) AS SiteCode,
         l_orderkey AS PatientPk, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_linenumber END AS EncounterId,
         CAST(l_shipdate AS DATE) AS TestDate,
         CASE l_returnflag WHEN 'R' THEN 'Positive' WHEN 'A' THEN 'Negative' END AS FinalTestResult,
         CAST(l_shipdate AS DATE) + CAST(l_partkey % 3 AS INTEGER) AS DateExtracted,
         l_linestatus AS EntryPoint, CASE WHEN l_tax > 0.05 THEN 'HP' END AS TestStrategy,
         CASE WHEN l_discount > 0.05 THEN 'Positive' END AS TestResult1, CASE WHEN l_linenumber % 4 <> 0 THEN 'Negative' END AS TestResult2,
         CASE l_linenumber % 3 WHEN 0 THEN 'Couple' WHEN 1 THEN 'I: Individual' ELSE 'x' END AS ClientTestedAs,
         CASE l_partkey % 4 WHEN 0 THEN 'TB Rx' WHEN 1 THEN 'Yes' ELSE 'zzz' END AS TbScreening,
         CAST(CAST(l_quantity * 40 AS INTEGER) AS VARCHAR) AS MonthsSinceLastTest,
         {_P26_FEED.form_sql}
  FROM lineitem),
tn AS (SELECT SiteCode, PatientPk, FinalTestResult, TestDate, EncounterId, max(ID) AS MaxID,
              max(CAST(DateExtracted AS DATE)) AS MaxDateExtracted
       FROM a GROUP BY SiteCode, PatientPk, FinalTestResult, TestDate, EncounterId),
scan AS (
  SELECT DISTINCT a.SiteCode, a.PatientPk, coalesce(a.EncounterId, -1) AS EncounterId, a.TestDate,
         a.MonthsSinceLastTest, a.ClientTestedAs, a.EntryPoint, a.TestStrategy,
         coalesce(a.TestResult1, 'empty') AS TestResult1, coalesce(a.TestResult2, 'empty') AS TestResult2,
         a.FinalTestResult, a.TbScreening, {_P26_FEED.names('a.')}
  FROM a JOIN tn ON a.SiteCode = tn.SiteCode AND a.PatientPk = tn.PatientPk
    AND CAST(a.DateExtracted AS DATE) = tn.MaxDateExtracted AND a.FinalTestResult = tn.FinalTestResult
    AND a.TestDate = tn.TestDate AND coalesce(a.EncounterId, -1) = coalesce(tn.EncounterId, -1) AND a.ID = tn.MaxID
  WHERE a.FinalTestResult IS NOT NULL
    AND EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = a.PatientPk
                AND CAST(o.o_custkey % 10 + 1 AS INTEGER) = a.SiteCode)),
clean AS (
  SELECT SiteCode, PatientPk, EncounterId, TestDate,
         CASE WHEN TRY_CAST(MonthsSinceLastTest AS DOUBLE) > 1540 THEN NULL ELSE MonthsSinceLastTest END
           AS MonthsSinceLastTest,
         CASE WHEN ClientTestedAs IN ('C: Couple (includes polygamous)', 'Couple') THEN 'Couple'
              WHEN ClientTestedAs IN ('I: Individual', 'Individual') THEN 'Individual' END AS ClientTestedAs,
         coalesce(l.target_name, s.EntryPoint, 'Empty') AS EntryPoint,
         coalesce(h.Target_htsStrategy, s.TestStrategy, 'Empty') AS TestStrategy,
         TestResult1, TestResult2, FinalTestResult,
         CASE WHEN TbScreening IN ('No Signs', 'No TB', 'No TB signs', 'Yes') THEN 'No Signs'
              WHEN TbScreening IN ('On TB Treatment', 'INH', 'TB Rx', 'TBRx') THEN 'On TB Treatment'
              WHEN TbScreening IN ('Presumed TB', 'PrTB') THEN 'Presumed TB'
              WHEN TbScreening = 'TB Confirmed' THEN 'TB Confirmed' ELSE 'Not Done' END AS TbScreening,
         {_P26_FEED.rule_sql}
  FROM scan s
  LEFT JOIN (SELECT DISTINCT l_linestatus AS source_name, 'OPD' AS target_name FROM lineitem
             WHERE l_linestatus = 'F') l ON s.EntryPoint = l.source_name
  LEFT JOIN (SELECT DISTINCT 'HP' AS Source_htsStrategy, 'Home Based' AS Target_htsStrategy FROM lineitem
             WHERE l_tax > 0.05) h ON s.TestStrategy = h.Source_htsStrategy),
tgt AS (SELECT l_orderkey AS PatientPk, CAST(l_suppkey % 10 + 1 AS INTEGER) AS SiteCode,
               coalesce(CASE WHEN l_linenumber = 1 THEN NULL ELSE l_linenumber END, -1) AS EncounterId
        FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01')
SELECT {final}, {utf16.format(c='PatientPk')} AS PatientPKHash
FROM clean c WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.PatientPk IS NOT DISTINCT FROM c.PatientPk
  AND t.SiteCode IS NOT DISTINCT FROM c.SiteCode AND t.EncounterId IS NOT DISTINCT FROM c.EncounterId)"""


@query("load_hts_client_tests", oracle=_p26_oracle())
def load_hts_client_tests(spark, sf):
    """The HTS client-tests load spec (P26) end to end on the test tables: latest rule with a
    NULL-sentinel encounter key, client existence, closed-vocabulary recodes, lookups with an
    'Empty' default, months cap, delta on (patient, site, encounter), digest."""
    spec, io = _p26_io(spark, sf)
    return build_load(spec, io, AS_OF)


# =============================================================== the PrEP visits job
# PrepVisits <- events (patient = user, site = event % 3 + 1); the existing
# PrEP_Visits <- events before 2024-01-10.
_P51_FEED = Feed(
    "p51_visits", "event_id",
    "Created,PatientPk,SiteCode,DateExtracted,VisitID,VisitDate,NextAppointment,MonthsPrescribed,BMI,ClinicalNotes,"
    "PrepNumber,Emr,FacilityName",
    blank="TreatedForHepC,VaccinationForHepCStarted,VaccinationForHepBStarted,HepatitisCPositiveResult,"
          "HepatitisBPositiveResult,Reasonfornotgivingnextappointment,Tobegivennextappointment,CondomsIssued,"
          "RegimenPrescribed,PrepPrescribed,PrepTreatmentPlan,ContraindicationsPrep,SymptomsAcuteHIV,AdherenceReasons,"
          "AdherenceOutcome,AdherenceDone,FPMethods,FamilyPlanningStatus,Breastfeeding,BirthDefects,PregnancyOutcome,"
          "PregnancyEndDate,PregnancyEnded,PregnancyPlanned,PlanningToGetPregnant,EDD,PregnantAtThisVisit,"
          "MenopausalStatus,LMP,VMMCReferral,Circumcised,STITreated,STISymptoms,STIScreening,Height,Weight,"
          "BloodPressure,TreatedForHepB")


def _p51_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p51_visits"]
    e = table(spark, sf, "events")
    eid = F.col("event_id")
    site = (eid % 3 + 1).cast("int")
    form = e.select(
        eid.alias("ID"), F.col("user_id").alias("PatientPk"), site.alias("SiteCode"),
        F.col("ts").alias("Created"),
        F.date_add(F.to_date("ts"), (eid % 4).cast("int")).alias("DateExtracted"),
        F.concat(F.lit("PV"), (eid % 13).cast("string")).alias("VisitID"),
        F.when(eid % 10 == 0, F.lit("")).when(eid % 10 == 1, F.lit("1975-06-01"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("VisitDate"),
        F.when(eid % 7 == 0, F.lit("")).otherwise(F.date_format(F.date_add(F.to_date("ts"), 30), "yyyy-MM-dd"))
         .alias("NextAppointment"),
        (eid % 20).cast("string").alias("MonthsPrescribed"),
        F.when(eid % 5 == 0, F.lit("")).otherwise((eid % 40).cast("string")).alias("BMI"),
        F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("event_type")).alias("ClinicalNotes"),
        F.concat(F.lit("PREP-"), F.col("user_id").cast("string")).alias("PrepNumber"),
        F.lit("KenyaEMR").alias("Emr"), F.concat(F.lit("Site "), site.cast("string")).alias("FacilityName"),
        *_P51_FEED.columns())
    loaded = e.filter(F.col("ts") < ntz(dt.datetime(2024, 1, 10))).select(
        F.col("user_id").alias("PatientPk"), site.alias("SiteCode"),
        F.concat(F.lit("PV"), (eid % 13).cast("string")).alias("VisitID"))
    return spec, FrameIO({"PrepVisits": form}, {spec.target: loaded})


def _p51_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p51_visits"]
    final = ", ".join(spec.columns)
    utf16 = "upper(sha256(unhex(regexp_replace(hex(substring(CAST({c} AS VARCHAR), 1, 36)), '(..)', '\\100', 'g'))))"
    return f"""
WITH a AS (
  SELECT event_id AS ID, user_id AS PatientPk, CAST(event_id % 3 + 1 AS INTEGER) AS SiteCode, ts AS Created,
         CAST(ts AS DATE) + CAST(event_id % 4 AS INTEGER) AS DateExtracted,
         'PV' || CAST(event_id % 13 AS VARCHAR) AS VisitID,
         CASE event_id % 10 WHEN 0 THEN '' WHEN 1 THEN '1975-06-01' ELSE strftime(ts, '%Y-%m-%d') END AS VisitDate,
         CASE WHEN event_id % 7 = 0 THEN '' ELSE strftime(CAST(ts AS DATE) + 30, '%Y-%m-%d') END AS NextAppointment,
         CAST(event_id % 20 AS VARCHAR) AS MonthsPrescribed,
         CASE WHEN event_id % 5 = 0 THEN '' ELSE CAST(event_id % 40 AS VARCHAR) END AS BMI,
         CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS ClinicalNotes,
         'PREP-' || CAST(user_id AS VARCHAR) AS PrepNumber, 'KenyaEMR' AS Emr,
         'Site ' || CAST(event_id % 3 + 1 AS VARCHAR) AS FacilityName, {_P51_FEED.form_sql}
  FROM events),
tn AS (SELECT PatientPk, SiteCode, max(ID) AS MaxID, max(CAST(Created AS DATE)) AS MaxCreated FROM a
       GROUP BY PatientPk, SiteCode),
tm AS (SELECT PatientPk, SiteCode, max(ID) AS MaxID, max(CAST(DateExtracted AS DATE)) AS MaxExtracted FROM a
       GROUP BY PatientPk, SiteCode),
scan AS (
  SELECT DISTINCT a.Created, a.PatientPk, a.SiteCode, a.Emr, a.DateExtracted, a.FacilityName, a.PrepNumber,
         a.VisitDate, a.VisitID, a.BMI, a.MonthsPrescribed, a.NextAppointment, a.ClinicalNotes, {_P51_FEED.names('a.')}
  FROM a JOIN tn ON a.PatientPk = tn.PatientPk AND a.SiteCode = tn.SiteCode
                AND CAST(a.Created AS DATE) = tn.MaxCreated AND a.ID = tn.MaxID
         JOIN tm ON a.PatientPk = tm.PatientPk AND a.SiteCode = tm.SiteCode
                AND CAST(a.DateExtracted AS DATE) = tm.MaxExtracted AND a.ID = tm.MaxID),
clean AS (
  SELECT Created, PatientPk, SiteCode, Emr, DateExtracted, FacilityName, PrepNumber,
         CASE WHEN VisitDate = '' OR TRY_CAST(VisitDate AS DATE) < DATE '1980-01-01' THEN NULL ELSE VisitDate END
           AS VisitDate,
         VisitID,
         CASE WHEN BMI = '' THEN NULL ELSE BMI END AS BMI,
         CASE WHEN TRY_CAST(MonthsPrescribed AS DOUBLE) > 12 THEN NULL ELSE MonthsPrescribed END AS MonthsPrescribed,
         CASE WHEN NextAppointment = '' OR TRY_CAST(NextAppointment AS DATE) < DATE '1980-01-01' THEN NULL
              ELSE NextAppointment END AS NextAppointment,
         CASE WHEN ClinicalNotes = '' THEN NULL ELSE ClinicalNotes END AS ClinicalNotes, {_P51_FEED.rule_sql}
  FROM scan),
tgt AS (SELECT user_id AS PatientPk, CAST(event_id % 3 + 1 AS INTEGER) AS SiteCode,
               'PV' || CAST(event_id % 13 AS VARCHAR) AS VisitID FROM events WHERE ts < TIMESTAMP '2024-01-10')
SELECT {final}, {utf16.format(c='PrepNumber')} AS PrepNumberHash, {utf16.format(c='PatientPk')} AS PatientPKHash
FROM clean c WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.PatientPk IS NOT DISTINCT FROM c.PatientPk
  AND t.SiteCode IS NOT DISTINCT FROM c.SiteCode AND t.VisitID IS NOT DISTINCT FROM c.VisitID)"""


@query("load_prep_visits", oracle=_p51_oracle())
def load_prep_visits(spark, sf):
    """The PrEP visits load spec (P51) end to end on the test tables: two latest rules ANDed
    (creation day and extraction day), blank -> NULL, text dates before 1980 -> NULL, months cap,
    delta on (patient, site, visit), digests."""
    spec, io = _p51_io(spark, sf)
    return build_load(spec, io, AS_OF)


# =============================================================== the patient-status job
# patientstatusextract <- lineitem (patient = part, exit ten years after shipping),
# PatientExtract <- customer, Facility <- nation, existing CT_PatientStatus <- lines shipped
# before 1998.  Load date 2008-12-31, so exits after it are cleaned to 1900-01-01.
P22_AS_OF = dt.date(2008, 12, 31)


def _p22_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p22_patient_status"]
    li = table(spark, sf, "lineitem")
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    exit_day = F.date_add(F.to_date("l_shipdate"), 3650)
    form = li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ID"), F.col("l_partkey").alias("PatientId"),
        exit_day.alias("ExitDate"),
        F.when(F.col("l_linestatus") == "F", F.lit("DIED")).otherwise(F.lit("LTFU")).alias("ExitReason"),
        (F.col("l_linenumber") == 7).alias("voided"),
        (F.col("l_shipdate") + F.make_interval(days=(F.col("l_orderkey") % 3).cast("int"))).alias("Created"),
        F.date_add(exit_day, 30).alias("EffectiveDiscontinuationDate"),
        (F.col("l_shipdate") + F.make_interval(hours=F.lit(5))).alias("DeathDate"))
    patient = c.select(
        F.col("c_custkey").alias("ID"), F.concat(F.lit("CCC"), F.col("c_custkey").cast("string")).alias("PatientCccNumber"),
        F.col("c_custkey").alias("PatientPID"), F.col("c_mktsegment").alias("Gender"),
        F.col("c_nationkey").alias("FacilityId"),
        F.when(F.col("c_custkey") % 4 == 0, F.lit("Ampath AMRS")).otherwise(F.lit("KenyaEMR")).alias("Emr"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit("HMIS")).when(F.col("c_custkey") % 5 == 1, F.lit("Ampathplus"))
         .when(F.col("c_custkey") % 5 == 2, F.lit("IRDO")).otherwise(F.lit("Other")).alias("Project"))
    facility = n.select(F.col("n_nationkey").alias("Id"), (F.col("n_nationkey") * 100).alias("Code"),
                        F.col("n_name").alias("Name"), F.lit(0).alias("Voided"))
    loaded = (li.filter(F.col("l_shipdate") < ntz(dt.datetime(1998, 1, 1)))
              .join(c, F.col("l_partkey") == F.col("c_custkey"))
              .select((F.col("c_nationkey") * 100).alias("SiteCode"), F.col("c_custkey").alias("PatientPK"),
                      F.date_add(F.to_date("l_shipdate"), 3650).alias("ExitDate")))
    io = FrameIO({"PatientStatusExtract": form, "PatientExtract": patient, "Facility": facility},
                 {spec.target: loaded})
    return spec, io


def _p22_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p22_patient_status"]
    have = {"PatientID", "SiteCode", "FacilityName", "ExitDate", "ExitReason", "PatientPK", "Emr", "Project",
            "EffectiveDiscontinuationDate", "voided", "DeathDate"}
    final = ", ".join(c if c in have else f"CAST(NULL AS VARCHAR) AS {c}" for c in spec.columns)
    utf16 = "upper(sha256(unhex(regexp_replace(hex(substring(CAST({c} AS VARCHAR), 1, 36)), '(..)', '\\100', 'g'))))"
    return f"""
WITH ps AS (
  SELECT l_orderkey * 10 + l_linenumber AS ID, l_partkey AS PatientRef,
         CAST(l_shipdate AS DATE) + 3650 AS ExitDate,
         CASE WHEN l_linestatus = 'F' THEN 'DIED' ELSE 'LTFU' END AS ExitReason,
         (l_linenumber = 7) AS voided, l_shipdate + to_days(CAST(l_orderkey % 3 AS INTEGER)) AS Created,
         CAST(l_shipdate AS DATE) + 3680 AS EffectiveDiscontinuationDate, CAST(l_shipdate AS DATE) AS DeathDate
  FROM lineitem),
j AS (
  SELECT ps.*, 'CCC' || CAST(c.c_custkey AS VARCHAR) AS PatientID, c.c_custkey AS PatientPK,
         c.c_mktsegment AS Gender,
         CASE WHEN c.c_custkey % 4 = 0 THEN 'Ampath AMRS' ELSE 'KenyaEMR' END AS Emr,
         CASE c.c_custkey % 5 WHEN 0 THEN 'HMIS' WHEN 1 THEN 'Ampathplus' WHEN 2 THEN 'IRDO' ELSE 'Other' END AS Project,
         n.n_nationkey * 100 AS SiteCode, n.n_name AS FacilityName
  FROM ps JOIN customer c ON ps.PatientRef = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
tn AS (SELECT PatientPK, SiteCode, ExitDate, voided, max(ID) AS Max_ID, max(CAST(Created AS DATE)) AS MaxCreated
       FROM j GROUP BY PatientPK, SiteCode, ExitDate, voided),
scan AS (
  SELECT DISTINCT j.PatientID, j.SiteCode, j.FacilityName, j.ExitDate, j.ExitReason, j.PatientPK, j.Emr, j.Project,
         j.EffectiveDiscontinuationDate, j.voided, j.DeathDate
  FROM j JOIN tn ON j.PatientPK = tn.PatientPK AND j.SiteCode = tn.SiteCode AND j.ExitDate = tn.ExitDate
                AND CAST(j.Created AS DATE) = tn.MaxCreated AND j.ID = tn.Max_ID
  WHERE j.Gender <> 'Unknown' AND j.SiteCode > 0),
clean AS (
  SELECT PatientID, SiteCode, FacilityName,
         CASE WHEN ExitDate < DATE '2004-01-01' OR ExitDate > DATE '2008-12-31' THEN DATE '1900-01-01' ELSE ExitDate END
           AS ExitDate,
         ExitReason, PatientPK,
         CASE WHEN Emr = 'Ampath AMRS' THEN 'AMRS' ELSE Emr END AS Emr,
         CASE WHEN p0 = 'Ampathplus' THEN 'Ampath Plus'
              WHEN p0 IN ('UCSF Clinical Kisumu', 'CHAP Uzima', 'DREAM Kenya Trusts', 'IRDO') THEN 'Kenya HMIS II'
              ELSE p0 END AS Project,
         EffectiveDiscontinuationDate, voided, DeathDate
  FROM (SELECT *, CASE WHEN Project IN ('I-TECH', 'HMIS') THEN 'Kenya HMIS II' ELSE Project END AS p0 FROM scan) s),
tgt AS (SELECT c.c_nationkey * 100 AS SiteCode, c.c_custkey AS PatientPK, CAST(l.l_shipdate AS DATE) + 3650 AS ExitDate
        FROM lineitem l JOIN customer c ON l.l_partkey = c.c_custkey
        WHERE l.l_shipdate < TIMESTAMP '1998-01-01')
SELECT {final}, {utf16.format(c='PatientID')} AS PatientIDHash, {utf16.format(c='PatientPK')} AS PatientPKHash
FROM clean x WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.SiteCode IS NOT DISTINCT FROM x.SiteCode
  AND t.PatientPK IS NOT DISTINCT FROM x.PatientPK AND t.ExitDate IS NOT DISTINCT FROM CAST(x.ExitDate AS DATE))"""


@query("load_patient_status", oracle=_p22_oracle())
def load_patient_status(spark, sf):
    """The patient-status load spec (P22) end to end on the test tables: latest rule grouped with
    the voided flag but joined without it, exit-date window, EMR / project recodes, delta keyed
    on the exit day."""
    spec, io = _p22_io(spark, sf)
    return _load(spec, io, P22_AS_OF)


# =============================================================== the mother-baby pairs job
# MotherBabyPairs <- orders (mother = customer, baby = order, site = customer % 10 + 1,
# facility = nation), Facilities <- nation, existing MNCH_MotherBabyPairs <- orders before 1995-04.
def _p42_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p42_mother_baby_pairs"]
    o = table(spark, sf, "orders")
    n = table(spark, sf, "nation")
    ck = F.col("o_custkey")
    form = o.select(
        F.col("o_orderkey").alias("ID"), ck.alias("PatientPk"), (ck % 10 + 1).cast("int").alias("SiteCode"),
        (ck % 25).cast("int").alias("FacilityId"),
        F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 11).cast("int")).alias("DateExtracted"),
        F.concat(F.lit("CCC"), ck.cast("string")).alias("PatientIDCCC"), F.col("o_orderkey").alias("BabyPatientPK"),
        ck.alias("MotherPatientPK"), F.concat(F.lit("HEI"), F.col("o_orderkey").cast("string")).alias("BabyPatientMncHeiID"),
        F.concat(F.lit("M"), ck.cast("string")).alias("MotherPatientMncHeiID"), F.lit("KenyaEMR").alias("EMR"),
        F.col("o_orderpriority").alias("Project"), F.col("o_orderdate").alias("Date_Last_Modified"),
        F.concat(F.lit("u"), F.col("o_orderkey").cast("string")).alias("RecordUUID"))
    facilities = n.select(F.col("n_nationkey").alias("Id"), F.col("n_name").alias("Name"))
    loaded = o.filter(F.col("o_orderdate") < ntz(dt.datetime(1995, 4, 1))).select(
        ck.alias("PatientPk"), (ck % 10 + 1).cast("int").alias("SiteCode"))
    return spec, FrameIO({"MotherBabyPairs": form, "Facilities": facilities}, {spec.target: loaded})


def _p42_oracle() -> str:
    utf16 = "upper(sha256(unhex(regexp_replace(hex(substring(CAST({c} AS VARCHAR), 1, 36)), '(..)', '\\100', 'g'))))"
    return f"""
WITH p AS (
  SELECT o_orderkey AS ID, o_custkey AS PatientPk, CAST(o_custkey % 10 + 1 AS INTEGER) AS SiteCode,
         CAST(o_custkey % 25 AS INTEGER) AS FacilityId,
         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 11 AS INTEGER) AS DateExtracted,
         'CCC' || CAST(o_custkey AS VARCHAR) AS PatientIDCCC, o_orderkey AS BabyPatientPK, o_custkey AS MotherPatientPK,
         'HEI' || CAST(o_orderkey AS VARCHAR) AS BabyPatientMncHeiID, 'M' || CAST(o_custkey AS VARCHAR) AS MotherPatientMncHeiID,
         'KenyaEMR' AS EMR, o_orderpriority AS Project, o_orderdate AS Date_Last_Modified,
         'u' || CAST(o_orderkey AS VARCHAR) AS RecordUUID
  FROM orders),
tm AS (SELECT PatientPk, SiteCode, max(ID) AS MaxID, max(CAST(DateExtracted AS DATE)) AS MaxDateExtracted
       FROM p GROUP BY PatientPk, SiteCode),
scan AS (
  SELECT DISTINCT p.PatientIDCCC, p.PatientPk, p.BabyPatientPK, p.MotherPatientPK, p.BabyPatientMncHeiID,
         p.MotherPatientMncHeiID, p.SiteCode, f.n_name AS FacilityName, p.EMR, p.Project, p.Date_Last_Modified,
         p.RecordUUID
  FROM p JOIN tm ON p.PatientPk = tm.PatientPk AND p.SiteCode = tm.SiteCode
                AND CAST(p.DateExtracted AS DATE) = tm.MaxDateExtracted AND p.ID = tm.MaxID
  JOIN nation f ON p.FacilityId = f.n_nationkey),
tgt AS (SELECT o_custkey AS PatientPk, CAST(o_custkey % 10 + 1 AS INTEGER) AS SiteCode FROM orders
        WHERE o_orderdate < TIMESTAMP '1995-04-01')
SELECT s.*, {utf16.format(c='MotherPatientMncHeiID')} AS MotherPatientMncHeiIDHash,
       {utf16.format(c='PatientPk')} AS PatientPKHash, {utf16.format(c='MotherPatientPK')} AS MotherPatientPKHash,
       {utf16.format(c='BabyPatientPK')} AS BabyPatientPKHash
FROM scan s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.PatientPk IS NOT DISTINCT FROM s.PatientPk
  AND t.SiteCode IS NOT DISTINCT FROM s.SiteCode)"""


@query("load_mother_baby_pairs", oracle=_p42_oracle())
def load_mother_baby_pairs(spark, sf):
    """The mother-baby pairs load spec (P42) end to end on the test tables: latest rule over the
    form alone, facility name from the facility table, delta on (patient, site), four digests."""
    spec, io = _p42_io(spark, sf)
    return _load(spec, io)


# =============================================================== the HTS linkages job (P25)
# ClientLinkages <- orders (extraction 8 800 days after the order, so the 2019-09-08
# cut-off splits it), Clients <- customers with a positive balance, existing
# HTS_ClientLinkages <- orders before 1995-04.
def _p25_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p25_client_linkages"]
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    od = F.to_date("o_orderdate")
    form = o.select(
        k.alias("ID"), (ck % 10 + 1).cast("int").alias("SiteCode"), ck.alias("PatientPk"),
        F.concat(F.lit("H"), ck.cast("string")).alias("HtsNumber"), F.lit("IQCare").alias("Emr"),
        F.col("o_orderstatus").alias("Project"), F.concat(F.lit("F"), (ck % 10 + 1).cast("string")).alias("FacilityName"),
        (F.col("o_orderdate") + F.expr("INTERVAL 8800 DAYS")).alias("DateExtracted"),
        F.col("o_orderpriority").alias("EnrolledFacilityName"),
        F.when(k % 17 == 0, F.lit(dt.date(1975, 1, 1))).otherwise(F.date_sub(od, (k % 400).cast("int")))
         .alias("ReferralDate"),
        (F.col("o_orderdate") + F.make_interval(days=(k % 30).cast("int"))).alias("DateEnrolled"),
        F.date_add(od, 7).alias("DatePrefferedToBeEnrolled"),
        F.when(k % 4 == 0, F.lit("Other Facility")).otherwise(F.lit("KNH")).alias("FacilityReferredTo"),
        F.lit("Nurse").alias("HandedOverTo"), F.lit("Clinician").alias("HandedOverToCadre"),
        F.concat(F.lit("C"), ck.cast("string")).alias("ReportedCCCNumber"),
        F.when(k % 9 == 0, F.expr("DATE '0001-01-01'")).otherwise(od).alias("ReportedStartARTDate"),
        F.concat(F.lit("r"), ck.cast("string")).alias("RecordUUID"))
    clients = c.filter(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").alias("PatientPk"), (F.col("c_custkey") % 10 + 1).cast("int").alias("SiteCode"))
    loaded = o.filter(F.col("o_orderdate") < ntz(dt.datetime(1995, 4, 1))).select(
        ck.alias("PatientPk"), (ck % 10 + 1).cast("int").alias("SiteCode"))
    return spec, FrameIO({"ClientLinkages": form, "Clients": clients}, {spec.target: loaded})


def _p25_oracle() -> str:
    utf16 = "upper(sha256(unhex(regexp_replace(hex(substring(CAST({c} AS VARCHAR), 1, 36)), '(..)', '\\100', 'g'))))"
    return f"""
WITH a AS (
  SELECT o_orderkey AS ID, CAST(o_custkey % 10 + 1 AS INTEGER) AS SiteCode, o_custkey AS PatientPk,
         'H' || CAST(o_custkey AS VARCHAR) AS HtsNumber, 'IQCare' AS Emr, o_orderstatus AS Project,
         'F' || CAST(o_custkey % 10 + 1 AS VARCHAR) AS FacilityName,
         o_orderdate + INTERVAL 8800 DAY AS DateExtracted, o_orderpriority AS EnrolledFacilityName,
         CASE WHEN o_orderkey % 17 = 0 THEN DATE '1975-01-01'
              ELSE CAST(o_orderdate AS DATE) - CAST(o_orderkey % 400 AS INTEGER) END AS ReferralDate,
         o_orderdate + to_days(CAST(o_orderkey % 30 AS INTEGER)) AS DateEnrolled,
         CAST(o_orderdate AS DATE) + 7 AS DatePrefferedToBeEnrolled,
         CASE WHEN o_orderkey % 4 = 0 THEN 'Other Facility' ELSE 'KNH' END AS FacilityReferredTo,
         'Nurse' AS HandedOverTo, 'Clinician' AS HandedOverToCadre, 'C' || CAST(o_custkey AS VARCHAR) AS ReportedCCCNumber,
         CASE WHEN o_orderkey % 9 = 0 THEN DATE '0001-01-01' ELSE CAST(o_orderdate AS DATE) END AS ReportedStartARTDate,
         'r' || CAST(o_custkey AS VARCHAR) AS RecordUUID
  FROM orders),
tm AS (SELECT SiteCode, PatientPk, max(ID) AS MaxID, max(CAST(DateExtracted AS DATE)) AS MaxDateExtracted
       FROM a GROUP BY SiteCode, PatientPk),
g AS (
  SELECT a.FacilityName, a.SiteCode, a.PatientPk, a.HtsNumber, a.Emr, a.Project, a.EnrolledFacilityName,
         CAST(max(a.ReferralDate) AS DATE) AS ReferralDate, CAST(a.DateEnrolled AS DATE) AS DateEnrolled,
         CAST(max(a.DatePrefferedToBeEnrolled) AS DATE) AS DatePrefferedToBeEnrolled,
         CASE WHEN a.FacilityReferredTo = 'Other Facility' THEN NULL ELSE a.FacilityReferredTo END AS FacilityReferredTo,
         a.HandedOverTo, a.HandedOverToCadre, a.ReportedCCCNumber,
         CASE WHEN CAST(a.ReportedStartARTDate AS DATE) = DATE '0001-01-01' THEN NULL
              ELSE CAST(a.ReportedStartARTDate AS DATE) END AS ReportedStartARTDate,
         a.RecordUUID
  FROM a JOIN tm ON a.SiteCode = tm.SiteCode AND a.PatientPk = tm.PatientPk
              AND CAST(a.DateExtracted AS DATE) = tm.MaxDateExtracted AND a.ID = tm.MaxID
  WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal > 0 AND c.c_custkey = a.PatientPk
                AND CAST(c.c_custkey % 10 + 1 AS INTEGER) = a.SiteCode)
    AND a.DateExtracted > DATE '2019-09-08'
  GROUP BY a.FacilityName, a.SiteCode, a.PatientPk, a.HtsNumber, a.Emr, a.Project, a.EnrolledFacilityName,
           CAST(a.DateEnrolled AS DATE), a.FacilityReferredTo, a.HandedOverTo, a.HandedOverToCadre, a.DateExtracted,
           a.ReportedCCCNumber, CAST(a.ReportedStartARTDate AS DATE), a.RecordUUID),
clean AS (
  SELECT DISTINCT FacilityName, SiteCode, PatientPk, HtsNumber, Emr, Project, EnrolledFacilityName,
         CASE WHEN ReferralDate < DATE '1980-01-01' THEN NULL ELSE ReferralDate END AS ReferralDate,
         CASE WHEN DateEnrolled < DATE '1980-01-01' THEN NULL ELSE DateEnrolled END AS DateEnrolled,
         CASE WHEN DatePrefferedToBeEnrolled < DATE '1980-01-01' THEN NULL ELSE DatePrefferedToBeEnrolled END
           AS DatePrefferedToBeEnrolled,
         FacilityReferredTo, HandedOverTo, HandedOverToCadre, ReportedCCCNumber, ReportedStartARTDate, RecordUUID
  FROM g),
tgt AS (SELECT o_custkey AS PatientPk, CAST(o_custkey % 10 + 1 AS INTEGER) AS SiteCode FROM orders
        WHERE o_orderdate < TIMESTAMP '1995-04-01')
SELECT x.*, {utf16.format(c='HtsNumber')} AS HtsNumberHash, {utf16.format(c='PatientPk')} AS PatientPKHash
FROM clean x WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.PatientPk IS NOT DISTINCT FROM x.PatientPk
  AND t.SiteCode IS NOT DISTINCT FROM x.SiteCode)"""


@query("load_hts_client_linkages", oracle=_p25_oracle())
def load_hts_client_linkages(spark, sf):
    """The HTS linkages load spec (P25) end to end on the test tables: latest rule, client
    existence, extraction cut-off, scan-level GROUP BY with max() of referral dates, in-scan
    CASEs (facility referred to, 0001-01-01 sentinel), dates before 1980 -> NULL, delta, digests."""
    spec, io = _p25_io(spark, sf)
    return _load(spec, io)


# =============================================================== the CT patients job
# PatientExtract <- customer (patient id = customer / 3, so patients have several
# versions), Facility <- nation, lookups derived from customer, existing CT_Patient <-
# customers below 300.
def _p24_made():
    """Seven more windowed dates, 1970 to 2010, some of them missing."""
    names = ("RegistrationAtCCC", "RegistrationAtPMTCT", "RegistrationAtTBClinic", "PreviousARTStartDate", "LastVisit",
             "DateConfirmedHIVPositive", "TransferInDate")
    return {c: (f"CASE WHEN c_custkey % {i + 5} <> 0 THEN DATE '1970-01-01' + CAST((c_custkey * {2 * i + 31}) % 14600 AS INT) END",
                f"CASE WHEN {c} < DATE '1980-01-01' OR {c} > DATE '2000-12-31' THEN DATE '1900-01-01' ELSE {c} END")
            for i, c in enumerate(names)}


_P24_FEED = Feed(
    "p24_patients", "c_custkey",
    "ID,PatientID,PatientPK,SiteCode,FacilityName,Gender,DOB,RegistrationDate,PatientSource,MaritalStatus,EducationLevel,"
    "PreviousARTExposure,Emr,Project,NUPI", made=_p24_made())


def _p24_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p24_patients"]
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    ck = F.col("c_custkey")
    pat = c.select(
        ck.alias("ID"), F.concat(F.lit("CCC"), F.floor(ck / 3).cast("long").cast("string")).alias("PatientCccNumber"),
        F.floor(ck / 3).cast("long").alias("PatientPID"), F.col("c_nationkey").alias("FacilityId"),
        F.when(ck % 10 == 0, F.lit(None)).when(ck % 10 == 1, F.lit("Unknown")).otherwise(F.col("c_mktsegment"))
         .alias("Gender"),
        F.date_add(F.lit(dt.date(1999, 1, 1)), (ck % 50).cast("int")).alias("Created"),
        F.date_sub(F.lit(dt.date(1990, 1, 1)), ((ck * 37) % 40000).cast("int")).alias("DOB"),
        F.date_add(F.lit(dt.date(1975, 1, 1)), ((ck * 3) % 12000).cast("int")).alias("RegistrationDate"),
        F.when(ck % 4 == 0, F.lit("M")).when(ck % 4 == 1, F.lit("S")).otherwise(F.lit("X")).alias("MaritalStatus"),
        F.when(ck % 2 == 0, F.lit("Primary")).otherwise(F.lit("Secondary")).alias("EducationLevel"),
        F.col("c_mktsegment").alias("PreviousARTExposure"),
        F.when(ck % 3 == 0, F.lit("VCT")).otherwise(F.lit("OPD")).alias("PatientSource"),
        F.concat(F.lit("NUPI"), ck.cast("string")).alias("NUPI"), F.lit("KenyaEMR").alias("Emr"),
        F.lit("Other").alias("Project"), F.lit("KP").alias("PopulationType"), *_P24_FEED.columns())
    nk = F.col("n_nationkey")
    facility = n.select(nk.alias("Id"), (F.floor(nk / 5) * 100).cast("int").alias("Code"), F.col("n_name").alias("Name"),
                        F.when(nk % 5 == 4, F.lit(1)).when(nk % 5 != 3, F.lit(0)).alias("Voided"))
    marital = c.select(F.when(ck % 4 == 0, F.lit("M")).when(ck % 4 == 1, F.lit("S")).alias("Source_MaritalStatus"),
                       F.when(ck % 4 == 0, F.lit("Married")).when(ck % 4 == 1, F.lit("Single"))
                       .alias("Target_MaritalStatus")).filter(F.col("Source_MaritalStatus").isNotNull()).distinct()
    edu = c.filter(ck % 2 == 0).select(F.lit("Primary").alias("SourceEducationLevel"),
                                       F.lit("PRIMARY").alias("TargetEducationLevel")).distinct()
    regimen = c.filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_mktsegment").alias("Source_Regimen"), F.lit("First line").alias("Target_Regimen")).distinct()
    source = c.filter(ck % 3 == 0).select(F.lit("VCT").alias("source_name"),
                                          F.lit("VCT Centre").alias("target_name")).distinct()
    loaded = (c.filter(ck % 3 == 1).select((F.floor(F.col("c_nationkey") / 5) * 100).cast("int").alias("SiteCode"),
                                        F.floor(ck / 3).cast("long").alias("PatientPK")))
    io = FrameIO({"PatientExtract": pat, "Facility": facility, "lkp_MaritalStatus": marital,
                  "Lkp_EducationLevel": edu, "lkp_RegimenLineMap": regimen, "lkp_patient_source": source},
                 {spec.target: loaded})
    return spec, io


def _p24_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p24_patients"]
    final = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" if c in ("PopulationType", "KeyPopulationType") else c
                      for c in spec.columns)  # the text fills these two with NULL
    utf16 = "upper(sha256(unhex(regexp_replace(hex(substring(CAST({c} AS VARCHAR), 1, 36)), '(..)', '\\100', 'g'))))"
    return f"""
WITH p AS (
  SELECT c_custkey AS ID, 'CCC' || CAST(c_custkey // 3 AS VARCHAR) AS PatientID, c_custkey // 3 AS PatientPK,
         c_nationkey AS FacilityRef,
         CASE c_custkey % 10 WHEN 0 THEN NULL WHEN 1 THEN 'Unknown' ELSE c_mktsegment END AS Gender,
         DATE '1999-01-01' + CAST(c_custkey % 50 AS INTEGER) AS Created,
         DATE '1990-01-01' - CAST((c_custkey * 37) % 40000 AS INTEGER) AS DOB,
         DATE '1975-01-01' + CAST((c_custkey * 3) % 12000 AS INTEGER) AS RegistrationDate,
         CASE c_custkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'S' ELSE 'X' END AS MaritalStatus,
         CASE WHEN c_custkey % 2 = 0 THEN 'Primary' ELSE 'Secondary' END AS EducationLevel,
         c_mktsegment AS PreviousARTExposure,
         CASE WHEN c_custkey % 3 = 0 THEN 'VCT' ELSE 'OPD' END AS PatientSource,
         'NUPI' || CAST(c_custkey AS VARCHAR) AS NUPI, 'KenyaEMR' AS Emr, 'Other' AS Project, {_P24_FEED.form_sql}
  FROM customer),
j AS (SELECT p.*, n.n_nationkey // 5 * 100 AS SiteCode, n.n_name AS FacilityName, n.n_nationkey % 5 < 3 AS live
      FROM p JOIN nation n ON p.FacilityRef = n.n_nationkey),
tn AS (SELECT PatientPK, SiteCode, max(ID) AS MaxID, max(CAST(Created AS DATE)) AS MaxCreated FROM j
       GROUP BY PatientPK, SiteCode),
scan AS (
  SELECT DISTINCT j.ID, j.PatientID, j.PatientPK, j.SiteCode, j.FacilityName, j.Gender, j.DOB, j.RegistrationDate,
         j.PatientSource, j.MaritalStatus, j.EducationLevel, j.PreviousARTExposure, j.Emr, j.Project, j.NUPI, {_P24_FEED.names('j.')}
  FROM j JOIN tn ON j.PatientPK = tn.PatientPK AND j.SiteCode = tn.SiteCode
                AND CAST(j.Created AS DATE) = tn.MaxCreated AND j.ID = tn.MaxID
  WHERE j.live AND j.Gender IS NOT NULL AND j.Gender <> 'Unknown' AND j.SiteCode > 0),
clean AS (
  SELECT ID, PatientID, PatientPK, SiteCode, FacilityName, Gender,
         CASE WHEN DOB < DATE '1910-01-01' OR DOB > DATE '2000-12-31' THEN DATE '1900-01-01' ELSE DOB END AS DOB,
         CASE WHEN RegistrationDate < DATE '1980-01-01' OR RegistrationDate > DATE '2000-12-31'
              THEN DATE '1900-01-01' ELSE RegistrationDate END AS RegistrationDate,
         coalesce(ls.t, s.PatientSource) AS PatientSource,
         coalesce(lm.t, s.MaritalStatus) AS MaritalStatus,
         coalesce(le.t, s.EducationLevel) AS EducationLevel,
         coalesce(lr.t, s.PreviousARTExposure) AS PreviousARTExposure,
         Emr, Project, NUPI, {_P24_FEED.rule_sql}
  FROM scan s
  LEFT JOIN (SELECT DISTINCT CASE c_custkey % 4 WHEN 0 THEN 'M' ELSE 'S' END AS k,
                    CASE c_custkey % 4 WHEN 0 THEN 'Married' ELSE 'Single' END AS t
             FROM customer WHERE c_custkey % 4 IN (0, 1)) lm ON s.MaritalStatus = lm.k
  LEFT JOIN (SELECT DISTINCT 'Primary' AS k, 'PRIMARY' AS t FROM customer WHERE c_custkey % 2 = 0) le
    ON s.EducationLevel = le.k
  LEFT JOIN (SELECT DISTINCT c_mktsegment AS k, 'First line' AS t FROM customer WHERE c_mktsegment = 'BUILDING') lr
    ON s.PreviousARTExposure = lr.k
  LEFT JOIN (SELECT DISTINCT 'VCT' AS k, 'VCT Centre' AS t FROM customer WHERE c_custkey % 3 = 0) ls
    ON s.PatientSource = ls.k),
tgt AS (SELECT c_nationkey // 5 * 100 AS SiteCode, c_custkey // 3 AS PatientPK FROM customer WHERE c_custkey % 3 = 1)
SELECT {final}, {utf16.format(c='PatientID')} AS PatientIDHash, {utf16.format(c='PatientPK')} AS PatientPKHash,
       {utf16.format(c='NUPI')} AS NUPIHash
FROM clean x WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.SiteCode IS NOT DISTINCT FROM x.SiteCode
  AND t.PatientPK IS NOT DISTINCT FROM x.PatientPK)"""


@query("load_ct_patients", oracle=_p24_oracle())
def load_ct_patients(spark, sf):
    """The CT patients load spec (P24) end to end on the test tables: latest rule on the
    patient table joined to its facility, gender filters, DOB / registration windows, four
    lookups with job-specific column names, delta on (site, patient), three digests."""
    spec, io = _p24_io(spark, sf)
    return build_load(spec, io, AS_OF)


# =============================================================== the ART patients job
# PatientArtExtract <- orders (patient = customer), PatientExtract <- customer,
# Facility <- nation, lookups derived from orders, existing CT_ARTPatients <- customers
# below 500.  The latest rule keeps every order of a patient's last order day.
def _p01_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p01_art_patients"]
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    k = F.col("o_orderkey")
    od = F.to_date("o_orderdate")
    start = F.date_sub(od, (k % 9000).cast("int"))
    regimen = F.col("o_orderpriority")
    form = o.select(
        k.alias("ID"), F.col("o_custkey").alias("PatientId"), F.col("o_orderdate").alias("Created"),
        F.date_sub(F.lit(dt.date(1985, 1, 1)), ((k * 7) % 40000).cast("int")).alias("DOB"),
        start.alias("StartARTDate"), F.date_add(start, 10).alias("StartARTAtThisFacility"),
        od.alias("LastARTDate"), F.date_sub(start, 5).alias("RegistrationDate"),
        F.date_sub(start, 400).alias("PreviousARTStartDate"), F.date_add(od, 30).alias("ExpectedReturn"),
        od.alias("LastVisit"), F.when(F.col("o_orderstatus") == "F", F.date_add(od, 100)).alias("ExitDate"),
        (k % 200 - 20).cast("string").alias("Duration"), (k % 150 - 10).cast("string").alias("AgeARTStart"),
        (k % 140).cast("string").alias("AgeLastVisit"), (k % 130 - 5).cast("string").alias("AgeEnrollment"),
        F.when(F.col("o_orderstatus") == "F", F.lit("dead")).when(F.col("o_orderstatus") == "O", F.lit("ltfu"))
         .alias("ExitReason"),
        regimen.alias("PreviousARTRegimen"), regimen.alias("StartRegimen"), regimen.alias("LastRegimen"),
        F.when(k % 2 == 0, F.lit("VCT")).otherwise(F.lit("OPD")).alias("PatientSource"),
        F.when(k % 3 == 0, F.lit("Unknown")).otherwise(F.lit("F")).alias("Gender"))
    patient = c.select(
        F.col("c_custkey").alias("ID"), F.concat(F.lit("CCC"), F.col("c_custkey").cast("string")).alias("PatientCccNumber"),
        F.col("c_custkey").alias("PatientPID"), F.when(F.col("c_custkey") % 7 == 0, F.lit("Unknown")).otherwise(F.lit("M")).alias("Gender"),
        F.col("c_nationkey").alias("FacilityId"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("Open Medical Records System - OpenMRS")).otherwise(F.lit("IQCare"))
         .alias("Emr"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("AMPATH")).when(F.col("c_custkey") % 3 == 1, F.lit("HMIS"))
         .otherwise(F.lit("Other")).alias("Project"))
    facility = n.select(F.col("n_nationkey").alias("Id"), (F.col("n_nationkey") * 100).alias("Code"),
                        F.col("n_name").alias("Name"), F.lit(0).alias("Voided"))
    exit_lkp = o.filter(F.col("o_orderstatus") == "F").select(
        F.lit("dead").alias("source_name"), F.lit("DIED").alias("target_name")).distinct()
    reg_lkp = (o.select(F.col("o_orderpriority").alias("source_name")).distinct()
               .filter(F.col("source_name").isin("1-URGENT", "2-HIGH", "3-MEDIUM"))
               .withColumn("target_name", F.concat(F.lit("REG-"), F.substring("source_name", 1, 1))))
    src_lkp = o.filter(F.col("o_orderkey") % 2 == 0).select(
        F.lit("VCT").alias("source_name"), F.lit("VCT Centre").alias("target_name")).distinct()
    loaded = c.filter(F.col("c_custkey") % 3 == 1).select(
        F.col("c_custkey").alias("PatientPK"), (F.col("c_nationkey") * 100).alias("SiteCode"))
    io = FrameIO({"PatientArtExtract": form, "PatientExtract": patient, "Facility": facility,
                  "lkp_exit_reason": exit_lkp, "lkp_regimen": reg_lkp, "lkp_patient_source": src_lkp},
                 {spec.target: loaded})
    return spec, io


def _p01_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p01_art_patients"]
    have = {"ID", "PatientID", "PatientPK", "SiteCode", "FacilityName", "AgeEnrollment", "AgeARTStart", "AgeLastVisit",
            "RegistrationDate", "PatientSource", "Gender", "StartARTDate", "PreviousARTStartDate", "PreviousARTRegimen",
            "StartARTAtThisFacility", "StartRegimen", "LastARTDate", "LastRegimen", "Duration", "ExpectedReturn",
            "LastVisit", "ExitReason", "ExitDate", "Emr", "Project", "DOB", "DateAsOf"}
    dated = {r.column for r in spec.rules if r.kind == "date"}
    final = ", ".join(c if c in have else f"CAST(NULL AS {'DATE' if c in dated else 'VARCHAR'}) AS {c}"
                      for c in spec.columns)
    utf16 = "upper(sha256(unhex(regexp_replace(hex(substring(CAST({c} AS VARCHAR), 1, 36)), '(..)', '\\100', 'g'))))"

    def window(col, lo):
        return (f"CASE WHEN {col} < DATE '{lo}' OR {col} > DATE '2000-12-31' THEN DATE '1900-01-01' "
                f"ELSE {col} END AS {col}")

    def age(col, lo, hi):
        cond = f"TRY_CAST({col} AS DOUBLE) < {lo}" + (f" OR TRY_CAST({col} AS DOUBLE) > {hi}" if hi else "")
        return f"CASE WHEN {cond} THEN '999' ELSE {col} END AS {col}"
    dates80 = ["StartARTDate", "StartARTAtThisFacility", "LastARTDate", "RegistrationDate", "PreviousARTStartDate",
               "ExpectedReturn", "LastVisit", "ExitDate"]
    return f"""
WITH a AS (
  SELECT o_orderkey AS ID, o_custkey AS PatientRef, o_orderdate AS Created,
         DATE '1985-01-01' - CAST((o_orderkey * 7) % 40000 AS INTEGER) AS DOB,
         CAST(o_orderdate AS DATE) - CAST(o_orderkey % 9000 AS INTEGER) AS StartARTDate,
         CAST(o_orderdate AS DATE) - CAST(o_orderkey % 9000 AS INTEGER) + 10 AS StartARTAtThisFacility,
         CAST(o_orderdate AS DATE) AS LastARTDate,
         CAST(o_orderdate AS DATE) - CAST(o_orderkey % 9000 AS INTEGER) - 5 AS RegistrationDate,
         CAST(o_orderdate AS DATE) - CAST(o_orderkey % 9000 AS INTEGER) - 400 AS PreviousARTStartDate,
         CAST(o_orderdate AS DATE) + 30 AS ExpectedReturn, CAST(o_orderdate AS DATE) AS LastVisit,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 100 END AS ExitDate,
         CAST(o_orderkey % 200 - 20 AS VARCHAR) AS Duration, CAST(o_orderkey % 150 - 10 AS VARCHAR) AS AgeARTStart,
         CAST(o_orderkey % 140 AS VARCHAR) AS AgeLastVisit, CAST(o_orderkey % 130 - 5 AS VARCHAR) AS AgeEnrollment,
         CASE o_orderstatus WHEN 'F' THEN 'dead' WHEN 'O' THEN 'ltfu' END AS ExitReason,
         o_orderpriority AS PreviousARTRegimen, o_orderpriority AS StartRegimen, o_orderpriority AS LastRegimen,
         CASE WHEN o_orderkey % 2 = 0 THEN 'VCT' ELSE 'OPD' END AS PatientSource,
         CASE WHEN o_orderkey % 3 = 0 THEN 'Unknown' ELSE 'F' END AS Gender
  FROM orders),
j AS (
  SELECT a.*, 'CCC' || CAST(c.c_custkey AS VARCHAR) AS PatientID, c.c_custkey AS PatientPK, c.c_custkey % 7 <> 0 AS known,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'Open Medical Records System - OpenMRS' ELSE 'IQCare' END AS Emr,
         CASE c.c_custkey % 3 WHEN 0 THEN 'AMPATH' WHEN 1 THEN 'HMIS' ELSE 'Other' END AS Project,
         n.n_nationkey * 100 AS SiteCode, n.n_name AS FacilityName
  FROM a JOIN customer c ON a.PatientRef = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
tn AS (SELECT PatientPK, SiteCode, max(CAST(Created AS DATE)) AS MaxCreated FROM j GROUP BY PatientPK, SiteCode),
scan AS (
  SELECT DISTINCT j.ID, j.PatientID, j.PatientPK, j.SiteCode, j.FacilityName, j.AgeEnrollment, j.AgeARTStart,
         j.AgeLastVisit, j.RegistrationDate, j.PatientSource, j.Gender, j.StartARTDate, j.PreviousARTStartDate,
         j.PreviousARTRegimen, j.StartARTAtThisFacility, j.StartRegimen, j.LastARTDate, j.LastRegimen, j.Duration,
         j.ExpectedReturn, j.LastVisit, j.ExitReason, j.ExitDate, j.Emr, j.Project, j.DOB
  FROM j JOIN tn ON j.PatientPK = tn.PatientPK AND j.SiteCode = tn.SiteCode AND CAST(j.Created AS DATE) = tn.MaxCreated
  WHERE j.known AND j.SiteCode > 0),
clean AS (
  SELECT ID, PatientID, PatientPK, SiteCode, FacilityName, {age('AgeEnrollment', 0, 120)}, {age('AgeARTStart', 0, 120)},
         {age('AgeLastVisit', 0, 120)}, {', '.join(window(c, '1980-01-01') for c in dates80)},
         {window('DOB', '1900-01-01')}, {age('Duration', 0, None)},
         PatientSource, Gender, PreviousARTRegimen, StartRegimen, LastRegimen, ExitReason,
         CASE WHEN Emr = 'Open Medical Records System - OpenMRS' THEN 'OpenMRS' WHEN Emr = 'Ampath AMRS' THEN 'AMRS'
              ELSE Emr END AS Emr,
         CASE WHEN p0 IN ('Ampathplus', 'AMPATH') THEN 'Ampath Plus'
              WHEN p0 IN ('UCSF Clinical Kisumu', 'CHAP Uzima', 'DREAM', 'IRDO') THEN 'Kenya HMIS II' ELSE p0 END AS Project,
         DATE '2000-12-31' AS DateAsOf
  FROM (SELECT *, CASE WHEN Project IN ('I-TECH', 'HMIS') THEN 'Kenya HMIS II' ELSE Project END AS p0 FROM scan) s),
reg AS (SELECT DISTINCT o_orderpriority AS s, 'REG-' || substring(o_orderpriority, 1, 1) AS t FROM orders
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')),
std AS (
  SELECT x.* REPLACE (coalesce(e.t, x.ExitReason) AS ExitReason, coalesce(r1.t, x.PreviousARTRegimen) AS PreviousARTRegimen,
                      coalesce(r2.t, x.StartRegimen) AS StartRegimen, coalesce(r3.t, x.LastRegimen) AS LastRegimen,
                      coalesce(ps.t, x.PatientSource) AS PatientSource)
  FROM clean x
  LEFT JOIN (SELECT DISTINCT 'dead' AS s, 'DIED' AS t FROM orders WHERE o_orderstatus = 'F') e ON x.ExitReason = e.s
  LEFT JOIN reg r1 ON x.PreviousARTRegimen = r1.s LEFT JOIN reg r2 ON x.StartRegimen = r2.s
  LEFT JOIN reg r3 ON x.LastRegimen = r3.s
  LEFT JOIN (SELECT DISTINCT 'VCT' AS s, 'VCT Centre' AS t FROM orders WHERE o_orderkey % 2 = 0) ps
    ON x.PatientSource = ps.s),
tgt AS (SELECT c_custkey AS PatientPK, c_nationkey * 100 AS SiteCode FROM customer WHERE c_custkey % 3 = 1)
SELECT {final}, {utf16.format(c='PatientID')} AS PatientIDHash, {utf16.format(c='PatientPK')} AS PatientPKHash
FROM std x WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.PatientPK IS NOT DISTINCT FROM x.PatientPK
  AND t.SiteCode IS NOT DISTINCT FROM x.SiteCode)"""


@query("load_art_patients", oracle=_p01_oracle())
def load_art_patients(spark, sf):
    """The ART patients load spec (P01) end to end on the test tables: latest rule by day only
    (ties survive), nine date windows, age / duration clamps to 999, EMR and project recodes,
    one regimen lookup used for three columns, exit-reason and patient-source lookups,
    injected as-of stamp, delta on (patient, site), digests."""
    spec, io = _p01_io(spark, sf)
    return _load(spec, io)


# =============================================================== pharmacy (P21), PNS (P30), EMR sites
_UTF16_SQL = "upper(sha256(unhex(regexp_replace(hex(substring(CAST({c} AS VARCHAR), 1, 36)), '(..)', '\\100', 'g'))))"


def _null_cols(spec, have):
    """Contract columns: present ones by name (case-insensitive, as both engines resolve
    them), missing ones as typed NULLs (dates where a date rule types them)."""
    dated = {r.column for r in spec.rules if r.kind == "date"} | {c for c, e in spec.select if e.endswith("AS DATE)")}
    low = {h.lower() for h in have}

    def one(c):
        if c in have:
            return c
        if c.lower() in low:
            return f"{c} AS {c}"
        return f"CAST(NULL AS {'DATE' if c in dated else 'VARCHAR'}) AS {c}"
    return ", ".join(one(c) for c in spec.columns)


def _p21_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p21_patient_pharmacy"]
    li = table(spark, sf, "lineitem")
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    sd = F.to_date("l_shipdate")
    form = li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ID"), F.col("l_partkey").alias("PatientId"),
        F.concat(F.lit("V"), F.col("l_orderkey").cast("string")).alias("VisitID"),
        F.col("l_returnflag").alias("Drug"), sd.alias("DispenseDate"),
        (F.col("l_quantity") - 10).cast("int").cast("string").alias("Duration"),
        F.when(F.col("l_linenumber") == 3, F.lit(dt.date(1899, 5, 1))).otherwise(F.date_add(sd, 30))
         .alias("ExpectedReturn"),
        F.col("l_linestatus").alias("TreatmentType"),
        (F.col("l_linenumber") - 2).cast("string").alias("PeriodTaken"),
        F.when(F.col("l_discount") > 0.05, F.lit("CTX")).alias("ProphylaxisType"))
    patient = c.select(
        F.col("c_custkey").alias("ID"), F.concat(F.lit("CCC"), F.col("c_custkey").cast("string")).alias("PatientCccNumber"),
        F.col("c_custkey").alias("PatientPID"), F.col("c_mktsegment").alias("Gender"),
        F.col("c_nationkey").alias("FacilityId"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("Ampath AMRS")).otherwise(F.lit("KenyaEMR")).alias("Emr"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("I-TECH")).when(F.col("c_custkey") % 3 == 1, F.lit("DREAM"))
         .otherwise(F.lit("Other")).alias("Project"))
    facility = n.select(F.col("n_nationkey").alias("Id"), (F.col("n_nationkey") * 100).alias("Code"),
                        F.col("n_name").alias("Name"), F.lit(0).alias("Voided"))
    drugs = li.select(F.col("l_returnflag").alias("source_name")).distinct().filter(F.col("source_name") != "N") \
        .withColumn("target_name", F.concat(F.lit("DRUG-"), F.col("source_name")))
    ttype = li.filter(F.col("l_linestatus") == "F").select(F.lit("F").alias("source_name"),
                                                           F.lit("ART").alias("target_name")).distinct()
    proph = li.filter(F.col("l_discount") > 0.05).select(F.lit("CTX").alias("source_name"),
                                                         F.lit("Cotrimoxazole").alias("target_name")).distinct()
    loaded = li.filter(F.col("l_shipdate") < ntz(dt.datetime(1997, 1, 1))).join(
        c, F.col("l_partkey") == F.col("c_custkey")).select(
        (F.col("c_nationkey") * 100).alias("SiteCode"), F.col("c_custkey").alias("PatientPK"),
        F.concat(F.lit("V"), F.col("l_orderkey").cast("string")).alias("VisitID"))
    io = FrameIO({"PatientPharmacyExtract": form, "PatientExtract": patient, "Facility": facility,
                  "lkp_regimen": drugs, "lkp_treatment_type": ttype, "lkp_prophylaxis_type": proph},
                 {spec.target: loaded})
    return spec, io


def _p21_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p21_patient_pharmacy"]
    have = {"ID", "PatientID", "SiteCode", "FacilityName", "PatientPK", "VisitID", "Drug", "DispenseDate", "Duration",
            "ExpectedReturn", "TreatmentType", "PeriodTaken", "ProphylaxisType", "Emr", "Project"}
    return f"""
WITH a AS (
  SELECT l_orderkey * 10 + l_linenumber AS ID, l_partkey AS PatientRef, 'V' || CAST(l_orderkey AS VARCHAR) AS VisitID, l_returnflag AS Drug,
         CAST(l_shipdate AS DATE) AS DispenseDate, CAST(CAST(l_quantity - 10 AS INTEGER) AS VARCHAR) AS Duration,
         CASE WHEN l_linenumber = 3 THEN DATE '1899-05-01' ELSE CAST(l_shipdate AS DATE) + 30 END AS ExpectedReturn,
         l_linestatus AS TreatmentType, CAST(l_linenumber - 2 AS VARCHAR) AS PeriodTaken,
         CASE WHEN l_discount > 0.05 THEN 'CTX' END AS ProphylaxisType
  FROM lineitem),
scan AS (
  SELECT DISTINCT a.ID, 'CCC' || CAST(c.c_custkey AS VARCHAR) AS PatientID, n.n_nationkey * 100 AS SiteCode,
         n.n_name AS FacilityName, c.c_custkey AS PatientPK, a.VisitID, a.Drug, a.DispenseDate, a.Duration,
         a.ExpectedReturn, a.TreatmentType, a.PeriodTaken, a.ProphylaxisType,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'Ampath AMRS' ELSE 'KenyaEMR' END AS Emr,
         CASE c.c_custkey % 3 WHEN 0 THEN 'I-TECH' WHEN 1 THEN 'DREAM' ELSE 'Other' END AS Project
  FROM a JOIN customer c ON a.PatientRef = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE c.c_mktsegment <> 'Unknown' AND n.n_nationkey * 100 > 0),
clean AS (
  SELECT ID, PatientID, SiteCode, FacilityName, PatientPK, VisitID, coalesce(d.t, s.Drug) AS Drug, DispenseDate,
         CASE WHEN TRY_CAST(Duration AS DOUBLE) < 0 THEN '999' ELSE Duration END AS Duration,
         CASE WHEN ExpectedReturn < DATE '1900-01-01' THEN DATE '1900-01-01' ELSE ExpectedReturn END AS ExpectedReturn,
         coalesce(tt.t, s.TreatmentType) AS TreatmentType,
         CASE WHEN TRY_CAST(PeriodTaken AS DOUBLE) < 0.0000001 THEN '999' ELSE PeriodTaken END AS PeriodTaken,
         coalesce(pr.t, s.ProphylaxisType) AS ProphylaxisType,
         CASE WHEN Emr = 'Open Medical Records System - OpenMRS' THEN 'OpenMRS' WHEN Emr = 'Ampath AMRS' THEN 'AMRS'
              ELSE Emr END AS Emr,
         CASE WHEN p0 IN ('Ampathplus', 'AMPATH') THEN 'Ampath Plus'
              WHEN p0 IN ('UCSF Clinical Kisumu', 'CHAP Uzima', 'DREAM', 'IRDO') THEN 'Kenya HMIS II' ELSE p0 END AS Project
  FROM (SELECT *, CASE WHEN Project IN ('I-TECH', 'HMIS') THEN 'Kenya HMIS II' ELSE Project END AS p0 FROM scan) s
  LEFT JOIN (SELECT DISTINCT l_returnflag AS k, 'DRUG-' || l_returnflag AS t FROM lineitem WHERE l_returnflag <> 'N') d
    ON s.Drug = d.k
  LEFT JOIN (SELECT DISTINCT 'F' AS k, 'ART' AS t FROM lineitem WHERE l_linestatus = 'F') tt ON s.TreatmentType = tt.k
  LEFT JOIN (SELECT DISTINCT 'CTX' AS k, 'Cotrimoxazole' AS t FROM lineitem WHERE l_discount > 0.05) pr
    ON s.ProphylaxisType = pr.k),
tgt AS (SELECT c.c_nationkey * 100 AS SiteCode, c.c_custkey AS PatientPK, 'V' || CAST(l.l_orderkey AS VARCHAR) AS VisitID
        FROM lineitem l JOIN customer c ON l.l_partkey = c.c_custkey WHERE l.l_shipdate < TIMESTAMP '1997-01-01')
SELECT {_null_cols(spec, have)}, {_UTF16_SQL.format(c='PatientID')} AS PatientIDHash,
       {_UTF16_SQL.format(c='PatientPK')} AS PatientPKHash
FROM clean x WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.SiteCode IS NOT DISTINCT FROM x.SiteCode
  AND t.PatientPK IS NOT DISTINCT FROM x.PatientPK AND t.VisitID IS NOT DISTINCT FROM x.VisitID)"""


@query("load_patient_pharmacy", oracle=_p21_oracle())
def load_patient_pharmacy(spark, sf):
    """The pharmacy load spec (P21) end to end on the test tables: no latest rule, duration and
    period clamps (valid values kept), open-ended expected-return window, three lookups, EMR /
    project recodes, delta on (site, patient, visit)."""
    spec, io = _p21_io(spark, sf)
    return _load(spec, io)


def _p30_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p30_partner_notification_services"]
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    form = o.select(
        k.alias("ID"), (ck % 10 + 1).cast("int").alias("SiteCode"), ck.alias("PatientPk"),
        F.concat(F.lit("H"), ck.cast("string")).alias("HtsNumber"), (k % 3000).alias("PartnerPatientPk"),
        F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("C"), k.cast("string"))).alias("CccNumber"),
        F.when(k % 4 == 0, F.lit("N/A")).otherwise(F.lit("Yes")).alias("ScreenedForIpv"),
        F.when(k % 3 == 0, F.lit("0")).otherwise(F.lit("1")).alias("PnsConsent"),
        F.when(k % 2 == 0, F.lit("Y")).otherwise(F.lit("N")).alias("LinkedToCare"),
        F.when(k % 6 == 0, F.lit("Pr: Provider Referral")).when(k % 6 == 1, F.lit("Cr: Passive Referral"))
         .otherwise(F.lit("Other")).alias("PnsApproach"),
        F.when(k % 7 == 0, F.lit("")).otherwise(F.col("o_orderpriority")).alias("FacilityLinkedTo"),
        (k % 130 - 10).cast("string").alias("Age"))
    clients = c.filter(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").alias("PatientPk"), (F.col("c_custkey") % 10 + 1).cast("int").alias("SiteCode"))
    loaded = o.filter(F.col("o_orderdate") < ntz(dt.datetime(1997, 1, 1))).select(
        ck.alias("PatientPk"), (ck % 10 + 1).cast("int").alias("SiteCode"), (k % 3000).alias("PartnerPatientPk"))
    return spec, FrameIO({"HtsPartnerNotificationServices": form, "Clients": clients}, {spec.target: loaded})


def _p30_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p30_partner_notification_services"]
    have = {"ID", "SiteCode", "PatientPk", "HtsNumber", "PartnerPatientPk", "CccNumber", "ScreenedForIpv", "PnsConsent",
            "LinkedToCare", "PnsApproach", "FacilityLinkedTo", "Age"}
    return f"""
WITH a AS (
  SELECT o_orderkey AS ID, CAST(o_custkey % 10 + 1 AS INTEGER) AS SiteCode, o_custkey AS PatientPk,
         'H' || CAST(o_custkey AS VARCHAR) AS HtsNumber, o_orderkey % 3000 AS PartnerPatientPk,
         CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'C' || CAST(o_orderkey AS VARCHAR) END AS CccNumber,
         CASE WHEN o_orderkey % 4 = 0 THEN 'N/A' ELSE 'Yes' END AS ScreenedForIpv,
         CASE WHEN o_orderkey % 3 = 0 THEN '0' ELSE '1' END AS PnsConsent,
         CASE WHEN o_orderkey % 2 = 0 THEN 'Y' ELSE 'N' END AS LinkedToCare,
         CASE o_orderkey % 6 WHEN 0 THEN 'Pr: Provider Referral' WHEN 1 THEN 'Cr: Passive Referral' ELSE 'Other' END
           AS PnsApproach,
         CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderpriority END AS FacilityLinkedTo,
         CAST(o_orderkey % 130 - 10 AS VARCHAR) AS Age
  FROM orders),
scan AS (
  SELECT DISTINCT * FROM a WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal > 0 AND c.c_custkey = a.PatientPk
                                         AND CAST(c.c_custkey % 10 + 1 AS INTEGER) = a.SiteCode)),
clean AS (
  SELECT ID, SiteCode, PatientPk, HtsNumber, PartnerPatientPk,
         CASE WHEN CccNumber = '' THEN NULL ELSE CccNumber END AS CccNumber,
         CASE WHEN ScreenedForIpv = 'N/A' THEN NULL ELSE ScreenedForIpv END AS ScreenedForIpv,
         CASE WHEN PnsConsent = '0' THEN 'No' ELSE PnsConsent END AS PnsConsent,
         CASE LinkedToCare WHEN 'Y' THEN 'Yes' WHEN 'N' THEN 'No' ELSE LinkedToCare END AS LinkedToCare,
         CASE WHEN PnsApproach IN ('Pr: Provider Referral', 'D: Dual Referral') THEN 'Provider Referral'
              WHEN PnsApproach = 'Cr: Passive Referral' THEN 'Passive Referral' ELSE PnsApproach END AS PnsApproach,
         CASE WHEN FacilityLinkedTo = '' THEN NULL ELSE FacilityLinkedTo END AS FacilityLinkedTo,
         CASE WHEN TRY_CAST(Age AS DOUBLE) < 0 OR TRY_CAST(Age AS DOUBLE) > 100 THEN NULL ELSE Age END AS Age
  FROM scan),
tgt AS (SELECT o_custkey AS PatientPk, CAST(o_custkey % 10 + 1 AS INTEGER) AS SiteCode, o_orderkey % 3000 AS PartnerPatientPk
        FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01')
SELECT {_null_cols(spec, have)}, {_UTF16_SQL.format(c='HtsNumber')} AS HtsNumberHash,
       {_UTF16_SQL.format(c='PatientPk')} AS PatientPKHash
FROM clean x WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.PatientPk IS NOT DISTINCT FROM x.PatientPk
  AND t.SiteCode IS NOT DISTINCT FROM x.SiteCode AND t.PartnerPatientPk IS NOT DISTINCT FROM x.PartnerPatientPk)"""


@query("load_partner_notification", oracle=_p30_oracle())
def load_partner_notification(spark, sf):
    """The partner-notification load spec (P30) end to end on the test tables: client existence,
    blank -> NULL, N/A sentinel, consent / linkage / approach recodes, age outside 0-100 -> NULL,
    delta on (patient, site, partner)."""
    spec, io = _p30_io(spark, sf)
    return _load(spec, io)


def _p12_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p12_emr_sites"]
    s = table(spark, sf, "supplier")
    sites = s.select(
        F.when(F.col("s_suppkey") % 9 == 0, F.lit("")).otherwise((F.col("s_suppkey") + 10000).cast("string"))
         .alias("MFL_Code"),
        F.col("s_name").alias("Facility_Name"), F.concat(F.lit("County "), F.col("s_nationkey").cast("string"))
         .alias("County"), F.lit(None).cast("string").alias("SubCounty"),
        F.when(F.col("s_acctbal") > 5000, F.lit("KenyaEMR")).otherwise(F.lit("IQCare")).alias("EMR"),
        F.lit("Yes").alias("_3PM"), F.lit("Yes").alias("TB"), F.lit("Live").alias("IL_Status"))
    loaded = s.filter(F.col("s_suppkey") % 3 == 1).select((F.col("s_suppkey") + 10000).cast("string").alias("MFL_Code"))
    return spec, FrameIO({"ALL_EMRSites": sites}, {spec.target: loaded})


def _p12_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p12_emr_sites"]
    have = {"MFL_Code", "Facility_Name", "County", "SubCounty", "EMR"}
    return f"""
WITH s AS (
  SELECT DISTINCT CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE CAST(s_suppkey + 10000 AS VARCHAR) END AS MFL_Code,
         s_name AS Facility_Name, 'County ' || CAST(s_nationkey AS VARCHAR) AS County, CAST(NULL AS VARCHAR) AS SubCounty,
         CASE WHEN s_acctbal > 5000 THEN 'KenyaEMR' ELSE 'IQCare' END AS EMR
  FROM supplier)
SELECT {_null_cols(spec, have)} FROM s
WHERE MFL_Code <> '' AND NOT EXISTS (SELECT 1 FROM supplier t WHERE t.s_suppkey % 3 = 1
  AND CAST(t.s_suppkey + 10000 AS VARCHAR) IS NOT DISTINCT FROM s.MFL_Code)"""


@query("load_emr_sites", oracle=_p12_oracle())
def load_emr_sites(spark, sf):
    """The facility-master load spec (P12) on the test tables: blank facility codes dropped,
    NULL placeholder columns, a quoted column name, delta on the facility code."""
    spec, io = _p12_io(spark, sf)
    return _load(spec, io)


# =============================================================== PrEP patient (P49), test kits (P32), contacts
_P49_FEED = Feed(
    "p49_patient", "c_custkey",
    "ID,PatientPk,SiteCode,Created,PrepNumber,Sex,Inschool,MaritalStatus,County,SubCounty,Emr",
    blank="DateLastUsedPrev,PrevPrepReg,ClientPreviouslyonPrep,DateStartedPrEPattransferringfacility,TransferFromFacility,"
          "TransferInDate,Refferedfrom,ReferralPoint,ClientType,Ward,LandMark,CountyofBirth")


def _p49_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p49_patient"]
    c = table(spark, sf, "customer")
    ck = F.col("c_custkey")
    form = c.select(
        ck.alias("ID"), F.floor(ck / 2).cast("long").alias("PatientPk"), (F.col("c_nationkey") + 1).alias("SiteCode"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (ck % 40).cast("int")).alias("Created"),
        F.concat(F.lit("PREP-"), F.floor(ck / 2).cast("long").cast("string")).alias("PrepNumber"),
        F.when(ck % 5 == 0, F.lit("")).otherwise(F.lit("F")).alias("Sex"),
        F.when(ck % 6 == 0, F.lit("160579")).when(ck % 6 == 1, F.lit("105")).otherwise(F.lit("GP"))
         .alias("KeyPopulationType"),
        F.when(ck % 3 == 0, F.lit("1")).when(ck % 3 == 1, F.lit("2")).otherwise(F.lit("9")).alias("Inschool"),
        F.when(ck % 4 == 0, F.lit("Never married")).when(ck % 4 == 1, F.lit("Separated"))
         .otherwise(F.lit("Widowed")).alias("MaritalStatus"),
        F.when(ck % 7 == 0, F.lit("Ugunja")).when(ck % 7 == 1, F.lit("...")).when(ck % 7 == 2, F.lit(""))
         .when(ck % 7 == 3, F.lit("KIAMBU''")).otherwise(F.col("c_mktsegment")).alias("County"),
        F.when(ck % 8 == 0, F.lit("")).otherwise(F.lit("Kisumu")).alias("SubCounty"),
        F.lit("KenyaEMR").alias("Emr"), *_P49_FEED.columns())
    loaded = c.filter(ck % 3 == 1).select(F.floor(ck / 2).cast("long").alias("PatientPk"), (F.col("c_nationkey") + 1).alias("SiteCode"))
    return spec, FrameIO({"PrepPatients": form}, {spec.target: loaded})


def _p49_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p49_patient"]
    have = {"ID", "PatientPk", "SiteCode", "Created", "PrepNumber", "Sex", "Inschool",
            "MaritalStatus", "County", "SubCounty", "Emr", *_P49_FEED.form}
    return f"""
WITH a AS (
  SELECT c_custkey AS ID, c_custkey // 2 AS PatientPk, c_nationkey + 1 AS SiteCode,
         DATE '2020-01-01' + CAST(c_custkey % 40 AS INTEGER) AS Created,
         'PREP-' || CAST(c_custkey // 2 AS VARCHAR) AS PrepNumber,
         CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'F' END AS Sex,
         CASE c_custkey % 3 WHEN 0 THEN '1' WHEN 1 THEN '2' ELSE '9' END AS Inschool,
         CASE c_custkey % 4 WHEN 0 THEN 'Never married' WHEN 1 THEN 'Separated' ELSE 'Widowed' END AS MaritalStatus,
         CASE c_custkey % 7 WHEN 0 THEN 'Ugunja' WHEN 1 THEN '...' WHEN 2 THEN '' WHEN 3 THEN 'KIAMBU''''' ELSE c_mktsegment END
           AS County,
         CASE WHEN c_custkey % 8 = 0 THEN '' ELSE 'Kisumu' END AS SubCounty, 'KenyaEMR' AS Emr,
         {_P49_FEED.form_sql}
  FROM customer),
tn AS (SELECT PatientPk, SiteCode, max(ID) AS MaxID, max(CAST(Created AS DATE)) AS MaxCreated FROM a
       GROUP BY PatientPk, SiteCode),
scan AS (SELECT a.* FROM a JOIN tn ON a.PatientPk = tn.PatientPk AND a.SiteCode = tn.SiteCode
                                   AND CAST(a.Created AS DATE) = tn.MaxCreated AND a.ID = tn.MaxID),
clean AS (
  SELECT ID, PatientPk, SiteCode, Created, PrepNumber, Emr,
         CASE WHEN Sex = '' THEN NULL ELSE Sex END AS Sex,
         CASE WHEN SubCounty = '' THEN NULL ELSE SubCounty END AS SubCounty,
         CASE Inschool WHEN '1' THEN 'Yes' WHEN '2' THEN 'No' ELSE Inschool END AS Inschool,
         CASE MaritalStatus WHEN 'Married' THEN 'Married Monogamous' WHEN 'Never married' THEN 'Single'
              WHEN 'Living with partner' THEN 'Cohabiting' WHEN 'Polygamous' THEN 'Married Polygamous'
              WHEN 'OTHER NON-CODED' THEN 'Unknown' WHEN 'Separated' THEN 'Divorced' ELSE MaritalStatus END
           AS MaritalStatus,
         CASE WHEN County IN ('North Alego', 'West Sakwa', 'Ugunja', 'North Ugenya', 'Ugenya West', 'Ukwala', 'West Alego')
                THEN 'Siaya'
              WHEN County = 'KIAMBU''''' THEN 'Kiambu'
              WHEN County IN ('Kagen', '...') THEN 'NOT DOCUMENTED'
              WHEN County = '' THEN NULL ELSE County END AS County, {_P49_FEED.rule_sql}
  FROM scan)
SELECT {_null_cols(spec, have)}, {_UTF16_SQL.format(c='PrepNumber')} AS PrepNumberHash,
       {_UTF16_SQL.format(c='PatientPk')} AS PatientPKHash
FROM clean x WHERE NOT EXISTS (SELECT 1 FROM customer t WHERE t.c_custkey % 3 = 1
  AND t.c_custkey // 2 IS NOT DISTINCT FROM x.PatientPk AND t.c_nationkey + 1 IS NOT DISTINCT FROM x.SiteCode)"""


@query("load_prep_patient", oracle=_p49_oracle())
def load_prep_patient(spark, sf):
    """The PrEP patient load spec (P49) on the test tables: latest rule, no DISTINCT, blank ->
    NULL, key-population / school / marital / county recodes, delta, digests."""
    spec, io = _p49_io(spark, sf)
    return build_load(spec, io, AS_OF)


def _p32_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p32_test_kits"]
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    ln = F.col("l_linenumber")
    form = li.select(
        (F.col("l_orderkey") * 10 + ln).alias("ID"), F.col("l_orderkey").alias("PatientPk"),
        (F.col("l_suppkey") % 5 + 1).cast("int").alias("SiteCode"),
        F.concat(F.lit("H"), F.col("l_orderkey").cast("string")).alias("HtsNumber"),
        (ln % 3).alias("EncounterId"),
        F.when(ln == 2, F.lit("")).otherwise(F.col("l_returnflag")).alias("TestKitName1"),
        F.col("l_linestatus").alias("TestKitLotNumber1"),
        F.when(F.col("l_tax") > 0.04, F.lit("N/A")).otherwise(F.lit("Negative")).alias("TestResult2"),
        F.when(ln == 4, F.lit("")).otherwise(F.lit("Unigold")).alias("TestKitName2"),
        F.date_add(F.to_date("l_shipdate"), (F.col("l_partkey") % 2).cast("int")).alias("DateExtracted"))
    clients = o.select(F.col("o_orderkey").alias("PatientPk"),
                       (F.col("o_custkey") % 5 + 1).cast("int").alias("SiteCode"))
    loaded = li.filter(F.col("l_shipdate") < ntz(dt.datetime(1996, 1, 1))).select(
        F.col("l_orderkey").alias("PatientPk"), (F.col("l_suppkey") % 5 + 1).cast("int").alias("SiteCode"))
    return spec, FrameIO({"HtsTestKits": form, "Clients": clients}, {spec.target: loaded})


def _p32_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p32_test_kits"]
    have = {"SiteCode", "PatientPk", "HtsNumber", "EncounterId", "TestKitName1", "TestKitLotNumber1", "TestResult2",
            "TestKitName2"}
    return f"""
WITH a AS (
  SELECT l_orderkey * 10 + l_linenumber AS ID, l_orderkey AS PatientPk,
         CAST(l_suppkey % 5 + 1 AS INTEGER) AS SiteCode, 'H' || CAST(l_orderkey AS VARCHAR) AS HtsNumber,
         l_linenumber % 3 AS EncounterId, CASE WHEN l_linenumber = 2 THEN '' ELSE l_returnflag END AS TestKitName1,
         l_linestatus AS TestKitLotNumber1, CASE WHEN l_tax > 0.04 THEN 'N/A' ELSE 'Negative' END AS TestResult2,
         CASE WHEN l_linenumber = 4 THEN '' ELSE 'Unigold' END AS TestKitName2,
         CAST(l_shipdate AS DATE) + CAST(l_partkey % 2 AS INTEGER) AS DateExtracted
  FROM lineitem),
tm AS (SELECT SiteCode, PatientPk, EncounterId, TestKitName1, TestResult2, TestKitLotNumber1, max(ID) AS MaxID,
              max(CAST(DateExtracted AS DATE)) AS MaxDateExtracted
       FROM a GROUP BY SiteCode, PatientPk, EncounterId, TestKitName1, TestResult2, TestKitLotNumber1),
scan AS (
  SELECT DISTINCT a.SiteCode, a.PatientPk, a.HtsNumber, a.EncounterId, a.TestKitName1, a.TestKitLotNumber1,
         a.TestResult2, a.TestKitName2
  FROM a JOIN tm ON a.SiteCode = tm.SiteCode AND a.PatientPk = tm.PatientPk AND a.EncounterId = tm.EncounterId
    AND a.TestKitName1 = tm.TestKitName1 AND a.TestResult2 = tm.TestResult2 AND a.TestKitLotNumber1 = tm.TestKitLotNumber1
    AND CAST(a.DateExtracted AS DATE) = tm.MaxDateExtracted AND a.ID = tm.MaxID
  WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = a.PatientPk
                AND CAST(o.o_custkey % 5 + 1 AS INTEGER) = a.SiteCode)),
clean AS (
  SELECT SiteCode, PatientPk, HtsNumber, EncounterId,
         CASE WHEN TestKitName1 = '' THEN NULL ELSE TestKitName1 END AS TestKitName1, TestKitLotNumber1,
         CASE WHEN TestResult2 = 'N/A' THEN NULL ELSE TestResult2 END AS TestResult2,
         CASE WHEN TestKitName2 = '' THEN NULL ELSE TestKitName2 END AS TestKitName2
  FROM scan)
SELECT {_null_cols(spec, have)}, {_UTF16_SQL.format(c='HtsNumber')} AS HtsNumberHash,
       {_UTF16_SQL.format(c='PatientPk')} AS PatientPKHash
FROM clean x WHERE NOT EXISTS (SELECT 1 FROM lineitem t WHERE t.l_shipdate < TIMESTAMP '1996-01-01'
  AND t.l_orderkey IS NOT DISTINCT FROM x.PatientPk
  AND CAST(t.l_suppkey % 5 + 1 AS INTEGER) IS NOT DISTINCT FROM x.SiteCode)"""


@query("load_hts_test_kits", oracle=_p32_oracle())
def load_hts_test_kits(spark, sf):
    """The HTS test-kits load spec (P32) on the test tables: latest rule over six keys, client
    existence, N/A sentinel and blank kit names -> NULL, delta, digests."""
    spec, io = _p32_io(spark, sf)
    return _load(spec, io)


# =============================================================== contacts (P06), MNCH ARTs (P34), manifest (P13), OTZ
def _ct_parents(spark, sf, project=True):
    """PatientExtract <- customer, Facility <- nation (shared by the CT mappings below)."""
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    patient = c.select(
        F.col("c_custkey").alias("ID"), F.concat(F.lit("CCC"), F.col("c_custkey").cast("string")).alias("PatientCccNumber"),
        F.col("c_custkey").alias("PatientPID"),
        F.when(F.col("c_custkey") % 10 == 1, F.lit("Unknown")).otherwise(F.col("c_mktsegment")).alias("Gender"),
        F.col("c_nationkey").alias("FacilityId"), F.lit("KenyaEMR").alias("Emr"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("HMIS")).otherwise(F.lit("Other")).alias("Project"))
    facility = n.select(F.col("n_nationkey").alias("Id"), (F.col("n_nationkey") * 100).alias("Code"),
                        F.col("n_name").alias("Name"),
                        F.when(F.col("n_nationkey") % 12 == 10, F.lit(1)).when(F.col("n_nationkey") % 12 != 11, F.lit(0))
                         .alias("Voided"))
    return patient, facility


_CT_PARENTS_SQL = """
  JOIN customer c ON a.PatientRef = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
                                                AND n.n_nationkey % 12 < 10"""
_CT_COLS_SQL = """'CCC' || CAST(c.c_custkey AS VARCHAR) AS PatientID, c.c_custkey AS PatientPK,
         CASE WHEN c.c_custkey % 10 = 1 THEN 'Unknown' ELSE c.c_mktsegment END AS Gender, 'KenyaEMR' AS Emr,
         CASE WHEN c.c_custkey % 3 = 0 THEN 'Kenya HMIS II' ELSE 'Other' END AS Project,
         n.n_nationkey * 100 AS SiteCode, n.n_name AS FacilityName"""


def _p06_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p06_contact_listing"]
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    form = o.select(
        k.alias("ID"), F.col("o_custkey").alias("PatientId"), (k % 140 - 5).cast("string").alias("ContactAge"),
        F.col("o_orderdate").alias("Created"),
        F.when(k % 3 == 0, F.lit("U")).when(k % 3 == 1, F.lit("M")).otherwise(F.lit("F")).alias("ContactSex"),
        F.when(k % 5 == 0, F.lit("Son")).when(k % 5 == 1, F.lit("Co-wife")).when(k % 5 == 2, F.lit("Select"))
         .when(k % 5 == 3, F.lit("None")).otherwise(F.lit("Aunt")).alias("RelationshipWithPatient"),
        F.when(k % 4 == 0, F.lit("0")).when(k % 4 == 1, F.lit("Yes")).when(k % 4 == 2, F.lit("1065"))
         .otherwise(F.lit("x")).alias("IPVScreeningOutcome"),
        F.when(k % 4 == 0, F.lit("Positive")).when(k % 4 == 1, F.lit("1067")).when(k % 4 == 2, F.lit("Unknown"))
         .otherwise(F.lit("maybe")).alias("KnowledgeOfHivStatus"),
        (k + 100000).alias("ContactPatientPK"))
    patient, facility = _ct_parents(spark, sf)
    c = table(spark, sf, "customer")
    loaded = c.filter(F.col("c_custkey") % 3 == 1).select((F.col("c_nationkey") * 100).alias("SiteCode"),
                                                        F.col("c_custkey").alias("PatientPK"))
    return spec, FrameIO({"ContactListingExtract": form, "PatientExtract": patient, "Facility": facility},
                         {spec.target: loaded})


def _p06_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p06_contact_listing"]
    have = {"ID", "PatientID", "PatientPK", "SiteCode", "FacilityName", "Emr", "Project", "ContactAge", "ContactSex",
            "RelationshipWithPatient", "IPVScreeningOutcome", "KnowledgeOfHivStatus", "ContactPatientPK"}
    return f"""
WITH a AS (
  SELECT o_orderkey AS ID, o_custkey AS PatientRef, CAST(o_orderkey % 140 - 5 AS VARCHAR) AS ContactAge,
         o_orderdate AS Created,
         CASE o_orderkey % 3 WHEN 0 THEN 'U' WHEN 1 THEN 'M' ELSE 'F' END AS ContactSex,
         CASE o_orderkey % 5 WHEN 0 THEN 'Son' WHEN 1 THEN 'Co-wife' WHEN 2 THEN 'Select' WHEN 3 THEN 'None' ELSE 'Aunt' END
           AS RelationshipWithPatient,
         CASE o_orderkey % 4 WHEN 0 THEN '0' WHEN 1 THEN 'Yes' WHEN 2 THEN '1065' ELSE 'x' END AS IPVScreeningOutcome,
         CASE o_orderkey % 4 WHEN 0 THEN 'Positive' WHEN 1 THEN '1067' WHEN 2 THEN 'Unknown' ELSE 'maybe' END
           AS KnowledgeOfHivStatus,
         o_orderkey + 100000 AS ContactPatientPK
  FROM orders),
j AS (SELECT a.*, {_CT_COLS_SQL} FROM a {_CT_PARENTS_SQL}),
tn AS (SELECT PatientPK, SiteCode, ContactAge, max(CAST(Created AS DATE)) AS MaxCreated FROM j
       GROUP BY PatientPK, SiteCode, ContactAge),
scan AS (
  SELECT DISTINCT j.ID, j.PatientID, j.PatientPK, j.SiteCode, j.FacilityName, j.Emr, j.Project, j.ContactAge,
         j.ContactSex, j.RelationshipWithPatient, j.IPVScreeningOutcome, j.KnowledgeOfHivStatus, j.ContactPatientPK
  FROM j JOIN tn ON j.PatientPK = tn.PatientPK AND j.SiteCode = tn.SiteCode AND j.ContactAge = tn.ContactAge
                AND CAST(j.Created AS DATE) = tn.MaxCreated
  WHERE j.Gender <> 'Unknown' AND j.SiteCode > 0),
clean AS (
  SELECT ID, PatientID, PatientPK, SiteCode, FacilityName, Emr, Project,
         CASE WHEN TRY_CAST(ContactAge AS DOUBLE) < 0 OR TRY_CAST(ContactAge AS DOUBLE) > 120 THEN '999'
              ELSE ContactAge END AS ContactAge,
         CASE ContactSex WHEN 'U' THEN 'Undefined' WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' ELSE ContactSex END
           AS ContactSex,
         CASE WHEN RelationshipWithPatient IN ('Daughter', 'Son') THEN 'Child'
              WHEN RelationshipWithPatient = 'Co-wife' THEN 'Sexual Partner'
              WHEN RelationshipWithPatient = 'Select' THEN 'OTHER'
              WHEN RelationshipWithPatient IN ('undefined', 'None') THEN 'Undefined'
              WHEN RelationshipWithPatient = 'Nice' THEN 'Niece' ELSE RelationshipWithPatient END
           AS RelationshipWithPatient,
         CASE WHEN IPVScreeningOutcome IN ('0', 'No') THEN 'False' WHEN IPVScreeningOutcome = 'Yes' THEN 'True'
              WHEN IPVScreeningOutcome IN ('1065', '1066') THEN 'OTHER' ELSE IPVScreeningOutcome END
           AS IPVScreeningOutcome,
         CASE WHEN KnowledgeOfHivStatus IN ('Negative', 'Yes', 'Positive', 'Exposed Infant', 'Exposed', '664', '703')
                THEN 'Yes'
              WHEN KnowledgeOfHivStatus IN ('No', 'Unknown', '1067', '0') THEN 'No' ELSE KnowledgeOfHivStatus END
           AS KnowledgeOfHivStatus,
         ContactPatientPK
  FROM scan)
SELECT {_null_cols(spec, have)}, {_UTF16_SQL.format(c='PatientID')} AS PatientIDHash,
       {_UTF16_SQL.format(c='PatientPK')} AS PatientPKHash,
       {_UTF16_SQL.format(c='ContactPatientPK')} AS ContactPatientPKHash
FROM clean x WHERE NOT EXISTS (SELECT 1 FROM customer t WHERE t.c_custkey % 3 = 1
  AND t.c_nationkey * 100 IS NOT DISTINCT FROM x.SiteCode AND t.c_custkey IS NOT DISTINCT FROM x.PatientPK)"""


@query("load_contact_listing", oracle=_p06_oracle())
def load_contact_listing(spark, sf):
    """The contact-listing load spec (P06) on the test tables: latest rule by day with the
    contact's age as a key (ties survive), age clamp, sex / relationship / IPV / HIV-knowledge
    recodes, three digests."""
    spec, io = _p06_io(spark, sf)
    return _load(spec, io)


def _p34_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p34_arts"]
    o = table(spark, sf, "orders")
    n = table(spark, sf, "nation")
    ck = F.col("o_custkey")
    form = o.select(
        F.col("o_orderkey").alias("ID"), ck.alias("PatientPk"), (ck % 10 + 1).cast("int").alias("SiteCode"),
        (ck % 25).cast("int").alias("FacilityId"),
        F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 5).cast("int")).alias("DateExtracted"),
        F.concat(F.lit("MN"), ck.cast("string")).alias("PatientMnchID"), F.to_date("o_orderdate").alias("StartARTDate"),
        F.col("o_orderpriority").alias("StartRegimen"), F.col("o_orderstatus").alias("Status"),
        F.lit("KenyaEMR").alias("Emr"))
    facilities = n.filter(F.col("n_regionkey") != 4).select(F.col("n_nationkey").alias("Id"),
                                                            F.col("n_name").alias("Name"))
    loaded = o.filter(F.col("o_orderdate") < ntz(dt.datetime(1995, 4, 1))).select(
        ck.alias("PatientPk"), (ck % 10 + 1).cast("int").alias("SiteCode"))
    return spec, FrameIO({"MnchArts": form, "Facilities": facilities}, {spec.target: loaded})


def _p34_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p34_arts"]
    have = {"PatientPk", "SiteCode", "Emr", "Status", "DateExtracted", "PatientMnchID", "StartARTDate", "StartRegimen"}
    return f"""
WITH p AS (
  SELECT o_orderkey AS ID, o_custkey AS PatientPk, CAST(o_custkey % 10 + 1 AS INTEGER) AS SiteCode,
         CAST(o_custkey % 25 AS INTEGER) AS FacilityId,
         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INTEGER) AS DateExtracted,
         'MN' || CAST(o_custkey AS VARCHAR) AS PatientMnchID, CAST(o_orderdate AS DATE) AS StartARTDate,
         o_orderpriority AS StartRegimen, o_orderstatus AS Status, 'KenyaEMR' AS Emr
  FROM orders),
tm AS (SELECT PatientPk, SiteCode, max(ID) AS MaxID, max(CAST(DateExtracted AS DATE)) AS MaxDateExtracted
       FROM p GROUP BY PatientPk, SiteCode),
scan AS (
  SELECT DISTINCT p.PatientPk, p.SiteCode, p.Emr, p.Status, p.DateExtracted, p.PatientMnchID, p.StartARTDate,
         p.StartRegimen
  FROM p JOIN tm ON p.PatientPk = tm.PatientPk AND p.SiteCode = tm.SiteCode
                AND CAST(p.DateExtracted AS DATE) = tm.MaxDateExtracted AND p.ID = tm.MaxID
  WHERE EXISTS (SELECT 1 FROM nation f WHERE f.n_regionkey <> 4 AND f.n_nationkey = p.FacilityId))
SELECT {_null_cols(spec, have)}, {_UTF16_SQL.format(c='PatientMnchID')} AS PatientMnchIDHash,
       {_UTF16_SQL.format(c='PatientPk')} AS PatientPKHash
FROM scan x WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderdate < TIMESTAMP '1995-04-01'
  AND t.o_custkey IS NOT DISTINCT FROM x.PatientPk
  AND CAST(t.o_custkey % 10 + 1 AS INTEGER) IS NOT DISTINCT FROM x.SiteCode)"""


@query("load_mnch_arts", oracle=_p34_oracle())
def load_mnch_arts(spark, sf):
    """The MNCH ART load spec (P34) on the test tables: latest rule over the form, facility
    existence (semi join), delta on (patient, site), digests."""
    spec, io = _p34_io(spark, sf)
    return _load(spec, io)


def _p13_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p13_facility_manifest"]
    s = table(spark, sf, "supplier")
    sk = F.col("s_suppkey")
    form = s.select(
        sk.alias("ID"), (sk % 11 == 0).alias("Voided"), F.col("s_nationkey").alias("SiteCode"),
        F.floor(F.col("s_acctbal")).alias("PatientCount"), F.col("s_name").alias("Name"),
        F.lit("KenyaEMR").alias("EmrName"), F.date_add(F.lit(dt.date(2020, 1, 1)), sk.cast("int")).alias("Start"),
        F.date_add(F.lit(dt.date(2020, 1, 2)), sk.cast("int")).alias("End"))
    loaded = s.filter(sk % 3 == 1).select(sk.alias("ID"))
    return spec, FrameIO({"FacilityManifest": form}, {spec.target: loaded})


def _p13_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p13_facility_manifest"]
    have = {"ID", "Voided", "SiteCode", "PatientCount", "Name", "EmrName", "Start", "End"}
    cols = ", ".join(f'"{c}"' if c in have else f"CAST(NULL AS VARCHAR) AS \"{c}\"" for c in spec.columns)
    return f"""
WITH s AS (
  SELECT DISTINCT s_suppkey AS ID, (s_suppkey % 11 = 0) AS Voided, s_nationkey AS SiteCode,
         CAST(floor(s_acctbal) AS BIGINT) AS PatientCount, s_name AS Name, 'KenyaEMR' AS EmrName,
         DATE '2020-01-01' + CAST(s_suppkey AS INTEGER) AS "Start", DATE '2020-01-02' + CAST(s_suppkey AS INTEGER) AS "End"
  FROM supplier)
SELECT {cols} FROM s WHERE NOT EXISTS (SELECT 1 FROM supplier t WHERE t.s_suppkey % 3 = 1
  AND t.s_suppkey IS NOT DISTINCT FROM s.ID)"""


@query("load_facility_manifest", oracle=_p13_oracle())
def load_facility_manifest(spark, sf):
    """The facility-manifest load spec (P13) on the test tables: reserved column names, delta on
    the manifest id."""
    spec, io = _p13_io(spark, sf)
    return _load(spec, io)


# =============================================================== eligibility (P29), behaviour risk (P46), CWC visits
_P29_FEED = Feed(
    "p29_eligibility", "event_id",
    "ID,SiteCode,PatientPk,HtsNumber,EncounterId,VisitID,TypeGBV,WeightLoss,PatientType,DateTestedProvider,VisitDate",
    blank="ReceivedServices,ResultOfHIVSelf,ReasonsForIneligibility,ChildReasonsForIneligibility,PartnerHIVStatus,"
          "RelationshipWithContact",
    made={c: (f"CASE event_id % {n} WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '' WHEN 3 THEN 'unsure' END",
              f"CASE {c} WHEN '0' THEN 'No' WHEN '1' THEN 'Yes' ELSE {c} END")
          for c, n in (("NightSweats", 4), ("Pregnant", 5), ("Cough", 7), ("IsHealthWorker", 6))})


def _p29_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p29_eligibility"]
    e = table(spark, sf, "events")
    eid = F.col("event_id")
    site = (eid % 3 + 1).cast("int")
    day = F.to_date("ts")
    form = e.select(
        eid.alias("ID"), site.alias("SiteCode"), F.col("user_id").alias("PatientPk"),
        F.concat(F.lit("H"), F.col("user_id").cast("string")).alias("HtsNumber"), (eid % 5).alias("EncounterId"),
        F.concat(F.lit("EV"), (eid % 7).cast("string")).alias("VisitID"), F.col("ts").alias("DateCreated"),
        F.date_add(day, (eid % 3).cast("int")).alias("DateExtracted"),
        F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("event_type")).alias("TypeGBV"),
        (eid % 3).cast("string").alias("WeightLoss"),
        F.when(eid % 2 == 0, F.lit("HP:Hospital Patient")).otherwise(F.lit("NP:Non-Hospital Patient")).alias("PatientType"),
        F.when(eid % 9 == 0, F.lit(dt.date(1975, 1, 1))).otherwise(day).alias("DateTestedProvider"),
        F.date_sub(day, (eid % 2000).cast("int")).alias("VisitDate"), *_P29_FEED.columns())
    clients = e.filter(F.col("event_type") != "signup").select(
        F.col("user_id").alias("PatientPk"), site.alias("SiteCode")).distinct()
    loaded = e.filter(F.col("ts") < ntz(dt.datetime(2024, 1, 2))).select(
        F.col("user_id").alias("PatientPk"), site.alias("SiteCode"))
    return spec, FrameIO({"HtsEligibilityExtract": form, "Clients": clients}, {spec.target: loaded})


def _p29_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p29_eligibility"]
    have = {"ID", "SiteCode", "PatientPk", "HtsNumber", "EncounterId", "VisitID", "TypeGBV", "WeightLoss",
            "PatientType", "DateTestedProvider", "VisitDate", *_P29_FEED.form}
    return f"""
WITH a AS (
  SELECT event_id AS ID, CAST(event_id % 3 + 1 AS INTEGER) AS SiteCode, user_id AS PatientPk,
         'H' || CAST(user_id AS VARCHAR) AS HtsNumber, event_id % 5 AS EncounterId,
         'EV' || CAST(event_id % 7 AS VARCHAR) AS VisitID, ts AS DateCreated,
         CAST(ts AS DATE) + CAST(event_id % 3 AS INTEGER) AS DateExtracted,
         CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS TypeGBV,
         CAST(event_id % 3 AS VARCHAR) AS WeightLoss,
         CASE WHEN event_id % 2 = 0 THEN 'HP:Hospital Patient' ELSE 'NP:Non-Hospital Patient' END AS PatientType,
         CASE WHEN event_id % 9 = 0 THEN DATE '1975-01-01' ELSE CAST(ts AS DATE) END AS DateTestedProvider,
         CAST(ts AS DATE) - CAST(event_id % 2000 AS INTEGER) AS VisitDate, {_P29_FEED.form_sql}
  FROM events),
tn AS (SELECT SiteCode, PatientPk, EncounterId, VisitID, max(ID) AS MaxID, max(DateCreated) AS MaxDateCreated
       FROM a GROUP BY SiteCode, PatientPk, EncounterId, VisitID),
tn1 AS (SELECT SiteCode, PatientPk, EncounterId, VisitID, max(ID) AS MaxID,
               max(CAST(DateExtracted AS DATE)) AS MaxDateExtracted
        FROM a GROUP BY SiteCode, PatientPk, EncounterId, VisitID),
scan AS (
  SELECT DISTINCT a.ID, a.SiteCode, a.PatientPk, a.HtsNumber, a.EncounterId, a.VisitID, a.TypeGBV, a.WeightLoss,
         a.PatientType, a.DateTestedProvider, a.VisitDate, {_P29_FEED.names('a.')}
  FROM a JOIN tn ON a.SiteCode = tn.SiteCode AND a.PatientPk = tn.PatientPk AND a.DateCreated = tn.MaxDateCreated
                AND a.EncounterId = tn.EncounterId AND a.VisitID = tn.VisitID AND a.ID = tn.MaxID
         JOIN tn1 ON a.SiteCode = tn1.SiteCode AND a.PatientPk = tn1.PatientPk
                AND CAST(a.DateExtracted AS DATE) = tn1.MaxDateExtracted AND a.EncounterId = tn1.EncounterId
                AND a.VisitID = tn1.VisitID AND a.ID = tn1.MaxID
  WHERE EXISTS (SELECT 1 FROM events c WHERE c.event_type <> 'signup' AND c.user_id = a.PatientPk
                AND CAST(c.event_id % 3 + 1 AS INTEGER) = a.SiteCode)),
clean AS (
  SELECT ID, SiteCode, PatientPk, HtsNumber, EncounterId, VisitID,
         CASE WHEN TypeGBV = '' THEN NULL ELSE TypeGBV END AS TypeGBV,
         CASE WeightLoss WHEN '0' THEN 'No' WHEN '1' THEN 'Yes' ELSE WeightLoss END AS WeightLoss,
         CASE PatientType WHEN 'HP:Hospital Patient' THEN 'Hospital Patient'
              WHEN 'NP:Non-Hospital Patient' THEN 'Non-Hospital Patient' ELSE PatientType END AS PatientType,
         CASE WHEN DateTestedProvider < DATE '1980-01-01' THEN NULL ELSE DateTestedProvider END AS DateTestedProvider,
         CASE WHEN VisitDate < DATE '2019-01-01' THEN NULL ELSE VisitDate END AS VisitDate,
         {_P29_FEED.rule_sql}
  FROM scan)
SELECT {_null_cols(spec, have)}, {_UTF16_SQL.format(c='HtsNumber')} AS HtsNumberHash,
       {_UTF16_SQL.format(c='PatientPk')} AS PatientPKHash
FROM clean x WHERE NOT EXISTS (SELECT 1 FROM events t WHERE t.ts < TIMESTAMP '2024-01-02'
  AND t.user_id IS NOT DISTINCT FROM x.PatientPk AND CAST(t.event_id % 3 + 1 AS INTEGER) IS NOT DISTINCT FROM x.SiteCode)"""


@query("load_hts_eligibility", oracle=_p29_oracle())
def load_hts_eligibility(spark, sf):
    """The HTS eligibility load spec (P29) on the test tables: two latest rules ANDed (newest
    creation timestamp, newest extraction day), client existence, blank / 0-1 / patient-type
    recodes, dates before 1980 and visits before 2019 -> NULL, delta, digests."""
    spec, io = _p29_io(spark, sf)
    return build_load(spec, io, AS_OF)


_P46_FEED = Feed(
    "p46_behaviour_risk", "event_id",
    "Created,PatientPk,SiteCode,DateExtracted,VisitID,PrepNumber,ClientRisk,SexPartnerHIVStatus",
    blank="NumberofchildrenWithPartner,SexWithoutCondom,MonthsknownHIVSerodiscordant,HIVPartnerARTStartDate,"
          "PartnerEnrolledtoCCC,ReferralToOtherPrevServices,RiskReductionEducationOffered,PrEPDeclineReason,"
          "ClientWillingToTakePrep,IsPartnerHighrisk,IsHIVPositivePartnerCurrentonART")


def _p46_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p46_behaviour_risk"]
    e = table(spark, sf, "events")
    eid = F.col("event_id")
    site = (eid % 3 + 1).cast("int")
    form = e.select(
        eid.alias("ID"), F.col("user_id").alias("PatientPk"), site.alias("SiteCode"), F.col("ts").alias("Created"),
        F.date_add(F.to_date("ts"), (eid % 3).cast("int")).alias("DateExtracted"),
        F.concat(F.lit("BR"), (eid % 5).cast("string")).alias("VisitID"),
        F.concat(F.lit("PREP-"), F.col("user_id").cast("string")).alias("PrepNumber"),
        F.when(eid % 4 == 0, F.lit("")).otherwise(F.lit("High")).alias("ClientRisk"),
        F.when(eid % 6 == 0, F.lit("")).otherwise(F.lit("Positive")).alias("SexPartnerHIVStatus"),
        *_P46_FEED.columns())
    patients = e.filter(F.col("event_type") != "error").select(
        F.col("user_id").alias("PatientPk"), site.alias("SiteCode")).distinct()
    loaded = e.filter(F.col("ts") < ntz(dt.datetime(2024, 1, 8))).select(
        F.col("user_id").alias("PatientPk"), site.alias("SiteCode"),
        F.concat(F.lit("BR"), (eid % 5).cast("string")).alias("VisitID"))
    return spec, FrameIO({"PrepBehaviourRisks": form, "PrepPatients": patients}, {spec.target: loaded})


def _p46_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p46_behaviour_risk"]
    have = {"Created", "PatientPk", "SiteCode", "DateExtracted", "VisitID", "PrepNumber", "ClientRisk",
            "SexPartnerHIVStatus", *_P46_FEED.form}
    return f"""
WITH a AS (
  SELECT event_id AS ID, user_id AS PatientPk, CAST(event_id % 3 + 1 AS INTEGER) AS SiteCode, ts AS Created,
         CAST(ts AS DATE) + CAST(event_id % 3 AS INTEGER) AS DateExtracted,
         'BR' || CAST(event_id % 5 AS VARCHAR) AS VisitID, 'PREP-' || CAST(user_id AS VARCHAR) AS PrepNumber,
         CASE WHEN event_id % 4 = 0 THEN '' ELSE 'High' END AS ClientRisk,
         CASE WHEN event_id % 6 = 0 THEN '' ELSE 'Positive' END AS SexPartnerHIVStatus, {_P46_FEED.form_sql}
  FROM events),
tn AS (SELECT PatientPk, SiteCode, max(ID) AS MaxID, max(CAST(Created AS DATE)) AS maxCreated FROM a
       GROUP BY PatientPk, SiteCode),
tm AS (SELECT PatientPk, SiteCode, max(CAST(DateExtracted AS DATE)) AS maxDateExtracted FROM a
       GROUP BY PatientPk, SiteCode),
scan AS (
  SELECT DISTINCT a.Created, a.PatientPk, a.SiteCode, a.DateExtracted, a.VisitID, a.PrepNumber, a.ClientRisk,
         a.SexPartnerHIVStatus, {_P46_FEED.names('a.')}
  FROM a JOIN tn ON a.PatientPk = tn.PatientPk AND a.SiteCode = tn.SiteCode
                AND CAST(a.Created AS DATE) = tn.maxCreated AND a.ID = tn.MaxID
         JOIN tm ON a.PatientPk = tm.PatientPk AND a.SiteCode = tm.SiteCode
                AND CAST(a.DateExtracted AS DATE) = tm.maxDateExtracted
  WHERE EXISTS (SELECT 1 FROM events b WHERE b.event_type <> 'error' AND b.user_id = a.PatientPk
                AND CAST(b.event_id % 3 + 1 AS INTEGER) = a.SiteCode)),
clean AS (
  SELECT Created, PatientPk, SiteCode, DateExtracted, VisitID, PrepNumber,
         CASE WHEN ClientRisk = '' THEN NULL ELSE ClientRisk END AS ClientRisk,
         CASE WHEN SexPartnerHIVStatus = '' THEN NULL ELSE SexPartnerHIVStatus END AS SexPartnerHIVStatus,
         {_P46_FEED.rule_sql}
  FROM scan)
SELECT {_null_cols(spec, have)}, {_UTF16_SQL.format(c='PrepNumber')} AS PrepNumberHash,
       {_UTF16_SQL.format(c='PatientPk')} AS PatientPKHash
FROM clean x WHERE NOT EXISTS (SELECT 1 FROM events t WHERE t.ts < TIMESTAMP '2024-01-08'
  AND t.user_id IS NOT DISTINCT FROM x.PatientPk AND CAST(t.event_id % 3 + 1 AS INTEGER) IS NOT DISTINCT FROM x.SiteCode
  AND 'BR' || CAST(t.event_id % 5 AS VARCHAR) IS NOT DISTINCT FROM x.VisitID)"""


@query("load_prep_behaviour_risk", oracle=_p46_oracle())
def load_prep_behaviour_risk(spark, sf):
    """The PrEP behaviour-risk load spec (P46) on the test tables: newest (id, creation day) AND
    newest extraction day (no id in the second rule), patient existence, blank -> NULL, delta on
    (patient, site, visit), digests."""
    spec, io = _p46_io(spark, sf)
    return build_load(spec, io, AS_OF)


_P36_FEED = Feed(
    "p36_cwc_visits", "o_orderkey", "PatientMnchID,PatientPk,SiteCode,DateExtracted,VisitDate,VisitID,Weight",
    made={"NextAppointment": ("CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderdate AS TIMESTAMP) END",
                              "CAST(NextAppointment AS DATE)")},
    spark={"NextAppointment": "CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderdate AS TIMESTAMP_NTZ) "
                              "+ make_interval(0, 0, 0, 0, 11) END"})


def _p36_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p36_cwc_visits"]
    o = table(spark, sf, "orders")
    n = table(spark, sf, "nation")
    ck, k = F.col("o_custkey"), F.col("o_orderkey")
    form = o.select(
        k.alias("ID"), ck.alias("PatientPk"), (ck % 10 + 1).cast("int").alias("SiteCode"),
        F.to_date("o_orderdate").alias("VisitDate"),
        F.date_add(F.to_date("o_orderdate"), (k % 4).cast("int")).alias("DateExtracted"),
        (ck % 25).cast("int").alias("FacilityId"), F.concat(F.lit("MN"), ck.cast("string")).alias("PatientMnchID"),
        F.concat(F.lit("CV"), (k % 9).cast("string")).alias("VisitID"),
        F.floor(F.col("o_totalprice") / 1000).cast("string").alias("Weight"), *_P36_FEED.columns())
    facilities = n.select(F.col("n_nationkey").alias("Id"), F.col("n_name").alias("Name"))
    loaded = o.filter(F.col("o_orderdate") < ntz(dt.datetime(1995, 4, 1))).select(
        ck.alias("PatientPk"), (ck % 10 + 1).cast("int").alias("SiteCode"))
    return spec, FrameIO({"CwcVisits": form, "Facilities": facilities}, {spec.target: loaded})


def _p36_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p36_cwc_visits"]
    have = {"PatientMnchID", "PatientPk", "SiteCode", "DateExtracted", "VisitDate", "VisitID", "Weight", *_P36_FEED.form}
    return f"""
WITH p AS (
  SELECT o_orderkey AS ID, o_custkey AS PatientPk, CAST(o_custkey % 10 + 1 AS INTEGER) AS SiteCode,
         CAST(o_orderdate AS DATE) AS VisitDate, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 4 AS INTEGER) AS DateExtracted,
         CAST(o_custkey % 25 AS INTEGER) AS FacilityId, 'MN' || CAST(o_custkey AS VARCHAR) AS PatientMnchID,
         'CV' || CAST(o_orderkey % 9 AS VARCHAR) AS VisitID, CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) AS Weight,
         {_P36_FEED.form_sql}
  FROM orders),
tm AS (SELECT PatientPk, SiteCode, VisitDate, max(ID) AS MaxID, max(CAST(DateExtracted AS DATE)) AS MaxDateExtracted
       FROM p GROUP BY PatientPk, SiteCode, VisitDate),
scan AS (
  SELECT DISTINCT p.PatientMnchID, p.PatientPk, p.SiteCode, p.DateExtracted, p.VisitDate, p.VisitID, p.Weight,
         {_P36_FEED.rule_sql}
  FROM p JOIN tm ON p.PatientPk = tm.PatientPk AND p.SiteCode = tm.SiteCode
                AND CAST(p.DateExtracted AS DATE) = tm.MaxDateExtracted AND p.ID = tm.MaxID
  WHERE EXISTS (SELECT 1 FROM nation f WHERE f.n_nationkey = p.FacilityId))
SELECT {_null_cols(spec, have)}, {_UTF16_SQL.format(c='PatientMnchID')} AS PatientMnchIDHash,
       {_UTF16_SQL.format(c='PatientPk')} AS PatientPKHash
FROM scan x WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderdate < TIMESTAMP '1995-04-01'
  AND t.o_custkey IS NOT DISTINCT FROM x.PatientPk
  AND CAST(t.o_custkey % 10 + 1 AS INTEGER) IS NOT DISTINCT FROM x.SiteCode)"""


@query("load_cwc_visits", oracle=_p36_oracle())
def load_cwc_visits(spark, sf):
    """The CWC visits load spec (P36) on the test tables: latest rule grouped by visit date but
    joined on (patient, site) only – any row holding some visit date's maxima survives –,
    facility existence, delta, digests."""
    spec, io = _p36_io(spark, sf)
    return build_load(spec, io, AS_OF)


# =============================================================== IPT (P16), drug & alcohol (P10), PrEP pharmacy (P50)
def _ct_visit_form(o, extra: dict):
    k = F.col("o_orderkey")
    own = {"ID": k, "PatientId": F.col("o_custkey"), "VisitID": F.concat(F.lit("V"), (k % 11).cast("string")),
           "VisitDate": F.to_date("o_orderdate")}
    return o.select(*[e.alias(n) for n, e in (own | extra).items()])


def _twice_a_day(o):
    """Every order at two times of its day, for texts whose DISTINCT is over dates."""
    hour = F.explode(F.array(F.lit(3), F.lit(17)))
    return o.withColumn("hour", hour).withColumn("o_orderdate", F.date_trunc("day", "o_orderdate").cast("timestamp_ntz")
                                                 + F.make_interval(hours=F.col("hour"))).drop("hour")


_CT_VISIT_SQL = """o_orderkey AS ID, o_custkey AS PatientRef, 'V' || CAST(o_orderkey % 11 AS VARCHAR) AS VisitID,
         CAST(o_orderdate AS DATE) AS VisitDate"""


def _ct_visit_job(spark, sf, spec_name, source, extra, form_rows=lambda o: o):
    from wardflow.plans.catalog import SPECS
    spec = SPECS[spec_name]
    o = table(spark, sf, "orders")
    patient, facility = _ct_parents(spark, sf)
    c = table(spark, sf, "customer")
    loaded = o.filter(F.col("o_orderdate") < ntz(dt.datetime(1998, 1, 1))).join(c, F.col("o_custkey") == F.col("c_custkey")) \
        .select((F.col("c_nationkey") * 100).alias("SiteCode"), F.col("o_custkey").alias("PatientPK"),
                F.concat(F.lit("V"), (F.col("o_orderkey") % 11).cast("string")).alias("VisitID"))
    return spec, FrameIO({source: _ct_visit_form(form_rows(o), extra), "PatientExtract": patient, "Facility": facility},
                         {spec.target: loaded})


def _ct_visit_oracle(spec_name, extra_sql: str, extra_cols: list, clean_sql: str,
                     project_map: bool = True, patient_id: bool = False, feed: Feed | None = None) -> str:
    """``project_map`` – the scan text maps the patient's project names (most CT texts);
    ``patient_id`` – its ID is the patient row's, not the form's."""
    from wardflow.plans.catalog import SPECS
    spec = SPECS[spec_name]
    cols_sql = _CT_COLS_SQL if project_map else _CT_COLS_SQL.replace("'Kenya HMIS II'", "'HMIS'")
    have = {"ID", "PatientID", "PatientPK", "SiteCode", "FacilityName", "VisitID", "VisitDate", "Emr", "Project",
            *extra_cols}
    cols = ", ".join(extra_cols)
    if feed:
        extra_sql, clean_sql = f"{extra_sql}, {feed.form_sql}", f"{clean_sql}, {feed.rule_sql}"
        cols, have = f"{cols}, {feed.names()}", have | set(feed.form)
    row_id = "PatientRef AS ID" if patient_id else "ID"
    return f"""
WITH a AS (SELECT {_CT_VISIT_SQL}, {extra_sql} FROM orders),
j AS (SELECT a.*, {cols_sql} FROM a {_CT_PARENTS_SQL}),
scan AS (SELECT DISTINCT {row_id}, PatientID, PatientPK, SiteCode, FacilityName, VisitID, VisitDate, Emr, Project, {cols}
         FROM j WHERE Gender <> 'Unknown' AND SiteCode > 0),
clean AS (SELECT ID, PatientID, PatientPK, SiteCode, FacilityName, VisitID, VisitDate, Emr, Project, {clean_sql}
          FROM scan),
tgt AS (SELECT c.c_nationkey * 100 AS SiteCode, o.o_custkey AS PatientPK, 'V' || CAST(o.o_orderkey % 11 AS VARCHAR) AS VisitID
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderdate < TIMESTAMP '1998-01-01')
SELECT {_null_cols(spec, have)}, {_UTF16_SQL.format(c='PatientID')} AS PatientIDHash,
       {_UTF16_SQL.format(c='PatientPK')} AS PatientPKHash
FROM clean x WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.SiteCode IS NOT DISTINCT FROM x.SiteCode
  AND t.PatientPK IS NOT DISTINCT FROM x.PatientPK AND t.VisitID IS NOT DISTINCT FROM x.VisitID)"""


def _p16_extra():
    return {
        "TBScreening": F.when(F.col("o_orderkey") % 4 == 0, F.lit("1")).when(F.col("o_orderkey") % 4 == 1,
                                                                             F.lit("TB Screening not done"))
        .otherwise(F.lit("Done")),
        "IndicationForIPT": F.when(F.col("o_orderkey") % 5 == 0, F.lit("Poor adherence"))
        .when(F.col("o_orderkey") % 5 == 1, F.lit("Pregnancy")).when(F.col("o_orderkey") % 5 == 2, F.lit("Client Traced back a"))
        .otherwise(F.col("o_orderpriority")),
        "OnIPT": F.col("o_orderstatus"),
    }
_P16_SQL = """CASE o_orderkey % 4 WHEN 0 THEN '1' WHEN 1 THEN 'TB Screening not done' ELSE 'Done' END AS TBScreening,
         CASE o_orderkey % 5 WHEN 0 THEN 'Poor adherence' WHEN 1 THEN 'Pregnancy' WHEN 2 THEN 'Client Traced back a'
              ELSE o_orderpriority END AS IndicationForIPT, o_orderstatus AS OnIPT"""
_P16_CLEAN = """CASE WHEN TBScreening = '1' THEN 'Screened' WHEN TBScreening IN ('TB Screening not done', '0')
              THEN 'Not Screened' ELSE TBScreening END AS TBScreening,
         CASE WHEN IndicationForIPT IN ('Adherence Issues', 'Poor adherence') THEN 'Adherence Issues'
              WHEN IndicationForIPT = 'Client Traced back a' THEN 'Client Traced back'
              WHEN IndicationForIPT IN ('No more drug Interru', 'Toxicity Resolved', 'Other patient decisi', 'Pregnancy',
                                        'Patient declined', 'Other', 'High CD4', 'Education', 'Client Discharged fr')
              THEN 'OTHER' ELSE IndicationForIPT END AS IndicationForIPT, OnIPT"""


@query("load_ipt", oracle=_ct_visit_oracle("p16_ipt", _P16_SQL, ["TBScreening", "IndicationForIPT", "OnIPT"],
                                           _P16_CLEAN, patient_id=True))
def load_ipt(spark, sf):
    """The IPT load spec (P16) on the test tables: patient / facility joins with filters, in-scan
    project map, TB-screening and IPT-indication recodes, delta on (site, patient, visit)."""
    spec, io = _ct_visit_job(spark, sf, "p16_ipt", "IptExtract", _p16_extra())
    return _load(spec, io)


def _p10_extra():
    return {
        "DrinkingAlcohol": F.when(F.col("o_orderkey") % 3 == 0, F.lit("No")).when(F.col("o_orderkey") % 3 == 1, F.lit("Yes"))
        .otherwise(F.lit("Sometimes")),
        "Smoking": F.when(F.col("o_orderkey") % 2 == 0, F.lit("No")).otherwise(F.lit("Yes")),
        "DrugUse": F.col("o_orderstatus"),
    }
_P10_SQL = """CASE o_orderkey % 3 WHEN 0 THEN 'No' WHEN 1 THEN 'Yes' ELSE 'Sometimes' END AS DrinkingAlcohol,
         CASE WHEN o_orderkey % 2 = 0 THEN 'No' ELSE 'Yes' END AS Smoking, o_orderstatus AS DrugUse"""
_P10_CLEAN = """CASE DrinkingAlcohol WHEN 'No' THEN 'Never' WHEN 'Yes' THEN 'OTHER' ELSE DrinkingAlcohol END AS DrinkingAlcohol,
         CASE Smoking WHEN 'No' THEN 'Never' WHEN 'Yes' THEN 'OTHER' ELSE Smoking END AS Smoking, DrugUse"""


@query("load_drug_alcohol_screening", oracle=_ct_visit_oracle("p10_drug_alcohol_screening", _P10_SQL,
                                                               ["DrinkingAlcohol", "Smoking", "DrugUse"], _P10_CLEAN))
def load_drug_alcohol_screening(spark, sf):
    """The drug & alcohol screening load spec (P10) on the test tables: patient / facility joins,
    Never / OTHER recodes, delta on (site, patient, visit)."""
    spec, io = _ct_visit_job(spark, sf, "p10_drug_alcohol_screening", "DrugAlcoholScreeningExtract", _p10_extra())
    return _load(spec, io)


def _p50_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p50_pharmacy"]
    e = table(spark, sf, "events")
    eid = F.col("event_id")
    site = (eid % 3 + 1).cast("int")
    form = e.select(
        eid.alias("ID"), F.col("user_id").alias("PatientPk"), site.alias("SiteCode"), F.col("ts").alias("Created"),
        F.date_add(F.to_date("ts"), (eid % 2).cast("int")).alias("DateExtracted"),
        F.concat(F.lit("PH"), (eid % 6).cast("string")).alias("VisitID"),
        F.concat(F.lit("PREP-"), F.col("user_id").cast("string")).alias("PrepNumber"),
        F.when(eid % 5 == 0, F.lit("")).otherwise(F.lit("TDF/FTC")).alias("RegimenPrescribed"),
        F.when(eid % 8 == 0, F.lit("")).when(eid % 8 == 1, F.lit("1979-12-31"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("DispenseDate"),
        (eid % 16).cast("string").alias("Duration"))
    loaded = e.filter(F.col("ts") < ntz(dt.datetime(2024, 1, 8))).select(
        F.col("user_id").alias("PatientPk"), site.alias("SiteCode"),
        F.concat(F.lit("PH"), (eid % 6).cast("string")).alias("VisitID"))
    return spec, FrameIO({"PrepPharmacys": form}, {spec.target: loaded})


def _p50_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p50_pharmacy"]
    have = {"ID", "Created", "PatientPk", "SiteCode", "DateExtracted", "PrepNumber", "VisitID", "RegimenPrescribed",
            "DispenseDate", "Duration"}
    return f"""
WITH a AS (
  SELECT event_id AS ID, user_id AS PatientPk, CAST(event_id % 3 + 1 AS INTEGER) AS SiteCode, ts AS Created,
         CAST(ts AS DATE) + CAST(event_id % 2 AS INTEGER) AS DateExtracted,
         'PH' || CAST(event_id % 6 AS VARCHAR) AS VisitID, 'PREP-' || CAST(user_id AS VARCHAR) AS PrepNumber,
         CASE WHEN event_id % 5 = 0 THEN '' ELSE 'TDF/FTC' END AS RegimenPrescribed,
         CASE event_id % 8 WHEN 0 THEN '' WHEN 1 THEN '1979-12-31' ELSE strftime(ts, '%Y-%m-%d') END AS DispenseDate,
         CAST(event_id % 16 AS VARCHAR) AS Duration
  FROM events),
tn AS (SELECT PatientPk, SiteCode, max(ID) AS MaxID, max(CAST(Created AS DATE)) AS MaxCreated FROM a
       GROUP BY PatientPk, SiteCode),
tm AS (SELECT PatientPk, SiteCode, max(ID) AS MaxID, max(CAST(DateExtracted AS DATE)) AS MaxExtracted FROM a
       GROUP BY PatientPk, SiteCode),
scan AS (
  SELECT DISTINCT a.ID, a.Created, a.PatientPk, a.SiteCode, a.DateExtracted, a.PrepNumber, a.VisitID,
         a.RegimenPrescribed, a.DispenseDate, a.Duration
  FROM a JOIN tn ON a.PatientPk = tn.PatientPk AND a.SiteCode = tn.SiteCode
                AND CAST(a.Created AS DATE) = tn.MaxCreated AND a.ID = tn.MaxID
         JOIN tm ON a.PatientPk = tm.PatientPk AND a.SiteCode = tm.SiteCode
                AND CAST(a.DateExtracted AS DATE) = tm.MaxExtracted AND a.ID = tm.MaxID),
clean AS (
  SELECT ID, Created, PatientPk, SiteCode, DateExtracted, PrepNumber, VisitID,
         CASE WHEN RegimenPrescribed = '' THEN NULL ELSE RegimenPrescribed END AS RegimenPrescribed,
         CASE WHEN DispenseDate = '' OR TRY_CAST(DispenseDate AS DATE) < DATE '1980-01-01' THEN NULL ELSE DispenseDate END
           AS DispenseDate,
         CASE WHEN TRY_CAST(Duration AS DOUBLE) > 12 THEN NULL ELSE Duration END AS Duration
  FROM scan)
SELECT {_null_cols(spec, have)}, {_UTF16_SQL.format(c='PrepNumber')} AS PrepNumberHash,
       {_UTF16_SQL.format(c='PatientPk')} AS PatientPKHash
FROM clean x WHERE NOT EXISTS (SELECT 1 FROM events t WHERE t.ts < TIMESTAMP '2024-01-08'
  AND t.user_id IS NOT DISTINCT FROM x.PatientPk AND CAST(t.event_id % 3 + 1 AS INTEGER) IS NOT DISTINCT FROM x.SiteCode
  AND 'PH' || CAST(t.event_id % 6 AS VARCHAR) IS NOT DISTINCT FROM x.VisitID)"""


@query("load_prep_pharmacy", oracle=_p50_oracle())
def load_prep_pharmacy(spark, sf):
    """The PrEP pharmacy load spec (P50) on the test tables: two latest rules ANDed, duration cap,
    text dispense dates before 1980 / blank -> NULL, blank regimen -> NULL, delta, digests."""
    spec, io = _p50_io(spark, sf)
    return _load(spec, io)


# =============================================================== adverse events
def _p02_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p02_adverse_events"]
    li = table(spark, sf, "lineitem")
    c = table(spark, sf, "customer")
    ln, pk = F.col("l_linenumber"), F.col("l_partkey")
    sd = F.to_date("l_shipdate")
    start = F.date_sub(sd, (F.col("l_orderkey") % 12000).cast("int"))
    form = li.select(
        pk.alias("PatientId"), sd.alias("VisitDate"), start.alias("AdverseEventStartDate"),
        F.date_add(start, 10).alias("AdverseEventEndDate"),
        F.when(ln % 4 == 0, F.lit("Mild|Mild|Mild")).when(ln % 4 == 1, F.lit("Fatal"))
         .when(ln % 4 == 2, F.lit("Moderate|Mild")).when(ln == 7, F.lit("2")).otherwise(F.lit("")).alias("Severity"),
        F.when(pk % 5 == 0, F.lit("efavirenz")).when(pk % 5 == 1, F.lit("isoniazid efavirenz"))
         .when(pk % 5 == 2, F.lit("INH")).when(pk % 5 == 3, F.lit("")).otherwise(F.lit("rash")).alias("AdverseEventCause"),
        F.when(ln % 4 == 0, F.lit("STOP|STOP")).when(ln % 4 == 1, F.lit("Dose reduced"))
         .when(ln % 4 == 2, F.lit("Select")).otherwise(F.lit("")).alias("AdverseEventActionTaken"),
        F.when(pk % 2 == 0, F.lit("Recovered/Resolved")).otherwise(F.lit("x")).alias("AdverseEventClinicalOutcome"),
        F.col("l_returnflag").alias("AdverseEventRegimen"), F.col("l_linestatus").alias("AdverseEvent"),
        F.concat(F.lit("Emr"), ln.cast("string")).alias("Emr"),
        F.when(ln % 2 == 0, F.lit("I-TECH")).otherwise(F.lit("Own")).alias("Project"))
    patient, facility = _ct_parents(spark, sf)
    regimen = li.filter(F.col("l_returnflag") == "A").select(F.lit("A").alias("source_name"),
                                                             F.lit("AF2B").alias("target_name")).distinct()
    events = li.filter(F.col("l_linestatus") == "F").select(F.lit("F").alias("source_name"),
                                                            F.lit("Rash").alias("target_name")).distinct()
    loaded = li.filter(F.col("l_shipdate") < ntz(dt.datetime(1997, 1, 1))).join(c, pk == F.col("c_custkey")) \
        .select((F.col("c_nationkey") * 100).alias("SiteCode"), F.col("c_custkey").alias("PatientPK"), sd.alias("VisitDate"))
    return spec, FrameIO({"PatientAdverseEventExtract": form, "PatientExtract": patient, "Facility": facility,
                          "lkp_regimen": regimen, "lkp_adverse_events": events}, {spec.target: loaded})


def _p02_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    from wardflow.plans import vocab as V
    spec = SPECS["p02_adverse_events"]

    def lst(xs):
        return ", ".join("'" + x.replace("'", "''") + "'" for x in xs)
    cause = V.AE_CAUSE
    have = {"PatientID", "PatientPK", "SiteCode", "AdverseEvent", "AdverseEventStartDate", "AdverseEventEndDate",
            "Severity", "VisitDate", "EMR", "Project", "AdverseEventCause", "AdverseEventRegimen",
            "AdverseEventActionTaken", "AdverseEventClinicalOutcome", "LoadDate"}
    return f"""
WITH a AS (
  SELECT l_partkey AS PatientRef, CAST(l_shipdate AS DATE) AS VisitDate,
         CAST(l_shipdate AS DATE) - CAST(l_orderkey % 12000 AS INTEGER) AS AdverseEventStartDate,
         CAST(l_shipdate AS DATE) - CAST(l_orderkey % 12000 AS INTEGER) + 10 AS AdverseEventEndDate,
         CASE WHEN l_linenumber = 7 THEN 'Moderate' WHEN l_linenumber % 4 = 0 THEN 'Mild|Mild|Mild'
              WHEN l_linenumber % 4 = 1 THEN 'Fatal' WHEN l_linenumber % 4 = 2 THEN 'Moderate|Mild' ELSE '' END AS Severity,
         CASE l_partkey % 5 WHEN 0 THEN 'efavirenz' WHEN 1 THEN 'isoniazid efavirenz' WHEN 2 THEN 'INH' WHEN 3 THEN ''
              ELSE 'rash' END AS AdverseEventCause,
         CASE l_linenumber % 4 WHEN 0 THEN 'STOP|STOP' WHEN 1 THEN 'Dose reduced' WHEN 2 THEN 'Select' ELSE '' END
           AS AdverseEventActionTaken,
         CASE WHEN l_partkey % 2 = 0 THEN 'Recovered/Resolved' ELSE 'x' END AS AdverseEventClinicalOutcome,
         l_returnflag AS AdverseEventRegimen, l_linestatus AS AdverseEvent,
         'Emr' || CAST(l_linenumber AS VARCHAR) AS EMR,
         CASE WHEN l_linenumber % 2 = 0 THEN 'I-TECH' ELSE 'Own' END AS Project
  FROM lineitem),
scan AS (
  SELECT DISTINCT 'CCC' || CAST(c.c_custkey AS VARCHAR) AS PatientID, c.c_custkey AS PatientPK,
         n.n_nationkey * 100 AS SiteCode, a.AdverseEvent, a.AdverseEventStartDate, a.AdverseEventEndDate, a.Severity,
         a.VisitDate, a.EMR, a.Project,
         a.AdverseEventCause, a.AdverseEventRegimen, a.AdverseEventActionTaken, a.AdverseEventClinicalOutcome
  FROM a JOIN customer c ON a.PatientRef = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE n.n_nationkey * 100 > 0 AND n.n_nationkey % 12 < 10),
clean AS (
  SELECT PatientID, PatientPK, SiteCode,
         CASE WHEN AdverseEventStartDate < DATE '1980-01-01' OR AdverseEventStartDate > DATE '2000-12-31'
              THEN DATE '1900-01-01' ELSE AdverseEventStartDate END AS AdverseEventStartDate,
         CASE WHEN AdverseEventEndDate < DATE '1980-01-01' OR AdverseEventEndDate > DATE '2000-12-31'
              THEN DATE '1900-01-01' ELSE AdverseEventEndDate END AS AdverseEventEndDate,
         CASE WHEN Severity IN ({lst(V.AE_SEVERITY['Mild'])}) THEN 'Mild'
              WHEN Severity IN ({lst(V.AE_SEVERITY['Moderate'])}) THEN 'Moderate'
              WHEN Severity IN ({lst(V.AE_SEVERITY['Severe'])}) THEN 'Severe'
              WHEN Severity IN ({lst(V.AE_SEVERITY['Unknown'])}) THEN 'Unknown'
              WHEN Severity = '' THEN NULL ELSE Severity END AS Severity,
         VisitDate, EMR, Project,
         CASE WHEN AdverseEventCause IN ({lst(cause['ARV'])}) THEN 'ARV'
              WHEN AdverseEventCause IN ({lst(cause['ARV + OTHER DRUGS'])}) THEN 'ARV + OTHER DRUGS'
              WHEN AdverseEventCause IN ({lst(cause['NON-ARVS'])}) THEN 'NON-ARVS'
              WHEN AdverseEventCause = '' THEN NULL ELSE AdverseEventCause END AS AdverseEventCause,
         AdverseEventRegimen, AdverseEvent,
         CASE WHEN AdverseEventActionTaken IN ({lst(V.AE_ACTION['Drug not Changed'])}) THEN 'Drug not Changed'
              WHEN AdverseEventActionTaken IN ({lst(V.AE_ACTION['Drug Reduced'])}) THEN 'Drug Reduced'
              WHEN AdverseEventActionTaken IN ({lst(V.AE_ACTION['Drug Substituted'])}) THEN 'Drug Substituted'
              WHEN AdverseEventActionTaken IN ({lst(V.AE_ACTION['Drug Withdrawn'])}) THEN 'Drug Withdrawn'
              WHEN AdverseEventActionTaken IN ({lst(V.AE_ACTION['OTHER'])}) THEN 'OTHER'
              WHEN AdverseEventActionTaken IN ({lst(V.AE_ACTION['Regimen Switched'])}) THEN 'Regimen Switched'
              WHEN AdverseEventActionTaken = '' THEN NULL ELSE AdverseEventActionTaken END AS AdverseEventActionTaken,
         CASE WHEN AdverseEventClinicalOutcome = 'Recovered/Resolved' THEN 'Recovered'
              WHEN AdverseEventClinicalOutcome = 'Recovering/Resolving' THEN 'Recovering'
              WHEN AdverseEventClinicalOutcome = 'Requires intervention to prevent permanent damage' THEN 'OTHER'
              WHEN AdverseEventClinicalOutcome = '' THEN NULL ELSE AdverseEventClinicalOutcome END
           AS AdverseEventClinicalOutcome,
         CAST(DATE '2000-12-31' AS TIMESTAMP) AS LoadDate
  FROM scan),
std AS (
  SELECT x.* REPLACE (coalesce(r.t, x.AdverseEventRegimen) AS AdverseEventRegimen, coalesce(e.t, x.AdverseEvent) AS AdverseEvent)
  FROM clean x
  LEFT JOIN (SELECT DISTINCT 'A' AS k, 'AF2B' AS t FROM lineitem WHERE l_returnflag = 'A') r ON x.AdverseEventRegimen = r.k
  LEFT JOIN (SELECT DISTINCT 'F' AS k, 'Rash' AS t FROM lineitem WHERE l_linestatus = 'F') e ON x.AdverseEvent = e.k),
tgt AS (SELECT c.c_nationkey * 100 AS SiteCode, c.c_custkey AS PatientPK, CAST(l.l_shipdate AS DATE) AS VisitDate
        FROM lineitem l JOIN customer c ON l.l_partkey = c.c_custkey WHERE l.l_shipdate < TIMESTAMP '1997-01-01')
SELECT {_null_cols(spec, have)}, {_UTF16_SQL.format(c='PatientID')} AS PatientIDHash,
       {_UTF16_SQL.format(c='PatientPK')} AS PatientPKHash
FROM std x WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.SiteCode IS NOT DISTINCT FROM x.SiteCode
  AND t.PatientPK IS NOT DISTINCT FROM x.PatientPK AND t.VisitDate IS NOT DISTINCT FROM CAST(x.VisitDate AS DATE))"""


@query("load_adverse_events", oracle=_p02_oracle())
def load_adverse_events(spark, sf):
    """The adverse-events load spec (P02) on the test tables: no gender filter, facility-code
    filter, date windows, severity / action / cause / outcome recodes (the 150-spelling cause
    vocabulary as one map literal), regimen and event lookups, load-date stamp, delta keyed on
    the visit day."""
    spec, io = _p02_io(spark, sf)
    return _load(spec, io)


# =============================================================== GBV (P14), immunization
def _p14_extra():
    k = F.col("o_orderkey")
    return {"IPV": F.when(k % 2 == 0, F.lit("Yes")).otherwise(F.lit("No")),
            "PhysicalIPV": F.col("o_orderstatus"), "IPVRelationship": F.col("o_orderpriority")}


@query("load_gbv_screening", oracle=_ct_visit_oracle(
    "p14_gbv_screening",
    "CASE WHEN o_orderkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS IPV, o_orderstatus AS PhysicalIPV, "
    "o_orderpriority AS IPVRelationship",
    ["IPV", "PhysicalIPV", "IPVRelationship"], "IPV, PhysicalIPV, IPVRelationship"))
def load_gbv_screening(spark, sf):
    """The GBV screening load spec (P14) on the test tables: delta mixing null-safe keys with a
    plain '=' site key, in-scan project map."""
    spec, io = _ct_visit_job(spark, sf, "p14_gbv_screening", "GbvScreeningExtract", _p14_extra())
    return _load(spec, io)


def _p39_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p39_immunization"]
    o = table(spark, sf, "orders")
    ck, k = F.col("o_custkey"), F.col("o_orderkey")
    form = o.select(
        k.alias("ID"), ck.alias("PatientPk"), (ck % 10 + 1).cast("int").alias("SiteCode"),
        F.concat(F.lit("MN"), ck.cast("string")).alias("PatientMnchID"),
        F.date_add(F.to_date("o_orderdate"), (k % 3).cast("int")).alias("DateExtracted"),
        F.col("o_orderstatus").alias("BCG"), F.col("o_orderpriority").alias("OPV1"))
    loaded = o.filter(F.col("o_orderdate") < ntz(dt.datetime(1995, 4, 1))).select(
        (ck % 10 + 1).cast("int").alias("SiteCode"), ck.alias("PatientPk"),
        F.concat(F.lit("MN"), ck.cast("string")).alias("PatientMnchID"), k.alias("Id"))
    return spec, FrameIO({"MnchImmunization": form}, {spec.target: loaded})


def _p39_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p39_immunization"]
    have = {"Id", "PatientPk", "SiteCode", "PatientMnchID", "DateExtracted", "BCG", "OPV1"}
    return f"""
WITH p AS (
  SELECT o_orderkey AS Id, o_custkey AS PatientPk, CAST(o_custkey % 10 + 1 AS INTEGER) AS SiteCode,
         'MN' || CAST(o_custkey AS VARCHAR) AS PatientMnchID,
         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER) AS DateExtracted,
         o_orderstatus AS BCG, o_orderpriority AS OPV1
  FROM orders),
tm AS (SELECT PatientPk, SiteCode, max(Id) AS MaxID, max(CAST(DateExtracted AS DATE)) AS MaxDateExtracted
       FROM p GROUP BY PatientPk, SiteCode),
scan AS (SELECT DISTINCT p.* FROM p JOIN tm ON p.PatientPk = tm.PatientPk AND p.SiteCode = tm.SiteCode
           AND CAST(p.DateExtracted AS DATE) = tm.MaxDateExtracted AND p.Id = tm.MaxID)
SELECT {_null_cols(spec, have)}
FROM scan x WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderdate < TIMESTAMP '1995-04-01'
  AND CAST(t.o_custkey % 10 + 1 AS INTEGER) IS NOT DISTINCT FROM x.SiteCode AND t.o_custkey IS NOT DISTINCT FROM x.PatientPk
  AND 'MN' || CAST(t.o_custkey AS VARCHAR) IS NOT DISTINCT FROM x.PatientMnchID AND t.o_orderkey = x.Id)"""


@query("load_mnch_immunization", oracle=_p39_oracle())
def load_mnch_immunization(spark, sf):
    """The MNCH immunization load spec (P39) on the test tables: no parent, latest rule, delta
    mixing null-safe keys with a plain '=' id, no digests."""
    spec, io = _p39_io(spark, sf)
    return _load(spec, io)


# =============================================================== labs (P20), partner tracing
def _p20_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p20_patient_labs"]
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    k = F.col("o_orderkey")
    od = F.to_date("o_orderdate")
    form = o.select(
        k.alias("ID"), F.col("o_custkey").alias("PatientId"), F.concat(F.lit("L"), (k % 5).cast("string")).alias("VisitID"),
        od.alias("OrderedbyDate"), F.date_add(od, 5).alias("ReportedbyDate"),
        F.when(k % 3 == 0, F.lit("cd4")).when(k % 3 == 1, F.lit("VIRAL LOAD")).otherwise(F.lit("Hb")).alias("TestName"),
        F.when(k % 4 == 0, F.lit("-1")).otherwise((k % 900).cast("string")).alias("TestResult"),
        F.col("o_orderdate").alias("Created"), F.lit(False).alias("voided"))
    patient, facility = _ct_parents(spark, sf)
    names = o.filter(k % 3 == 1).select(F.lit("viral load").alias("source_name"),
                                        F.lit("Viral Load Test").alias("target_name")).distinct()
    loaded = c.filter(F.col("c_custkey") % 3 == 1).select((F.col("c_nationkey") * 100).alias("SiteCode"),
                                                        F.col("c_custkey").alias("PatientPK"), F.lit("L0").alias("VisitID"))
    return spec, FrameIO({"PatientLaboratoryExtract": form, "PatientExtract": patient, "Facility": facility,
                          "lkp_test_name": names}, {spec.target: loaded})


def _p20_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p20_patient_labs"]
    have = {"ID", "PatientID", "PatientPk", "SiteCode", "FacilityName", "VisitID", "OrderedbyDate", "ReportedbyDate",
            "TestName", "TestResult", "Emr", "Project", "voided"}
    return f"""
WITH a AS (
  SELECT o_orderkey AS ID, o_custkey AS PatientRef, 'L' || CAST(o_orderkey % 5 AS VARCHAR) AS VisitID,
         CAST(o_orderdate AS DATE) AS OrderedbyDate, CAST(o_orderdate AS DATE) + 5 AS ReportedbyDate,
         CASE o_orderkey % 3 WHEN 0 THEN 'cd4' WHEN 1 THEN 'VIRAL LOAD' ELSE 'Hb' END AS TestName,
         CASE WHEN o_orderkey % 4 = 0 THEN '-1' ELSE CAST(o_orderkey % 900 AS VARCHAR) END AS TestResult,
         o_orderdate AS Created, false AS voided
  FROM orders),
j AS (SELECT a.*, {_CT_COLS_SQL} FROM a {_CT_PARENTS_SQL}),
tn AS (SELECT SiteCode, PatientPK, TestResult, TestName, OrderedbyDate, voided, max(ID) AS MaxID,
              max(CAST(Created AS DATE)) AS MaxCreated
       FROM j GROUP BY SiteCode, PatientPK, TestResult, TestName, OrderedbyDate, voided),
scan AS (
  SELECT DISTINCT j.PatientRef AS ID, j.PatientID, j.PatientPK AS PatientPk, j.SiteCode, j.FacilityName, j.VisitID, j.OrderedbyDate,
         j.ReportedbyDate, j.TestName, j.TestResult, j.Emr, j.Project, j.voided
  FROM j JOIN tn ON j.SiteCode = tn.SiteCode AND j.PatientPK = tn.PatientPK AND j.TestResult = tn.TestResult
                AND j.TestName = tn.TestName AND j.OrderedbyDate = tn.OrderedbyDate AND j.voided = tn.voided
                AND j.ID = tn.MaxID AND CAST(j.Created AS DATE) = tn.MaxCreated
  WHERE j.Gender <> 'Unknown'),
clean AS (
  SELECT ID, PatientID, PatientPk, SiteCode, FacilityName, VisitID,
         CASE WHEN OrderedbyDate < DATE '1900-01-01' OR OrderedbyDate > DATE '2000-12-31' THEN DATE '1900-01-01'
              ELSE OrderedbyDate END AS OrderedbyDate,
         CASE WHEN ReportedbyDate < DATE '1900-01-01' OR ReportedbyDate > DATE '2000-12-31' THEN DATE '1900-01-01'
              ELSE ReportedbyDate END AS ReportedbyDate,
         coalesce(l.t, s.TestName) AS TestName,
         CASE WHEN TRY_CAST(TestResult AS DOUBLE) < 0 THEN 'Viral Load' ELSE TestResult END AS TestResult,
         CASE WHEN Emr = 'Open Medical Records System - OpenMRS' THEN 'OpenMRS' WHEN Emr = 'Ampath AMRS' THEN 'AMRS'
              ELSE Emr END AS Emr,
         Project, voided
  FROM scan s LEFT JOIN (SELECT DISTINCT upper('viral load') AS k, 'Viral Load Test' AS t FROM orders
                         WHERE o_orderkey % 3 = 1) l ON upper(s.TestName) = l.k),
tgt AS (SELECT c_nationkey * 100 AS SiteCode, c_custkey AS PatientPK, 'L0' AS VisitID FROM customer WHERE c_custkey % 3 = 1)
SELECT {_null_cols(spec, have)}, {_UTF16_SQL.format(c='PatientID')} AS PatientIDHash,
       {_UTF16_SQL.format(c='PatientPk')} AS PatientPKHash
FROM clean x WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.SiteCode IS NOT DISTINCT FROM x.SiteCode
  AND t.PatientPK IS NOT DISTINCT FROM x.PatientPk AND t.VisitID IS NOT DISTINCT FROM x.VisitID)"""


@query("load_patient_labs", oracle=_p20_oracle())
def load_patient_labs(spark, sf):
    """The patient-labs load spec (P20) on the test tables: latest rule over six keys after the
    patient / facility joins, gender filter only (facility code 0 kept), date windows, negative
    results labelled, case-insensitive test-name lookup, delta on (site, patient, visit)."""
    spec, io = _p20_io(spark, sf)
    return _load(spec, io)


def _p31_io(spark, sf):
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p31_partner_tracing"]
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    ln = F.col("l_linenumber")
    form = li.select(
        (F.col("l_orderkey") * 10 + ln).alias("ID"), F.col("l_orderkey").alias("PatientPk"),
        (F.col("l_suppkey") % 4 + 1).cast("int").alias("SiteCode"),
        F.concat(F.lit("H"), F.col("l_orderkey").cast("string")).alias("HtsNumber"),
        F.col("l_linestatus").alias("TraceType"), F.to_date("l_shipdate").alias("TraceDate"),
        F.date_trunc("month", F.col("l_shipdate")).cast("date").alias("BookingDate"),
        F.when(ln % 3 == 0, F.lit("NULL")).when(ln % 3 == 1, F.lit("null")).otherwise(F.col("l_returnflag"))
         .alias("TraceOutcome"),
        F.date_add(F.to_date("l_shipdate"), (F.col("l_partkey") % 3).cast("int")).alias("DateExtracted"))
    clients = o.select(F.col("o_orderkey").alias("PatientPk"),
                       (F.col("o_custkey") % 4 + 1).cast("int").alias("SiteCode"))
    loaded = li.filter(F.col("l_shipdate") < ntz(dt.datetime(1995, 6, 1))).select(
        F.col("l_orderkey").alias("PatientPk"), (F.col("l_suppkey") % 4 + 1).cast("int").alias("SiteCode"),
        F.concat(F.lit("H"), F.col("l_orderkey").cast("string")).alias("HtsNumber"))
    return spec, FrameIO({"HtsPartnerTracings": form, "Clients": clients}, {spec.target: loaded})


def _p31_oracle() -> str:
    from wardflow.plans.catalog import SPECS
    spec = SPECS["p31_partner_tracing"]
    have = {"SiteCode", "PatientPk", "HtsNumber", "TraceType", "TraceDate", "TraceOutcome", "BookingDate"}
    return f"""
WITH a AS (
  SELECT l_orderkey * 10 + l_linenumber AS ID, l_orderkey AS PatientPk, CAST(l_suppkey % 4 + 1 AS INTEGER) AS SiteCode,
         'H' || CAST(l_orderkey AS VARCHAR) AS HtsNumber, l_linestatus AS TraceType,
         CAST(l_shipdate AS DATE) AS TraceDate, CAST(date_trunc('month', l_shipdate) AS DATE) AS BookingDate,
         CASE l_linenumber % 3 WHEN 0 THEN 'NULL' WHEN 1 THEN 'null' ELSE l_returnflag END AS TraceOutcome,
         CAST(l_shipdate AS DATE) + CAST(l_partkey % 3 AS INTEGER) AS DateExtracted
  FROM lineitem),
tm AS (SELECT SiteCode, PatientPk, HtsNumber, TraceType, TraceDate, BookingDate, TraceOutcome, max(ID) AS MaxID,
              max(CAST(DateExtracted AS DATE)) AS MaxDateExtracted
       FROM a GROUP BY SiteCode, PatientPk, HtsNumber, TraceType, BookingDate, TraceDate, TraceOutcome),
scan AS (
  SELECT DISTINCT a.SiteCode, a.PatientPk, a.HtsNumber, a.TraceType, a.TraceDate, a.TraceOutcome, a.BookingDate
  FROM a JOIN tm ON a.SiteCode = tm.SiteCode AND a.PatientPk = tm.PatientPk AND a.TraceType = tm.TraceType
                AND a.BookingDate = tm.BookingDate AND CAST(a.DateExtracted AS DATE) = tm.MaxDateExtracted
                AND a.ID = tm.MaxID
  WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = a.PatientPk
                AND CAST(o.o_custkey % 4 + 1 AS INTEGER) = a.SiteCode)),
clean AS (
  SELECT SiteCode, PatientPk, HtsNumber, TraceType, TraceDate,
         CASE WHEN TraceOutcome IN ('null', 'NULL') THEN NULL ELSE TraceOutcome END AS TraceOutcome, BookingDate
  FROM scan)
SELECT {_null_cols(spec, have)}, {_UTF16_SQL.format(c='HtsNumber')} AS HtsNumberHash,
       {_UTF16_SQL.format(c='PatientPk')} AS PatientPKHash
FROM clean x WHERE NOT EXISTS (SELECT 1 FROM lineitem t WHERE t.l_shipdate < TIMESTAMP '1995-06-01'
  AND t.l_orderkey IS NOT DISTINCT FROM x.PatientPk
  AND CAST(t.l_suppkey % 4 + 1 AS INTEGER) IS NOT DISTINCT FROM x.SiteCode
  AND 'H' || CAST(t.l_orderkey AS VARCHAR) IS NOT DISTINCT FROM x.HtsNumber)"""


@query("load_hts_partner_tracing", oracle=_p31_oracle())
def load_hts_partner_tracing(spark, sf):
    """The HTS partner-tracing load spec (P31) on the test tables: latest rule grouped by seven
    columns but joined on four, client existence, 'null' / 'NULL' sentinels, delta, digests."""
    spec, io = _p31_io(spark, sf)
    return _load(spec, io)


# =============================================================== PrEP lab (P48), adverse events (P45), care termination
def _prep_events_form(e, extra: dict):
    eid = F.col("event_id")
    return e.select(
        eid.alias("ID"), F.col("user_id").alias("PatientPk"), (eid % 3 + 1).cast("int").alias("SiteCode"),
        F.col("ts").alias("Created"), F.date_add(F.to_date("ts"), (eid % 2).cast("int")).alias("DateExtracted"),
        F.concat(F.lit("PREP-"), (eid % 2).cast("string"), F.lit("-"), F.col("user_id").cast("string")).alias("PrepNumber"),
        *[v.alias(k) for k, v in extra.items()])


_PREP_FORM_SQL = """event_id AS ID, user_id AS PatientPk, CAST(event_id % 3 + 1 AS INTEGER) AS SiteCode, ts AS Created,
         CAST(ts AS DATE) + CAST(event_id % 2 AS INTEGER) AS DateExtracted,
         'PREP-' || CAST(event_id % 2 AS VARCHAR) || '-' || CAST(user_id AS VARCHAR) AS PrepNumber"""


def _prep_patients(e, with_number: bool):
    eid = F.col("event_id")
    cols = [F.col("user_id").alias("PatientPk"), (eid % 3 + 1).cast("int").alias("SiteCode")]
    if with_number:
        cols.append(F.concat(F.lit("PREP-"), (eid % 2).cast("string"), F.lit("-"), F.col("user_id").cast("string"))
                    .alias("PrepNumber"))
    return e.filter(F.col("event_type") != "error").select(*cols).distinct()


def _prep_loaded(e, keys):
    eid = F.col("event_id")
    m = {"PatientPk": F.col("user_id"), "SiteCode": (eid % 3 + 1).cast("int"),
         "PrepNumber": F.concat(F.lit("PREP-"), (eid % 2).cast("string"), F.lit("-"), F.col("user_id").cast("string"))}
    return e.filter(F.col("ts") < ntz(dt.datetime(2024, 1, 2))).select(*[m[k].alias(k) for k in keys])


def _prep_job(spark, sf, spec_name, source, extra, with_number=False):
    from wardflow.plans.catalog import SPECS
    spec = SPECS[spec_name]
    e = table(spark, sf, "events")
    tables = {source: _prep_events_form(e, extra)}
    if spec.parents:
        tables["PrepPatients"] = _prep_patients(e, with_number)
    loaded = _prep_loaded(e, [k for k in spec.delta_keys])
    return spec, FrameIO(tables, {spec.target: loaded})


def _prep_oracle(spec_name, extra_sql, extra_cols, latest_sql, clean_sql, with_number=False, number_key=False, feed=None):
    from wardflow.plans.catalog import SPECS
    spec = SPECS[spec_name]
    if feed:
        extra_sql, clean_sql = f"{extra_sql}, {feed.form_sql}", f"{clean_sql}, {feed.rule_sql}"
        extra_cols = [*extra_cols, *feed.form]
    have = {"ID", "Created", "PatientPk", "SiteCode", "DateExtracted", "PrepNumber", *extra_cols}
    exist = ("AND 'PREP-' || CAST(b.event_id % 2 AS VARCHAR) || '-' || CAST(b.user_id AS VARCHAR) = a.PrepNumber"
             if with_number else "")
    keyn = ("AND 'PREP-' || CAST(t.event_id % 2 AS VARCHAR) || '-' || CAST(t.user_id AS VARCHAR) "
            "IS NOT DISTINCT FROM x.PrepNumber" if number_key else "")
    parent = (f"""WHERE EXISTS (SELECT 1 FROM events b WHERE b.event_type <> 'error' AND b.user_id = a.PatientPk
                AND CAST(b.event_id % 3 + 1 AS INTEGER) = a.SiteCode {exist})""" if spec.parents else "")
    sel = ", ".join(["a.ID", "a.Created", "a.PatientPk", "a.SiteCode", "a.DateExtracted", "a.PrepNumber"]
                    + [f"a.{c}" for c in extra_cols])
    return f"""
WITH a AS (SELECT {_PREP_FORM_SQL}, {extra_sql} FROM events),
{latest_sql},
scan AS (SELECT DISTINCT {sel} FROM a {{joins}} {parent}),
clean AS (SELECT ID, Created, PatientPk, SiteCode, DateExtracted, PrepNumber, {clean_sql} FROM scan)
SELECT {_null_cols(spec, have)}, {_UTF16_SQL.format(c='PrepNumber')} AS PrepNumberHash,
       {_UTF16_SQL.format(c='PatientPk')} AS PatientPKHash
FROM clean x WHERE NOT EXISTS (SELECT 1 FROM events t WHERE t.ts < TIMESTAMP '2024-01-02'
  AND t.user_id IS NOT DISTINCT FROM x.PatientPk AND CAST(t.event_id % 3 + 1 AS INTEGER) IS NOT DISTINCT FROM x.SiteCode
  {keyn})"""


_TN_CREATED = """tn AS (SELECT PatientPk, SiteCode, max(ID) AS MaxID, max(CAST(Created AS DATE)) AS MaxCreated FROM a
       GROUP BY PatientPk, SiteCode)"""
_JOIN_CREATED = ("JOIN tn ON a.PatientPk = tn.PatientPk AND a.SiteCode = tn.SiteCode "
                 "AND CAST(a.Created AS DATE) = tn.MaxCreated AND a.ID = tn.MaxID")


_PREP_OWN = "ID,Created,PatientPk,SiteCode,DateExtracted,PrepNumber,"
_P45_FEED = Feed("p45_adverse_events", "event_id", _PREP_OWN + "Severity,AdverseEvent",
                 blank="AdverseEventRegimen,AdverseEventIsPregnant,AdverseEventClinicalOutcome,AdverseEventActionTaken,"
                       "AdverseEventEndDate,AdverseEventStartDate")
_P47_FEED = Feed("p47_care_termination", "event_id", _PREP_OWN + "ExitReason,ExitDate", blank="DateOfLastPrepDose")
_P48_FEED = Feed("p48_lab", "event_id", _PREP_OWN + "Reason,TestName", blank="SampleDate")


def _p45_extra():
    eid = F.col("event_id")
    return {"Severity": F.when(eid % 4 == 0, F.lit("")).otherwise(F.lit("Mild")),
            "AdverseEvent": F.when(eid % 5 == 0, F.lit("")).otherwise(F.col("event_type"))} | _P45_FEED.extra()


@query("load_prep_adverse_events", oracle=_prep_oracle(
    "p45_adverse_events",
    "CASE WHEN event_id % 4 = 0 THEN '' ELSE 'Mild' END AS Severity, "
    "CASE WHEN event_id % 5 = 0 THEN '' ELSE event_type END AS AdverseEvent",
    ["Severity", "AdverseEvent"], _TN_CREATED,
    "CASE WHEN Severity = '' THEN NULL ELSE Severity END AS Severity, "
    "CASE WHEN AdverseEvent = '' THEN NULL ELSE AdverseEvent END AS AdverseEvent", with_number=True,
    feed=_P45_FEED).replace("{joins}", _JOIN_CREATED))
def load_prep_adverse_events(spark, sf):
    """The PrEP adverse-events load spec (P45) on the test tables: latest rule, patient existence,
    blank -> NULL, delta, digests."""
    spec, io = _prep_job(spark, sf, "p45_adverse_events", "PrepAdverseEvents", _p45_extra(), with_number=True)
    return build_load(spec, io, AS_OF)


def _p47_extra():
    eid = F.col("event_id")
    return {"ExitReason": F.when(eid % 3 == 0, F.lit("")).otherwise(F.col("event_type")),
            "ExitDate": F.to_date("ts")} | _P47_FEED.extra()


_P47_LATEST = _TN_CREATED + """,
tm AS (SELECT PatientPk, SiteCode, max(ID) AS MaxID, max(CAST(DateExtracted AS DATE)) AS MaxExtracted FROM a
       GROUP BY PatientPk, SiteCode)"""
_P47_JOINS = _JOIN_CREATED + (" JOIN tm ON a.PatientPk = tm.PatientPk AND a.SiteCode = tm.SiteCode "
                              "AND CAST(a.DateExtracted AS DATE) = tm.MaxExtracted AND a.ID = tm.MaxID")


@query("load_prep_care_termination", oracle=_prep_oracle(
    "p47_care_termination",
    "CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS ExitReason, CAST(ts AS DATE) AS ExitDate",
    ["ExitReason", "ExitDate"], _P47_LATEST,
    "CASE WHEN ExitReason = '' THEN NULL ELSE ExitReason END AS ExitReason, ExitDate", feed=_P47_FEED).replace("{joins}", _P47_JOINS))
def load_prep_care_termination(spark, sf):
    """The PrEP care-termination load spec (P47) on the test tables: two latest rules ANDed,
    patient existence, blank -> NULL, delta, digests."""
    spec, io = _prep_job(spark, sf, "p47_care_termination", "PrepCareTerminations", _p47_extra())
    return build_load(spec, io, AS_OF)


def _p48_extra():
    eid = F.col("event_id")
    return {"Reason": F.when(eid % 4 == 0, F.lit("")).otherwise(F.lit("Routine")),
            "TestName": F.col("event_type")} | _P48_FEED.extra()


_P48_LATEST = """tn AS (SELECT PatientPk, SiteCode, PrepNumber, max(ID) AS MaxID, max(CAST(Created AS DATE)) AS MaxCreated
       FROM a GROUP BY PatientPk, SiteCode, PrepNumber)"""
_P48_JOINS = ("JOIN tn ON a.PatientPk = tn.PatientPk AND a.SiteCode = tn.SiteCode "
              "AND CAST(a.Created AS DATE) = tn.MaxCreated AND a.ID = tn.MaxID")


@query("load_prep_lab", oracle=_prep_oracle(
    "p48_lab",
    "CASE WHEN event_id % 4 = 0 THEN '' ELSE 'Routine' END AS Reason, event_type AS TestName",
    ["Reason", "TestName"], _P48_LATEST,
    "CASE WHEN Reason = '' THEN NULL ELSE Reason END AS Reason, TestName",
    with_number=True, number_key=True, feed=_P48_FEED).replace("{joins}", _P48_JOINS))
def load_prep_lab(spark, sf):
    """The PrEP lab load spec (P48) on the test tables: latest rule grouped with the PrEP number
    but joined on (patient, site), existence in PrEP patients by (site, patient, number), blank ->
    NULL, delta on (patient, site, number), digests."""
    spec, io = _prep_job(spark, sf, "p48_lab", "PrepLabs", _p48_extra(), with_number=True)
    return build_load(spec, io, AS_OF)


# =============================================================== depression (P09), allergies
def _p09_extra():
    k = F.col("o_orderkey")
    return {"PHQ9_1": (k % 4).cast("string"), "PHQ_9_rating": F.col("o_orderpriority")}


@query("load_depression_screening", oracle=_ct_visit_oracle(
    "p09_depression_screening",
    "CAST(o_orderkey % 4 AS VARCHAR) AS PHQ9_1, o_orderpriority AS PHQ_9_rating",
    ["PHQ9_1", "PHQ_9_rating"], "PHQ9_1, PHQ_9_rating", patient_id=True))
def load_depression_screening(spark, sf):
    """The depression-screening load spec (P09) on the test tables: patient / facility joins and
    filters, in-scan project map, delta on (site, patient, visit), digests."""
    spec, io = _ct_visit_job(spark, sf, "p09_depression_screening", "DepressionScreeningExtract", _p09_extra())
    return _load(spec, io)


def _p03_extra():
    k = F.col("o_orderkey")
    return {"ChronicIllness": F.col("o_orderstatus"),
            "ChronicOnsetDate": F.date_sub(F.to_date("o_orderdate"), (k % 9000).cast("int")),
            "AllergyCausativeAgent": F.col("o_orderpriority"),
            "AllergicReaction": F.when(k % 2 == 0, F.lit("rash")).otherwise(F.lit("itch")),
            "AllergySeverity": F.when(k % 4 == 0, F.lit("Mild|Mild")).when(k % 4 == 1, F.lit("Moderate|Mild"))
            .when(k % 4 == 2, F.lit("Fatal")).otherwise(F.lit("Odd"))}


def _p03_job(spark, sf):
    spec, io = _ct_visit_job(spark, sf, "p03_allergies_chronic_illness", "AllergiesChronicIllnessExtract", _p03_extra())
    o = table(spark, sf, "orders")
    io.tables["lkp_chronic_illness"] = o.filter(F.col("o_orderstatus") == "F").select(
        F.lit("F").alias("source_name"), F.lit("Hypertension").alias("target_name")).distinct()
    io.tables["lkp_allergy_causative_agent"] = o.filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.lit("1-URGENT").alias("source_name"), F.lit("Penicillin").alias("target_name")).distinct()
    io.tables["lkp_allergic_reaction"] = o.filter(F.col("o_orderkey") % 2 == 0).select(
        F.lit("rash").alias("source_name"), F.lit("Rash").alias("target_name")).distinct()
    return spec, io


_P03_SQL = """o_orderstatus AS ChronicIllness, CAST(o_orderdate AS DATE) - CAST(o_orderkey % 9000 AS INTEGER) AS ChronicOnsetDate,
         o_orderpriority AS AllergyCausativeAgent, CASE WHEN o_orderkey % 2 = 0 THEN 'rash' ELSE 'itch' END AS AllergicReaction,
         CASE o_orderkey % 4 WHEN 0 THEN 'Mild|Mild' WHEN 1 THEN 'Moderate|Mild' WHEN 2 THEN 'Fatal' ELSE 'Odd' END
           AS AllergySeverity"""
_P03_CLEAN = """CASE WHEN ChronicIllness = 'F' THEN 'Hypertension' ELSE ChronicIllness END AS ChronicIllness,
         CASE WHEN ChronicOnsetDate < DATE '1900-01-01' OR ChronicOnsetDate > DATE '2000-12-31' THEN DATE '1900-01-01'
              ELSE ChronicOnsetDate END AS ChronicOnsetDate,
         CASE WHEN AllergyCausativeAgent = '1-URGENT' THEN 'Penicillin' ELSE AllergyCausativeAgent END AS AllergyCausativeAgent,
         CASE WHEN AllergicReaction = 'rash' THEN 'Rash' ELSE AllergicReaction END AS AllergicReaction,
         CASE WHEN AllergySeverity = 'Fatal' THEN 'Fatal'
              WHEN AllergySeverity IN ('Mild|Mild|Mild', 'Mild|Mild', 'Mild') THEN 'Mild'
              WHEN AllergySeverity IN ('Moderate|Moderate', 'Moderate') THEN 'Moderate'
              WHEN AllergySeverity = 'Severe' THEN 'Severe'
              WHEN AllergySeverity IN ('Unknown', 'Moderate|Mild') THEN 'Unknown' ELSE AllergySeverity END AS AllergySeverity"""


@query("load_allergies_chronic_illness", oracle=_ct_visit_oracle(
    "p03_allergies_chronic_illness", _P03_SQL,
    ["ChronicIllness", "ChronicOnsetDate", "AllergyCausativeAgent", "AllergicReaction", "AllergySeverity"], _P03_CLEAN))
def load_allergies_chronic_illness(spark, sf):
    """The allergies / chronic-illness load spec (P03) on the test tables: onset-date window,
    severity recode, three lookups, delta on (site, patient, visit), digests."""
    spec, io = _p03_job(spark, sf)
    return _load(spec, io)


# =============================================================== OVC (P18), EAC (P11), defaulter tracing
def _p18_extra():
    return {"OVCEnrollmentDate": F.date_sub(F.to_date("o_orderdate"), 30), "OVCExitReason": F.col("o_orderstatus")}


@query("load_ovc", oracle=_ct_visit_oracle(
    "p18_ovc", "CAST(o_orderdate AS DATE) - 30 AS OVCEnrollmentDate, o_orderstatus AS OVCExitReason",
    ["OVCEnrollmentDate", "OVCExitReason"], "OVCEnrollmentDate, OVCExitReason", patient_id=True))
def load_ovc(spark, sf):
    """The OVC load spec (P18) on the test tables: patient / facility joins and filters, in-scan
    project map, delta on (site, patient, visit), digests."""
    spec, io = _ct_visit_job(spark, sf, "p18_ovc", "OvcExtract", _p18_extra())
    return _load(spec, io)


def _p11_extra():
    k = F.col("o_orderkey")
    return {"DateOfFirstSession": F.date_sub(F.to_date("o_orderdate"), (k % 40000).cast("int")),
            "EACFollowupDate": F.date_add(F.to_date("o_orderdate"), (k % 1000).cast("int")),
            "SessionNumber": (k % 6).cast("string")}


@query("load_enhanced_adherence_counselling", oracle=_ct_visit_oracle(
    "p11_enhanced_adherence_counselling",
    "CAST(o_orderdate AS DATE) - CAST(o_orderkey % 40000 AS INTEGER) AS DateOfFirstSession, "
    "CAST(o_orderdate AS DATE) + CAST(o_orderkey % 1000 AS INTEGER) AS EACFollowupDate, "
    "CAST(o_orderkey % 6 AS VARCHAR) AS SessionNumber",
    ["DateOfFirstSession", "EACFollowupDate", "SessionNumber"],
    "CASE WHEN DateOfFirstSession < DATE '1900-01-01' OR DateOfFirstSession > DATE '2000-12-31' "
    "THEN DATE '1900-01-01' ELSE DateOfFirstSession END AS DateOfFirstSession, "
    "CASE WHEN EACFollowupDate < DATE '1900-01-01' OR EACFollowupDate > DATE '2000-12-31' "
    "THEN DATE '1900-01-01' ELSE EACFollowupDate END AS EACFollowupDate, SessionNumber"))
def load_enhanced_adherence_counselling(spark, sf):
    """The enhanced adherence counselling load spec (P11) on the test tables: first-session and
    follow-up date windows, delta on (site, patient, visit), digests."""
    spec, io = _ct_visit_job(spark, sf, "p11_enhanced_adherence_counselling", "EnhancedAdherenceCounsellingExtract",
                             _p11_extra())
    return _load(spec, io)


def _p08_extra():
    k = F.col("o_orderkey")
    return {"TracingType": F.col("o_orderpriority"), "TracingOutcome": F.col("o_orderstatus"),
            "AttemptNumber": (k % 3 + 1).cast("string"), "VisitDate": F.col("o_orderdate"),
            "BookingDate": F.col("o_orderdate") + F.make_interval(days=F.lit(7))}


@query("load_defaulter_tracing", oracle=_ct_visit_oracle(
    "p08_defaulter_tracing",
    "o_orderpriority AS TracingType, o_orderstatus AS TracingOutcome, CAST(o_orderkey % 3 + 1 AS VARCHAR) AS AttemptNumber, "
    "CAST(o_orderdate AS DATE) + 7 AS BookingDate",
    ["TracingType", "TracingOutcome", "AttemptNumber", "BookingDate"],
    "TracingType, TracingOutcome, AttemptNumber, BookingDate", project_map=False, patient_id=True))
def load_defaulter_tracing(spark, sf):
    """The defaulter-tracing load spec (P08) on the test tables: patient / facility joins and
    filters (no in-scan project map in this text), delta on (site, patient, visit), digests."""
    spec, io = _ct_visit_job(spark, sf, "p08_defaulter_tracing", "DefaulterTracingExtract", _p08_extra(),
                             _twice_a_day)
    return _load(spec, io)


# =============================================================== Covid
_P07_CASTS = ("BoosterDoseDate", "COVID19TestDate", "COVID19TestDateSinceLastVisit", "AdmissionStartDate")
_P07_FEED = Feed(
    "p07_covid", "o_orderkey",
    "ID,PatientID,PatientPK,SiteCode,FacilityName,VisitID,Emr,Project,Covid19AssessmentDate,DateGivenFirstDose,"
    "DateGivenSecondDose,AdmissionEndDate,VaccinationStatus",
    made={c: (f"CASE WHEN o_orderkey % {i + 4} <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % {90 + i} AS INTEGER) END",
              f"CAST({c} AS DATE)") for i, c in enumerate(_P07_CASTS)},
    spark={c: f"CASE WHEN o_orderkey % {i + 4} <> 0 THEN o_orderdate + make_interval(0, 0, 0, CAST(o_orderkey % {90 + i} AS INT)) END"
           for i, c in enumerate(_P07_CASTS)})


def _p07_extra():
    k = F.col("o_orderkey")
    at = lambda days: F.col("o_orderdate") + F.make_interval(days=days.cast("int"))
    return {"Covid19AssessmentDate": at(-(k % 12000)), "DateGivenFirstDose": at(k % 800),
            "DateGivenSecondDose": at(k % 800 + 30), "AdmissionEndDate": at(k % 3),
            "VaccinationStatus": F.when(k % 3 == 0, F.lit("Partial")).when(k % 3 == 1, F.lit("Fully - Details not Available"))
            .otherwise(F.lit("Not Vaccinated"))} | _P07_FEED.extra()


@query("load_covid", oracle=_ct_visit_oracle(
    "p07_covid",
    "CAST(o_orderdate AS DATE) - CAST(o_orderkey % 12000 AS INTEGER) AS Covid19AssessmentDate, "
    "CAST(o_orderdate AS DATE) + CAST(o_orderkey % 800 AS INTEGER) AS DateGivenFirstDose, "
    "CAST(o_orderdate AS DATE) + CAST(o_orderkey % 800 + 30 AS INTEGER) AS DateGivenSecondDose, "
    "CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER) AS AdmissionEndDate, "
    "CASE o_orderkey % 3 WHEN 0 THEN 'Partial' WHEN 1 THEN 'Fully - Details not Available' ELSE 'Not Vaccinated' END "
    "AS VaccinationStatus",
    ["Covid19AssessmentDate", "DateGivenFirstDose", "DateGivenSecondDose", "AdmissionEndDate", "VaccinationStatus"],
    ", ".join(f"CASE WHEN {c} < DATE '1980-01-01' OR {c} > DATE '2000-12-31' THEN DATE '1900-01-01' ELSE {c} END AS {c}"
              for c in ("Covid19AssessmentDate", "DateGivenFirstDose", "DateGivenSecondDose"))
    + ", CASE VaccinationStatus WHEN 'Fully - Details not Available' THEN 'Fully Vaccinated' "
      "WHEN 'Partial' THEN 'Partially Vaccinated' WHEN 'Partial - Details not Available' THEN 'Partially Vaccinated' "
      "ELSE VaccinationStatus END AS VaccinationStatus, AdmissionEndDate",
    project_map=False, patient_id=True, feed=_P07_FEED))
def load_covid(spark, sf):
    """The Covid load spec (P07) on the test tables: three date windows, vaccination-status
    recode, delta on (site, patient, visit), digests."""
    spec, io = _ct_visit_job(spark, sf, "p07_covid", "CovidExtract", _p07_extra(), _twice_a_day)
    return build_load(spec, io, AS_OF)
