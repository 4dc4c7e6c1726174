"""Merkle fixity audit of archive replicas.

Records are the leaves: a digest of the record's bytes at its file and offset.
A node of level 1 covers an offset range of ``RANGE_BYTES``; each level above
covers ``FAN`` ranges of the one below, up to one root per file.  A node's digest
is that of its children's places and digests in offset order, so equal digests
mean equal ranges.  The audit compares the replicas' roots and goes down only
below nodes that differ, level by level, to the records at fault.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.llm.common import materialize, read_table

RANGE_BYTES = 1 << 16
FAN = 16
PLACE_BUCKETS = 4096  # parts that the records of one offset are hashed in, by digest
FILE_RECORDS = 512  # records dealt into one archive file, on average


def record_bytes(url: Column, body: Column) -> Column:
    """One response record; null parts are empty."""
    url, body = F.coalesce(url, F.lit("")), F.coalesce(body, F.lit(""))
    return F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), url,
                    F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"),
                    F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def places(records: DataFrame) -> DataFrame:
    """One row for each ``file`` and offset ``idx`` (null: -1): ``digest`` of all its records and the ``least`` of theirs.

    Equal records become a count first; the others of one place, such as all
    records of null offset, are hashed in buckets of their digests, so that no
    task holds them all.
    """
    one = records.select("file", F.coalesce("offset", F.lit(-1)).cast("long").alias("idx"),
                         F.coalesce("digest", F.lit("")).alias("digest"))
    counted = one.groupBy("file", "idx", "digest").agg(F.count("*").alias("n"))
    bucket = F.pmod(F.xxhash64("digest"), F.lit(PLACE_BUCKETS)).alias("bucket")
    listed = lambda *cols: F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*cols))), lambda k: F.concat_ws(
        ":", *[k[c].cast("string") for c in cols])), "\n"), 256)
    parts = counted.groupBy("file", "idx", bucket).agg(listed("digest", "n").alias("part"), F.min("digest").alias("least"))
    return parts.groupBy("file", "idx").agg(listed("bucket", "part").alias("digest"), F.min("least").alias("least"))


def merkle_tree(records: DataFrame, range_bytes: int = RANGE_BYTES, fan: int = FAN, top: int | None = None) -> DataFrame:
    """Nodes (``file``, ``level``, ``idx``, ``digest``, ``least``) from records (``file``, ``offset``, ``digest``).

    Level 0 holds the records by offset, one node each, with the ``least`` of
    their digests (null above); the level ``top`` has one node per
    file (default: as many levels as the largest offset needs).  Records at
    one offset of one file count together, whatever their order.  Null offsets and
    digests are hashed as empty.  No record: no node.
    """
    leaves = places(records).select("file", F.lit(0).alias("level"), "idx", "digest", "least")
    if top is None:
        top = levels(records, range_bytes, fan)
    out, below = [leaves], leaves
    for level in range(1, top + 1):
        step = range_bytes if level == 1 else fan
        # children of one node: the records of range_bytes, or fan nodes
        kids = F.sort_array(F.collect_list(F.struct("idx", "digest")))
        below = below.groupBy("file", F.floor(F.col("idx") / step).cast("long").alias("up")).agg(kids.alias("kids"))
        below = below.select("file", F.lit(level).alias("level"), F.col("up").alias("idx"), F.sha2(F.array_join(
            F.transform("kids", lambda k: F.concat_ws(":", k["idx"].cast("string"), k["digest"])), "\n"), 256).alias("digest"),
            F.lit(None).cast("string").alias("least"))
        out.append(below)
    return reduce(DataFrame.unionByName, out)


def levels(records: DataFrame, range_bytes: int = RANGE_BYTES, fan: int = FAN) -> int:
    """Levels above the records until one node covers the largest offset."""
    far = records.agg(F.max("offset")).first()[0] or 0
    top, covers = 1, range_bytes
    while covers <= far:
        top, covers = top + 1, covers * fan
    return top + 1  # one more holds ranges below zero, that is null offsets, too


def audit(left: DataFrame, right: DataFrame, range_bytes: int = RANGE_BYTES, fan: int = FAN) -> DataFrame:
    """Places where two replicas differ: ``file``, ``offset``, ``fault`` and both digests.

    ``left`` and ``right`` have ``file``, ``offset`` and ``digest``.  ``fault`` is
    ``changed``, ``missing`` (only in ``left``) or ``extra`` (only in ``right``).
    Null files are one file; records that repeat at one offset are compared as
    one set and come as one place with the smallest digest of each side.  Equal replicas,
    also empty ones, give an empty result; other columns are ignored.
    """
    top = max(levels(left, range_bytes, fan), levels(right, range_bytes, fan))
    trees = [materialize(merkle_tree(r, range_bytes, fan, top), f"tree{i}") for i, r in enumerate((left, right))]
    bad: DataFrame | None = None
    for level in range(top, -1, -1):
        step = fan if level else range_bytes
        sides = []
        for tree, mark in zip(trees, ("l", "r"), strict=True):
            nodes = tree.where(F.col("level") == level).withColumn("up", F.floor(F.col("idx") / step).cast("long"))
            nodes = nodes.select("file", "idx", "up", F.col("digest").alias("node"),
                                 F.col("digest" if level else "least").alias("digest"))
            if bad is not None:
                nodes = nodes.join(bad.select(F.col("file").alias("bf"), F.col("idx").alias("bi")),
                                   F.col("file").eqNullSafe(F.col("bf")) & (F.col("up") == F.col("bi")), "left_semi")
            sides.append(nodes.select(*[F.col(c).alias(f"{mark}_{c}") for c in ("file", "idx", "node", "digest")]))
        both = sides[0].join(sides[1], F.col("l_file").eqNullSafe(F.col("r_file")) & (F.col("l_idx") == F.col("r_idx")), "full")
        bad = materialize(both.where(~F.col("l_node").eqNullSafe(F.col("r_node"))).select(
            F.coalesce("l_file", "r_file").alias("file"), F.coalesce("l_idx", "r_idx").alias("idx"),
            F.when(F.col("r_node").isNull(), "missing").when(F.col("l_node").isNull(), "extra").otherwise("changed").alias("fault"),
            F.col("l_digest").alias("left_digest"), F.col("r_digest").alias("right_digest")), f"bad{level}")
    return bad.select("file", F.col("idx").alias("offset"), "fault", "left_digest", "right_digest")


def archive(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two replicas of the pages as archive records, the second with planted faults.

    Rows: ``file``, ``offset``, ``length``, ``digest``, ``page_id``, ``url``.  By a digest of the page id one page in 97
    is changed in the second replica by one character, one is lost there, and one is lost in the first.
    Equal rows are numbered, so that each has its own place.
    """
    url, body = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    half = F.floor(F.length(body) / 2).cast("int")
    hurt = F.concat(F.substring(body, F.lit(1), half), F.lit("#"), F.substring(body, half + 2, F.length(body)))
    pid = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    luck = F.conv(F.substring(F.sha2(pid, 256), 1, 8), 16, 10).cast("long") % 97
    raw, bent = record_bytes(url, body), record_bytes(url, hurt)
    narrow = pages.select("page_id", url.alias("url"), luck.alias("luck"), F.octet_length(raw).cast("long").alias("length"),
                          F.sha2(raw, 256).alias("digest"), F.when(luck == 0, F.sha2(bent, 256)).alias("bent"))
    counted = narrow.groupBy(*narrow.columns).count()
    one = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "count"))).drop("count")
    files = (pages.count() + FILE_RECORDS - 1) // FILE_RECORDS or 1
    slot = F.sha2(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("")), "url", "digest",
                              F.col("copy").cast("string")), 256)
    one = one.withColumn("slot", slot).withColumn(
        "file", (F.conv(F.substring("slot", 1, 8), 16, 10).cast("long") % files).cast("long"))
    before = Window.partitionBy("file").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = materialize(one.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))), "records")
    first = placed.where("luck <> 2").select("file", "offset", "length", "digest", "page_id", "url")
    second = placed.where("luck <> 1").select("file", "offset", "length", F.coalesce("bent", "digest").alias("digest"),
                                              "page_id", "url")
    return first, second


def op1_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of a replica of all pages' archive records, located through the trees."""
    first, second = archive(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    bad = audit(first, second)
    known = first.unionByName(second).select("file", "offset", "length", "page_id", "url").distinct()
    return bad.join(known, ["file", "offset"]).select("page_id", "url", "file", "offset", "length", "fault",
                                                      "left_digest", "right_digest")


_ORACLE = r"""
WITH page AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS body, coalesce(CAST(page_id AS VARCHAR), '') AS pid
  FROM pages
), raw AS (
  SELECT page_id, pid, url,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
         || chr(13) || chr(10) || 'Content-Length: ' AS head,
         chr(13) || chr(10) || chr(13) || chr(10) AS gap, body,
         left(body, CAST(floor(length(body) / 2) AS INTEGER)) || '#'
         || substr(body, CAST(floor(length(body) / 2) AS INTEGER) + 2) AS hurt
  FROM page
), rec AS (
  SELECT page_id, pid, url, strlen(head || strlen(body) || gap || body || gap) AS length,
         sha256(head || strlen(body) || gap || body || gap) AS digest,
         sha256(head || strlen(hurt) || gap || hurt || gap) AS bent
  FROM raw
), copies AS (
  SELECT *, row_number() OVER (PARTITION BY page_id, url, digest) AS copy FROM rec
), slots AS (
  SELECT *, sha256(pid || '|' || url || '|' || digest || '|' || copy) AS slot,
         (SELECT greatest(1, (count(*) + 511) // 512) FROM pages) AS files
  FROM copies
), placed AS (
  SELECT *, CAST('0x' || substr(slot, 1, 8) AS BIGINT) % files AS file FROM slots
), offsets AS (
  SELECT *, CAST(coalesce(sum(length) OVER (PARTITION BY file ORDER BY slot
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
  FROM placed
)
SELECT o.page_id, o.url, o.file, o."offset", o.length,
       CASE luck WHEN 0 THEN 'changed' WHEN 1 THEN 'missing' ELSE 'extra' END AS fault,
       CASE WHEN luck <> 2 THEN digest END AS left_digest, CASE luck WHEN 0 THEN bent WHEN 2 THEN digest END AS right_digest
FROM (SELECT *, CAST('0x' || substr(sha256(pid), 1, 8) AS BIGINT) % 97 AS luck FROM offsets) o
WHERE luck <= 2 AND (luck > 0 OR bent <> digest)
"""

QUERIES = {"op1_fixity": op1_fixity}
ORACLES = {"op1_fixity": _ORACLE}
