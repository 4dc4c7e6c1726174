"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

A test item is the set of its ``gram``-word shingles (n of them), a document the
set of all its own.  An item is found when the document holds at least
``threshold`` of the item's shingles – containment, so a short item stands out
in a document of any length.

* Signature: the k smallest shingle hashes of the item (bottom-k MinHash), with
  k = n - ceil(threshold * n) + 1.  A document that misses k or more of the n
  shingles is below the threshold, so a true match always holds one of any k:
  the search loses nothing.
* Size partition: items carry the least number of shingles a match must share;
  a document is only held against items its own size class can contain.
* Verification: the shared shingles are counted as texts, not as hashes, once
  per (document, item): at the lowest-ranked signature hash the document holds.

Only the item side is broadcast, in blocks of proven size; documents are never
shuffled.  All steps are DataFrame functions.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import materialize, read_table

GRAM = 5
THRESHOLD_PCT = 80
BLOCK_ITEMS = 20_000  # items in one broadcast block
BLOCK_CHARS = 32_000_000  # and their characters

WORD_BREAK = r"[^\p{L}\p{M}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-case words (letters, marks, digits) of a text; null: none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_BREAK), "")


def _windows(w: Column, n: int, make) -> Column:
    """``make`` of the n words at each start, as an array; ``w`` is bound once."""
    return F.transform(F.array(w), lambda a: F.when(
        F.size(a) >= n, F.transform(F.sequence(F.lit(0), F.size(a) - n),
                                    lambda i: make([F.get(a, i + k) for k in range(n)]))))[0]


def gram_hashes(w: Column, n: int) -> Column:
    return F.array_distinct(F.coalesce(_windows(w, n, lambda g: F.xxhash64(*g)), F.array().cast("array<bigint>")))


def gram_texts(w: Column, n: int) -> Column:
    return F.array_distinct(F.coalesce(_windows(w, n, lambda g: F.concat_ws(" ", *g)), F.array().cast("array<string>")))


def item_table(items: DataFrame, item_col: str, text_col: str, gram: int, threshold_pct: int) -> DataFrame:
    """Item key, shingles, number needed and MinHash signature; items without a word have no row."""
    out = items.select(F.col(item_col).alias("item_id"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    out = out.withColumn("n", F.least(F.size("w"), F.lit(gram)))
    pick = lambda f: reduce(lambda e, n: F.when(F.col("n") == n, f(F.col("w"), n)).otherwise(e),
                            range(1, gram), f(F.col("w"), gram))
    out = out.select("item_id", "n", pick(gram_texts).alias("grams"), pick(gram_hashes).alias("hashes"))
    need = F.ceil(F.size("grams") * F.lit(threshold_pct) / F.lit(100)).cast("int")
    out = out.withColumn("need", need).withColumn(
        "sig", F.slice(F.array_sort("hashes"), 1, F.size("grams") - F.col("need") + 1)).drop("hashes")
    return materialize(out.withColumn("key", F.monotonically_increasing_id()), "items")


def find_items(docs: DataFrame, items: DataFrame, id_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", gram: int = GRAM,
               threshold_pct: int = THRESHOLD_PCT) -> DataFrame:
    """Pairs of a document and a test item it contains: ``id_cols``, ``item_id``, ``n_item``, ``n_shared``, ``containment``.

    A pair is returned when the document holds at least ``threshold_pct`` % of
    the item's distinct shingles of ``gram`` lower-case words.  An item of fewer
    words counts as one shingle of its own length.  Null, empty and wordless
    texts on either side match nothing; null ids are kept; rows with equal
    ids and counts come once; item ids that repeat are separate items, and pairs that
    then agree in every column come once.  Empty tables give an empty result.
    Columns besides the named ones are ignored.
    """
    spark = docs.sparkSession
    table = item_table(items, item_col, item_text_col, gram, threshold_pct)
    shape = table.groupBy("n").agg(F.count("*").alias("c"), F.sum(F.length(F.concat_ws(" ", "grams"))).alias("chars")).collect()
    ids = [F.col(c) for c in id_cols]
    base = docs.select(F.struct(*ids).alias("doc"), words(F.col(text_col)).alias("w"))
    found = []
    for n, count, chars in sorted(map(tuple, shape)):
        blocks = max(ceil(count / BLOCK_ITEMS), ceil(chars / gram / BLOCK_CHARS))
        hashed = base.withColumn("h", gram_hashes(F.col("w"), n))
        for b in range(blocks):
            block = table.where((F.col("n") == n) & (F.pmod(F.xxhash64("key"), F.lit(blocks)) == b))
            sig = block.select("key", "need", F.posexplode("sig").alias("rank", "hash"))
            hits = (hashed.select("doc", "w", "h", F.explode("h").alias("hash"))
                    .join(F.broadcast(sig), "hash")  # at most BLOCK_ITEMS signatures
                    .where(F.col("need") <= F.size("h")))
            hits = hits.join(F.broadcast(block.select("key", "item_id", "grams", "sig")), "key").where(
                ~F.arrays_overlap("h", F.slice("sig", 1, F.col("rank"))))
            found.append(hits.select("doc", "item_id", "need", F.size("grams").alias("n_item"),
                                     F.size(F.array_intersect("grams", gram_texts(F.col("w"), n))).alias("n_shared")))
    if not found:
        none = spark.createDataFrame([], base.select("doc").schema)
        zero = F.lit(0)
        found = [none.select("doc", F.lit(None).cast(items.schema[item_col].dataType).alias("item_id"),
                             zero.alias("need"), zero.alias("n_item"), zero.alias("n_shared"))]
    pairs = reduce(DataFrame.unionByName, found).where("n_shared >= need")
    return pairs.select("doc.*", "item_id", "n_item", "n_shared",
                        F.try_divide("n_shared", "n_item").alias("containment")).distinct()


def op9_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items contained in any document: 5-word shingles, containment 0.8 or more."""
    return find_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_ORACLE = r"""
WITH item AS (
  SELECT row_number() OVER () AS k, item_id,
         list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w
  FROM benchmark
), item_gram AS (
  SELECT DISTINCT k, item_id, least(len(w), 5) AS n,
         array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS g
  FROM (SELECT k, item_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM item WHERE len(w) > 0)
), doc AS (
  SELECT doc_id, row_number() OVER () AS r,
         list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w
  FROM documents
), doc_gram AS (
  SELECT DISTINCT doc_id, r, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc, (SELECT DISTINCT n FROM item_gram) WHERE len(w) >= n)
), size AS (SELECT k, item_id, n, count(*) AS n_item FROM item_gram GROUP BY ALL)
SELECT DISTINCT d.doc_id, s.item_id, CAST(s.n_item AS INTEGER) AS n_item, CAST(count(*) AS INTEGER) AS n_shared,
       count(*) / s.n_item AS containment
FROM doc_gram d JOIN item_gram i ON d.n = i.n AND d.g = i.g JOIN size s ON s.k = i.k
GROUP BY d.doc_id, d.r, s.k, s.item_id, s.n_item
HAVING count(*) * 100 >= 80 * s.n_item
"""

QUERIES = {"op9_contamination": op9_contamination}
ORACLES = {"op9_contamination": _ORACLE}
