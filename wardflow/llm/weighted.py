"""Document fingerprints by consistent weighted sampling.

A text is a bag of words, each weighted by how often it occurs.  For every
sample number j and word x three random numbers that depend on (j, x) alone are
drawn: r and c from Gamma(2, 1), b uniform.  With weight w,

    t = floor(ln w / r + b),   ln a = ln c - r * (t - b + 1)

and the word of least a is the sample, together with its t.  Two texts have the
same sample j with a chance equal to their generalised Jaccard similarity, the
sum of the smaller weights over the sum of the larger ones.  The fingerprint is
``SAMPLES`` such samples of 16 bits each; the share of equal ones, freed of the
chance hits of 16-bit values, estimates the similarity.

All of it is DataFrame functions: words are counted inside each row, the
samples are plain minima of one packed long, computed before the shuffle.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.llm.common import materialize, read_table

SAMPLES = 48
SEED = 20_240_501
BITS = 16
WORD_BREAK = r"[^\p{L}\p{M}\p{N}]+"
_WEIGHT_BITS = 30  # a string of Spark has fewer words than 2**30
BUCKETS_PER_PARTITION = 8
MOST_BUCKETS = 4096  # cuts that the driver holds; a bucket is sorted with spilling
_STEP = 40_503  # odd: samples of one word at different t differ in their low bits


def term_weights(text: Column) -> Column:
    """Array of longs, one per word of a text: 33 bits of the word's hash, then 30 bits of its count.

    A text without a word is one term, the empty text none.
    """
    hashes = F.transform(F.split(F.lower(text), WORD_BREAK), lambda w: F.when(
        w != "", F.shiftrightunsigned(F.xxhash64(w), 64 - 33)))
    found = F.sort_array(F.array_compact(hashes))
    found = F.transform(F.array(F.struct(found.alias("s"), text.alias("t"))), lambda x: F.when(
        (F.size(x["s"]) == 0) & (x["t"] != ""), F.array(F.shiftrightunsigned(F.xxhash64(x["t"]), 64 - 33)))
        .otherwise(x["s"]))[0]
    bound = F.transform(F.array(found), lambda s: F.struct(
        s.alias("s"), F.filter(F.transform(s, lambda x, i: F.when(
            (i + 1 == F.size(s)) | (F.get(s, i + 1) != x), i + 1)), lambda e: e.isNotNull()).alias("e")))[0]
    # runs of equal hashes: e holds where each ends, counted from 1
    return F.transform(F.array(bound), lambda b: F.transform(b["e"], lambda e, k: F.shiftleft(
        F.get(b["s"], e - 1), _WEIGHT_BITS) + F.when(k == 0, e).otherwise(e - F.get(b["e"], k - 1))))[0]


_MASK = (1 << 31) - 1
_LOG_RANGE = 62 * math.log(2.0)


def _odd(bits: Column, shift: int) -> Column:
    """31 bits of a long, the last one set: over 2^31 a number inside (0, 1)."""
    return F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit(_MASK)).bitwiseOR(F.lit(1)).cast("double")


def _gamma(bits: Column) -> Column:
    """Gamma(2, 1): -ln of the product of two uniform numbers, from one hash."""
    return F.lit(_LOG_RANGE) - F.ln(_odd(bits, 0) * _odd(bits, 32))


def _packed(term: Column, log_weight: Column, j: int) -> Column:
    """ln a in fixed point above 24 bits of the sample (word, t); smaller is better.

    Two hashes give all: r from one, c from the other, b from bits of both.  ln a
    lies within -90 and 4 at any weight.  Words that occur once have t = 0.
    """
    one, two = (F.xxhash64(term, F.lit(SEED + 3 * j + k)) for k in range(2))
    r = _gamma(one)
    mixed = F.shiftrightunsigned(one, 11).bitwiseXOR(F.shiftrightunsigned(two, 32)).bitwiseAND(F.lit(_MASK))
    b = mixed.cast("double") * F.lit(2.0 ** -31)
    t = F.when(log_weight == 0, F.lit(0).cast("long")).otherwise(F.floor(log_weight / r + b))
    ln_a = F.ln(_gamma(two)) - r * (t - b + 1)
    level = ((ln_a + 512) * F.lit(float(1 << 28))).cast("long")
    return F.shiftleft(level, 24).bitwiseOR((term + t * _STEP).bitwiseAND(F.lit((1 << 24) - 1)))


def _signature(columns: list[Column]) -> Column:
    """Hex string of the samples' low 16 bits, in order; no word: zeros."""
    return F.concat(*[F.lpad(F.lower(F.hex(F.coalesce(c, F.lit(0)).bitwiseAND(F.lit((1 << BITS) - 1)))), BITS // 4, "0")
                      for c in columns])


def fingerprints(rows: DataFrame, keys: list[str], texts: dict[str, str], samples: int = SAMPLES) -> DataFrame:
    """``keys`` and a fingerprint per text column: ``texts`` maps one or two text columns to output columns.

    Rows of equal ``keys`` are one text: give keys that tell rows apart.  Words
    that both texts of a row hold with equal weight are sampled once.  The
    empty or null text has a fingerprint of zeros; equal texts have equal
    fingerprints whatever their row.  If the rows are already dealt out by one of
    the keys, nothing is shuffled; else the minima of each row are.  An empty
    table gives an empty result; columns not named are ignored.
    """
    names = list(texts)
    bags = rows.select(*keys, *[term_weights(F.coalesce(F.col(c), F.lit(""))).alias(f"_{i}") for i, c in enumerate(names)])
    if len(names) == 1:
        sets = {1: F.col("_0")}
    elif len(names) == 2:
        a, b = F.col("_0"), F.col("_1")
        sets = {3: F.array_intersect(a, b), 1: F.array_except(a, b), 2: F.array_except(b, a)}
    else:
        raise ValueError("one or two texts a row")
    none = F.array(F.struct(F.lit(None).cast("long").alias("x"), F.lit(0).alias("in")))  # keeps rows without a word

    def mark(terms: Column, sides: int) -> Column:
        return F.transform(terms, lambda x: F.struct(x.alias("x"), F.lit(sides).alias("in")))

    marked = [mark(terms, sides) for sides, terms in sets.items()]
    flat = bags.select(*keys, F.explode(F.concat(none, *marked)).alias("e")).select(
        *keys, F.col("e.in").alias("_in"), F.shiftright("e.x", _WEIGHT_BITS).alias("_term"),
        F.ln(F.col("e.x").bitwiseAND(F.lit((1 << _WEIGHT_BITS) - 1)).cast("double")).alias("_lw"))
    part = flat.groupBy(*keys, "_in").agg(*[
        F.min(_packed(F.col("_term"), F.col("_lw"), j)).alias(f"_m{j}") for j in range(samples)])
    got = part.groupBy(*keys).agg(*[
        F.min(F.when(F.col("_in").bitwiseAND(F.lit(1 << i)) != 0, F.col(f"_m{j}"))).alias(f"_s{i}_{j}")
        for i in range(len(names)) for j in range(samples)])
    return got.select(*keys, *[_signature([F.col(f"_s{i}_{j}") for j in range(samples)]).alias(out)
                               for i, out in enumerate(texts.values())])


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Estimated generalised Jaccard similarity of two fingerprints, 0 to 1."""
    size = BITS // 4
    same = sum((F.substring(a, 1 + size * j, size) == F.substring(b, 1 + size * j, size)).cast("int")
               for j in range(samples)) / F.lit(samples)
    chance = 2.0 ** -BITS
    return F.greatest(F.lit(0.0), (same - chance) / (1 - chance))


def with_neighbour(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document beside the next one in descending id order, after the last the first.

    Columns: ``bucket`` (the rows are dealt out by it), ``spare``, ``id``, ``rank`` (order among equal ids, a digest
    of the text), ``text`` and ``next_text``.  Ids are cut into buckets of about equal size at
    quantiles; rows of one id are told apart by a digest of their text, so that no id
    fills a bucket alone.  A bucket also gets a copy of the first row of the next one, marked ``spare``:
    the neighbour of its last row.  Null ids come last; null texts are empty.
    """
    spark = docs.sparkSession
    buckets = min(MOST_BUCKETS, BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("rank", F.shiftrightunsigned(F.xxhash64("text"), 1))
    share = F.col("rank").cast("double") * F.lit(2.0 ** -63)
    rows = rows.withColumn("place", F.when(F.col("id").isNull(), F.lit(-1e19) - F.lit(1e19) * (1 - share))
                           .otherwise(F.col("id").cast("double") + share))
    cuts = rows.approxQuantile("place", [i / buckets for i in range(1, buckets)], 0.25 / buckets)
    splits = [float("-inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    rows = Bucketizer(splits=splits, inputCol="place", outputCol="slot").transform(rows)
    rows = rows.select(F.col("slot").cast("int").alias("bucket"), F.lit(False).alias("spare"), "id", "rank", "text")
    # the first row of each bucket in descending order, for the bucket above it: as many rows as buckets
    first = rows.groupBy("bucket").agg(F.max(F.struct(F.col("id").isNotNull().alias("a"), "id", "rank")).alias("f"))
    first = materialize(first, "firsts")
    around = Window.orderBy("bucket")
    lowest = first.agg(F.min("bucket"), F.max("bucket")).first()
    first = first.select(F.coalesce(F.lead("bucket").over(around), F.lit(lowest[0])).alias("to"),
                         F.col("f.id").alias("fid"), F.col("f.rank").alias("frank"))
    spares = rows.join(F.broadcast(first), F.col("id").eqNullSafe(F.col("fid")) & (F.col("rank") == F.col("frank"))).select(
        F.col("to").alias("bucket"), F.lit(True).alias("spare"), "id", "rank", "text").dropDuplicates(["bucket"])
    both = rows.unionByName(spares)
    return both.withColumn("next_text", F.lead("text").over(_descending()))


def _descending():
    return Window.partitionBy("bucket").orderBy("spare", F.col("id").desc_nulls_last(), F.col("rank").desc())


def edited_text() -> Column:
    """The text with its last third (of its code points, rounded down) replaced by the next text's beginning."""
    third = F.floor(F.length("text") / 3).cast("int")
    return F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - third),
                    F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), third))


def op10_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike these and the next document are.

    The rows are shuffled once, by bucket; counting, sampling and the look at
    the neighbour stay within a bucket.
    """
    rows = with_neighbour(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = rows.withColumn("edited", edited_text()).withColumn("row", F.monotonically_increasing_id())
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("digest", F.unhex(F.sha2("edited", 256)))
    keys = ["bucket", "row", "spare", "id", "rank", "n_chars", "digest"]
    got = fingerprints(rows, keys, {"text": "fingerprint", "edited": "edited_fingerprint"})
    got = got.withColumn("next", F.lead("fingerprint").over(_descending()))
    return got.where("not spare").select(
        F.col("id").alias("doc_id"), "n_chars", F.lower(F.hex("digest")).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next")).alias("near_next"))


QUERIES = {"op10_weighted": op10_weighted}
ORACLES: dict[str, str] = {}  # XXH64 is not a DuckDB function; tests compare with brute force
