"""Corpus pipeline: toxicity, SimHash near-duplicates, benchmark decontamination, secret scan, packing.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)``
and works on all that its predecessor kept.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import contamination, packing, secrets, simhash, toxicity
from wardflow.llm.common import materialize, read_table

BROADCAST_IDS = 1_000_000  # ids (8 bytes, digests 64) that are sent to every executor at most; more are joined by shuffle
TOXIC_SCORE = 0.5


def _without(docs: DataFrame, gone: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose ``key`` is not in ``gone`` (one column, no null)."""
    gone = materialize(gone.where(F.col(key).isNotNull()).distinct(), "gone")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, key, "left_anti").select(*docs.columns)


def _ids_tell_rows(ids: DataFrame) -> bool:
    """Whether every row has a ``doc_id`` of its own."""
    return ids.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").isEmpty()


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under one half; the chain is learned from the labels of ``sf_dir``."""
    chain = toxicity.train(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    scored = toxicity.tag(docs, chain, out_col="_toxicity")
    return scored.where(F.col("_toxicity.score") < TOXIC_SCORE).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: that of the smallest id (3-word shingles, at most 2 bits).

    Of rows that share this id, within a group, one stays.  A group without
    any id keeps one row.  Groups are told apart by their root fingerprint, so
    ids that are null or repeated on unlike texts lose no group.
    """
    classes = materialize(simhash.near_duplicates(docs), "classes")
    if _ids_tell_rows(classes):
        return _without(docs, classes.where("doc_id <> component_id").select("doc_id"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp")).alias("first")
    one = classes.groupBy("root").agg(first).select("first.doc_id", "first.fp")
    marked = docs.withColumn("_fp", simhash.simhash_column(F.col("text")))
    kept = marked.alias("d").join(one.alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id"))
                                  & (F.col("d._fp") == F.col("k.fp")), "left_semi")
    return kept.dropDuplicates(["doc_id", "_fp"]).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item (five-word shingles, containment 0.8 or more)."""
    items = read_table(spark, sf_dir, "benchmark")
    if _ids_tell_rows(docs):
        return _without(docs, contamination.find_items(docs, items).select("doc_id"))
    # rows without an id, or with that of another row, are told apart by their texts
    marked = docs.withColumn("_digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    found = contamination.find_items(marked, items, ("_digest",))
    return _without(marked, found.select("_digest"), "_digest").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the values of secrets masked; ``n_chars`` follows the text."""
    model = secrets.train(secrets.labelled_findings(spark))
    masked = secrets.redact(docs, model, path_col="source" if "source" in docs.columns else None)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
            F.length("text")).cast(kind))
    return masked.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    pieces = packing.pack(docs, ["doc_id"])
    return pieces.select(F.col("doc.doc_id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # trained models and token ids are no SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written once and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
