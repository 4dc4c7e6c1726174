"""How the sources of a language differ in their words.

Texts become columns of terms inside Arrow: ``ascii_lower``, ``split_pattern_regex``,
``dictionary_encode`` and a hash ``group_by`` turn each batch into one row per
(lang, source, term) with its occurrences and documents.  Spark adds these
partial counts up and deals the kept terms out in columnar shards by term, so
that no language, source or term is one task's work.  A shard holds, for a block of
terms, the counts of all sources side by side, and gives its share of every
divergence; the shares are added up.

Smoothed share of a term, in billionths: p = 1 + floor(10^9 (count + 2) / (N + 2 V)),
N the group's kept occurrences, V the language's kept terms.  A term's
divergence between two shares: floor((p - q)^2 / (p + q)).  All of it is in
whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.llm.common import materialize, read_table

LEAST_DOCUMENTS = 10
TOP_TERMS = 10
BREAK = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"  # what stands between terms
STEP_BYTES = 4 << 20  # text that is split at a time
HELD_ROWS = 400_000  # partial counts that a task holds before it emits them
BLOCK_CELLS = 1 << 19  # counts of a block of terms, side by side for all sources
PAIR_CELLS = 1 << 22  # sums of pairs of sources that a shard holds (up to 2,048 sources) before it emits them

_PARTIAL = "lang string, source string, term string, n long, docs long"
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``STEP_BYTES`` of text, whole rows each."""
    ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + STEP_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def _count(batch: pa.RecordBatch) -> pa.Table:
    """Rows (lang, source, term, n, docs) of a batch; the term '' stands for the documents themselves."""
    words = pc.split_pattern_regex(pc.ascii_lower(batch["text"]), BREAK)
    of, term = pc.list_parent_indices(words), pc.list_flatten(words)
    real = pc.not_equal(term, "")  # the split leaves an empty string at either end
    of, term = of.filter(real), term.filter(real).dictionary_encode()
    keys = pa.table({"lang": batch["lang"], "source": batch["source"], "row": pa.array(np.arange(batch.num_rows))})
    groups = keys.group_by(["lang", "source"], use_threads=False).aggregate([("row", "list"), ("row", "count")])
    number = np.empty(batch.num_rows, np.int64)
    number[np.concatenate([r.values.to_numpy() for r in groups["row_list"]])] = np.repeat(
        np.arange(len(groups)), groups["row_count"].to_numpy())
    once = pa.table({"of": of, "term": term.indices}).group_by(["of", "term"], use_threads=False).aggregate([([], "count_all")])
    once = once.append_column("group", pa.array(number[once["of"].to_numpy()]))
    done = once.group_by(["group", "term"], use_threads=False).aggregate([("count_all", "sum"), ("count_all", "count")])
    at = done["group"]
    counts = pa.table([groups["lang"].take(at), groups["source"].take(at), term.dictionary.take(done["term"].combine_chunks()),
                       done["count_all_sum"], done["count_all_count"]], schema=_COUNTS)
    own = pa.table([groups["lang"], groups["source"], pa.array([""] * len(groups), pa.string()),
                    pa.array(np.zeros(len(groups), np.int64)), groups["row_count"]], schema=_COUNTS)
    return pa.concat_tables([counts, own])


def _added(tables: list[pa.Table]) -> pa.Table:
    whole = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return whole.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(_COUNTS.names)


def partial_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Occurrences ``n`` and documents ``docs`` of each (lang, source, term), partial: several rows may share a key.

    Rows of the term '' count the documents of a group, with or without terms.
    """
    def text(name: str, out: str):
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(out)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            batch = pa.RecordBatch.from_arrays([batch[c].cast(pa.string()) for c in ("text", "lang", "source")], ["text", "lang", "source"])
            for part in _slices(batch):
                held.append(_count(part))
                rows += len(held[-1])
                if rows >= HELD_ROWS:
                    held = [_added(held)]
                    rows = len(held[0])
                    if rows >= HELD_ROWS // 2:
                        yield from held[0].to_batches()
                        held, rows = [], 0
        if held:
            yield from _added(held).to_batches()

    return docs.select(text(text_col, "text"), text(lang_col, "lang"), text(source_col, "source")).mapInArrow(count, _PARTIAL)


def kept_terms(counts: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """Whole counts of the terms in at least so many documents of their language, with the language's count ``all``.

    Rows of the term '' (documents of a group) stay.  One shuffle by (lang, term): a
    key is at most one row per source and task.
    """
    dealt = counts.repartition("lang", "term")
    sums = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    own = Window.partitionBy("lang", "term")
    sums = sums.withColumn("all", F.sum("n").over(own)).withColumn("in_docs", F.sum("docs").over(own))
    return sums.where((F.col("in_docs") >= least_documents) | (F.col("term") == "")).select("lang", "source", "term", "n", "all")


def totals(kept: DataFrame) -> DataFrame:
    """One row per (lang, source): ``size`` its kept occurrences, ``lang_size`` the language's, ``terms`` its kept terms."""
    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    first = F.row_number().over(Window.partitionBy("lang", "term").orderBy("source")) == 1
    of_lang = kept.where("term <> ''").withColumn("first", first).where("first").groupBy("lang").agg(
        F.sum("all").alias("lang_size"), F.count(F.lit(1)).alias("terms"))
    both = of_group.join(of_lang, "lang", "left")
    return both.select("lang", "source", "size", F.coalesce("lang_size", F.lit(0)).alias("lang_size"),
                       F.coalesce("terms", F.lit(0)).alias("terms"))


def shares(count: np.ndarray, size: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / (size + 2 terms)), by long division in three steps: exact below 9 * 10^15 occurrences."""
    whole = size + 2 * terms
    out, rest = np.divmod(count + 2, whole)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digit
    return out + 1


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


_SHARE = "lang string, source string, part string, item string, value long"
_SHARES = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


class _Shard:
    """The shares of one language in one shard: pairs of sources, and terms that a source uses more than its language."""

    def __init__(self, groups: pa.Table):
        self.lang = groups["lang"][0].as_py()
        self.sources = groups["source"].combine_chunks()
        self.size = groups["size"].to_numpy()
        self.lang_size, self.terms = groups["lang_size"][0].as_py(), groups["terms"][0].as_py()
        n = len(groups)
        self.width = max(1, BLOCK_CELLS // n)
        self.sums = np.zeros((n, n), np.int64) if n * n <= PAIR_CELLS else None

    def _rows(self, source: pa.Array, part: str, item: pa.Array, value: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(self.lang), len(value)), source, pa.repeat(pa.scalar(part), len(value)),
                                           item, pa.array(value, pa.int64())], schema=_SHARES)

    def _pairs(self, i: int, values: np.ndarray) -> pa.RecordBatch:
        return self._rows(pa.repeat(self.sources[i], len(values)), "pair", self.sources[i + 1:], values)

    def block(self, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """Rows (term, source, n, all) in the order of the terms, all rows of each."""
        term, n = rows["term"].combine_chunks(), rows["n"].to_numpy()
        begins = np.flatnonzero(np.concatenate([[True], pc.not_equal(term[1:], term[:-1]).to_numpy(zero_copy_only=False)]))
        at = pc.index_in(rows["source"], value_set=self.sources).to_numpy()
        of = np.repeat(np.arange(len(begins)), np.diff([*begins, len(n)]))
        counts = np.zeros((len(self.sources), len(begins)), np.int64)
        counts[at, of] = n
        p = shares(counts, self.size[:, None], self.terms)
        q = shares(rows["all"].to_numpy()[begins], self.lang_size, self.terms)
        own, usual = p[at, of], q[of]
        more = np.flatnonzero(own > usual)
        if len(more):
            yield self._rows(self.sources.take(pa.array(at[more])), "term", term.take(pa.array(more)),
                             difference(own[more], usual[more]))
        for i in range(len(self.sources) - 1):
            values = difference(p[i], p[i + 1:]).sum(axis=1)
            if self.sums is None:
                yield self._pairs(i, values)
            else:
                self.sums[i, i + 1:] += values

    def rest(self) -> Iterator[pa.RecordBatch]:
        for i in range(len(self.sources) - 1):
            if self.sums is not None:
                yield self._pairs(i, self.sums[i, i + 1:])


def _runs(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    """The batch cut where shard, lang or kind change."""
    new = np.zeros(batch.num_rows, bool)
    for name in ("shard", "lang", "kind"):
        column = batch[name]
        new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield pa.Table.from_batches([batch.slice(a, b - a)])


def _shard_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by shard, lang, kind (groups first) and term; see ``divergences``."""
    key, groups, shard, held = None, None, None, None

    def close() -> Iterator[pa.RecordBatch]:
        own = shard
        if key is not None and own is None and key[0] == 0:  # shard 0 gives every pair, also without a term
            own = _Shard(groups)
        if own is None:
            return
        if held is not None and len(held):
            yield from own.block(held)
        yield from own.rest()
        if own.sums is None and key[0] == 0:
            for i in range(len(own.sources) - 1):
                yield own._pairs(i, np.zeros(len(own.sources) - 1 - i, np.int64))

    for batch in batches:
        for run in _runs(batch):
            now = (run["shard"][0].as_py(), run["lang"][0].as_py())
            if now != key:
                yield from close()
                key, groups, shard, held = now, None, None, None
            if run["kind"][0].as_py() == 0:
                groups = run if groups is None else pa.concat_tables([groups, run])
                continue
            shard = shard or _Shard(groups)
            run = run.select(["term", "source", "n", "all"])
            held = run if held is None else pa.concat_tables([held, run])
            while len(held) >= shard.width + len(shard.sources):  # a block of whole terms; a term has at most a row per source
                end = shard.width
                while end < len(held) and held["term"][end] == held["term"][end - 1]:
                    end += 1
                yield from shard.block(held.slice(0, end))
                held = held.slice(end)
    yield from close()


def divergences(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS, text_col: str = "text",
                lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Columns ``lang, source, part, item, value, rank``: how a group differs from the other sources and from its language.

    Part ``pair``: one row per other source of the language, all of them; part ``term``: the
    ``top_terms`` terms that the group uses more than its language.  Ranks
    count from 1 by value descending, then item ascending in UTF-8.  Null text,
    lang and source are ''; a group without terms takes part with counts of 0, a
    language without kept terms gives pairs of value 0; repeated rows count as
    documents of their own; other columns are ignored; an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = materialize(kept_terms(partial_counts(docs, text_col, lang_col, source_col), least_documents), "kept_terms")
    groups = materialize(totals(kept), "groups")
    every = groups.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "lang", F.lit(0).alias("kind"),
                          F.lit("").alias("term"), "source", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("all"),
                          "size", "lang_size", "terms")
    none = F.lit(0).cast("long")
    terms = kept.where("term <> ''").select(
        F.pmod(F.xxhash64("lang", "term"), F.lit(shards)).cast("int").alias("shard"), "lang", F.lit(1).alias("kind"), "term", "source",
        "n", "all", none.alias("size"), none.alias("lang_size"), none.alias("terms"))
    dealt = every.unionByName(terms).repartition(shards, "shard").sortWithinPartitions("shard", "lang", "kind", "term", "source")
    parts = dealt.mapInArrow(_shard_rows, _SHARE)
    sums = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))  # a term has one row
    both = sums.withColumn("turned", F.explode(F.when(F.col("part") == "pair", F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False)))))
    both = both.select("lang", F.when(F.col("turned"), F.col("item")).otherwise(F.col("source")).alias("source"), "part",
                       F.when(F.col("turned"), F.col("source")).otherwise(F.col("item")).alias("item"), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    first = both.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    pairs = both.where("part = 'pair'").withColumn("rank", F.row_number().over(order))
    return first.unionByName(pairs).select("lang", "source", "part", "item", "value", "rank")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergences of all (lang, source) groups of ``documents``."""
    return divergences(read_table(spark, sf_dir, "documents").select("text", "lang", "source"))


QUERIES = {"op13_divergence": op13_divergence}
ORACLES = {"op13_divergence": r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
words AS (SELECT doc, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept USING (lang, term) GROUP BY w.lang, w.source, w.term),
sizes AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS size FROM groups g LEFT JOIN counts c
          ON g.lang = c.lang AND g.source = c.source GROUP BY g.lang, g.source),
cells AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (s.size + 2 * l.v) AS p,
         1 + 1000000000::HUGEINT * (k.total + 2) // (l.n + 2 * l.v) AS q
  FROM sizes s JOIN kept k ON s.lang = k.lang JOIN langs l ON s.lang = l.lang
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
summed AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
telling AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM cells WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM telling))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""}
