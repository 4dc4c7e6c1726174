"""Bounded-space online packing of documents into training sequences.

Each partition reads its documents once, in order, and keeps ``open_windows``
windows open.  Whole windows of a long document become sequences of their own;
its rest goes to the open window it leaves the least room in (best fit).  When
it fits in none, the fullest window is emitted and a new one opened.  Memory is
``open_windows`` windows whatever the partition's size.  What is still open at
the end of ``merge_partitions`` neighbouring partitions is merged: the leftover
windows are strung together and cut at the window length, so that at most one
window per such group stays partly filled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.llm.bpe import token_ids, vocabulary_path
from wardflow.llm.common import materialize, read_table

WINDOW = 2048
OPEN_WINDOWS = 64
MERGE_PARTITIONS = 16
END_ID = 1
STEP_DOCS = 500  # documents tokenized at a time

_COLUMNS = ["row", "start", "length", "ids", "doc_tokens", "part", "window", "offset", "closed"]


class OpenWindows:
    """The open windows of one partition; pieces are tuples (row, start, length, ids, doc_tokens)."""

    def __init__(self, window: int, most: int):
        self.window, self.most, self.made = window, most, 0
        self.used: dict[int, int] = {}
        self.held: dict[int, list[tuple]] = {}

    def _new(self) -> int:
        self.made += 1
        return self.made - 1

    def place(self, piece: tuple) -> list[tuple]:
        """Put one piece of at most a window; returns the pieces of windows that this closed."""
        size, done = piece[2], []
        if size == self.window:
            return [(*piece, self._new(), 0)]
        fits = [(u, -w) for w, u in self.used.items() if u + size <= self.window]
        if fits:
            w = -max(fits)[1]  # least room left; among equals the oldest
        else:
            if len(self.used) >= self.most:
                full = max(self.used, key=lambda k: (self.used[k], -k))
                done = self._close(full)
            w = self._new()
            self.used[w], self.held[w] = 0, []
        self.held[w].append((*piece, w, self.used[w]))
        self.used[w] += size
        if self.used[w] == self.window:
            done += self._close(w)
        return done

    def _close(self, w: int) -> list[tuple]:
        del self.used[w]
        return self.held.pop(w)

    def rest(self) -> list[tuple]:
        return [p for w in sorted(self.held) for p in self.held[w]]


def pack(docs: DataFrame, keep: list[str], text_col: str = "text", window: int = WINDOW,
         open_windows: int = OPEN_WINDOWS, merge_partitions: int = MERGE_PARTITIONS, end_id: int = END_ID,
         tokenizer: str | None = None) -> DataFrame:
    """Pieces of packed sequences, one row each.

    Columns: ``doc`` (struct of the ``keep`` columns), ``start`` (the document's
    ids before the piece), ``length``, ``ids`` (binary, little-endian unsigned
    32-bit ids), ``doc_tokens`` (with the end id), ``sequence_id`` and ``offset``
    (its place there; each sequence is filled without a gap from 0 to at most
    ``window``).  A document's ids are its text's, then ``end_id``; a null or
    empty text is the end id alone.  Repeated rows and ids are packed as they
    come, null ids are kept, an empty table gives an empty result.  Columns not
    in ``keep`` are ignored.
    """
    path = tokenizer or vocabulary_path()
    row = F.struct(*[F.col(c) for c in keep])
    source = docs.select(row.alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    doc_type = source.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, state, part = token_ids(path), OpenWindows(window, open_windows), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()

        def frame(pieces: list[tuple], closed: bool) -> pd.DataFrame:
            rows = [(*p[:5], part, p[5], p[6], closed) for p in pieces]
            out = pd.DataFrame(rows, columns=_COLUMNS)
            return pd.concat([pd.DataFrame(list(out.pop("row")), columns=list(keep), index=out.index), out], axis=1)

        for batch in batches:
            ids_of = list(batch["doc"].itertuples(index=False, name=None)) if isinstance(batch["doc"], pd.DataFrame) \
                else [tuple(d.values()) for d in batch["doc"]]
            texts = batch["text"].tolist()
            for at in range(0, len(texts), STEP_DOCS):
                done: list[tuple] = []
                for key, ids in zip(ids_of[at:at + STEP_DOCS], encoder.encode(texts[at:at + STEP_DOCS]), strict=True):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        size = min(window, total - start)
                        done += state.place((key, start, size, ids[4 * start:4 * (start + size)], total))
                if done:
                    yield frame(done, True)
        if state.held:
            yield frame(state.rest(), False)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema["doc"].dataType.fields)
    assert doc_type.startswith("struct<")
    schema = f"{fields}, start long, length long, ids binary, doc_tokens long, part long, window long, offset long, closed boolean"
    placed = materialize(source.mapInPandas(run, schema), "pieces").withColumn("doc", row)
    closed = placed.where("closed").select(
        "doc", "start", "length", "ids", "doc_tokens",
        (F.shiftleft("part", 32) + F.col("window") * 2).alias("sequence_id"), "offset")
    return closed.unionByName(_merge(placed.where("not closed"), window, merge_partitions))


def _merge(left: DataFrame, window: int, merge_partitions: int) -> DataFrame:
    """String the leftover windows of neighbouring partitions together and cut them at the window length."""
    group: Column = F.floor(F.col("part") / merge_partitions).cast("long")
    # bounded: merge_partitions * open_windows windows in a group
    order = Window.partitionBy("group").orderBy("part", "window", "offset").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    at = left.withColumn("group", group).withColumn("stop", F.sum("length").over(order))
    at = at.withColumn("begin", F.col("stop") - F.col("length"))
    cut = at.withColumn("no", F.explode(F.sequence(F.floor(F.col("begin") / window),
                                                   F.floor((F.col("stop") - 1) / window))))
    cut = (cut.withColumn("from", F.greatest(F.col("begin"), F.col("no") * window))
           .withColumn("to", F.least(F.col("stop"), (F.col("no") + 1) * window))
           .withColumn("skip", F.col("from") - F.col("begin")))
    size = F.col("to") - F.col("from")
    return cut.select(
        "doc", (F.col("start") + F.col("skip")).alias("start"), size.alias("length"),
        F.expr("substring(ids, cast(skip * 4 + 1 as int), cast((`to` - `from`) * 4 as int))").alias("ids"),
        "doc_tokens",
        (F.shiftleft(F.col("group") * merge_partitions, 32) + F.col("no") * 2 + 1).alias("sequence_id"),
        (F.col("from") - F.col("no") * window).alias("offset"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens; the ids of each piece as a checksum."""
    pieces = pack(read_table(spark, sf_dir, "documents"), ["doc_id"])
    return pieces.select(F.col("doc.doc_id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


QUERIES = {"op2_packing": op2_packing}
ORACLES: dict[str, str] = {}  # token ids are no SQL; tests rebuild every document from its pieces
