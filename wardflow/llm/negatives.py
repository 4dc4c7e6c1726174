"""Hard negatives by a packed R-tree over integer vectors.

Rows are packed by sort-tile-recursion: dealt out in ranges of label and first
coordinate, then tiled inside each subtree along the coordinates that vary
most, into leaves of ``LEAF`` rows and inner nodes of ``FAN`` children, each with its
minimum bounding box (the label is one more coordinate).  A box bounds the inner
product with an anchor from both sides, coordinate by coordinate: the larger of
q*lo and q*hi at most, the smaller at least.

The anchors are a stated query set, searched in blocks: every block meets the subtrees as a
stream, in ``SPLITS`` parts side by side, and keeps its best rows so far.  In a
subtree a queue takes the box of the highest bound first; anchors leave a box
whose bound lies strictly below their kth best row, outside their score windows,
or whose label excludes it.  The parts' best rows are merged.

All scores are whole numbers and exact.  Memory of a task: one block, its best rows and one subtree.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.llm.common import materialize, read_table

LEAF = 128
FAN = 8
SUBTREE = 8192  # rows, at most
BLOCK = 8192  # anchors, at most
SPLITS = 8
POSITIVES, NEGATIVES = 5, 3
_LOWEST = -(1 << 62)  # below every score


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, label: Column, scale: int = 256) -> DataFrame:
    """Columns ``id``, ``label`` and ``v``, the components as floor(scale * x); rows that take no part are left out."""
    x = F.col(vector_col)
    fine = label.isNotNull() & x.isNotNull() & ~F.exists(x, lambda e: F.isnull(e) | F.isnan(e) | (
        F.abs(e.cast("double")) == float("inf")))
    return rows.where(fine).select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                                   F.transform(x, lambda e: F.floor(e.cast("double") * scale)).alias("v"))


# ---- packing

def _tiles(v: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Order of the rows in which every ``LEAF`` neighbours are a tile."""
    spread = v.max(axis=0) - v.min(axis=0) if len(v) else np.zeros(v.shape[1])
    axes = np.argsort(-spread, kind="stable")[:3]

    def cut(rows: np.ndarray, axes: np.ndarray) -> list[np.ndarray]:
        if len(rows) <= LEAF or not len(axes):
            return [rows]
        rows = rows[np.argsort(v[rows, axes[0]], kind="stable")]
        leaves = -(-len(rows) // LEAF)
        slabs = max(1, round(leaves ** (1 / len(axes))))
        step = -(-leaves // slabs) * LEAF  # whole leaves in every slab
        return [part for at in range(0, len(rows), step) for part in cut(rows[at:at + step], axes[1:])]

    order = np.lexsort((np.arange(len(v)), label))
    ends = np.flatnonzero(np.diff(label[order])) + 1
    if len(ends) * LEAF > len(v):  # many labels: leaves hold several
        return order
    return np.concatenate([part for rows in np.split(order, ends) for part in cut(rows, axes)]) if len(v) else order


def _pack(kind: str, width: int):
    """Rows (id, label, v) of a partition, sorted, to one row per subtree of at most ``SUBTREE`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, ...]] = []

        def subtree(ids, no_id, label, v) -> pa.RecordBatch:
            nonlocal made
            order = _tiles(v, label)
            made += 1
            return pa.RecordBatch.from_pydict({
                "subtree": [part << 24 | made], "n": [len(order)], "ids": [ids[order].astype("<i8").tobytes()],
                "no_id": [no_id[order].astype(np.uint8).tobytes()], "labels": [label[order].astype("<i8").tobytes()],
                "v": [v[order].astype(kind).tobytes()]}, schema=_TREE_SCHEMA)

        for batch in batches:
            lists = batch["v"]
            size = lists.value_lengths().to_numpy()
            v = np.zeros((batch.num_rows, width), np.int64)  # shorter vectors end in zeros
            row = np.repeat(np.arange(batch.num_rows), size)
            v[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = lists.flatten().to_numpy()
            ids = batch["id"]
            held.append((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), batch["label"].to_numpy(), v))
            while sum(len(h[0]) for h in held) >= SUBTREE:
                whole = [np.concatenate(x) for x in zip(*held, strict=True)]
                yield subtree(*[x[:SUBTREE] for x in whole])
                held = [tuple(x[SUBTREE:] for x in whole)]
        if sum(len(h[0]) for h in held):
            yield subtree(*[np.concatenate(x) for x in zip(*held, strict=True)])
    return run


_TREE = "subtree long, n long, ids binary, no_id binary, labels binary, v binary"
_TREE_SCHEMA = pa.schema([("subtree", pa.int64()), ("n", pa.int64()), *[(c, pa.binary()) for c in ("ids", "no_id", "labels", "v")]])


class Tree:
    """The packed rows of one subtree and its boxes, leaves first; a box is (lo, hi) of every coordinate and of the label."""

    def __init__(self, ids: np.ndarray, no_id: np.ndarray, labels: np.ndarray, v: np.ndarray):
        self.ids, self.no_id, self.labels, self.v = ids, no_id, labels, v
        self.levels: list[tuple[np.ndarray, ...]] = []
        lo, hi, first, last = v, v, labels, labels
        step = LEAF
        while True:
            at = np.arange(0, len(lo), step)
            lo, hi = np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)
            first, last = np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)
            self.levels.append((lo, hi, first, last))
            if len(at) == 1:
                return
            step = FAN

    def search(self, block: Block) -> None:
        """Best-first over the boxes; ``block`` keeps the rows that stay among its anchors' best."""
        top = len(self.levels) - 1
        queue: list[tuple[int, int, int, np.ndarray]] = []

        def push(level: int, boxes: np.ndarray, active: np.ndarray) -> None:
            lo, hi, first, last = (x[boxes] for x in self.levels[level])
            up, down = block.up[active], block.down[active]
            most, least = up @ hi.T + down @ lo.T, up @ lo.T + down @ hi.T
            open_ = block.wants(active, most, least, first, last)
            for k, box in enumerate(boxes.tolist()):
                rows = open_[:, k]
                if rows.any():
                    heapq.heappush(queue, (-int(most[rows, k].max()), level, box, active[rows]))

        push(top, np.arange(len(self.levels[top][0])), np.arange(len(block.v)))
        while queue:
            _, level, box, active = heapq.heappop(queue)
            lo, hi, first, last = (x[box:box + 1] for x in self.levels[level])
            up, down = block.up[active], block.down[active]  # the kth best may have risen since
            active = active[block.wants(active, up @ hi.T + down @ lo.T, up @ lo.T + down @ hi.T, first, last)[:, 0]]
            if not len(active):
                continue
            if level:
                below = len(self.levels[level - 1][0])
                push(level - 1, np.arange(box * FAN, min((box + 1) * FAN, below)), active)
            else:
                rows = slice(box * LEAF, min((box + 1) * LEAF, len(self.ids)))
                block.meet(active, block.v[active] @ self.v[rows].T, self, rows)


class Block:
    """Anchors with their best rows so far; queries are rows of (anchor, window)."""

    def __init__(self, uid: np.ndarray, label: np.ndarray, v: np.ndarray, k: int):
        self.uid, self.label, self.v, self.k = uid, label, v, k
        self.up, self.down = np.maximum(v, 0), np.minimum(v, 0)
        self._set(len(uid))

    def _set(self, queries: int) -> None:
        self.kth = np.full(queries, _LOWEST, np.float64 if self.v.dtype == np.float64 else np.int64)
        none = np.zeros(0, np.int64)
        self.best = (none, none, none, none.astype(bool))  # query, score, id, without id

    def keep(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        query, score, ids, no_id = (np.concatenate(x) for x in zip(self.best, (query, score.astype(np.int64), ids, no_id), strict=True))
        order = np.lexsort((ids, no_id, -score, query))
        query = query[order]
        begin = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))
        rank = np.arange(len(query)) - np.repeat(begin, np.diff([*begin, len(query)]))
        stay = rank < self.k
        order, full = order[stay], query[rank == self.k - 1]
        self.best = (query[stay], score[order], ids[order], no_id[order])
        self.kth[full] = self.best[1][rank[stay] == self.k - 1]

    def wants(self, active, most, least, first, last) -> np.ndarray:
        raise NotImplementedError

    def meet(self, active, score, tree: Tree, rows: slice) -> None:
        raise NotImplementedError


class SameLabel(Block):
    """The best other rows of the anchor's label."""

    def wants(self, active, most, least, first, last):
        own = self.label[active][:, None]
        return (own >= first) & (own <= last) & (most >= self.kth[active][:, None])

    def meet(self, active, score, tree, rows):
        fits = (score >= self.kth[active][:, None]) & (tree.labels[rows][None, :] == self.label[active][:, None])
        fits &= (tree.base + np.arange(rows.start, rows.stop))[None, :] != self.uid[active][:, None]  # other rows than itself
        a, r = np.nonzero(fits)
        if len(a):
            self.keep(active[a], score[a, r], tree.ids[rows][r], tree.no_id[rows][r])


class InWindows(Block):
    """The best rows of another label in each of the anchor's score windows."""

    def __init__(self, uid, label, v, k, low: np.ndarray, high: np.ndarray):
        super().__init__(uid, label, v, k)
        self.low, self.high = low, high  # anchors x windows; an empty window has low > high
        self._set(low.size)

    def _floor(self, active):
        return np.maximum(self.low[active], self.kth.reshape(self.low.shape)[active])

    def wants(self, active, most, least, first, last):
        floor, high = self._floor(active), self.high[active]
        inside = ((most[:, :, None] >= floor[:, None, :]) & (least[:, :, None] <= high[:, None, :]) & (floor <= high)[:, None, :]).any(axis=2)
        own = self.label[active][:, None]
        return inside & ~((first == last) & (own == first))

    def meet(self, active, score, tree, rows):
        other = tree.labels[rows][None, :] != self.label[active][:, None]
        floor, high = self._floor(active), self.high[active]
        found = []
        for w in range(floor.shape[1]):
            a, r = np.nonzero(other & (score >= floor[:, w:w + 1]) & (score <= high[:, w:w + 1]))
            found.append((active[a] * floor.shape[1] + w, score[a, r], r))
        query, score, r = (np.concatenate(x) for x in zip(*found, strict=True))
        if len(query):
            self.keep(query, score, tree.ids[rows][r], tree.no_id[rows][r])


# ---- search

def _windows(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole scores s with low * positive <= 100 * s <= high * positive."""
    whole, rest = np.divmod(positive, 100)  # so that no product leaves a long
    return low * whole - (-low * rest // 100), high * whole + high * rest // 100


def _search(kind: str, width: int, exact: bool, k: int, window: tuple[int, int] | None):
    """Stream of rows by (block, split): its anchors first, then subtrees; gives the best rows of each query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.float64 if exact else np.int64
        key, anchors, block = None, [], None

        def begin() -> Block:
            anchors.sort(key=lambda r: r["uid"])
            uid = np.array([r["uid"] for r in anchors], np.int64)
            label = np.array([r["label"] for r in anchors], np.int64)
            v = np.stack([np.frombuffer(r["v"], kind) for r in anchors]).astype(number)
            if window is None:
                return SameLabel(uid, label, v, k)
            most = max(len(r["scores"]) for r in anchors)
            low, high = np.ones((len(anchors), most), np.int64), np.zeros((len(anchors), most), np.int64)
            for i, r in enumerate(anchors):
                low[i, :len(r["scores"])], high[i, :len(r["scores"])] = _windows(np.array(r["scores"], np.int64), *window)
            return InWindows(uid, label, v, k, low, high)

        def close() -> Iterator[pa.RecordBatch]:
            if block is None or not len(block.best[0]):
                return
            query, score, ids, no_id = block.best
            of = 1 if window is None else block.low.shape[1]
            yield pa.RecordBatch.from_arrays([
                pa.array(block.uid[query // of]), pa.array((query % of).astype(np.int32)), pa.array(score),
                pa.array(ids, mask=no_id)], schema=_BEST_SCHEMA)

        for batch in batches:
            for row in batch.to_pylist():
                if (row["block"], row["split"]) != key:
                    yield from close()
                    key, anchors, block = (row["block"], row["split"]), [], None
                if row["kind"] == 0:
                    anchors.append(row)
                    continue
                if not anchors:
                    continue
                if block is None:
                    block = begin()
                tree = Tree(np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["no_id"], np.uint8).astype(bool),
                            np.frombuffer(row["labels"], "<i8"), np.frombuffer(row["v"], kind).reshape(-1, width).astype(number))
                tree.base = row["uid"] * SUBTREE
                tree.search(block)
        yield from close()
    return run


_BEST = "uid long, w int, score long, id long"
_BEST_SCHEMA = pa.schema([("uid", pa.int64()), ("w", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])


def _best(stream: DataFrame, parts: int, search, k: int) -> DataFrame:
    """Run the stream of anchors and subtrees, and merge the best ``k`` of the splits; ``rank`` from 1."""
    dealt = stream.repartition(parts, "block", "split").sortWithinPartitions("block", "split", "kind", "uid")
    found = dealt.mapInArrow(search, _BEST)
    order = Window.partitionBy("uid", "w").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label: Column | None = None, scale: int = 256, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   window: tuple[int, int] = (50, 95), subtree: int = SUBTREE, block: int = BLOCK) -> DataFrame:
    """Hard negatives of the rows that ``anchors`` (a condition on the column ``id``) selects.

    Columns: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.  An
    anchor's positives are its ``positives`` best other rows of the same label;
    for each, the best ``negatives`` rows of another label whose score lies between
    window[0] and window[1] percent of the positive's.  Higher inner products of the
    whole-number vectors come first, ties by smaller id, rows without an id last.

    Rows with a null label or vector, or any null or non-finite component, take no part;
    shorter vectors end in zeros; repeated rows and ids are rows of their own.
    An empty table, or one without anchors or labels to match, gives an empty result.  Scores must fit a long.
    """
    label = F.col("label") if label is None else label
    subtree, block = min(subtree, SUBTREE), min(block, 1 << 22)
    clean = materialize(whole_vectors(rows, id_col, vector_col, label, scale), "vectors")
    seen = clean.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"),
                     F.max(F.greatest(F.lit(0), F.array_max(F.transform("v", lambda e: F.abs(e))))).alias("most"),
                     F.count(F.when(anchors, 1)).alias("anchors")).first()
    width, most = max(1, seen["width"] or 0), int(seen["most"] or 0)
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    bound = width * most * most
    if bound >= 1 << 62:
        raise ValueError(f"inner products of {width} components of up to {most} do not fit a long")
    exact = bound < 1 << 53  # whole numbers that a float holds exactly, in any order of adding
    parts = max(1, -(-seen["n"] // subtree))
    first = F.coalesce(F.get("v", F.lit(0)), F.lit(0))
    # ranges of label and first coordinate; a digest spreads rows that are alike in both
    sorted_ = clean.withColumn("x", first).withColumn("spread", F.xxhash64("id", "v")).repartitionByRange(
        parts, "label", "x", "spread").sortWithinPartitions("label", "x").select("id", "label", "v")
    tree = materialize(sorted_.mapInArrow(_pack(kind, width), _TREE), "tree")

    size = {"<i2": 2, "<i4": 4, "<i8": 8}[kind] * width

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, ids = row["n"], np.frombuffer(row["ids"], "<i8")
                no_id = np.frombuffer(row["no_id"], np.uint8).astype(bool)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["subtree"] * SUBTREE + np.arange(n)), pa.array(ids, mask=no_id),
                    pa.array(np.frombuffer(row["labels"], "<i8")),
                    pa.array([row["v"][i * size:(i + 1) * size] for i in range(n)], pa.binary())], names=["uid", "id", "label", "v"])

    blocks = max(1, -(-seen["anchors"] // block))
    asked = materialize(tree.mapInArrow(unpack, "uid long, id long, label long, v binary").where(anchors).withColumn(
        "block", F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int")), "anchors")
    split = F.pmod(F.xxhash64("subtree"), F.lit(SPLITS)).cast("int")
    subtrees = tree.select(split.alias("split"), F.lit(1).alias("kind"), F.col("subtree").alias("uid"), F.lit(0).cast("long").alias("label"),
                           "v", "ids", "no_id", "labels", F.lit(None).cast("array<long>").alias("scores"))
    to_all = subtrees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    none = F.lit(None).cast("binary")

    def stream(scored: DataFrame) -> DataFrame:
        own = scored.withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(SPLITS - 1)))).select(
            "split", F.lit(0).alias("kind"), "uid", "label", "v", none.alias("ids"), none.alias("no_id"), none.alias("labels"),
            "scores", "block")
        return own.unionByName(to_all)

    parts = blocks * SPLITS
    near = materialize(_best(stream(asked.withColumn("scores", F.lit(None).cast("array<long>"))), parts,
                             _search(kind, width, exact, positives, None), positives), "positives")
    scores = near.groupBy("uid").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda e: e["score"]).alias("scores"))
    hard = _best(stream(asked.join(scores, "uid")), parts, _search(kind, width, exact, negatives, window), negatives)
    pairs = near.select("uid", (F.col("rank") - 1).alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = hard.join(pairs, ["uid", "w"]).join(asked.select("uid", F.col("id").alias("anchor_id")), "uid")
    return found.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                        F.col("score").alias("negative_score"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th row; every 7th row's label is moved on by one first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=moved)


QUERIES = {"op11_negatives": op11_negatives}
ORACLES = {"op11_negatives": """
WITH rows AS (
  SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.uid, a.vec_id AS anchor_id, a.label AS anchor_label, b.uid AS other, b.vec_id AS id, b.label,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.uid <> b.uid WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, id) AS place FROM scored WHERE label = anchor_label
  QUALIFY place <= 5),
ranked AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.uid, p.other ORDER BY n.score DESC, n.id) AS rank
  FROM positives p JOIN scored n ON p.uid = n.uid AND n.label <> n.anchor_label
  WHERE 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""}
