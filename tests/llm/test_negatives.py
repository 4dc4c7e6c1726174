import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string, uid string"


def _brute(rows, every=50, positives=5, most=3):
    """Rows (vec_id, vector, label) -> sorted result rows, by sorting everything, in Python integers."""
    clean = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        clean.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    for a, (i, v, label) in enumerate(clean):
        if i is None or i % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w, strict=False)), j is None, j or 0, j, other)
                         for b, (j, w, other) in enumerate(clean) if b != a), key=lambda r: r[:3])
        for s, _, _, j, _ in [r for r in scored if r[4] == label][:positives]:
            near = [r for r in scored if r[4] != label and 50 * -s <= 100 * -r[0] <= 95 * -s][:most]
            out += [(i, j, k, n[3], -s, -n[0]) for k, n in enumerate(near, 1)]
    return sorted(out, key=str)


def _got(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = negatives.hard_negatives(df, F.col("id") % kw.pop("every", 50) == 0, label=moved, **kw)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_odd_rows(spark):
    random.seed(8)

    def vector(n=6):
        return [random.choice([0.0, 0.5, -0.25, 1.0, random.uniform(-1, 1)]) for _ in range(n)]
    rows = [(i, vector(), random.randrange(4)) for i in range(160)]
    rows += rows[40:60] + rows[50:52]  # repeated rows, an anchor among them
    rows += [(i, [1.0, 1.0, 0.0, 0.0, 0.0, 0.0], i % 3) for i in range(200, 260)]  # ties
    rows += [(None, vector(), 1), (None, [0.5] * 6, 2), (300, None, 1), (301, vector(), None), (302, [1.0, None], 1),
             (303, [float("nan")] * 6, 1), (304, [float("inf")] * 6, 2), (305, [], 1), (306, [0.5], 0), (350, [0.25, 0.5], 2),
             (400, vector(9), 3), (450, [], 2), (500, [-1.0] * 6, 9)]
    want = _brute(rows)
    assert len(want) > 60
    assert _got(spark, rows) == want
    assert _got(spark, rows, subtree=40, block=3) == want
    assert _got(spark, []) == [] and _got(spark, [(1, [1.0], 1)]) == [] and _got(spark, [(50, None, None)]) == []


def test_large_components_and_many_labels(spark):
    random.seed(9)
    rows = [(i, [random.uniform(-3e6, 3e6) for _ in range(4)], i % 90) for i in range(400)]  # beyond what a float adds exactly
    assert _got(spark, rows, every=25, subtree=100) == _brute(rows, 25)
    rows = [(i, [random.uniform(0, 1) for _ in range(4)], random.randrange(200)) for i in range(500)]
    assert _got(spark, rows) == _brute(rows)
    with pytest.raises(ValueError, match="do not fit a long"):
        _got(spark, [(0, [1e30], 1), (1, [1e30], 1)])


def _tree(ids, labels, v):
    order = negatives._tiles(v, labels)
    tree = negatives.Tree(ids[order], np.zeros(len(ids), bool), labels[order], v[order])
    tree.base = 0
    return tree, order


def test_queue_visits_few_leaves_of_clustered_rows():
    rng = np.random.default_rng(1)
    centre = rng.normal(0, 200, (40, 8))
    v = np.floor(np.repeat(centre, 200, axis=0) + rng.normal(0, 3, (8000, 8)))
    labels = rng.integers(0, 3, 8000)
    tree, order = _tree(np.arange(8000), labels, v)
    met = []

    class Counted(negatives.SameLabel):
        def meet(self, active, score, tree, rows):
            met.append(len(active))
            super().meet(active, score, tree, rows)
    block = Counted(np.full(100, -1), labels[:8000:80], v[::80], 5)
    tree.search(block)
    for a in range(100):
        score = np.where(labels == block.label[a], v @ block.v[a], -np.inf)
        best = np.lexsort((np.arange(8000), -score))[:5]
        mine = block.best[0] == a
        assert block.best[2][mine].tolist() == best.tolist()
    assert sum(met) < 0.25 * 100 * len(tree.levels[0][0])


def test_boxes_bound_every_score():
    rng = np.random.default_rng(2)
    v = np.floor(rng.normal(0, 50, (3000, 5)))
    tree, order = _tree(np.arange(3000), rng.integers(0, 9, 3000), v)
    q = np.floor(rng.normal(0, 50, (20, 5)))
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    score, size = q @ tree.v.T, negatives.LEAF
    for lo, hi, first, last in tree.levels:
        for k in range(len(lo)):
            rows = slice(k * size, (k + 1) * size)
            assert (score[:, rows].max(axis=1) <= up @ hi[k] + down @ lo[k]).all()
            assert (score[:, rows].min(axis=1) >= up @ lo[k] + down @ hi[k]).all()
            assert first[k] == tree.labels[rows].min() and last[k] == tree.labels[rows].max()
        size *= negatives.FAN


def test_windows_are_exact_at_their_borders():
    for s in range(-30, 400):
        low, high = negatives._windows(np.array([s]), 50, 95)
        assert [n for n in range(-40, 420) if 50 * s <= 100 * n <= 95 * s] == list(range(low[0], high[0] + 1))
