"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels mark documents, so the labelled tokens are derived first: over a bounded
sample, the words and word beginnings that occur (almost) only in toxic
documents, and there too often for chance, are chosen; their occurrences in
toxic documents are the tagged tokens.  A
two-state chain with hashed word-shape features is trained on windows around
them and on windows of clean documents.  Scoring runs forward-backward over
every token of every text; a document's score is the chance that at least one
of its three likeliest tokens is toxic, its offending offsets are the tokens
with a marginal of one half or more.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import read_table

SAMPLE_PER_CLASS = 2000  # labelled documents of each class that are fitted, at most
SAMPLE_CHARS = 20_000  # longer ones are left out of the sample; scoring reads whole texts
HELD_OUT_FOLD = 5  # crc32(doc_id) mod this = 0: never learned from
DIM = 1 << 18
WINDOW = 24  # tokens in a training window
EPOCHS = 40
RATE = 0.5
L2 = 1e-5
CHANCE = 12.0  # a telling feature's toxic documents: less than one chance in e**12
STEP_TOKENS = 300_000
BLOCK = 256
CACHE_WORDS = 200_000

_WORD = re.compile(r"\w+")


def held_out(doc_id: Column) -> Column:
    """Whether a row is outside the training fold (null ids: yes)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_FOLD == 0, F.lit(True))


def _shapes(word: str) -> tuple[str, ...]:
    """Features of one token."""
    w = word.lower()
    return ("w" + w, "s" + w[-3:], *(f"{k}{w[:k]}" if len(w) >= k else f"{k}" for k in range(3, 9)))


def _slots(word: str) -> list[int]:
    return [crc32(f.encode("utf-8", "surrogatepass")) % DIM for f in _shapes(word)]


def _telling(words: list[set[str]], toxic: np.ndarray) -> set[str]:
    """Words and beginnings that tell toxic documents.

    Near copies (equal minima under three hashes of their words) count once.  A
    feature is chosen if at least 98 % of its documents, classes weighed
    alike, are toxic, and chance would give so many toxic ones in less than
    one of ``e**CHANCE`` draws.
    """
    sketch = [tuple(min((crc32(w.encode("utf-8", "surrogatepass"), k) for w in ws), default=0) for k in (1, 2, 3))
              for ws in words]
    rows = list({(k, t): i for i, (k, t) in enumerate(zip(sketch, toxic.tolist(), strict=True))}.values())
    n_toxic = max(1, sum(bool(toxic[i]) for i in rows))
    n_clean = max(1, len(rows) - n_toxic)
    seen: dict[bool, Counter] = {True: Counter(), False: Counter()}
    for i in rows:
        seen[bool(toxic[i])].update({f for w in words[i] for f in _shapes(w) if f[0] in "w45678" and len(f) > 1})
    surprise = np.log((n_toxic + n_clean) / n_toxic)
    return {f for f, n in seen[True].items()
            if n * surprise >= CHANCE and seen[False][f] <= 0.02 * n * n_clean / n_toxic}


class Chain:
    """Weights of the chain: one score per feature for the toxic state, transitions and start in log space."""

    def __init__(self, theta: np.ndarray, bias: float, trans: np.ndarray, start: float):
        self.theta, self.bias, self.trans, self.start = theta, bias, trans, start

    def emission(self, word: str) -> float:
        return float(np.clip(self.bias + self.theta[_slots(word)].sum(), -30, 30))


def _windows(docs: list[list[str]], tags: list[np.ndarray], rng: np.random.Generator):
    """Training windows: around every tagged token of a document (at most 8 a document), and two random ones."""
    out = []
    for words, tag in zip(docs, tags, strict=True):
        if not words:
            continue
        hits = np.flatnonzero(tag)
        at = [max(0, h - int(rng.integers(WINDOW))) for h in hits[:8]]
        at += [int(rng.integers(max(1, len(words) - WINDOW + 1))) for _ in range(2)]
        out += [(words[a:a + WINDOW], tag[a:a + WINDOW]) for a in at]
    return out


def fit_chain(texts: list[str], labels: list[int], seed: int = 7) -> Chain:
    """Fit the chain on whole sample texts; without both classes it tags nothing."""
    toxic = np.array(labels, dtype=bool)
    if not toxic.any() or toxic.all():
        return Chain(np.zeros(DIM, np.float32), -30.0, np.zeros((2, 2)), 0.0)
    docs = [_WORD.findall(t) for t in texts]
    telling = _telling([set(d) for d in docs], toxic)
    marks: dict[str, bool] = {}
    tags = []
    for d, t in zip(docs, toxic, strict=True):
        for w in d:
            if w not in marks:
                marks[w] = any(f in telling for f in _shapes(w))
        tags.append(np.array([t and marks[w] for w in d], dtype=np.int8))
    rng = np.random.default_rng(seed)
    wins = _windows(docs, tags, rng)
    n = len(wins)
    slot = {w: _slots(w) for win, _ in wins for w in win}
    feats = np.zeros((n, WINDOW, len(_shapes(""))), np.int32)
    gold, mask = np.zeros((n, WINDOW)), np.zeros((n, WINDOW), bool)
    for i, (ws, tag) in enumerate(wins):
        feats[i, :len(ws)] = [slot[w] for w in ws]
        gold[i, :len(ws)], mask[i, :len(ws)] = tag, True
    return _train(feats, gold, mask, rng)


def _train(feats: np.ndarray, gold: np.ndarray, mask: np.ndarray, rng: np.random.Generator) -> Chain:
    """Maximise the conditional likelihood by AdaGrad on minibatches."""
    n, width = gold.shape
    theta, g_theta = np.zeros(DIM), np.full(DIM, 1e-8)
    rest, g_rest = np.zeros(6), np.full(6, 1e-8)  # bias, start, transitions 00 01 10 11
    rest[0] = -2.0
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(n), max(1, n // 2000)):
            f, y, m = feats[rows], gold[rows], mask[rows]
            s = np.clip(rest[0] + theta[f].sum(2), -30, 30)
            tr = rest[2:].reshape(2, 2)
            first = np.stack([np.zeros(len(rows)), rest[1] + s[:, 0]], 1)
            la, lb = [first], [np.zeros((len(rows), 2))]
            for t in range(1, width):
                nxt = np.logaddexp(la[-1][:, :1] + tr[0], la[-1][:, 1:] + tr[1])
                nxt[:, 1] += s[:, t]
                la.append(np.where(m[:, t, None], nxt, la[-1]))
            for t in range(width - 1, 0, -1):
                into = lb[-1] + np.stack([np.zeros(len(rows)), s[:, t]], 1)
                prev = np.logaddexp(tr[:, 0] + into[:, :1], tr[:, 1] + into[:, 1:])
                lb.append(np.where(m[:, t, None], prev, lb[-1]))
            lb.reverse()
            a, b = np.stack(la, 1), np.stack(lb, 1)
            z = np.logaddexp(a[:, -1, 0], a[:, -1, 1])
            p1 = np.exp(a[:, :, 1] + b[:, :, 1] - z[:, None]) * m
            g = (p1 - y * m) / len(rows)
            d_theta = np.bincount(f.reshape(-1), np.repeat(g.reshape(-1), f.shape[2]), DIM) + L2 * theta
            d_rest = np.zeros(6)
            d_rest[0], d_rest[1] = g.sum(), g[:, 0].sum()
            yi = y.astype(int)
            for u in (0, 1):
                for v in (0, 1):
                    pair = np.exp(a[:, :-1, u] + tr[u, v] + (s[:, 1:] if v else 0) + b[:, 1:, v] - z[:, None])
                    true = (yi[:, :-1] == u) & (yi[:, 1:] == v)
                    d_rest[2 + 2 * u + v] = ((pair - true) * m[:, 1:]).sum() / len(rows)
            d_rest[2:] += 1e-3 * rest[2:]
            g_theta += d_theta ** 2
            g_rest += d_rest ** 2
            theta -= RATE * d_theta / np.sqrt(g_theta)
            rest -= RATE * d_rest / np.sqrt(g_rest)
    return Chain(theta.astype(np.float32), float(rest[0]), rest[2:].reshape(2, 2).copy(), float(rest[1]))


def _scan(top, low, left, right, entry: float) -> np.ndarray:
    """x_t = (top_t x + low_t) / (left_t x + right_t) along rows, exactly, in blocks of columns.

    Each block's steps are first composed to one 2x2 matrix, the blocks' entry
    values follow from these one by one, and all blocks then run side by side.
    """
    n = len(top)
    nb = -(-n // BLOCK)
    pad = nb * BLOCK - n
    sides = [np.concatenate([c, np.full(pad, v)]).reshape(nb, BLOCK).T.copy()
             for c, v in ((top, 1.0), (low, 0.0), (left, 0.0), (right, 1.0))]
    m00, m01, m10, m11 = np.ones(nb), np.zeros(nb), np.zeros(nb), np.ones(nb)
    for a, b, c, d in zip(*sides, strict=True):
        m00, m10 = a * m00 + b * m10, c * m00 + d * m10
        m01, m11 = a * m01 + b * m11, c * m01 + d * m11
        scale = 1 / (m00 + m01 + m10 + m11)
        m00, m01, m10, m11 = m00 * scale, m01 * scale, m10 * scale, m11 * scale
    x = np.empty(nb)
    for i in range(nb):
        x[i] = entry
        entry = (m00[i] * entry + m01[i]) / (m10[i] * entry + m11[i])
    out = np.empty((BLOCK, nb))
    for t, (a, b, c, d) in enumerate(zip(*sides, strict=True)):
        x = (a * x + b) / (c * x + d)
        out[t] = x
    return out.T.reshape(-1)[:n]


def marginals(s: np.ndarray, first: np.ndarray, chain: Chain) -> np.ndarray:
    """Chance of the toxic state of each token; ``first`` marks the first token of each text."""
    if not len(s):
        return s
    e, t = np.exp(s), np.exp(chain.trans)
    one, zero = np.ones(len(s)), np.zeros(len(s))
    fwd = _scan(np.where(first, zero, e * t[1, 1]), np.where(first, e * np.exp(chain.start), e * t[0, 1]),
                np.where(first, zero, t[1, 0]), np.where(first, one, t[0, 0]), 1.0)
    last = np.append(first[1:], True)
    nxt = np.append(e[1:], 1.0)
    bwd = _scan(np.where(last, zero, t[1, 1] * nxt)[::-1], np.where(last, one, t[1, 0])[::-1],
                np.where(last, zero, t[0, 1] * nxt)[::-1], np.where(last, one, t[0, 0])[::-1], 1.0)[::-1]
    odds = fwd * bwd
    return odds / (1 + odds)


class _Emissions(dict):
    """Word to its number in ``scores``; unknown words are scored when first met."""

    def __init__(self, chain: Chain):
        super().__init__()
        self.chain, self.scores = chain, []

    def __missing__(self, word: str) -> int:
        self[word] = i = len(self.scores)
        self.scores.append(self.chain.emission(word))
        return i


def _score_step(texts: list[str], tokens: list[list[str]], known: _Emissions):
    lengths = np.array([len(t) for t in tokens])
    ids = np.fromiter((known[w] for ws in tokens for w in ws), np.int64, int(lengths.sum()))
    first = np.zeros(len(ids), bool)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    first[starts[:-1][lengths > 0]] = True
    p = marginals(np.array(known.scores)[ids] if len(ids) else np.empty(0), first, known.chain)
    for text, a, b in zip(texts, starts[:-1], starts[1:], strict=True):
        own = p[a:b]
        top = np.partition(own, len(own) - 3)[-3:] if len(own) > 3 else own
        hot = set(np.flatnonzero(own >= 0.5).tolist())
        spans = [m.span() for i, m in enumerate(_WORD.finditer(text)) if i in hot] if hot else []
        yield 1.0 - float(np.prod(1.0 - top)), [x for x, _ in spans], [y for _, y in spans]


def score_texts(texts: Iterable[str | None], chain: Chain, known: _Emissions | None = None):
    """(score, span starts, span ends) of each text, offsets in code points."""
    known = known if known is not None else _Emissions(chain)
    part, tokens, size = [], [], 0
    for t in texts:
        part.append(t or "")
        tokens.append(_WORD.findall(part[-1]))
        size += len(tokens[-1])
        if size >= STEP_TOKENS:
            yield from _score_step(part, tokens, known)
            part, tokens, size = [], [], 0
            if len(known) > CACHE_WORDS:
                known.clear()
                known.scores.clear()
    yield from _score_step(part, tokens, known)


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Chain:
    """Fit on at most ``per_class`` labelled documents of each class outside the held-out fold."""
    own = labels.select("doc_id", "toxic").where(~held_out(F.col("doc_id")))
    picked = [own.where(F.col("toxic") == c).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
              for c in (1, 0)]
    sample = picked[0].unionByName(picked[1])  # at most 2 * per_class ids
    rows = (docs.select("doc_id", "text").where(F.length("text") <= SAMPLE_CHARS)
            .join(F.broadcast(sample), "doc_id").select("toxic", "text").distinct()
            .orderBy(F.xxhash64("text"), "toxic").limit(2 * per_class).collect())
    return fit_chain([r["text"] for r in rows], [r["toxic"] for r in rows])


def tag(docs: DataFrame, chain: Chain, text_col: str = "text", out_col: str = "toxicity") -> DataFrame:
    """All input columns and ``out_col``: struct of ``score`` (0 to 1), ``starts`` and ``ends`` of the toxic spans.

    Null and empty texts score 0 and have no span; any text is scored whole.
    Repeated rows score alike.  An input column named like ``out_col`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # DIM weights, whatever the input

    @F.pandas_udf("score double, starts array<int>, ends array<int>")
    def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = _Emissions(shared.value)
        for texts in batches:
            yield pd.DataFrame(list(score_texts(texts, shared.value, known)), columns=["score", "starts", "ends"])

    return docs.withColumn(out_col, toxicity(F.col(text_col)))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents by a chain trained on the labels outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = tag(docs, train(docs, read_table(spark, sf_dir, "labels")))
    score = F.col("toxicity.score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"),
                         (score >= 0.5).cast("int").alias("predicted"), F.size("toxicity.starts").alias("n_spans"))


QUERIES = {"op4_toxicity": op4_toxicity}
ORACLES: dict[str, str] = {}  # a trained model: held-out accuracy is tested instead
