"""SimHash near-duplicates through a Gray-order hierarchical index.

A fingerprint pair within ``max_bits`` = 2 differing bits touches at most two
of the eight bytes.  For each of the 28 choices of two free bytes the other six
form an upper node: a masked bit pattern shared by all fingerprints below it.
Two linked fingerprints meet, without accumulated difference, below at least one
common upper node, so the node key can deal the work out to tasks.  Inside a
task the rows arrive in Gray order of the masked-first bit sequence: an upper
node is one run, and consecutive rows differ in few bits.  Below the upper node
the two free bytes form two further levels; a child whose pattern already
differs by d bits is only searched for the 2-d bits left and pruned otherwise.

A node covers at most 2**16 distinct fingerprints, which bounds a task's memory
whatever the skew; equal fingerprints are collapsed first, so a group of copies
is one row.  A node emits a spanning star of its linked fingerprints instead of
its pairs, which keeps every component and is linear in the node.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.llm.common import materialize, read_table
from wardflow.llm.components import components

SEED = 42
MAX_BITS = 2
SHINGLE = 3
MASKS = tuple(combinations(range(8), 2))  # the two free bytes of each table
SMALL_NODE = 24  # up to this size a node is compared row by row at every offset
_POP = np.array([bin(i).count("1") for i in range(1 << 16)], dtype=np.uint8)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of one text; no word: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII space
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def simhash_column(text, shingle: int = SHINGLE):
    """Column with the fingerprint as a signed long."""
    @F.pandas_udf(T.LongType())
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))
    return simhash(text)


def gray_rank(code: np.ndarray) -> np.ndarray:
    """Rank of 16-bit codes in the Gray sequence (prefix exclusive-or)."""
    r = code ^ (code >> 1)
    r ^= r >> 2
    r ^= r >> 4
    return r ^ (r >> 8)


def upper_nodes(fps: DataFrame) -> DataFrame:
    """(node, rank) for each fingerprint below each of the 28 masks: 53-bit node id, Gray rank of the free bits."""
    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            by = b["fp"].to_numpy(np.int64).view(np.uint8).reshape(-1, 8).astype(np.int64)
            for i, (x, y) in enumerate(MASKS):
                node = np.full(len(by), i, dtype=np.int64)
                for k in range(8):
                    if k not in (x, y):
                        node = (node << 8) | by[:, k]
                yield pd.DataFrame({"node": node, "rank": gray_rank((by[:, x] << 8) | by[:, y]).astype(np.int32)})
    return fps.select("fp").mapInPandas(expand, "node long, rank int")


def _restore(node: np.ndarray, free: np.ndarray) -> np.ndarray:
    """Fingerprints (signed) from node ids and free bits."""
    out = np.zeros((len(node), 8), dtype=np.uint8)
    mask = (node >> 48).astype(np.int64)
    for i, (x, y) in enumerate(MASKS):
        own = mask == i
        if own.any():
            rest = [k for k in range(8) if k not in (x, y)]
            for pos, k in enumerate(rest):
                out[own, k] = (node[own] >> (8 * (5 - pos))) & 255
            out[own, x], out[own, y] = free[own] >> 8, free[own] & 255
    return out.view("<i8").reshape(-1)


def _settle(lab: np.ndarray, src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """Smallest reachable label over the given links."""
    while len(src):
        was = lab.copy()
        np.minimum.at(lab, src, lab[dst])
        np.minimum.at(lab, dst, lab[src])
        lab = lab[lab]
        if np.array_equal(was, lab):
            break
    return lab


def _big_node(free: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside one large node, level by level: first byte, then the bits left for the second."""
    at = np.full(1 << 16, -1, dtype=np.int64)
    at[free] = np.arange(len(free))
    child = np.zeros(256, dtype=bool)
    child[free >> 8] = True
    src, dst = [], []
    for hi in range(256):
        if _POP[hi] > max_bits:
            continue
        rows = np.flatnonzero(child[(free >> 8) ^ hi])  # the sibling group exists: else it is pruned whole
        if not len(rows):
            continue
        for lo in range(256):
            if (hi or lo) and _POP[hi] + _POP[lo] <= max_bits:
                j = at[free[rows] ^ ((hi << 8) | lo)]
                keep = j > rows
                if keep.any():
                    src.append(rows[keep])
                    dst.append(j[keep])
    if not src:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(src), np.concatenate(dst)


def _links(node: np.ndarray, free: np.ndarray, max_bits: int) -> pd.DataFrame:
    """Spanning stars of whole nodes; rows sorted by node and Gray rank."""
    n = len(node)
    new = np.empty(n, dtype=bool)
    new[:1] = True
    new[1:] = node[1:] != node[:-1]
    run = np.cumsum(new) - 1
    size = np.bincount(run)[run] if n else np.empty(0, np.int64)
    src, dst = [], []
    small = np.flatnonzero((size > 1) & (size <= SMALL_NODE))
    if len(small):
        r, f = run[small], free[small]
        for k in range(1, SMALL_NODE):
            near = (r[k:] == r[:-k]) & (_POP[f[k:] ^ f[:-k]] <= max_bits)
            if len(r) <= k or not (r[k:] == r[:-k]).any():
                break
            i = np.flatnonzero(near)
            src.append(small[i])
            dst.append(small[i + k])
    starts = np.flatnonzero(new & (size > SMALL_NODE))
    for s in starts:
        a, b = _big_node(free[s:s + size[s]], max_bits)
        src.append(a + s)
        dst.append(b + s)
    if not src:
        return pd.DataFrame({"u": np.empty(0, np.int64), "v": np.empty(0, np.int64)})
    lab = _settle(np.arange(n), np.concatenate(src), np.concatenate(dst))
    i = np.flatnonzero(lab != np.arange(n))
    return pd.DataFrame({"u": _restore(node[i], free[i]), "v": _restore(node[lab[i]], free[lab[i]])})


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints within ``max_bits`` (0 to 2) differing bits."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the masks of this index cover at most two differing bits")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, rank = np.empty(0, np.int64), np.empty(0, np.int64)
        for b in batches:
            node = np.concatenate([node, b["node"].to_numpy(np.int64)])
            rank = np.concatenate([rank, b["rank"].to_numpy(np.int64)])
            if not len(node):
                continue
            cut = int(np.searchsorted(node, node[-1]))  # the last node may go on in the next batch
            if cut:
                yield _links(node[:cut], rank[:cut] ^ (rank[:cut] >> 1), max_bits)
            node, rank = node[cut:], rank[cut:]
        if len(node):
            yield _links(node, rank ^ (rank >> 1), max_bits)

    dealt = upper_nodes(fps).repartition("node").sortWithinPartitions("node", "rank")
    return dealt.mapInPandas(search, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: ``id_col``, ``fp`` (signed long), ``component_id`` and ``root``.

    Texts are lower-cased in A-Z only, split at ASCII white space and hashed as
    ``shingle``-word windows.  Fingerprints within ``max_bits`` differing bits are
    linked; ``component_id`` is the smallest id reachable, ``root`` the smallest
    fingerprint, which tells groups apart also where ids are null or repeat.  Null and wordless
    texts have fingerprint 0 and are linked like any other; repeated rows stay
    as they are; rows of a null id keep null ids and get the smallest other id
    of their component, null if it has none.  Other columns are ignored, so
    their names cannot clash.  An empty table gives an empty result.
    """
    rows = materialize(docs.select(F.col(id_col).alias("id"), simhash_column(F.col(text_col), shingle).alias("fp")),
                       "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("id").alias("low")), "distinct")
    member = components(links(distinct, max_bits))
    roots = distinct.join(member, distinct["fp"] == member["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    roots = materialize(roots, "roots")
    lowest = roots.groupBy("root").agg(F.min("low").alias("component_id"))
    # only fingerprints that moved into another one's component need the lookup of their root
    classes = materialize(roots.join(lowest, "root").select("fp", "component_id", "root"), "classes")
    return rows.join(classes, "fp").select(F.col("id").alias(id_col), "fp", "component_id", "root")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of all documents: 3-word shingles, at most 2 differing bits."""
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op7_simhash": op7_simhash}
ORACLES: dict[str, str] = {}  # XXH64 is not a DuckDB function; tests compare with brute force
