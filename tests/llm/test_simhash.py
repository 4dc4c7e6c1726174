import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from wardflow.llm import simhash
from wardflow.llm.components import components


def _slow_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
             .translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ") if w]
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def _slow_classes(rows):
    """Union of all pairs at 2 or fewer differing bits."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if (a ^ b).bit_count() <= 2:
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            low[r] = min(low.get(r, d), d)
    return [low.get(find(i)) for i in range(len(rows))]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB c\t\né中", max_size=40))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == _slow_fingerprint(text)


def test_links_of_dense_fingerprints(spark):
    """Large and small nodes, chains, exact bounds: against all pairs."""
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(0, 1 << 62, 6)]
    fps = set()
    for b in base:
        for _ in range(60):
            f = b
            for bit in rng.integers(0, 64, int(rng.integers(0, 6))):
                f ^= 1 << int(bit)
            fps.add(f)
        fps.update(b ^ int(x) for x in rng.integers(0, 1 << 16, 60))  # one node below a mask
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r["node"]: r["root"] for r in components(simhash.links(df)).collect()}
    want = _slow_classes([(f, int(np.int64(f).astype(np.uint64))) for f in signed])
    assert [got.get(f, f) for f in signed] == want
    assert len(set(want)) < len(want)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    got = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 160)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_query_against_brute_force(spark, sf_small):
    got = {r["doc_id"]: r for r in simhash.op7_simhash(spark, sf_small).collect()}
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r["doc_id"], _slow_fingerprint(r["text"])) for r in docs]
    assert len(got) == len(rows)
    for (d, f), c in zip(rows, _slow_classes(rows), strict=True):
        assert (got[d]["fingerprint"], got[d]["component_id"]) == (f"{f:016x}", c)


def test_odd_rows(odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["fp"], r["component_id"]))
    assert by[1][0] == by[1][1] and by[2][0] == by[1][0]  # case and blanks do not count
    assert {by[i][0] for i in (3, 4, 5)} == {(0, 3)} and (0, 3) in by[None]  # no word: one class
    assert any(c is None for _, c in by[None])  # a class without any id
    assert simhash.near_duplicates(no_docs).count() == 0
