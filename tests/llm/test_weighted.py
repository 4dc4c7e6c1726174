import hashlib
import math
from collections import Counter

import numpy as np
import regex
import xxhash
from pyspark.sql import functions as F

from wardflow.llm import weighted

WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
M64 = (1 << 64) - 1


def _bag(text):
    return Counter(WORD.findall((text or "").lower()))


def _jaccard(a, b):
    keys = set(a) | set(b)
    return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys) if keys else 1.0


def _h(*parts, seed=42):
    """The hash of the engine: XXH64 chained over longs and ints."""
    for p, size in parts:
        seed = xxhash.xxh64_intdigest(int(p & ((1 << 8 * size) - 1)).to_bytes(size, "little"), seed)
    return seed


def _slow_fingerprint(text, samples):
    """By the definition, word by word."""
    if not text:
        return "0000" * samples
    bag = _bag(text) or {text: 1}
    terms = Counter()
    for w, n in bag.items():
        terms[xxhash.xxh64_intdigest(w.encode(), 42) >> 31] += n
    out = []
    for j in range(samples):
        best = None
        for term, n in terms.items():
            one, two = (_h((term, 8), (weighted.SEED + 3 * j + k, 4)) for k in range(2))
            u = lambda bits, shift: float(((bits >> shift) & ((1 << 31) - 1)) | 1)
            r = 62 * math.log(2) - math.log(u(one, 0) * u(one, 32))
            c = 62 * math.log(2) - math.log(u(two, 0) * u(two, 32))
            b = ((one >> 11 ^ two >> 32) & ((1 << 31) - 1)) * 2.0 ** -31
            t = math.floor(math.log(n) / r + b) if n > 1 else 0
            a = math.log(c) - r * (t - b + 1)
            if best is None or a < best[0]:
                best = (a, (term + t * 40_503) & 0xFFFF)
        out.append(f"{best[1]:04x}")
    return "".join(out)


def test_signature_equals_the_definition(spark):
    rows = [(0, "a b a c a"), (1, ""), (2, None), (3, "?!"), (4, "one"), (5, " ".join(f"w{i % 37}" for i in range(500))), (6, "É é x")]
    df = spark.createDataFrame(rows, "k long, t string")
    got = dict(weighted.fingerprints(df, ["k"], {"t": "f"}, samples=8).collect())
    assert got == {k: _slow_fingerprint(t, 8) for k, t in rows}


def test_collision_rate_is_generalised_jaccard(spark):
    rng = np.random.default_rng(9)
    rows = []
    for k in range(150):
        a = list(rng.choice([f"w{i}" for i in range(40)], 150))
        n = int(rng.integers(0, 130))
        rows.append((k, " ".join(a), " ".join(a[n:] + list(rng.choice([f"v{i}" for i in range(40)], n)))))
    df = spark.createDataFrame(rows, "k long, a string, b string")
    got = weighted.fingerprints(df, ["k"], {"a": "fa", "b": "fb"}).select("k", weighted.likeness(F.col("fa"), F.col("fb")).alias("l"))
    err = [r["l"] - _jaccard(_bag(rows[r["k"]][1]), _bag(rows[r["k"]][2])) for r in got.collect()]
    assert abs(np.mean(err)) < 0.02 and np.sqrt(np.mean(np.square(err))) < 0.1


def test_query_against_brute_force(spark, sf_small):
    got = {r["doc_id"]: r for r in weighted.op10_weighted(spark, sf_small).collect()}
    docs = sorted(((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()), reverse=True)
    assert len(got) == len(docs)
    for i, (d, text) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        third = len(text) // 3
        edited = text[:len(text) - third] + after[:third]
        r = got[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        f, e = r["fingerprint"], r["edited_fingerprint"]
        same = lambda x, y: sum(x[4 * j:4 * j + 4] == y[4 * j:4 * j + 4] for j in range(weighted.SAMPLES)) / weighted.SAMPLES
        assert abs(r["near_edited"] - same(f, e)) < 1e-3
        assert abs(r["near_next"] - same(f, got[docs[(i + 1) % len(docs)][0]]["fingerprint"])) < 1e-3
        if i % 40 == 0 and len(text) < 2000:
            assert f == _slow_fingerprint(text, weighted.SAMPLES)


def test_odd_rows(spark, odd_docs, no_docs, tmp_path):
    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = weighted.op10_weighted(spark, str(tmp_path)).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1][0]["fingerprint"] == by[1][1]["fingerprint"]
    assert by[3][0]["fingerprint"] == by[4][0]["fingerprint"] == "0000" * weighted.SAMPLES
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    no_docs.write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert weighted.op10_weighted(spark, str(tmp_path / "none")).count() == 0
    one = spark.createDataFrame([(5, "only one row here")], "doc_id long, text string")
    one.write.parquet(str(tmp_path / "one" / "documents.parquet"))
    r = weighted.op10_weighted(spark, str(tmp_path / "one")).first()
    assert r["near_next"] == 1.0
