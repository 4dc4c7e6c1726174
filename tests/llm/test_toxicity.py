import numpy as np

from wardflow.llm import toxicity


def _docs(n, seed):
    """Toxic ones hold a word of a root with changing ends; long clean ones, copies of toxic ones."""
    rng = np.random.default_rng(seed)
    plain = [f"word{i}" for i in range(300)]
    out = []
    for i in range(n):
        words = list(rng.choice(plain, int(rng.integers(5, 80))))
        bad = i % 4 == 0
        if bad:
            for _ in range(int(rng.integers(1, 4))):
                words.insert(int(rng.integers(len(words) + 1)), "vilegrub" + "".join(rng.choice(list("abcdefgh"), 4)))
        out.append((" ".join(words), int(bad)))
    return out


def test_chain_learns_a_root_and_finds_unseen_words():
    train, test = _docs(600, 1), _docs(200, 2)
    chain = toxicity.fit_chain([t for t, _ in train], [y for _, y in train])
    got = list(toxicity.score_texts([t for t, _ in test], chain))
    assert all((s >= 0.5) == bool(y) for (s, _, _), (_, y) in zip(got, test, strict=True))
    for (_, starts, ends), (t, y) in zip(got, test, strict=True):
        assert [t[a:b] for a, b in zip(starts, ends, strict=True)] == [w for w in t.split() if w.startswith("vilegrub")]


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7):
        s = rng.normal(0, 2, n)
        chain = toxicity.Chain(np.zeros(1), 0.0, rng.normal(0, 1, (2, 2)), 0.7)
        total, hot = 0.0, np.zeros(n)
        for y in range(1 << n):
            bits = [y >> i & 1 for i in range(n)]
            e = bits[0] * chain.start + sum(b * x for b, x in zip(bits, s, strict=True))
            e += sum(chain.trans[a, b] for a, b in zip(bits, bits[1:], strict=False))
            total += np.exp(e)
            hot += np.exp(e) * np.array(bits)
        first = np.zeros(n, bool)
        first[0] = True
        assert np.allclose(toxicity.marginals(s, first, chain), hot / total)


def test_marginals_over_blocks_and_texts():
    """Many texts of any length in one array: as each alone."""
    rng = np.random.default_rng(4)
    chain = toxicity.Chain(np.zeros(1), 0.0, rng.normal(0, 1, (2, 2)), -0.3)
    parts = [rng.normal(-1, 3, int(n)) for n in rng.integers(1, 1500, 12)]
    first = np.concatenate([np.arange(len(p)) == 0 for p in parts])
    got = toxicity.marginals(np.concatenate(parts), first, chain)
    want = np.concatenate([toxicity.marginals(p, np.arange(len(p)) == 0, chain) for p in parts])
    assert np.allclose(got, want)


def test_one_class_and_no_labels_tag_nothing(spark, no_docs):
    assert toxicity.fit_chain(["a b"], [1]).bias == -30.0
    chain = toxicity.train(no_docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert list(toxicity.score_texts(["a b", None, ""], chain))[1][0] == 0.0


def test_query_and_odd_rows(spark, sf_small, odd_docs, no_docs):
    rows = toxicity.op4_toxicity(spark, sf_small).collect()
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    assert len(rows) == docs.count()
    from zlib import crc32
    for r in rows:
        assert r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    train = _docs(300, 5)
    chain = toxicity.fit_chain([t for t, _ in train], [y for _, y in train])
    got = toxicity.tag(odd_docs, chain).select("text", "toxicity.*").collect()
    assert len(got) == odd_docs.count()
    assert all(r["score"] == 0.0 and r["starts"] == [] for r in got if not (r["text"] or "").strip())
    assert toxicity.tag(no_docs, chain).count() == 0


def test_held_out_accuracy_of_the_query(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [(r["predicted"], labels[r["doc_id"]]) for r in toxicity.op4_toxicity(spark, sf).collect()
            if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == y for p, y in rows) >= 0.95 * len(rows)
    assert sum(p and not y for p, y in rows) == 0  # clean documents are left alone
