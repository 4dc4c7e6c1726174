import re

from wardflow.llm import contamination


def _words(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def test_threshold_and_odd_rows(spark, odd_docs, no_docs):
    item = " ".join(f"q{i}" for i in range(24))  # 20 shingles, 16 needed
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "lazy dog"), (None, "again and again"),
                                   (5, "?!")], "item_id long, text string")
    docs = spark.createDataFrame([
        (20, "intro " + item.upper().replace(" ", ", ") + " outro", "x"),
        (21, " ".join(f"q{i}" for i in range(20)), "x"),  # exactly 16 of 20
        (22, " ".join(f"q{i}" for i in range(19)), "x"),  # 15 of 20
        (23, " ".join(f"q{i}" for i in range(12)) + " cut " + " ".join(f"q{i}" for i in range(12, 24)), "x"),  # 16
        (24, " ".join(reversed(item.split())), "x"),
    ], "doc_id long, text string, need string")
    got = {(r["doc_id"], r["item_id"]): (r["n_shared"], r["n_item"]) for r in contamination.find_items(docs, items).collect()}
    assert got == {(20, 1): (20, 20), (21, 1): (16, 20), (23, 1): (16, 20)}
    odd = {(r["doc_id"], r["item_id"]) for r in contamination.find_items(odd_docs, items).collect()}
    assert odd == {(1, 4), (2, 4), (1, None), (2, None)}
    assert contamination.find_items(no_docs, items).count() == 0
    empty = contamination.find_items(odd_docs, items.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "item_id", "n_item", "n_shared", "containment"]


def test_blocks_give_the_same(spark, sf_small, monkeypatch):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    items = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    whole = sorted(map(tuple, contamination.find_items(docs, items).collect()))
    monkeypatch.setattr(contamination, "BLOCK_ITEMS", 7)
    assert sorted(map(tuple, contamination.find_items(docs, items).collect())) == whole and whole


def test_query_against_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()
    gram = lambda t: {tuple(w[i:i + 5]) for w in [_words(t)] for i in range(len(w) - 4)}
    want = set()
    sets = [(r["item_id"], gram(r["text"])) for r in items]
    for d in docs:
        g = gram(d["text"])
        want |= {(d["doc_id"], i) for i, s in sets if s and 5 * len(s & g) >= 4 * len(s)}
    got = contamination.op9_contamination(spark, sf_small).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and want
