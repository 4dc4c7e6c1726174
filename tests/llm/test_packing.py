import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from wardflow.llm import packing
from wardflow.llm.bpe import TokenIds, vocabulary_path

LIBRARY = Tokenizer.from_file(vocabulary_path())


def _ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library():
    random.seed(11)
    parts = ["a", "b", "'", "s", "re", " ", "  ", "\n", "\t", "1", "²", "!", "é", "漢", "\U0001f642", "the", " and", "\x1c",
             "<|endoftext|>", "\xa0", "\x00", "ing", " '", "　", "\r\n", "<|"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 14))) for _ in range(3000)]
    got = TokenIds(vocabulary_path()).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [_ids(t) for t in texts]


def _check(rows, texts, window=2048):
    """Each id in one piece, sequences gapless; returns the share of padding."""
    whole = {}
    seqs = {}
    for r in rows:
        whole.setdefault(r["doc_id"], []).append(r)
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for d, text in texts.items():
        ids = _ids(text) + [1]
        at = 0
        for r in sorted(whole.pop(d), key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            part = np.array(ids[at:at + r["length"]], "<u4").tobytes()
            assert (r["ids_crc32"] if "ids_crc32" in r else zlib.crc32(r["ids"])) == zlib.crc32(part)
            at += r["length"]
        assert at == len(ids)
    assert not whole
    for parts in seqs.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end and n > 0
            end += n
        assert end <= window
    return 1 - sum(n for p in seqs.values() for _, n in p) / (window * len(seqs))


def test_query_rebuilds_every_document(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    rows = [r.asDict() for r in packing.op2_packing(spark, sf_small).collect()]
    assert _check(rows, {r["doc_id"]: r["text"] for r in docs}) < 0.01


def test_many_partitions_and_few_windows(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").repartition(20, "doc_id")
    out = packing.pack(docs, ["doc_id"], window=128, open_windows=3, merge_partitions=4).select("*", "doc.doc_id").drop("doc")
    rows = [r.asDict() for r in out.collect()]
    assert _check(rows, {r["doc_id"]: r["text"] for r in docs.collect()}, 128) < 0.2


def test_best_fit_and_fullest():
    w = packing.OpenWindows(10, 2)
    put = lambda size: [(p[0], p[5], p[6]) for p in w.place((size, 0, size, b"", size))]
    assert put(6) == [] and put(7) == []  # windows 0 and 1
    assert put(3) == [(7, 1, 0), (3, 1, 7)]  # best fit fills and closes window 1
    assert put(5) == [] and put(5) == [(5, 2, 0), (5, 2, 5)]
    assert put(9) == [] and put(8) == [(9, 3, 0)]  # none fits: the fullest of two goes
    assert put(10) == [(10, 5, 0)]
    assert [p[0] for p in w.rest()] == [6, 8]


def test_odd_rows(odd_docs, no_docs):
    rows = packing.pack(odd_docs, ["doc_id"]).select("*", "doc.doc_id").collect()
    total = {}
    for r in rows:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    want = {}
    for r in odd_docs.select("doc_id", "text").collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + len(_ids(r["text"])) + 1
    assert total == want
    assert packing.pack(no_docs, ["doc_id"]).count() == 0
