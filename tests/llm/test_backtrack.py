import hashlib
import json
import random

import numpy as np
import pytest
from tokenizers import Tokenizer, decoders, models, pre_tokenizers

from wardflow.llm import backtrack
from wardflow.llm.bpe import byte_of_char, vocabulary_path

LIBRARY = Tokenizer.from_file(vocabulary_path())
OWN = backtrack.backtracking(vocabulary_path())


def _ids(text, library=LIBRARY):
    return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_random_texts_and_their_decoding():
    random.seed(11)
    parts = ["a", "b", "'", "s", "re", "ll", " ", "  ", "\n", "\t", "1", "²", "!", "é", "ß", "漢", "\U0001f642", "the", " and",
             "<|endoftext|>", "\x1c", "\xa0", " ", "\x00", "ing", " '", "<|", "aaa", "ch", "\x85", "tion", "ooo", "00"]
    for _ in range(6000):
        t = "".join(random.choice(parts) for _ in range(random.randint(0, 16)))
        ids = OWN.encode(t)
        assert ids == _ids(t), repr(t)
        assert OWN.decode(ids) == LIBRARY.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False) == t


def test_cut_ids_decode_as_the_library_does():
    random.seed(12)
    ids = np.frombuffer(OWN.encode("né 漢字 \U0001f642\U0001f643 ß" * 20), "<u4")
    for _ in range(200):
        some = random.sample(ids.tolist(), 12)
        assert OWN.decode(np.array(some, "<u4").tobytes()) == LIBRARY.decode(some, skip_special_tokens=False)
    assert OWN.decode(np.array([50_300, 64], "<u4").tobytes()) == "a"  # an id outside the vocabulary


def test_every_letter_run_of_a_small_alphabet(tmp_path):
    """A vocabulary with merges that overlap in every way, against the library on all strings of up to 9 letters."""
    chars = {b: c for c, b in byte_of_char().items()}
    vocab = {chars[b]: b for b in range(256)}
    merges = [("a", "a"), ("a", "b"), ("b", "a"), ("aa", "a"), ("ab", "a"), ("b", "ba"), ("aa", "ab"), ("ba", "aa"), ("aba", "b"), ("bba", "ab")]
    for a, b in merges:
        vocab.setdefault(a + b, len(vocab))
    tok = Tokenizer(models.BPE(vocab, merges))
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.decoder = decoders.ByteLevel()
    path = str(tmp_path / "small.json")
    tok.save(path)
    own = backtrack.Backtracking(path)
    for n in range(1, 10):
        for k in range(2 ** n):
            t = "".join("ab"[k >> i & 1] for i in range(n))
            assert own.encode(t) == _ids(t, tok), t
    assert json.load(open(path))["model"]["type"] == "BPE"


def test_compatible_pairs_are_those_that_merge_to_themselves():
    OWN.encode(" ".join(f"word{i}ing anti{i}dis Umständ{i}e" for i in range(400)))
    known = list(OWN.pairs.items())
    assert {fit for _, fit in known} == {True, False}
    for key, fit in known:
        a, b = key >> 32, key & 0xFFFFFFFF
        spelled = (OWN.spelled[a] + OWN.spelled[b]).encode("latin-1")
        text = "".join({v: c for c, v in byte_of_char().items()}[x] for x in spelled)
        assert fit == ([t.id for t in LIBRARY.model.tokenize(text)] == [a, b])


@pytest.mark.parametrize("text", ["a" * 300_000, " " * 200_000, "ab" * 150_000, "é" * 100_000, "!?" * 100_000])
def test_long_words_in_linear_time(text):
    assert OWN.encode(text) == _ids(text)
    assert OWN.decode(OWN.encode(text)) == text


def test_caches_stay_in_their_bound():
    kept = backtrack._Kept(lambda k: b"1234", 50_000)
    for i in range(5000):
        assert kept[f"k{i % 700}"] == b"1234"
    assert kept.held <= 25_000 and len(kept.older) <= 25_000 // kept.ENTRY


def test_query_and_odd_rows(spark, sf_small, odd_docs, no_docs):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    for r in backtrack.op12_backtrack(spark, sf_small).collect():
        text = docs.pop(r["doc_id"])
        ids = LIBRARY.encode(text, add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == sha(np.array(ids, "<u4").tobytes())
        assert r["decoded_sha256"] == sha(LIBRARY.decode(ids, skip_special_tokens=False).encode())
    assert not docs
    both = backtrack.decode(backtrack.encode(odd_docs, out_col="ids"), "ids", "back")
    assert both.count() == odd_docs.count()
    for r in both.select("text", "ids", "back").collect():
        assert bytes(r["ids"]) == _ids(r["text"] or "") and r["back"] == (r["text"] or "")
    assert backtrack.decode(backtrack.encode(no_docs)).count() == 0
