import random

from tokenizers import Tokenizer

from wardflow.llm import tokencount
from wardflow.llm.bpe import vocabulary_path

LIBRARY = Tokenizer.from_file(vocabulary_path())
COUNTER = tokencount.PrefixCounter(vocabulary_path())


def _n(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_every_prefix_of_random_texts():
    random.seed(3)
    parts = ["a", "b", "'", "s", "re", "ll", " ", "  ", "\n", "\t", "1", "²", "!", "é", "ß", "漢", "\U0001f642", "the", " and",
             "<|endoftext|>", "\x1c", "\xa0", " ", "\x00", "ing", " '", "<|", "aaa", "ch"]
    for _ in range(1500):
        t = "".join(random.choice(parts) for _ in range(random.randint(0, 12)))
        want = [_n(t[:i]) for i in range(len(t) + 1)]
        assert COUNTER.counts(t).tolist() == want, repr(t)
        assert COUNTER.total(t) == want[-1], repr(t)
        for limit in (0, 1, 2, 5):
            assert COUNTER.longest_prefix(t, limit) == max(i for i, v in enumerate(want) if v <= limit), (t, limit)


def test_pairs_survive_as_in_the_merge_loop():
    COUNTER.total(" ".join(f"word{i}ing anti{i}dis" for i in range(300)))
    for key, fit in list(COUNTER._fits.items()):
        a, b = (key >> 32) - 1, key & 0xFFFFFFFF
        if a >= 0:
            a, b = COUNTER.token[a], COUNTER.token[b]
            assert fit == (COUNTER._merge(a + b) == [a, b])


def test_query_and_odd_rows(spark, sf_small, odd_docs, no_docs):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    for r in tokencount.op6_tokencount(spark, sf_small).collect():
        text = docs.pop(r["doc_id"])
        assert (r["n_bytes"], r["n_tokens"]) == (len(text.encode()), _n(text))
        assert r["over_limit"] == (r["n_tokens"] > 512)
        assert r["fits_chars"] == len(text) or (_n(text[:r["fits_chars"]]) <= 512 < _n(text[:r["fits_chars"] + 1]))
    assert not docs
    got = tokencount.prefix_counts(odd_docs.where("doc_id <> 8 or doc_id is null")).select("text", "prefix_tokens").collect()
    for r in got:
        assert r["prefix_tokens"] == [_n((r["text"] or "")[:i]) for i in range(len(r["text"] or "") + 1)]
    assert tokencount.prefix_counts(no_docs).count() == 0
