import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from wardflow.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _brute(rows, least, top):
    """Rows (text, lang, source) -> (lang, source, part, item, value, rank), in Python integers."""
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        words = TERM.findall((text or "").translate(LOWER))
        count[lang, source].update(words)
        docs[lang].update(set(words))
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        whole = sum((count[lang, s] for s in sources), Counter())

        def share(c, kept=kept):
            size = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // (size + 2 * len(kept)) for t in kept}
        p, q = {s: share(count[lang, s]) for s in sources}, share(whole)

        def diff(a, b):
            return (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(diff(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(diff(p[s][t], q[t]), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.add((lang, s, part, item, value, rank))
    return out


def _got(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("least,top", [(1, 3), (2, 10), (50, 10)])
def test_odd_rows_against_brute_force(spark, odd_docs, no_docs, least, top):
    rows = [(r["text"], r["lang"], r["source"]) for r in odd_docs.collect()]
    assert _got(divergence.divergences(odd_docs, least, top)) == _brute(rows, least, top)
    assert divergence.divergences(no_docs, least, top).count() == 0


def test_many_groups_small_blocks_and_ties(spark, monkeypatch):
    random.seed(4)
    words = ["Ärger", "ärger", "É", "é", "a", "B", "b", "x1y", "漢字", "\U0001f642", "don't", "tab\tc\x0bd", "\x00nul", "~", "a_b", "\x80\x81"]
    rows = [(" ".join(random.choices(words, k=random.randint(0, 30))), random.choice(["en", "de", None]),
             random.choice([None, *"abcdefgh"])) for _ in range(400)]
    rows += [(None, "xx", "only"), ("", "yy", "one"), ("", "yy", "two"), ("!!", "yy", "three")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(7)
    assert _got(divergence.divergences(docs, 10, 10)) == _brute(rows, 10, 10)


def test_blocks_and_pairs_that_do_not_fit(monkeypatch):
    """The shard's rows in blocks of few terms, and without sums held, give the same sums."""
    import pyarrow as pa
    random.seed(5)
    sources = [f"s{i}" for i in range(6)]
    terms = [f"t{i:02d}" for i in range(40)]
    cells = sorted((t, s, random.randint(1, 9)) for t in terms for s in sources if random.random() < 0.6)
    size = {s: sum(n for _, o, n in cells if o == s) for s in sources}
    total = {t: sum(n for o, _, n in cells if o == t) for t in terms}
    rows = [dict(shard=0, lang="l", kind=0, term="", source=s, n=0, all=0, size=size[s], lang_size=sum(size.values()), terms=40) for s in sources]
    rows += [dict(shard=0, lang="l", kind=1, term=t, source=s, n=n, all=total[t], size=0, lang_size=0, terms=0) for t, s, n in cells]
    schema = pa.schema([("shard", pa.int32()), ("lang", pa.string()), ("kind", pa.int32()), ("term", pa.string()), ("source", pa.string()),
                        *[(c, pa.int64()) for c in ("n", "all", "size", "lang_size", "terms")]])

    def run(batch):
        sums = Counter()
        parts = [pa.RecordBatch.from_pylist(rows[i:i + batch], schema=schema) for i in range(0, len(rows), batch)]
        for b in divergence._shard_rows(iter(parts)):
            for r in b.to_pylist():
                sums[r["source"], r["part"], r["item"]] += r["value"]
        return sums
    want = run(10_000)
    assert len([k for k in want if k[1] == "pair"]) == 15
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 24)
    assert run(7) == want
    monkeypatch.setattr(divergence, "PAIR_CELLS", 1)
    assert run(11) == want


def test_shares_are_exact_for_large_counts():
    for n, size, v in ((0, 0, 1), (5, 9, 3), (8 * 10 ** 14, 9 * 10 ** 15 - 10, 2), (10 ** 12 + 7, 3 * 10 ** 12 + 1, 10 ** 6)):
        got = divergence.shares(np.array([n], np.int64), np.array([size], np.int64), np.int64(v))
        assert got[0] == 1 + 10 ** 9 * (n + 2) // (size + 2 * v)
