"""Exact token counts of every prefix of a text by dynamic programming.

Byte-pair encoding has the property that the encoding of a prefix, cut after
any of its tokens, is again an encoding.  So the encoding of ``p`` is that of a
shorter prefix plus one token ``t``: the only vocabulary entry that ends ``p``
and whose pair with the last token before it survives encoding on its own.  One
pass over a word therefore yields the token count and last token at each of its
prefixes; each is found once for all equal words.  A text's counts are the
running sums over its words, with the pre-tokenizer's special cases (white space
runs, contractions, special tokens) settled at the cut.  Truncation and budget
questions are lookups in that table: nothing is encoded again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.bpe import PATTERN, ByChunk, byte_of_char, chunk_length, chunks, vocabulary_path
from wardflow.llm.common import read_table

LIMIT = 512
CACHE_PAIRS = 600_000
CACHE_WORDS = 800_000  # in two generations: words met again move to the younger
CACHE_UNITS = 300_000
_BLANK = re.compile("[\t-\r \x85\xa0  -     　]+")


class PrefixCounter:
    """Token counts of prefixes under one byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = byte_of_char()
        raw = lambda s: bytes(byte[c] for c in s)
        self.vocab = {raw(s): i for s, i in spec["model"]["vocab"].items() if all(c in byte for c in s)}
        self.token = {i: t for t, i in self.vocab.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        self.ids = {(self.vocab[a], self.vocab[b]): i for (a, b), i in self.rank.items()
                    if a in self.vocab and b in self.vocab}
        self.made = {self.vocab[self.token[a] + self.token[b]]: (a, b, i) for (a, b), i in self.ids.items()
                     if self.token[a] + self.token[b] in self.vocab}
        self._left: dict[int, list[tuple[int, float]]] = {}
        self._right: dict[int, list[tuple[int, float]]] = {}
        self.longest: dict[bytes, int] = {}  # longest token by its last two bytes
        for t in self.vocab:
            self.longest[t[-2:]] = max(len(t), self.longest.get(t[-2:], 0))
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = frozenset(special)
        self._cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self._fits: dict[int, bool] = {}
        self._words: dict[str, int] = {}
        self._older: dict[str, int] = {}
        self._totals = ByChunk(self._plain_total)

    def _merge(self, word: bytes) -> list[bytes]:
        parts = [word[i:i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best, at = min((self.rank.get((a, b), 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if best == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _edge(self, token: int, side: int, known: dict[int, list[tuple[int, float]]]) -> list[tuple[int, float]]:
        """The pieces at one edge of a token, from its byte to itself, each with the rank of the merge that ends it."""
        out = known.get(token)
        if out is None:
            chain, until, at = [], float("inf"), token
            while True:
                chain.append((at, until))
                if at not in self.made:
                    break
                until = self.made[at][2]
                at = self.made[at][side]
            out = known[token] = chain[::-1]
        return out

    def _pair(self, key: int, a: int, b: int) -> bool:
        """Whether token ``b`` may follow token ``a`` (-1: begin a word).

        Both sides are built up in the order of merge ranks; the pair fails if
        at some time the pieces beside the border merge with each other first.
        Of equal ranks the left one goes first.
        """
        if a < 0:
            fit = self._merge(self.token[b]) == [self.token[b]]
        else:
            xs, ys = self._edge(a, 1, self._right), self._edge(b, 0, self._left)
            i = j = 0
            while True:
                (x, rx), (y, ry) = xs[i], ys[j]
                across = self.ids.get((x, y))
                if across is not None and across < rx and across <= ry:
                    fit = False
                    break
                if rx == ry == float("inf"):
                    fit = True
                    break
                if rx <= ry:
                    i += 1
                else:
                    j += 1
        self._fits[key] = fit
        return fit

    def _fill(self, word: bytes) -> list[int]:
        """Token counts of all prefixes of a word, by bytes from 0."""
        n = len(word)
        counts, last = [0] * (n + 1), [-1] * (n + 1)
        vocab, fits, longest = self.vocab, self._fits, self.longest
        for j in range(1, n + 1):
            reach = longest.get(word[j - 2:j] if j > 1 else word[:1], 1)
            for start in range(j - reach if j > reach else 0, j):
                token = vocab.get(word[start:j])
                if token is None:
                    continue
                before = last[start]
                if before < 0 and start:
                    continue
                key = (before + 1) << 32 | token
                fit = fits.get(key)
                if fit is None:
                    fit = self._pair(key, before, token)
                if fit:
                    counts[j], last[j] = counts[start] + 1, token
                    break
            else:
                raise ValueError(f"the vocabulary lacks a byte of {word!r}")
        return counts

    def word_counts(self, word: str) -> np.ndarray:
        """Counts at every code point of one pre-token, from 0."""
        counts = self._fill(word.encode("utf-8", "surrogatepass"))
        ends = np.cumsum([0, *(len(c.encode("utf-8", "surrogatepass")) for c in word)])
        return np.array(counts, dtype=np.int32)[ends]

    def _word_total(self, word: str) -> int:
        if len(word) == 1 and word < "\x80":
            return 1
        known = self._words.get(word)
        if known is None:
            if len(self._words) >= CACHE_WORDS // 2:
                self._words, self._older = {}, self._words
            known = self._older.pop(word, None) or self._fill(word.encode("utf-8", "surrogatepass"))[-1]
            self._words[word] = known
        return known

    def _plain_total(self, text: str) -> int:
        return sum(self._word_total(w) for w in PATTERN.findall(text))

    def trim(self) -> None:
        """Forget the caches when they have grown to their bound; called between texts."""
        if len(self._fits) > CACHE_PAIRS:
            self._fits.clear()
        if len(self._totals) > CACHE_UNITS:
            self._totals.clear()

    def _plain_counts(self, text: str) -> np.ndarray:
        """Counts at every code point of a text without special tokens."""
        out = np.zeros(len(text) + 1, dtype=np.int32)
        base = 0
        for m in PATTERN.finditer(text):
            word, at = m.group(), m.start()
            own = self.word_counts(word)
            if word[0] == "'" and len(word) > 2:  # a contraction cut short is two words
                own[2:-1] = [self._plain_total(word[:k]) for k in range(2, len(word))]
            out[at + 1:at + len(own)] = base + own[1:]
            base += int(own[-1])
        for m in _BLANK.finditer(text):  # at a cut the run of white space before it is one word
            a, b = m.span()
            if b - a > 1:
                out[a + 1:b + 1] = out[a] + self.word_counts(text[a:b])[1:]
        return out

    def counts(self, text: str) -> np.ndarray:
        """The table: token counts of ``text[:k]`` for every k from 0 to its length."""
        if not (self._cut and self._cut.search(text)):
            out = self._plain_counts(text)
            self._close(out, text, 0)
            return out
        done, base, before = [np.zeros(1, np.int32)], 0, ""
        for part in self._cut.split(text):
            if part in self.special:
                total = base + self._plain_total(before)
                inner = [base + self._plain_total(before + part[:k]) for k in range(1, len(part))]
                done.append(np.array([*inner, total + 1], dtype=np.int32))
                base, before = total + 1, ""
            elif part:
                own = self._plain_counts(part)
                self._close(own, part, 0)
                done.append(base + own[1:])
                before = part
        return np.concatenate(done)

    def _close(self, out: np.ndarray, text: str, base: int) -> None:
        """The last entry is the whole text's count, whatever follows it."""
        if text:
            out[-1] = base + self._plain_total(text)

    def unit_totals(self, text: str) -> tuple[list[int], list[str]]:
        """Counts and keys of the parts of a text between safe cuts."""
        if "\0" not in text:
            keys = chunks(text)
            counts = list(map(self._totals.__getitem__, keys))
            if None not in counts:
                return counts, keys
        words = PATTERN.findall(text)
        return [self._word_total(w) for w in words], ["\0" + w for w in words]

    def total(self, text: str) -> int:
        """The table's last entry, from running sums over parts only."""
        return self.fit(text, 1 << 60)[0]

    def longest_prefix(self, text: str, limit: int) -> int:
        """Code points of the longest prefix of at most ``limit`` tokens."""
        return self.fit(text, limit)[1]

    def fit(self, text: str, limit: int) -> tuple[int, int]:
        """The whole text's count, and the code points of its longest prefix of at most ``limit`` tokens."""
        if not text:
            return 0, 0
        if self._cut and self._cut.search(text):
            total = sum(1 if p in self.special else sum(self.unit_totals(p)[0]) for p in self._cut.split(text) if p)
            return total, len(text) if total <= limit else int(np.flatnonzero(self.counts(text) <= limit)[-1])
        counts, keys = self.unit_totals(text)
        total = sum(counts)
        if total <= limit:
            return total, len(text)
        # parts of one token at least: behind the first that ends over the limit all counts are higher
        over, before = 0, 0
        while before + counts[over] <= limit:
            before += counts[over]
            over += 1
        # from a part that no white space precedes, to one part behind, as white space at the cut may join
        first = over
        ends = [0, *accumulate(map(chunk_length, keys[:over + 1]))]
        while first and (first > over - 2 or self._blank(text[ends[first] - 1])):
            first -= 1
        begin = sum(counts[:first])
        own = begin + self.counts(text[ends[first]:ends[over + 1]])
        return total, ends[first] + int(np.flatnonzero(own <= limit)[-1])

    @staticmethod
    def _blank(c: str) -> bool:
        return c.isspace() or bool(_BLANK.match(c))


@lru_cache(maxsize=2)
def prefix_counter(path: str) -> PrefixCounter:
    """One counter for all tasks of a Python worker."""
    return PrefixCounter(path)


def prefix_counts(docs: DataFrame, text_col: str = "text", out_col: str = "prefix_tokens",
                  vocabulary: str | None = None) -> DataFrame:
    """All input columns and ``out_col``: array of the token counts of every prefix, by code points from 0.

    Null and empty texts have the one entry 0.  Repeated rows stay; a column
    named like ``out_col`` is replaced; an empty table stays empty.
    """
    path = vocabulary or vocabulary_path()

    @F.pandas_udf("array<int>")
    def table(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = prefix_counter(path)
        for texts in batches:
            out = []
            for t in texts:
                out.append(counter.counts(t or ""))
                counter.trim()
            yield pd.Series(out)
    return docs.withColumn(out_col, table(F.col(text_col)))


def budget(text: Column, limit: int = LIMIT, vocabulary: str | None = None) -> Column:
    """Struct of ``n_tokens`` and ``fits_chars``, the longest prefix of at most ``limit`` tokens in code points."""
    path = vocabulary or vocabulary_path()

    @F.pandas_udf("n_tokens long, fits_chars long")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = prefix_counter(path)
        for texts in batches:
            rows = []
            for t in texts:
                rows.append(counter.fit(t or "", limit))
                counter.trim()
            yield pd.DataFrame(rows, columns=["n_tokens", "fits_chars"])
    return ask(text)


def op6_tokencount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, and how many characters of each fit 512 tokens."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    asked = docs.withColumn("b", budget(F.col("text")))
    return asked.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                        F.col("b.n_tokens").alias("n_tokens"), (F.col("b.n_tokens") > LIMIT).alias("over_limit"),
                        F.col("b.fits_chars").alias("fits_chars"))


QUERIES = {"op6_tokencount": op6_tokencount}
ORACLES: dict[str, str] = {}  # token counts are no SQL; tests compare with the library on texts and all their prefixes
