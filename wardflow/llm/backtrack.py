"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

A sequence of tokens is the encoding of its bytes if every token encodes to
itself and every two neighbours are compatible: merged on their own, side by
side, they come out as the same two tokens.  So the encoder takes the longest
token that an Aho-Corasick automaton finds at the present place, checks it
against the token before it in the pair-compatibility table, tries the next
shorter prefix token where the pair fails, and steps back over the last token
where none is left; a place once left that way is never entered again, which
makes the number of steps linear in the bytes.

Decoding is a gather: all tokens lie in one block of bytes, and a table of offsets
tells where each begins and ends.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.bpe import PATTERN, byte_of_char, chunk_text, chunks, is_odd, pack_ids, vocabulary_path
from wardflow.llm.common import read_table

CACHE_BYTES = 90_000_000  # of a Python worker, for chunks of texts and their ids
CACHE_PAIRS = 250_000  # about 35 MB
DECODE_STEP = 1 << 16  # ids that are gathered at a time

_BYTE = -1  # merge rank of a single byte: before all merges


class Backtracking:
    """Encoder of one byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        import ahocorasick
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = byte_of_char()
        latin = lambda s: "".join(chr(byte[c]) for c in s)  # noqa: E731 - one character per byte
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        vocab = {latin(s): i for s, i in spec["model"]["vocab"].items() if s not in special and all(c in byte for c in s)}
        self.spelled = {i: s for s, i in vocab.items()}
        self.special = {text: pack_ids([i]) for text, i in special.items()}
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}  # the two tokens that a token is merged from
        self.born = {i: _BYTE for s, i in vocab.items() if len(s) == 1}  # rank of that merge; only tokens that encode to themselves
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        pairs = [(vocab.get(latin(a)), vocab.get(latin(b)), vocab.get(latin(a + b))) for a, b in merges]
        for at, (a, b, _) in enumerate(pairs):
            self.rank.setdefault((a, b), at)
        for at, (a, b, whole) in enumerate(pairs):
            if whole is not None and whole not in self.born and a in self.born and b in self.born and self._stays(a, b, at):
                self.parts[whole], self.born[whole] = (a, b), at
        self.automaton = ahocorasick.Automaton()
        for i in self.born:
            self.automaton.add_word(self.spelled[i], i)
        self.automaton.make_automaton()
        self.reach = max(len(self.spelled[i]) for i in self.born)
        self.pairs: dict[int, bool] = {}  # the pair-compatibility table, filled as pairs are met
        self._shorter: dict[int, int] = {}
        self._ids = _Kept(self._chunk)
        self.decode = OffsetTable({i: s.encode("latin-1") for i, s in self.spelled.items()} | {i: t.encode() for t, i in special.items()}).decode

    def _stays(self, a: int, b: int, until: float = float("inf")) -> bool:
        """Whether tokens ``a`` and ``b`` side by side do not merge across their border before rank ``until``.

        Looks back in time: the pieces beside the border are whole tokens last, and
        bytes first.  A piece is there from its own merge until the one that takes
        it in; of equal ranks the left place merges first.
        """
        a_until = b_until = until
        while True:
            across = self.rank.get((a, b))
            if across is not None and across < a_until and across < until and (across <= b_until):
                return False
            born_a, born_b = self.born[a], self.born[b]
            if born_a > born_b:
                a_until, a = born_a, self.parts[a][1]
            elif born_b > _BYTE:
                b_until, b = born_b, self.parts[b][0]
            else:
                return True

    def compatible(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._stays(a, b)
        return known

    def _longest(self, spelled: str) -> int:
        """The longest token that the string begins with."""
        return next(self.automaton.iter_long(spelled))[1]

    def _prefix(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``; -1 if there is none."""
        known = self._shorter.get(token)
        if known is None:
            spelled = self.spelled[token]
            known = self._shorter[token] = self._longest(spelled[:-1]) if len(spelled) > 1 else -1
        return known

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word of the pre-tokenizer."""
        w = word if word.isascii() else word.encode("utf-8", "surrogatepass").decode("latin-1")
        out: list[int] = []
        left: set[int] = set()  # places from which no encoding goes on
        at, end, spelled, compatible = 0, len(w), self.spelled, self.compatible
        token = self._longest(w[:self.reach])
        while at < end:
            to = at + len(spelled[token])
            if to not in left and (not out or compatible(out[-1], token)):
                out.append(token)
                at = to
                if at < end:
                    token = self._longest(w[at:at + self.reach])
            elif (shorter := self._prefix(token)) >= 0:
                token = shorter
            else:
                left.add(at)
                token = out.pop()
                at -= len(spelled[token])
        return out

    def _words(self, words: list[str]) -> bytes:
        return b"".join([pack_ids(self.encode_word(w)) for w in words])

    def _chunk(self, key: str) -> bytes | None:
        if key.isascii() and key.isalpha():
            return pack_ids(self.encode_word(" " + key))
        return None if is_odd(key) else self._words(PATTERN.findall(chunk_text(key)))

    def _plain(self, text: str) -> bytes:
        if "\0" not in text:
            try:
                return b"".join(map(self._ids.__getitem__, chunks(text)))
            except TypeError:  # white space that adjoins, or is no blank
                pass
        return self._words(PATTERN.findall(text))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit bytes; strings of special tokens are these tokens."""
        if self._cut and self._cut.search(text):
            return b"".join(self.special.get(p) or self._plain(p) for p in self._cut.split(text) if p)
        return self._plain(text) if text else b""


class OffsetTable:
    """All tokens in one block of bytes, and where each begins; the next one's begin is its end."""

    def __init__(self, tokens: dict[int, bytes]):
        content = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.block = np.frombuffer(b"".join(content), np.uint8)
        self.offsets = np.zeros(len(content) + 1, np.int64)
        np.cumsum([len(c) for c in content], out=self.offsets[1:])

    def decode(self, ids: bytes) -> str:
        """The text; ids outside the vocabulary stand for nothing, bytes that are no UTF-8 become U+FFFD."""
        ids_of = np.frombuffer(ids, "<u4").astype(np.int64)
        done = []
        for at in range(0, len(ids_of), DECODE_STEP):
            part = ids_of[at:at + DECODE_STEP]
            part = part[part < len(self.offsets) - 1]
            begin = self.offsets[part]
            size = self.offsets[part + 1] - begin
            stop = np.cumsum(size)
            done.append(self.block[np.repeat(begin - (stop - size), size) + np.arange(int(stop[-1]) if len(stop) else 0)].tobytes())
        return b"".join(done).decode("utf-8", "replace")


class _Kept(dict):
    """A value per key, made when first asked for, in at most ``CACHE_BYTES`` of memory.

    Two generations of half of it: when the younger is full the older is forgotten;
    what is asked for again moves to the younger.
    """

    ENTRY = 190  # bytes of a dictionary slot, the headers of key and value, and the allocator's rounding

    def __init__(self, make, budget: int = CACHE_BYTES):
        super().__init__()
        self.make, self.most, self.held, self.older = make, budget // 2, 0, {}

    def __missing__(self, key: str):
        value = self.older.pop(key, self)
        if value is self:
            value = self.make(key)
        self.held += self.ENTRY + 2 * len(key) + len(value or b"")
        if self.held > self.most:
            self.older = dict(self)
            self.clear()
            self.held = 0
        self[key] = value
        return value


@lru_cache(maxsize=2)
def backtracking(path: str) -> Backtracking:
    """One encoder for all tasks of a Python worker."""
    return Backtracking(path)


def encode(docs: DataFrame, text_col: str = "text", out_col: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """All input columns and ``out_col``: the ids of the whole text, binary, little-endian unsigned 32-bit.

    Null and empty texts have no ids (an empty value).  Repeated rows stay; a
    column named like ``out_col`` is replaced; an empty table stays empty.
    """
    path = vocabulary or vocabulary_path()

    @F.pandas_udf("binary")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = backtracking(path)
        for texts in batches:
            yield pd.Series([encoder.encode(t or "") for t in texts], dtype=object)
    return docs.withColumn(out_col, ids(F.col(text_col)))


def decode(docs: DataFrame, ids_col: str = "ids", out_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """All input columns and ``out_col``: the text of the ids; null ids give an empty text."""
    path = vocabulary or vocabulary_path()

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = backtracking(path)
        for ids in batches:
            yield pd.Series([encoder.decode(bytes(i or b"")) for i in ids], dtype=object)
    return docs.withColumn(out_col, text(F.col(ids_col)))


def round_trip(text: Column, vocabulary: str | None = None) -> Column:
    """Struct of ``ids``, as ``encode`` gives them, and ``text``, what ``decode`` makes of these; one pass in one worker."""
    path = vocabulary or vocabulary_path()

    @F.pandas_udf("ids binary, text string")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = backtracking(path)
        for texts in batches:
            ids = [encoder.encode(t or "") for t in texts]
            yield pd.DataFrame({"ids": ids, "text": list(map(encoder.decode, ids))}, dtype=object)
    return both(text)


def op12_backtrack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again; both results as digests."""
    docs = read_table(spark, sf_dir, "documents")
    both = docs.select("doc_id", round_trip(F.col("text")).alias("b"))
    return both.select("doc_id", (F.octet_length("b.ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("b.ids", 256).alias("ids_sha256"), F.sha2("b.text", 256).alias("decoded_sha256"))


QUERIES = {"op12_backtrack": op12_backtrack}
ORACLES: dict[str, str] = {}  # token ids are no SQL; tests compare with the library's encode and decode
