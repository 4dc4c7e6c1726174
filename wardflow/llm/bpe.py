"""Token ids of a byte-level BPE vocabulary, and the cuts between its text units.

The pre-tokenizer never joins characters across a single space or newline that
stands between two visible characters, so a text is cut there by plain string
splits, and the value of each chunk can be looked up.  Texts with other white space
are cut by the pre-tokenizer's own pattern.
"""

from __future__ import annotations

import json
import os
import re
import struct
from functools import lru_cache

import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

VOCABULARY = "byte_bpe_50k.json"
# fixed values: the pre-tokenizer's pattern, \s spelled out
_S = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PATTERN_TEXT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
PATTERN = regex.compile(PATTERN_TEXT)
_BLANK = re.compile(f"[{_S}]|\\s")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def chunks(text: str) -> list[str]:
    """Keys of the text cut at single blanks and before newlines; \0 marks the first, which has no blank before it."""
    out = text.replace("\n", " \n").split(" ")
    out[0] = "\0" + out[0]
    return out


def is_odd(key: str) -> bool:
    """Whether the cut beside this chunk may not be one of the pre-tokenizer's: blanks that adjoin, or others."""
    body = key[1:] if key[:1] in ("\0", "\n") else key
    return not body or bool(_BLANK.search(body))


def chunk_text(key: str) -> str:
    """The text that a key stands for."""
    return key[1:] if key[0] == "\0" else key if key[0] == "\n" else " " + key


def chunk_length(key: str) -> int:
    """Code points of that text."""
    return len(key) - 1 if key[0] == "\0" else len(key) if key[0] == "\n" else len(key) + 1


class ByChunk(dict):
    """A value per chunk, made when it is first asked for; None for odd chunks."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key: str):
        self[key] = value = None if is_odd(key) else self.make(chunk_text(key))
        return value


def pieces(text: str) -> list[str]:
    """The pre-tokenizer's words."""
    return PATTERN.findall(text)


def byte_of_char() -> dict[str, int]:
    """Fixed by the vocabulary format: the printable character that stands for each byte, reversed."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def pack_ids(ids) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class TokenIds:
    """Ids of texts as little-endian unsigned 32-bit bytes, special tokens recognised as the library does.

    A vocabulary whose ids are its merge ranks is encoded text by text without a
    cache; any other goes through the library's own encoder.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = _ranks(spec, special)
        self._fast = None
        if ranks is not None:
            import tiktoken
            self._fast = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN_TEXT, mergeable_ranks=ranks,
                                           special_tokens=special).encode_to_numpy
        self._path, self._library = path, None

    def ids(self, text: str) -> bytes:
        if self._fast:
            try:
                return self._fast(text, allowed_special="all").astype("<u4", copy=False).tobytes()
            except ValueError:  # a run of white space too long for its regular expressions
                pass
        if self._library is None:
            from tokenizers import Tokenizer
            self._library = Tokenizer.from_file(self._path)
            self._library.no_padding()
            self._library.no_truncation()
        return pack_ids(self._library.encode(text, add_special_tokens=False).ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        return list(map(self.ids, texts))


def _ranks(spec: dict, special: dict[str, int]) -> dict[bytes, int] | None:
    """Ids by token, if these are the ranks of plain byte-level merges; else None."""
    byte, model = byte_of_char(), spec["model"]
    cut = spec.get("pre_tokenizer") or {}
    if (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex", True)) != ("ByteLevel", False, True) or spec.get("normalizer"):
        return None
    if model.get("type") != "BPE" or any(model.get(k) for k in ("ignore_merges", "unk_token", "continuing_subword_prefix",
                                                                "end_of_word_suffix", "byte_fallback", "dropout")):
        return None
    words = {t: i for t, i in model["vocab"].items() if t not in special}
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [words.get(a + b) for a, b in pairs]
    if None in made or made != sorted(made) or len(words) != len(pairs) + 256 or not all(c in byte for t in words for c in t):
        return None
    if made and made[0] <= max(i for t, i in words.items() if len(t) == 1):
        return None
    return {bytes(byte[c] for c in t): i for t, i in words.items()}


@lru_cache(maxsize=2)
def token_ids(path: str) -> TokenIds:
    """One encoder for all tasks of a Python worker."""
    return TokenIds(path)
