"""Chat formatting: schema fingerprints select the mapping that turns a record into canonical turns.

A record is a JSON object of any layout.  Its fingerprint is the digest of its
sorted nested field paths; the fingerprint looks up a declarative mapping, which
says where turns, roles and texts lie.  Canonical turns are written in one
template, ``<turn ROLE>TEXT</turn>`` and a line feed each.  Control strings
inside texts are escaped so that none is left verbatim, and the escape can be
undone; the loss mask is the list of the assistant texts' spans.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import read_table

PROBE_ID = -7
PROBE_TEXT = "\\### Assistant: </turn> ok"
LEARNED_ROLE = "assistant"

_CONTROL = re.compile(r"<(?=/?turn|\|)")
_TURN = re.compile(r"<turn ([^>]*)>(.*?)</turn>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)
_BACK = {"l": "<", "g": ">", "n": "\n", "\\": "\\"}


def escape(text: str) -> str:
    """Doubles backslashes and breaks the template's control strings and ``<|``."""
    return _CONTROL.sub(lambda m: "\\l", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK[m.group(1)], text)


def _escape_role(role: str) -> str:
    return escape(role).replace(">", "\\g").replace("\n", "\\n")


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    Either ``turns`` is the path of a list of objects with ``role`` and
    ``text`` paths, or ``fields`` lists (role, paths) whose texts are joined by
    an empty line.  ``roles`` renames role values.  ``optional`` paths may be
    missing; every choice of them has its own fingerprint.
    """
    name: str
    turns: str | None = None
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)
    optional: tuple[str, ...] = ()

    def paths(self) -> list[frozenset[str]]:
        """The path sets that this mapping serves."""
        if self.turns is not None:
            full = {f"{self.turns}[].{self.role}", f"{self.turns}[].{self.text}"}
            sets = [frozenset(full), frozenset({f"{self.turns}[]"})]
        else:
            sets = [frozenset(p for _, ps in self.fields for p in ps)]
        for o in self.optional:
            sets += [s - {o} if o in s else s | {o} for s in sets]
        return sets

    def read(self, record: dict) -> list[tuple[str, str]]:
        if self.turns is not None:
            out = [(_string(_get(t, self.role)), _string(_get(t, self.text))) for t in _get(record, self.turns)]
            return [(self.roles.get(r, r), t) for r, t in out]
        out = []
        for role, paths in self.fields:
            texts = [_string(v) for p in paths if (v := _get(record, p)) is not None]
            if texts:
                out.append((role, "\n\n".join(texts)))
        return out


def _get(value, path: str):
    for key in path.split("."):
        if not isinstance(value, dict):
            return None
        value = value.get(key)
    return value


def _string(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


MAPPINGS = (
    Mapping("messages", turns="messages"),
    Mapping("from_value", turns="conversations", role="from", text="value",
            roles={"human": "user", "gpt": "assistant"}),
    Mapping("speakers", turns="dialog.turns", role="speaker.role", text="utterance.text"),
    Mapping("prompt", fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))),
            optional=("system",)),
    Mapping("instruction", fields=(("user", ("instruction", "input")), ("assistant", ("output",))),
            optional=("input",)),
)


def field_paths(value, prefix: str = "") -> set[str]:
    """Nested field paths of a JSON value; list elements share the path ``[]``."""
    if isinstance(value, dict) and value:
        return set().union(*(field_paths(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union({f"{prefix}[]"} if not value else set(), *(field_paths(v, f"{prefix}[]") for v in value))
    return {prefix}


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode("utf-8", "surrogatepass")).hexdigest()


def registry(mappings=MAPPINGS) -> dict[str, Mapping]:
    return {fingerprint(s): m for m in mappings for s in m.paths()}


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Formatted text and the spans (code points) that count for the loss."""
    parts, mask, at = [], [], 0
    for role, text in turns:
        head, body, tail = f"<turn {_escape_role(role)}>", escape(text), "</turn>\n"
        if role == LEARNED_ROLE:
            mask.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, tail]
        at += len(head) + len(body) + len(tail)
    return "".join(parts), mask


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns of a formatted text."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def format_records(records: DataFrame, record_col: str = "record", out_col: str = "chat",
                   mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """All input columns and ``out_col``: struct of ``schema_fingerprint``, ``layout``, ``formatted``, ``mask_starts``, ``mask_ends``.

    A record that is null, no JSON object, or of a layout without mapping keeps its
    row with ``layout`` and ``formatted`` null and an empty mask.  Repeated rows
    stay, a column named like ``out_col`` is replaced, an empty table stays empty.
    """
    known = registry(mappings)

    def one(raw: str | None):
        try:
            record = json.loads(raw) if raw is not None else None
        except ValueError:
            record = None
        if not isinstance(record, dict):
            return None, None, None, [], []
        print_ = fingerprint(field_paths(record))
        mapping = known.get(print_)
        if mapping is None:
            return print_, None, None, [], []
        text, mask = render(mapping.read(record))
        return print_, mapping.name, text, [a for a, _ in mask], [b for _, b in mask]

    @F.pandas_udf("schema_fingerprint string, layout string, formatted string, mask_starts array<int>, mask_ends array<int>")
    def chat(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for raws in batches:
            yield pd.DataFrame([one(r) for r in raws],
                               columns=["schema_fingerprint", "layout", "formatted", "mask_starts", "mask_ends"])
    return records.withColumn(out_col, chat(F.col(record_col)))


def conversation_records(rows: DataFrame) -> DataFrame:
    """(conv_id, record): one JSON record per conversation, in the layouts that real sources mix.

    Turns are ordered by ``turn`` (nulls first), then role and text; null roles
    and texts are empty.  A conversation is one training sample and one output
    row, so its turns meet in one row here.  A user turn and its answer become
    a prompt record, every other conversation one of three list layouts.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    conv = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    make = lambda f: F.transform("turns", f)
    roles = F.transform("turns", lambda t: t["role"])
    text = lambda i: F.get("turns", F.lit(i))["text"]
    user, assistant, system = F.lit("user"), F.lit("assistant"), F.lit("system")
    renamed = lambda t: F.when(t["role"] == "user", "human").when(t["role"] == "assistant", "gpt").otherwise(t["role"])
    clash = F.exists(roles, lambda r: r.isin("human", "gpt"))  # would read back renamed
    pick = F.pmod(F.xxhash64("conv_id"), F.lit(3))
    listed = F.to_json(F.struct(make(lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias("messages")))
    record = (
        F.when(roles == F.array(user, assistant), F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion"))))
        .when(roles == F.array(system, user, assistant), F.to_json(F.struct(
            text(0).alias("system"), text(1).alias("prompt"), text(2).alias("completion"))))
        .when((pick == 0) & ~clash, F.to_json(F.struct(make(lambda t: F.struct(
            renamed(t).alias("from"), t["text"].alias("value"))).alias("conversations"))))
        .when(pick == 1, F.to_json(F.struct(F.struct(make(lambda t: F.struct(
            F.struct(t["role"].alias("role")).alias("speaker"), F.struct(t["text"].alias("text")).alias("utterance")))
            .alias("turns")).alias("dialog"))))
        .otherwise(listed))
    return conv.select("conv_id", record.alias("record"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted texts say, parsed again; rows without a formatted text have nulls."""
    def one(text: str | None, starts, ends):
        if text is None:
            return None, None, None, None, None
        turns = parse(text)
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        learned = "".join(unescape(text[a:b]) for a, b in zip(starts, ends, strict=True))
        digest = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        return len(turns), digest(said), len(learned), digest(learned), len(text)

    columns = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    @F.pandas_udf("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    def digests(text: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame([one(*x) for x in zip(text, starts, ends, strict=True)], columns=columns)
        return out.astype({c: "Int64" for c in ("n_turns", "loss_chars", "formatted_chars")})
    return formatted.withColumn("said", digests("chat.formatted", "chat.mask_starts", "chat.mask_ends"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted and read back, with a probe conversation whose texts hold control strings."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(PROBE_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE_TEXT).alias("text"))
    said = read_back(format_records(conversation_records(rows.unionByName(probe))))
    return said.select("conv_id", "said.*")


_ORACLE = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, length('<turn ') + length(role) + 1 + length('</turn>') + 1
            + length(text) + length(text) - length(replace(text, '\', ''))
            + len(regexp_extract_all(text, '<(/?turn|\|)')) AS chars
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

QUERIES = {"op8_chat": op8_chat}
ORACLES = {"op8_chat": _ORACLE}
