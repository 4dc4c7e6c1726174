import json

from hypothesis import given, settings
from hypothesis import strategies as st

from wardflow.llm import chat

TEXT = st.text(alphabet="a\\<>|/turn \n#é", max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), max_size=5))
def test_round_trip(turns):
    text, mask = chat.render(turns)
    assert chat.parse(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]
    for _, t in turns:
        assert "<turn" not in chat.escape(t) and "</turn" not in chat.escape(t) and "<|" not in chat.escape(t)


def test_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"value": "a", "from": "gpt"}]},
        {"dialog": {"turns": [{"speaker": {"role": "user"}, "utterance": {"text": "q"}},
                              {"speaker": {"role": "assistant"}, "utterance": {"text": "a"}}]}},
        {"prompt": "q", "completion": "a"}, {"instruction": "q", "output": "a"},
    ]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)]
    more = [(10, json.dumps({"system": "s", "prompt": "q", "completion": "a"})),
            (11, json.dumps({"instruction": "i", "input": "j", "output": None})), (12, json.dumps({"messages": []}))]
    bad = [(20, None), (21, "not json"), (22, "[1]"), (23, json.dumps({"other": 1})), (24, "{}")]
    df = spark.createDataFrame(rows + more + bad, "i int, record string").selectExpr("*", "1 as chat")
    got = {r["i"]: r["chat"] for r in chat.format_records(df).collect()}
    assert len({got[i]["schema_fingerprint"] for i in range(5)}) == 5
    assert all(chat.parse(got[i]["formatted"]) == [("user", "q"), ("assistant", "a")] for i in range(5))
    assert chat.parse(got[10]["formatted"])[0] == ("system", "s")
    assert chat.parse(got[11]["formatted"]) == [("user", "i\n\nj")] or chat.parse(got[11]["formatted"])[0] == ("user", "i\n\nj")
    assert got[12]["formatted"] == "" and got[12]["layout"] == "messages"
    assert all(got[i]["formatted"] is None and got[i]["mask_starts"] == [] for i in range(20, 25))
    assert chat.format_records(df.limit(0)).count() == 0


def test_query_with_odd_rows(spark, tmp_path):
    rows = [(1, 0, "user", "x"), (1, 0, "user", "x"), (1, None, None, None), (2, 0, "human", "a"), (2, 1, "gpt", "b"),
            (None, 0, "user", "who"), (3, 0, "assistant", "z" * 100_000), (4, 0, "user", "<turn a></turn>\n\\l<|")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'c' as chat") \
        .write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r for r in chat.op8_chat(spark, str(tmp_path)).collect()}
    said = {}
    for c, t, r, x in sorted(rows + [(-7, 0, "user", chat.PROBE_TEXT), (-7, 1, "assistant", chat.PROBE_TEXT)],
                             key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        said.setdefault(c, []).append((r or "", x or ""))
    import hashlib
    assert set(got) == set(said)
    for c, turns in said.items():
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        learned = "".join(t for r, t in turns if r == "assistant")
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
