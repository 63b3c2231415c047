import json

from ledgerline.llm import chat_format as CF

CALL = "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>"
RESULT = "conv_id long, turn long, call_id string, content string"
SCHEMAS = {"f": {"x": ("integer", True), "s": ("string", False), "o": ("object", False), "n": ("number", False),
                 "b": ("boolean", False), "a": ("array", False)}}


def run(spark, calls, results, schemas=SCHEMAS):
    return CF.format_calls(spark.createDataFrame(calls, CALL), spark.createDataFrame(results, RESULT),
                           schemas).collect()


def test_links_orders_validates_and_serialises(spark):
    rows = run(spark, [(1, 0, "a", "f", '{"x": 1, "o": {"z":1, "b":[2, {"d":1,"c":2}]}}', ["b", "gone"]),
                       (1, 1, "b", "f", '{"s": "é\\"", "x": 2}', None),
                       (1, 2, "c", "f", '{"x": "1", "q": 1}', ["a"]),
                       (1, 3, "d", "g", "{}", []), (1, 4, "e", "f", "no json", [])],
               [(1, 5, "a", "ra"), (1, 6, "b", "rb"), (1, 9, "b", "later"), (1, 7, "c", None), (1, 8, "zz", "r?")])
    got = {r.call_id: r for r in rows}
    assert [c for c in sorted("abcde", key=lambda c: got[c].position)][:1] == ["b"]
    order = sorted("abcde", key=lambda c: got[c].position)
    assert sorted(got[c].position for c in "abcde") == list(range(5))
    assert order.index("b") < order.index("a") < order.index("c")
    assert got["zz"].status == "orphan" and got["zz"].position is None
    assert got["d"].status == "unanswered" and got["d"]["errors"] == ["unknown_tool"]
    assert got["e"]["errors"] == ["not_json"] and got["c"]["errors"] == ["extra:q", "type:x"]
    assert got["a"].valid and got["b"].valid and not got["c"].valid
    body = json.loads(got["a"].json)
    assert body["arguments"] == {"o": {"b": [2, {"c": 2, "d": 1}], "z": 1}, "x": 1}
    assert got["a"].json == json.dumps(body, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert json.loads(got["b"].json)["result"] == "rb"


def test_types(spark):
    rows = run(spark, [(1, 0, "a", "f", '{"x":1,"s":"t","o":{},"n":1.5,"b":true,"a":[]}', None),
                       (1, 1, "b", "f", '{"x":1.5,"s":1,"o":[],"n":"1","b":0,"a":{}}', None),
                       (1, 2, "c", "f", '{"x":null}', None), (1, 3, "d", "f", "[1]", None),
                       (1, 4, "e", None, None, None)], [])
    got = {r.call_id: r["errors"] for r in rows}
    assert got["a"] == []
    assert got["b"] == ["type:a", "type:b", "type:n", "type:o", "type:s", "type:x"]
    assert got["c"] == ["type:x"] and got["d"] == ["missing:x"] and got["e"] == ["not_json"]


def test_cycles_repeats_and_nulls(spark):
    calls = [(1, 0, "a", "f", '{"x":1}', ["b"]), (1, 1, "b", "f", '{"x":1}', ["a"]),
             (1, 2, "c", "f", '{"x":1}', []), (1, 3, "self", "f", '{"x":1}', ["self"]),
             (2, 0, "a", "f", '{"x":1}', []), (2, 0, "a", "f", '{"x":1}', []), (2, 5, "a", "f", '{"x":9}', []),
             (None, 0, "a", "f", '{"x":1}', []), (3, 0, None, "f", '{"x":1}', []), (3, None, "n", "f", '{"x":1}', [])]
    results = [(1, 9, "a", "r"), (2, 9, "a", "r"), (None, 9, "a", "r"), (3, 9, None, "r"), (2, 9, "a", "r")]
    got = run(spark, calls, results)
    one = {r.call_id: r for r in got if r.conv_id == 1}
    assert one["c"].position == 0 and not one["c"].cyclic
    assert {c for c in one if one[c].cyclic} == {"a", "b", "self"} and not one["a"].valid
    two = [r for r in got if r.conv_id == 2]
    assert len(two) == 1 and two[0].turn == 0 and two[0].status == "linked"
    assert sorted(r.status for r in got if r.conv_id is None) == ["orphan", "unanswered"]
    assert sorted((str(r.call_id), r.status) for r in got if r.conv_id == 3) == [
        ("None", "orphan"), ("None", "unanswered"), ("n", "unanswered")]
    assert run(spark, [], []) == []


def test_long_conversation_is_numbered_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(CF, "STRETCH", 7)
    calls = [(1, t, f"t{t}", "f", '{"x":1}', [f"t{t - 2}"]) for t in range(0, 200, 2)]
    got = run(spark, calls, [(1, t + 1, f"t{t}", "r") for t in range(0, 200, 2)])
    assert [r.turn for r in sorted(got, key=lambda r: r.position)] == list(range(0, 200, 2))
    assert all(r.valid for r in got)


def test_messages(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", json.dumps({"tool_calls": [
        {"id": "k", "name": "f", "arguments": {"x": 1}, "depends_on": []}]})),
        (1, 2, "tool", json.dumps({"tool_call_id": "k", "content": "42"})), (1, 3, "assistant", "plain"),
        (1, 4, "tool", "{broken"), (None, None, None, None)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    calls, results = CF.tool_messages(messages)
    got = [r for r in CF.format_calls(calls, results, SCHEMAS).collect() if r.status == "linked"]
    assert len(got) == 1 and got[0].valid and json.loads(got[0].json)["result"] == "42"
    calls, results = CF.plain_turns(messages)
    assert {r.status for r in CF.format_calls(calls, results).collect()} == {"linked", "orphan"}
