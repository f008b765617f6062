import json

import pytest
from pyspark.sql import functions as F

from marquee.llm import tool_calls
from tests.llm.conftest import SMOKE_DIR

SCHEMAS = {"f": {"type": "object", "properties": {"x": {"type": "integer"}}, "required": ["x"], "additionalProperties": False}}
CALL = "conv_id long, call_id string, turn long, name string, arguments string, after string"
RESULT = "conv_id long, call_id string, turn long, content string"


def link(spark, calls, results=()):
    calls = spark.createDataFrame(calls, CALL).withColumns({n: F.lit("x") for n in ("depth", "status", "n_calls", "result", "seen")})
    return tool_calls.link(calls, spark.createDataFrame(list(results), RESULT).withColumn("status", F.lit(1)), SCHEMAS).collect()


def test_every_status(spark):
    calls = [
        (1, "a", 0, "f", '{"x": 1}', None),
        (1, "b", 2, "f", ' {"x" : 2 } ', "a"),
        (1, "b", 3, "f", '{"x": 3}', "a"),
        (1, "c", 4, "f", '{"x": "1"}', "b"),
        (1, "d", 5, "g", "{}", "c"),
        (1, "e", 6, "f", None, "gone"),
        (1, "f", 7, "f", '{"x": 1}', "g"),
        (1, "g", 8, "f", '{"x": 1}', "f"),
        (1, "h", 9, "f", '{"x": 1}', "g"),
        (1, None, 9, "f", '{"x": 1}', None),
        (None, "a", 9, "f", "not json", None),
        (2, "a", 0, "f", '{"x": NaN}', "b"),
        (2, "b", 9, "f", '{"x": true}', None),
    ]
    results = [(1, "a", 1, "one"), (1, "a", 2, "two"), (1, "b", 3, None), (3, "z", 0, "lost"), (None, "a", 0, "lost"), (1, "c", 5, "c")]
    got = sorted((r.conv_id or 0, r.call_id or "", r.status, r.position, r.depth) for r in link(spark, calls, results))
    assert got == sorted(
        [
            (1, "a", "ok", 0, 0), (1, "b", "ok", 2, 1), (1, "b", "duplicate_call", None, None), (1, "c", "invalid_arguments", 3, 2),
            (1, "d", "invalid_arguments", 4, 3), (1, "e", "dangling", 1, 0), (1, "f", "cyclic", 5, None), (1, "g", "cyclic", 6, None),
            (1, "h", "cyclic", 7, None), (1, "", "no_id", None, None), (0, "a", "no_id", None, None), (2, "a", "invalid_arguments", 1, 1),
            (2, "b", "invalid_arguments", 0, 0), (3, "z", "orphan_result", None, None), (0, "a", "orphan_result", None, None),
        ],
        key=lambda r: (r[0], r[1], r[2], r[3] is not None, r[3] or 0),
    )


def test_first_result_and_canonical_json(spark):
    row = link(spark, [(1, "a", 0, "f", '{ "x" :1}', None)], [(1, "a", 9, "later"), (1, "a", 2, 'é "\n\u2028')])[0]
    assert row.n_results == 2
    assert row.json == (
        '{"after":null,"arguments":{"x":1},"call_id":"a","conv_id":1,"name":"f","position":0,"result":"é \\"\\n\u2028","status":"ok"}'
    )


def test_a_long_chain_out_of_order(spark):
    n = 700
    calls = [(1, f"c{i}", n - i, "f", '{"x": 1}', f"c{i - 1}" if i else None) for i in range(n)]
    rows = link(spark, calls)
    assert sorted((r.depth, r.position, r.call_id) for r in rows) == [(i, i, f"c{i}") for i in range(n)]


@pytest.mark.parametrize(
    "value, schema, found",
    [
        (1, {"type": "integer"}, []),
        (True, {"type": "integer"}, ["$: not integer"]),
        (1.5, {"type": "number", "maximum": 1}, ["$: out of range"]),
        ("c", {"enum": ["a", "b"]}, ["$: not listed"]),
        ([1, "x"], {"type": "array", "items": {"type": "integer"}}, ["$[1]: not integer"]),
        ({"b": 1}, {"type": "object", "properties": {"a": {}}, "required": ["a"], "additionalProperties": False}, ["$.a: missing", "$.b: not known"]),
        ({"a": {"b": None}}, {"properties": {"a": {"properties": {"b": {"type": "string"}}}}}, ["$.a.b: not string"]),
    ],
)
def test_violations(value, schema, found):
    assert tool_calls.violations(value, schema) == found


def test_digest_of_smoke_conversations(spark):
    conversations = spark.read.parquet(f"{SMOKE_DIR}/conversations.parquet")
    turns = {(r.conv_id, r.turn): r for r in conversations.collect()}
    got = {(r.conv_id, r.call_id): r for r in tool_calls.digest(conversations).collect()}
    users = [k for k, r in turns.items() if r.role == "user"]
    orphans = [k for k, r in turns.items() if r.role == "assistant" and (k[0], k[1] - 1) not in users]
    assert len(got) == len(users) + len(orphans)
    for conv, turn in users:
        row = got[conv, f"call-{conv}-{turn}"]
        after = (conv, turn - 2)
        assert row.depth == (got[conv, f"call-{conv}-{turn - 2}"].depth + 1 if after in users else 0)
        answer = turns.get((conv, turn + 1))
        assert json.loads(row.json)["result"] == (answer.text if answer and answer.role == "assistant" else None)
        assert row.json == tool_calls.canonical(json.loads(row.json))
    for conv in {c for c, _ in users}:
        own = sorted((r for r in got.values() if r.conv_id == conv and r.position is not None), key=lambda r: r.position)
        assert [(r.depth, r.turn) for r in own] == sorted((r.depth, r.turn) for r in own)
        assert [r.position for r in own] == list(range(len(own)))


def test_no_rows(spark):
    assert link(spark, []) == []
    assert [r.status for r in link(spark, [], [(1, "a", 0, None)])] == ["orphan_result"]


def test_whole_texts_and_turns_of_every_role(spark):
    long = "  many\twords " * 300
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", long), (1, 2, "assistant", "yes"), (1, 3, None, "who"), (1, 4, "tool", None), (None, 0, "system", "x")]
    rows += [(2, i, "user", f"{long}{i}") for i in range(30)]
    got = tool_calls.every_turn(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    other = sorted((r.conv_id or 0, r.turn, json.loads(r.json)["role"] or "", json.loads(r.json)["result"] or "") for r in got if r.status == "unlinked")
    assert other == [(0, 0, "system", "x"), (1, 0, "system", "be brief"), (1, 3, "", "who"), (1, 4, "tool", "")]
    assert len(got) == len(rows) - 1  # the answer is in the row of its call
    texts = {(conv, turn): text for conv, turn, _, text in rows}
    asked = {(r.conv_id, r.turn): json.loads(r.json)["arguments"].get("query") for r in got if r.call_id}
    assert {k: v for k, v in asked.items() if v is not None} == {k: texts[k] for k, v in asked.items() if v is not None}
    assert len([v for v in asked.values() if v]) > 20


def test_repeated_ids_keep_their_content(spark):
    calls = [(1, "a", 0, "f", '{"x": 1}', None), (1, "a", 2, "f", '{"x": "2"}', "b"), (1, "a", 2, "f", '{"x": "2"}', "b"), (1, "b", 1, "f", '{"x": 5}', None)]
    results = [(1, "a", 1, "one"), (1, "a", 3, "two"), (1, "a", 3, "two"), (1, "z", 4, "lost"), (1, "z", 5, "lost too"), (1, None, 6, "no id")]
    calls, results = spark.createDataFrame(calls, CALL), spark.createDataFrame(results, RESULT)
    got = [(r, json.loads(r.json)) for r in tool_calls.link_all(calls, results, SCHEMAS).collect()]
    seen = sorted((r.status, r.turn, r.rank or 0, r.name or "", str(j["arguments"]), j["after"] or "", j["result"] or "", len(r.errors)) for r, j in got)
    assert seen == [
        ("duplicate_call", 2, 2, "f", "{'x': '2'}", "b", "", 1),
        ("duplicate_call", 2, 3, "f", "{'x': '2'}", "b", "", 1),
        ("further_result", 3, 2, "", "None", "", "two", 0),
        ("further_result", 3, 3, "", "None", "", "two", 0),
        ("no_result", 1, 1, "f", "{'x': 5}", "", "", 0),
        ("ok", 0, 1, "f", "{'x': 1}", "", "one", 0),
        ("orphan_result", 4, 1, "", "None", "", "lost", 0),
        ("orphan_result", 5, 2, "", "None", "", "lost too", 0),
        ("orphan_result", 6, 0, "", "None", "", "no id", 0),
    ]
    assert len(tool_calls.link(calls, results, SCHEMAS).collect()) == 7


@pytest.mark.parametrize(
    "text, error",
    [
        ('{"x": "\\ud800"}', "half a character"), ('{"\\udc00x": 1}', "half a character"), ("[" * 200_000, "nested too deep"),
        ('{"x":' * 5000 + "1" + "}" * 5000, "nested too deep"), ('{"x": 1e999}', "number out of range"), ('{"x": -1e999}', "number out of range"),
        ('{"x": ' + "9" * 5000 + "}", "number out of range"), ('{"x": 1, "x": 1}', "repeated key"), ('{"y": {"a": 1, "\\u0061": 2}}', "repeated key"),
        ('{"x": NaN}', "not JSON"), ("{'x': 1}", "not JSON"), ("", "not JSON"), ('{"x": 1} 2', "not JSON"), ('"' + "[" * 500, "not JSON"),
    ],
)
def test_arguments_without_a_canonical_form(spark, text, error):
    rows = link(spark, [(1, "a", 0, "f", text, None), (1, "b", 1, "f", '{"x": 1}', None)])
    got = {r.call_id: (r.status, r.errors, json.loads(r.json)["arguments"]) for r in rows}
    assert got == {"a": ("invalid_arguments", [f"$: {error}"], None), "b": ("no_result", [], {"x": 1})}


@pytest.mark.parametrize(
    "text, shown",
    [
        ("1.0", "1"), ("1", "1"), ("-0.0", "0"), ("1e3", "1000"), ("1E-7", "1e-7"), ("0.00001", "0.00001"), ("123e18", "123000000000000000000"),
        ("1e21", "1e+21"), ("1.5e300", "1.5e+300"), ("0.1", "0.1"), ("-2.50", "-2.5"), ("5e-324", "5e-324"), ("9007199254740993", "9007199254740993"),
        ("1234.5678", "1234.5678"), ("1e16", "10000000000000000"), ("0.000001234", "0.000001234"), ("12345678901234567890.0", "12345678901234567000"),
        ('"\\u0061\\ud83d\\ude00"', '"a😀"'), ('"\\u001f\\n\\u007f/"', '"\\u001f\\n\x7f/"'),
        ('{"b": 1, "a": [ true , null ], "\\ud83d\\ude00": 2, "\ufffd": 3}', '{"a":[true,null],"b":1,"😀":2,"\ufffd":3}'),
        ('["[[", "]"]', '["[[","]"]'), ("[" * 150 + "]" * 150, "[" * 150 + "]" * 150),
    ],
)
def test_canonical_json(text, shown):
    assert tool_calls.canonical(tool_calls.parse(text)) == shown
    assert tool_calls.canonical(tool_calls.parse(shown)) == shown


def plain_links(calls, results, schemas):
    """Status, errors, depth, position and JSON of every row, from the definitions; ``after`` is a list of ids or null."""
    from collections import defaultdict

    by_id, answers = defaultdict(list), defaultdict(list)
    for call in calls:
        by_id[call[:2]].append(call)
    for result in results:
        answers[result[:2]].append(result)
    low = lambda v: (v is not None, v)  # noqa: E731 - nulls first
    first, out = {}, []
    for key, own in by_id.items():
        if None not in key:
            own.sort(key=lambda c: (low(c[2]), low(c[4]), low(c[3]), (c[5] is not None, [low(a) for a in c[5] or []])))
            first[key] = own[0]

    def preds(key):
        return {(key[0], a) for a in first[key][5] or [] if a is not None}

    depth = {}
    while True:  # what can be settled, until nothing is
        more = {k for k in first if k not in depth and all(p in depth or p not in first for p in preds(k))}
        if not more:
            break
        for k in more:
            depth[k] = max((depth[p] + 1 for p in preds(k) if p in first), default=0)
    place = {}
    for conv in {c for c, _ in first}:
        mine = sorted((k for k in first if k[0] == conv), key=lambda k: (depth.get(k, 2**62), low(first[k][2]), k[1]))
        place.update({k: i for i, k in enumerate(mine)})

    def judged(call):
        try:
            value = tool_calls.parse(call[4] or "")
        except tool_calls.Refused as why:
            return None, [f"$: {why}"]
        return value, ["$: no such tool"] if call[3] not in schemas else tool_calls.violations(value, schemas[call[3]])

    def row(key, turn, name, after, arguments, result, status, errors, at, deep, rank, n):
        shown = {"conv_id": key[0], "call_id": key[1], "name": name, "after": after, "position": at, "arguments": arguments, "result": result, "status": status}
        out.append((key[0], key[1], turn, name, at, deep, rank, n, status, errors, json.dumps(shown, sort_keys=True, separators=(",", ":"), ensure_ascii=False)))

    for key, own in by_id.items():
        for rank, call in enumerate(own, 1):
            value, errors = judged(call)
            args = (key, call[2], call[3], call[5], value)
            if None in key:
                row(*args, None, "no_id", errors, None, None, None, 0)
            elif rank > 1:
                row(*args, None, "duplicate_call", errors, None, None, rank, 0)
            else:
                found = sorted(answers.get(key, []), key=lambda r: (low(r[2]), low(r[3])))
                gone = any(p not in first for p in preds(key))
                status = "cyclic" if key not in depth else "dangling" if gone else "invalid_arguments" if errors else "ok" if found else "no_result"
                row(*args, found[0][3] if found else None, status, errors, place[key], depth.get(key), 1, len(found))
    for key, own in answers.items():
        own = sorted(own, key=lambda r: (low(r[2]), low(r[3])))
        for rank, result in enumerate(own, 1):
            if None in key:
                row(key, result[2], None, None, None, result[3], "orphan_result", [], None, None, None, 0)
            elif key not in first:
                row(key, result[2], None, None, None, result[3], "orphan_result", [], None, None, rank, len(own))
            elif rank > 1:
                row(key, result[2], None, None, None, result[3], "further_result", [], None, None, rank, len(own))
    return out


def graph(seed, n, convs):
    """Calls that build on up to three others, some of them later, missing, repeated or themselves."""
    import random

    pick = random.Random(seed)
    calls, results = [], []
    for i in range(n):
        conv, name = pick.randrange(convs), f"c{pick.randrange(n // convs)}"
        after = [f"c{max(0, int(name[1:]) - pick.randint(1, 6))}" for _ in range(pick.choice([0, 1, 1, 1, 2, 3]))]
        if pick.random() < 0.04:
            after += [pick.choice(["gone", name, f"c{int(name[1:]) + 2}", None])]
        text = pick.choice(['{"x": 1}', '{"x" :2.0}', '{"x": "1"}', "{", None, '{"x": 1, "x": 2}', '{"x": 3, "y": 1e999}'])
        calls.append((conv, name if pick.random() > 0.01 else None, pick.choice([i, i, None]), pick.choice(["f", "f", "g"]), text, pick.choice([after, after, None]) if not after else after))
        if pick.random() < 0.6:
            results.append((conv, pick.choice([name, name, f"z{i % 5}", None]), i + 1, pick.choice([f"r {i}", None])))
    return calls, results


@pytest.mark.parametrize("seed", [1, 2])
def test_every_column_equals_the_plain_version(spark, seed):
    calls, results = graph(seed, 160, 4)
    listed = CALL.replace("after string", "after array<string>")
    got = tool_calls.link_all(spark.createDataFrame(calls, listed), spark.createDataFrame(results, RESULT), SCHEMAS).collect()
    want = plain_links(calls, results, SCHEMAS)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert len({r.status for r in got}) >= 8 and max(r.depth or 0 for r in got) > 3


def test_chains_between_calls_of_several(spark):
    """A ladder: long chains that meet and part; depths are those of the longest way."""
    calls, depth = [(1, "s0", 0, "f", '{"x": 1}', None)], {"s0": 0}
    for k in range(4):
        for side, length in (("a", 30 + k), ("b", 7)):
            for i in range(length):
                above = f"{side}{k}x{i - 1}" if i else f"s{k}"
                calls.append((1, f"{side}{k}x{i}", len(calls), "f", '{"x": 1}', [above]))
                depth[f"{side}{k}x{i}"] = depth[above] + 1
        calls.append((1, f"s{k + 1}", len(calls), "f", '{"x": 1}', [f"a{k}x{29 + k}", f"b{k}x6", f"s{k}"]))
        depth[f"s{k + 1}"] = depth[f"a{k}x{29 + k}"] + 1
    listed = CALL.replace("after string", "after array<string>")
    rows = tool_calls.link(spark.createDataFrame(calls[::-1], listed), spark.createDataFrame([], RESULT), SCHEMAS).collect()
    assert {r.call_id: r.depth for r in rows} == depth
