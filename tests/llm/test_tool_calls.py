import json
import random

import pytest
from pyspark.sql import functions as F

from tallybridge.llm import tool_calls as C

CALLS = "conv_id bigint, call_id string, position bigint, name string, arguments string"
RESULTS = "conv_id bigint, call_id string, position bigint, content string"


def linked(spark, calls, results=()):
    df = C.link_tool_calls(spark.createDataFrame(list(calls), CALLS), spark.createDataFrame(list(results), RESULTS), C.SCHEMAS)
    return df.collect()


@pytest.mark.parametrize(
    "text, want",
    [
        ('{"b": 1, "a": {"d": [3, {"z": 1, "y": null}], "c": "é\\n\\u0041"}}', '{"a":{"c":"é\\nA","d":[3,{"y":null,"z":1}]},"b":1}'),
        (" [1 , 2.50 , true ] ", "[1,2.5,true]"),
        ('{"a": 1, "a": 2}', None),
        ("{broken", None),
        ("", None),
        (None, None),
    ],
)
def test_canonical_json(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(C.canonical(F.col("t"))).first()[0]
    assert got == want
    if got:
        assert df.select(C.canonical(C.canonical(F.col("t")))).first()[0] == got
        assert json.loads(got) == json.loads(text)


@pytest.mark.parametrize(
    "name, arguments, want",
    [
        ("search", '{"query": "x"}', ""),
        ("search", '{"query": "x", "limit": 51}', "limit is out of range"),
        ("search", '{"query": "x", "limit": 1.5}', "limit is no integer"),
        ("search", '{"query": 5, "limit": "5"}', "limit is no integer; query is no string"),
        ("search", '{"query": null}', "missing query"),
        ("search", "{}", "missing query"),
        ("search", '{"query": "", "x": 1, "y": {}}', "query is out of range; unknown field x; unknown field y"),
        ("summarise", '{"text": "t", "ratio": 1}', ""),
        ("summarise", '{"text": "t", "ratio": 1e0}', ""),
        ("summarise", '{"text": "t", "ratio": 1.01}', "ratio is out of range"),
        ("translate", '{"text": "t", "to": "en", "formal": "yes"}', "formal is no boolean"),
        ("search", '{"query": "x", "after": "c1"}', "after is no call"),
        ("search", '{"query": "x", "after": {"$ref": "nowhere"}}', "unknown reference nowhere"),
        ("search", "[1]", "arguments are no object"),
        ("search", "nonsense", "arguments are no object"),
        ("search", None, "arguments are no object"),
        ("unheard", "{}", "unknown tool"),
        (None, "{}", "unknown tool"),
    ],
)
def test_arguments_against_schemas(spark, name, arguments, want):
    assert [r["errors"] for r in linked(spark, [(1, "a", 0, name, arguments)])] == [want]


def test_links_duplicates_and_orphans(spark):
    q = '{"query":"x"}'
    calls = [(1, "a", 0, "search", q), (1, "a", 5, "search", q), (1, "b", 1, "search", q), (2, "a", 0, "search", q), (2, "a", 0, "search", q), (None, "a", 0, "search", q), (3, None, 0, "search", q)]
    results = [(1, "a", 1, "first"), (1, "a", 2, "second"), (2, "z", 0, "loose"), (2, "a", 3, None), (None, "a", 1, "x")]
    got = sorted((str(r["conv_id"]), str(r["call_id"]), r["position"], r["status"], r["copies"]) for r in linked(spark, calls, results))
    assert got == sorted(
        [
            ("1", "a", 0, "linked", 1),
            ("1", "a", 5, "duplicate_call", 1),
            ("1", "a", 2, "duplicate_result", 1),
            ("1", "b", 1, "no_result", 1),
            ("2", "a", 0, "linked", 2),
            ("2", "z", 0, "orphan_result", 1),
            ("None", "a", 0, "no_result", 1),
            ("None", "a", 1, "orphan_result", 1),
            ("3", "None", 0, "no_result", 1),
        ]
    )
    message = next(r["message"] for r in linked(spark, calls, results) if (r["conv_id"], r["status"]) == (1, "linked"))
    assert message == '{"arguments":{"query":"x"},"id":"a","name":"search","result":"first"}'


def test_order_respects_references(spark):
    rng = random.Random(5)
    rows, parents = [], {}
    for conv in range(40):
        n = rng.randint(1, 12)
        position, order = rng.sample(range(100), n), rng.sample(range(n), n)
        for i in range(n):
            before = order[: order.index(i)]
            refs = rng.sample(before, min(len(before), rng.choice([0, 1, 1, 2])))
            if conv % 9 == 8 and i == order[0] and n > 2:
                refs = [order[1]] if order[0] in parents.get((conv, order[1]), []) else [i]
            parents[conv, i] = refs
            fields = "".join(f',"a{j}":{{"$ref":"k{p}"}}' for j, p in enumerate(refs))
            rows.append((conv, f"k{i}", position[i], "search", '{"query":"x"' + fields + "}"))
    for i in range(300):  # a long chain in reverse, and one in place
        after = f',"after":{{"$ref":"k{i - 1}"}}' if i else ""
        rows += [(900 + k, f"k{i}", (1000 - i) if k else i, "search", '{"query":"x"' + after + "}") for k in (0, 1)]
    got = {(r["conv_id"], r["call_id"]): r for r in linked(spark, rows)}
    assert len(got) == len(rows)

    def circular(c, i, seen=()):
        return i in seen or any(circular(c, p, (*seen, i)) for p in parents[c, i])

    for (c, i), refs in parents.items():
        r = got[c, f"k{i}"]
        assert (r["order_key"] is None) == circular(c, i)
        for p in refs:
            u = got[c, f"k{p}"]
            if r["order_key"] is not None:
                assert (u["order_key"], u["order_hop"], u["position"]) < (r["order_key"], r["order_hop"], r["position"])
    assert [got[901, f"k{i}"]["order_hop"] for i in range(300)] == list(range(300))
    assert [got[900, f"k{i}"]["order_key"] for i in range(300)] == list(range(300))


def test_empty_tables(spark):
    assert linked(spark, []) == []
    assert [r["status"] for r in linked(spark, [], [(1, "a", 0, "x")])] == ["orphan_result"]
    assert [r["status"] for r in linked(spark, [(1, "a", 0, "search", None)])] == ["no_result"]


def test_no_python_in_plan(spark, sf_dir):
    plan = C.op10_tool_calls(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_references_to_ids_with_escapes(spark):
    import json

    ids = ['say "hi"', "back\\slash", "line\nbreak\x01", "é/ü", "plain"]
    calls = [(1, i, 2 * n + 1, "search", '{"query": "x"}') for n, i in enumerate(ids)]
    calls += [(1, f"r{n}", 2 * n, "search", json.dumps({"query": "x", "after": {"$ref": i}})) for n, i in enumerate([*ids, 'not "known"'])]
    got = {r["call_id"]: r for r in linked(spark, calls)}
    assert [got[f"r{n}"]["errors"] for n in range(len(ids))] == [""] * len(ids)
    assert 'unknown reference not "known"' in got[f"r{len(ids)}"]["errors"]
    place = lambda r: (r["order_key"], r["order_hop"], r["position"])
    assert all(place(got[i]) < place(got[f"r{n}"]) for n, i in enumerate(ids))
