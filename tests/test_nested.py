import json
import random

import pytest

from folioflow.operators import nested as N


def brute(questions, parent=""):
    out = []
    for q in questions:
        out.append(("question", q["id"], parent))
        out += [("escalation", f"{q['id']}/{i}", q["id"]) for i, e in enumerate((q.get("validation") or {}).get("escalations") or [], 1) if e]
        out += brute(q.get("sub_questions") or [], q["id"])
    return out


def random_tree(r, count, depth=0):
    out = []
    for _ in range(r.randint(0, 3) if depth else 3):
        count[0] += 1
        q = {"id": f"Q_{count[0]:04d}", "question_text": "t"}
        if r.random() < 0.5:
            q["validation"] = {"escalations": [{"kind": "k", "attempt": i} if r.random() < 0.8 else None for i in range(r.randint(0, 3))]}
        if depth < 5:
            q["sub_questions"] = random_tree(r, count, depth + 1)
        out.append(q)
    return out


def rows(document):
    return sorted(r[:1] + r[2:4] for r in N.visit("d", document))


@pytest.mark.parametrize("seed", range(15))
def test_visitor_like_recursion(seed):
    tree = random_tree(random.Random(seed), [0])
    assert rows({"questions": tree}) == sorted(brute(tree))


def test_any_depth():
    q = {"id": "q0"}
    for i in range(1, 5000):
        q = {"id": f"q{i}", "sub_questions": [q]}
    assert len(list(N.visit("d", {"questions": [q]}))) == 5000


@pytest.mark.parametrize("wrap", [
    lambda j: j, lambda j: "﻿ " + j, lambda j: f"```json\n{j}\n```", lambda j: f"Here it is:\n{j}\nDone.", lambda j: json.dumps({"document": json.loads(j)}), lambda j: json.dumps(j), lambda j: f"[{j}]", lambda j: json.dumps(json.loads(j), indent=3),
])
def test_wrapping(wrap):
    document = {"document_id": "d", "questions": [{"id": "Q1"}]}
    assert N.read_payload(wrap(json.dumps(document)))["questions"] == document["questions"]


@pytest.mark.parametrize("payload", [None, "", "  ", "```", "{", '{"questions": [{"id": "Q1"', '```json\n{"questions": [', "not json", "[]", "null", "3", '"x"'])
def test_unreadable(payload):
    assert not list(N.visit("d", N.read_payload(payload) or {}))


def test_shapes():
    esc = {"kind": "k", "attempt": 1}
    doc = {"questions": {"Q_1": {"sub_questions": json.dumps([{"id": "Q_2"}, None, {"id": 7}])}, "Q_3": {"id": "Q_3", "validation": json.dumps({"escalations": esc})}}}
    assert rows(doc) == sorted([("question", "Q_1", ""), ("question", "Q_2", "Q_1"), ("question", "7", "Q_1"), ("question", "Q_3", ""), ("escalation", "Q_3/1", "Q_3")])
    assert rows({"questions": {"id": "Q_1", "validation": {"escalations": [None, esc]}}}) == [("escalation", "Q_1/2", "Q_1"), ("question", "Q_1", "")]
    assert rows({"questions": [{"question_text": "no id"}, 5, None]}) == [("question", "#1", "")]


def test_tables(spark, tmp_path):
    doc = {"questions": [{"id": "Q1", "question_text": "t", "marks": {"value": 2}, "validation": {"escalations": [{"kind": "k", "reason": "r"}]}}]}
    data = [("d", json.dumps(doc), "x"), ("d", json.dumps(doc), "x"), (None, json.dumps(doc | {"document_id": "own"}), "x"), ("e", None, "x"), ("f", "{", "x")]
    df = spark.createDataFrame(data, "document_id string, payload string, record_key string")
    assert sorted(tuple(r) for r in N.links(N.emit(df)).collect()) == [(d, e, k, p) for d in ("d", "own") for e, k, p in (("escalation", "Q1/1", "Q1"), ("question", "Q1", ""))]
    written = N.write_tables(df, f"file://{tmp_path}/nested")
    assert sorted((r.document_id, r.marks, r.question_text) for r in written["question"].collect()) == [("d", '{"value": 2}', "t"), ("own", '{"value": 2}', "t")]
    assert {(r.parent_key, r.kind, r.reason) for r in written["escalation"].collect()} == {("Q1", "k", "r")}


def test_any_number_of_wrappings():
    doc = {"questions": [{"id": "q"}]}
    text = json.dumps(doc)
    for _ in range(8):
        text = json.dumps(text)
    assert rows(N.read_payload(text)) == [("question", "q", "")]
    inside: object = doc
    for k in range(9):
        inside = {"document": inside} if k % 3 else [{"document": json.dumps(inside)}]
    assert rows(N.read_payload(json.dumps(inside))) == [("question", "q", "")]
    nested = json.dumps([{"id": "s"}])
    for _ in range(6):
        nested = json.dumps(nested)
    assert rows({"questions": [{"id": "q", "sub_questions": nested}]}) == [("question", "q", ""), ("question", "s", "q")]
    for odd in ("[]", "[[]]", '""', '"\\"\\""', "{}", '{"document": {"document": null}}', "[1]"):
        assert N.read_payload(odd) is None


def test_one_write_for_all_tables(spark):
    doc = {"questions": [{"id": "Q1", "validation": {"escalations": [{"kind": "k"}]}}]}
    emitted = N.written(spark.createDataFrame([("d", json.dumps(doc))], "document_id string, payload string"))
    assert {r.tag for r in emitted.select("tag").collect()} == {"question", "escalation"}
    assert N.links(emitted).count() == 2 and N.flat_table(emitted, "question").count() == 1
    plan = N.flat_table(emitted, "question")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tag" in plan


def test_empty(spark):
    assert N.links(N.emit(spark.createDataFrame([], "document_id string, payload string"))).count() == 0


def test_deep_payloads_are_read():
    n = 60_000
    text = "".join('{"id": "q%d", "sub_questions": [' % i for i in range(n)) + "]}" * n
    deep = "[" * n + "1" + "]" * n
    for payload in ('{"questions": [%s]}' % text, 'Here: {"questions": [%s]} done' % text):
        assert len(list(N.visit("d", N.read_payload(payload)))) == n
    assert N.read_payload('{"questions": [%s]' % text) is None
    [row] = N.visit("d", N.read_payload('{"questions": [{"id": "q", "options": %s}]}' % deep))
    assert row[2] == "q" and len(row[-1]) == len(json.dumps({"options": deep}))


@pytest.mark.parametrize("text", ['{"a": [1, -2.5e3, true, null, {}, [], "x\\u00e9\\n"], "b": {"c": ""}}', " [ 1 , 2 ] ", '"s"', "0"])
def test_reader_without_recursion(text):
    value, end = N._read_deep(text, 0)
    assert value == json.loads(text) and not text[end:].strip()


@pytest.mark.parametrize("text", ["", "[1,]", '{"a"}', '{"a" 1}', "{1: 2}", '{"a": 1,}', "[1 2]", "[", '{"a":', "x", '"s'])
def test_reader_without_recursion_refuses(text):
    with pytest.raises(ValueError):
        N._read_deep(text, 0)
