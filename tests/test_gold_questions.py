"""Stored questions matched with built ones: results by brute force, without a table of all pairs."""

import random
import re
from collections import Counter

import pytest

from folioflow.operators import evaluate
from folioflow.plans import answers
from tests.test_mini_chapter import folder  # noqa: F401

WORDS = ["the", "the", "the", "of", "a", "why", "heat", "Light", "ray", "ion", "acid", "İon"]


def made(seed=3, documents=3, n=40):
    """Golds and found questions of a few documents with repeated words, blank and null texts, and ties."""
    r = random.Random(seed)
    text = lambda: r.choice([None, "", "?!", *(" ".join(r.choices(WORDS, k=r.randint(1, 9))) for _ in range(9))])
    gold = [(f"d{d}", f"{r.randint(0, 30):010d} g{i}", f"g{i}", text()) for d in range(documents) for i in range(n)]
    got = [(f"d{d}", f"p{i}", text()) for d in range(1, documents + 1) for i in range(n + 5)]
    return [*gold, (None, "1", "g", "ray")], [*got, (None, "p", "ray"), ("d1", None, "ray")]


def scores(gold, got):
    """Scores of all pairs of a document that agree enough."""
    bag = lambda t: Counter(re.findall("[a-z0-9]+", (t or "").lower()))
    out = {}
    for d, ix, g, text in gold:
        a = bag(text)
        for e, p, other in got:
            if d == e and d and p and a and (s := sum((a & bag(other)).values()) / sum(a.values())) >= evaluate.MATCH:
                out[d, ix, g, p] = s
    return out


def frames(spark, gold, got):
    return spark.createDataFrame(gold, "document_id string, gold_ix string, gold_id string, gold_text string"), spark.createDataFrame(got, "document_id string, got_id string, got_text string")


def test_matches_are_those_of_all_pairs_in_order(spark):
    gold, got = made()
    want, done, used = [], set(), set()
    for (d, _, g, p), s in sorted(scores(gold, got).items(), key=lambda x: (x[0][0], x[0][1], -x[1], x[0][3])):
        if (d, g) not in done and (d, p) not in used:
            done.add((d, g))
            used.add((d, p))
            want.append((d, g, p, s))
    found = evaluate.question_matches(*frames(spark, gold, got))
    assert want and sorted(map(tuple, found.collect())) == sorted(want)
    none = frames(spark, [], [])
    assert evaluate.question_matches(*none).count() == 0 and found.columns == ["document_id", "gold_id", "got_id", "score"]


def no_pairs(*_):
    raise AssertionError("pairs are as many as the product of a document's questions")


def test_matching_makes_no_table_of_pairs(spark, folder, monkeypatch):  # noqa: F811
    gold, got = answers.gold_and_got(spark, folder)
    want = sorted(map(tuple, evaluate.greedy_in_documents(answers.gold_pairs_of(gold, got), evaluate.MATCH).collect()))
    monkeypatch.setattr(evaluate, "question_pairs", no_pairs)
    assert want and sorted(map(tuple, answers.q_gold_matches(spark, folder).collect())) == want


def test_metrics_make_no_table_of_pairs(spark, folder, monkeypatch):  # noqa: F811
    gold, got = answers.gold_and_got(spark, folder)
    matches = evaluate.greedy_in_documents(answers.gold_pairs_of(gold, got), evaluate.MATCH)
    [want] = evaluate.gold_metrics(matches, gold.drop("gold_ix", "gold_text"), got.drop("got_text")).collect()
    monkeypatch.setattr(evaluate, "question_pairs", no_pairs)
    [row] = answers.q_gold_metrics(spark, folder).collect()
    assert want.n_matched > 0 and row.asDict() == pytest.approx(want.asDict())


@pytest.mark.parametrize("golds, rows", [(1_000, 50_000), (7, 10)])
def test_pairs_by_brute_force(spark, monkeypatch, golds, rows):
    monkeypatch.setattr(evaluate, "PAIR_GOLDS", golds)
    monkeypatch.setattr(evaluate, "PAIR_ROWS", rows)
    gold, got = made(seed=5)
    want = sorted((*k, s) for k, s in scores(gold, got).items())
    pairs = evaluate.question_pairs(*frames(spark, gold, got))
    assert want and sorted(map(tuple, pairs.collect())) == want and pairs.columns == ["document_id", "gold_ix", "gold_id", "got_id", "score"]


def test_no_row_per_token_of_a_pair(spark):
    """Where each gold shares common words with each found question, a join of their tokens has a row for each of them."""
    gold, got = frames(spark, [("d", f"{i:04d}", f"g{i}", f"the ray of light is w{i}") for i in range(50)], [("d", f"p{i}", f"the ray of light is v{i}") for i in range(60)])
    pairs = evaluate.question_pairs(gold, got)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert pairs.count() == 3_000 and "token" not in plan and plan.count("Join") == 2
