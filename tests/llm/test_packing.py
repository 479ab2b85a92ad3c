import base64
import random
from collections import Counter

import pytest

from folioflow.llm import packing as P


@pytest.fixture(scope="module")
def tokenizer(tmp_path_factory):
    """A vocabulary of single bytes: a text has as many tokens as bytes."""
    path = tmp_path_factory.mktemp("tok") / "bytes.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(bytes([i])) + b" %d\n" % i for i in range(256)))
    return str(path)


@pytest.mark.parametrize("capacity", [7, 64, 512])
@pytest.mark.parametrize("seed", range(5))
def test_valid_and_near_the_bound(seed, capacity):
    r = random.Random(seed)
    items = [(i, 0, min(capacity, max(1, int(r.expovariate(3 / capacity))))) for i in range(4000)]
    held = P.pack(items, capacity)
    assert sorted(i for h in held for i in h) == items
    docs = max(1, capacity // P.TOKENS_A_DOC)
    assert all(sum(i[2] for i in h) <= capacity and len(h) <= docs and sum(i[2] ** 2 for i in h) <= capacity**2 for h in held)
    if capacity == 512:
        assert len(held) <= 1.01 * sum(i[2] for i in items) / capacity + 1


def test_ties_zero_and_full_items():
    held = P.pack([(i, 0, s) for i, s in enumerate([0, 0, 10, 10, 5, 5, 5, 5])], 10)
    assert sorted(sum(i[2] for i in h) for h in held) == [0, 0, 5, 5, 5, 5, 10, 10] or sum(sum(i[2] for i in h) for h in held) == 40
    assert P.pack([], 10) == []


def one_dimension(items, capacity):
    """Best fit by tokens alone."""
    bins: list[list] = []
    for i in sorted(items, key=lambda i: -i[2]):
        fits = [b for b in bins if sum(x[2] for x in b) + i[2] <= capacity]
        if fits:
            max(fits, key=lambda b: sum(x[2] for x in b)).append(i)
        else:
            bins.append([i])
    return bins


def cost(held):
    return sum(i[2] ** 2 for i in held)


@pytest.mark.parametrize("seed", range(4))
def test_every_capacity_binds(seed):
    r = random.Random(seed)
    items = [(i, 0, r.choice([1, 2, 3, 5, 8, 13, 21, 34, 55, 90])) for i in range(400)]
    most_docs, most_cost = 6, 5000
    plain = one_dimension(items, 100)
    assert any(cost(b) > most_cost and len(b) > 1 for b in plain) and any(len(b) > most_docs for b in plain)
    held = P.pack(items, 100, most_docs, most_cost)
    assert sorted(i for h in held for i in h) == sorted(items)
    for h in held:
        assert sum(i[2] for i in h) <= 100 and len(h) <= most_docs and (cost(h) <= most_cost or len(h) == 1)
    # a lower bound by each capacity; what costs more than a container alone is one by itself
    alone = sum(i[2] ** 2 > most_cost for i in items)
    rest = [i for i in items if i[2] ** 2 <= most_cost]
    assert len(held) <= alone + 1.25 * max(sum(i[2] for i in rest) / 100, len(rest) / most_docs, cost(rest) / most_cost) + 2


def test_the_shortest_residual_of_all_containers_is_chosen():
    r = random.Random(9)
    for _ in range(60):
        b = P.Containers(60, 5, 1500)
        for i in range(120):
            size = r.randint(1, 40)
            fit = [k for k in range(len(b.tokens)) if b.tokens[k] + size <= 60 and b.docs[k] < 5 and b.cost[k] + size * size <= 1500 and b.tokens[k] < 60]
            chosen = b.choose(size)
            assert (chosen is None) == (not fit)
            assert chosen is None or b.residual(chosen, size) == min(b.residual(k, size) for k in fit)
            b.add((i, 0, size))


def test_all_residuals_weigh():
    """A container with a little more room of tokens is taken where its attention and documents would be left unused otherwise."""
    b = P.Containers(100, 10, 10_000)
    for held in ([80], [26, 26, 26]):
        b.n_open = 0  # each opens one of its own
        for i, size in enumerate(held):
            b.add((i, 0, size))
    b.n_open = 0
    for bin_ in (0, 1):  # 20 and 22 tokens of room; 3600 and 7972 of attention
        b.open[:, bin_] = 100 - b.tokens[bin_], 10_000 - b.cost[bin_], 10 - b.docs[bin_], bin_
    b.n_open = 2
    norm = lambda *shares: sum(w * x * x for w, x in zip(b.weights, shares))
    for bin_, shares in ((0, (0.1, 0.35, 0.8)), (1, (0.12, 0.7872, 0.6))):
        assert b.residual(bin_, 10) == pytest.approx(norm(*shares))
    assert b.choose(10) == 0
    b.weights = (1.0, 0.01, 1.0)
    assert b.residual(1, 10) < b.residual(0, 10) and b.choose(10) == 1


def test_what_is_scarce_weighs_more():
    items = [(i, 0, 10) for i in range(100)]
    assert P.demand(items, 100, 100, 10_000) == pytest.approx((10 / 12, 1 / 12, 1 / 12))
    assert P.demand(items, 100, 5, 1_000)[2] == pytest.approx(20 / 40) and P.demand([], 10, 1, 100) == (0, 0, 0)


def test_capacity_beyond_a_list_of_rooms():
    assert P.pack([(1, 0, 10**9), (2, 0, 5)], 10**10) == [[(1, 0, 10**9), (2, 0, 5)]]


DOCS = "doc_id bigint, text string, n_tokens string"
BUDGETS = "budget_id int, capacity_tokens int, doc_id string"


@pytest.mark.parametrize("group", [3, 100_000])
def test_every_text_is_placed(spark, tokenizer, monkeypatch, group):
    monkeypatch.setattr(P, "GROUP_DOCS", group)
    r = random.Random(1)
    sizes = {i: r.choice([1, 3, 8, 9, 16, 20, 33]) for i in range(1, 25)} | {50: 0, 51: 2000}
    docs = [(i, "x" * n, "a") for i, n in sizes.items()] + [(60, None, "a"), (None, "xx", "a"), (1, "x" * sizes[1], "a")]
    budgets = [(1, 8, "b"), (2, 16, "b"), (2, 16, "b"), (3, None, "b"), (4, 0, "b"), (None, 5, "b")]
    rows = P.packed(spark.createDataFrame(docs, DOCS), spark.createDataFrame(budgets, BUDGETS), tokenizer).collect()
    for budget, capacity in ((1, 8), (2, 16)):
        own = [x for x in rows if x.budget_id == budget]
        assert len({(x.doc_id, x.piece) for x in own}) == len(own)
        for doc, n in sizes.items():
            pieces = sorted((x.piece, x.start_token, x.n_tokens) for x in own if x.doc_id == doc)
            assert sum(p[2] for p in pieces) == n and len(pieces) == max(1, -(-n // capacity))
            assert [p[1] for p in pieces] == [k * capacity for k in range(len(pieces))]
        filled = Counter()
        for x in own:
            filled[x.container] += x.n_tokens
        assert max(filled.values()) <= capacity
    assert {x.doc_id for x in rows} == set(sizes)
    report = {x.budget_id: x for x in P.fill_report(spark.createDataFrame(rows), spark.createDataFrame(budgets, BUDGETS)).collect()}
    assert report[1].n_tokens == sum(sizes.values()) and 0 <= report[1].unused_share < 0.35


def test_capacities_of_the_budgets_and_validity(spark, tokenizer):
    r = random.Random(4)
    df = spark.createDataFrame([(i, "x" * r.randint(1, 30), "a") for i in range(300)], DOCS)
    budgets = spark.createDataFrame([(1, 40, 4, 800), (2, 40, 40, None)], "budget_id int, capacity_tokens int, capacity_docs int, capacity_attention bigint")
    rows = spark.createDataFrame(P.packed(df, budgets, tokenizer).collect())
    for x in P.validity(rows, budgets).collect():
        assert (x.n_texts, x.n_twice, x.n_badly_cut, x.n_over_tokens, x.n_over_docs, x.n_over_attention) == (300, 0, 0, 0, 0, 0)
    report = {x.budget_id: x for x in P.fill_report(rows, budgets).collect()}
    assert report[2].unused_attention is None and report[1].n_containers > report[2].n_containers and 0 <= report[1].unused_docs < 1
    broken = rows.unionByName(rows.filter("budget_id = 1 and doc_id < 20").withColumn("container", rows.container * 0))
    bad = {x.budget_id: x for x in P.validity(broken, budgets).collect()}
    assert bad[1].n_twice == 20 and bad[1].n_over_tokens >= 1 and bad[2].n_twice == 0


def test_empty(spark, tokenizer):
    docs, budgets = spark.createDataFrame([], DOCS), spark.createDataFrame([], BUDGETS)
    assert P.packed(docs, budgets, tokenizer).count() == 0
    assert P.packed(docs, spark.createDataFrame([(1, 8, "b")], BUDGETS), tokenizer).count() == 0
    assert P.packed(docs, budgets, tokenizer).columns == ["budget_id", "doc_id", "piece", "container", "start_token", "n_tokens"]
