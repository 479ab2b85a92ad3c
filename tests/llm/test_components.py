import random

import pytest

from folioflow.llm import components


def brute(links):
    near = {}
    for d, a, b in links:
        near.setdefault((d, a), set()).add((d, b))
        near.setdefault((d, b), set()).add((d, a))
    out, seen = {}, set()
    for v in near:
        if v in seen:
            continue
        group, stack = {v}, [v]
        while stack:
            for n in near[stack.pop()] - group:
                group.add(n)
                stack.append(n)
        seen |= group
        for g in group:
            out[g] = min(group)[1]
    return out


def shapes(seed):
    """Paths, rings, stars, ladders, cliques and random links."""
    r = random.Random(seed)
    name = iter(f"{x:05d}" for x in r.sample(range(100000), 5000))
    links = []
    for d in ("d1", "d2"):
        for n in (2, 3, 17, 40):
            p = [next(name) for _ in range(n)]
            links += [(d, a, b) for a, b in zip(p, p[1:])]
        for n in (3, 12):
            p = [next(name) for _ in range(n)]
            links += [(d, a, b) for a, b in zip(p, p[1:] + p[:1])]
        hub, *rays = [next(name) for _ in range(9)]
        links += [(d, hub, x) for x in rays]
        k = [next(name) for _ in range(5)]
        links += [(d, a, b) for a in k for b in k if a < b]
        tail = [next(name) for _ in range(6)]
        links += [(d, k[0], tail[0]), *((d, a, b) for a, b in zip(tail, tail[1:]))]
        p = [next(name) for _ in range(60)]
        links += [(d, r.choice(p), r.choice(p)) for _ in range(70)]
    return links


@pytest.mark.parametrize("seed", range(20))
def test_solve_links_like_brute_force(seed):
    links = shapes(seed)
    want = brute([x for x in links if x[1] != x[2]])
    got = components.solve_links(((d, a), (d, b)) for d, a, b in links)
    assert {v: root[1] for v, root in got.items()} == want


@pytest.mark.parametrize("limit", [0, 60, 10_000])
def test_connect_over_the_cluster_like_brute_force(spark, limit):
    links = shapes(7)
    df = spark.createDataFrame(links, "document_id string, a string, b string")
    got = {(r.document_id, r.v): r.root for r in components.connect(df, limit).collect()}
    assert got == brute([x for x in links if x[1] != x[2]])


SCHEMA = "document_id string, block_id string, continuation_of string, continues_to string, logical_item_id string, label string"


def test_groups_over_fragments_items_and_odd_rows(spark):
    rows = [
        ("d", "blk_00000001", None, "blk_00001002", None, "x"),
        ("d", "blk_00001002", "blk_00000001", "", None, "x"),
        ("d", "blk_00001002", "blk_00000001", "", None, "y"),
        ("d", "blk_00002003", None, None, "item_1", "x"),
        ("d", "blk_00003004", None, "blk_00001002", "item_1", "x"),
        ("d", "blk_00004005", "blk_99999999", "blk_00004005", "none", "x"),
        ("d", "blk_00005006", None, None, "item_alone", "x"),
        ("e", "blk_00000001", None, None, "item_1", "x"),
        (None, "blk_00000001", None, "blk_00001002", "item_1", "x"),
        ("d", None, None, "blk_00001002", "item_1", "x"),
        ("d", "", None, "blk_00001002", "item_1", "x"),
        ("e", "a", "b", None, None, "x"),
        ("e", "b", None, None, None, "x"),
    ]
    got = {tuple(r) for r in components.block_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    first = {("d", b, "blk_00000001") for b in ("blk_00000001", "blk_00001002", "blk_00002003", "blk_00003004")}
    assert got == first | {("e", "a", "a"), ("e", "b", "a")}


@pytest.mark.parametrize("chunk", [1, 3, 10_000])
def test_hot_item_and_small_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(components, "CHUNK_ROWS", chunk)
    rows = [("d", f"blk_{i:08d}", None, None, "item_hot" if i % 3 else None, "x") for i in range(0, 9000, 100)]
    got = {r.block_id: r.group_id for r in components.block_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {b: "blk_00000100" for _, b, _, _, item, _ in rows if item}


def test_empty(spark):
    assert components.block_groups(spark.createDataFrame([], SCHEMA)).count() == 0
