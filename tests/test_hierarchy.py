import random

import pytest

from folioflow.operators import hierarchy as H

BLOCKS = "document_id string, block_id string, part_of_id string, tree string, node string"
NODES = "document_id string, node_id string, children array<string>, kind string"


def brute(parents, rows):
    """State, root, depth and path of every linked node, by walking up."""
    named = set(parents.values())
    out = {}
    for node in rows:
        if node not in parents and node not in named:
            continue
        path, at = [node], node
        while True:
            up = parents.get(at)
            if up is None or up not in rows:
                out[node] = ("tree", path[-1], len(path) - 1, "/".join(reversed(path)))
                break
            if up in path:
                out[node] = ("cycle" if up == node else "below_cycle", "", -1, "")
                break
            path.append(up)
            at = up
    return out


def found(df):
    return {r.node_id: (r.tree_state, r.root_id, r.depth, r.id_path) for r in df.collect()}


def random_forest(seed, n=300):
    r = random.Random(seed)
    ids = [f"blk_{i:08d}" for i in sorted(r.sample(range(5000), n))]
    parents = {}
    for k, node in enumerate(ids):
        x = r.random()
        if x < 0.75 and k:
            parents[node] = ids[max(0, k - r.randint(1, 6))]
        elif x < 0.8:
            parents[node] = r.choice(ids)
        elif x < 0.84:
            parents[node] = "blk_99999999"
    return ids, parents


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("chunk", [7, 10_000])
def test_contract_chunk_is_exact_in_one_fragment(seed, chunk):
    ids, parents = random_forest(seed)
    rows = [("t", "d", n, parents.get(n), None, n, n, 1) for n in ids] + [("t", "d", "blk_99999999", None, "phantom", "blk_99999999", "blk_99999999", 1)]
    got = {r[2]: r for r in H.contract_chunk(rows)}
    want = brute(parents, set(ids))
    for node, (state, root, depth, path) in want.items():
        kind = {"tree": "root"}.get(state, state)
        assert got[node][3] == kind
        if state == "tree":
            assert (got[node][5], got[node][7] - 1, got[node][6].replace(H.SEP, "/")) == (root, depth, path)


@pytest.mark.parametrize(("chunk", "single"), [(5, 0), (5, 10), (10_000, 0), (10_000, 100_000)])
def test_resolve_over_fragments_like_walking_up(spark, monkeypatch, chunk, single):
    monkeypatch.setattr(H, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(H, "ONE_FRAGMENT_ROWS", single)
    ids, parents = random_forest(3)
    big = [f"blk_{i:08d}" for i in range(10_000, 16_000, 700)]  # a ring over many fragments, with tails
    parents |= dict(zip(big, big[1:] + big[:1])) | {"blk_00009000": big[0], "blk_00008000": "blk_00009000"}
    ids += [*big, "blk_00009000", "blk_00008000"]
    df = spark.createDataFrame([("d", n, parents.get(n), "x", "y") for n in ids], BLOCKS)
    assert found(H.resolve(H.node_table(H.part_of_links(df)))) == brute(parents, set(ids))


def test_long_chain(spark):
    ids = [f"{i:06d}" for i in range(3000)]
    df = spark.createDataFrame([("d", n, p, "x", "y") for n, p in zip(ids, [None, *ids])], BLOCKS)
    got = found(H.resolve(H.node_table(H.part_of_links(df))))
    assert got["002999"][2] == 2999 and got["002999"][1] == "000000" and got["002999"][3].count("/") == 2999


def test_odd_rows(spark):
    rows = [
        ("d", "a", "", "x", "y"), ("d", "b", "a", "x", "y"), ("d", "b", "a", "x", "y"), ("d", "c", "c", "x", "y"), ("d", "e", "nowhere", "x", "y"), ("d", "f", None, "x", "y"),
        (None, "g", "a", "x", "y"), ("d", None, "a", "x", "y"), ("d", "", "f2", "x", "y"), ("e", "b", "a", "x", "y"), ("d", "h", "c", "x", "y"),
    ]
    got = [tuple(r) for r in H.resolve(H.node_table(H.part_of_links(spark.createDataFrame(rows, BLOCKS)))).collect()]
    assert sorted(got) == [
        ("part_of", "d", "a", "tree", "a", 0, "a"), ("part_of", "d", "b", "tree", "a", 1, "a/b"), ("part_of", "d", "c", "cycle", "", -1, ""),
        ("part_of", "d", "e", "tree", "e", 0, "e"), ("part_of", "d", "h", "below_cycle", "", -1, ""), ("part_of", "e", "b", "tree", "b", 0, "b"),
    ]


def test_child_lists_and_descendants(spark):
    nodes = [("d", "r", ["b", "a", "a", None, "", "gone"], "x"), ("d", "a", ["c"], "x"), ("d", "b", None, "x"), ("d", "c", [], "x"), ("d", "alone", ["gone"], "x"), ("d", "self", ["self"], "x")]
    solved = H.hierarchies(spark.createDataFrame([], BLOCKS), spark.createDataFrame(nodes, NODES))
    assert found(solved) == {"r": ("tree", "r", 0, "r"), "a": ("tree", "r", 1, "r/a"), "b": ("tree", "r", 1, "r/b"), "c": ("tree", "r", 2, "r/a/c"), "self": ("cycle", "", -1, "")}
    assert {(r.ancestor_id, r.descendant_id, r.distance) for r in H.descendants(solved).collect()} == {("r", "a", 1), ("r", "b", 1), ("r", "c", 2), ("a", "c", 1)}
    assert {(r.node_id, r.n_descendants, r.height) for r in H.descendant_counts(solved).collect()} == {("r", 3, 2), ("a", 1, 1)}


@pytest.mark.parametrize("parts", [1, 3, 9])
def test_counts_add_up_over_stretches(parts):
    r = random.Random(parts)
    ids, parents = random_forest(8, 500)
    want = brute(parents, set(ids))
    paths = sorted(p.replace("/", H.SEP) for state, _, _, p in want.values() if state == "tree")
    cuts = sorted(r.sample(range(1, len(paths)), parts - 1))
    got: dict = {}
    for a, b in zip([0, *cuts], [*cuts, len(paths)]):
        for _, _, node, n, deepest in H.count_below(("t", "d", p) for p in paths[a:b]):
            old = got.get(node, (0, 0))
            got[node] = (old[0] + n, max(old[1], deepest))
    brute_counts: dict = {}
    for p in paths:
        up = p.split(H.SEP)
        for k, node in enumerate(up[:-1]):
            old = brute_counts.get(node, (0, 0))
            brute_counts[node] = (old[0] + 1, max(old[1], len(up) - 1 - k))
    assert got == brute_counts


def test_ids_with_slashes(spark):
    rows = [("d", "a", None, "x", "y"), ("d", "a/b", "a", "x", "y"), ("d", "c", "a/b", "x", "y")]
    links = H.node_table(H.part_of_links(spark.createDataFrame(rows, BLOCKS)))
    solved = H.resolve(links, keep_path=True)
    assert {(r.ancestor_id, r.descendant_id) for r in H.descendants(solved).collect()} == {("a", "a/b"), ("a", "c"), ("a/b", "c")}
    assert {(r.node_id, r.n_descendants, r.height) for r in H.descendant_counts(solved).collect()} == {("a", 2, 2), ("a/b", 1, 1)}


def test_empty(spark):
    assert H.hierarchies(spark.createDataFrame([], BLOCKS), spark.createDataFrame([], NODES)).count() == 0


def test_descendants_are_a_query(spark, tmp_path):
    from folioflow.plans import records

    spark.createDataFrame([("d", "a", None), ("d", "b", "a"), ("d", "c", "b")], "document_id string, block_id string, part_of_id string").write.parquet(f"{tmp_path}/blocks.parquet")
    spark.createDataFrame([("d", "x", ["y"]), ("d", "y", None)], "document_id string, node_id string, children array<string>").write.parquet(f"{tmp_path}/hierarchy.parquet")
    got = sorted(tuple(r) for r in records.QUERIES["p1_descendants"](spark, str(tmp_path)).collect())
    assert got == [("hierarchy", "d", "x", "y", 1), ("part_of", "d", "a", "b", 1), ("part_of", "d", "a", "c", 2), ("part_of", "d", "b", "c", 1)]
