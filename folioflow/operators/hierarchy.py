"""Parent-child links to full hierarchies.

Method: every fragment of the node table contracts its own parent chains to
the fragment's exits, the exits form a smaller forest that is solved the same
way, and the fragments' paths are then expanded with the solved exits.

Fragments are formed by a prefix of the node id, so that chains of neighbouring
ids stay inside one; where that no longer helps, a node and its parent are
brought together by a coin that each id throws, which shrinks any forest (and
any cycle) by an expected quarter a level. A fragment never holds more than
``CHUNK_ROWS`` rows in memory: longer ones are cut, which only adds exits.

Defined results for odd input: rows with a null scope column, or a null or
empty node id, are ignored; an empty parent is none; a parent without a row
makes its child a root; a node naming itself is a cycle; repeated rows count
once; if repeats name different parents the smallest counts; extra columns are
not looked at. An empty input gives an empty result of the same schema.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.session import stage

SEP = "\x01"
CHUNK_ROWS = 200_000
#: a quotient of at most so many nodes is solved as one fragment (a size that is counted, not assumed)
ONE_FRAGMENT_ROWS = 100_000
PREFIX_STEP = 3

_OUT = "tree string, document_id string, node string, kind string, exit string, root string, path string, n bigint"
_ARROW = pa.schema([(f, pa.int64() if f == "n" else pa.string()) for f in ("tree", "document_id", "node", "kind", "exit", "root", "path", "n")])


def contract_chunk(rows: list[tuple]) -> list[tuple]:
    """Follow parents inside one fragment.

    rows: (tree, document_id, node, parent, kind, root, path, n); kind is None for
    a live node, 'phantom' for an id without a row, or the final kind that an
    earlier level found. Result: (tree, document_id, node, kind, exit, root, path, n).
    """
    index = {row[:3]: i for i, row in enumerate(rows)}
    done: list[tuple | None] = [None] * len(rows)
    open_at: dict[int, int] = {}
    for start in range(len(rows)):
        if done[start] is not None:
            continue
        stack: list[int] = []
        open_at.clear()
        at = start
        while True:
            if done[at] is not None:
                break
            if at in open_at:
                for k in stack[open_at[at]:]:
                    row = rows[k]
                    done[k] = ("cycle", None, None, row[6], row[7])
                del stack[open_at[at]:]
                break
            tree, doc, node, parent, kind, root, path, n = rows[at]
            if kind is not None:
                done[at] = (kind, None, root, path, n)
                break
            if not parent:
                done[at] = ("root", None, root, path, n)
                break
            up = index.get((tree, doc, parent))
            if up is None:
                done[at] = ("exit", parent, root, path, n)
                break
            open_at[at] = len(stack)
            stack.append(at)
            at = up
        base = done[at]
        for k in reversed(stack):
            root, path, n = rows[k][5:]
            kind = base[0]
            if kind == "phantom":
                base = ("root", None, root, path, n)
            elif kind in ("cycle", "below_cycle"):
                base = ("below_cycle", None, None, None, 0)
            else:
                base = (kind, base[1], base[2], base[3] + SEP + path, base[4] + n)
            done[k] = base
    return [row[:3] + res for row, res in zip(rows, done)]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def flush() -> pa.RecordBatch:
        out = contract_chunk(held)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*out), _ARROW)], schema=_ARROW)

    for batch in batches:
        cols = [batch.column(k).to_pylist() for k in ("tree", "document_id", "node", "parent", "kind", "root", "path", "n")]
        held.extend(zip(*cols))
        if len(held) >= CHUNK_ROWS:
            yield flush()
    if held:
        yield flush()


def _fragment_key(level: int):
    """The column that says which fragment a node goes to at a level."""
    node, parent = F.col("node"), F.col("parent")
    if level < 2:
        cut = PREFIX_STEP * (level + 1)
        return F.expr(f"substring(node, 1, greatest(length(node) - {cut}, 0))")
    tail = lambda c: F.pmod(F.xxhash64(F.lit(level), c), F.lit(2)) == 0
    return F.when(tail(node) & parent.isNotNull() & ~tail(parent), parent).otherwise(node)


def node_table(links: DataFrame) -> DataFrame:
    """One row per id of the links, those without a row of their own as phantoms.

    links(tree, document_id, node, parent, present): present tells that the row
    comes from a row of the node, and not from one that only names it.
    """
    clean = links.filter("tree is not null and document_id is not null and node is not null and node <> ''").withColumn("parent", F.expr("nullif(parent, '')"))
    named = clean.filter("parent is not null").select("tree", "document_id", F.col("parent").alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(False).alias("present"), F.lit(True).alias("named"))
    both = clean.select("tree", "document_id", "node", "parent", "present", F.lit(False).alias("named")).unionByName(named)
    # a partial sum first, so that a parent with very many children is one row a task, then the fragments
    grouped = both.groupBy("tree", "document_id", "node").agg(F.min("parent").alias("parent"), F.max("present").alias("present"), F.max("named").alias("named"))
    grouped = grouped.filter("parent is not null or named").withColumn("part", _fragment_key(0))
    return grouped.repartition("tree", "document_id", "part")


def _level(nodes: DataFrame, level: int, single: bool) -> DataFrame:
    if level:
        nodes = nodes.withColumn("part", _fragment_key(level))
        nodes = nodes.repartition(1) if single else nodes.repartition("tree", "document_id", "part")
    if not single:
        nodes = nodes.sortWithinPartitions("tree", "document_id", "part")
    cols = nodes.select("tree", "document_id", "node", "parent", "kind", "root", "path", "n")
    return stage(cols.mapInArrow(_contract, _OUT), "forest")


def _solve(nodes: DataFrame, one_fragment_rows: int, level: int = 0, single: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """Final kind of each node, and the paths whose every id lies on a cycle."""
    local = _level(nodes, level, single)
    exits = local.filter("kind = 'exit'").select("tree", "document_id", F.col("exit").alias("node")).distinct()
    found = stage(exits, "exits")
    open_rows = found.count()
    on_cycle = local.filter("kind = 'cycle'").select("tree", "document_id", "path") if level else None
    if not open_rows:
        return local, on_cycle
    # both sides grow with the data, so neither is broadcast
    quotient = local.join(found.hint("merge"), ["tree", "document_id", "node"]).select(
        "tree", "document_id", "node", F.col("exit").alias("parent"),
        F.when(F.col("kind") != "exit", F.col("kind")).alias("kind"), "root", "path", "n",
    )
    solved, cycles = _solve(quotient, one_fragment_rows, level + 1, open_rows <= one_fragment_rows)
    up = solved.select(
        "tree", "document_id", F.col("node").alias("exit"), F.col("kind").alias("u_kind"), F.col("root").alias("u_root"), F.col("path").alias("u_path"), F.col("n").alias("u_n"),
    )
    joined = local.join(up.hint("merge"), ["tree", "document_id", "exit"], "left")
    whole = (F.col("kind") == "exit") & (F.col("u_kind") == "root")
    alone = (F.col("kind") == "exit") & (F.col("u_kind") == "phantom")
    lost = (F.col("kind") == "exit") & F.col("u_kind").isin("cycle", "below_cycle")
    out = joined.select(
        "tree", "document_id", "node",
        F.when(whole | alone, "root").when(lost, "below_cycle").otherwise(F.col("kind")).alias("kind"),
        F.lit(None).cast("string").alias("exit"),
        F.when(whole, F.col("u_root")).otherwise(F.col("root")).alias("root"),
        F.when(whole, F.concat_ws(SEP, "u_path", "path")).otherwise(F.col("path")).alias("path"),
        F.when(whole, F.col("u_n") + F.col("n")).otherwise(F.col("n")).alias("n"),
    )
    if on_cycle is not None:
        cycles = cycles.unionByName(on_cycle) if cycles is not None else on_cycle
    return out, cycles


def resolve(nodes: DataFrame, keep_path: bool = False, one_fragment_rows: int | None = None) -> DataFrame:
    """tree, document_id, node_id, tree_state, root_id, depth and id_path of each node with a row.

    nodes as node_table() gives them. keep_path adds the path with its ids apart
    from each other, whatever characters they have.
    """
    ready = nodes.select(
        "tree", "document_id", "part", "node", "parent", F.when(~F.col("present"), F.lit("phantom")).alias("kind"),
        F.col("node").alias("root"), F.col("node").alias("path"), F.lit(1).cast("bigint").alias("n"),
    )
    solved, cycles = _solve(ready, ONE_FRAGMENT_ROWS if one_fragment_rows is None else one_fragment_rows)
    solved = solved.filter("kind <> 'phantom'")
    if cycles is not None:
        on = cycles.select("tree", "document_id", F.explode(F.split("path", SEP)).alias("node"), F.lit(True).alias("on_cycle")).distinct()
        solved = solved.join(on, ["tree", "document_id", "node"], "left").withColumn("kind", F.when(F.col("on_cycle"), "cycle").otherwise(F.col("kind")))
    is_tree = F.col("kind") == "root"
    return solved.select(
        "tree", "document_id", F.col("node").alias("node_id"),
        F.when(is_tree, "tree").otherwise(F.col("kind")).alias("tree_state"),
        F.when(is_tree, F.col("root")).otherwise("").alias("root_id"),
        F.when(is_tree, F.col("n") - 1).otherwise(-1).cast("int").alias("depth"),
        F.when(is_tree, F.translate("path", SEP, "/")).otherwise("").alias("id_path"), *([F.when(is_tree, F.col("path")).alias("path")] if keep_path else []),
    )


def part_of_links(blocks: DataFrame) -> DataFrame:
    """Links of blocks to the block that holds them; any delivery of a block, deleted or not, is a row."""
    return blocks.select(F.lit("part_of").alias("tree"), "document_id", F.col("block_id").alias("node"), F.col("part_of_id").alias("parent"), F.lit(True).alias("present"))


def child_list_links(hierarchy: DataFrame) -> DataFrame:
    """Links of nodes to the node that lists them; listed ids without a row are dropped, as are nodes left alone."""
    rows = hierarchy.select("document_id", F.col("node_id").alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(True).alias("present"))
    listed = hierarchy.filter("node_id <> ''").select("document_id", F.explode("children").alias("node"), F.col("node_id").alias("parent"), F.lit(False).alias("present"))
    known = rows.unionByName(listed).filter("document_id is not null and node <> ''").groupBy("document_id", "node").agg(F.min("parent").alias("parent"), F.max("present").alias("present")).filter("present")
    return known.select(F.lit("hierarchy").alias("tree"), "document_id", "node", "parent", "present")


def hierarchies(blocks: DataFrame, hierarchy: DataFrame, keep_path: bool = False, one_fragment_rows: int | None = None) -> DataFrame:
    """Both kinds of trees, solved together."""
    return resolve(node_table(part_of_links(blocks).unionByName(child_list_links(hierarchy))), keep_path, one_fragment_rows)


def _paths(resolved: DataFrame) -> DataFrame:
    path = F.col("path") if "path" in resolved.columns else F.translate("id_path", "/", SEP)
    return resolved.filter("tree_state = 'tree'").select("tree", "document_id", "node_id", "depth", path.alias("path"))


def descendants(resolved: DataFrame) -> DataFrame:
    """Every (ancestor, node) pair of the trees, the node itself left out: all descendants of each node.

    The rows are as many as the depths of all nodes together; descendant_counts()
    does not make them.
    """
    ids = _paths(resolved).filter("depth > 0").select("tree", "document_id", "node_id", "depth", F.posexplode(F.split("path", SEP)).alias("at", "ancestor_id"))
    return ids.filter("at < depth").select("tree", "document_id", "ancestor_id", F.col("node_id").alias("descendant_id"), (F.col("depth") - F.col("at")).alias("distance"))


_COUNTS = "tree string, document_id string, node_id string, n bigint, deepest int"
_COUNTS_ARROW = pa.schema([("tree", pa.string()), ("document_id", pa.string()), ("node_id", pa.string()), ("n", pa.int64()), ("deepest", pa.int32())])


def count_below(rows: Iterable[tuple[str, str, str]]) -> Iterator[tuple[str, str, str, int, int]]:
    """(tree, document, node, descendants, greatest distance) as far as these (tree, document, path) rows show.

    Rows come in the order of their paths, so only the ids of one path are open at
    a time. An id whose subtree goes on in other rows comes again there.
    """
    here: tuple | None = None
    stack: list[list] = []  # id, rows below, deepest depth below

    def close(to: int) -> Iterator[tuple]:
        while len(stack) > to:
            node, n, deepest = stack.pop()
            if n:
                yield (*here, node, n, deepest - len(stack))
                if stack:
                    stack[-1][1] += n
                    stack[-1][2] = max(stack[-1][2], deepest)

    for tree, document, path in rows:
        ids = path.split(SEP)
        if (tree, document) != here:
            yield from close(0)
            here = (tree, document)
        same = 0
        while same < min(len(stack), len(ids)) and stack[same][0] == ids[same]:
            same += 1
        yield from close(same)
        stack.extend([node, 0, 0] for node in ids[same:])
        if len(ids) > 1:
            stack[-2][1] += 1
            stack[-2][2] = max(stack[-2][2], len(ids) - 1)
    if here:
        yield from close(0)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("tree", "document_id", "path"))))
    held: list[tuple] = []
    for row in count_below(rows):
        held.append(row)
        if len(held) >= 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _COUNTS_ARROW)], schema=_COUNTS_ARROW)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _COUNTS_ARROW)], schema=_COUNTS_ARROW)


def descendant_counts(resolved: DataFrame) -> DataFrame:
    """Number of descendants, and greatest distance to one, of each node of the trees that has any.

    Paths are sorted over the cluster, so a subtree lies in one stretch; every task
    sums its stretch from the leaves up and gives one row a node, and for the nodes
    above its first row. These few are added up.
    """
    paths = _paths(resolved).select("tree", "document_id", "path")
    ordered = paths.repartitionByRange("tree", "document_id", "path").sortWithinPartitions("tree", "document_id", "path")
    parts = ordered.mapInArrow(_count, _COUNTS)
    return parts.groupBy("tree", "document_id", "node_id").agg(F.sum("n").alias("n_descendants"), F.max("deepest").cast("int").alias("height"))
