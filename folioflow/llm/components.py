"""Consolidating pairwise matches into groups.

Method: vertices of degree one are stripped again and again, chains of vertices
of degree two are compressed (by list ranking, where the chain lies over many
tasks), the reduced core is solved, and the removed vertices get their labels
back in reverse order.

It is done twice. First every fragment (the blocks of a document whose ids have
a common prefix) reduces and solves the links inside it, which leaves one label
for each local component; a fragment holds a bounded number of ids, however
large its document is. Then the links between labels are reduced by joins over the
whole cluster, however few they are. A shared item connects, per fragment, one label only,
and across fragments the smallest label of the item, so an item with a third of
all rows makes no more links than there are fragments.

Defined results for odd input: rows with a null document or a null or empty
block id are ignored; null and '' are no link, nor is a link to the block
itself or to a block without a row; the item ids in ``NO_ITEM`` are none;
repeated rows count once; a block in no group of two is left out; extra columns
are not looked at. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.session import stage

NO_ITEM = ("", "none", "item_00000000")
CHUNK_ROWS = 200_000
#: a caller may let so many links between labels (counted, not assumed) be solved in one task; by default none are
ONE_TASK_LINKS = 0
#: a round that removes a smaller share of the links than this has reached the core
LEAST_SHRINK = 0.1


def solve_links(links: Iterable[tuple]) -> dict:
    """Smallest connected vertex of every vertex of the links: strip, compress, solve the core, restore."""
    near: dict[object, set] = {}
    for a, b in links:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    removed: list[tuple] = []
    work = [v for v, n in near.items() if len(n) <= 2]
    while work:
        v = work.pop()
        around = near.get(v)
        if around is None or not 1 <= len(around) <= 2:
            continue
        del near[v]
        first, *second = around
        removed.append((v, first))
        near[first].discard(v)
        if second:
            other = second[0]
            near[other].discard(v)
            near[first].add(other)
            near[other].add(first)
            work.append(other)
        work.append(first)
    label: dict[object, object] = {}
    for start in near:
        if start in label:
            continue
        label[start] = start
        stack = [start]
        while stack:
            for n in near[stack.pop()]:
                if n not in label:
                    label[n] = start
                    stack.append(n)
    for v, to in reversed(removed):
        label[v] = label[to]
    least: dict[object, object] = {}
    for v, core in label.items():
        if core not in least or v < least[core]:
            least[core] = v
    return {v: least[core] for v, core in label.items()}


_LOCAL = "kind string, document_id string, id string, label string, n bigint"
_LOCAL_ARROW = pa.schema([("kind", pa.string()), ("document_id", pa.string()), ("id", pa.string()), ("label", pa.string()), ("n", pa.int64())])


def solve_fragment(rows: list[tuple]) -> list[tuple]:
    """Local labels ('v'), links that leave the fragment ('e') and items ('i') of (document, block, links, item) rows."""
    here = {(d, b) for d, b, _, _ in rows}
    links: list[tuple] = []
    away: set[tuple] = set()
    item_of: dict[tuple, tuple] = {}
    items: list[tuple] = []
    for d, b, ends, item in rows:
        for o in ends or ():
            if o and o != b:
                if (d, o) in here:
                    links.append(((d, b), (d, o)))
                else:
                    away.add((d, b, o))
        if item is not None:
            first = item_of.setdefault((d, item), (d, b))
            if first == (d, b):
                items.append((d, item, b))
            else:
                links.append((first, (d, b)))
    label = solve_links(links)
    size: dict[tuple, int] = {}
    for v in here:
        top = label.get(v, v)
        size[top] = size.get(top, 0) + 1
    out = [("v", d, b, (top := label.get((d, b), (d, b)))[1], size[top]) for d, b in here]
    out += [("e", d, o, label.get((d, b), (d, b))[1], 0) for d, b, o in away]
    out += [("i", d, item, label.get((d, b), (d, b))[1], 0) for d, item, b in items]
    return out


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*rows), schema)], schema=schema)


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    last = None
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in ("document_id", "block_id", "links", "item", "part"))):
            key = (row[0], row[4])
            if len(held) >= CHUNK_ROWS and key != last:
                yield _arrow(solve_fragment(held), _LOCAL_ARROW)
                held = []
            last = key
            held.append(row[:4])
    if held:
        yield _arrow(solve_fragment(held), _LOCAL_ARROW)


_SOLVED = "document_id string, v string, root string"
_SOLVED_ARROW = pa.schema([("document_id", pa.string()), ("v", pa.string()), ("root", pa.string())])


def _one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    links: list[tuple] = []
    for batch in batches:
        d, a, b = (batch.column(k).to_pylist() for k in ("document_id", "a", "b"))
        links.extend(zip(zip(d, a), zip(d, b)))
    solved = solve_links(links)
    if solved:
        yield _arrow([(d, v, root[1]) for (d, v), root in solved.items()], _SOLVED_ARROW)


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("document_id", F.col("a").alias("v"), F.col("b").alias("to")).unionByName(links.select("document_id", F.col("b").alias("v"), F.col("a").alias("to")))


def _ordered(links: DataFrame) -> DataFrame:
    """Distinct links with the smaller end first, without loops."""
    return links.filter("a <> b").select("document_id", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _rank_chains(degrees: DataFrame) -> DataFrame:
    """List ranking of the vertices of degree two by pointer doubling.

    An arc u->v with v of degree two goes on to v's other neighbour. Doubling
    gives each arc the vertex where its chain ends, or, on a chain that closes to
    a ring, the smallest vertex of the ring. Result: document_id, v, end_a, end_b
    (equal for a ring).
    """
    inner = degrees.filter("degree = 2").select("document_id", "v", "lo", "hi")
    # the arcs that leave a chain vertex, each with the vertex it reaches and the one after that
    arcs = inner.select("document_id", F.col("v").alias("u"), F.explode(F.array("lo", "hi")).alias("v"))
    after = inner.select("document_id", "v", F.col("lo").alias("n1"), F.col("hi").alias("n2"))
    arcs = arcs.join(after, ["document_id", "v"], "left").select(
        "document_id", "u", "v", F.when(F.col("n1").isNull(), None).when(F.col("n1") == F.col("u"), F.col("n2")).otherwise(F.col("n1")).alias("next"),
    )
    # state of an arc: the arc it points at (p_u -> p_v), whether that is the last, and the least vertex passed
    state = stage(arcs.select("document_id", "u", "v", F.when(F.col("next").isNull(), F.col("u")).otherwise(F.col("v")).alias("p_u"), F.coalesce("next", "v").alias("p_v"), F.col("next").isNull().alias("ended"), F.least("u", "v").alias("least")), "chains")
    steps = 2 * state.count()
    while steps > 1:
        steps = (steps + 1) // 2
        if not state.filter("not ended").limit(1).count():
            break
        ahead = state.select("document_id", F.col("u").alias("p_u"), F.col("v").alias("p_v"), F.col("p_u").alias("q_u"), F.col("p_v").alias("q_v"), F.col("ended").alias("q_ended"), F.col("least").alias("q_least"))
        open_arcs = state.filter("not ended").join(ahead, ["document_id", "p_u", "p_v"], "left").select(
            "document_id", "u", "v", F.coalesce("q_u", "p_u").alias("p_u"), F.coalesce("q_v", "p_v").alias("p_v"), F.coalesce("q_ended", F.lit(True)).alias("ended"), F.least("least", "q_least").alias("least"),
        )
        state = stage(state.filter("ended").unionByName(open_arcs), "chains")
    end = F.when(F.col("ended"), F.col("p_v")).otherwise(F.col("least"))
    return state.select("document_id", F.col("u").alias("v"), end.alias("end")).groupBy("document_id", "v").agg(F.min("end").alias("end_a"), F.max("end").alias("end_b"))


def _compress(degrees: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What the vertices of degree two hang on, and the links that replace their chains; of a ring the smallest vertex stays."""
    chains = stage(_rank_chains(degrees), "ranked")
    hung = chains.filter("v <> end_a").select("document_id", "v", F.col("end_a").alias("to"))
    return hung, chains.select("document_id", F.col("end_a").alias("a"), F.col("end_b").alias("b"))


def _strip(degrees: DataFrame) -> tuple[DataFrame, None]:
    """What the vertices of degree one hang on; of two that only have each other the smaller stays."""
    other = degrees.select("document_id", F.col("v").alias("lo"), F.col("degree").alias("lo_degree"))
    return degrees.filter("degree = 1").join(other, ["document_id", "lo"]).filter("lo_degree > 1 or v > lo").select("document_id", "v", F.col("lo").alias("to")), None


def _solve_core(links: DataFrame) -> DataFrame:
    """Labels of a graph without shape: every vertex hooks on its smallest neighbour, trees shrink to their root, again until no link is left."""
    maps: list[DataFrame] = []
    while True:
        links = stage(_ordered(links), "core")
        if not links.limit(1).count():
            break
        hook = _both_ways(links).groupBy("document_id", "v").agg(F.min("to").alias("to")).select("document_id", "v", F.least("v", "to").alias("root"))
        hook = stage(hook, "hooks")
        while True:
            up = hook.select("document_id", F.col("v").alias("root"), F.col("root").alias("top"))
            jumped = stage(hook.join(up, ["document_id", "root"], "left").select("document_id", "v", F.col("root").alias("was"), F.coalesce("top", "root").alias("root")), "hooks")
            hook = jumped.drop("was")
            if not jumped.filter("was <> root").limit(1).count():
                break
        maps.append(hook)
        at = lambda end: hook.select("document_id", F.col("v").alias(end), F.col("root").alias(f"r_{end}"))  # noqa: E731, B023
        links = links.join(at("a"), ["document_id", "a"]).join(at("b"), ["document_id", "b"]).select("document_id", F.col("r_a").alias("a"), F.col("r_b").alias("b"))
    if not maps:
        return links.select("document_id", F.col("a").alias("v"), F.col("b").alias("root"))
    label = maps[0]
    for later in maps[1:]:
        up = later.select("document_id", F.col("v").alias("root"), F.col("root").alias("top"))
        label = label.join(up, ["document_id", "root"], "left").select("document_id", "v", F.coalesce("top", "root").alias("root"))
    return label


def connect(links: DataFrame, one_task_links: int = ONE_TASK_LINKS) -> DataFrame:
    """document_id, v and root, the smallest vertex connected with v, of every vertex of links(document_id, a, b)."""
    links = stage(_ordered(links), "links")
    left = links.count()
    removed: list[DataFrame] = []
    while left > one_task_links:
        before = left
        for round_of in (_compress, _strip):
            degrees = stage(_both_ways(links).groupBy("document_id", "v").agg(F.count(F.lit(1)).alias("degree"), F.min("to").alias("lo"), F.max("to").alias("hi")), "degrees")
            gone, bridges = round_of(degrees)
            gone = stage(gone, "removed")
            removed.append(gone)
            a_gone, b_gone = (gone.select("document_id", F.col("v").alias(end)) for end in ("a", "b"))
            kept = links.join(a_gone, ["document_id", "a"], "left_anti").join(b_gone, ["document_id", "b"], "left_anti").select("document_id", "a", "b")
            links = stage(_ordered(kept if bridges is None else kept.unionByName(bridges)), "links")
        left = links.count()
        if left > before * (1 - LEAST_SHRINK):
            break
    if left > one_task_links:
        label = _solve_core(links)
    else:
        label = links.repartition(1).mapInArrow(_one_task, _SOLVED)
    for gone in reversed(removed):
        # what a removed vertex hangs on is a vertex that stays, or one that is a component by itself
        label = stage(label, "labels")
        up = label.select("document_id", F.col("v").alias("to"), "root")
        back = gone.join(up, ["document_id", "to"], "left").select("document_id", "v", F.coalesce("root", "to").alias("root"))
        alone = gone.select("document_id", F.col("to").alias("v")).distinct().join(label, ["document_id", "v"], "left_anti").join(gone, ["document_id", "v"], "left_anti").select("document_id", "v", F.col("v").alias("root"))
        label = label.unionByName(back).unionByName(alone)
    if not removed:
        return label
    label = stage(label, "labels")
    # stripping keeps connections and not the order, so the smallest member is looked up at the end
    least = label.groupBy("document_id", "root").agg(F.min("v").alias("least"))
    return label.join(least, ["document_id", "root"]).select("document_id", "v", F.col("least").alias("root"))


def block_links(blocks: DataFrame) -> DataFrame:
    """document_id, block_id, links and item of every block, each once."""
    item = F.when(~F.col("logical_item_id").isin(*NO_ITEM), F.col("logical_item_id"))
    rows = blocks.filter("document_id is not null and block_id <> ''").select("document_id", "block_id", "continuation_of", "continues_to", item.alias("item"))
    return rows.distinct().select("document_id", "block_id", F.array("continuation_of", "continues_to").alias("links"), "item")


def groups(rows: DataFrame, one_task_links: int = ONE_TASK_LINKS) -> DataFrame:
    """document_id, block_id and group_id of every block that is connected with another one."""
    rows = rows.withColumn("part", F.expr("substring(block_id, 1, greatest(length(block_id) - 3, 0))"))
    rows = rows.repartition("document_id", "part").sortWithinPartitions("document_id", "part")
    local = stage(rows.mapInArrow(_fragments, _LOCAL), "local")
    own = local.filter("kind = 'v'").select("document_id", F.col("id").alias("block_id"), "label", "n")
    away = local.filter("kind = 'e'").select("document_id", F.col("id").alias("block_id"), F.col("label").alias("a"))
    # all blocks are on one side, so it isn't broadcast
    between = away.join(own.select("document_id", "block_id", F.col("label").alias("b")).hint("merge"), ["document_id", "block_id"]).select("document_id", "a", "b")
    shared = local.filter("kind = 'i'").select("document_id", F.col("id").alias("item"), F.col("label").alias("a"))
    spread = shared.groupBy("document_id", "item").agg(F.min("a").alias("b"), F.max("a").alias("most")).filter("b <> most").drop("most")
    between = between.unionByName(shared.join(spread, ["document_id", "item"]).select("document_id", "a", "b"))
    roots = connect(between, one_task_links).select("document_id", F.col("v").alias("label"), "root")
    return own.join(roots, ["document_id", "label"], "left").filter("n > 1 or root is not null").select("document_id", "block_id", F.coalesce("root", "label").alias("group_id"))


def block_groups(blocks: DataFrame) -> DataFrame:
    """Groups of the fragments of one item, tied by either link or by the item they share."""
    return groups(block_links(blocks))
