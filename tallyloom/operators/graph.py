"""Graphs as edge tables: components, bounded walks, layers, and money passed along edges.

Each round is a join and an aggregate over edges, written to the shared folder, so lineage stays short and no node's
neighbourhood is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from tallyloom.operators.groups import numbered
from tallyloom.session import cut, ship


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the undirected edges (a, b): the smallest node that each node is connected to.

    Labels spread along edges and jump along labels, so rounds grow with the logarithm of a component's width. Edges with a
    null end are left out; an empty table gives no rows; self-loops make components of one node.
    """
    known = edges.filter("a IS NOT NULL AND b IS NOT NULL")
    both = cut(known.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(known.select(F.col("b").alias("node"), F.col("a").alias("near"))).distinct(), "edges")
    labels = cut(both.groupBy("node").agg(F.least("node", F.min("near")).alias("component")), "labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("near"), "component"), "near").groupBy("node").agg(F.min("component").alias("seen"))
        lower = labels.join(seen, "node").select("node", F.col("component").alias("was"), F.least("component", "seen").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        now = cut(lower.join(jump, "component").select("node", "was", F.least("component", "further").alias("component")), "labels")
        changed = now.filter("was <> component").limit(1).count()
        labels = now.select("node", "component")
        if not changed:
            return labels


#: Seeds that walk together, as the bits of one number.
TOGETHER = 62
#: Up to so many nodes and different edges, walks are bit matrices of so many bytes, one task for each; edges are sent in chunks.
MATRIX_NODES, MATRIX_EDGES, MATRIX_BYTES, CHUNK = 1 << 18, 1 << 27, 40_000_000, 1 << 20
#: Bytes of a matrix that are worked on at a time, so that they stay in a core's cache, and rows of a batch of results.
CACHED, BATCH = 1 << 20, 1 << 17


def reachable(edges: DataFrame, seeds: DataFrame, depth: int) -> DataFrame:
    """(seed, node, depth): nodes within so many steps of each seed along directed edges (parent, child), by their fewest steps.

    The result may hold the square of the nodes, so none of its rows is shuffled or stored on the way. Nodes that were reached
    before are not walked again, so cycles end. Null seeds and ends of edges are left out. Up to MATRIX_NODES nodes a task walks
    from a block of seeds over all edges, beyond that walks are joins.
    """
    known = edges.filter("parent IS NOT NULL AND child IS NOT NULL").select("parent", "child")
    starts = seeds.select("node").filter("node IS NOT NULL").distinct()
    ends = known.select(F.col("parent").alias("node")).distinct().unionByName(known.select(F.col("child").alias("node")).distinct())
    nodes = cut(starts.withColumn("start", F.lit(True)).unionByName(ends.withColumn("start", F.lit(False))).groupBy("node").agg(F.max("start").alias("start")), "nodes")
    kind = seeds.schema["node"].dataType
    rows = _by_matrix(known, nodes, depth) if nodes.count() <= MATRIX_NODES else None
    rows = _by_joins(known, starts, depth) if rows is None else rows
    return rows.withColumn("seed", F.col("seed").cast(kind))


def _by_joins(known: DataFrame, starts: DataFrame, depth: int) -> DataFrame:
    """TOGETHER seeds walk as one: a row (node, group, bits) says which of them have reached a node, so a step moves each edge once
    a group and not once a seed. The seeds of a group are joined to such rows, and rows become seeds after that.
    """
    step = cut(known.distinct(), "step")
    known = cut(numbered(starts, "node", "n"), "seeds")
    known = known.select(F.col("node").alias("seed"), F.floor((F.col("n") - 1) / TOGETHER).alias("group"), ((F.col("n") - 1) % TOGETHER).cast("int").alias("bit"))
    start = known.select(F.col("seed").alias("node"), "group", F.expr("shiftleft(1L, bit)").alias("bits"))
    frontier = seen = cut(start.groupBy("node", "group").agg(F.bit_or("bits").alias("bits")), "walk")
    found = [frontier.withColumn("depth", F.lit(0))]
    for d in range(1, depth + 1):
        met = frontier.join(step, frontier["node"] == step["parent"]).groupBy(F.col("child").alias("node"), "group").agg(F.bit_or("bits").alias("met"))
        now = cut(seen.join(met, ["node", "group"], "full").select("node", "group", F.coalesce("bits", F.lit(0)).cast("bigint").alias("was"), F.coalesce("met", F.lit(0)).cast("bigint").alias("met")), "walk")
        frontier = now.select("node", "group", F.col("met").bitwiseAND(F.bitwise_not("was")).alias("bits")).filter("bits <> 0")
        seen = now.select("node", "group", F.col("was").bitwiseOR(F.col("met")).alias("bits"))
        found.append(frontier.withColumn("depth", F.lit(d)))
        if not frontier.head(1):
            break
    rows = found[0]
    for f in found[1:]:
        rows = rows.unionByName(f)
    members = known.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("bit", "seed"))).alias("members"))
    walked = rows.join(members, "group").select("node", "depth", F.explode(F.expr("filter(members, m -> getbit(bits, m.bit) = 1)")).alias("m"))
    return walked.select(F.col("m.seed").alias("seed"), "node", "depth")


def _packed(parents: np.ndarray, children: np.ndarray) -> tuple[int, int, bytes]:
    """Edges by child, as (number of children, of edges, the children, how many parents each has, and the parents, compressed)."""
    order = np.lexsort((parents, children))
    own, many = np.unique(children, return_counts=True)
    whole = np.concatenate([own, many, parents[order]]).astype("<i4")
    return len(own), len(parents), pa.compress(whole.view("u1").reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def _unpacked(own: int, edges: int, packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = 2 * own + edges
    whole = np.frombuffer(pa.decompress(packed, 4 * n, codec="zstd", asbytes=True), "u1").reshape(4, n).T.copy().view("<i4").ravel()
    return whole[:own], whole[own : 2 * own], whole[2 * own :]


def _step(chunk: tuple[int, int, bytes], frontier: np.ndarray, seen: np.ndarray, met: np.ndarray, active: np.ndarray, open_: np.ndarray, full: np.ndarray) -> None:
    """Adds to met, for each child that is open, the bits of its parents in the frontier."""
    own, many, parents = _unpacked(*chunk)
    child = np.repeat(own, many)
    kept = active[parents] & open_[child]
    child, parents = child[kept], parents[kept]
    if not len(child):
        return
    first = np.flatnonzero(np.r_[True, child[1:] != child[:-1]])
    many = np.diff(np.r_[first, len(child)])
    order = np.argsort(-many, kind="stable")  # children with a k-th parent come first
    rows = max(1, CACHED // (frontier.shape[1] * 8))
    space = np.empty((rows, frontier.shape[1]), frontier.dtype)
    for s in range(0, len(order), rows):
        at, deg = first[order[s : s + rows]], many[order[s : s + rows]]
        c = child[at]
        now, before = met[c], seen[c]
        for k, m in enumerate(np.searchsorted(-deg, -np.arange(deg[0]), side="left")):
            np.take(frontier, parents[at[:m] + k], axis=0, out=space[:m], mode="clip")
            now[:m] |= space[:m]
            if k & (k + 1) == 0 and ((now[:m] | before[:m]) == full).all():
                break
        met[c] = now
        open_[c] = ((now | before) != full).any(axis=1)


def _walked(chunks: list[tuple[int, int, bytes]], nodes: int, at: np.ndarray, depth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(depth, nodes, ends, positions in at) of the walks from the nodes `at`: a row of bits for each node says which have reached it.

    The positions of a node stand between the end before and its own.
    """
    j = np.arange(len(at))
    seen = np.zeros((nodes, -(-len(at) // 64)), "<u8")
    full = np.zeros(seen.shape[1], "<u8")
    bit = np.left_shift(np.uint64(1), (j % 64).astype("u8"))
    seen[at, j // 64] = bit
    np.bitwise_or.at(full, j // 64, bit)
    frontier, rows = seen.copy(), max(1, BATCH // max(1, len(at)))
    for d in range(depth + 1):
        if d:
            met = np.zeros_like(seen)
            active, open_ = frontier.any(axis=1), (seen != full).any(axis=1)
            for chunk in chunks:
                _step(chunk, frontier, seen, met, active, open_, full)
            frontier = np.bitwise_and(met, np.bitwise_not(seen), out=met)
            seen |= frontier
        held = np.flatnonzero(frontier.any(axis=1))
        for s in range(0, len(held), rows):
            part = held[s : s + rows]
            bits = np.unpackbits(frontier[part].view("u1"), axis=1, bitorder="little").view(bool)
            many = bits.sum(axis=1)
            yield d, part, np.cumsum(many), np.flatnonzero(bits) - np.repeat(np.arange(len(part)) * bits.shape[1], many)
        if not len(held):
            break


def _by_matrix(known: DataFrame, nodes: DataFrame, depth: int) -> DataFrame | None:
    """Each task walks from a block of seeds, of which it has MATRIX_BYTES of bits; it gets all edges, packed. None for too many edges."""
    ship(known.sparkSession)
    listed = nodes.orderBy("node").toArrow()
    values, is_start = (listed[c].combine_chunks() for c in ("node", "start"))
    starts = np.flatnonzero(is_start.to_numpy(zero_copy_only=False))
    blocks = max(1, -(-len(starts) // max(64, MATRIX_BYTES * 8 // max(1, len(values)))))
    each = max(1, -(-len(starts) // blocks))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def packed() -> pa.RecordBatch:
            out = [[x] for x in _packed(*(np.concatenate(x) for x in zip(*held, strict=True)))]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int32(), pa.int32(), pa.binary()), strict=True)], ["own", "edges", "packed"])

        for b in batches:
            held.append([pc.index_in(b.column(c).cast(values.type), value_set=values).to_numpy(zero_copy_only=False).astype("i4") for c in range(2)])
            if sum(len(x[0]) for x in held) >= CHUNK:
                yield packed()
        if sum(len(x[0]) for x in held):
            yield packed()

    chunks = cut(known.distinct().mapInArrow(pack, "own int, edges int, packed binary"), "edges")
    if (chunks.agg(F.sum("edges")).head()[0] or 0) > MATRIX_EDGES:
        return None
    # a block without edges has its seeds
    blank = known.sparkSession.range(1).select(F.lit(0).alias("own"), F.lit(0).alias("edges"), F.lit(b"").alias("packed"))
    sent = chunks.unionByName(blank).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartitionByRange(blocks, "block")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[int, list[tuple[int, int, bytes]]] = {}
        for b in batches:
            for r in b.to_pylist():
                own = by.setdefault(r["block"], [])
                if r["edges"]:
                    own.append((r["own"], r["edges"], r["packed"]))
        for block, own in by.items():
            at = starts[block * each : (block + 1) * each]
            from_ = values.take(pa.array(at))
            for d, n, ends, k in _walked(own, len(values), at, depth):
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype("i4")), from_.take(pa.array(k)))
                yield pa.RecordBatch.from_arrays([lists, values.take(pa.array(n)), pa.array(np.full(len(n), d, "i4"))], ["seeds", "node", "depth"])

    kind = nodes.schema["node"].dataType
    walked = sent.mapInArrow(walk, StructType([StructField("seeds", ArrayType(kind)), StructField("node", kind), StructField("depth", IntegerType())]))
    return walked.select(F.explode("seeds").alias("seed"), "node", "depth")


def layers(edges: DataFrame) -> DataFrame:
    """(node, layer): 0 for nodes without children, else one more than the highest child; null for nodes on or above a cycle."""
    step = cut(edges.select("parent", "child").distinct(), "step")
    nodes = step.select(F.col("parent").alias("node")).unionByName(step.select(F.col("child").alias("node"))).distinct()
    placed = cut(nodes.join(step.select(F.col("parent").alias("node")), "node", "left_anti").withColumn("layer", F.lit(0)), "layer")
    left = cut(step, "left")
    depth = 0
    while True:
        depth += 1
        left = cut(left.join(placed.filter(F.col("layer") == depth - 1).select(F.col("node").alias("child")), "child", "left_anti"), "left")
        waiting = left.select(F.col("parent").alias("node")).distinct()
        ready = step.select(F.col("parent").alias("node")).distinct().join(waiting, "node", "left_anti").join(placed, "node", "left_anti").withColumn("layer", F.lit(depth))
        ready = cut(ready, "layer")
        if not ready.head(1):
            break
        placed = placed.unionByName(ready)
        if depth % 20 == 0:
            placed = cut(placed, "layer")  # so that a long path does not make a long plan
    return nodes.join(placed, "node", "left")


def passed_down(edges: DataFrame, own: DataFrame, rounds: int) -> DataFrame:
    """(node, label, amount): what each node's money consists of, after money from children is replaced by what theirs consists of.

    edges (parent, child, amount): money of parent that came from child. own (node, label, amount): money with a label of its
    own. A child's composition is scaled to the edge's amount. Cycles are cut after `rounds` steps; what has no label by then
    stays out. Rows are (node, label), so a node with many labels is spread.
    """
    base = cut(own.groupBy("node", "label").agg(F.sum("amount").alias("amount")), "own")
    total = own.groupBy("node").agg(F.sum("amount").alias("own"))
    came = edges.groupBy(F.col("parent").alias("node")).agg(F.sum("amount").alias("came"))
    whole = cut(total.join(came, "node", "full").select("node", (F.coalesce("own", F.lit(0.0)) + F.coalesce("came", F.lit(0.0))).alias("whole")), "whole")
    now = base
    for _ in range(rounds):
        parts = now.join(whole.filter("whole > 0"), "node").select(F.col("node").alias("child"), "label", (F.col("amount") / F.col("whole")).alias("part"))
        inherited = edges.join(parts, "child").select(F.col("parent").alias("node"), "label", (F.col("amount") * F.col("part")).alias("amount"))
        now = cut(base.unionByName(inherited).groupBy("node", "label").agg(F.sum("amount").alias("amount")), "passed")
    return now


def split_by_shares(rows: DataFrame, parts: DataFrame, key: str, node: str, amount: str, rest: str = "uncategorised", least: float = 0.01) -> DataFrame:
    """(key, label, amount): each row's amount spread over its node's parts (node, label, share), and a rest above `least`."""
    spread = rows.join(parts, node).select(key, "label", (F.col(amount) * F.col("share")).alias("amount"))
    used = spread.groupBy(key).agg(F.sum("amount").alias("used"))
    remainder = rows.join(used, key, "left").select(key, F.lit(rest).alias("label"), (F.col(amount) - F.coalesce("used", F.lit(0.0))).alias("amount"))
    return spread.unionByName(remainder.filter(F.abs("amount") > least))
