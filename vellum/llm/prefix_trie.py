"""Prefix trie of conversations, rolled up by centroid decomposition.

A node is a distinct sequence of first turns; its identity is its least
member's conv_id and its depth. Keys of prefixes are running XORs of hashed
(turn, place) pairs, 128 bits wide, so a long conversation needs no sequential
pass.

The rollup adds a value of every node over its subtree. Each node knows the
weight of its subtree from its members alone (every member brings the length
that it has left). In a component of the parent-edge forest the nodes that
hold at least half of the component's weight form one path from its top; the
last of them is the centroid. What lies at or below the centroid is summed
once and added to every node of that path; then the centroid goes, its
children's subtrees and the upper rest are the next components, and the
weights on the path lose the centroid's. A component halves in every step.
Components of more than ``local_nodes`` nodes are split by Spark, all at once
a step; smaller ones are finished whole, many in a task.

Rows: null conv_ids take no part; null roles and texts are empty; a null turn
comes first; turns of equal number are ordered by role and text, equal rows
stay separate turns. An empty table has no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vellum.llm.running import running, stored

SHARED_TURNS = 6          # the donor's turns are crc32 modulo this
FAMILY = 100              # the donor of c is c - c % FAMILY
SALTS = 64                # a key that every row holds is dealt to so many
LOCAL_NODES = 4096
PIECE_BYTES = 1 << 20


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, points): the turns in order, as two hashes and the
    number of code points of the text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.xxhash64(F.lit("a"), role, text).alias("a"), F.xxhash64(text, F.lit("b"), role).alias("b"),
        F.sha2(F.concat_ws("\n", role, text), 256).alias("tie"), F.char_length(text).cast("long").alias("points"),
        F.lit(1).cast("long").alias("one"))
    placed = running(rows, ["conv_id"], ["turn", "tie", "a"], {"pos": ("one", F.sum)})
    return placed.select("conv_id", (F.col("pos") - 1).alias("pos"), "a", "b", "points")


def rebuilt(placed: DataFrame, shared_turns: int = SHARED_TURNS, family: int = FAMILY) -> DataFrame:
    """(conv_id, depth, size, a, b, points): each conversation's first h
    turns come from its donor; depth 0 is a row without a turn. ``size`` is
    the number of rebuilt turns."""
    convs = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    donor = (F.col("conv_id") - F.col("conv_id") % family).alias("donor")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared_turns).alias("h")
    plans = convs.select("conv_id", "n", donor, h).join(
        convs.select(F.col("conv_id").alias("donor"), F.col("n").alias("donor_n")), "donor", "left")
    taken = F.least("h", F.coalesce("donor_n", F.lit(0).cast("long")))
    plans = plans.select("conv_id", "donor", "h", taken.alias("taken"),
                         (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long"))).alias("size"))
    heads = placed.where(F.col("pos") < shared_turns).withColumnRenamed("conv_id", "donor")
    turn = ["a", "b", "points"]
    borrowed = plans.join(heads, "donor").where("pos < h").select("conv_id", (F.col("pos") + 1).alias("depth"), "size", *turn)
    own = placed.join(plans, "conv_id").where("pos >= h").select(
        "conv_id", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"), "size", *turn)
    zero = F.lit(0).cast("long")
    tops = plans.select("conv_id", zero.alias("depth"), "size", *(zero.alias(c) for c in turn))
    return borrowed.unionByName(own).unionByName(tops)


def prefixes(rows: DataFrame) -> DataFrame:
    """rebuilt() with (k, l), the key of the prefix that ends at the row."""
    mixed = rows.withColumns({"a": F.when(F.col("depth") > 0, F.xxhash64("a", "depth")).otherwise(F.lit(0).cast("long")),
                              "b": F.when(F.col("depth") > 0, F.xxhash64("depth", "b")).otherwise(F.lit(0).cast("long"))})
    return running(mixed, ["conv_id"], ["depth"], {"k": ("a", F.bit_xor), "l": ("b", F.bit_xor)}).drop("a", "b")


def trie(prefix_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(steps, nodes). steps: (conv_id, depth, size, rep), the node of each
    prefix by its least member; nodes: (rep, depth, parent_rep, n_convs,
    n_children, points, mass). Nodes that a third of all conversations share
    are counted in SALTS parts first, and found again by part."""
    key = ["k", "l", "depth"]
    rows = prefix_rows.withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int"))
    parts = stored(rows.groupBy(*key, "salt").agg(
        F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.max("points").alias("points"),
        F.sum(F.col("size") - F.col("depth") + 1).alias("mass")), "trie", "parts")
    whole = parts.groupBy(*key).agg(F.min("rep").alias("rep"), F.sum("n_convs").alias("n_convs"),
                                    F.max("points").alias("points"), F.sum("mass").alias("mass"))
    named = parts.select(*key, "salt").join(whole.select(*key, "rep"), key)
    steps = stored(rows.join(named, [*key, "salt"]).select("conv_id", "depth", "size", "rep"), "trie", "steps")
    above = steps.select(F.col("conv_id").alias("rep"), (F.col("depth") + 1).alias("depth"), F.col("rep").alias("parent_rep"))
    nodes = stored(whole.select("rep", "depth", "n_convs", "points", "mass").join(above, ["rep", "depth"], "left"), "trie", "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("parent_rep").alias("rep"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["rep", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    return steps, nodes


def _salted(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def rollup(nodes: DataFrame, steps: DataFrame, values: list[str], local_nodes: int = LOCAL_NODES) -> DataFrame:
    """(rep, depth, *values): each value summed over the node's subtree.
    ``nodes`` holds (rep, depth, parent_rep, mass, *values), mass being the
    weight of the whole subtree, and ``steps`` (conv_id, depth, rep)."""
    node, comp = ["rep", "depth"], ["top", "top_depth"]
    # a component is named after its top node; all nodes start in the root's, named (0, 0)
    active = nodes.select(*node, "parent_rep", "mass", *values, *(F.lit(0).cast("long").alias(c) for c in comp))
    active = stored(active.withColumn("salt", F.pmod(F.xxhash64(*node), F.lit(SALTS)).cast("int")), "trie", "active")
    sums = []
    while True:
        facts = stored(active.groupBy(*comp).agg(F.count(F.lit(1)).alias("n"), F.max("mass").alias("total")), "trie", "facts")
        large = facts.where(F.col("n") > local_nodes)
        sized = active.join(_salted(facts), [*comp, "salt"])
        sums.append(_finished(sized.where(F.col("n") <= local_nodes), comp, values))
        if large.isEmpty():
            break
        open_ = sized.where(F.col("n") > local_nodes)
        path = open_.where("2 * mass >= total")
        centre = path.groupBy(*comp).agg(F.min(F.struct("mass", "rep", "depth")).alias("c"))
        centre = stored(centre.select(*comp, F.col("c.mass").alias("c_mass"), F.col("c.rep").alias("c_rep"),
                                      F.col("c.depth").alias("c_depth")), "trie", "centres")
        met = open_.join(_salted(centre), [*comp, "salt"]).withColumn("next_depth", F.col("c_depth") + 1)
        # the ancestor of a node one below the centroid's depth, and that ancestor's parent
        child = steps.select(F.col("conv_id").alias("rep"), F.col("depth").alias("next_depth"), F.col("rep").alias("child"))
        at = steps.select(F.col("conv_id").alias("rep"), (F.col("depth") + 1).alias("next_depth"), F.col("rep").alias("holder"))
        is_centre = (F.col("rep") == F.col("c_rep")) & (F.col("depth") == F.col("c_depth"))
        below = (F.col("depth") > F.col("c_depth")) & (F.col("holder") == F.col("c_rep"))
        met = met.join(child, ["rep", "next_depth"], "left").join(at, ["rep", "next_depth"], "left")
        met = stored(met.withColumns({"is_centre": is_centre, "below": F.coalesce(below, F.lit(False))}), "trie", "met")
        held = met.where("below OR is_centre").groupBy(*comp).agg(*(F.sum(v).alias(v) for v in values))
        sums.append(met.where("2 * mass >= total").select(*node, *comp, "salt").join(_salted(held), [*comp, "salt"]).select(*node, *values))
        onward = met.where("NOT is_centre").select(
            *node, "parent_rep", F.when(F.expr("2 * mass >= total"), F.col("mass") - F.col("c_mass")).otherwise(F.col("mass")).alias("mass"),
            *values, F.when(F.col("below"), F.col("child")).otherwise(F.col("top")).alias("top"),
            F.when(F.col("below"), F.col("next_depth")).otherwise(F.col("top_depth")).alias("top_depth"), "salt")
        active = stored(onward, "trie", "active")
    total = sums[0]
    for more in sums[1:]:
        total = total.unionByName(more)
    return total.groupBy(*node).agg(*(F.sum(v).alias(v) for v in values))


def _finished(rows: DataFrame, comp: list[str], values: list[str]) -> DataFrame:
    """Small components, whole: a task reads its components one after the
    other and rolls up many at a time."""
    dealt = rows.select("rep", "depth", "parent_rep", "mass", *values, *comp).repartition(*comp).sortWithinPartitions(*comp, "depth", "rep")
    names = list(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = pa.concat_tables([rest, table]) if rest is not None else table
            tops, depths = (rest[c].to_numpy() for c in comp)
            cut = len(tops) - 1  # the last component may go on in the next batch
            while cut > 0 and tops[cut - 1] == tops[-1] and depths[cut - 1] == depths[-1]:
                cut -= 1
            if cut:
                yield from _rolled(rest.slice(0, cut), comp, names)
                rest = rest.slice(cut)
        if rest is not None and rest.num_rows:
            yield from _rolled(rest, comp, names)

    return dealt.mapInArrow(run, "rep bigint, depth bigint, " + ", ".join(f"{v} bigint" for v in values))


def _rolled(table: pa.Table, comp: list[str], values: list[str]) -> Iterator[pa.RecordBatch]:
    if not table.num_rows:
        return
    rep, depth, mass, top, top_depth = (table[c].to_numpy() for c in ("rep", "depth", "mass", *comp))
    parent_rep = table["parent_rep"].combine_chunks().fill_null(0).to_numpy(zero_copy_only=False)
    changed = np.ones(len(rep), bool)
    changed[1:] = (top[1:] != top[:-1]) | (top_depth[1:] != top_depth[:-1])
    group = np.cumsum(changed) - 1
    order = np.lexsort((rep, depth, group))
    # parents: the node (parent_rep, depth - 1) of the same component
    place = {key: i for i, key in enumerate(zip(group.tolist(), depth.tolist(), rep.tolist()))}
    parent = np.array([place.get(key, -1) for key in zip(group.tolist(), (depth - 1).tolist(), parent_rep.tolist())], np.int64)
    sums = decomposed(parent, depth, group, mass.copy(), [table[v].to_numpy() for v in values])
    arrays = [pa.array(rep[order]), pa.array(depth[order]), *(pa.array(s[order]) for s in sums)]
    yield pa.RecordBatch.from_arrays(arrays, names=["rep", "depth", *values])


def decomposed(parent: np.ndarray, depth: np.ndarray, group: np.ndarray, mass: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
    """Subtree sums by centroid decomposition of all components at once.
    ``group`` numbers the components; ``mass`` is the weight of the part of a
    node's subtree that lies in its component, and changes."""
    n = len(parent)
    sums = [np.zeros(n, np.int64) for _ in values]
    layers = [np.flatnonzero(depth == d) for d in np.unique(depth)]
    alive = np.ones(n, bool)
    group = group.astype(np.int64)
    while alive.any():
        at = np.flatnonzero(alive)
        labels, g = np.unique(group[at], return_inverse=True)
        total = np.zeros(len(labels), np.int64)
        np.maximum.at(total, g, mass[at])
        path = 2 * mass[at] >= total[g]
        on = at[path]
        last = np.lexsort((mass[on], g[path]))  # the lightest of each path comes first
        first = np.ones(len(on), bool)
        first[1:] = g[path][last][1:] != g[path][last][:-1]
        centre = on[last[first]]                # one a component, in the order of the labels
        is_centre = np.zeros(n, bool)
        is_centre[centre] = True
        below = np.full(n, -1, np.int64)        # the child of the centroid that a node lies under
        for layer in layers:
            live = layer[alive[layer] & (parent[layer] >= 0)]
            up = parent[live]
            live, up = live[alive[up]], up[alive[up]]
            live, up = live[group[live] == group[up]], up[group[live] == group[up]]
            below[live] = np.where(is_centre[up], live, below[up])
        held = (below[at] >= 0) | is_centre[at]
        for s, v in zip(sums, values):
            part = np.zeros(len(labels), np.int64)
            np.add.at(part, g[held], v[at[held]])
            s[on] += part[g[path]]
        mass[on] -= mass[centre][g[path]]
        group[at] = np.where(below[at] >= 0, n + below[at], labels[g])
        _, group[at] = np.unique(group[at], return_inverse=True)
        alive[centre] = False
    return sums


def ends_digest(steps: DataFrame) -> DataFrame:
    """(rep, depth, ends_sha256): digest of the ids of the conversations that
    end at a node, ascending. Ids are joined to pieces of bounded length where
    they lie, sorted by range; the digest then reads pieces one by one."""
    ends = steps.where("depth = size").select("rep", "depth", "conv_id")
    sorted_ends = ends.repartitionByRange("rep", "depth", "conv_id").sortWithinPartitions("rep", "depth", "conv_id")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in range(3)))
            for (rep, depth), members in groupby(rows, key=lambda r: r[:2]):
                ids = [r[2] for r in members]
                step = PIECE_BYTES // 20
                out += [(rep, depth, ids[k], ",".join(map(str, ids[k:k + step]))) for k in range(0, len(ids), step)]
            yield _batch(out, ["rep", "depth", "least", "piece"], [pa.int64()] * 3 + [pa.string()])
            out = []

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        for batch in batches:
            out = []
            for rep, depth, _, piece in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if held != (rep, depth):
                    if held:
                        out.append((*held, state.hexdigest()))
                    held, state = (rep, depth), hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
            yield _batch(out, ["rep", "depth", "ends_sha256"], [pa.int64()] * 2 + [pa.string()])
        if held:
            yield _batch([(*held, state.hexdigest())], ["rep", "depth", "ends_sha256"], [pa.int64()] * 2 + [pa.string()])

    cut = sorted_ends.mapInArrow(pieces, "rep bigint, depth bigint, least bigint, piece string")
    ordered = cut.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "least")
    return ordered.mapInArrow(digests, "rep bigint, depth bigint, ends_sha256 string")


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def prefix_trie(conversations: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """One row a node: conv_id (least member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    steps, nodes = trie(prefixes(rebuilt(stored(turns(conversations), "trie", "turns"))))
    nodes = stored(nodes.withColumns({
        "n_leaves": (F.col("n_children") == 0).cast("long"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("points")}), "trie", "valued")
    sums = rollup(nodes, steps, ["n_leaves", "saved_tokens"], local_nodes)
    key = ["rep", "depth"]
    full = nodes.drop("n_leaves", "saved_tokens").join(sums, key).join(ends_digest(steps), key, "left")
    return full.select(
        F.col("rep").alias("conv_id"), "depth", F.col("parent_rep").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
