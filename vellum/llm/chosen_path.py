"""Near-duplicate components by chosen-path set similarity join.

Every distinct shingle set has POSITIONS minwise tokens. A tree sends each set
from a node to one child by the token at a position that the node draws, and,
as often as makes the mean 100/percent, to a second one; so two sets that link
share one child a level on average, while others lose each other. Trees are
independent; TREES of them meet the target recall. A node is finished when all
its sets but ``small`` are in one component: those few are compared with every
set of other components in it, exhaustively. Larger nodes branch again; what
is left after DEPTH levels is compared exhaustively too, so nothing is cut.

Groups of thousands of near copies would stay together in every node and give
all pairs. So the first trees only link each set with the centre of its nodes,
the member whose tokens are the most common: that makes the core of a group one
component, and only sets of different components are compared after that.
Comparisons in a node are made on one byte of each minwise token, where the
rows lie; what is within four standard deviations of the limit is confirmed on
the full sets. Nodes of many sets get those too, confirm at once and return
links between components only, so a family of texts that are close to each
other without linking gives no pairs. Small nodes return pairs: first the most
alike partner of each set is confirmed, then, of sets that are still in
different components, all; sets with the same partners are confirmed in
groups, so that a partner moves once a group. Hot nodes and groups are dealt to
several tasks.

Equal sets are one class throughout. Sets and tokens are stored once, bucketed
by class, so that no comparison shuffles them again; what moves is one of the
two sets of each compared pair.

Defined results: A-Z is lower-cased; a text of fewer words than ``size`` is
one shingle, its whole sequence; a null or empty text has no shingles and is
linked with nothing; component_id is the least non-null id of the component;
rows with one id keep their own sets; repeated rows are members of one class;
a row without an id is not kept; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import math
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vellum.llm import blocks, textscan
from vellum.llm.components import components
from vellum.llm.ngram_join import classes, shingles
from vellum.llm.running import stored
from vellum.session import shared_path

SIZE, PERCENT = 5, 85
POSITIONS = 96
TREES = 12
STAR_TREES = 8            # trees of the pass that links sets with centres only
SMALL = 2048              # outsiders a node may have to be compared exhaustively
PAIRS_OF = 64             # nodes of up to so many sets give pairs, larger ones compare full sets where they lie
DEPTH = 12
GROUP_ROWS = 2048         # sets that meet the same few in one group
CENTRES = 64              # sets that others are confirmed with in one group
BUCKET_BYTES = 16 << 20

_U = np.uint64


def tokens(doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Minwise tokens (n, POSITIONS); rows without shingles hold zeros."""
    out = np.zeros((n, POSITIONS), np.uint32)
    if len(h):
        rows, first = np.unique(doc, return_index=True)
        factors = np.random.default_rng(12).integers(1, 1 << 62, POSITIONS, dtype=np.uint64) * _U(2) + _U(1)
        for p in range(POSITIONS):
            out[rows, p] = np.minimum.reduceat((h * factors[p]) >> _U(32), first).astype(np.uint32)
    return out


def pack_set(h: np.ndarray) -> bytes:
    """A sorted set's upper 48 bits, as byte planes: two sets of 20,000
    shingles have a chance of 1e-6 to be told more alike than they are."""
    return np.ascontiguousarray((h >> _U(16)).view(np.uint8).reshape(-1, 8)[:, :6].T).tobytes()


def unpack_set(body: bytes) -> np.ndarray:
    planes = np.frombuffer(body, np.uint8).reshape(6, -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :6] = planes.T
    return wide.view(np.uint64).reshape(-1)


def _described(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """The store: (code, doc_id, n, class, tokens, body), bucketed by code, a
    number for each row; later only a class's least code is used."""
    spark, id_type = docs.sparkSession, dict(docs.dtypes)[doc_id]

    def describe(batches):
        for batch in batches:
            column = batch.column("text")
            lengths = np.diff(textscan.utf8(column)[1])
            for i, j in textscan.slices(np.concatenate([[0], np.cumsum(lengths)])):
                doc, h = shingles(column.slice(i, j - i), size)
                n, digest = classes(doc, h, j - i)
                first = np.searchsorted(doc, np.arange(j - i + 1))
                least = tokens(doc, h, j - i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                     pa.array([t.tobytes() if d else None for t, d in zip(least, digest)], pa.binary()),
                     pa.array([pack_set(h[a:b]) if d else None for a, b, d in zip(first, first[1:], digest)], pa.binary())],
                    names=["doc_id", "n", "class", "tokens", "body"])

    plain = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = plain.mapInArrow(describe, f"doc_id {id_type}, n bigint, class binary, tokens binary, body binary")
    _, n_bytes = blocks.volume(docs, text)
    n_buckets = max(4, math.ceil(n_bytes / BUCKET_BYTES))
    name = f"chosen_path_{uuid.uuid4().hex}"
    (rows.withColumn("code", F.monotonically_increasing_id()).repartition(n_buckets, "code").write.format("parquet")
     .bucketBy(n_buckets, "code").sortBy("code").option("path", shared_path(spark, "chosen-path", "store", unique=True)).saveAsTable(name))
    return spark.table(name)


def _draw(node: np.ndarray, seed: int) -> np.ndarray:
    return textscan.mix(node + _U(seed * 0x9E3779B97F4A7C15 % 2**64))


def branched(percent: int):
    """Rows (code, comp, node, tokens) to their children (code, comp, node)."""
    second = int((100 / percent - 1) * 2.0**63)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column("node").to_numpy().view(np.uint64)
            held = np.frombuffer(b"".join(batch.column("tokens").to_pylist()), np.uint32).reshape(-1, POSITIONS)
            at = np.arange(len(node))
            out = []
            for k, rows in ((0, at), (1, np.flatnonzero(_draw(node, 1) >> _U(1) < _U(second)))):
                place = (_draw(node[rows], 2 + k) % _U(POSITIONS)).astype(np.int64)
                child = textscan.mix(_draw(node[rows], 4 + k) ^ textscan.mix(held[rows, place].astype(np.uint64)))
                out.append(pa.RecordBatch.from_arrays([batch.column("code").take(pa.array(rows)), batch.column("comp").take(pa.array(rows)),
                                                       pa.array(child.view(np.int64))], names=["code", "comp", "node"]))
            yield from out
    return run


_CHILD = "code bigint, comp bigint, node bigint"


def _equal(held: np.ndarray, others: np.ndarray) -> np.ndarray:
    return (others == held).sum(1)


def _runs(keys: list[np.ndarray]) -> np.ndarray:
    """Bounds of the runs of equal keys."""
    changed = np.ones(len(keys[0]), bool)
    changed[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.append(np.flatnonzero(changed), len(changed))


def _whole_groups(batches, keys: list[str]):
    """Tables of whole groups of rows that are sorted by ``keys``."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = pa.concat_tables([rest, table]) if rest is not None and rest.num_rows else table
        if rest.num_rows:
            cut = int(_runs([rest[k].to_numpy() for k in keys])[-2])
            if cut:
                yield rest.slice(0, cut)
                rest = rest.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest


_NEAR = "a bigint, b bigint, same bigint"


def _near(least: int):
    """Pairs of different components in one group of a node: those outside
    the node's main component with all others."""
    def run(batches):
        for table in _whole_groups(batches, ["node", "salt"]):
            node, salt, code, comp, main = (table[c].to_numpy() for c in ("node", "salt", "code", "comp", "main"))
            held = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, POSITIONS)
            outside = comp != main
            out = []
            bounds = _runs([node, salt])
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                inner = slice(lo, hi)
                for i in (np.flatnonzero(outside[inner]) + lo).tolist():
                    # an outsider meets the main component's sets and, once, the other outsiders
                    able = (comp[inner] != comp[i]) & (~outside[inner] | (code[inner] < code[i]))
                    at = np.flatnonzero(able) + lo
                    same = _equal(held[i], held[at])
                    good = same >= least
                    if good.any():
                        out.append(np.stack([code[at[good]], np.full(int(good.sum()), code[i]), same[good]]))
            found = np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(r) for r in found.astype(np.int64)], names=["a", "b", "same"])
    return run


def _links(least: int, percent: int):
    """As _near, but confirmed on the full sets: links (a, b) that join
    components of the group."""
    def run(batches):
        for table in _whole_groups(batches, ["node", "salt"]):
            node, salt, code, comp, main, size = (table[c].to_numpy() for c in ("node", "salt", "code", "comp", "main", "n"))
            out = []
            bounds = _runs([node, salt])
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                part = table.slice(lo, hi - lo)
                held = np.frombuffer(b"".join(part["sketch"].to_pylist()), np.uint8).reshape(-1, POSITIONS)
                out += _joined(held, part["body"].to_pylist(), size[lo:hi], code[lo:hi], comp[lo:hi], comp[lo:hi] != main[lo:hi], least, percent)
            columns = list(zip(*out)) if out else [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])
    return run


def _joined(held, bodies, size, code, comp, outside, least: int, percent: int) -> list[tuple[int, int]]:
    sets = [unpack_set(b) for b in bodies]
    _, comp = np.unique(comp, return_inverse=True)
    out = []
    for i in np.flatnonzero(outside).tolist():
        at = np.flatnonzero((comp != comp[i]) & (~outside | (code < code[i])) & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])))
        same = _equal(held[i], held[at])
        at = at[np.argsort(-same, kind="stable")][:int((same >= least).sum())]
        while len(at):
            some, at = at[:64], at[64:]
            flat = np.concatenate([sets[j] for j in some.tolist()])
            place = np.minimum(np.searchsorted(sets[i], flat), len(sets[i]) - 1)
            ends = np.cumsum(size[some])
            common = np.add.reduceat((sets[i][place] == flat).astype(np.int64), ends - size[some])
            for j in some[100 * common >= percent * (size[some] + size[i] - common)].tolist():
                if comp[j] != comp[i]:
                    out.append((int(code[j]), int(code[i])))
                    comp[comp == comp[j]] = comp[i]
            at = at[comp[at] != comp[i]]
    return out


def _met(pairs: DataFrame, store: DataFrame, column: str, compare, result: str) -> DataFrame:
    """pairs (a, b, gid) with ``result``, a number from the two blobs and
    sizes. The sets b of one gid, CENTRES or so, lie in one group; each a
    moves to it once. A gid with many a is dealt to several groups."""
    facts = store.select("code", "n", F.col(column).alias("blob"))
    moved = pairs.groupBy("a", "gid").agg(F.collect_set("b").alias("with"))
    parts = moved.groupBy("gid").agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).alias("parts"))
    salt = F.pmod(F.xxhash64("a"), F.col("parts")).alias("salt")
    moved = moved.join(parts, "gid").select("gid", salt, F.col("a").alias("code"), "with")
    centres = pairs.select("gid", "b").distinct().join(parts, "gid").select(
        "gid", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("salt"), F.col("b").alias("code"),
        F.lit(None).cast("array<bigint>").alias("with"))
    rows = moved.unionByName(centres).join(facts, "code").withColumn("first", F.col("with").isNotNull())

    def run(batches):
        now, held = None, {}
        for batch in batches:
            out = []
            for gid, salt, code, others, n, blob in zip(*(batch.column(c).to_pylist() for c in ("gid", "salt", "code", "with", "n", "blob"))):
                if now != (gid, salt):
                    now, held = (gid, salt), {}
                if others is None:
                    held[code] = (compare.read(blob), n)
                else:
                    mine = compare.read(blob)
                    out += [(code, b, compare(mine, n, *held[b])) for b in others]
            columns = list(zip(*out)) if out else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b", result])
    ordered = rows.select("gid", "salt", "first", "code", "with", "n", "blob").repartition("gid", "salt").sortWithinPartitions("gid", "salt", "first")
    return ordered.mapInArrow(run, f"a bigint, b bigint, {result} bigint")


class EqualTokens:
    def read(self, blob: bytes) -> np.ndarray:
        return np.frombuffer(blob, np.uint32)

    def __call__(self, a, n_a, b, n_b) -> int:
        return int((a == b).sum())


class Linked:
    def __init__(self, percent: int):
        self.percent = percent

    def read(self, blob: bytes) -> np.ndarray:
        return unpack_set(blob)

    def __call__(self, a, n_a, b, n_b) -> int:
        if 100 * min(n_a, n_b) < self.percent * max(n_a, n_b):
            return 0
        at = np.minimum(np.searchsorted(b, a), len(b) - 1)
        common = int((b[at] == a).sum())
        return int(100 * common >= self.percent * (n_a + n_b - common))


class Join:
    def __init__(self, docs: DataFrame, doc_id: str, text: str, percent: int, size: int):
        self.percent = percent
        share = percent / 100
        self.least_equal = math.floor(POSITIONS * (share - 4 * math.sqrt(share * (1 - share) / POSITIONS)))
        self.store = _described(docs, doc_id, text, size)
        self.owners = stored(self.store.where("class IS NOT NULL").groupBy("class").agg(
            F.min("code").alias("code"), F.min("doc_id").alias("least")), "chosen-path", "owners")
        held = self.store.select("code", "tokens").join(self.owners.select("code"), "code", "left_semi")
        roots = [int(textscan.mix(np.array([t + 1], np.uint64)).view(np.int64)[0]) for t in range(TREES)]
        run = branched(percent)

        def first(batches):
            for batch in batches:
                for tree in range(TREES):
                    rows = batch.append_column("node", pa.array(np.full(batch.num_rows, roots[tree], np.int64))).append_column("comp", batch.column("code"))
                    for out in run([rows]):
                        yield out.append_column("tree", pa.array(np.full(out.num_rows, tree, np.int32)))
        top = stored(held.mapInArrow(first, _CHILD + ", tree int"), "chosen-path", "first-level")
        sizes = top.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        # what no other set shares needs no comparison; a set's weight tells how common its tokens are
        shared = stored(top.join(sizes, "node"), "chosen-path", "shared")
        weights = shared.groupBy("code").agg(F.sum("n").alias("weight"))
        self.top = stored(shared.drop("n").join(weights, "code"), "chosen-path", "top")
        self.roots = None

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Rows with the component that the code is in by now."""
        if self.roots is None:
            return rows
        roots = self.roots.select(F.col("node").alias("code"), F.col("root").alias("now"))
        return rows.join(roots, "code", "left").withColumn("comp", F.coalesce("now", "comp")).drop("now")

    def _confirm(self, pairs: DataFrame, links: DataFrame | None = None) -> None:
        """Compare pairs (a, b) on the full sets; what links, and stored
        ``links`` found before, joins the components. Sets b go into groups by their commonest partner a's
        component, which those of one family share."""
        pairs = stored(pairs.select("a", "b"), "chosen-path", "to-confirm")
        grouped = pairs.withColumn("gid", F.col("b"))
        if self.roots is not None:
            by_comp = self._placed(pairs.select(F.col("a").alias("code"), F.col("a").alias("comp"), "b")).groupBy("b", "comp").agg(F.count(F.lit(1)).alias("n"))
            family = by_comp.groupBy("b").agg(F.max(F.struct("n", "comp")).alias("m")).select("b", F.col("m.comp").alias("family"))
            sizes = family.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / CENTRES).alias("parts"))
            gid = F.xxhash64("family", F.pmod(F.xxhash64("b"), F.col("parts")))
            grouped = pairs.join(family.join(sizes, "family").select("b", gid.alias("gid")), "b")
        found = _met(grouped, self.store, "body", Linked(self.percent), "linked").where("linked = 1").select("a", "b")
        found = stored(found, "chosen-path", "links")
        self._join(found if links is None else found.unionByName(links))

    def _join(self, found: DataFrame) -> None:
        """Join the components by stored links; those of before are known by
        their roots."""
        if self.roots is not None:
            found = found.unionByName(self.roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
        self.roots = stored(components(found, at_hand=True), "chosen-path", "roots")

    def _best(self, near: DataFrame) -> DataFrame:
        """Of each set's pairs the one that is most alike."""
        both = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "same"))
        return both.groupBy("a").agg(F.max(F.struct("same", "b")).alias("p")).select("a", F.col("p.b").alias("b"))

    def star(self, trees: int) -> None:
        """Each set with the centre of its nodes that is most alike."""
        rows = self.top.where(F.col("tree") < trees)
        centres = rows.groupBy("node").agg(F.max(F.struct("weight", "code")).alias("c")).select("node", F.col("c.code").alias("b"))
        pairs = rows.join(centres, "node").where("code <> b").select(F.col("code").alias("a"), "b").distinct()
        near = _met(pairs.withColumn("gid", F.col("b")), self.store, "tokens", EqualTokens(), "same").where(F.col("same") >= self.least_equal)
        self._confirm(near.groupBy("a").agg(F.max(F.struct("same", "b")).alias("p")).select("a", F.col("p.b").alias("b")))

    def exhaustive(self, small: int, depth: int) -> None:
        """All trees, to the end; then the finished nodes of all levels are
        compared together (nodes of different levels have different ids)."""
        rows = self._placed(self.top.select("code", "comp", "node"))
        finished = []
        for level in range(1, depth + 1):
            rows = stored(rows, "chosen-path", "rows")
            by_comp = rows.groupBy("node", "comp").agg(F.count(F.lit(1)).alias("n"))
            nodes = by_comp.groupBy("node").agg(F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("main"))
            nodes = nodes.where("n > main.n").select("node", (F.col("n") - F.col("main.n")).alias("outsiders"), "n", F.col("main.comp").alias("main"))
            placed = stored(rows.join(nodes, "node"), "chosen-path", "placed")
            finished.append(placed if level == depth else placed.where(F.col("outsiders") <= small))
            more = placed.where(F.col("outsiders") > small).select("code", "comp", "node")
            if level == depth or more.isEmpty():
                break
            rows = more.join(self.store.select("code", "tokens"), "code").mapInArrow(branched(self.percent), _CHILD)
        done = reduce(DataFrame.unionByName, finished)
        near = stored(self._compared(done.where(F.col("n") <= PAIRS_OF)), "chosen-path", "near")
        links = stored(self._compared(done.where(F.col("n") > PAIRS_OF), full=True), "chosen-path", "links")
        near = stored(self._apart(near).groupBy("a", "b").agg(F.max("same").alias("same")), "chosen-path", "pairs")
        # links join with the next ones: until then a set's best partner may be one it is joined with already
        self._confirm(self._best(near), links)
        self._confirm(self._apart(near))

    def _apart(self, pairs: DataFrame) -> DataFrame:
        """Pairs of sets that are in different components by now."""
        a, b = (self.roots.select(F.col("node").alias(side), F.col("root").alias(f"comp_{side}")) for side in "ab")
        return pairs.join(a, "a", "left").join(b, "b", "left").where("coalesce(comp_a, a) <> coalesce(comp_b, b)").drop("comp_a", "comp_b")

    def _compared(self, done: DataFrame, full: bool = False) -> DataFrame:
        """Pairs of finished nodes that may link, or, with the full sets,
        links. The outsiders of a node come to each of its groups."""
        parts = F.ceil(F.col("n") / GROUP_ROWS)
        salt = F.when(F.col("comp") != F.col("main"), F.sequence(F.lit(0).cast("long"), parts - 1)).otherwise(F.array(F.pmod(F.xxhash64("code"), parts)))
        held = self.store.select("code", "n", "tokens", *(["body"] if full else [])).join(done.select("code").distinct(), "code", "left_semi")

        def shorten(batches):
            for batch in batches:
                sketch = np.frombuffer(b"".join(batch.column("tokens").to_pylist()), np.uint32).reshape(-1, POSITIONS).astype(np.uint8)
                columns = [batch.column("code"), pa.array([h.tobytes() for h in sketch], pa.binary())]
                columns += [batch.column("n"), batch.column("body")] if full else []
                yield pa.RecordBatch.from_arrays(columns, names=["code", "sketch", "n", "body"][:len(columns)])
        schema = "code bigint, sketch binary" + ", n bigint, body binary" * full
        rows = done.select("node", "code", "comp", "main", F.explode(salt).alias("salt")).join(held.mapInArrow(shorten, schema), "code")
        ordered = rows.repartition("node", "salt").sortWithinPartitions("node", "salt")
        if full:
            return ordered.mapInArrow(_links(self.least_equal, self.percent), "a bigint, b bigint")
        return ordered.mapInArrow(_near(self.least_equal), _NEAR)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, size: int = SIZE,
                    small: int = SMALL, depth: int = DEPTH) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept."""
    join = Join(docs, doc_id, text, percent, size)
    join.star(STAR_TREES)
    join.exhaustive(small, depth)
    linked = join.owners.join(join.roots, F.col("code") == F.col("node")).select("class", "root", "least")
    joint = linked.groupBy("root").agg(F.min("least").alias("joint"))
    by_class = linked.join(joint, "root").select("class", "joint").unionByName(
        join.owners.join(linked, "class", "left_anti").select("class", F.col("least").alias("joint")))
    settled = join.store.select("doc_id", F.col("n").alias("n_shingles"), "class").join(by_class, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("joint"))
    return settled.select("doc_id", "n_shingles", component.alias("component_id"),
                          F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
