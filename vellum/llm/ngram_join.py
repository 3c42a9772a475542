"""Near-duplicate components by an exact Jaccard join of n-gram sets.

Method: universe partitioning with the pigeonhole principle. Sets are put in
bands by size (a band's sizes differ by at most the factor 1/0.8). For a band,
a hash deals all shingles to ``segments`` parts; two sets that link differ in at
most H elements, so if a set spends H + 1 units on its segments, one unit on
"this segment is equal" and two on "this segment differs by one element at
most", some segment must show it. Every set indexes the subsets of its
segments in its own band, and in small bands the one-deletion neighbourhoods of
the subsets too. It probes its own band and the lower bands it can link with.
Allocation goes by cost: merged counts tell each set how many others share
every subset, and it spends its units on the cheapest; what nobody shares costs
nothing and yields no candidate. Candidates are verified exactly.

Equal sets are one class throughout. Of a group of many sets that share a
subset no pairs are made: all are first verified against the most connected
member; the sets that such groups connect ("families") and that are not in one
component by then are compared chunk by chunk, each two chunks in one group,
through the shingles they share. So every link between different sets is
found, up to those that join two members of one component.

Stages: (A) one scan makes (doc_id, class, size); (B) documents are dealt to
blocks once, and three grouped passes exchange compressed subset keys by hash
range (see ``blocks.py``): keys, counts back, picks; (C) the sets of classes
that can have a partner are stored, and pairs are verified on them.

Defined results: A-Z is lower-cased; a text of fewer words than ``size`` is
one shingle, its whole sequence; a null or empty text has no shingles and is
linked with nothing; component_id is the least non-null id of the component;
rows with one id keep their own sets; repeated rows are members of one class;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from vellum.llm import blocks, textscan
from vellum.llm.components import components
from vellum.session import shared_path

SIZE = 5
BLOCK_BYTES = 8 << 20
BLOCK_ENTRIES = 600_000  # entries (keys) a block sends, whatever its texts' length
PAIR_ROWS = 1 << 20      # candidate pairs held before repeats are dropped
KEY_BITS = 44
SPARE = 2.0            # segments a band has, over the units a set must spend
DELETION_SIZES = 32    # bands up to this size index one-deletion neighbourhoods too
ALL_PAIRS = 16         # groups with fewer pairs than this are verified pair by pair
CHUNK = 128            # members of a family that are compared with as many others in one group
SALT_ROWS = 512        # members verified against one centre in one group

_U = np.uint64
_EQUAL, _DELETION = 0x51ED270B, 0x2545F491


# ---- sets ------------------------------------------------------------------

@lru_cache(maxsize=1)
def _hashers():
    return [textscan.SpanHasher(71, fold_case=True)], [textscan.SpanHasher(73)]


def shingles(column, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct shingles, sorted by both."""
    word_hashers, runs = _hashers()
    w = textscan.words(column, word_hashers)
    begin, (h,) = textscan.windows(w, size, runs)
    doc = np.searchsorted(w.first, begin, side="right") - 1
    count = np.diff(w.first)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        whole = np.array([runs[0].spans(w.hashes[0][a:b], np.array([0]), np.array([b - a]))[0]
                          for a, b in zip(w.first[short], w.first[short + 1])], np.uint64)
        doc, h = np.concatenate([doc, short]), np.concatenate([h, whole])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[new], h[new]


def classes(doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, list[bytes | None]]:
    """(set size, 128-bit class or None for an empty set) of each document."""
    first = np.searchsorted(doc, np.arange(n + 1))
    size = np.diff(first)
    one = np.concatenate([[_U(0)], np.cumsum(textscan.mix(h), dtype=np.uint64)])
    two = np.concatenate([[_U(0)], np.cumsum(textscan.mix(h ^ _U(0xD6E8FEB86659FD93)), dtype=np.uint64)])
    a = textscan.mix((one[first[1:]] - one[first[:-1]]) ^ size.astype(np.uint64))
    b = textscan.mix(two[first[1:]] - two[first[:-1]])
    raw = np.stack([a, b], axis=1).astype("<u8").tobytes()
    return size, [raw[16 * d:16 * d + 16] if size[d] else None for d in range(n)]


# ---- bands -----------------------------------------------------------------

@lru_cache(maxsize=4)
def bands(largest: int) -> list[tuple[int, int]]:
    """(least, greatest) size of each band."""
    out, low = [], 1
    while low <= largest:
        high = max(low, low * 5 // 4)
        out.append((low, high))
        low = high + 1
    return out


def allowance(a, b):
    """Greatest number of elements in which linked sets of sizes a, b differ:
    100 * common >= 80 * union."""
    return (a + b) // 9


def segments(low: int, high: int) -> int:
    return int(np.ceil(SPARE * (allowance(high, high * 5 // 4) + 1)))


def entry_counts(sizes: np.ndarray) -> np.ndarray:
    """Entries that sets of these sizes send: by segment, and by element in
    bands that index deletions."""
    out = np.zeros(len(sizes), np.int64)
    if not len(sizes) or sizes.max() < 1:
        return out
    all_bands = bands(int(sizes.max()))
    lows = np.array([b[0] for b in all_bands], np.int64)
    m = np.array([segments(*b) for b in all_bands], np.int64)
    small = np.array([b[1] <= DELETION_SIZES for b in all_bands])
    own = np.searchsorted(lows, sizes, side="right") - 1
    reach = np.searchsorted(lows, -(-sizes * 4 // 5), side="right") - 1
    for step in range(int((own - reach).max()) + 1):
        band = np.maximum(own - step, 0)
        here = (own - step >= reach) & (sizes > 0)
        extra = np.where(small[band], m[band] + sizes * (2 if step == 0 else 1), 0)
        out += np.where(here, m[band] + extra, 0)
    return out


class Scheme:
    """The subsets of some sets in one band: sums of element hashes by
    (set, segment)."""

    def __init__(self, band: int, low: int, high: int, owner: np.ndarray, elements: np.ndarray, n: int):
        self.band, self.m, self.n = band, segments(low, high), n
        salt = textscan.mix(np.array([band + 1], np.uint64))[0]
        part = (textscan.mix(elements ^ salt) % _U(self.m)).astype(np.int64)
        self.cell = owner * self.m + part
        order = np.argsort(self.cell, kind="stable")
        self.cell, self.value = self.cell[order], textscan.mix(elements[order] + salt)
        self.sums = np.zeros(n * self.m, np.uint64)
        if len(order):
            at = np.flatnonzero(np.concatenate([[True], self.cell[1:] != self.cell[:-1]]))
            self.sums[self.cell[at]] = np.add.reduceat(self.value, at)
        self.cell_salt = textscan.mix(np.arange(self.m, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + salt)

    def keys(self, sums: np.ndarray, cell: np.ndarray, kind: int) -> np.ndarray:
        raw = textscan.mix((sums ^ self.cell_salt[cell % self.m]) + _U(kind))
        return raw >> _U(64 - KEY_BITS)

    def equal(self) -> np.ndarray:
        """Keys of the subsets, one per (set, segment), empty ones too."""
        return self.keys(self.sums, np.arange(self.n * self.m), _EQUAL)

    def equal_to_deletion(self) -> np.ndarray:
        """The subsets as deletions of others."""
        return self.keys(self.sums, np.arange(self.n * self.m), _DELETION)

    def deletions(self, kind: int) -> np.ndarray:
        """Keys of the subsets less one element, one per element."""
        return self.keys(self.sums[self.cell] - self.value, self.cell, kind)


class Block:
    """The classes a block owns, and the entries (keys) that they send."""

    def __init__(self, table: pa.Table, owned: set[bytes], size: int):
        table = blocks.ordered(table)
        doc, h = shingles(table["text"], size)
        sizes, digests = classes(doc, h, table.num_rows)
        first = np.searchsorted(doc, np.arange(table.num_rows + 1))
        seen: dict[bytes, int] = {}
        for d, c in enumerate(digests):
            if c is not None and c in owned and c not in seen:
                seen[c] = d
        rows = np.array(list(seen.values()), np.int64)
        self.digests = list(seen)
        self.sizes = sizes[rows] if len(rows) else np.zeros(0, np.int64)
        self.elements = [h[first[d]:first[d + 1]] for d in rows.tolist()]
        self.schemes = []  # (scheme, sets, indexes, small)
        top = int(self.sizes.max()) if len(rows) else 0
        all_bands = bands(top)
        lows = np.array([b[0] for b in all_bands], np.int64)
        own = np.searchsorted(lows, self.sizes, side="right") - 1
        reach = np.searchsorted(lows, -(-self.sizes * 4 // 5), side="right") - 1
        for k, (low, high) in enumerate(all_bands):
            for index in (True, False):
                sets = np.flatnonzero(own == k) if index else np.flatnonzero((reach <= k) & (own > k))
                if not len(sets):
                    continue
                values = np.concatenate([self.elements[i] for i in sets.tolist()])
                owner = np.repeat(np.arange(len(sets)), self.sizes[sets])
                self.schemes.append((Scheme(k, low, high, owner, values, len(sets)), sets, index, high <= DELETION_SIZES))

    def entries(self):
        """(keys, set of each, is an index entry) of all schemes, in a fixed
        order, and for each scheme the places of its parts in it."""
        keys, owner, index, places, at = [], [], [], [], 0

        def add(part: np.ndarray, sets: np.ndarray, flag: bool) -> slice:
            nonlocal at
            keys.append(part)
            owner.append(sets)
            index.append(np.full(len(part), flag))
            at += len(part)
            return slice(at - len(part), at)
        for scheme, sets, indexes, small in self.schemes:
            by_cell = np.repeat(sets, scheme.m)
            found = {"equal": add(scheme.equal(), by_cell, indexes)}
            if small:
                by_element = sets[scheme.cell // scheme.m]
                if indexes:
                    found["indexed"] = add(scheme.deletions(_DELETION), by_element, True)
                found["as_deletion"] = add(scheme.equal_to_deletion(), by_cell, False)
                found["deletions"] = add(scheme.deletions(_EQUAL), by_element, False)
            places.append(found)
        cat = lambda parts, t: np.concatenate(parts) if parts else np.zeros(0, t)
        return cat(keys, np.uint64), cat(owner, np.int64), cat(index, bool), places

    def picks(self, cost: np.ndarray, places: list[dict]) -> np.ndarray:
        """Places of the entries that are probed: each set spends its units
        on the cheapest segments of every scheme."""
        out = []
        for (scheme, sets, _, small), found in zip(self.schemes, places):
            high = bands(int(self.sizes.max()))[scheme.band][1]
            units = allowance(self.sizes[sets], np.minimum(high, self.sizes[sets])) + 1
            price = cost[found["equal"]].reshape(scheme.n, scheme.m).astype(np.int64)
            entry = np.arange(found["equal"].start, found["equal"].stop).reshape(scheme.n, scheme.m)
            busy = units > 1  # with no difference allowed only equal sets link, and they are one class
            if not small:
                order = np.argsort(price, axis=1, kind="stable")
                rank = np.empty_like(order)
                np.put_along_axis(rank, order, np.broadcast_to(np.arange(scheme.m), order.shape), axis=1)
                chosen = (rank < units[:, None]) & (price > 0) & busy[:, None]
                out.append(entry[chosen])
                continue
            second = cost[found["as_deletion"]].reshape(scheme.n, scheme.m).astype(np.int64)
            extra = np.bincount(scheme.cell, cost[found["deletions"]], scheme.n * scheme.m).reshape(scheme.n, scheme.m)
            wide = price + second + extra.astype(np.int64)
            by_cell = np.searchsorted(scheme.cell, np.arange(scheme.n * scheme.m + 1))
            for i in np.flatnonzero(busy).tolist():
                one, two = _allocate(price[i], wide[i], int(units[i]))
                out.append(entry[i, one])
                out.append(entry[i, two])
                out.append(found["as_deletion"].start + i * scheme.m + two)
                for s in two.tolist():
                    c = i * scheme.m + s
                    out.append(found["deletions"].start + np.arange(by_cell[c], by_cell[c + 1]))
        places_ = np.concatenate(out) if out else np.zeros(0, np.int64)
        return places_[cost[places_] > 0] if len(places_) else places_

    def can_link(self, shared: np.ndarray, places: list[dict]) -> np.ndarray:
        """Classes of which enough segments are shared for any partner."""
        out = np.zeros(len(self.sizes), dtype=bool)
        for (scheme, sets, _, small), found in zip(self.schemes, places):
            n = shared[found["equal"]].reshape(scheme.n, scheme.m).sum(axis=1)
            size = self.sizes[sets]
            out[sets] |= True if small else n >= scheme.m - allowance(size, size * 5 // 4)
        return out


def _allocate(one: np.ndarray, two: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray]:
    """Spend ``units`` on segments, one unit at price ``one`` or two at price
    ``two``: least total, by dynamic programming."""
    best = np.full(units + 1, np.inf)
    best[0] = 0
    choice = np.zeros((len(one), units + 1), np.int8)
    for s in range(len(one)):
        with_one = np.concatenate([[np.inf], best[:-1]]) + one[s]
        with_one[units] = min(with_one[units], best[units] + one[s])
        with_two = np.concatenate([[np.inf, np.inf], best[:-2]])[:units + 1] + two[s]
        with_two[units] = min(with_two[units], best[units - 1] + two[s] if units >= 1 else np.inf, best[units] + two[s])
        stack = np.stack([best, with_one, with_two])
        choice[s] = np.argmin(stack, axis=0)
        best = stack.min(axis=0)
    left, ones, twos = units, [], []
    for s in range(len(one) - 1, -1, -1):
        c = choice[s, left]
        if c:
            (ones if c == 1 else twos).append(s)
            left = max(0, left - int(c))
    return np.array(ones[::-1], np.int64), np.array(twos[::-1], np.int64)


# ---- what travels ----------------------------------------------------------

def _cut(keys: np.ndarray, n_shards: int) -> np.ndarray:
    shard = (keys * _U(n_shards)) >> _U(KEY_BITS)
    return np.searchsorted(shard, np.arange(n_shards + 1))


def _key_pieces(keys, owner, index, n_shards):
    """Keys in order, with the owner of each index entry."""
    order = np.argsort(keys, kind="stable")
    keys, owner, index = keys[order], owner[order], index[order]
    edges = _cut(keys, n_shards)
    for s in range(n_shards):
        a, b = edges[s], edges[s + 1]
        if b > a:
            own = owner[a:b][index[a:b]]
            yield s, blocks.pack(np.diff(keys[a:b], prepend=_U(0))) + blocks.pack_bits(index[a:b]) + blocks.pack(own.astype(np.uint32))


def _read_keys(body: bytes):
    deltas, at = blocks.unpack(body, np.uint64)
    index, at = blocks.unpack_bits(body, at)
    owner, _ = blocks.unpack(body, np.uint32, at)
    return np.cumsum(deltas, dtype=np.uint64), index, owner.astype(np.int64)


def _count_keys(bodies: list[bytes]) -> list[bytes]:
    """Answer each entry: bits of the number of other sets indexed under its
    key (0 to 15), plus 16 if any other entry has it."""
    read = [_read_keys(b)[:2] for b in bodies]
    keys = np.concatenate([k for k, _ in read])
    index = np.concatenate([i for _, i in read])
    _, inverse, total = np.unique(keys, return_inverse=True, return_counts=True)
    indexed = np.bincount(inverse, index, len(total))
    others = indexed[inverse] - index
    code = np.minimum(15, np.ceil(np.log2(others + 1))).astype(np.uint8) + np.where(total[inverse] > 1, 16, 0).astype(np.uint8)
    return [blocks.pack(c) for c in np.split(code, np.cumsum([len(k) for k, _ in read])[:-1])]


def _answers(replies: pa.Table, keys: np.ndarray) -> np.ndarray:
    rows = sorted((r["shard"], r["body"]) for r in replies.select(["shard", "body"]).to_pylist())
    sorted_codes = np.concatenate([blocks.unpack(b, np.uint8)[0] for _, b in rows]) if rows else np.zeros(0, np.uint8)
    out = np.empty(len(keys), np.uint8)
    out[np.argsort(keys, kind="stable")] = sorted_codes
    return out


_ROW = "kind int, shard int, block int, a bigint, b bigint, body binary"
_PICKS, _SET, _PAIR, _GROUP = 0, 1, 2, 3


def _rows(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [()] * 6
    types = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("kind", "shard", "block", "a", "b", "body"), cols, types)})


def _code(block, index):
    """A class's number: its block and its place there."""
    return (np.int64(block) << 32) | index


def pack_set(h: np.ndarray) -> bytes:
    return blocks.pack(np.diff(h, prepend=_U(0)))


def unpack_set(body: bytes) -> np.ndarray:
    return np.cumsum(blocks.unpack(body, np.uint64)[0], dtype=np.uint64)


def _pairs_of_shard(bodies, body_blocks, picks, pick_blocks) -> pa.Table:
    """Candidates of a key range: pairs to verify now, and groups of which
    more pairs may be needed later."""
    keys, code = [], []
    for body, block in zip(bodies, body_blocks):
        k, index, owner = _read_keys(body)
        keys.append(k[index])
        code.append(_code(block, owner))
    if not picks or not keys:
        return _rows([])
    ik, ic = np.concatenate(keys), np.concatenate(code)
    order = np.lexsort((ic, ik))
    ik, ic = ik[order], ic[order]
    pk, pc, pw = [], [], []
    for body, block in zip(picks, pick_blocks):
        deltas, at = blocks.unpack(body, np.uint64)
        owner, at = blocks.unpack(body, np.uint32, at)
        weight, _ = blocks.unpack(body, np.uint32, at)
        pk.append(np.cumsum(deltas, dtype=np.uint64))
        pc.append(_code(block, owner.astype(np.int64)))
        pw.append(weight.astype(np.int64))
    pk, pc, pw = np.concatenate(pk), np.concatenate(pc), np.concatenate(pw)
    order = np.lexsort((pc, -pw, pk))  # of each key the most connected set comes first
    pk, pc = pk[order], pc[order]
    start = np.flatnonzero(np.concatenate([[True], pk[1:] != pk[:-1]]))
    stop = np.append(start[1:], len(pk))
    lo, hi = np.searchsorted(ik, pk[start]), np.searchsorted(ik, pk[start], side="right")
    pairs, held, groups = [], 0, {}
    for s, e, a, b in zip(start.tolist(), stop.tolist(), lo.tolist(), hi.tolist()):
        probes, members = pc[s:e], ic[a:b]
        centre = probes[0]
        if (e - s) * (b - a) <= ALL_PAIRS:
            left, right = np.repeat(probes, b - a), np.tile(members, e - s)
        else:
            left = np.union1d(probes, members)
            right = np.full(len(left), centre)
            if e - s > 1:
                body = np.unique(probes).tobytes(), np.unique(members).tobytes()
                groups[int(centre), body] = None
        pairs.append(np.stack([left, right])[:, left != right])
        held += len(left)
        if held > PAIR_ROWS:  # groups of one family repeat each other's pairs
            pairs = [_distinct(pairs)]
            held = pairs[0].shape[1]
    both = _distinct(pairs)
    n = both.shape[1]
    zero = np.zeros(n, np.int32)
    found = pa.table([pa.array(np.full(n, _PAIR, np.int32)), pa.array(zero), pa.array(zero), pa.array(both[0]), pa.array(both[1]),
                      pa.nulls(n, pa.binary())], names=["kind", "shard", "block", "a", "b", "body"])
    more = [(_GROUP, len(probes) // 8, 0, centre, 0, probes + members) for centre, (probes, members) in groups]
    return pa.concat_tables([found, _rows(more)])


def _distinct(pairs: list[np.ndarray]) -> np.ndarray:
    """The distinct columns of (2, n) arrays."""
    both = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
    both = both[:, np.lexsort(both)]
    new = np.ones(both.shape[1], bool)
    new[1:] = (both[:, 1:] != both[:, :-1]).any(0)
    return both[:, new]


# ---- verification ----------------------------------------------------------

def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b) -> (a, b, common, size_a, size_b). Each a's set moves to
    its b once; a b with many partners is spread over several groups."""
    pairs = pairs.select("a", "b", F.pmod(F.xxhash64("a"), F.lit(1 << 20)).alias("h"))
    degree = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    spread = pairs.join(degree, "b").withColumn("salt", F.expr(f"cast(h % cast(ceil(n / {SALT_ROWS}) as bigint) as int)"))
    members = spread.join(sets, spread["a"] == sets["code"]).select("b", "salt", F.col("a").alias("code"), "size", "body")
    centres = spread.select("b", "salt").distinct().join(sets, F.col("b") == F.col("code")).select("b", "salt", "code", "size", "body")

    def compare(table: pa.Table) -> pa.Table:
        code, centre = table["code"].to_numpy(), table["b"][0].as_py()
        size, bodies = table["size"].to_numpy(), table["body"].to_pylist()
        mine = np.flatnonzero(code == centre)
        others = np.flatnonzero(code != centre)
        if not len(mine):  # the centre cannot link with anything
            others = others[:0]
        common = np.zeros(len(others), np.int64)
        if len(others):
            own = unpack_set(bodies[mine[0]])
            for k, i in enumerate(others.tolist()):
                h = unpack_set(bodies[i])
                at = np.minimum(np.searchsorted(own, h), len(own) - 1)
                common[k] = int((own[at] == h).sum())
        own_size = int(size[mine[0]]) if len(mine) else 0
        return pa.table({"a": pa.array(code[others], pa.int64()), "b": pa.array(np.full(len(others), centre), pa.int64()),
                         "common": pa.array(common), "size_a": pa.array(size[others], pa.int64()),
                         "size_b": pa.array(np.full(len(others), own_size), pa.int64())})
    return members.unionByName(centres).groupBy("b", "salt").applyInArrow(
        compare, "a bigint, b bigint, common bigint, size_a bigint, size_b bigint")


_LINKED = "100 * common >= 80 * (size_a + size_b - common)"


def _group_links(groups: DataFrame, able: DataFrame) -> DataFrame:
    """(a, b): every member of a large group that can link at all, and the
    least such member of the group."""
    def spread(batches):
        for batch in batches:
            for row in batch.to_pylist():
                codes = np.unique(np.frombuffer(row["body"], np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), row["gid"])), pa.array(codes)], names=["gid", "code"])
    keyed = groups.select(F.xxhash64("a", "body").alias("gid"), "body").distinct()
    rows = keyed.mapInArrow(spread, "gid bigint, code bigint").join(able, "code", "left_semi")
    least = rows.groupBy("gid").agg(F.min("code").alias("b"))
    return rows.join(least, "gid").where("code <> b").select(F.col("code").alias("a"), "b").distinct()


def _family_links(families: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components within families, the sets that large groups
    connect: (node, root of the family). A family is cut into chunks of
    CHUNK members, and every two chunks meet in one group, which compares
    their sets through the shingles they share and returns at most one link
    for each two components: no pairs are made."""
    members = families.join(sets, F.col("node") == F.col("code")).join(roots.withColumnRenamed("root", "component"), "node", "left")
    members = members.select("code", F.col("root").alias("family"), F.coalesce("component", "code").alias("component"), "size", "body")
    sizes = members.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("x"), F.max("component").alias("y"))
    sizes = sizes.where("x <> y").select("family", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    rows = members.join(sizes, "family").withColumn("own", F.pmod(F.xxhash64("code"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("family", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "code", "component", "size", "body")

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("code")
        code, size = table["code"].to_numpy(), table["size"].to_numpy()
        _, component = np.unique(table["component"].to_numpy(), return_inverse=True)
        elements = [unpack_set(b) for b in table["body"].to_pylist()]
        owner = np.repeat(np.arange(len(code)), [len(e) for e in elements])
        _, shingle = np.unique(np.concatenate(elements), return_inverse=True)
        order = np.argsort(shingle, kind="stable")
        holders, first = owner[order], np.searchsorted(shingle[order], np.arange(int(shingle.max()) + 2))
        ends = np.cumsum(size)
        merged = list(range(int(component.max()) + 1))

        def root(x: int) -> int:
            while merged[x] != x:
                merged[x] = merged[merged[x]]
                x = merged[x]
            return x
        a, b = [], []
        for i in range(1, len(code)):
            own = shingle[ends[i] - size[i]:ends[i]]
            n = first[own + 1] - first[own]
            common = np.bincount(holders[np.repeat(first[own] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))], minlength=len(code))[:i]
            for j in np.flatnonzero(100 * common >= 80 * (size[:i] + size[i] - common)).tolist():
                x, y = root(component[i]), root(component[j])
                if x != y:
                    merged[x] = y
                    a.append(code[i])
                    b.append(code[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return rows.groupBy("family", "low", "high").applyInArrow(compare, "a bigint, b bigint")


# ---- the operator ----------------------------------------------------------

def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE,
                    block_bytes: int = BLOCK_BYTES, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    id_type = dict(docs.dtypes)[doc_id]
    folder = shared_path(spark, "ngram_join", unique=True)

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    deal = F.xxhash64("doc_id", "text").alias("deal")
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def describe(batches):
        for batch in batches:
            column = batch.column("text")
            lengths = np.diff(textscan.utf8(column)[1])
            for i, j in textscan.slices(np.concatenate([[0], np.cumsum(lengths)])):
                doc, h = shingles(column.slice(i, j - i), size)
                n, digest = classes(doc, h, j - i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("deal").slice(i, j - i), batch.column("doc_id").slice(i, j - i), pa.array(n, pa.int64()),
                     pa.array(entry_counts(n)), pa.array(digest, pa.binary())], names=["deal", "doc_id", "n_shingles", "entries", "class"])

    described = stored(plain.select(deal, "doc_id", "text").mapInArrow(
        describe, f"deal bigint, doc_id {id_type}, n_shingles bigint, entries bigint, class binary"), "documents")
    rows, n_bytes = blocks.volume(docs, text)
    entries = described.where("class is not null").groupBy("class").agg(F.max("entries").alias("n")).agg(F.sum("n")).first()[0] or 0
    n_blocks = max(blocks.block_count(n_bytes, rows, block_bytes), -(-entries // block_entries))
    block = F.pmod(F.col("deal"), F.lit(n_blocks)).cast("int")
    owners = described.where("class is not null").groupBy("class").agg(F.min(block).alias("block"))
    dealt = blocks.dealt(docs, doc_id, text, n_blocks)
    owned = owners.select("block", "class")

    def own(table: pa.Table) -> set:
        return set(table["class"].to_pylist()) if table.num_rows else set()

    def send(table: pa.Table, mine: pa.Table) -> pa.Table:
        if not table.num_rows or not mine.num_rows:
            return pa.table({"shard": pa.array([], pa.int32()), "block": pa.array([], pa.int32()), "body": pa.array([], pa.binary())})
        keys, owner, index, _ = Block(table, own(mine), size).entries()
        out = list(_key_pieces(keys, owner, index, n_blocks))
        return pa.table({"shard": pa.array([s for s, _ in out], pa.int32()),
                         "block": pa.array([table["block"][0].as_py()] * len(out), pa.int32()),
                         "body": pa.array([b for _, b in out], pa.binary())})

    pieces = dealt.groupBy("block").cogroup(owned.groupBy("block")).applyInArrow(send, blocks.PIECE).repartition(n_blocks, "shard")
    counts = blocks.merged(pieces, _count_keys, 0)
    # what a block needs for its picks: the classes it owns and its answers
    told = counts.select("block", "shard", "body", F.lit(None).cast("binary").alias("class")).unionByName(
        owned.select("block", F.lit(None).cast("int").alias("shard"), F.lit(None).cast("binary").alias("body"), "class"))

    def pick(table: pa.Table, replies: pa.Table) -> pa.Table:
        import pyarrow.compute as pc
        if not table.num_rows or not replies.num_rows:
            return _rows([])
        number = table["block"][0].as_py()
        held = Block(table, own(replies.filter(pc.is_valid(replies["class"]))), size)
        keys, owner, _, places = held.entries()
        code = _answers(replies.filter(pc.is_valid(replies["body"])), keys)
        cost = (np.int64(1) << (code & 15).astype(np.int64)) - 1
        able = held.can_link(code >= 16, places)
        chosen = np.unique(held.picks(cost, places))
        chosen = chosen[able[owner[chosen]]]
        weight = np.bincount(owner, np.minimum(cost, 1 << 15), len(held.sizes)) if len(keys) else np.zeros(0)
        out = []
        order = chosen[np.argsort(keys[chosen], kind="stable")]
        pk, po = keys[order], owner[order]
        edges = _cut(pk, n_blocks)
        for s in range(n_blocks):
            a, b = edges[s], edges[s + 1]
            if b > a:
                w = np.minimum(weight[po[a:b]], 2**32 - 1).astype(np.uint32)
                out.append((_PICKS, s, number, 0, 0, blocks.pack(np.diff(pk[a:b], prepend=_U(0)))
                            + blocks.pack(po[a:b].astype(np.uint32)) + blocks.pack(w)))
        for i in np.flatnonzero(able).tolist():
            out.append((_SET, (number + i) % n_blocks, number, int(_code(number, i)), int(held.sizes[i]),
                        held.digests[i] + pack_set(held.elements[i])))
        return _rows(out)

    picked = dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(pick, _ROW).repartition(n_blocks, "shard")

    def match(entries: pa.Table, told: pa.Table) -> pa.Table:
        import pyarrow.compute as pc
        sets = told.filter(pc.equal(told["kind"], _SET))
        picks = told.filter(pc.equal(told["kind"], _PICKS)).sort_by("block")
        if not entries.num_rows or not picks.num_rows:
            return sets
        entries = entries.sort_by("block")
        found = _pairs_of_shard(entries["body"].to_pylist(), entries["block"].to_pylist(), picks["body"].to_pylist(), picks["block"].to_pylist())
        return pa.concat_tables([sets.cast(found.schema), found])

    found = stored(pieces.groupBy("shard").cogroup(picked.groupBy("shard")).applyInArrow(match, _ROW), "candidates")
    sets = found.where(F.col("kind") == _SET).select(F.col("a").alias("code"), F.col("b").alias("size"),
                                                     F.expr("substring(body, 17)").alias("body"))
    names = found.where(F.col("kind") == _SET).select(F.col("a").alias("code"), F.expr("substring(body, 1, 16)").alias("class"))
    pairs = found.where(F.col("kind") == _PAIR).select("a", "b").distinct()
    first = stored(verified(pairs, sets), "first")
    links = first.where(_LINKED).select("a", "b")
    roots = components(links)
    near = _group_links(found.where(F.col("kind") == _GROUP), sets.select("code"))
    more = stored(_family_links(components(near), roots, sets), "more")
    roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))

    least = described.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"))
    linked = names.join(roots, F.col("code") == F.col("node")).select("class", "root").join(least, "class")
    joint = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = least.join(linked.select("class", "root"), "class", "left").join(joint, "root", "left").select(
        "class", F.coalesce("component_id", "least").alias("component_id"))
    settled = described.join(by_class, "class", "left")
    return settled.select("doc_id", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def first_of_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each id that is the least of its component, all
    columns; of several rows with that id one stays. Rows without an id stay.
    Documents without words are alone in their components."""
    held = docs.withColumn("__text", F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))
    least = near_duplicates(docs, doc_id, text).where("doc_id = component_id").select(F.col("doc_id").alias("__kept")).distinct()
    kept = held.where(F.col(doc_id).isNotNull()).join(least, F.col(doc_id) == F.col("__kept"), "left_semi")
    # ids are few rows each: the window is over one id's rows only
    place = F.row_number().over(Window.partitionBy(doc_id).orderBy("__text"))
    kept = kept.withColumn("__place", place).where("__place = 1").drop("__place", "__text")
    return kept.unionByName(docs.where(F.col(doc_id).isNull()))
