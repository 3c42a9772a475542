"""Best-fit packing of token sequences with a grouping genetic algorithm.

A document's ids (with an end id) are cut into pieces of ``capacity`` only
where they are longer; its first piece may be shorter and is the item to
pack, later pieces fill a sequence each. Items are dealt to shards of some
thousand; each shard is evolved on several islands. An individual is a
grouping of the shard's items into bins; crossover injects whole well-filled
bins of one parent into the other, removes the bins that hold duplicates, and
best-fits the displaced documents; after each epoch an island's elite moves to
the next island of its shard (one small exchange). Bins that stay poorly
filled are taken apart, and their items are dealt anew to as many shards as
their number needs, so that shards do not each leave a rest and none grows
with the input; when that no longer saves bins, they stay as they are.

Defined results: a null or empty text is one piece, the end id; every piece
of every row is placed once, also of repeated rows and null ids; an empty
table gives an empty result; other columns are not read. The search is seeded
by the shard, so a retried task makes the same bins.
"""

from __future__ import annotations

import math
import random
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from vellum.llm import chunk_tokens
from vellum.session import shared_path

CAPACITY = 1024
SHARD_ITEMS = 2048
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 3
POPULATION = 4
WELL_FILLED = 0.995
LEAST_SAVED = 0.01  # a level that saves a smaller share of the bins it took apart is the last
MAX_LEVELS = 100  # the level is one byte of sequence_id

PIECES = "doc_id {id}, item bigint, piece int, start bigint, length bigint, ids_crc32 bigint, own_sequence bigint"


def token_pieces(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
                 capacity: int = CAPACITY) -> DataFrame:
    """One row per piece. ``item`` numbers the rows of ``docs``."""
    id_type = dict(docs.dtypes)[doc_id]

    def cut(batches):
        encoder = chunk_tokens.byte_encoder(vocabulary)
        item = full = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids_of = batch.column("doc_id")
            for first, bounds, ids in encoder.batches(batch.column("text")):
                rows = []
                for d in range(len(bounds) - 1):
                    own = np.append(ids[bounds[d]:bounds[d + 1]], chunk_tokens.END_ID).astype("<u4")
                    n = len(own)
                    edge = n - capacity * (math.ceil(n / capacity) - 1)
                    start, piece = 0, 0
                    while start < n:
                        alone = edge - start == capacity  # a sequence of its own, numbered below zero
                        full += alone
                        rows.append((first + d, item, piece, start, edge - start, zlib.crc32(own[start:edge].tobytes()),
                                     -full - 1 if alone else None))
                        start, edge, piece = edge, edge + capacity, piece + 1
                    item += 1
                where, *cols = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [ids_of.take(pa.array(where))]
                    + [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["doc_id", "item", "piece", "start", "length", "ids_crc32", "own_sequence"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(cut, PIECES.format(id=id_type))


class OpenBins:
    """Bins by room left; ``take`` finds the fullest that an item fits in."""

    def __init__(self, capacity: int):
        self.rooms = 0  # bit r: some bin has room r
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, number: int, room: int) -> None:
        if room:
            self.by_room[room].append(number)
            self.rooms |= 1 << room

    def take(self, length: int):
        above = self.rooms >> length
        if not above:
            return None
        room = length + (above & -above).bit_length() - 1
        bins = self.by_room[room]
        number = bins.pop()
        if not bins:
            self.rooms &= ~(1 << room)
        return number, room


def best_fit(order, lengths, bins: list[list[int]], fills: list[int], capacity: int) -> None:
    """Place items, in the given order, into the fullest bin that has room."""
    open_bins = OpenBins(capacity)
    for number, fill in enumerate(fills):
        open_bins.add(number, capacity - fill)
    for item in order:
        length = lengths[item]
        found = open_bins.take(length)
        if found is None:
            number, room = len(bins), capacity
            bins.append([])
            fills.append(0)
        else:
            number, room = found
        bins[number].append(item)
        fills[number] += length
        open_bins.add(number, room - length)


def crossover(giver, taker, lengths, capacity: int, rng: random.Random):
    """Inject well-filled bins of ``giver`` into ``taker``."""
    bins, fills = giver
    good = [b for b, fill in zip(bins, fills) if fill >= WELL_FILLED * capacity]
    if not good:
        return taker
    injected = rng.sample(good, max(1, int(len(good) * rng.uniform(0.2, 0.6))))
    moved = {item for b in injected for item in b}
    new_bins, new_fills, displaced = [list(b) for b in injected], [sum(lengths[i] for i in b) for b in injected], []
    for b, fill in zip(*taker):
        if moved.isdisjoint(b):
            new_bins.append(list(b))
            new_fills.append(fill)
        else:
            displaced.extend(i for i in b if i not in moved)
    displaced.sort(key=lengths.__getitem__, reverse=True)
    best_fit(displaced, lengths, new_bins, new_fills, capacity)
    return new_bins, new_fills


def mutate(parent, lengths, capacity: int, rng: random.Random):
    """Take the emptiest bins and a few others apart, best-fit their items."""
    bins, fills = parent
    order = sorted(range(len(bins)), key=fills.__getitem__)
    gone = set(order[:max(1, len(order) // 20)]) | set(rng.sample(order, max(1, len(order) // 20)))
    new_bins = [list(b) for k, b in enumerate(bins) if k not in gone]
    new_fills = [f for k, f in enumerate(fills) if k not in gone]
    displaced = [i for k in gone for i in bins[k]]
    displaced.sort(key=lambda i: lengths[i] * rng.uniform(0.9, 1.1), reverse=True)
    best_fit(displaced, lengths, new_bins, new_fills, capacity)
    return new_bins, new_fills


def fitness(individual, capacity: int) -> tuple:
    """Fewer bins first, then bins that are full or nearly empty."""
    _, fills = individual
    return -len(fills), sum(f * f for f in fills)


def _flat(individual, n: int) -> bytes:
    out = np.zeros(n, np.int32)
    for number, b in enumerate(individual[0]):
        out[b] = number
    return out.tobytes()


def _grouped(flat: bytes, lengths):
    numbers = np.frombuffer(flat, np.int32)
    bins: list[list[int]] = [[] for _ in range(int(numbers.max()) + 1 if len(numbers) else 0)]
    for item, number in enumerate(numbers.tolist()):
        bins[number].append(item)
    return bins, [sum(lengths[i] for i in b) for b in bins]


def _start(lengths, capacity: int, rng: random.Random, size: int):
    out = []
    for k in range(size):
        noise = 0.0 if k == 0 else 0.3 * k / size
        order = sorted(range(len(lengths)), key=lambda i: lengths[i] * rng.uniform(1 - noise, 1 + noise), reverse=True)
        bins, fills = [], []
        best_fit(order, lengths, bins, fills, capacity)
        out.append((bins, fills))
    return out


def evolve(population, lengths, capacity: int, rng: random.Random, generations: int):
    """Elitist generations; stops when the lower bound is met."""
    bound = math.ceil(sum(lengths) / capacity)
    rank = lambda x: fitness(x, capacity)
    population.sort(key=rank, reverse=True)
    for _ in range(generations):
        if len(population[0][0]) <= bound:
            break
        a, b = population[0], rng.choice(population[1:] or population)
        children = [crossover(a, b, lengths, capacity, rng), crossover(b, a, lengths, capacity, rng),
                    mutate(a, lengths, capacity, rng)]
        size = len(population)
        population = sorted(population + children, key=rank, reverse=True)[:size]
    return population


_STATE = "level int, shard bigint, island int, items binary, lengths binary, individual binary"


def _pack_level(items: DataFrame, level: int, capacity: int) -> DataFrame:
    """items: (shard, item, length) -> (shard, item, bin, at, fill)."""
    def begin(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("item", "ascending")])
        shard = table["shard"][0].as_py()
        items, lengths = table["item"].to_numpy(), table["length"].to_numpy().astype(np.int32)
        rows = []
        for island in range(ISLANDS):
            rng = random.Random(f"{level}/{shard}/{island}")
            best = evolve(_start(lengths.tolist(), capacity, rng, POPULATION), lengths.tolist(), capacity, rng, GENERATIONS)
            rows += [(island, _flat(p, len(items))) for p in best]
            rows.append(((island + 1) % ISLANDS, _flat(best[0], len(items))))  # the elite moves on
        return pa.table({"level": pa.array([level] * len(rows), pa.int32()), "shard": pa.array([shard] * len(rows), pa.int64()),
                         "island": pa.array([r[0] for r in rows], pa.int32()),
                         "items": pa.array([items.tobytes()] * len(rows), pa.binary()),
                         "lengths": pa.array([lengths.tobytes()] * len(rows), pa.binary()),
                         "individual": pa.array([r[1] for r in rows], pa.binary())})

    def epoch(number: int):
        def run(table: pa.Table) -> pa.Table:
            shard, island = table["shard"][0].as_py(), table["island"][0].as_py()
            items, lengths = table["items"][0].as_py(), table["lengths"][0].as_py()
            sizes = np.frombuffer(lengths, np.int32).tolist()
            rng = random.Random(f"{level}/{shard}/{island}/{number}")
            population = [_grouped(f, sizes) for f in sorted(set(table["individual"].to_pylist()))]
            best = evolve(population, sizes, capacity, rng, GENERATIONS)[:POPULATION]
            rows = [(island, p) for p in best] + [((island + 1) % ISLANDS, best[0])]
            return pa.table({"level": pa.array([level] * len(rows), pa.int32()), "shard": pa.array([shard] * len(rows), pa.int64()),
                             "island": pa.array([r[0] for r in rows], pa.int32()),
                             "items": pa.array([items] * len(rows), pa.binary()),
                             "lengths": pa.array([lengths] * len(rows), pa.binary()),
                             "individual": pa.array([_flat(r[1], len(sizes)) for r in rows], pa.binary())})
        return run

    def finish(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        items = np.frombuffer(table["items"][0].as_py(), np.int64)
        sizes = np.frombuffer(table["lengths"][0].as_py(), np.int32).tolist()
        best = max((_grouped(f, sizes) for f in sorted(set(table["individual"].to_pylist()))), key=lambda x: fitness(x, capacity))
        rows = []
        for number, (b, fill) in enumerate(zip(*best)):
            at = 0
            for i in b:
                rows.append((int(items[i]), sizes[i], number, at, fill))
                at += sizes[i]
        cols = list(zip(*rows))
        return pa.table({"shard": pa.array([shard] * len(rows), pa.int64()), "item": pa.array(cols[0], pa.int64()),
                         "length": pa.array(cols[1], pa.int64()), "bin": pa.array(cols[2], pa.int64()),
                         "at": pa.array(cols[3], pa.int64()), "fill": pa.array(cols[4], pa.int64())})

    state = items.groupBy("shard").applyInArrow(begin, _STATE)
    for number in range(1, EPOCHS):
        state = state.groupBy("shard", "island").applyInArrow(epoch(number), _STATE)
    return state.groupBy("shard").applyInArrow(finish, "shard bigint, item bigint, length bigint, bin bigint, at bigint, fill bigint")


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """Place the pieces of :func:`token_pieces` (a stored table): adds
    sequence_id and offset."""
    spark = pieces.sparkSession
    own = pieces.where(F.col("own_sequence").isNotNull()).select(
        "item", "piece", F.col("own_sequence").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    items = pieces.where(F.col("own_sequence").isNull()).select("item", "length")
    n, bins, kept, placed = items.count(), None, None, own
    for level in range(MAX_LEVELS):
        shards = max(1, math.ceil(n / shard_items))
        path = shared_path(spark, "packing", f"level{level}", unique=True)
        # dealt anew at each level: a hash of the item mixes all lengths in every shard
        dealt = items.select(F.pmod(F.xxhash64("item", F.lit(level)), F.lit(shards)).alias("shard"), "item", "length")
        _pack_level(dealt, level, capacity).write.parquet(path)
        packed = spark.read.parquet(path)
        poor = F.col("fill") < F.lit(math.floor(WELL_FILLED * capacity))
        total, left, left_bins = packed.agg(F.count_if(F.col("at") == 0), F.count_if(poor),
                                            F.count_if(poor & (F.col("at") == 0))).first()
        if bins is not None and total >= bins:
            placed = placed.unionByName(kept)  # no bin saved: they stay as the level before made them
            break
        rows = packed.select("item", F.lit(0).alias("piece"),
                             (F.lit(level) * F.lit(1 << 56) + F.col("shard") * F.lit(1 << 24) + F.col("bin")).alias("sequence_id"),
                             F.col("at").alias("offset"), poor.alias("poor"))
        saves = bins is None or bins - total >= LEAST_SAVED * bins
        if shards == 1 or left == 0 or not saves or level == MAX_LEVELS - 1:
            placed = placed.unionByName(rows.drop("poor"))
            break
        placed = placed.unionByName(rows.where(~F.col("poor")).drop("poor"))
        kept = rows.where("poor").drop("poor")
        items, n, bins = packed.where(poor).select("item", "length"), left, left_bins
    return pieces.join(placed, ["item", "piece"])


def pack_documents(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
                   capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset."""
    spark = docs.sparkSession
    path = shared_path(spark, "packing", "pieces", unique=True)
    token_pieces(docs, vocabulary, doc_id, text, capacity).write.parquet(path)
    return pack_pieces(spark.read.parquet(path), capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
