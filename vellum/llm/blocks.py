"""Documents dealt to blocks, and filters that are merged by hash range.

Two operators (substring and line dedup) work the same way: documents are
dealt once to blocks of a few MB (one exchange of the texts, which Spark
reuses for every pass); each block sends the sorted bit or cell positions of
its keys, cut by position range ("shard"), as compressed pieces of one to two
bytes a key; a shard merges the pieces of all blocks into its range of the
filter and answers every piece with one bit a position. No filter is ever
held whole anywhere, so its size may grow with the corpus, and a key that a
third of all rows hold costs two positions a block at most.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_CODEC = "zstd"

PIECE = "shard int, block int, body binary"
REPLY = "block int, kind int, shard int, body binary"


def pack(planes: np.ndarray) -> bytes:
    """Integers as byte planes, compressed; the length goes in front."""
    a = np.ascontiguousarray(planes)
    raw = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if len(a) else b""
    body = pa.compress(raw, codec=_CODEC, asbytes=True)
    return len(a).to_bytes(8, "little") + len(body).to_bytes(8, "little") + body


def unpack(blob: bytes, dtype, at: int = 0) -> tuple[np.ndarray, int]:
    n, size = (int.from_bytes(blob[at + k:at + k + 8], "little") for k in (0, 8))
    item = np.dtype(dtype).itemsize
    raw = pa.decompress(blob[at + 16:at + 16 + size], decompressed_size=n * item, codec=_CODEC, asbytes=True) if n else b""
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(item, n) if n else np.zeros((item, 0), np.uint8)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype), at + 16 + size


def pack_bits(bits: np.ndarray) -> bytes:
    return len(bits).to_bytes(8, "little") + pack(np.packbits(bits))


def unpack_bits(blob: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    n = int.from_bytes(blob[at:at + 8], "little")
    raw, end = unpack(blob, np.uint8, at + 8)
    return np.unpackbits(raw, count=n).astype(bool), end


def volume(docs: DataFrame, text: str) -> tuple[int, int]:
    """(rows, UTF-8 bytes) of a text column: one aggregate, two numbers."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(text))).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def block_count(n_bytes: int, n_rows: int, block_bytes: int) -> int:
    return max(1, math.ceil(n_bytes / block_bytes), math.ceil(n_rows / 50_000))


def dealt(docs: DataFrame, doc_id: str, text: str, n_blocks: int, carry: list[str] = ()) -> DataFrame:
    """(block, doc_id, text) and, as __x0, __x1, ..., the columns to carry, dealt by a hash of id and text: rows without an
    id spread too, and a null text becomes empty. The exchange is stated here
    so that all passes over one returned frame share it."""
    extra = [f"__x{k}" for k in range(len(carry))]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       *(F.col(f"`{c}`").alias(x) for c, x in zip(carry, extra)))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int")
    return rows.select(block.alias("block"), "doc_id", "text", *extra).repartition(n_blocks, "block")


def ordered(table: pa.Table) -> pa.Table:
    """A block's rows in one order in every pass."""
    if table.num_rows < 2:
        return table
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


class Filter:
    """Positions of one filter, cut into shards of ``width`` positions."""

    def __init__(self, n_positions: int, n_shards: int):
        self.width = max(64, math.ceil(n_positions / n_shards))
        self.n_shards = n_shards
        self.size = np.uint64(self.width * n_shards)

    def positions(self, keys: np.ndarray) -> np.ndarray:
        return (keys % self.size).astype(np.int64)

    def pieces(self, positions: np.ndarray, twice: np.ndarray):
        """(shard, body) for the distinct sorted positions of a block;
        ``twice`` marks those that this block alone has seen twice."""
        edges = np.searchsorted(positions, np.arange(self.n_shards + 1) * self.width)
        for s in range(self.n_shards):
            a, b = edges[s], edges[s + 1]
            if b > a:
                deltas = np.diff(positions[a:b], prepend=s * self.width).astype(np.uint32)
                yield s, pack(deltas) + pack_bits(twice[a:b])

    def merge(self, bodies: list[bytes]) -> list[bytes]:
        """Answer each piece: a bit a position, true if the merged filter has
        seen it at least twice."""
        once = np.zeros(self.width, dtype=bool)
        again = np.zeros(self.width, dtype=bool)
        for body in bodies:
            at, twice = self._read(body)
            again[at[once[at] | twice]] = True
            once[at] = True
        return [pack_bits(again[self._read(body)[0]]) for body in bodies]

    def _read(self, body: bytes) -> tuple[np.ndarray, np.ndarray]:
        deltas, end = unpack(body, np.uint32)
        twice, _ = unpack_bits(body, end)
        return np.cumsum(deltas, dtype=np.int64), twice


def merged(pieces: DataFrame, merge, kind: int) -> DataFrame:
    """Group pieces by shard, merge, and address each answer to its block."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        answers = merge(table["body"].to_pylist())
        return pa.table({"block": table["block"].combine_chunks(),
                         "kind": pa.array(np.full(table.num_rows, kind, np.int32)),
                         "shard": table["shard"].combine_chunks(),
                         "body": pa.array(answers, pa.binary())})
    return pieces.groupBy("shard").applyInArrow(run, REPLY)


def answer(replies: pa.Table, kind: int) -> np.ndarray:
    """A block's answers of one kind, in ascending position order."""
    if not replies.num_rows:
        return np.zeros(0, dtype=bool)
    rows = sorted((r["shard"], r["body"]) for r in replies.select(["kind", "shard", "body"]).to_pylist() if r["kind"] == kind)
    parts = [unpack_bits(body)[0] for _, body in rows]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=bool)
