"""Substring dedup: words covered by a repeated window of words are removed.

Method: a Count-min prefilter. Every block of documents counts its windows in
a sketch (``depth`` rows, counters that saturate at two); the partial sketches
are merged by counter range, and each block learns which of its windows the
merged sketch estimates at two or more. Counters never underestimate, so no
repeated window is lost. A second pass groups exactly (128-bit hashes of the
word sequence) only the windows estimated repeated. See ``blocks.py`` for how
pieces travel.

Defined results: a null text has no words; a document shorter than the window
keeps everything; repeated rows (same id, same text) count as different
places, so their common windows are removed from both; a null id is kept as
null; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vellum.llm import blocks, textscan

WINDOW = 35
BLOCK_BYTES = 8 << 20
CELLS_PER_BYTE = 1.0
DEPTH = 2
_KINDS = 100  # kind of the exact pass; sketch rows are kinds 0..depth-1


@lru_cache(maxsize=4)
def _hashers(seed: int, n: int = 2) -> list[textscan.SpanHasher]:
    return [textscan.SpanHasher(seed + k) for k in range(n)]


def _scan(table: pa.Table, window: int):
    table = blocks.ordered(table)
    w = textscan.words(table["text"], _hashers(11))
    begin, (h1, h2) = textscan.windows(w, window, _hashers(23))
    return table, w, begin, h1, h2


def _row_key(h1: np.ndarray, row: int) -> np.ndarray:
    return textscan.mix(h1 ^ np.uint64(0x9E3779B97F4A7C15 * (row + 1) % 2**64))


def _repeated(sketch: blocks.Filter, h1: np.ndarray, replies: pa.Table, depth: int) -> np.ndarray:
    """Windows that all rows of the merged sketch count twice or more."""
    out = np.ones(len(h1), dtype=bool)
    for row in range(depth):
        _, inverse = np.unique(sketch.positions(_row_key(h1, row)), return_inverse=True)
        bits = blocks.answer(replies, row)
        out &= bits[inverse] if len(bits) else False
    return out


def _distinct(h1: np.ndarray, h2: np.ndarray):
    """Distinct 128-bit keys in order, how often each occurs, and the place
    of every input in them."""
    order = np.lexsort((h2, h1))
    a, b = h1[order], h2[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    group = np.cumsum(new) - 1
    inverse = np.empty(len(order), dtype=np.int64)
    inverse[order] = group
    counts = np.bincount(group) if len(group) else np.zeros(0, np.int64)
    return a[new], b[new], counts, inverse


def _key_pieces(k1: np.ndarray, k2: np.ndarray, counts: np.ndarray, n_shards: int):
    shard = ((k1 >> np.uint64(32)) * np.uint64(n_shards)) >> np.uint64(32)
    edges = np.searchsorted(shard, np.arange(n_shards + 1))
    for s in range(n_shards):
        a, b = edges[s], edges[s + 1]
        if b > a:
            yield s, (blocks.pack(np.diff(k1[a:b], prepend=np.uint64(0))) + blocks.pack(k2[a:b])
                      + blocks.pack_bits(counts[a:b] > 1))


def _merge_keys(bodies: list[bytes]) -> list[bytes]:
    """Exact grouping of a shard's window keys."""
    k1, k2, twice, sizes = [], [], [], []
    for body in bodies:
        deltas, at = blocks.unpack(body, np.uint64)
        second, at = blocks.unpack(body, np.uint64, at)
        k1.append(np.cumsum(deltas, dtype=np.uint64))
        k2.append(second)
        twice.append(blocks.unpack_bits(body, at)[0])
        sizes.append(len(second))
    first, second, counts, inverse = _distinct(np.concatenate(k1), np.concatenate(k2))
    bits = (counts > 1)[inverse] | np.bincount(inverse, np.concatenate(twice), len(counts)).astype(bool)[inverse]
    return [blocks.pack_bits(b) for b in np.split(bits, np.cumsum(sizes)[:-1])]


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                   block_bytes: int = BLOCK_BYTES, cells_per_byte: float = CELLS_PER_BYTE,
                   depth: int = DEPTH, with_text: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 and,
    with ``with_text``, kept_text (the kept words joined by one space).

    ``block_bytes`` is what one task holds; the number of pieces is
    (bytes / block_bytes)^2, so raise it with the corpus (8 MB for tens of
    GB, some hundred MB for 100 TB). ``cells_per_byte`` sets the width of a
    sketch row from the size of the corpus."""
    rows, size = blocks.volume(docs, text)
    n_blocks = blocks.block_count(size, rows, block_bytes)
    sketch = blocks.Filter(int(size * cells_per_byte) + 1, n_blocks)
    dealt = blocks.dealt(docs, doc_id, text, n_blocks)

    def count(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        _, _, _, h1, _ = _scan(table, window)
        shard, body = [], []
        for row in range(depth):
            at, n = np.unique(sketch.positions(_row_key(h1, row)), return_counts=True)
            for s, b in sketch.pieces(at, n > 1):
                shard.append(s * depth + row)
                body.append(b)
        return pa.table({"shard": pa.array(shard, pa.int32()), "block": pa.array([block] * len(shard), pa.int32()),
                         "body": pa.array(body, pa.binary())})

    # one merge group per (range, sketch row): the row number is the low part of the shard
    answers = blocks.merged(dealt.groupBy("block").applyInArrow(count, blocks.PIECE), sketch.merge, 0)
    answers = answers.selectExpr("block", f"shard % {depth} as kind", f"cast(shard div {depth} as int) as shard", "body")

    def candidates(table: pa.Table, replies: pa.Table) -> pa.Table:
        shard, body, block = [], [], 0
        if table.num_rows:
            block = table["block"][0].as_py()
            _, _, _, h1, h2 = _scan(table, window)
            hit = _repeated(sketch, h1, replies, depth)
            k1, k2, counts, _ = _distinct(h1[hit], h2[hit])
            for s, b in _key_pieces(k1, k2, counts, n_blocks):
                shard.append(s)
                body.append(b)
        return pa.table({"shard": pa.array(shard, pa.int32()), "block": pa.array([block] * len(shard), pa.int32()),
                         "body": pa.array(body, pa.binary())})

    pieces = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(candidates, blocks.PIECE)
    exact = blocks.merged(pieces, _merge_keys, _KINDS)
    verdicts = answers.unionByName(exact)
    out = [("doc_id", dict(docs.dtypes)[doc_id]), ("n_words", "bigint"), ("n_removed", "bigint"), ("kept_sha256", "string")]
    out += [("kept_text", "string")] * with_text

    def rewrite(table: pa.Table, replies: pa.Table) -> pa.Table:
        table, w, begin, h1, h2 = _scan(table, window)
        hit = _repeated(sketch, h1, replies, depth)
        k1, _, _, inverse = _distinct(h1[hit], h2[hit])
        bits = blocks.answer(replies, _KINDS)
        repeated = bits[inverse] if len(bits) else np.zeros(len(inverse), dtype=bool)
        at = begin[hit][repeated]
        cover = np.zeros(len(w.starts) + 1, dtype=np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + window, -1)
        keep = np.cumsum(cover)[:-1] == 0
        kept = textscan.joined(textscan.span_strings(w.data, w.starts, w.ends), keep, w.first, " ")
        total = np.diff(w.first)
        left = np.diff(np.concatenate([[0], np.cumsum(keep)])[w.first])
        cols = {"doc_id": table["doc_id"], "n_words": pa.array(total, pa.int64()),
                "n_removed": pa.array(total - left, pa.int64()), "kept_sha256": pa.array(textscan.sha256_hex(kept), pa.string())}
        if with_text:
            cols["kept_text"] = kept.cast(pa.string())
        return pa.table(cols)

    return dealt.groupBy("block").cogroup(verdicts.groupBy("block")).applyInArrow(
        rewrite, ", ".join(f"{n} {t}" for n, t in out))
