"""Vectorised word, line and hash arrays over Arrow string columns.

Everything works on the UTF-8 bytes of a batch with numpy. Words are maximal
runs of bytes outside ``[\\x20\\x09-\\x0D]``; bytes of multi-byte characters
are never in that class, so words keep whole characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

SLICE_BYTES = 1 << 18  # workers keep a hasher's powers, 16 bytes a byte of the longest slice

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), so that every output bit depends on
    every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class SpanHasher:
    """Polynomial hash (mod 2^64) of any span of an array from prefix sums:
    one pass over the array, then two lookups a span. ``seed`` picks the
    value table and the base; hashers with two seeds are independent and give
    128 bits together."""

    def __init__(self, seed: int, fold_case: bool = False):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
        if fold_case:
            self.table[65:91] = self.table[97:123]
        self.base = int(rng.integers(0, 2**61, dtype=np.uint64)) * 8 + 3
        self._powers = np.ones(1, dtype=np.uint64)
        self._inverses = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._powers) >= n:
            return
        def powers(base: int) -> np.ndarray:
            out = np.full(n, base, dtype=np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)
        self._powers = powers(self.base)
        self._inverses = powers(_inverse(self.base))

    def spans(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of ``values[starts[i]:ends[i]]`` (uint64 values)."""
        self._grow(len(values) + 1)
        prefix = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self._powers[:len(values)], out=prefix[1:])
        out = prefix[ends] - prefix[starts]
        out *= self._inverses[starts]
        return mix(out + (ends - starts).astype(np.uint64))

    def byte_spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.spans(self.table[data], starts, ends)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    raw = raw[offsets[0]:offsets[-1]]
    return raw, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole documents of at most ``limit`` bytes (one document at
    least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words, the maximal runs of bytes that ``gap``
    doesn't mark; a word never crosses a document."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~gap[data]
    before = np.zeros(n, dtype=bool)
    before[1:] = word[:-1]
    inner = offsets[1:-1]
    before[inner[(inner > 0) & (inner < n)]] = False
    starts = np.flatnonzero(word & ~before)
    after = np.zeros(n, dtype=bool)
    after[:-1] = word[1:]
    cuts = inner[(inner > 0) & (inner < n)] - 1
    after[cuts] = False
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends


@dataclass
class Words:
    """Words of a batch: byte spans, document bounds (``first[d]:first[d+1]``)
    and one hash array per hasher."""
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: list[np.ndarray]

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(column, hashers: list[SpanHasher], gap: np.ndarray = SPACE) -> Words:
    data, offsets = utf8(column)
    starts, ends = [], []
    hashes: list[list[np.ndarray]] = [[] for _ in hashers]
    for i, j in slices(offsets):
        a, b = int(offsets[i]), int(offsets[j])
        s, e = word_spans(data[a:b], offsets[i:j + 1] - a, gap)
        for k, h in enumerate(hashers):
            hashes[k].append(h.byte_spans(data[a:b], s, e))
        starts.append(s + a)
        ends.append(e + a)
    cat = lambda parts, t: np.concatenate(parts) if parts else np.zeros(0, t)
    s = cat(starts, np.int64)
    return Words(data, offsets, s, cat(ends, np.int64), np.searchsorted(s, offsets),
                 [cat(h, np.uint64) for h in hashes])


def windows(w: Words, size: int, hashers: list[SpanHasher]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(index of the first word, hashes) of every run of ``size`` consecutive
    words of one document. Hasher k runs over word hashes k."""
    counts = np.maximum(np.diff(w.first) - size + 1, 0)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64), [np.zeros(0, np.uint64) for _ in hashers]
    begin = np.repeat(w.first[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(total)
    out = []
    for h, values in zip(hashers, w.hashes):
        parts = []
        step = 1 << 17
        for a in range(0, total, step):  # prefix sums over short stretches: small arrays, small powers
            b = begin[a:a + step]
            lo, hi = int(b[0]), int(b[-1]) + size
            parts.append(h.spans(values[lo:hi], b - lo, b - lo + size))
        out.append(np.concatenate(parts))
    return begin, out


def joined(column_words: pa.Array, keep: np.ndarray, first: np.ndarray, sep: str) -> pa.Array:
    """Texts of the kept items, joined by ``sep`` for each document. ``first``
    are the documents' bounds in the flat item array."""
    kept = np.concatenate([[0], np.cumsum(keep)])
    flat = column_words.filter(pa.array(keep))
    lists = pa.LargeListArray.from_arrays(pa.array(kept[first], pa.int64()), flat)
    import pyarrow.compute as pc
    return pc.binary_join(lists, pa.scalar(sep, flat.type))


def span_strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans ``data[starts[i]:ends[i]]`` as a large_string array. Spans
    ascend and do not overlap."""
    lengths = ends - starts
    offs = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    if len(starts):
        mark = np.zeros(len(data) + 1, dtype=np.int8)
        np.add.at(mark, starts[lengths > 0], 1)
        np.add.at(mark, ends[lengths > 0], -1)
        body = data[np.cumsum(mark[:-1], dtype=np.int8).astype(bool)]
    else:
        body = np.zeros(0, np.uint8)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(body)))


def sha256_hex(texts) -> list[str]:
    import hashlib
    return [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts.to_pylist()]
