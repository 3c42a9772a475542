"""Line dedup: lines that many documents share stay in one document only.

Method: two Bloom filters, for hashes seen once and seen twice. Every block of
documents sets the bits of its line keys in the first filter, and in the
second those of keys that it has seen in two documents; merging two pairs sets
the second filter where both first filters have the bit. So a key of two
documents is always found in the second filter. Only lines found there
("suspected repeats") are shuffled, as 128-bit digests pre-counted by block,
for the exact count of documents and the choice of the document that keeps
them. See ``blocks.py`` for how the filters are cut by bit range.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with
A-Z lower-cased. Defined results: a null or empty text is one empty line;
rows count as documents, so repeated rows each count; a line that occurs
twice in one document counts it once, and both lines go or stay together;
rows with a null id count, but never keep a shared line while a row with an
id holds it; rows tied at the largest id all keep it; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from vellum.llm import blocks, textscan

MIN_CHARS = 40
MIN_DOCS = 5
BLOCK_BYTES = 8 << 20
BITS_PER_BYTE = 0.5
PROBES = 2
_SUSPECTS = "block int, k1 bigint, k2 bigint, n_docs bigint, last_id {id}"
_VERDICTS = "block int, k1 bigint, k2 bigint, keep_id {id}"


@lru_cache(maxsize=1)
def _hashers() -> list[textscan.SpanHasher]:
    return [textscan.SpanHasher(31, fold_case=True), textscan.SpanHasher(37, fold_case=True)]


class Lines:
    """Lines of a block's documents: byte spans, key hashes, document
    numbers. Every document has one line at least."""

    def __init__(self, column, min_chars: int):
        self.data, self.offsets = textscan.utf8(column)
        none = np.zeros(0, np.int64)
        parts = [(none, none, none, none, none.view(np.uint64), none.view(np.uint64))]
        count = 0
        for i, j in textscan.slices(self.offsets):  # scratch arrays are several times the bytes they are made from
            a, b = self.offsets[i], self.offsets[j]
            starts, ends, doc, long, k1, k2 = self._of(self.data[a:b], self.offsets[i:j + 1] - a, min_chars)
            parts.append((starts + a, ends + a, doc + i, long + count, k1, k2))
            count += len(starts)
        self.starts, self.ends, self.doc, self.long, self.k1, self.k2 = (np.concatenate(p) for p in zip(*parts))
        self.first = np.searchsorted(self.doc, np.arange(len(self.offsets)))

    @staticmethod
    def _of(data: np.ndarray, offsets: np.ndarray, min_chars: int):
        """Starts, ends and document numbers of the lines of some documents;
        numbers and key hashes of the long ones."""
        n = len(offsets) - 1
        breaks = np.flatnonzero(data == 0x0A)
        begin = np.concatenate([offsets[:-1], breaks + 1])
        end = np.concatenate([breaks, offsets[1:]])
        holder = np.searchsorted(offsets, breaks, side="right") - 1
        doc = np.concatenate([np.arange(n), holder])
        order = np.lexsort((begin, doc))
        starts, doc = begin[order], doc[order]
        ends = end[np.lexsort((end, np.concatenate([holder, np.arange(n)])))]
        solid = np.flatnonzero(~textscan.SPACE[data])
        lo = np.searchsorted(solid, starts)
        hi = np.searchsorted(solid, ends)
        some = hi > lo
        key_start, key_end = starts.copy(), starts.copy()
        key_start[some] = solid[lo[some]]
        key_end[some] = solid[hi[some] - 1] + 1
        letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        long = np.flatnonzero(letters[key_end] - letters[key_start] >= min_chars)
        k1, k2 = (h.byte_spans(data, key_start[long], key_end[long]) for h in _hashers())
        return starts, ends, doc, long, k1, k2

    def keys(self):
        """Distinct keys of the block: (k1, k2, documents, their last row)
        and the key number of every long line."""
        doc = self.doc[self.long]
        order = np.lexsort((doc, self.k2, self.k1))
        a, b, d = self.k1[order], self.k2[order], doc[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        other = np.ones(len(order), dtype=bool)
        other[1:] = new[1:] | (d[1:] != d[:-1])
        group = np.cumsum(new) - 1
        inverse = np.empty(len(order), dtype=np.int64)
        inverse[order] = group
        n = int(new.sum())
        docs = np.bincount(group, other, n).astype(np.int64)
        last = d[np.concatenate([np.flatnonzero(new)[1:], [len(order)]]) - 1] if n else np.zeros(0, np.int64)
        return a[new], b[new], docs, last, inverse


def _probes(k1: np.ndarray, k2: np.ndarray, bloom: blocks.Filter, probes: int) -> np.ndarray:
    return np.stack([bloom.positions(k1 + k2 * np.uint64(i)) for i in range(probes)]) if len(k1) else np.zeros((probes, 0), np.int64)


def _last_id(table: pa.Table, last: np.ndarray) -> pa.Array:
    """Rows are ordered by id with nulls at the end; the largest non-null id
    of a key's documents in the block is asked for."""
    return table["doc_id"].combine_chunks().take(pa.array(last))


def drop_shared_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                      min_docs: int = MIN_DOCS, block_bytes: int = BLOCK_BYTES,
                      bits_per_byte: float = BITS_PER_BYTE, probes: int = PROBES,
                      with_text: bool = True, carry: list[str] = ()) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_dropped, kept_sha256 and,
    with ``with_text``, kept_text (the lines left, joined by a line break);
    the columns named in ``carry`` come along as __x0, __x1, and so on.

    ``min_docs`` must be 2 or more. ``bits_per_byte`` sets the size of a
    filter from the size of the corpus (a key takes 40 bytes or more)."""
    if min_docs < 2:
        raise ValueError("min_docs must be at least 2")
    id_type = dict(docs.dtypes)[doc_id]
    rows, size = blocks.volume(docs, text)
    n_blocks = blocks.block_count(size, rows, block_bytes)
    bloom = blocks.Filter(int(size * bits_per_byte) + 1, n_blocks)
    dealt = blocks.dealt(docs, doc_id, text, n_blocks, carry)

    def insert(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        k1, k2, n, _, _ = Lines(blocks.ordered(table)["text"], min_chars).keys()
        bits = _probes(k1, k2, bloom, probes)
        at, inverse = np.unique(bits, return_inverse=True)
        twice = np.bincount(inverse.reshape(-1), np.tile(n > 1, probes), len(at)) > 0
        out = list(bloom.pieces(at, twice))
        return pa.table({"shard": pa.array([s for s, _ in out], pa.int32()),
                         "block": pa.array([block] * len(out), pa.int32()),
                         "body": pa.array([b for _, b in out], pa.binary())})

    answers = blocks.merged(dealt.groupBy("block").applyInArrow(insert, blocks.PIECE), bloom.merge, 0)
    suspect_schema = _SUSPECTS.format(id=id_type)

    def suspects(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"block": pa.array([], pa.int32()), "k1": pa.array([], pa.int64()),
                             "k2": pa.array([], pa.int64()), "n_docs": pa.array([], pa.int64()),
                             "last_id": pa.array([], table.schema.field("doc_id").type)})
        table = blocks.ordered(table)
        found = Lines(table["text"], min_chars)
        k1, k2, n, last, inverse = found.keys()
        bits = _probes(k1, k2, bloom, probes)
        at, place = np.unique(bits, return_inverse=True)
        again = blocks.answer(replies, 0)
        hit = again[place.reshape(bits.shape)].all(axis=0) if len(again) else np.zeros(len(k1), dtype=bool)
        ids = table["doc_id"].combine_chunks()
        if ids.null_count:  # nulls sort last: step back to the last row with an id
            doc = found.doc[found.long]
            valid = ~np.asarray(ids.is_null())[doc]
            best = np.full(len(k1), -1)
            np.maximum.at(best, inverse[valid], doc[valid])
            last = np.where(best >= 0, best, last)
        return pa.table({"block": pa.array(np.full(int(hit.sum()), table["block"][0].as_py(), np.int32)),
                         "k1": pa.array(k1[hit].view(np.int64)), "k2": pa.array(k2[hit].view(np.int64)),
                         "n_docs": pa.array(n[hit], pa.int64()), "last_id": ids.take(pa.array(last[hit]))})

    asked = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(suspects, suspect_schema)
    # a key has one row a block at most, however many documents hold it
    same = Window.partitionBy("k1", "k2")
    verdicts = (asked.withColumn("total", F.sum("n_docs").over(same)).withColumn("keep_id", F.max("last_id").over(same))
                .where(F.col("total") >= min_docs).select("block", "k1", "k2", "keep_id"))
    out = [("doc_id", id_type), ("n_lines", "bigint"), ("n_dropped", "bigint"), ("kept_sha256", "string")]
    out += [("kept_text", "string")] * with_text
    out += [(f"__x{k}", dict(docs.dtypes)[c]) for k, c in enumerate(carry)]

    def rewrite(table: pa.Table, replies: pa.Table) -> pa.Table:
        table = blocks.ordered(table)
        found = Lines(table["text"], min_chars)
        k1, k2, _, _, inverse = found.keys()
        keep = np.ones(len(found.starts), dtype=bool)
        if replies.num_rows:
            r1 = replies["k1"].to_numpy().view(np.uint64)
            r2 = replies["k2"].to_numpy().view(np.uint64)
            number = {k: i for i, k in enumerate(zip(r1.tolist(), r2.tolist()))}
            verdict = np.full(len(k1), -1, np.int64)
            likely = np.flatnonzero(np.isin(k1, r1))
            verdict[likely] = [number.get(k, -1) for k in zip(k1[likely].tolist(), k2[likely].tolist())]
            shared = verdict[inverse]
            lines = found.long[shared >= 0]
            import pyarrow.compute as pc
            own = table["doc_id"].combine_chunks().take(pa.array(found.doc[lines]))
            keeper = replies["keep_id"].combine_chunks().take(pa.array(shared[shared >= 0]))
            same_id = pc.fill_null(pc.equal(own, keeper), False)
            both_null = pc.and_(own.is_null(), keeper.is_null())
            keep[lines] = np.asarray(pc.or_(same_id, both_null))
        digests, texts = [], []
        for i, j in textscan.slices(found.offsets):
            a, b, x, y = found.offsets[i], found.offsets[j], found.first[i], found.first[j]
            lines = textscan.span_strings(found.data[a:b], found.starts[x:y] - a, found.ends[x:y] - a)
            kept = textscan.joined(lines, keep[x:y], found.first[i:j + 1] - x, "\n")
            digests += textscan.sha256_hex(kept)
            if with_text:
                texts.append(kept.cast(pa.string()))
        total = np.diff(found.first)
        left = np.diff(np.concatenate([[0], np.cumsum(keep)])[found.first])
        cols = {"doc_id": table["doc_id"], "n_lines": pa.array(total, pa.int64()),
                "n_dropped": pa.array(total - left, pa.int64()), "kept_sha256": pa.array(digests, pa.string())}
        if with_text:
            cols["kept_text"] = pa.chunked_array(texts, pa.string())
        return pa.table(cols | {f"__x{k}": table[f"__x{k}"] for k in range(len(carry))})

    return dealt.groupBy("block").cogroup(verdicts.groupBy("block")).applyInArrow(
        rewrite, ", ".join(f"{n} {t}" for n, t in out))


def without_shared_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the lines left as its text, all columns."""
    carry = [c for c in docs.columns if c not in (doc_id, text)]
    rows = drop_shared_lines(docs, doc_id, text, carry=carry)
    named = {doc_id: "doc_id", text: "kept_text"} | {c: f"__x{k}" for k, c in enumerate(carry)}
    return rows.select(*(F.col(named[c]).alias(c) for c in docs.columns))
