"""Benchmark decontamination with spaced seeds.

Tokens are runs of ASCII letters and digits and of characters outside ASCII,
with A-Z lower-cased. A mask such as ``11011011`` hashes the tokens at its
ones and ignores the others, so a seed survives substitutions there. Seeds of
the test items are joined with those of every document position; each hit
fixes an alignment of a document with an item, along which all tokens are then
compared: each maximal-scoring stretch (+1 for an equal token, ``-penalty`` for
a substitution; the best one, then the best ones left and right of it, and so
on) is an overlap if it has ``min_tokens`` equal tokens, or ``min_share`` of
the tokens of an item that is shorter. Items too short for the masks are hashed
whole.

The test set goes through the driver in slices of at most ``slice_tokens``
tokens, and all slices are broadcast (about 50 bytes a token in a worker, for
at most nine slices at a time): this suits test sets of some million tokens, and grows
with the test set, not with the documents.

Defined results: null or empty texts have no tokens and no overlaps; items
without tokens match nothing; every row gives one row; a repeated item is
listed once; an empty test set leaves all documents clean; other columns are
not read.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vellum.llm import textscan

# The masks, six tokens each.
MASKS = ("111111", "11011011", "111000111", "1101001101")
MIN_TOKENS = 12
MIN_SHARE = 0.8
PENALTY = 2
SLICE_TOKENS = 1_000_000

_GAP = np.ones(256, dtype=bool)
_GAP[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)]] = False
_TABLE_BITS = 22


@lru_cache(maxsize=1)
def _hashers() -> list[textscan.SpanHasher]:
    return [textscan.SpanHasher(53, fold_case=True)]


def tokens(column) -> textscan.Words:
    return textscan.words(column, _hashers(), _GAP)


def masks_for(lengths: np.ndarray) -> list[str]:
    """The fixed masks and, for items that none of them fits, whole ones."""
    shortest = min(map(len, MASKS))
    return [*MASKS, *("1" * n for n in sorted({int(n) for n in lengths if 0 < n < shortest}))]


def seeds(hashes: np.ndarray, first: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """(position, seed) of every place where the mask fits in a document."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    out = np.full(n, len(mask), np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            out *= np.uint64(0x9E3779B97F4A7C15)
            out += hashes[k:k + n]
    end = np.repeat(first[1:], np.diff(first))[:n]
    at = np.flatnonzero(np.arange(n) + len(mask) <= end)
    return at, textscan.mix(out[at])


class TestSet:
    """One slice of the test set: token hashes and a table of seeds."""
    __test__ = False

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        w = tokens(pa.array([t for _, t in items], pa.large_string()))
        self.hashes, self.first = w.hashes[0], w.first
        lengths = np.diff(w.first)
        self.masks = masks_for(lengths)
        seed, place = [], []
        for mask in self.masks:
            at, s = seeds(self.hashes, self.first, mask)
            if len(mask) < min(map(len, MASKS)):  # only for the items it was made for
                own = lengths[np.searchsorted(self.first, at, side="right") - 1] == len(mask)
                at, s = at[own], s[own]
            seed.append(s)
            place.append(at)
        seed, place = np.concatenate(seed), np.concatenate(place)
        order = np.argsort(seed, kind="stable")
        self.seed, self.place = seed[order], place[order]
        self.table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.table[(self.seed & np.uint64((1 << _TABLE_BITS) - 1)).astype(np.int64)] = True

    def hits(self, w: textscan.Words) -> np.ndarray:
        """Distinct (document, item, shift) rows: item token q lies on
        document token q + shift (positions within the batch)."""
        out = []
        for mask in self.masks:
            at, s = seeds(w.hashes[0], w.first, mask)
            likely = self.table[(s & np.uint64((1 << _TABLE_BITS) - 1)).astype(np.int64)]
            at, s = at[likely], s[likely]
            lo, hi = np.searchsorted(self.seed, s), np.searchsorted(self.seed, s, side="right")
            n = hi - lo
            place = self.place[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            at = np.repeat(at, n)
            item = np.searchsorted(self.first, place, side="right") - 1
            doc = np.searchsorted(w.first, at, side="right") - 1
            out.append(np.stack([doc, item, at - (place - self.first[item])], axis=1))
        rows = np.concatenate(out)
        return np.unique(rows, axis=0) if len(rows) else rows

    def overlaps(self, w: textscan.Words, doc: int, item: int, shift: int, min_tokens: int, min_share: float, penalty: int):
        """(equal tokens, first, end) of every stretch that is long enough."""
        a, b = self.first[item], self.first[item + 1]
        lo, hi = max(shift, w.first[doc]), min(shift + b - a, w.first[doc + 1])
        equal = w.hashes[0][lo:hi] == self.hashes[a + lo - shift:a + hi - shift]
        need = max(1, min(min_tokens, int(np.ceil(min_share * (b - a)))))
        same = np.concatenate([[0], np.cumsum(equal)])
        return [(int(same[end] - same[begin]), int(lo - w.first[doc]) + begin, int(lo - w.first[doc]) + end)
                for begin, end in stretches(equal, penalty) if same[end] - same[begin] >= need]


def stretches(equal: np.ndarray, penalty: int) -> list[tuple[int, int]]:
    """All maximal-scoring stretches, in one pass over the runs of equal
    tokens: a run joins the last stretch that began lower than it, if it ends
    higher than that one."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], equal.astype(np.int8), [0]])))
    out: list[tuple[int, int, int, int, int]] = []  # score before and after, begin, end, running score
    for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if out:
            low = out[-1][4] - penalty * (begin - out[-1][3])
        else:
            low = 0
        high = low + end - begin
        now = (low, high, begin, end, high)
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][0] >= now[0]:
                j -= 1
            if j < 0 or out[j][1] >= now[1]:
                out.append(now)
                break
            now = (out[j][0], now[1], out[j][2], now[3], high)
            del out[j:]
    return [(begin, end) for _, _, begin, end, _ in out]


def id_kind(benchmark: DataFrame, item_id: str) -> str:
    """Item ids are long, or text if they are no integers."""
    return "bigint" if dict(benchmark.dtypes)[item_id] in ("tinyint", "smallint", "int", "bigint") else "string"


def test_slices(benchmark: DataFrame, item_id: str, text: str, slice_tokens: int):
    """The test set in bounded slices, fetched row by row."""
    held, size = [], 0
    rows = benchmark.select(F.col(item_id).cast(id_kind(benchmark, item_id)).alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t")).toLocalIterator()
    for row in rows:
        n = len(row["t"]) // 2 + 1
        if held and size + n > slice_tokens:
            yield held
            held, size = [], 0
        held.append((row["i"], row["t"]))
        size += n
    yield held


def find_overlaps(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", min_tokens: int = MIN_TOKENS,
                  min_share: float = MIN_SHARE, penalty: int = PENALTY, slice_tokens: int = SLICE_TOKENS,
                  with_text: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_tokens, contaminated and overlaps, an
    array of (item_id, tokens, first, end) in token positions. ``with_text``
    adds the text column, so that a filter needs no join back."""
    spark = docs.sparkSession
    extra = [c for c in docs.columns if c not in (doc_id, text)] if with_text else []
    slices = test_slices(benchmark, item_id, item_text, slice_tokens)
    held = [(uuid.uuid4().hex, spark.sparkContext.broadcast(s)) for s in slices]
    kind = id_kind(benchmark, item_id)
    fields = pa.struct([("item_id", pa.int64() if kind == "bigint" else pa.string()), ("tokens", pa.int64()), ("first", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for batch in batches:
            column = batch.column("__text")
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            counts = np.zeros(batch.num_rows, np.int64)
            sizes = np.diff(textscan.utf8(column)[1])
            for i, j in textscan.slices(np.concatenate([[0], np.cumsum(sizes)])):
                w = tokens(column.slice(i, j - i))
                counts[i:j] = np.diff(w.first)
                for name, part in held:
                    test = _test_set(name, part)
                    for doc, item, shift in test.hits(w).tolist():
                        for same, first, end in test.overlaps(w, doc, item, shift, min_tokens, min_share, penalty):
                            found[i + doc].append({"item_id": test.ids[item], "tokens": same, "first": first, "end": end})
            for rows in found:
                rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"] if r["item_id"] is not None else 0, r["first"], r["end"]))
            cols = [batch.column("doc_id"), pa.array(counts), pa.array([bool(r) for r in found]), pa.array(found, pa.list_(fields))]
            names = ["doc_id", "n_tokens", "contaminated", "overlaps"]
            if with_text:
                cols += [batch.column(c) for c in ["__text", *(f"__x{k}" for k in range(len(extra)))]]
                names += ["__text", *(f"__x{k}" for k in range(len(extra)))]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    types = dict(docs.dtypes)
    schema = [f"doc_id {types[doc_id]}", "n_tokens bigint", "contaminated boolean",
              f"overlaps array<struct<item_id:{kind},tokens:bigint,first:bigint,end:bigint>>"]
    if with_text:
        schema += [f"__text {types[text]}", *(f"__x{k} {types[c]}" for k, c in enumerate(extra))]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"), *(F.col(f"`{c}`").alias(f"__x{k}") for k, c in enumerate(extra)))
    return rows.mapInArrow(run, ", ".join(schema))


_SETS: dict = {}


def _test_set(name: str, part) -> TestSet:
    """One table a worker and slice."""
    if name not in _SETS:
        if len(_SETS) > 8:
            _SETS.clear()
        _SETS[name] = TestSet(part.value)
    return _SETS[name]


def clean_documents(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows without an overlap, all columns, without a shuffle."""
    extra = [c for c in docs.columns if c not in (doc_id, text)]
    found = find_overlaps(docs, benchmark, doc_id, text, with_text=True).where(~F.col("contaminated"))
    named = {doc_id: "doc_id", text: "__text"} | {c: f"__x{k}" for k, c in enumerate(extra)}
    return found.select(*(F.col(named[c]).alias(c) for c in docs.columns))


def summary(found: DataFrame) -> DataFrame:
    """Per document: doc_id, n_tokens, contaminated, n_items, matched_tokens
    (of the longest overlap), item_ids and spans as text."""
    ids = F.array_sort(F.array_distinct(F.transform("overlaps", lambda o: o["item_id"])))
    spans = F.transform("overlaps", lambda o: F.concat_ws(":", o["item_id"].cast("string"), o["first"].cast("string"), o["end"].cast("string")))
    return found.select("doc_id", "n_tokens", "contaminated", F.size(ids).cast("bigint").alias("n_items"),
                        F.coalesce(F.array_max(F.transform("overlaps", lambda o: o["tokens"])), F.lit(0)).cast("bigint").alias("matched_tokens"),
                        F.array_join(F.transform(ids, lambda i: i.cast("string")), ",").alias("item_ids"), F.array_join(spans, ",").alias("spans"))
