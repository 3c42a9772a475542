"""Quality model: a generalised additive model with pairwise
interactions.

Every feature is cut into bins at quantiles of the fit sample. Boosting goes
through the features in turn, again and again; each time a tree of at most
``LEAVES`` leaves on that one feature is fitted to the residuals of the
logistic loss and added, shrunk, to the feature's lookup table. Then the pairs
of features that explain most of what is left get tables of their own, boosted
the same way by trees of one cut in each feature. A document's score is the
sum of the entries that its bins select, put through the logistic function:
vectorised additions, no tree is walked.

Features come from the text alone. Fitting uses a sample of labelled rows with
the documented bound ``MAX_FIT_ROWS``, chosen by a hash of the id; only the
sample's features travel to the driver. Scoring reads every row whole.

Defined results: a null or empty text has all features zero and is scored like
any other; labels without a document, or null, are not used; an id labelled
twice is used twice; without labels of both kinds the score is the share of
ones among the labels (one half without labels); an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vellum.llm import textscan

MAX_FIT_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
LEAVES = 3
ROUNDS = 60
PAIR_ROUNDS = 30
PAIRS = 6
RATE = 0.15

FEATURES = ("log_chars", "mean_word", "upper_share", "symbol_share", "digit_share", "space_share", "wide_share",
            "distinct_words", "repeated_next", "top_word", "symbol_ends", "long_words", "words_a_line", "distinct_lines",
            "repeated_trigrams", "stops_a_word")

_CLASS = {name: np.zeros(256, dtype=bool) for name in ("upper", "symbol", "digit", "wide")}
_CLASS["upper"][65:91] = True
_CLASS["symbol"][[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"-()"]] = True
_CLASS["digit"][48:58] = True
_CLASS["wide"][128:] = True


@lru_cache(maxsize=1)
def _hashers():
    return [textscan.SpanHasher(61)], [textscan.SpanHasher(67)]


def _sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between consecutive places."""
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[at]).astype(float)


def _distinct(doc: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each document, and how often the commonest occurs."""
    if not len(key):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((key, doc))
    d, k = doc[order], key[order]
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (k[1:] != k[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(d)))
    top = np.zeros(n)
    np.maximum.at(top, d[at], runs)
    return np.bincount(d[at], minlength=n).astype(float), top


def _over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=b > 0)


def features(column) -> np.ndarray:
    """A row of FEATURES per text."""
    word_hashers, run_hashers = _hashers()
    w = textscan.words(column, word_hashers)
    data, offsets, first = w.data, w.offsets, w.first
    n = len(offsets) - 1
    if n == 0:
        return np.zeros((0, len(FEATURES)))
    size = np.diff(offsets).astype(float)
    count = {name: _sums(table[data], offsets) for name, table in _CLASS.items()}
    words, doc = np.diff(first).astype(float), w.doc
    length = (w.ends - w.starts).astype(float)
    inside = length.cumsum() if len(length) else np.zeros(0)
    letters = np.diff(np.concatenate([[0], inside])[first])
    distinct, top = _distinct(doc, w.hashes[0], n)
    same = np.zeros(len(doc), dtype=bool)
    same[1:] = (w.hashes[0][1:] == w.hashes[0][:-1]) & (doc[1:] == doc[:-1])
    ends = _CLASS["symbol"][data[w.ends - 1]] if len(w.ends) else np.zeros(0, dtype=bool)
    breaks = data == 0x0A
    lines = _sums(breaks, offsets) + 1
    edges = np.unique(np.concatenate([offsets, np.flatnonzero(breaks) + 1]))
    edges = edges[edges <= len(data)]
    keys = np.concatenate([word_hashers[0].byte_spans(data[a:b], *_inside(edges, a, b)) for a, b in _stretches(offsets)]) \
        if len(data) else np.zeros(0, np.uint64)
    line_doc = np.searchsorted(offsets, edges[:-1], side="right") - 1
    distinct_lines, _ = _distinct(line_doc, keys, n)
    begin, (tri,) = textscan.windows(w, 3, run_hashers)
    tri_doc = np.searchsorted(first, begin, side="right") - 1
    tri_n = np.bincount(tri_doc, minlength=n).astype(float)
    tri_distinct, _ = _distinct(tri_doc, tri, n)
    stops = _sums((data == 0x2E) | (data == 0x2C), offsets)
    line_n = np.bincount(line_doc, minlength=n).astype(float)
    return np.stack([np.log1p(size), _over(letters, words), _over(count["upper"], size), _over(count["symbol"], size),
                     _over(count["digit"], size), _over(size - letters, size), _over(count["wide"], size), _over(distinct, words),
                     _over(_sums(same, first), words), _over(top, words), _over(_sums(ends, first), words),
                     _over(_sums(length > 12, first), words), _over(words, lines), _over(distinct_lines, line_n),
                     1 - _over(tri_distinct, tri_n) * (tri_n > 0), _over(stops, words)], axis=1)


def _stretches(offsets: np.ndarray):
    """Byte ranges of whole documents for the line hashes."""
    return [(int(offsets[i]), int(offsets[j])) for i, j in textscan.slices(offsets) if offsets[j] > offsets[i]]


def _inside(edges: np.ndarray, a: int, b: int):
    own = edges[np.searchsorted(edges, a):np.searchsorted(edges, b, side="right")] - a
    return own[:-1], own[1:]


@dataclass
class Model:
    intercept: float
    edges: list[np.ndarray]       # cuts between the bins of a feature
    tables: np.ndarray            # (feature, bin)
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: np.ndarray       # (pair, bin, bin)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, edges in enumerate(self.edges):
            total += self.tables[f][np.searchsorted(edges, x[:, f], side="right")]
        coarse = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.pair_edges)]
        for k, (a, b) in enumerate(self.pairs):
            total += self.pair_tables[k][coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaves(gradient: np.ndarray, hessian: np.ndarray, leaves: int) -> np.ndarray:
    """Newton values, by bin, of a tree of at most ``leaves`` leaves on one
    feature, grown by best gain."""
    g, h = np.concatenate([[0], gradient.cumsum()]), np.concatenate([[0], hessian.cumsum()])
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)
    parts = [(0, len(gradient))]
    while len(parts) < leaves:
        best = None
        for a, b in parts:
            if b - a > 1:
                c = np.arange(a + 1, b)
                gains = gain(a, c) + gain(c, b) - gain(a, b)
                k = int(np.argmax(gains))
                if best is None or gains[k] > best[0]:
                    best = (gains[k], a, int(c[k]), b)
        if best is None or best[0] <= 1e-9:
            break
        parts.remove((best[1], best[3]))
        parts += [(best[1], best[2]), (best[2], best[3])]
    out = np.zeros(len(gradient))
    for a, b in parts:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return out


def _grid_tree(gradient: np.ndarray, hessian: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree of one cut in each feature: (gain, values by cell)."""
    g = np.pad(gradient.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    h = np.pad(hessian.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    n, m = gradient.shape
    best = (0.0, np.zeros_like(gradient))
    for a in range(1, n):
        for b in range(1, m):
            cells = [(0, a, 0, b), (0, a, b, m), (a, n, 0, b), (a, n, b, m)]
            sums = [(g[q, t] - g[p, t] - g[q, s] + g[p, s], h[q, t] - h[p, t] - h[q, s] + h[p, s]) for p, q, s, t in cells]
            total = sum(x * x / (y + 1.0) for x, y in sums)
            if total > best[0]:
                out = np.zeros_like(gradient)
                for (p, q, s, t), (x, y) in zip(cells, sums):
                    out[p:q, s:t] = x / (y + 1.0)
                best = (total, out)
    return best


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pair_rounds: int = PAIR_ROUNDS, n_pairs: int = PAIRS) -> Model:
    n_features = len(FEATURES)
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    model = Model(float(np.log(share / (1 - share))), [np.zeros(0)] * n_features, np.zeros((n_features, BINS + 1)), [],
                  [np.zeros(0)] * n_features, np.zeros((0, PAIR_BINS + 1, PAIR_BINS + 1)))
    if not len(y) or y.min() == y.max():
        return model
    model.edges = [_cuts(x[:, f], BINS) for f in range(n_features)]
    model.pair_edges = [_cuts(x[:, f], PAIR_BINS) for f in range(n_features)]
    bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.edges)]
    margin = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        return y - p, p * (1 - p)
    for _ in range(rounds):
        for f in range(n_features):
            residual, weight = slopes()
            size = len(model.edges[f]) + 1
            step = RATE * _leaves(np.bincount(bins[f], residual, size), np.bincount(bins[f], weight, size), LEAVES)
            model.tables[f][:size] += step
            margin += step[bins[f]]
    coarse = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.pair_edges)]
    width = PAIR_BINS + 1

    def grid(pair, values):
        return np.bincount(coarse[pair[0]] * width + coarse[pair[1]], values, width * width).reshape(width, width)
    residual, weight = slopes()
    gains = {(a, b): _grid_tree(grid((a, b), residual), grid((a, b), weight))[0] for a in range(n_features) for b in range(a + 1, n_features)}
    model.pairs = sorted(gains, key=lambda k: (-gains[k], k))[:n_pairs]
    model.pair_tables = np.zeros((len(model.pairs), width, width))
    for _ in range(pair_rounds):
        for k, pair in enumerate(model.pairs):
            residual, weight = slopes()
            step = RATE * _grid_tree(grid(pair, residual), grid(pair, weight))[1]
            model.pair_tables[k] += step
            margin += step[coarse[pair[0]], coarse[pair[1]]]
    return model


def held_out(doc_id: str = "doc_id"):
    """Rows kept from learning: crc32 of the id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def featured(docs: DataFrame, text: str, keep: dict[str, str]) -> DataFrame:
    """Features of a column beside the columns named in ``keep``."""
    types = dict(docs.dtypes)

    def run(batches):
        for batch in batches:
            column = batch.column("__text")
            sizes = np.diff(textscan.utf8(column)[1])
            parts = [features(column.slice(i, j - i)) for i, j in textscan.slices(np.concatenate([[0], np.cumsum(sizes)]))]
            x = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(FEATURES), pa.int32()), pa.array(x.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep.values()), lists], names=[*keep.values(), "x"])
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in keep.items()), F.col(text).alias("__text"))
    return rows.mapInArrow(run, ", ".join([*(f"{n} {types[c]}" for c, n in keep.items()), "x array<double>"]))


def fit_model(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
              max_rows: int = MAX_FIT_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled rows that are not held out: so
    many ids are broadcast, and no text is shuffled to find them."""
    known = labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("double").alias("__label"))
    known = known.where(F.col("__label").isNotNull() & F.col("__id").isNotNull()).where(~held_out("__id"))
    known = known.orderBy(F.xxhash64("__id"), "__id", "__label").limit(max_rows)
    own = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(known), "__id")
    rows = featured(own, "__text", {"__label": "y"}).limit(max_rows).toPandas()
    x = np.stack(rows["x"].to_list()) if len(rows) else np.zeros((0, len(FEATURES)))
    return fit(x, rows["y"].to_numpy(dtype=float))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` and score; no shuffle."""
    types = dict(docs.dtypes)
    names = {c: f"__x{k}" for k, c in enumerate(docs.columns)}

    def run(batches):
        for batch in batches:
            column = batch.column(names[text])
            sizes = np.diff(textscan.utf8(column)[1])
            for i, j in textscan.slices(np.concatenate([[0], np.cumsum(sizes)])):
                total = model.score(features(column.slice(i, j - i)))
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns, pa.array(total)], names=[*batch.schema.names, "__score"])
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    scored = rows.mapInArrow(run, ", ".join([*(f"{n} {types[c]}" for c, n in names.items()), "__score double"]))
    return scored.select(*(F.col(n).alias(c) for c, n in names.items()), F.col("__score").alias("__score"))


def predictions(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    scored = score(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), model)
    return scored.select("doc_id", held_out().alias("held_out"), F.col("__score").alias("score"),
                         (F.col("__score") >= 0.5).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows that the model accepts, all columns."""
    return score(docs, model, text=text).where(F.col("__score") >= 0.5).drop("__score")
