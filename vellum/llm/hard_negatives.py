"""Hard-negative mining with rotated one-bit codes.

Rows are dealt to blocks. A block stores, for each row, its difference from
the mean of its label in the block as signs of the rotated vector (one bit a
component) with the alignment of the vector and that code. One code leaves
0.6 of the length unexplained, which is too wide an interval to drop any row,
so what is left is coded again under another rotation, CODES times in all, and
the length of the last rest is stored. The inner product with an anchor then
lies in an interval that is certain: the parts along the code vectors come
from popcounts of the anchor's quantised components (the quantisation error is
bounded), the rest is at most the product of the two lengths (Cauchy-Schwarz).
Rows whose interval can matter are scored in integers, all others are not.

Every block meets every group of anchors, one pair a group of Spark; what
leaves a pair is at most a few rows an anchor, which windows with a limit
before the shuffle merge.

Rows: a null label or vector, or a null or non-finite component, takes the row
out. A null vec_id is no anchor, keeps its label and comes last among ties.
Components beyond 2^24 after scaling count as 2^24. Vectors of different
lengths are compared as if zeros followed the shorter. A repeated row is
another row: it may be a positive of its copy, and repeated anchors give
repeated results. An empty table, or one without anchors, gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from vellum.llm.running import stored

BLOCK_ROWS = 4096
GROUP_ANCHORS = 1024
ANCHOR_EVERY = 50
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95        # percent of the positive's score
PLANES = 6                # bits of a quantised anchor component
CODES = 6                 # one-bit codes of a row, each of what the last left
LARGEST = float(1 << 24)


def vectors(embeddings: DataFrame) -> DataFrame:
    """(uid, vec_id, label, x): the rows that take part, components as
    integers. uid tells repeated rows apart."""
    c = F.col("embedding")
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    # a filter alone may be evaluated after the projection, so the projection is safe for any component
    scaled = F.transform(c, lambda v: F.greatest(F.least(F.floor(F.nanvl(v.cast("double"), F.lit(0.0)) * 256).cast("double"), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int"))
    label = F.col("label").cast("long")
    shifted = F.when(F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False)), (label + 1) % 10).otherwise(label)
    rows = embeddings.where(F.col("label").isNotNull() & c.isNotNull() & finite)
    return rows.select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"),
                       shifted.alias("label"), scaled.alias("x"))


@lru_cache(maxsize=4 * CODES)
def rotation(dim: int, code: int) -> np.ndarray:
    """The same orthogonal matrix everywhere, one a code."""
    q, r = np.linalg.qr(np.random.default_rng((dim, code)).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def matrix(column, dim: int | None = None) -> np.ndarray:
    """Lists of integers as float64 rows, cut or filled with zeros to
    ``dim`` columns (the longest by default). Integers up to 2^24 are exact."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
    dim = max(1, int(sizes.max(initial=0))) if dim is None else dim
    out = np.zeros((len(sizes), dim))
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    keep = at < dim
    out[row[keep], at[keep]] = flat[keep]
    return out


def _bits(mask: np.ndarray) -> np.ndarray:
    """Rows of bits as uint64 words."""
    raw = np.packbits(mask, axis=1)
    wide = np.zeros((len(mask), -(-raw.shape[1] // 8) * 8), np.uint8)
    wide[:, :raw.shape[1]] = raw
    return wide.view(np.uint64)


BLOCK = "block int, n int, dim int, ids binary, labels binary, x binary, which binary, means binary, codes binary, along binary, rest binary"


def coded(table: pa.Table) -> pa.Table:
    """One block: its rows in order of label and their codes."""
    table = table.sort_by([("label", "ascending"), ("uid", "ascending")])
    x = matrix(table["x"])
    n, dim = x.shape
    labels = table["label"].to_numpy()
    _, which = np.unique(labels, return_inverse=True)
    means = np.zeros((int(which.max()) + 1, dim))
    np.add.at(means, which, x)
    means /= np.bincount(which)[:, None]
    rest, codes, along = x - means[which], [], []
    for k in range(CODES):
        turned = rest @ rotation(dim, k)
        signs = turned > 0
        codes.append(_bits(signs))
        along.append(np.abs(turned).sum(1) / np.sqrt(dim))
        rest = rest - along[-1][:, None] * (np.where(signs, 1, -1) / np.sqrt(dim)) @ rotation(dim, k).T
    ids = np.stack([table["uid"].to_numpy(), table["vec_id"].combine_chunks().fill_null(0).to_numpy(zero_copy_only=False),
                    table["vec_id"].combine_chunks().is_null().to_numpy(zero_copy_only=False).astype(np.int64)])
    row = [table["block"][0].as_py(), n, dim] + [np.ascontiguousarray(a).tobytes() for a in (
        ids.astype(np.int64), labels.astype(np.int64), x.astype(np.int32), which.astype(np.int32), means, np.stack(codes), np.stack(along), np.sqrt((rest ** 2).sum(1)))]
    return pa.Table.from_pylist([dict(zip([f.split()[0] for f in BLOCK.split(", ")], row))], schema=_schema(BLOCK))


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


class Block:
    def __init__(self, row: dict):
        n, dim = self.n, self.dim = row["n"], row["dim"]
        self.uid, self.vec_id, self.no_id = np.frombuffer(row["ids"], np.int64).reshape(3, n)
        self.label = np.frombuffer(row["labels"], np.int64)
        self.x = np.frombuffer(row["x"], np.int32).reshape(n, dim).astype(np.float64)
        self.which = np.frombuffer(row["which"], np.int32)
        self.means = np.frombuffer(row["means"], np.float64).reshape(-1, dim)
        self.codes = np.ascontiguousarray(np.frombuffer(row["codes"], np.uint64).reshape(CODES, n, -1).transpose(2, 0, 1))
        self.along = np.frombuffer(row["along"], np.float64).reshape(CODES, n)
        self.rest = np.frombuffer(row["rest"], np.float64)
        self.ones = np.bitwise_count(self.codes).sum(0, dtype=np.int32)
        self.length = np.sqrt((self.x ** 2).sum(1))
        self.largest = np.abs(self.x).max(initial=0)

    def labelled(self, label: int) -> slice:
        """The rows of a label, which lie together."""
        return slice(*np.searchsorted(self.label, [label, label + 1]))

    def intervals(self, q: np.ndarray, at: slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible inner product of one anchor with each
        of the rows ``at``."""
        root, size = np.sqrt(self.dim), np.sqrt(float(q @ q))
        turned = np.stack([q @ rotation(self.dim, k) for k in range(CODES)])
        low = turned.min(1, keepdims=True)
        step = np.maximum((turned.max(1, keepdims=True) - low) / (2 ** PLANES - 1), 1e-9)
        levels = np.rint((turned - low) / step).astype(np.int64)
        wrong = np.abs(turned - (low + step * levels)).sum(1) / root
        whole = (low * self.dim + step * levels.sum(1, keepdims=True))
        codes = self.codes[:, :, at]
        hits = np.zeros(codes.shape[1:], np.int32)
        for j in range(PLANES):
            planes = _bits((levels >> j & 1).astype(bool))
            for w in range(len(codes)):
                hits += np.left_shift(np.bitwise_count(codes[w] & planes[:, w, None]), j, dtype=np.int32)
        along = self.along[:, at]
        signed = (2 * (low * self.ones[:, at] + step * hits) - whole) / root
        mid = (self.means @ q)[self.which[at]] + np.einsum("kn,kn->n", along, signed)
        wide = size * self.rest[at] + wrong @ along
        wide += 1e-9 * size * (self.length[at] + 1) + 1e-6  # rounding of these sums
        return mid - wide, mid + wide

    def score(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact integer inner products."""
        if np.abs(q).max(initial=0) * self.largest * self.dim < 2 ** 53:
            return (self.x[rows] @ q).astype(np.int64)
        return self.x[rows].astype(np.int64) @ q.astype(np.int64)

    def first(self, rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Places of the first k of ``rows``: score, then vec_id (null last)."""
        return np.lexsort((self.uid[rows], self.vec_id[rows], self.no_id[rows], -scores))[:k]


def _kth(values: np.ndarray, k: int) -> float:
    return -np.inf if len(values) < k else float(np.partition(values, len(values) - k)[len(values) - k])


FOUND = "anchor bigint, anchor_id bigint, uid bigint, vec_id bigint, score bigint, positive bigint, positive_id bigint, positive_score bigint"
_NAMES = [f.split()[0] for f in FOUND.split(", ")]


def _found(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(_NAMES)
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=_NAMES)


def positives_of(blocks: pa.Table, anchors: pa.Table, k: int = POSITIVES) -> pa.Table:
    """The best k other rows of each anchor's label in one block."""
    if not blocks.num_rows or not anchors.num_rows:
        return _found([])
    block, out = Block(blocks.to_pylist()[0]), []
    q = matrix(anchors["x"], block.dim)
    for i, (uid, vec_id, label) in enumerate(zip(*(anchors[c].to_pylist() for c in ("uid", "vec_id", "label")))):
        span = block.labelled(label)
        same = np.arange(span.start, span.stop)
        other = block.uid[same] != uid
        if not other.any():
            continue
        low, high = (a[other] for a in block.intervals(q[i], span))
        rows = same[other][high >= _kth(low, k)]
        scores = block.score(rows, q[i])
        for j in block.first(rows, scores, k):
            out.append((uid, vec_id, int(block.uid[rows[j]]), None if block.no_id[rows[j]] else int(block.vec_id[rows[j]]), int(scores[j]), None, None, None))
    return _found(out)


def negatives_of(blocks: pa.Table, anchors: pa.Table, k: int = NEGATIVES, low_pct: int = LOW, high_pct: int = HIGH) -> pa.Table:
    """For each anchor and positive, the best k rows of other labels in one
    block whose score lies in the band."""
    if not blocks.num_rows or not anchors.num_rows:
        return _found([])
    block, out = Block(blocks.to_pylist()[0]), []
    q = matrix(anchors["x"], block.dim)
    for i, (uid, vec_id, label, positives) in enumerate(zip(*(anchors[c].to_pylist() for c in ("uid", "vec_id", "label", "positives")))):
        other = np.flatnonzero(block.label != label)
        if not len(other):
            continue
        low, high = (a[other] for a in block.intervals(q[i]))
        exact = np.full(len(other), np.iinfo(np.int64).min)
        known = np.zeros(len(other), bool)
        for p in positives:
            floor, ceiling = low_pct * p["score"] / 100, high_pct * p["score"] / 100
            sure = (low >= floor) & (high <= ceiling)
            able = np.flatnonzero((high >= max(floor, _kth(low[sure], k))) & (low <= ceiling))
            new = able[~known[able]]
            exact[new], known[new] = block.score(other[new], q[i]), True
            able = able[(100 * exact[able] >= low_pct * p["score"]) & (100 * exact[able] <= high_pct * p["score"])]
            for j in block.first(other[able], exact[able], k):
                at = other[able[j]]
                out.append((uid, vec_id, int(block.uid[at]), None if block.no_id[at] else int(block.vec_id[at]), int(exact[able[j]]), p["uid"], p["vec_id"], p["score"]))
    return _found(out)


def _best(found: DataFrame, of: list[str], k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*of).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "uid"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def hard_negatives(embeddings: DataFrame, block_rows: int = BLOCK_ROWS, group_anchors: int = GROUP_ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): see the module."""
    rows = stored(vectors(embeddings), "hard-negatives", "rows")
    n, n_anchors = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("vec_id") % ANCHOR_EVERY == 0, 1))).first()
    n_blocks, n_groups = max(1, -(-n // block_rows)), max(1, -(-n_anchors // group_anchors))
    blocks = rows.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(n_blocks)).cast("int"))
    blocks = stored(blocks.groupBy("block").applyInArrow(coded, BLOCK), "hard-negatives", "blocks")
    anchors = rows.where(F.col("vec_id") % ANCHOR_EVERY == 0).withColumn("g", F.pmod(F.xxhash64(F.lit(1), "uid"), F.lit(n_groups)).cast("int"))
    left = blocks.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))).groupBy("g", "block")

    def met(wanted: DataFrame, what) -> DataFrame:
        right = wanted.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).groupBy("g", "block")
        return left.cogroup(right).applyInArrow(lambda block, some: what(block, some), FOUND)

    positives = _best(met(anchors, positives_of), ["anchor"], POSITIVES)
    lists = positives.groupBy(F.col("anchor").alias("uid")).agg(F.collect_list(F.struct("uid", "vec_id", "score")).alias("positives"))
    wanted = stored(anchors.join(lists, "uid"), "hard-negatives", "positives")
    return _best(met(wanted, negatives_of), ["anchor", "positive"], NEGATIVES).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
