"""Token-id files: Simple-8b coded ids in ascending document order.

Documents are encoded where they are read (ids by the tokenizers library, an
end id behind each), coded in blocks of at most ``simple8b.BLOCK`` ids that
never span documents, shuffled once by ranges of the id and written to files of a
bounded size in the shared folder. A file holds, in this order and little
endian: magic, numbers of documents, blocks, words and exceptions; per
document its id, whether the id is null, its number of blocks and of
exceptions; per block its number of ids and its offset in words; the words;
the exceptions. Every part can be mapped, so any run of blocks decodes alone,
vectorised.

A task attempt writes files under names of its own; only those that the
manifest lists (rows of attempts that Spark committed) are ever read, so lost
executors and repeated attempts leave no wrong data.

Defined results: a null or empty text has the end id only; null ids come
first; rows with one id follow each other in the order of their text's hash;
an empty table gives no files and an empty result; other columns are not
read. Ids of documents are integers.
"""

from __future__ import annotations

import math
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from vellum.llm import blocks, chunk_tokens, simple8b
from vellum.session import shared_path

MAGIC = b"VTOK8B01"
FILE_BYTES = 16 << 20
READ_TOKENS = 4 << 20  # tokens a task reads back
RANGE_BYTES = 64 << 20  # text of one range of ids
_CODED = "part int, doc_id bigint, tie bigint, n_tokens bigint, sizes binary, word_counts binary, words binary, exceptions binary"
_MANIFEST = "path string, part int, file int, n_docs bigint, n_tokens bigint"


class Ranges:
    """Ranges of ids in ascending order, null ids first. Eight bytes a range
    travel to the tasks. An id that fills several ranges, and null ids, are
    spread over theirs in the order of the texts' hashes."""

    def __init__(self, docs: DataFrame, doc_id: str, n: int):
        ids = docs.select(F.col(doc_id).cast("bigint").alias("i"))
        shares = [k / n for k in range(1, n)] or [0.5]
        row = ids.agg(F.count(F.lit(1)).alias("rows"), F.count("i").alias("ids"),
                      F.percentile_approx("i", shares, max(10_000, 20 * n)).alias("bounds")).first()
        self.bounds = np.array(row["bounds"] if n > 1 and row["bounds"] else [], np.int64)
        self.for_null = math.ceil(n * (row["rows"] - row["ids"]) / row["rows"]) if row["rows"] else 0
        self.n = self.for_null + len(self.bounds) + 1

    def part(self, ids: np.ndarray, null: np.ndarray, tie: np.ndarray) -> np.ndarray:
        place = tie.astype(float) / 2.0**64 + 0.5  # ascends with the hash
        low = np.searchsorted(self.bounds, ids)
        same = np.searchsorted(self.bounds, ids, side="right") - low
        own = self.for_null + low + np.minimum((place * (same + 1)).astype(np.int64), same)
        return np.where(null, np.minimum((place * self.for_null).astype(np.int64), max(self.for_null - 1, 0)), own)


def coded_documents(docs: DataFrame, vocabulary: str, ranges: Ranges, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its range of ids, and its token ids as Simple-8b blocks."""
    def code(batches):
        encoder = chunk_tokens.word_encoder(vocabulary)
        for batch in batches:
            for first, bounds, ids in encoder.batches(batch.column("text")):
                n = len(bounds) - 1
                full = np.insert(ids, bounds[1:], chunk_tokens.END_ID)  # the end id behind each document
                length = np.diff(bounds) + 1
                n_blocks = -(-length // simple8b.BLOCK)
                sizes = np.full(int(n_blocks.sum()), simple8b.BLOCK, np.int64)
                last = np.cumsum(n_blocks) - 1
                sizes[last] = length - (n_blocks - 1) * simple8b.BLOCK
                words, word_counts, _ = simple8b.encode(full, sizes)
                block_at = np.concatenate([[0], np.cumsum(n_blocks)])
                word_at = np.concatenate([[0], np.cumsum(word_counts)])[block_at]
                own, tie = batch.column("doc_id").slice(first, n), batch.column("tie").slice(first, n)
                null = np.asarray(own.is_null())
                part = ranges.part(own.fill_null(0).to_numpy(), null, tie.to_numpy())
                cut = lambda a, at, t: [a[at[d]:at[d + 1]].astype(t).tobytes() for d in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), own, tie, pa.array(length, pa.int64()),
                     pa.array(cut(sizes, block_at, "<u2"), pa.binary()), pa.array(cut(word_counts, block_at, "<u2"), pa.binary()),
                     pa.array(cut(words, word_at, "<u8"), pa.binary()), pa.array([b""] * n, pa.binary())],
                    names=["part", "doc_id", "tie", "n_tokens", "sizes", "word_counts", "words", "exceptions"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.withColumn("tie", F.xxhash64("text")).mapInArrow(code, _CODED)


def file_body(rows: list[dict]) -> bytes:
    """One file from coded documents."""
    sizes = b"".join(r["sizes"] for r in rows)
    word_counts = np.frombuffer(b"".join(r["word_counts"] for r in rows), "<u2").astype(np.int64)
    exceptions = b"".join(r["exceptions"] for r in rows)
    head = np.array([len(rows), len(word_counts), int(word_counts.sum()), len(exceptions) // 8], "<u8")
    ids = np.array([0 if r["doc_id"] is None else r["doc_id"] for r in rows], "<i8")
    null = np.array([r["doc_id"] is None for r in rows], np.uint8)
    blocks = np.array([len(r["sizes"]) // 2 for r in rows], "<u8")
    escapes = np.array([len(r["exceptions"]) // 8 for r in rows], "<u8")
    offsets = (np.cumsum(word_counts) - word_counts).astype("<u8")
    return b"".join([MAGIC, head.tobytes(), ids.tobytes(), null.tobytes(), blocks.tobytes(), escapes.tobytes(), sizes,
                     offsets.tobytes(), *(r["words"] for r in rows), exceptions])


class TokenFile:
    """A file's documents: ``ids(d)`` decodes one, ``all_ids()`` all."""

    def __init__(self, body: bytes):
        if body[:8] != MAGIC:
            raise ValueError("not a token file")
        self.n_docs, n_blocks, n_words, n_exceptions = (int(x) for x in np.frombuffer(body, "<u8", 4, 8))
        at = 40

        def part(dtype: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(body, dtype, n, at)
            at += out.nbytes
            return out
        self.doc_ids, self.null = part("<i8", self.n_docs), part("u1", self.n_docs).astype(bool)
        self.blocks, self.escapes = part("<u8", self.n_docs).astype(np.int64), part("<u8", self.n_docs).astype(np.int64)
        self.sizes = part("<u2", n_blocks).astype(np.int64)
        self.offsets = part("<u8", n_blocks).astype(np.int64)
        self.words, self.exceptions = part("<u8", n_words), part("<u8", n_exceptions)
        self.word_counts = np.diff(self.offsets, append=n_words)
        self.block_at = np.concatenate([[0], np.cumsum(self.blocks)])
        self.token_counts = np.diff(np.concatenate([[0], np.cumsum(self.sizes)])[self.block_at])

    def _run(self, a: int, b: int, escapes: np.ndarray) -> np.ndarray:
        lo = self.offsets[a] if a < len(self.offsets) else len(self.words)
        hi = lo + self.word_counts[a:b].sum()
        return simple8b.decode(self.words[lo:hi], self.word_counts[a:b], self.sizes[a:b], escapes)

    def ids(self, d: int) -> np.ndarray:
        done = int(self.escapes[:d].sum())
        return self._run(self.block_at[d], self.block_at[d + 1], self.exceptions[done:done + self.escapes[d]])

    def all_ids(self) -> np.ndarray:
        """All ids of the file; documents with escapes are decoded singly,
        since each numbers its own."""
        if self.escapes.any():
            return np.concatenate([self.ids(d) for d in range(self.n_docs)])
        return self._run(0, len(self.sizes), self.exceptions)


def _filesystem(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)


def write_files(coded: DataFrame, folder: str, n_ranges: int, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write coded documents in id order; returns the manifest as a stored
    table. ``folder`` is a URI in the shared folder."""
    spark = coded.sparkSession

    def write(batches):
        part, number, pending, size = -1, 0, [], 0

        def flush():
            nonlocal number, pending, size
            path = f"{folder.rstrip('/')}/part-{part:06d}-{number:05d}-{uuid.uuid4().hex}.s8b"
            system, at = _filesystem(path)
            system.create_dir(at.rsplit("/", 1)[0], recursive=True)
            with system.open_output_stream(at) as out:
                out.write(file_body(pending))
            row = (path, part, number, len(pending), sum(r["n_tokens"] for r in pending))
            number, pending, size = number + 1, [], 0
            return pa.RecordBatch.from_pylist([dict(zip(("path", "part", "file", "n_docs", "n_tokens"), row))], schema=manifest_schema)

        manifest_schema = pa.schema([("path", pa.string()), ("part", pa.int32()), ("file", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != part:
                    if pending:
                        yield flush()
                    part, number = row["part"], 0
                pending.append(row)
                size += len(row["words"]) + 64
                if size >= file_bytes:
                    yield flush()
        if pending:
            yield flush()

    spread = coded.repartition(n_ranges, "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "tie")
    manifest = spread.mapInArrow(write, _MANIFEST)
    path = f"{folder.rstrip('/')}-manifest"
    manifest.write.parquet(path)
    return spark.read.parquet(path)


def read_files(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32. One
    row of the manifest is one bounded file."""
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    # a row per file, not per document: small at any size of corpus
    files = manifest.withColumn("file_start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    # a count of its own: by size, a table of paths would fill one task
    n_files, n_tokens = manifest.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    tasks = max(1, min(n_files, max(math.ceil(n_tokens / READ_TOKENS), manifest.sparkSession.sparkContext.defaultParallelism)))
    files = files.select("path", "file_start").repartition(tasks, "path")

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                system, at = _filesystem(row["path"])
                with system.open_input_stream(at) as src:
                    held = TokenFile(src.read())
                ids = held.all_ids().astype("<u4")
                ends = np.cumsum(held.token_counts)
                crc = [zlib.crc32(ids[e - n:e].tobytes()) for e, n in zip(ends.tolist(), held.token_counts.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held.doc_ids.astype(np.int64), pa.int64(), mask=held.null), pa.array(row["file_start"] + ends - held.token_counts, pa.int64()),
                     pa.array(held.token_counts, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return files.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def write_documents(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
                    folder: str | None = None, file_bytes: int = FILE_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Encode and write a table; returns the manifest. Texts are encoded in
    the scan, and coded ids are shuffled once, by ranges of the document id."""
    spark = docs.sparkSession
    _, size = blocks.volume(docs, text)
    n = max(math.ceil(size / range_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranges = Ranges(docs, doc_id, n)
    folder = folder or shared_path(spark, "token_files", "files", unique=True)
    return write_files(coded_documents(docs, vocabulary, ranges, doc_id, text), folder, ranges.n, file_bytes)
