"""Incremental ingest as Structured Streaming jobs.

``ingest_stream`` is the general form: any streaming DataFrame of scan rows
is appended to an inventory table through ``foreachBatch`` -- dedup inside
the batch, probe the stored keys with the batch's keys, append the rest. A replayed batch finds
its rows already stored and appends nothing, so retries are idempotent.
Progress lives in a checkpoint under the shared checkpoint folder;
``trigger(availableNow=True)`` processes what has arrived and stops.
"""

from __future__ import annotations

from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from vellum.operators.dedup import first_seen
from vellum.operators.incremental import unseen_by_probe
from vellum.operators.latest import flag_latest
from vellum.session import shared_path

BATCH_COL = "ingest_batch"
ARRIVALS = 4  # lots that ingest_in_batches takes in one after the other


def _stored_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table; one that does not exist yet is empty, one that cannot
    be read is an error."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def ingest_stream(rows: DataFrame, inventory_path: str, checkpoint: str,
                  to_scan_rows: Callable[[DataFrame], DataFrame] = lambda d: d,
                  key: str = "relative_path", content: str = "md5_hash", available_now: bool = True):
    """Start the ingest query; returns the StreamingQuery. Flags are stored
    as they were on arrival; ``current_inventory`` works them out over all
    stored rows. The digests of all contents seen lie beside the inventory, a
    part per batch, so a copy in a later batch adds nothing."""
    seen_path = f"{inventory_path.rstrip('/')}-seen"

    def append_batch(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        rows = first_seen(to_scan_rows(batch))
        # contents that earlier batches brought, stored or not; a replayed batch rewrites its own part
        known = _stored_or_empty(spark, seen_path, f"`{content}` string, batch bigint").filter(F.col("batch") != epoch_id)
        # a missing digest is one content, as in first_seen
        known, came = known.select(F.col(content).alias("_held")), rows.select(F.col(content).alias("_came")).distinct()
        held = known.join(came, F.col("_held").eqNullSafe(F.col("_came")), "left_semi").distinct()
        rows = rows.join(held, F.col(content).eqNullSafe(F.col("_held")), "left_anti")
        rows.select(content).write.mode("overwrite").parquet(f"{seen_path}/batch={epoch_id}")
        stored = _stored_or_empty(spark, inventory_path, f"`{key}` string").select(key)
        new = unseen_by_probe(flag_latest(rows), stored, key).withColumn(BATCH_COL, F.lit(epoch_id).cast("bigint"))
        new.write.mode("append").parquet(inventory_path)

    writer = (rows.writeStream.foreachBatch(append_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def _documents_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a stream, be they one file or a folder of part files."""
    path = f"{sf_dir.rstrip('/')}/documents.parquet"
    # as a glob: Spark takes a plain path of one file for the folder that partitions lie in, and refuses it
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[{path[-1]}]")


def ingest_documents_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed an inventory with the earlier run's rows, stream the documents
    through ``ingest_stream`` and return the rows the stream appended."""
    from vellum.plans.catalogue import earlier_inventory
    from vellum.sources.fixtures import doc_files_of, scan_listing_of

    base = shared_path(spark, "ingest", unique=True)
    inventory_path, checkpoint = f"{base}/inventory", f"{base}/checkpoint"
    seed = earlier_inventory(spark, sf_dir).withColumn(BATCH_COL, F.lit(None).cast("bigint"))
    seed.write.mode("overwrite").parquet(inventory_path)
    query = ingest_stream(_documents_stream(spark, sf_dir), inventory_path, checkpoint,
                          to_scan_rows=lambda d: scan_listing_of(doc_files_of(d)))
    query.awaitTermination()
    return spark.read.parquet(inventory_path).filter(F.col(BATCH_COL).isNotNull())


def path_cuts(paths: DataFrame, parts: int, path: str = "relative_path") -> list[str]:
    """At most ``parts - 1`` paths that cut the rows into ranges of similar
    size. One pseudo-random path of each of 64 hash buckets is looked at, so
    the driver holds 64 paths at any size; the cuts only say where a row
    belongs, none is left out."""
    number = F.xxhash64(path)
    seen = (paths.filter(F.col(path).isNotNull()).groupBy(F.pmod(number, F.lit(64)).alias("bucket"))
            .agg(F.min_by(F.col(path), number).alias("at")).collect())
    at = sorted(r["at"] for r in seen)
    return [at[k * len(at) // parts] for k in range(1, parts)] if at else []


def ingest_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents arrive in ``ARRIVALS`` lots, in the order of their paths
    (those without a path last); after each the ingest job is started again
    from its checkpoint and takes the lot as one batch into the earlier
    inventory. Returns the stored inventory with its flags worked out over
    all rows."""
    from vellum.operators.incremental import recompute_latest
    from vellum.plans.catalogue import earlier_inventory
    from vellum.sources.fixtures import doc_files_of, scan_listing_of

    base = shared_path(spark, "ingest_batches", unique=True)
    files = doc_files_of(spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"))
    lot = F.lit(0)
    for cut in path_cuts(files, ARRIVALS):
        # a missing path sorts last, as in first_seen
        lot = lot + F.coalesce(F.col("relative_path") >= F.lit(cut), F.lit(True)).cast("int")
    docs = files.withColumn("lot", lot).select("doc_id", "lang", "source", "text", "lot")
    seed = earlier_inventory(spark, sf_dir).withColumn(BATCH_COL, F.lit(None).cast("bigint"))
    seed.write.parquet(f"{base}/inventory")
    for number in range(ARRIVALS):
        docs.filter(F.col("lot") == number).drop("lot").write.mode("append").parquet(f"{base}/arrivals")
        stream = spark.readStream.schema(docs.drop("lot").schema).parquet(f"{base}/arrivals")
        ingest_stream(stream, f"{base}/inventory", f"{base}/checkpoint",
                      to_scan_rows=lambda d: scan_listing_of(doc_files_of(d))).awaitTermination()
    return recompute_latest(spark.read.parquet(f"{base}/inventory").drop(BATCH_COL))


def scan_stream(spark: SparkSession, root: str, rows_path: str, checkpoint: str, ending: str = ".pdf",
                settle: float = 1.0, available_now: bool = True):
    """Start the scan of files as they arrive below ``root``: each batch is
    dealt to tasks by bytes, hashed and written as scan rows, a part per
    batch that a replay writes anew. Files that cannot be read are rows with an ``error``
    and no digest. Returns the StreamingQuery."""
    from vellum.sources.deal import deal
    from vellum.sources.files import hashed, scan_rows
    from vellum.sources.tree import stream_tree

    def scan_batch(batch: DataFrame, epoch_id: int) -> None:
        listed = batch.withColumn("error", F.lit(None).cast("string"))
        # the listing is stored first: dealing looks at it twice, and a hash must not repeat a walk of the tree
        listed.write.mode("overwrite").parquet(f"{rows_path}-listed/batch={epoch_id}")
        files = batch.sparkSession.read.parquet(f"{rows_path}-listed/batch={epoch_id}")
        found = hashed(deal(files, "path", F.col("length")))
        scan_rows(found, root).write.mode("overwrite").parquet(f"{rows_path}/batch={epoch_id}")

    writer = (stream_tree(spark, root, ending, settle).writeStream.foreachBatch(scan_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def scanned_files(spark: SparkSession, rows_path: str, path: str = "full_path") -> DataFrame:
    """The scan rows that the stream wrote; of a file that came several times
    the row of its last batch."""
    rows = spark.read.parquet(rows_path)
    last = rows.groupBy(path).agg(F.max("batch").alias("batch"))
    return rows.join(last, [path, "batch"], "left_semi").drop("batch")


def scan_in_lots(spark: SparkSession, sf_dir: str, lots: int = 3) -> DataFrame:
    """The documents arrive as files in three lots by a hash of their path,
    and the file stream is started again after each from its checkpoint.
    Returns the distinct contents with their latest flags, as the batch scan
    gives them."""
    from vellum.session import local_path
    from vellum.sources import fixtures as fx

    base = shared_path(spark, "file_stream", unique=True)
    files = fx.doc_files(spark, sf_dir)
    lot = F.pmod(F.xxhash64("relative_path"), F.lit(lots))
    for k in range(lots):
        fx.write_files(files.filter(lot == k), f"{base}/tree", set_times=False)
        scan_stream(spark, f"{local_path(base)}/tree/docs", f"{base}/rows", f"{base}/checkpoint",
                    settle=0.0).awaitTermination()
    # arrival times are not the documents' own, which the latest flag goes by
    own = files.select(F.col("relative_path"), F.timestamp_seconds("creation_epoch").alias("creation_time"))
    rows = scanned_files(spark, f"{base}/rows").drop("creation_time").join(own, "relative_path", "left")
    return flag_latest(first_seen(rows))


def dedup_stream(rows: DataFrame, key: str, out_path: str, checkpoint: str,
                 watermark_col: str | None = None, watermark: str = "1 day"):
    """Streaming first-seen dedup on ``key`` (I2). Without a watermark the
    state keeps every key; with one, ``dropDuplicatesWithinWatermark``
    bounds it."""
    if watermark_col:
        if dict(rows.dtypes).get(watermark_col) == "timestamp_ntz":
            # watermarks need an instant; read the wall-clock time in the session time zone
            rows = rows.withColumn(watermark_col, F.col(watermark_col).cast("timestamp"))
        deduped = rows.withWatermark(watermark_col, watermark).dropDuplicatesWithinWatermark([key])
    else:
        deduped = rows.dropDuplicates([key])
    return (deduped.writeStream.format("parquet").option("path", out_path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def dedup_documents_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_path(spark, "dedup", unique=True)
    rows = _documents_stream(spark, sf_dir).select(F.md5(F.col("text")).alias("md5_hash"))
    dedup_stream(rows, "md5_hash", f"{base}/data", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/data")
