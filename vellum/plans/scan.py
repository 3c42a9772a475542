"""Scan a directory tree and append unseen files to the inventory (B1)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from vellum.operators.dedup import first_seen
from vellum.operators.incremental import recompute_latest, unseen
from vellum.operators.latest import flag_latest
from vellum.session import shared_path
from vellum.sources.files import PDF_GLOB, list_files, scan_rows
from vellum.sources.inventory import append_inventory, read_inventory


@dataclass
class ScanResult:
    scanned: DataFrame   # every distinct file with its latest flag
    added: DataFrame     # rows appended to the inventory
    summary: DataFrame   # one row: total_files, added_files, skipped_files
    errors: DataFrame    # files that could not be read 


def _last_digests(spark: SparkSession, path: str) -> tuple[DataFrame | None, int]:
    """The digests of the last scan that stored some, and its number."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None, 0
    last = stored.agg(F.max("scan")).first()[0]
    return (None, 0) if last is None else (stored.filter(F.col("scan") == last).drop("scan"), last)


def scan_directory(spark: SparkSession, root: str, inventory_path: str, glob: str = PDF_GLOB,
                   write: bool = True, reuse_digests: bool = True) -> ScanResult:
    """List, hash, dedup by content, flag the latest revision per group and
    append the paths not stored yet.

    The listing (the only stage that reads file bodies) is stored once as
    Parquet, and so are the flagged rows with a mark on those that are new,
    from which the append, the summary and the returned frames are read: the
    summary is fixed before the inventory changes.

    Path, size, time and digest of the files found lie beside the inventory, a
    part per scan, of which the last is read. With ``reuse_digests`` only files
    that are new, or whose size or time changed, are opened; a file rewritten
    with the size and time it had goes unseen, which ``reuse_digests=False``
    finds. The part is written last, so a scan that dies is as if it had not
    stored any; one scan of an inventory runs at a time.
    """
    base = shared_path(spark, "scan", unique=True)
    digests = f"{inventory_path.rstrip('/')}-digests"
    known, number = _last_digests(spark, digests)
    list_files(spark, root, glob, with_md5=True, known=known if reuse_digests else None).write.parquet(f"{base}/listing")
    listing = spark.read.parquet(f"{base}/listing")
    good = listing.filter(F.col("error").isNull())
    scan_rows(good, root).write.parquet(f"{base}/rows")
    flagged = flag_latest(first_seen(spark.read.parquet(f"{base}/rows")))
    existing = read_inventory(spark, inventory_path)
    fresh = unseen(flagged.select("relative_path"), existing).withColumn("_new", F.lit(True)).distinct()
    flagged.join(fresh, "relative_path", "left").withColumn("_new", F.coalesce("_new", F.lit(False))).write.parquet(
        f"{base}/flagged")
    stored = spark.read.parquet(f"{base}/flagged")
    added = stored.filter("_new").drop("_new")
    summary = stored.agg(F.count(F.lit(1)).alias("total_files"), F.count_if("_new").alias("added_files"),
                         F.count_if(~F.col("_new")).alias("skipped_files"))
    if write:
        append_inventory(added, inventory_path)
        good.select("path", "length", "modificationTime", "md5_hash").write.mode("overwrite").parquet(
            f"{digests}/scan={number + 1}")
    errors = listing.filter(F.col("error").isNotNull()).select("path", "length", "error")
    return ScanResult(stored.drop("_new"), added, summary, errors)


def current_inventory(spark: SparkSession, inventory_path: str, mode: str = "corrected") -> DataFrame:
    """The inventory as stored (``parity``: flags as appended, possibly more
    than one latest per group) or with flags recomputed over every stored
    row (``corrected``)."""
    stored = read_inventory(spark, inventory_path)
    if mode == "parity":
        return stored
    if mode != "corrected":
        raise ValueError("mode must be 'parity' or 'corrected'")
    return recompute_latest(stored)
