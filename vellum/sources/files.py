"""File listings made by the executors."""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from vellum.functions.revision import (file_name, file_stem, revision_group_key, revision_label,
                                       revision_number)
from vellum.session import shared_path
from vellum.sources.deal import deal

# Endings of the files that are listed.
PDF_GLOB = "*.[pP][dD][fF]"
MSG_GLOB = "*.msg"

_ENTRY = "path string, folder boolean, length bigint, modificationTime timestamp, error string"


def _level(folders: DataFrame) -> DataFrame:
    """The entries of each folder; one that cannot be read is an error row."""
    def run(batches):
        from pyarrow import fs
        from vellum.sources.storage import filesystem
        for pdf in batches:
            rows = []
            for folder in pdf["path"]:
                try:
                    system, at = filesystem(folder)
                    for e in system.get_file_info(fs.FileSelector(at)):
                        rows.append((f"{folder.rstrip('/')}/{e.base_name}", e.type == fs.FileType.Directory, e.size, e.mtime, None))
                except Exception as exc:
                    rows.append((folder, False, None, None, f"{type(exc).__name__}: {exc}"))
            yield pd.DataFrame(rows, columns=["path", "folder", "length", "modificationTime", "error"]).astype(
                {"length": "Int64", "modificationTime": "datetime64[us, UTC]"})
    return folders.mapInPandas(run, _ENTRY)


def hashed(files: DataFrame) -> DataFrame:
    """MD5 of each file, read in chunks, so any size fits a task."""
    def run(batches):
        from vellum.sources.storage import md5_of
        for pdf in batches:
            digests, errors = [], []
            for path, error in zip(pdf["path"], pdf["error"]):
                digest = None
                if error is None:
                    try:
                        digest = md5_of(path)
                        error = None if digest else "not a file"
                    except Exception as exc:
                        error = f"{type(exc).__name__}: {exc}"
                digests.append(digest)
                errors.append(error)
            yield pdf.assign(md5_hash=digests, error=errors)
    return files.mapInPandas(run, "path string, length bigint, modificationTime timestamp, error string, md5_hash string")


def list_files(spark: SparkSession, root: str, glob: str = PDF_GLOB, with_md5: bool = True,
               known: DataFrame | None = None) -> DataFrame:
    """Recursive listing with size, modification time and MD5 of the content,
    of files of any name and size.

    Folders are read level by level, each level by a job over the folders
    that the last one found, and stored; the files are then dealt to tasks
    again and hashed there in chunks. Only path, size, time and digest move.
    A folder or file that cannot be read is a row with an ``error``. ``known``
    (path, length, modificationTime, md5_hash; a row a path) spares files whose
    size and time are as they were: they keep that digest and are not opened.
    """
    base = shared_path(spark, "listing", unique=True)
    level = spark.createDataFrame([(root.rstrip("/") or "/",)], "path string")
    depth = 0
    while True:
        _level(level).write.parquet(f"{base}/entries/depth={depth}")
        entries = spark.read.parquet(f"{base}/entries/depth={depth}")
        level = entries.filter("folder").select("path")
        if level.isEmpty():
            break
        level = deal(level, "path")
        depth += 1
    pattern = "(?s).*[.](?i:pdf)" if glob == PDF_GLOB else "(?s).*" + glob.lstrip("*").replace(".", "[.]")
    entries = spark.read.parquet(f"{base}/entries")
    found = entries.filter(~F.col("folder") & (F.col("error").isNotNull() | F.col("path").rlike(f"^{pattern}$")))
    files = found.select("path", "length", "modificationTime", "error")
    if not with_md5:
        return files.filter(F.col("error").isNull()).drop("error")
    columns = ["path", "length", "modificationTime", "md5_hash", "error"]
    if known is None:
        return hashed(deal(files, "path", F.col("length"))).select(*columns)
    held = known.select(F.col("path").alias("_path"), F.col("length").alias("_length"),
                        F.col("modificationTime").alias("_time"), "md5_hash")
    same = (F.col("path") == F.col("_path")) & (F.col("length") == F.col("_length")) & (
        F.col("modificationTime") == F.col("_time")) & F.col("error").isNull()
    # stored, since dealing looks at what is left twice
    files.join(held, same, "left").select(*columns).write.parquet(f"{base}/compared")
    compared = spark.read.parquet(f"{base}/compared")
    changed = compared.filter(F.col("md5_hash").isNull()).drop("md5_hash")
    anew = hashed(deal(changed, "path", F.col("length"))).select(*columns)
    return compared.filter(F.col("md5_hash").isNotNull()).unionByName(anew)


def parent_of(root: str) -> str:
    """Parent folder of a local path or of a scheme-qualified URI."""
    if "://" in root or root.startswith("file:"):
        return root.rstrip("/").rsplit("/", 1)[0]
    return os.path.dirname(os.path.abspath(root).rstrip("/")) or "/"


def relative_to(path_col, base: str):
    """Path relative to ``base``, or the whole path when outside it."""
    prefix = base.rstrip("/") + "/"
    return F.when(F.startswith(path_col, F.lit(prefix)),
                  F.substring(path_col, len(prefix) + 1, 1 << 30)).otherwise(path_col)


def scan_rows(listing: DataFrame, root: str) -> DataFrame:
    """Inventory rows of a listing (P1): names, paths relative to the root's
    parent, size, reduced-name flag, revision parse, time and MD5."""
    base = parent_of(root)
    p = F.col("path")
    listing = listing.select("*", file_stem(p).alias("_stem"))
    listing = listing.select("*", revision_label(F.col("_stem")).alias("_revision"))
    stem, revision = F.col("_stem"), F.col("_revision")
    return listing.select(
        file_name(p).alias("filename"),
        p.alias("full_path"),
        relative_to(p, base).alias("relative_path"),
        F.col("length").cast("bigint").alias("file_size"),
        F.endswith(F.lower(stem), F.lit("-reduced")).alias("reduced"),
        F.lit(None).cast("string").alias("upload_name"),
        revision_group_key(stem).alias("group_key"),
        revision.alias("revision"),
        revision_number(revision).alias("revision_number"),
        F.col("modificationTime").alias("creation_time"),
        F.col("md5_hash"),
    )
