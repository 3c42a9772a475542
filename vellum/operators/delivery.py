"""Upload manifest, name collisions and the object-store sink."""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from vellum.functions.naming import upload_name as upload_name_expr
from vellum.sources import storage
from vellum.sources.deal import deal


def with_upload_name(rows: DataFrame, path: str = "relative_path",
                     explicit: str | None = "upload_name", sanitize_explicit: bool = False) -> DataFrame:
    """Fill ``upload_name``. A stored name is used as it is (it was sanitised
    when the row was written); a blank one is generated from the path. With
    ``sanitize_explicit`` a user-given name is sanitised first (P12b)."""
    e = F.col(explicit) if explicit and explicit in rows.columns else None
    if e is None:
        return rows.withColumn("upload_name", upload_name_expr(F.col(path)))
    if sanitize_explicit:
        return rows.withColumn("upload_name", upload_name_expr(F.col(path), e))
    return rows.withColumn("upload_name", F.when(F.coalesce(e, F.lit("")) != "", e)
                           .otherwise(upload_name_expr(F.col(path))))


def name_winners(rows: DataFrame, name: str = "upload_name", path: str = "relative_path") -> DataFrame:
    """First path (smallest) per upload name, as an aggregate (no hot key)."""
    return rows.groupBy(name).agg(F.min(path).alias(path))


def split_by_name(rows: DataFrame, name: str = "upload_name", path: str = "relative_path",
                  local: str = "full_path") -> tuple[DataFrame, DataFrame]:
    """(the row of each name with the smallest path, result rows of the
    others). The winner is an aggregate over (path, local path)."""
    best = rows.groupBy(name).agg(F.min(F.struct(F.coalesce(path, F.lit("")).alias("p"),
                                                 F.coalesce(local, F.lit("")).alias("l"))).alias("_best"),
                                  F.count(F.lit(1)).alias("_n"))
    winners = best.select(name, F.col("_best.p").alias(path), F.col("_best.l").alias(local))
    pairs = rows.select(F.col(name), F.coalesce(path, F.lit("")).alias("_p"), F.coalesce(local, F.lit("")).alias("_l"))
    # only names that several rows share are looked at again
    shared = best.filter(F.col("_n") > 1).select(F.col(name).alias("_name"), "_best")
    ranked = pairs.groupBy(name, "_p", "_l").agg(F.count(F.lit(1)).alias("_rows")).join(
        shared, F.col(name).eqNullSafe(F.col("_name")))
    first = (F.col("_p") == F.col("_best.p")) & (F.col("_l") == F.col("_best.l"))
    extra = ranked.withColumn("_rows", F.col("_rows") - F.when(first, 1).otherwise(0)).filter(F.col("_rows") > 0)
    others = extra.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_rows")))).select(
        F.col(name).alias("upload_name"), F.col("_l").alias("local_path"),
        F.lit("duplicate_name").alias("status"), F.lit(None).cast("string").alias("error"))
    return winners, others


def upload_collisions(rows: DataFrame, name: str = "upload_name",
                      path: str = "relative_path") -> DataFrame:
    """Upload names shared by more than one path (Q12)."""
    return (rows.groupBy(name)
                .agg(F.count(F.lit(1)).alias("n_paths"), F.min(path).alias("kept_path"))
                .filter(F.col("n_paths") > 1))


def upload_manifest(rows: DataFrame, listing: DataFrame, local: str = "full_path",
                    name: str = "upload_name", path: str = "relative_path",
                    listing_path: str = "path") -> DataFrame:
    """Per row: whether the local file exists (J5, F8) and whether another
    path with the same name overrides it (first path wins)."""
    files = listing.select(F.col(listing_path).alias("_local"), F.lit(True).alias("_exists"))
    winners = name_winners(rows, name, path).select(path, F.lit(True).alias("_first")).distinct()
    # a blank local path has no file: spread over random keys that match none
    probe = F.when(F.coalesce(F.col(local), F.lit("")) != "", F.col(local)).otherwise(
        F.concat(F.lit("\0"), F.xxhash64(path, name).cast("string")))
    j = (rows.withColumn("_local", probe).join(files, "_local", "left")
             .join(winners, path, "left"))
    exists = F.coalesce(F.col("_exists"), F.lit(False))
    first = F.coalesce(F.col("_first"), F.lit(False))
    status = (F.when(~exists, F.lit("missing"))
              .when(first, F.lit("upload"))
              .otherwise(F.lit("duplicate_name")))
    return j.select(*rows.columns, exists.alias("file_exists"), first.alias("first_for_name"),
                    status.alias("status")).drop("_local")


UPLOAD_RESULT = T.StructType([
    T.StructField("upload_name", T.StringType()),
    T.StructField("local_path", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
])


def upload(manifest: DataFrame, put_factory: Callable[[], Callable[[str, bytes], None]],
           local: str = "full_path", name: str = "upload_name",
           read: Callable[[str], bytes] = storage.read_bytes, concurrency: int | None = None,
           size: str = "file_size") -> DataFrame:
    """Push each row's file with the injected ``put(name, data)``.

    Runs inside ``mapInPandas``; one client per partition; a failure is a
    'failed' row and the run continues. Existing objects are overwritten.
    Files are dealt to tasks by the bytes in column ``size``, if there is one,
    to ``concurrency`` tasks at most.
    """
    bytes_ = F.col(size).try_cast("long") if size in manifest.columns else F.lit(None).cast("long")
    src = manifest.select(F.col(name).alias("upload_name"), F.col(local).alias("local_path"), bytes_.alias("bytes"))
    src = deal(src, "upload_name", F.col("bytes")).drop("bytes")
    if concurrency:
        src = src.coalesce(concurrency)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        put = put_factory()
        for pdf in batches:
            out = []
            for blob, loc in zip(pdf["upload_name"], pdf["local_path"]):
                try:
                    if not loc:
                        raise FileNotFoundError("row has no local path")
                    put(blob, read(loc))
                    out.append((blob, loc, "uploaded", None))
                except Exception as exc:
                    out.append((blob, loc, "failed", f"{type(exc).__name__}: {exc}"))
            yield pd.DataFrame(out, columns=["upload_name", "local_path", "status", "error"])

    return src.mapInPandas(run, UPLOAD_RESULT)


def upload_summary(results: DataFrame) -> DataFrame:
    """Uploaded / failed / not put for a shared name."""
    return results.agg(F.count_if(F.col("status") == "uploaded").alias("uploaded"),
                       F.count_if(F.col("status") == "failed").alias("failed"),
                       F.count_if(F.col("status") == "duplicate_name").alias("duplicates"))


def directory_put(root: str) -> Callable[[], Callable[[str, bytes], None]]:
    """A put factory writing objects under a folder, a path or a URI that all
    executors share."""
    def factory():
        def put(name: str, data: bytes) -> None:
            if not name:
                raise ValueError("empty object name")
            storage.write_bytes(f"{root.rstrip('/')}/{name}", data)
        return put
    return factory
