"""Reduce the files of an inventory with an injected reducer."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from vellum.functions.revision import has_reduced_suffix
from vellum.operators import reduction
from vellum.session import cut_lineage
from vellum.sources.files import PDF_GLOB, list_files, relative_to


@dataclass
class ReduceResult:
    plan: DataFrame        # per row: action, source_path, destination
    results: DataFrame     # per reduced file: sizes, md5, error
    inventory: DataFrame   # updated inventory rows
    accounting: DataFrame  # n_reduced, bytes before/after, saved (B, MiB, GiB)


def reduce_inventory(spark: SparkSession, inventory: DataFrame, base_dir: str,
                     reducer: Callable[[bytes], bytes], output_dir: str | None = None,
                     replace_original: bool = True) -> ReduceResult:
    """Reduce every row not reduced yet, in two stages that survive task
    retries: reduce into staged files (sources untouched), store the
    results, then move the staged files into place. A file that several rows
    name is reduced and accounted once. The stored results feed the
    accounting and the inventory update, so nothing is reduced twice."""
    plan = cut_lineage(reduction.reduction_plan(inventory, base_dir, output_dir, replace_original), spark)
    staged = cut_lineage(reduction.reduce_files(plan, reducer), spark)
    results = cut_lineage(reduction.commit_files(staged), spark)
    updated = reduction.reduction_writeback(plan, results)
    return ReduceResult(plan, results, updated, reduction.reduction_accounting(results))


def reduce_directory(spark: SparkSession, input_dir: str, reducer: Callable[[bytes], bytes],
                     output_dir: str | None = None, glob: str = PDF_GLOB) -> ReduceResult:
    """Reduce every PDF below ``input_dir`` (S3, P23). Files whose stem
    already ends in '-reduced' are skipped; the others are written beside
    the source as ``<stem>-reduced<suffix>`` or, with ``output_dir``, to the
    same relative place under it. ``results`` is ordered by path when shown
    (``orderBy('source_path')``); no ordering is imposed on the work."""
    import os
    root = os.path.abspath(input_dir).rstrip("/")
    files = list_files(spark, root, glob, with_md5=False)
    p = F.col("path")
    if output_dir is None:
        destination = reduction.reduced_name(p)
    else:
        destination = reduction.reduced_name(
            F.concat(F.lit(os.path.abspath(output_dir).rstrip("/") + "/"), relative_to(p, root)))
    skip = has_reduced_suffix(p)
    plan = cut_lineage(files.select(
        p.alias("source_path"),
        F.when(skip, F.lit("already_reduced")).otherwise(F.lit("reduce")).alias("action"),
        F.when(skip, p).otherwise(destination).alias("destination"),
        F.lit(True).alias("reduced_after")), spark)
    staged = cut_lineage(reduction.reduce_files(plan, reducer), spark)
    results = cut_lineage(reduction.commit_files(staged), spark)
    return ReduceResult(plan, results, plan, reduction.reduction_accounting(results))
