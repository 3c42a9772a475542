"""Dealing file work to tasks by bytes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

TASK_BYTES = 256 << 20   # a task's share of bytes, if there is work enough
FILE_BYTES = 64 << 10    # what opening a file counts for
_LANES = 1024


def deal(files: DataFrame, path: str, size: Column | None = None, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The rows of ``files``, cut into tasks of about equal bytes.

    Rows of paths are small, so that partitions cut by their own size would
    leave all files to one task. Here files are put in one order (by a hash
    lane, then path), their bytes are summed along it, and the sum tells the
    task: as many tasks as the cluster has cores at least, more if a task got
    over ``task_bytes``, never more than files. A file larger than a task's
    share has its range to itself. The number of tasks is fixed, so adaptive
    execution does not merge them. Sums run inside lanes, and over the
    ``_LANES`` totals. Null paths and sizes count as empty; all columns are
    kept; an empty table stays empty.
    """
    spark = files.sparkSession
    weight = F.greatest(F.coalesce(size.cast("long") if size is not None else F.lit(0).cast("long"), F.lit(0).cast("long")), F.lit(0).cast("long")) + FILE_BYTES
    rows = files.withColumns({"__lane": F.pmod(F.xxhash64(F.col(path)), F.lit(_LANES)), "__weight": weight})
    lanes = rows.groupBy("__lane").agg(F.sum("__weight").alias("__sum"), F.count(F.lit(1)).alias("__n"))
    n, total = lanes.agg(F.sum("__n"), F.sum("__sum")).first()
    if not n:
        return files
    tasks = max(1, min(n, max(spark.sparkContext.defaultParallelism, math.ceil(total / task_bytes))))
    before = F.sum("__sum").over(Window.orderBy("__lane").rowsBetween(Window.unboundedPreceding, -1))  # _LANES rows
    starts = lanes.select("__lane", F.coalesce(before, F.lit(0)).alias("__start"))
    inside = F.sum("__weight").over(Window.partitionBy("__lane").orderBy(path).rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.withColumn("__inside", inside).join(starts, "__lane")
    # a file lies where its middle lies
    task = F.floor((F.col("__start") + F.col("__inside") - F.col("__weight") / 2) * tasks / total).cast("int")
    dealt = placed.withColumn("__task", F.least(F.greatest(task, F.lit(0)), F.lit(tasks - 1)))
    return dealt.repartitionById(tasks, F.col("__task")).select(*files.columns)
