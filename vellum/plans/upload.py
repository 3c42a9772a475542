"""Upload inventoried files to an object store."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from vellum.operators import delivery
from vellum.session import cut_lineage


@dataclass
class UploadResult:
    results: DataFrame     # upload_name, local_path, status, error
    summary: DataFrame     # uploaded, failed
    collisions: DataFrame  # names shared by several paths (the first is put)


def upload_inventory(spark: SparkSession, inventory: DataFrame,
                     put_factory: Callable[[], Callable[[str, bytes], None]],
                     concurrency: int | None = None) -> UploadResult:
    """Put one file under each upload name: of rows that share a name the
    first path wins, the others are 'duplicate_name' rows and are not put, so
    the stored object does not depend on scheduling. A missing file or a
    failed put is a 'failed' row and the run goes on. Results are
    checkpointed so counting them does not upload twice."""
    rows = delivery.with_upload_name(inventory)
    winners, others = delivery.split_by_name(rows)
    put = delivery.upload(winners, put_factory, concurrency=concurrency)
    results = cut_lineage(put.unionByName(others), spark)
    return UploadResult(results, delivery.upload_summary(results), delivery.upload_collisions(rows))
