"""Spreading under-split inputs across the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, keys: tuple[str, ...], min_partitions: int | None = None) -> DataFrame:
    """Hash-partition ``df`` on ``keys`` when its scan yields fewer
    partitions than ``min_partitions`` (default: the cluster's default
    parallelism). Keys should be unique per row so no partition is hot; an
    explicit partition count is kept as is by adaptive execution."""
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # no RDD view (e.g. a Spark Connect session): leave the input as it is
        return df
    if current >= target:
        return df
    return df.repartition(target, *keys)
