"""Exact-content dedup (A1) and duplicate accounting (A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def first_seen(df: DataFrame, key: str = "md5_hash",
               order: tuple[str, ...] = ("relative_path",)) -> DataFrame:
    """Keep one row per ``key``: the smallest ``order`` (A1).

    ``row_number() = 1`` is planned as a partial WindowGroupLimit before the
    shuffle, so a key held by a third of all rows still sends at most one
    row per input partition over the network.
    """
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))


def duplicate_groups(df: DataFrame, key: str = "md5_hash",
                     path: str = "relative_path") -> DataFrame:
    """Keys held by more than one row, with the copy that is kept (A2).
    A plain aggregate: partial counts are combined map-side."""
    return (df.groupBy(key)
              .agg(F.count(F.lit(1)).alias("copies"), F.min(path).alias("kept_path"))
              .filter(F.col("copies") > 1))


def duplicate_summary(df: DataFrame, key: str = "md5_hash") -> DataFrame:
    """One row: rows seen, distinct contents, duplicates skipped."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").cast("bigint").alias("files_seen"),
        F.count(F.lit(1)).alias("distinct_contents"),
        (F.sum("n") - F.count(F.lit(1))).cast("bigint").alias("duplicates_skipped"),
    )
