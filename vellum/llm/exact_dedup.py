"""Exact dedup with a heavy-hitter split, in DataFrame functions only.

Method: a Misra-Gries summary (Spark's ``approx_top_k`` functions, a
counter-based frequent-items sketch) is built per input partition and merged
in two levels; it yields a bounded list that holds every digest of more than
``1/share`` of the rows. These heavy digests are counted exactly, and their
winners, at most ``share`` rows, are broadcast: rows of heavy groups are
settled in the map stage and never shuffled. All other digests have small
groups and meet in an ordinary shuffle of (doc_id, digest) rows; texts are
never shuffled.

Defined results: a null text counts as empty; the largest non-null id of a
group stays; ids are compared with nulls last, so in a group of null ids only
the null stays; rows that share both id and text are one document, kept or
dropped together (``distinct_rows`` keeps one of them); an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from vellum.session import shared_path

SHARE = 1024
TRACKED = 8192  # counters of a summary: its error is below 4/TRACKED of the rows
FAN_IN = 64


def text_digest(text: str):
    """SHA-256 of the text with A-Z lower-cased, null as empty."""
    folded = F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.sha2(folded, 256)


def heavy_digests(digests: DataFrame, share: int = SHARE, tracked: int = TRACKED) -> DataFrame:
    """At most ``share`` digests, among them each that holds more than
    ``1/share`` of the rows."""
    part = F.pmod(F.spark_partition_id(), F.lit(FAN_IN))
    partial = (digests.withColumn("part", part).groupBy("part")
               .agg(F.expr(f"approx_top_k_accumulate(text_sha256, {tracked})").alias("summary")))
    # grouped by a constant, so that a partition without summaries adds no empty one
    top = partial.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(summary, {tracked}), {share})").alias("top"))
    return top.select(F.explode("top").alias("t")).select(F.col("t.item").alias("text_sha256")) \
        .where(F.col("text_sha256").isNotNull())


def group_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = SHARE,
                 tracked: int = TRACKED) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    path = shared_path(spark, "exact_dedup", unique=True)
    docs.select(F.col(doc_id).alias("doc_id"), text_digest(text).alias("text_sha256")).write.parquet(path)
    digests = spark.read.parquet(path)
    heavy = heavy_digests(digests, share, tracked)
    # at most `share` rows of about 100 bytes: the bound that the broadcasts rest on
    winners = (digests.join(F.broadcast(heavy), "text_sha256").groupBy("text_sha256")
               .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    settled = digests.join(F.broadcast(winners), "text_sha256", "left")
    light_window = Window.partitionBy("text_sha256")
    light = (settled.where(F.col("group_size").isNull()).select("doc_id", "text_sha256")
             .withColumn("keep_id", F.max("doc_id").over(light_window))
             .withColumn("group_size", F.count(F.lit(1)).over(light_window)))
    columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
    both = settled.where(F.col("group_size").isNotNull()).select(*columns).unionByName(light.select(*columns))
    return both.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                       "text_sha256")


def distinct_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns, one per group of equal
    texts. Repeated rows with the same id are reduced to one."""
    kept = group_copies(docs, doc_id, text).where("kept").select(
        F.col("doc_id").alias("__kept"), F.col("text_sha256").alias("__kept_text")).distinct()
    rows = docs.withColumn("__digest", text_digest(text))
    same = (F.col("__digest") == F.col("__kept_text")) & rows[doc_id].eqNullSafe(F.col("__kept"))
    return rows.join(kept, same, "left_semi").dropDuplicates([doc_id, "__digest"]).drop("__digest")
