"""Structured Streaming ingest equals the batch plan; restarts add nothing."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from vellum.operators.dedup import first_seen
from vellum.plans import catalogue
from vellum.sources.fixtures import doc_files_of, scan_listing_of
from vellum.streaming.ingest import (BATCH_COL, dedup_documents_stream, dedup_stream, ingest_documents_stream,
                                     ingest_in_batches, ingest_stream)

from conftest import SF_SMALL


def _key(df):
    return sorted(tuple(r) for r in df.select("relative_path", "group_key", "is_latest", "md5_hash").collect())


def test_stream_equals_batch(spark):
    assert _key(catalogue.incremental_ingest(spark, SF_SMALL)) == _key(catalogue.new_files(spark, SF_SMALL))


def test_restart_adds_no_rows(spark, tmp_path):
    src = str(tmp_path / "incoming")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs.filter(F.col("doc_id") < 100).write.parquet(src + "/b1")
    inv, ckpt = str(tmp_path / "inv"), str(tmp_path / "ckpt")
    from pyspark.sql import types as T
    schema = scan_listing_of(doc_files_of(docs)).schema.add("is_latest", T.BooleanType()) \
        .add(BATCH_COL, T.LongType())
    spark.createDataFrame([], schema).write.parquet(inv)
    stream = spark.readStream.schema(docs.schema).option("recursiveFileLookup", "true").parquet(src)
    to_rows = lambda d: scan_listing_of(doc_files_of(d))
    ingest_stream(stream, inv, ckpt, to_rows).awaitTermination()
    n1 = spark.read.parquet(inv).count()
    ingest_stream(stream, inv, ckpt, to_rows).awaitTermination()
    assert spark.read.parquet(inv).count() == n1
    docs.filter(F.col("doc_id") >= 100).write.parquet(src + "/b2")
    ingest_stream(stream, inv, ckpt, to_rows).awaitTermination()
    total = spark.read.parquet(inv)
    assert total.count() > n1
    assert total.select("relative_path").distinct().count() == total.count()


def test_streaming_dedup(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stream = (spark.readStream.schema(docs.schema).option("pathGlobFilter", "documents.parquet")
              .parquet(SF_SMALL).select(F.md5("text").alias("md5_hash")))
    out = str(tmp_path / "out")
    dedup_stream(stream, "md5_hash", out, str(tmp_path / "ck")).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == docs.select(F.md5("text")).distinct().count()


def test_watermark_bounded_dedup(spark, tmp_path):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    stream = (spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet")
              .parquet(SF_SMALL).select("event_type", "ts"))
    out = str(tmp_path / "out")
    dedup_stream(stream, "event_type", out, str(tmp_path / "ck"), watermark_col="ts",
                 watermark="1 hour").awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() >= events.select("event_type").distinct().count()
    assert got.count() <= events.count()


def test_first_batch_creates_the_inventory(spark, tmp_path):
    src = str(tmp_path / "incoming")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs.write.parquet(src + "/b1")
    stream = spark.readStream.schema(docs.schema).option("recursiveFileLookup", "true").parquet(src)
    inv = str(tmp_path / "inv")
    ingest_stream(stream, inv, str(tmp_path / "ckpt"),
                  lambda d: scan_listing_of(doc_files_of(d))).awaitTermination()
    stored = spark.read.parquet(inv)
    assert stored.count() == docs.select(F.md5("text")).distinct().count()


def test_batches_take_every_language_and_rows_without_one(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    lang = F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("l"), (F.col("doc_id") % 150).cast("string")))
    text = F.when(F.col("doc_id") % 23 != 0, F.col("text"))
    docs.withColumn("lang", lang).withColumn("text", text).write.parquet(str(tmp_path / "documents.parquet"))
    rows = lambda df: sorted(map(repr, df.select("relative_path", "md5_hash").collect()))
    got = ingest_in_batches(spark, str(tmp_path))
    assert rows(got) == rows(catalogue.appended_inventory(spark, str(tmp_path)))
    assert got.filter("relative_path IS NULL").count() > 0


@pytest.mark.parametrize("parts", [0, 3])
def test_documents_stream_from_a_file_or_a_folder_of_parts(spark, tmp_path, parts):
    rows = [(k, "en", "web", f"text {k % 7}") for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, source string, text string")
    path = str(tmp_path / "documents.parquet")
    docs.repartition(parts or 1).write.parquet(path if parts else f"{path}-written")
    if not parts:
        part = next(f for f in os.listdir(f"{path}-written") if f.endswith(".parquet"))
        os.link(f"{path}-written/{part}", path)
    got = dedup_documents_stream(spark, str(tmp_path))
    assert sorted(r.md5_hash for r in got.collect()) == sorted(hashlib.md5(f"text {k}".encode()).hexdigest() for k in range(7))
    assert _key(ingest_documents_stream(spark, str(tmp_path))) == _key(catalogue.new_files(spark, str(tmp_path)))
