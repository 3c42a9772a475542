"""File work is dealt to tasks by bytes."""

from pyspark.sql import functions as F

from vellum.operators.delivery import upload
from vellum.operators.reduction import commit_files, reduce_files
from vellum.sources.deal import deal
from vellum.sources.files import hashed

FILES = "path string, length bigint, modificationTime timestamp, error string"


def files(spark, sizes):
    rows = [(f"/f/{k:05d}.pdf", n, None, "not read in this test") for k, n in enumerate(sizes)]
    return spark.createDataFrame(rows, FILES)


def tasks_with_rows(df):
    return df.groupBy(F.spark_partition_id().alias("task")).count().collect()


def test_many_small_files_use_every_core(spark):
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        listed = files(spark, [1000] * 20000)
        named = listed.select(F.col("path").alias("full_path"), F.col("path").alias("upload_name"), F.col("length").alias("file_size"))
        plan = listed.select(F.col("path").alias("source_path"), F.col("path").alias("destination"), F.lit("reduce").alias("action"))
        staged = reduce_files(plan, lambda data: data, read=lambda p: b"", write=lambda p, data: None)
        for work in (hashed(deal(listed, "path", F.col("length"))), staged, commit_files(staged, commit=lambda a, b, c: None),
                     upload(named, lambda: (lambda name, data: None), read=lambda p: b"")):
            found = tasks_with_rows(work)
            assert len(found) >= cores and sum(r["count"] for r in found) == 20000
            assert max(r["count"] for r in found) <= 2 * 20000 / len(found)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_a_large_file_holds_no_others_up(spark):
    big = 10 << 30
    dealt = deal(files(spark, [1 << 20] * 3000 + [big]), "path", F.col("length"))
    tasks = dealt.groupBy(F.spark_partition_id().alias("t")).agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("b"), F.max("length").alias("m")).collect()
    assert sum(r["n"] for r in tasks) == 3001
    assert max(r["b"] - (r["m"] if r["m"] == big else 0) for r in tasks) <= 2 * (256 << 20)


def test_empty_null_and_repeated(spark):
    assert deal(files(spark, []), "path").count() == 0
    rows = spark.createDataFrame([(None, None, None, None), (None, -5, None, "x"), ("a", None, None, None), ("a", 3, None, None)], FILES)
    assert sorted(map(str, deal(rows, "path", F.col("length")).collect())) == sorted(map(str, rows.collect()))
