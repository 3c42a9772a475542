"""Latest flags kept by a stateful stream: events against the batch flags."""

import random

from pyspark.sql import functions as F

from vellum.operators.latest import flag_latest
from vellum.streaming.latest import flags_from_events, latest_events

SCHEMA = "group_key string, revision_number int, creation_epoch bigint, relative_path string"


def _flags(df):
    return sorted(map(repr, df.select("group_key", "relative_path", "is_latest").collect()))


def _take(spark, store, out, checkpoint):
    stream = spark.readStream.schema(SCHEMA).parquet(store)
    latest_events(stream, out, checkpoint, time="creation_epoch").awaitTermination()
    return spark.read.parquet(out)


def test_events_of_three_lots_and_a_restart(spark, tmp_path):
    store, out, checkpoint = (str(tmp_path / n) for n in ("store", "out", "checkpoint"))
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "b", "c", None, ""]), rng.choice([None, 0, 1, 2, 3]), rng.choice([None, 5, 9]),
             None if k == 77 else f"docs/ü{k:03d}") for k in range(240)]
    for lot in range(3):
        spark.createDataFrame(rows[lot::3], SCHEMA).write.mode("append").parquet(store)
        events = _take(spark, store, out, checkpoint)
        stored = spark.read.parquet(store)
        assert _flags(flags_from_events(stored, events)) == _flags(flag_latest(stored, time="creation_epoch"))
    seen = sorted(map(repr, events.collect()))
    again = _take(spark, store, out, checkpoint)
    assert sorted(map(repr, again.collect())) == seen
    per_group = again.groupBy("group_key").agg(F.count_if(F.col("event") == "gained").alias("g"),
                                               F.count_if(F.col("event") == "lost").alias("l")).collect()
    assert per_group and all(r.g == r.l + 1 for r in per_group)


def test_a_late_row_of_lower_rank_makes_no_event(spark, tmp_path):
    store, out, checkpoint = (str(tmp_path / n) for n in ("store", "out", "checkpoint"))
    spark.createDataFrame([("g", 2, 10, "a")], SCHEMA).write.mode("append").parquet(store)
    _take(spark, store, out, checkpoint)
    spark.createDataFrame([("g", 1, 99, "b"), ("g", 2, 10, "b")], SCHEMA).write.mode("append").parquet(store)
    assert [tuple(r) for r in _take(spark, store, out, checkpoint).collect()] == [("g", 1, "gained", "a")]
    spark.createDataFrame([("g", 2, 11, "c")], SCHEMA).write.mode("append").parquet(store)
    got = sorted(tuple(r) for r in _take(spark, store, out, checkpoint).collect())
    assert got == [("g", 1, "gained", "a"), ("g", 2, "lost", "a"), ("g", 3, "gained", "c")]
