"""The latest flag kept up to date by a stream.

``latest_events`` holds, per group, the order key of its latest row as keyed
state, and emits an event each time another row takes its place: "gained" for
the new latest path, "lost" for the one before. The events are an append-only
table; ``flags_from_events`` applies them to the stored rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"

_ROW = "group_key string, rev bigint, at bigint, path string"
_EVENT = "group_key string, seq bigint, event string, path string"
_ORDER = ["rev", "at", "path"]


def _best_of_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The latest row of each group within an Arrow batch, so that a group
    that holds a third of all rows moves a row a batch only."""
    for pdf in batches:
        ranked = pdf.sort_values(_ORDER, ascending=[False, False, True], kind="stable")
        yield ranked.drop_duplicates("group_key")


class _LatestPerGroup(StatefulProcessor):
    """State of a group: number of events so far and its latest row."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._latest = handle.getValueState("latest", "rev bigint, at bigint, path string, seq bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self._latest.get() if self._latest.exists() else None
        best = None
        for pdf in rows:
            for rev, at, path in zip(pdf["rev"], pdf["at"], pdf["path"]):
                row = (-int(rev), -int(at), path)
                best = row if best is None else min(best, row)
        if best is None or held is not None and (-held[0], -held[1], held[2]) <= best:
            return
        seq = held[3] if held is not None else 0
        events = [] if held is None else [(key[0], seq + 1, "lost", held[2])]
        events.append((key[0], seq + len(events) + 1, "gained", best[2]))
        self._latest.update((-best[0], -best[1], best[2], events[-1][1]))
        yield pd.DataFrame(events, columns=["group_key", "seq", "event", "path"])

    def close(self) -> None:
        pass


@contextmanager
def _rocksdb(spark: SparkSession):
    """Keyed state needs the RocksDB store; a query takes over the setting
    that holds when it is started."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def latest_events(rows: DataFrame, out_path: str, checkpoint: str, group: str = "group_key",
                  number: str = "revision_number", time: str = "creation_time", path: str = "relative_path",
                  available_now: bool = True):
    """Start the event query over a stream of inventory rows; returns the
    StreamingQuery, which appends ``group_key, seq, event, path`` to the
    Parquet table ``out_path``.

    The order of rows is that of ``flag_latest``: highest revision number,
    newest time, smallest path; a missing number or time counts as -1, a
    missing path as '', a null group is a group of its own. A row that arrives
    late changes nothing unless it ranks first. ``seq`` counts the events of a
    group. State is one small row a group. The file sink and the checkpoint
    take each batch once, so a restart repeats no event.
    """
    at = F.unix_micros(F.col(time)) if dict(rows.dtypes)[time].startswith("timestamp") else F.col(time).cast("bigint")
    keyed = rows.select(F.col(group).cast("string").alias("group_key"),
                        F.coalesce(F.col(number).cast("bigint"), F.lit(-1)).alias("rev"),
                        F.coalesce(at, F.lit(-1)).alias("at"), F.coalesce(F.col(path), F.lit("")).alias("path"))
    events = keyed.mapInPandas(_best_of_batch, _ROW).groupBy("group_key").transformWithStateInPandas(
        _LatestPerGroup(), _EVENT, "Append", "None")
    writer = events.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    with _rocksdb(rows.sparkSession):
        return writer.start()


def flags_from_events(stored: DataFrame, events: DataFrame, group: str = "group_key", path: str = "relative_path",
                      flag: str = "is_latest") -> DataFrame:
    """The stored rows with the flag that the events leave them with: true
    where the last event of (group, path) is "gained". Rows that share group
    and path share the flag. The join is on group and path, which no hot group
    makes heavy."""
    last = events.groupBy("group_key", "path").agg(F.max_by("event", "seq").alias("_event")).filter(
        F.col("_event") == "gained").select(F.col("group_key").alias("_group"), F.col("path").alias("_path"), "_event")
    base = stored.drop(flag).withColumn("_at", F.coalesce(F.col(path), F.lit("")))
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_at") == F.col("_path"))
    flagged = base.join(last, same, "left").withColumn(flag, F.col("_event").isNotNull())
    return flagged.select(*(stored.columns if flag in stored.columns else [*stored.columns, flag]))


def latest_by_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory after two append-only runs, its flags kept by the event
    stream: the rows of the earlier run arrive first, the new ones in two lots
    after it, and the stream is started again for each from its checkpoint.
    Returns the stored rows with the flags that the events leave."""
    from vellum.plans.catalogue import earlier_inventory, new_rows
    from vellum.session import shared_path

    base = shared_path(spark, "latest_events", unique=True)
    store, out = f"{base}/inventory", f"{base}/events"
    fresh = new_rows(spark, sf_dir)
    half = F.pmod(F.xxhash64("relative_path"), F.lit(2))
    for lot in (earlier_inventory(spark, sf_dir), fresh.filter(half == 0), fresh.filter(half == 1)):
        lot.write.mode("append").parquet(store)
        stream = spark.readStream.schema(spark.read.parquet(store).schema).parquet(store)
        latest_events(stream, out, f"{base}/checkpoint").awaitTermination()
    return flags_from_events(spark.read.parquet(store), spark.read.parquet(out))
