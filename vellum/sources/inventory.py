"""Inventory tables: typed Parquet at rest, CSV for import/export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.errors import AnalysisException

from vellum.functions.naming import upload_name
from vellum.functions.replies import format_confidence
from vellum.functions.revision import format_epoch
from vellum.schema import FULL_SCHEMA, INVENTORY_FIELDS, INVENTORY_SCHEMA, RESULT_FIELDS, align

_BOM = "﻿"


def read_inventory(spark: SparkSession, path: str, schema: T.StructType = FULL_SCHEMA) -> DataFrame:
    """The stored inventory; an absent table is an empty one."""
    try:
        return align(spark.read.parquet(path), schema)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc) \
                or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return spark.createDataFrame([], schema)
        raise


def read_csv_inventory(spark: SparkSession, path: str, schema: T.StructType = FULL_SCHEMA,
                       required_any: tuple[str, ...] = (), keep_extra: bool = False) -> DataFrame:
    """Read a CSV inventory of any generation.

    Every value is read as text, a BOM on the first header is dropped,
    quoted newlines and doubled quotes follow the CSV dialect, and the
    columns are aligned by name to ``schema``.
    """
    try:
        raw = (spark.read.option("header", "true").option("multiLine", "true")
               .option("quote", '"').option("escape", '"').option("inferSchema", "false")
               .option("encoding", "UTF-8").csv(path))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return spark.createDataFrame([], schema)
        raise
    renamed = raw.toDF(*[c.lstrip(_BOM) for c in raw.columns])
    if required_any and not any(c in renamed.columns for c in required_any):
        raise ValueError(f"inventory must contain one of: {', '.join(required_any)}")
    return align(renamed, schema, keep_extra=keep_extra)


def export_rows(df: DataFrame, with_results: bool = True) -> DataFrame:
    """The CSV dialect of inventory rows (P14, P31, T8): every value text,
    booleans 'True'/'False', missing ''. A stored ``upload_name`` is kept
    as it is (it was sanitised when the row was first written); a missing
    one is generated from the path (P11)."""
    aligned = align(df, FULL_SCHEMA if with_results else INVENTORY_SCHEMA)

    def text(c: str):
        col = F.col(c)
        dtype = aligned.schema[c].dataType
        if isinstance(dtype, T.BooleanType):
            out = F.when(col, F.lit("True")).when(~col, F.lit("False"))
        elif isinstance(dtype, T.TimestampType):
            out = format_epoch(F.unix_seconds(col))
        elif c == "llm_confidence":
            out = format_confidence(col)
        elif c == "upload_name":
            out = F.when(F.coalesce(col, F.lit("")) != "", col).otherwise(upload_name(F.col("relative_path")))
        else:
            out = col.cast("string")
        if c == "reduced":
            out = F.coalesce(out, F.lit("False"))
        return F.coalesce(out, F.lit("")).alias(c)

    fields = INVENTORY_FIELDS + (RESULT_FIELDS if with_results else [])
    return aligned.select(*[text(c) for c in fields])


def write_csv_inventory(df: DataFrame, path: str, with_results: bool = True) -> None:
    """Write the CSV dialect to a fresh directory (never over the input)."""
    (export_rows(df, with_results).write.mode("errorifexists")
     .option("header", "true").option("quote", '"').option("escape", '"')
     .option("emptyValue", "").option("nullValue", "").csv(path))


def append_inventory(rows: DataFrame, path: str) -> None:
    """Append typed rows to the Parquet inventory (S5). Upload names are
    filled in at write time, like the CSV writer does."""
    aligned = align(rows, FULL_SCHEMA)
    aligned = aligned.withColumn("upload_name", upload_name(F.col("relative_path"), F.col("upload_name")))
    aligned.write.mode("append").parquet(path)
