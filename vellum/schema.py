"""Declared schemas of the inventory and result tables, and by-name alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Inventory columns in their on-disk order.
INVENTORY_FIELDS = [
    "filename",
    "full_path",
    "relative_path",
    "file_size",
    "reduced",
    "upload_name",
    "group_key",
    "revision",
    "revision_number",
    "creation_time",
    "is_latest",
    "md5_hash",
]

# The result columns that scoring adds, in order.
RESULT_FIELDS = ["llm_document_type", "llm_confidence", "llm_reason", "llm_raw_json"]

INVENTORY_SCHEMA = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("full_path", T.StringType()),
    T.StructField("relative_path", T.StringType()),
    T.StructField("file_size", T.LongType()),
    T.StructField("reduced", T.BooleanType()),
    T.StructField("upload_name", T.StringType()),
    T.StructField("group_key", T.StringType()),
    T.StructField("revision", T.StringType()),
    T.StructField("revision_number", T.LongType()),
    T.StructField("creation_time", T.TimestampType()),
    T.StructField("is_latest", T.BooleanType()),
    T.StructField("md5_hash", T.StringType()),
])

RESULT_SCHEMA = T.StructType([
    T.StructField("llm_document_type", T.StringType()),
    T.StructField("llm_confidence", T.DoubleType()),
    T.StructField("llm_reason", T.StringType()),
    T.StructField("llm_raw_json", T.StringType()),
])

FULL_SCHEMA = T.StructType(INVENTORY_SCHEMA.fields + RESULT_SCHEMA.fields)

# Defaults used when a column is missing from an incoming row.
_DEFAULTS = {"reduced": False}


def is_truthy_or_null(c: Column) -> Column:
    from vellum.functions.text import is_truthy
    return F.when(c.isNull(), F.lit(None).cast("boolean")).otherwise(is_truthy(c))


def align(df: DataFrame, schema: T.StructType = INVENTORY_SCHEMA,
          keep_extra: bool = False) -> DataFrame:
    """Project ``df`` onto ``schema`` by column name.

    Missing columns become NULL (``reduced`` defaults to False); present
    columns are converted to the declared type: booleans through the truthy
    rule, numbers through a safe cast. Never positional, so an older or
    shorter header cannot shift values into the wrong column.
    """
    present = {c.lower(): c for c in df.columns}
    cols = []
    for field in schema.fields:
        src = present.get(field.name.lower())
        if src is None:
            default = F.lit(_DEFAULTS.get(field.name))
            cols.append(default.cast(field.dataType).alias(field.name))
            continue
        c = F.col(f"`{src}`")
        source_type = df.schema[src].dataType
        if source_type == field.dataType:
            typed = c
        elif isinstance(field.dataType, T.BooleanType):
            typed = is_truthy_or_null(c.cast("string"))
        elif isinstance(field.dataType, T.DoubleType):
            from vellum.functions.text import safe_float
            typed = F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
                safe_float(c.cast("string"), default=None))
        elif isinstance(field.dataType, (T.LongType, T.IntegerType)):
            typed = c.cast("string").try_cast(field.dataType)
        elif isinstance(field.dataType, T.TimestampType) and isinstance(source_type, T.StringType):
            # stored text is UTC wall-clock time, whatever the session time zone
            typed = F.try_to_timestamp(F.concat(c, F.lit("+0000")), F.lit("yyyy-MM-dd HH:mm:ssZ"))
        else:
            typed = c.cast(field.dataType)
        if field.name in _DEFAULTS:
            typed = F.coalesce(typed, F.lit(_DEFAULTS[field.name]))
        cols.append(typed.alias(field.name))
    if keep_extra:
        known = {f.name.lower() for f in schema.fields}
        cols += [F.col(f"`{c}`") for c in df.columns if c.lower() not in known]
    return df.select(*cols)


def empty_frame(spark, schema: T.StructType = INVENTORY_SCHEMA) -> DataFrame:
    return spark.createDataFrame([], schema)
