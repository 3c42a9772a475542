"""Mail messages as a table (S2, S7). The container parser is not built:
message fields arrive as columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from vellum.schema import align

MESSAGE_SCHEMA = T.StructType([
    T.StructField("message_id", T.StringType()),
    T.StructField("source_path", T.StringType()),
    T.StructField("sender", T.StringType()),
    T.StructField("sender_email", T.StringType()),
    T.StructField("to", T.StringType()),
    T.StructField("cc", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("subject", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("body_html", T.StringType()),
])


def read_messages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Messages with the declared columns; a BINARY html body is decoded as
    UTF-8 text (Q16)."""
    df = spark.read.format(fmt).load(path)
    if "body_html" in df.columns and dict(df.dtypes)["body_html"] == "binary":
        from pyspark.sql import functions as F
        df = df.withColumn("body_html", F.decode(F.col("body_html"), "UTF-8"))
    return align(df, MESSAGE_SCHEMA)
