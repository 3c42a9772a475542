"""Convert mail messages into documents and inventory rows (B2)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from vellum.functions.html import html_to_text
from vellum.functions.revision import file_name, file_stem, revision_group_key, revision_label, \
    revision_number
from vellum.functions.text import html_escape
from vellum.operators import messages as msg
from vellum.operators.incremental import append_if_missing
from vellum.session import cut_lineage
from vellum.sources.inventory import append_inventory, read_inventory


@dataclass
class ConvertResult:
    documents: DataFrame  # relative_path, title, header_lines, blocks, text
    rows: DataFrame       # inventory rows of the converted documents
    added: DataFrame      # rows appended (unseen paths only)
    summary: DataFrame    # detected, converted, failed


def convert_messages(spark: SparkSession, messages: DataFrame, inventory_path: str,
                     input_root: str = "", output_base: str = "emails", output_root: str | None = None,
                     write: bool = True,
                     documents_path: str | None = None) -> ConvertResult:
    """Message records -> document text + inventory rows, appended unless the
    path is already stored. The PDF layout engine is not built: the produced
    document is its text (escaped title, header lines and body blocks), whose
    MD5 and size go into the inventory. A message without a source path
    cannot be converted and counts as failed."""
    fields = msg.message_fields(messages, html_to_text)
    prefix = input_root.rstrip("/") + "/" if input_root else ""
    rel_src = (F.when(F.startswith(F.col("source_path"), F.lit(prefix)),
                      F.substring(F.col("source_path"), len(prefix) + 1, 1 << 30))
               .otherwise(F.col("source_path")) if prefix else F.col("source_path"))
    rel = F.concat(F.lit(output_base.rstrip("/") + "/"), msg.output_pdf_path(rel_src))
    ok = F.coalesce(F.col("source_path"), F.lit("")) != ""
    docs = fields.select(
        "message_id", ok.alias("ok"), rel.alias("relative_path"),
        html_escape(F.col("hdr_subject")).alias("title"),
        msg.header_lines(F.col("hdr_from"), F.col("hdr_to"), F.col("hdr_cc"), F.col("hdr_date"),
                         F.col("hdr_subject")).alias("header_lines"),
        msg.body_blocks(F.col("body_text")).alias("blocks"),
        msg.rendered_text(fields).alias("text"),
    )
    docs = cut_lineage(docs, spark)
    full_root = (output_root or "").rstrip("/")
    stem = file_stem(F.col("relative_path"))
    rev = revision_label(stem)
    rows = docs.filter(F.col("ok")).select(
        "message_id",
        file_name(F.col("relative_path")).alias("filename"),
        (F.concat(F.lit(full_root + "/"), F.col("relative_path")) if full_root else F.col("relative_path"))
        .alias("full_path"),
        "relative_path",
        F.octet_length("text").cast("bigint").alias("file_size"),
        F.lit(False).alias("reduced"),
        revision_group_key(stem).alias("group_key"), rev.alias("revision"),
        revision_number(rev).alias("revision_number"),
        F.current_timestamp().alias("creation_time"),
        F.lit(True).alias("is_latest"),
        F.md5("text").alias("md5_hash"),
    )
    existing = read_inventory(spark, inventory_path)
    added = cut_lineage(append_if_missing(rows, existing), spark)
    summary = docs.agg(F.count(F.lit(1)).alias("detected"), F.count_if(F.col("ok")).alias("converted"),
                       F.count_if(~F.col("ok")).alias("failed"))
    if write:
        append_inventory(added, inventory_path)
        if documents_path:
            docs.filter(F.col("ok")).drop("ok").write.mode("append").parquet(documents_path)
    return ConvertResult(docs.filter(F.col("ok")).drop("ok"), rows, added, summary)
