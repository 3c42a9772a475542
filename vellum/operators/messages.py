"""Message records -> document text (B2 parts: P17-P22, P21b, P21c)."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F

from vellum.functions.html import html_to_text
from vellum.functions.revision import file_stem, with_suffix
from vellum.functions.text import PY_WHITESPACE, blank_to_null, html_escape, py_strip, safe_str

# Header labels in print order, and the empty-body placeholder.
HEADER_LABELS = ("From", "To", "Cc", "Date", "Subject")
NO_BODY = "[No body text found]"
# Blocks are separated by a line break, any whitespace, and a line break.
BLOCK_SPLIT_RE = "\n[" + PY_WHITESPACE + "]*\n"


def message_body(body, body_html, html_fn: Callable[[Column], Column] = html_to_text) -> Column:
    """Plain body when non-blank, else the text of the HTML body, else '' (P19)."""
    html = py_strip(F.coalesce(body_html if isinstance(body_html, Column) else F.col(body_html),
                               F.lit("")))
    return F.coalesce(blank_to_null(body), F.when(html != "", html_fn(html)), F.lit(""))


def message_fields(messages: DataFrame, html_fn: Callable[[Column], Column] = html_to_text,
                   path: str = "source_path") -> DataFrame:
    """Header metadata with fallbacks (P20) and the body."""
    return messages.select(
        "*",
        F.coalesce(blank_to_null("sender"), safe_str("sender_email")).alias("hdr_from"),
        safe_str("to").alias("hdr_to"),
        safe_str("cc").alias("hdr_cc"),
        safe_str("date").alias("hdr_date"),
        F.coalesce(blank_to_null("subject"), file_stem(F.col(path))).alias("hdr_subject"),
        message_body(F.col("body"), F.col("body_html"), html_fn).alias("body_text"),
    )


def header_lines(*values: Column) -> Column:
    """'Label: value' for each non-empty header, in print order, values
    escaped (P21b, P21c)."""
    pairs = [F.struct(F.lit(label).alias("label"), v.alias("value"))
             for label, v in zip(HEADER_LABELS, values)]
    kept = F.filter(F.array(*pairs), lambda p: p["value"] != "")
    return F.transform(kept, lambda p: F.concat(p["label"], F.lit(": "), html_escape(p["value"])))


def body_blocks(body) -> Column:
    """Paragraph blocks: split on blank lines, strip, drop empties, escape,
    line breaks -> <br/> (P21, P21b). Placeholder when the body is blank."""
    b = py_strip(body if isinstance(body, Column) else F.col(body))
    b = F.when(b == "", F.lit(NO_BODY)).otherwise(b)
    blocks = F.filter(F.transform(F.split(b, BLOCK_SPLIT_RE), lambda x: py_strip(x)), lambda x: x != "")
    return F.transform(blocks, lambda x: F.replace(html_escape(x), F.lit("\n"), F.lit("<br/>")))


def rendered_text(fields: DataFrame) -> Column:
    """The text of the produced document: title, header lines, body blocks."""
    return F.concat_ws(
        "\n",
        html_escape(F.col("hdr_subject")),
        F.array_join(header_lines(F.col("hdr_from"), F.col("hdr_to"), F.col("hdr_cc"),
                                  F.col("hdr_date"), F.col("hdr_subject")), "\n"),
        F.array_join(body_blocks(F.col("body_text")), "\n"),
    )


def output_pdf_path(relative_source) -> Column:
    """Mirror the input tree, suffix -> .pdf."""
    return with_suffix(relative_source, ".pdf")
