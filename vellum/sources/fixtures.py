"""Stand-in tables derived from the driver's test data (FIXTURES.md, part B).

Every table here is computed by Spark from the given parquet tables, whole
rows and whole texts, so its size follows the scale factor:

* ``documents`` -> one file per document: a revision-bearing name, a path,
  size, MD5 and a creation time (``doc_files``, ``scan_listing``);
* the same files as an earlier inventory, a file listing, reduction and
  upload views;
* ``conversations`` + ``pages`` -> mail messages (plain and HTML bodies);
* ``conversations`` -> page images and model responses;
* ``labels`` -> model replies covering the normalisation cases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vellum.functions.revision import (file_name, file_stem, format_epoch, revision_group_key,
                                       revision_label, revision_number)

# Fixed values of the fixture: first creation time (2024-01-01T00:00:00Z)
# and the roots of the simulated file tree.
EPOCH0 = 1704067200
# The earlier scan ran at 12:00 on the first day: it saw the files created before then.
EARLIER_SCAN_AT = EPOCH0 + 12 * 3600
SRV = "/srv"
INVENTORY_DIR = "/srv/inv"
REDUCED_DIR = "/srv/reduced"

WRITTEN_AT = 256  # texts that a task writing files holds as strings at a time


# Unique key of each driver table: used to spread a table that arrives in
# fewer splits than the cluster has cores (one key per row, so no hot key).
TABLE_KEYS = {"documents": ("doc_id",), "pages": ("page_id",), "conversations": ("conv_id", "turn"),
              "labels": ("doc_id",)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a driver table. Text tables that come as too few splits (one
    parquet row group is one split) are hash-partitioned on their unique
    key across the default parallelism, so per-row text work uses every
    core; inputs that already have enough splits are left alone."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    keys = TABLE_KEYS.get(name)
    if keys and name != "labels":
        from vellum.sources.spread import spread
        df = spread(df, keys)
    return df


def _s(c: Column) -> Column:
    return c.cast("string")


def doc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_files_of(table(spark, sf_dir, "documents"))


def doc_files_of(d: DataFrame) -> DataFrame:
    """One file per document: name with a revision suffix picked by
    ``floor(doc_id / 20)``, so revisions do not follow ``source``."""
    doc = F.col("doc_id")
    k = F.floor(doc / 20).cast("bigint")
    rev2 = F.lpad(_s(k % 7), 2, "0")
    suffix = (F.when(k % 4 == 1, F.concat(F.lit(" rev"), rev2))
              .when(k % 4 == 2, F.concat(F.lit("_rev"), rev2, F.lit("a")))
              .when(k % 4 == 3, F.concat(F.lit(" REV"), _s(k % 7)))
              .otherwise(F.lit("")))
    stem = F.concat(F.lit("Prüfung "), F.col("source"), F.lit("-"), _s(doc % 2), suffix)
    rel = F.concat(F.lit("docs/"), F.col("lang"), F.lit("/b"), _s(doc), F.lit("/"), stem, F.lit(".pdf"))
    return d.select(
        doc, "lang", "source", "text",
        rel.alias("relative_path"),
        F.octet_length("text").cast("bigint").alias("file_size"),
        F.md5("text").alias("md5_hash"),
        (F.lit(EPOCH0) + (doc * 7919) % 86400).cast("bigint").alias("creation_epoch"),
    )


def scan_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_listing_of(doc_files(spark, sf_dir))


def scan_listing_of(f: DataFrame) -> DataFrame:
    """Inventory rows of every file (P1): the same projection a directory
    scan produces, over the documents stand-in. The stem and the revision
    label are computed once each and reused by the later columns."""
    rel = F.col("relative_path")
    staged = f.select("*", file_stem(rel).alias("_stem"))
    staged = staged.select("*", revision_label(F.col("_stem")).alias("revision"))
    return staged.select(
        "doc_id", "lang", "source",
        file_name(rel).alias("filename"),
        F.concat(F.lit(SRV + "/"), rel).alias("full_path"),
        rel,
        "file_size",
        F.endswith(F.lower(F.col("_stem")), F.lit("-reduced")).alias("reduced"),
        revision_group_key(F.col("_stem")).alias("group_key"),
        "revision",
        revision_number(F.col("revision")).alias("revision_number"),
        F.timestamp_seconds("creation_epoch").alias("creation_time"),
        "creation_epoch",
        "md5_hash",
    )


def stored_path(rel: Column) -> Column:
    """How an earlier run stored a path: with a Windows separator after 'docs'."""
    return F.concat(F.lit("docs\\"), F.substring(rel, 6, 1 << 30))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files present on disk: most at ``/srv/<rel>``, every fifth document
    moved under the inventory folder, and some deleted since inventoried."""
    f = doc_files(spark, sf_dir)
    doc = F.col("doc_id")
    rel = F.col("relative_path")
    path = (F.when(doc % 11 == 5, F.lit(None).cast("string"))
            .when(doc % 5 == 0, F.concat(F.lit(INVENTORY_DIR + "/"), rel))
            .otherwise(F.concat(F.lit(SRV + "/"), rel)))
    return f.select(path.alias("path"), "file_size").filter(F.col("path").isNotNull())


def resolution_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory rows whose full path is blank, relative or absolute."""
    f = doc_files(spark, sf_dir)
    doc = F.col("doc_id")
    rel = F.col("relative_path")
    full = (F.when(doc % 4 == 0, F.lit(""))
            .when(doc % 4 == 1, rel)
            .otherwise(F.concat(F.lit(SRV + "/"), rel)))
    return f.select("doc_id", rel, full.alias("full_path"))


def truthy_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Fixed values of the fixture: stored spellings of a boolean flag.
    spellings = ["True", " yes ", "Y", "1", "false", "0", "no", " TRUE\t", ""]
    doc = F.col("doc_id")
    arr = F.array(*[F.lit(s) for s in spellings])
    return table(spark, sf_dir, "documents").select(
        doc, F.element_at(arr, (doc % len(spellings) + 1).cast("int")).alias("flag_text"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mail messages: each conversation turn is a plain message (every
    seventh one arrives as HTML only), each web page an HTML message."""
    conv = table(spark, sf_dir, "conversations")
    cid, turn = F.col("conv_id"), F.col("turn")
    html_only = turn % 7 == 6
    plain = conv.select(
        F.concat(F.lit("c"), _s(cid), F.lit("-"), _s(turn)).alias("message_id"),
        F.concat(F.lit("mail/conv"), _s(cid), F.lit("/turn"), F.lpad(_s(turn), 3, "0"),
                 F.lit(".msg")).alias("source_path"),
        F.when(turn % 4 == 3, F.lit("  ")).otherwise(F.col("role")).alias("sender"),
        F.concat(F.col("role"), F.lit("@example.com")).alias("sender_email"),
        F.concat(F.lit("conv"), _s(cid), F.lit("@example.com")).alias("to"),
        F.when(turn % 2 == 0, F.lit("")).otherwise(F.lit("cc@example.com")).alias("cc"),
        format_epoch(F.lit(EPOCH0) + cid * 3600 + turn * 60).alias("date"),
        F.when(turn % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("Thread "), _s(cid))).alias("subject"),
        F.when(html_only, F.lit("  \n ")).otherwise(F.col("text")).alias("body"),
        F.when(html_only, F.concat(F.lit("<div>"), F.replace(F.col("text"), F.lit("\n"), F.lit("<br>")),
                                   F.lit("</div>"))).alias("body_html"),
    )
    pages = table(spark, sf_dir, "pages")
    web = pages.select(
        F.concat(F.lit("p"), _s(F.col("page_id"))).alias("message_id"),
        # some records come without a path: they cannot be converted
        F.when(F.col("page_id") % 13 == 5, F.lit("")).otherwise(
            F.concat(F.lit("mail/web/page"), _s(F.col("page_id")), F.lit(".msg"))).alias("source_path"),
        F.lit("").alias("sender"),
        F.regexp_extract(F.col("url"), "^[a-z]+://([^/?#]+)", 1).alias("sender_email"),
        F.lit("").alias("to"), F.lit("").alias("cc"), F.lit("").alias("date"), F.lit("").alias("subject"),
        F.lit("").alias("body"),
        F.col("html").alias("body_html"),
    )
    return plain.unionByName(web)


def page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as the ordered pages of a document; the page
    image is the turn's UTF-8 bytes."""
    return table(spark, sf_dir, "conversations").select(
        "conv_id", F.col("turn").alias("page_no"), F.encode(F.col("text"), "UTF-8").alias("image"))


def scored_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(inventory, listing, pages): every conversation is a file with a page a
    turn. A row names its file by an absolute path, by a path under the
    inventory folder or its parent, by an absolute path that it was moved
    away from, or by the full path alone; the files of some are gone."""
    conv = table(spark, sf_dir, "conversations")
    rel = F.concat(F.lit("conversations/"), _s(F.col("conv_id")), F.lit(".pdf"))
    kind = F.pmod(F.col("conv_id"), F.lit(6))
    place = F.concat(F.when(kind.isin(0, 2, 5), F.lit(SRV + "/")).otherwise(F.lit(INVENTORY_DIR + "/")), rel)
    full = (F.when(kind == 0, place).when(kind == 3, F.concat(F.lit("/old/"), rel))
            .when(kind == 4, F.concat(F.lit(SRV + "/"), rel)).when(kind == 5, place).otherwise(F.lit("")))
    files = conv.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"))
    inventory = files.select("conv_id", F.when(kind == 5, F.lit(" ")).otherwise(rel).alias("relative_path"),
                             full.alias("full_path"), F.lit(True).alias("is_latest"))
    listed = files.filter(kind != 4).select(place.alias("path"))
    pages = conv.select(place.alias("path"), F.col("turn").alias("page_no"),
                        F.encode(F.col("text"), "UTF-8").alias("image"))
    return inventory, listed, pages


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model responses in the shapes a client returns: direct text, blank
    text with nested parts, nested parts only, nothing."""
    conv = table(spark, sf_dir, "conversations")
    turn, text = F.col("turn"), F.col("text")
    part = lambda t: F.struct(t.cast("string").alias("text"))
    content_t = "array<struct<text:string>>"
    out_a = F.array(F.struct(F.array(part(text), part(F.lit("  "))).alias("content")),
                    F.struct(F.lit(None).cast(content_t).alias("content")))
    out_b = F.array(F.struct(F.array(part(F.concat(F.lit("part "), _s(turn))), part(text),
                                     part(F.lit(None))).alias("content")))
    m = turn % 4
    return conv.select(
        "conv_id", "turn",
        F.when(m == 0, text).when(m == 1, F.lit("   ")).alias("output_text"),
        F.when(m == 1, out_a).when(m == 2, out_b).alias("output"),
    )


def fenced_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    m = F.col("turn") % 3
    text = F.col("text")
    reply = (F.when(m == 0, F.concat(F.lit("```json\n"), text, F.lit("\n```")))
             .when(m == 1, F.concat(F.lit("  "), text))
             .otherwise(F.concat(F.lit("```\n"), text)))
    return conv.select("conv_id", "turn", reply.alias("reply"))


def prose_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON object carrying the whole turn text, with prose around it."""
    conv = table(spark, sf_dir, "conversations")
    obj = F.to_json(F.struct(F.col("text").alias("reasoning"), F.col("turn").alias("turn")))
    return conv.select("conv_id", "turn",
                       F.concat(F.lit("Result for turn "), _s(F.col("turn")), F.lit(": "), obj,
                                F.lit(" (end)")).alias("reply"))


def label_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model reply per label row, ten shapes chosen by ``doc_id % 10``:
    alias with dash and capitals; document_type only with a padded string
    confidence; unknown label with a negative confidence; null asset_type
    beside a valid document_type and confidence above 1; empty reasoning
    with a boolean confidence; padded label with a non-numeric confidence;
    fenced reply with an underscore number and null reasoning; prose around
    the object; a JSON array; no JSON at all."""
    lab = table(spark, sf_dir, "labels")
    q, t, doc = _s(F.col("quality")), _s(F.col("toxic")), F.col("doc_id")
    m = doc % 10
    conf0 = _s(F.col("quality") * 5 + F.col("toxic") * 3 + 1)
    reply = (
        F.when(m == 0, F.concat(F.lit('{"asset_type": "Text-Based", "confidence": 0.'), conf0,
                                F.lit(', "reasoning": "quality '), q, F.lit('"}')))
        .when(m == 1, F.concat(F.lit('{"document_type": "image", "confidence": " 0.75 ", "reason": "toxic '),
                               t, F.lit('"}')))
        .when(m == 2, F.concat(F.lit('{"asset_type": "diagram", "confidence": -'), q, F.lit(".5}")))
        .when(m == 3, F.concat(F.lit('{"asset_type": null, "document_type": "text", "confidence": 1'), t,
                               F.lit(".5}")))
        .when(m == 4, F.lit('{"reasoning": "", "reason": "hidden", "asset_type": "image document", '
                            '"confidence": true}'))
        .when(m == 5, F.lit('  {"asset_type": "  IMAGE_BASED ", "confidence": "high"}  '))
        .when(m == 6, F.lit('```json\n{"asset_type": "textdocument", "confidence": "1_0e-1", '
                            '"reasoning": null}\n```'))
        .when(m == 7, F.concat(F.lit('Sure! {"asset_type": "image_based", "confidence": 0.6, '
                                     '"reasoning": "plan '), _s(doc), F.lit('"} Hope this helps.')))
        .when(m == 8, F.lit('[{"asset_type": "text"}]'))
        .otherwise(F.lit("I cannot classify this document."))
    )
    return lab.select(doc, reply.alias("reply"))


def odd_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model reply per label row, seven shapes that only a full JSON
    reader takes as the original does: repeated keys; NaN; an infinity; other
    spellings of numbers, escapes and spaces; a nested reason; prose with
    braces that do not fit; an unfinished object."""
    lab = table(spark, sf_dir, "labels")
    doc, q = _s(F.col("doc_id")), _s(F.col("quality"))
    shapes = [
        F.concat(F.lit('{"asset_type": "image", "confidence": 0.1, "asset_type": "text", "n": '), doc,
                 F.lit(', "confidence": 0.62505}')),
        F.concat(F.lit('{"asset_type":"text","confidence":NaN,"reasoning":"row '), doc, F.lit('"}')),
        F.concat(F.lit('{"document_type": "image", "confidence": -Infinity, "id": '), doc, F.lit("}")),
        F.concat(F.lit('```json\n{"reasoning":"\\u00e9t\\u00e9\\/'), doc, F.lit('",\n "asset_type" : "text", "confidence":25E-2,"x":[1,2.50,1e3]}\n```')),
        F.concat(F.lit('So: {"asset_type": "image", "confidence": "0.5", "reasoning": {"q": '), q,
                 F.lit(', "ok": true, "none": null}} done.')),
        F.concat(F.lit('{x} then {"asset_type": "text", "id": '), doc, F.lit("}")),
        F.concat(F.lit('{"asset_type": "text", "id": '), doc),
    ]
    kind, reply = F.col("doc_id") % len(shapes), F.lit(None).cast("string")
    for k, shape in enumerate(shapes):
        reply = F.when(kind == k, shape).otherwise(reply)
    return lab.select("doc_id", reply.alias("reply"))


def write_file_tree(spark: SparkSession, sf_dir: str, base_uri: str) -> int:
    """Write every document as a file ``<base>/<relative_path>`` (its text
    as UTF-8 bytes, its creation time as modification time)."""
    return write_files(doc_files(spark, sf_dir), base_uri)


def write_files(files: DataFrame, base_uri: str, set_times: bool = True) -> int:
    """Write each row's text as a file. The executors
    write their own rows through ``pyarrow.fs``, so the base may be any
    shared filesystem URI; times are set where the filesystem is local and
    ``set_times`` holds. Of a batch, WRITTEN_AT texts are held beside it at a
    time. Returns the number of files written."""
    files = files.select("relative_path", "text", "creation_epoch")

    def write(batches):
        import os

        import pyarrow as pa
        from pyarrow import fs as pafs
        filesystem, root = pafs.FileSystem.from_uri(base_uri)
        local = isinstance(filesystem, pafs.LocalFileSystem)
        for batch in batches:
            for a in range(0, batch.num_rows, WRITTEN_AT):
                for rel, text, epoch in zip(*(c.to_pylist() for c in batch.slice(a, WRITTEN_AT).columns)):
                    target = f"{root.rstrip('/')}/{rel}"
                    if local:
                        os.makedirs(target.rsplit("/", 1)[0], exist_ok=True)
                        with open(target, "wb") as out:
                            out.write(text.encode("utf-8"))
                        if set_times:
                            os.utime(target, (int(epoch), int(epoch)))
                    else:
                        filesystem.create_dir(target.rsplit("/", 1)[0], recursive=True)
                        with filesystem.open_output_stream(target) as out:
                            out.write(text.encode("utf-8"))
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    return files.mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0


def remove_files(files: DataFrame, base_uri: str) -> int:
    """Delete each row's file, if it is there; returns the number of rows."""
    import pandas as pd

    def remove(batches):
        from pyarrow import fs as pafs
        filesystem, root = pafs.FileSystem.from_uri(base_uri)
        for pdf in batches:
            for rel in pdf["relative_path"]:
                target = f"{root.rstrip('/')}/{rel}"
                if filesystem.get_file_info(target).type == pafs.FileType.File:  # a retried task finds it gone
                    filesystem.delete_file(target)
            yield pd.DataFrame({"n": [len(pdf)]})

    return files.select("relative_path").mapInPandas(remove, "n long").agg(F.sum("n")).first()[0] or 0


def awkward_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose writer closes list items, paragraphs and divisions in its
    own ways, and breaks off within a reference."""
    h = F.coalesce(F.col("html"), F.lit(""))
    for old, new in (("</li>", "<li/>"), ("</h1>", "</h1><div />"), ("</div>", "</ div >"), ("<br>", "<tr/>")):
        h = F.replace(h, F.lit(old), F.lit(new))
    return table(spark, sf_dir, "pages").select("page_id", F.concat(h, F.lit(" R&D")).alias("html"))
