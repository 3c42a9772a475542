"""Scoring latest documents with an injected model client."""

from __future__ import annotations

import threading
import time
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from typing import Any, Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from vellum.functions.replies import response_text, with_exact_reply
from vellum.functions.text import blank_to_null, is_truthy, py_strip

# Default instruction sent with the page images. Callers may pass their own.
DEFAULT_PROMPT = (
    "Look at the page images of one PDF document and decide whether it is mainly "
    "'text' (letters, e-mails, reports, tables, listings) or mainly 'image' "
    "(drawings, plans, schematics, maps, charts, photos with little running text). "
    "Answer with one JSON object only, with the keys 'reasoning' (what you see, written "
    "first), 'asset_type' ('text' or 'image') and 'confidence' (a number from 0 to 1)."
)

CONTENT_TYPE = T.ArrayType(T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("image_url", T.StringType()),
]))

RESPONSE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("output_text", T.StringType()),
    T.StructField("output", T.ArrayType(T.StructType([
        T.StructField("content", T.ArrayType(T.StructType([T.StructField("text", T.StringType())]))),
    ]))),
    T.StructField("call_error", T.StringType()),
])


def score_candidates(inventory: DataFrame, results: DataFrame | None = None,
                     key: str = "relative_path", latest: str = "is_latest") -> DataFrame:
    """Latest rows without a stored non-blank document type.

    With a separate results table the done keys are removed by a left-anti
    join, so a restarted run only scores what is missing.
    """
    flag = F.col(latest)
    flag = flag if dict(inventory.dtypes).get(latest) == "boolean" else is_truthy(flag)
    todo = inventory.filter(F.coalesce(flag, F.lit(False)))
    if "llm_document_type" in inventory.columns:
        todo = todo.filter(~_has_type(F.col("llm_document_type")))
    if results is not None:
        done = results.filter(_has_type(F.col("llm_document_type"))).select(key)
        todo = todo.join(done, key, "left_anti")
    return todo


def _has_type(c: Column) -> Column:
    """Non-blank stored type (F4), referencing the column once."""
    return F.coalesce(F.length(py_strip(c)) > 0, F.lit(False))


def first_pages(pages: DataFrame, doc: str, page_no: str, max_pages: int = 2) -> DataFrame:
    """The first ``max_pages`` pages of every document.

    ``row_number() <= n`` plans a partial WindowGroupLimit before the shuffle,
    so a document with huge page counts costs n rows per partition.
    """
    w = Window.partitionBy(doc).orderBy(page_no)
    return (pages.withColumn("page_rank", F.row_number().over(w))
                 .filter(F.col("page_rank") <= max_pages))


def image_url(image: Column) -> Column:
    """data URL of JPEG bytes; Spark's base64 line breaks removed."""
    return F.concat(F.lit("data:image/jpeg;base64,"),
                    F.regexp_replace(F.base64(image), "[\r\n]", ""))


def request_content(images: Column, prompt: str = DEFAULT_PROMPT) -> Column:
    """Prompt part followed by one image part per page."""
    text_part = F.array(F.struct(F.lit("input_text").alias("type"), F.lit(prompt).alias("text"),
                                 F.lit(None).cast("string").alias("image_url")))
    img_parts = F.transform(images, lambda i: F.struct(
        F.lit("input_image").alias("type"), F.lit(None).cast("string").alias("text"),
        image_url(i).alias("image_url")))
    return F.concat(text_part, img_parts)


def build_requests(candidates: DataFrame, pages: DataFrame, key: str, page_no: str = "page_no",
                   image: str = "image", max_pages: int = 2,
                   prompt: str = DEFAULT_PROMPT, page_key: str | None = None) -> DataFrame:
    """One request per candidate; zero pages -> an error row.

    Pages are cut to ``max_pages`` per document before they are gathered, so
    each gathered array holds at most ``max_pages`` images. ``page_key`` is
    the column that both sides share when pages go by another name than
    ``key`` (a resolved path, which several candidates may have).
    """
    by = page_key or key
    wanted = candidates.select(*dict.fromkeys((key, by)))
    top = first_pages(pages.join(wanted.select(by), by, "left_semi"), by, page_no, max_pages)
    bundles = top.groupBy(by).agg(
        F.transform(F.sort_array(F.collect_list(F.struct(F.col(page_no).alias("n"),
                                                         F.col(image).alias("img")))),
                    lambda s: s["img"]).alias("images"))
    req = wanted.join(bundles, by, "left")
    return req.select(
        key,
        F.when(F.col("images").isNotNull(), request_content(F.col("images"), prompt)).alias("content"),
        F.when(F.col("images").isNull(), F.lit("document has no pages")).alias("request_error"),
    )


def _reply_row(client, key: str, parts: list[dict], retries: int, backoff: float) -> tuple:
    """(key, output_text, output, call_error) of one document. A failed call
    is made again after ``backoff`` seconds, doubled each time."""
    for attempt in range(retries + 1):
        try:
            reply = client(parts)
            if isinstance(reply, str) or reply is None:
                return key, reply, None, None
            return key, reply.get("output_text"), reply.get("output"), None
        except Exception as exc:  # one bad document must not end the run
            error = f"{type(exc).__name__}: {exc}"
        if attempt < retries:
            time.sleep(backoff * 2 ** attempt)
    return key, None, None, error


def call_model(requests: DataFrame, client_factory: Callable[[], Callable[[list], Any]],
               key: str, concurrency: int | None = None, in_flight: int = 1, retries: int = 0,
               backoff: float = 1.0) -> DataFrame:
    """Run the injected client once per request inside ``mapInPandas``.

    The client gets the content parts (list of dicts) and returns either the
    reply text or a response mapping with ``output_text`` / ``output``.
    ``concurrency`` caps the number of tasks by repartitioning first, and a
    task holds ``in_flight`` calls open at once: it waits for the first of
    them to end before it reads on, so it never holds more requests than one
    batch and those in flight. ``client_factory`` is called on the executor
    once for each of these ``in_flight`` threads, so a client need not be
    safe for threads. A call that fails is made ``retries`` times more, with
    a pause of ``backoff`` seconds that doubles; failures that stay become
    ``call_error`` rows instead of ending the job.
    """
    if in_flight < 1 or retries < 0:
        raise ValueError("in_flight must be at least 1 and retries at least 0")
    src = requests.filter(F.col("content").isNotNull()).select(F.col(key).cast("string").alias("key"),
                                                               "content")
    if concurrency:
        src = src.repartition(concurrency)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = threading.local()

        def open_client():
            own.client = client_factory()

        def call(k, content):
            return _reply_row(own.client, k, [dict(p) for p in content], retries, backoff)

        def frame(done):
            return pd.DataFrame([f.result() for f in done],
                                columns=["key", "output_text", "output", "call_error"])

        with ThreadPoolExecutor(in_flight, initializer=open_client) as pool:
            open_calls: set = set()
            for pdf in batches:
                for k, content in zip(pdf["key"], pdf["content"]):
                    if len(open_calls) == in_flight:
                        done, open_calls = wait(open_calls, return_when=FIRST_COMPLETED)
                        yield frame(done)
                    open_calls.add(pool.submit(call, k, content))
            if open_calls:
                yield frame(wait(open_calls).done)

    out = src.mapInPandas(run, RESPONSE_SCHEMA)
    return out.withColumnRenamed("key", key)


def normalise_responses(responses: DataFrame, key: str) -> DataFrame:
    """Reply -> result columns (P24-P31); empty replies and failed calls are
    error rows."""
    df = responses.withColumn("reply_text", response_text(F.col("output_text"), F.col("output")))
    df = df.withColumn("_failed", F.coalesce(F.col("call_error"), F.when(
        F.col("reply_text") == "", F.lit("model returned an empty response"))))
    df = with_exact_reply(df, "reply_text")
    failed = F.col("_failed")
    return df.select(
        key,
        F.when(failed.isNull(), F.col("document_type")).otherwise(F.lit("error")).alias("llm_document_type"),
        F.when(failed.isNull(), F.col("confidence")).otherwise(F.lit(0.0)).alias("llm_confidence"),
        F.when(failed.isNull(), F.col("reason")).otherwise(failed).alias("llm_reason"),
        F.when(failed.isNull(), F.col("raw_json")).alias("llm_raw_json"),
        F.coalesce(failed, F.col("error")).alias("error"),
    )


def latest_results(results: DataFrame, key: str, order: str = "scored_at") -> DataFrame:
    """Newest stored result per key, from an append-only results table."""
    cols = [c for c in results.columns if c not in (key, order)]
    packed = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(order)).alias("_r")
    return results.groupBy(key).agg(packed).select(key, "_r.*")


def writeback(inventory: DataFrame, results: DataFrame, key: str = "relative_path") -> DataFrame:
    """Inventory with result columns joined on ``key`` (J3). A new result
    wins; otherwise a result already stored on the row is kept, as is. A key
    has one result at most, and blank keys have none, so rows never multiply."""
    from vellum.schema import RESULT_SCHEMA
    from vellum.functions.text import safe_float
    res = results.select(key, *[F.col(f.name).cast(f.dataType).alias(f"_new_{f.name}")
                                for f in RESULT_SCHEMA.fields])
    res = res.filter(F.col(key) != "").dropDuplicates([key])
    joined = inventory.join(res, key, "left")
    cols = []
    for c in inventory.columns:
        field = next((f for f in RESULT_SCHEMA.fields if f.name == c), None)
        if field is None:
            cols.append(F.col(c))
            continue
        stored = F.col(c)
        if field.name == "llm_confidence" and dict(inventory.dtypes)[c] == "string":
            stored = safe_float(stored, default=None)
        cols.append(F.coalesce(F.col(f"_new_{c}"), stored.cast(field.dataType)).alias(c))
    for f in RESULT_SCHEMA.fields:
        if f.name not in inventory.columns:
            cols.append(F.col(f"_new_{f.name}").alias(f.name))
    return joined.select(*cols)


def display_name(filename: str = "filename", path: str = "relative_path") -> Column:
    """filename, else relative path, else '<unknown>' (P35)."""
    return F.coalesce(blank_to_null(filename), blank_to_null(path), F.lit("<unknown>"))
