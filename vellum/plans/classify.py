"""Score the latest, not yet scored documents with an injected model
client and write the results back (B4, X1, I3)."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Any, Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from vellum.functions.replies import format_confidence
from vellum.functions.text import blank_to_null, is_truthy
from vellum.operators import scoring
from vellum.operators.dedup import first_seen
from vellum.operators.resolve import resolve_paths
from vellum.session import cut_lineage

_PAGE = "_page_key"

RESULT_TABLE_SCHEMA = T.StructType([
    T.StructField("relative_path", T.StringType()),
    T.StructField("llm_document_type", T.StringType()),
    T.StructField("llm_confidence", T.DoubleType()),
    T.StructField("llm_reason", T.StringType()),
    T.StructField("llm_raw_json", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("scored_at", T.TimestampType()),
    T.StructField("run_id", T.StringType()),
])


@dataclass
class ClassifyResult:
    scored: DataFrame      # results of this run (one row per scored document)
    inventory: DataFrame   # inventory with the newest result per key
    summary: DataFrame     # rows_loaded, latest_rows
    messages: DataFrame    # key, message: one status line per inventory row (P35)


@dataclass
class Calls:
    """How documents become calls: page columns, prompt, and call limits."""
    page_no: str
    image: str
    max_pages: int
    prompt: str
    concurrency: int | None
    in_flight: int
    retries: int
    backoff: float


def _error_rows(failed: DataFrame, key: str, error: str) -> DataFrame:
    """Result rows of documents that no call was made for."""
    return failed.select(
        key, F.lit("error").alias("llm_document_type"), F.lit(0.0).alias("llm_confidence"),
        F.col(error).alias("llm_reason"), F.lit(None).cast("string").alias("llm_raw_json"),
        F.col(error).alias("error"))


def _append(rows: DataFrame, results_path: str, run_id: str) -> None:
    rows.withColumn("scored_at", F.current_timestamp()).withColumn(
        "run_id", F.lit(run_id)).write.mode("append").parquet(results_path)


def _score_wave(candidates: DataFrame, pages: DataFrame, client_factory, results_path: str, key: str,
                calls: Calls, run_id: str) -> None:
    requests = scoring.build_requests(candidates, pages, key=key, page_no=calls.page_no, image=calls.image,
                                      max_pages=calls.max_pages, prompt=calls.prompt, page_key=_PAGE)
    responses = scoring.call_model(requests, client_factory, key=key, concurrency=calls.concurrency,
                                   in_flight=calls.in_flight, retries=calls.retries, backoff=calls.backoff)
    no_pages = requests.filter(F.col("request_error").isNotNull())
    _append(scoring.normalise_responses(responses, key).unionByName(_error_rows(no_pages, key, "request_error")),
            results_path, run_id)


def _one_a_key(rows: DataFrame, listing: DataFrame | None, base_dir: str | None, listing_path: str,
               key: str, share_by: str | None) -> DataFrame:
    """The documents to score, one row a key: the name their pages go by
    (null: no file found), and the raw path for the message of a missing file.

    With a listing that name is the first of the row's candidate paths that
    the listing holds (J2); of rows with one key the smallest such name is
    taken. Without one it is the key.
    """
    raws = [c for c in ("full_path", key) if c in rows.columns]
    if listing is None:
        found = rows.withColumn(_PAGE, F.col(key))
    else:
        found = resolve_paths(rows, listing, base_dir, tuple(dict.fromkeys(raws)),
                              listing_path=listing_path).withColumnRenamed("resolved_path", _PAGE)
    carried = [F.col(_PAGE)] + ([F.col(share_by)] if share_by else [])
    best = F.min(F.when(F.col(_PAGE).isNotNull(), F.struct(*carried)))
    wanted = F.coalesce(*[blank_to_null(c) for c in reversed(raws)], F.lit("<empty>"))
    return found.groupBy(key).agg(best.alias("_best"), F.min(wanted).alias("_wanted")).select(
        key, "_best.*", "_wanted")


def _fan_out(spark: SparkSession, candidates: DataFrame, called: DataFrame, results_path: str,
             key: str, share_by: str, run_id: str, salts: int = 64) -> None:
    """Append the representative's result for every other candidate that
    shares its ``share_by`` value. The results (one row a value) are joined
    with their value first and then copied to ``salts`` salted values, so the
    followers of one hot value are spread over as many tasks."""
    reps = called.filter(F.col(share_by).isNotNull()).select(share_by, F.col(key).alias("_rep"))
    results = spark.read.parquet(results_path).filter(F.col("run_id") == run_id).withColumnRenamed(key, "_rep")
    by_value = reps.join(scoring.latest_results(results, "_rep"), "_rep")
    salted = by_value.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    followers = candidates.filter(F.col(share_by).isNotNull()).select(
        key, share_by, F.pmod(F.xxhash64(key), F.lit(salts)).cast("int").alias("_salt"))
    copied = followers.join(salted, [share_by, "_salt"]).filter(F.col(key) != F.col("_rep"))
    copied = copied.drop("_rep", "_salt", share_by).withColumn("scored_at", F.current_timestamp())
    copied.withColumn("run_id", F.lit(run_id)).write.mode("append").parquet(results_path)


def read_results(spark: SparkSession, results_path: str, key: str = "relative_path") -> DataFrame:
    """Stored results; a table that does not exist yet is empty, one that
    cannot be read is an error."""
    try:
        return spark.read.parquet(results_path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RESULT_TABLE_SCHEMA).withColumnRenamed("relative_path", key)


def classify_latest(spark: SparkSession, inventory: DataFrame, pages: DataFrame,
                    client_factory: Callable[[], Callable[[list], Any]], results_path: str,
                    key: str = "relative_path", page_no: str = "page_no", image: str = "image",
                    max_pages: int = 2, prompt: str = scoring.DEFAULT_PROMPT,
                    concurrency: int | None = None, retry_errors: bool = False,
                    waves: int = 1, share_by: str | None = None, listing: DataFrame | None = None,
                    base_dir: str | None = None, listing_path: str = "path", page_key: str | None = None,
                    in_flight: int = 1, retries: int = 0, backoff: float = 1.0) -> ClassifyResult:
    """One model call per latest document without a stored type.

    Results are appended to ``results_path`` before anything else reads
    them, so no model call is repeated by a later action, and a crashed run
    resumes with the documents still missing. ``waves`` splits the
    candidates by a hash of their key into that many disjoint waves, each
    appended before the next starts: a failure loses at most one wave.
    ``retry_errors`` also re-scores documents whose stored type is 'error'.
    ``share_by`` (e.g. ``"md5_hash"``) makes documents with the same value
    share one call: the smallest key per value is scored and its result is
    written for the others too.

    With a ``listing`` of files (column ``listing_path``) every candidate is
    looked up first: its full path, then its key, each as it is when absolute
    and else under ``base_dir`` and then under its parent (J2). ``pages`` go
    by the path found, in column ``page_key`` (default: ``key``); a document
    without a file is an error row and no call. Rows with one key are one
    document; rows without any path share the key ''. ``in_flight``,
    ``retries`` and ``backoff`` are those of ``scoring.call_model``.
    """
    if listing is not None and base_dir is None:
        raise ValueError("a listing needs the base_dir that relative paths start from")
    run_id = uuid.uuid4().hex
    if "full_path" in inventory.columns and "full_path" != key:  # a row without the key goes by its full path
        inventory = inventory.withColumn(key, F.coalesce(blank_to_null(key), F.col("full_path"), F.col(key)))
    stored = read_results(spark, results_path, key)
    done = stored if not retry_errors else stored.filter(F.col("llm_document_type") != "error")
    todo = scoring.score_candidates(inventory.withColumn(key, F.coalesce(F.col(key), F.lit(""))), done, key=key)
    # Read by every wave, and the results they are told from change meanwhile.
    candidates = cut_lineage(_one_a_key(todo, listing, base_dir, listing_path, key, share_by), spark)
    missing = candidates.filter(F.col(_PAGE).isNull()).withColumn(
        "_error", F.concat(F.lit("file not found: "), F.col("_wanted")))
    _append(_error_rows(missing, key, "_error"), results_path, run_id)
    candidates = candidates.filter(F.col(_PAGE).isNotNull())
    to_call = candidates
    if share_by:
        shared = candidates.filter(F.col(share_by).isNotNull())
        to_call = first_seen(shared, key=share_by, order=(key,)).unionByName(
            candidates.filter(F.col(share_by).isNull()))
    pages = pages.withColumnRenamed(page_key or key, _PAGE)
    calls = Calls(page_no, image, max_pages, prompt, concurrency, in_flight, retries, backoff)
    for wave in range(waves):
        part = to_call if waves == 1 else to_call.filter(
            F.pmod(F.xxhash64(F.col(key)), F.lit(waves)) == wave)
        _score_wave(part, pages, client_factory, results_path, key, calls, run_id)
    if share_by:
        _fan_out(spark, candidates, to_call, results_path, key, share_by, run_id)
    all_results = spark.read.parquet(results_path)
    latest = scoring.latest_results(all_results.drop("error", "run_id"), key)
    scored = all_results.filter(F.col("run_id") == run_id).drop("run_id")
    flag = F.col("is_latest")
    flag = flag if dict(inventory.dtypes).get("is_latest") == "boolean" else is_truthy(flag)
    # Rows are only ever given results, never cleared: a row that stopped
    # being latest keeps what it had.
    merged = scoring.writeback(inventory, latest)
    summary = inventory.agg(F.count(F.lit(1)).alias("rows_loaded"),
                            F.count_if(F.coalesce(flag, F.lit(False))).alias("latest_rows"))
    return ClassifyResult(scored, merged, summary, _messages(inventory, flag, scored, merged, key))


def _messages(inventory: DataFrame, flag, scored: DataFrame, merged: DataFrame, key: str) -> DataFrame:
    """'<name>: skipped (not latest)', '<name>: skipped (already <type>)' or
    '<name>: <type> (<confidence to 4 places>)' for every inventory row."""
    name = scoring.display_name("filename" if "filename" in inventory.columns else key, key)
    fresh = scored.select(key).distinct().withColumn("_fresh", F.lit(True))
    rows = merged.join(fresh, key, "left")
    latest = F.coalesce(flag, F.lit(False))
    msg = (F.when(~latest, F.concat(name, F.lit(": skipped (not latest)")))
           .when(F.col("_fresh").isNull(),
                 F.concat(name, F.lit(": skipped (already "), F.coalesce(F.col("llm_document_type"), F.lit("")),
                          F.lit(")")))
           .otherwise(F.concat(name, F.lit(": "), F.coalesce(F.col("llm_document_type"), F.lit("")), F.lit(" ("),
                               F.coalesce(format_confidence(F.col("llm_confidence")), F.lit("")), F.lit(")"))))
    return rows.select(key, msg.alias("message"))
