"""Physical-plan checks: the properties that matter at scale."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry_module
from conftest import SF_SMALL
from vellum.plans.catalogue import QUERIES

STREAMING = {"incremental_ingest", "ingest_in_batches", "streaming_dedup"}
# Python's JSON by decision: Arrow batches, no row at a time
ARROW = {"reply_raw_json"}


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


NATIVE = sorted(set(QUERIES) - STREAMING)


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_stay_in_the_jvm(spark, name):
    plan = _plan(entry_module.queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and ("ArrowEvalPython" in plan) == (name in ARROW)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", NATIVE)
def test_no_text_in_exchanges(spark, name):
    """Whole texts and file bodies are consumed before any shuffle, except
    where the query's own output or key is text (names, blocks, replies)."""
    text_is_output = {"upload_name_explicit", "upload_collisions", "upload_manifest", "upload_summary",
                      "message_body", "body_blocks", "message_headers", "converted_rows", "response_text",
                      "fence_strip", "json_brace_slice", "request_payload", "html_text_native",
                      "html_text_exact", "reply_normalise", "score_candidates", "score_writeback", "score_summary",
                      "conversion_summary", "reduction_accounting"}
    plan = _plan(entry_module.queries()[name](spark, SF_SMALL))
    blocks = re.findall(r"\(\d+\) (?:Exchange|ShuffleExchange)\nInput \[\d+\]: \[([^\]]*)\]\n"
                        r"Arguments: ([^\n]*)", plan)
    for cols, args in blocks:
        if "REPARTITION_BY_NUM" in args:      # spreading an under-split input (sources/spread.py)
            continue
        names = [c.split("#")[0].strip() for c in cols.split(",")]
        assert "content" not in names
        if name not in text_is_output:
            assert "text" not in names and "html" not in names, (name, names)


def test_dedup_limits_before_the_shuffle(spark):
    plan = _plan(entry_module.queries()["dedup_exact"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "row_number(), 1, Partial" in plan


def test_latest_flag_is_an_aggregate_not_a_group_window(spark):
    plan = _plan(entry_module.queries()["latest_revision"](spark, SF_SMALL))
    assert "partial_min_by" in plan
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\]", plan)
    assert all("group_key" not in w for w in windows)


def test_scan_projection_prunes_columns(spark):
    plan = _plan(entry_module.queries()["revision_parse"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)
    assert schemas and all("n_chars" not in s for s in schemas)
