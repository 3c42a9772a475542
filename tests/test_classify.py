"""Scoring with an injected client: only latest rows, cached rows kept,
results resumable, bad replies become error rows."""

import json

from pyspark.sql import functions as F

from vellum.plans.classify import classify_latest
from vellum.sources.inventory import export_rows

PAGES_SCHEMA = "relative_path string, page_no int, image binary"


def _inventory(spark, rows):
    return spark.createDataFrame(rows, "filename string, relative_path string, is_latest string, "
                                       "llm_document_type string, llm_confidence string")


def _client_factory(reply):
    def factory():
        def client(parts):
            assert parts[0]["type"] == "input_text"
            assert all(p["image_url"].startswith("data:image/jpeg;base64,") for p in parts[1:])
            return reply(parts)
        return client
    return factory


def test_only_latest_rows_are_scored(spark, tmp_path):
    inv = _inventory(spark, [("old.pdf", "docs/old.pdf", "False", None, None),
                             ("latest.pdf", "docs/latest.pdf", "True", None, None)])
    pages = spark.createDataFrame([("docs/latest.pdf", 1, b"img1"), ("docs/latest.pdf", 2, b"img2"),
                                   ("docs/latest.pdf", 3, b"img3"), ("docs/old.pdf", 1, b"x")], PAGES_SCHEMA)
    seen = []

    def reply(parts):
        seen.append(len(parts))
        return json.dumps({"document_type": "image_based", "confidence": 0.41, "reason": "many drawings"})

    res = classify_latest(spark, inv, pages, _client_factory(reply), str(tmp_path / "results"))
    out = {r.filename: r for r in export_rows(res.inventory).collect()}
    assert out["old.pdf"].llm_document_type == "" and out["old.pdf"].llm_confidence == ""
    assert out["latest.pdf"].llm_document_type == "image"
    assert out["latest.pdf"].llm_confidence == "0.4100"
    assert out["latest.pdf"].llm_reason == "many drawings"
    assert res.scored.count() == 1
    msgs = {r.message for r in res.messages.collect()}
    assert "old.pdf: skipped (not latest)" in msgs and "latest.pdf: image (0.4100)" in msgs
    again = classify_latest(spark, inv, pages, _client_factory(lambda p: 1 / 0), str(tmp_path / "results"))
    assert again.scored.count() == 0


def test_cached_rows_are_not_rescored(spark, tmp_path):
    inv = _inventory(spark, [("already.pdf", "docs/already.pdf", "True", "text_based", "0.1250")])
    pages = spark.createDataFrame([("docs/already.pdf", 1, b"i")], PAGES_SCHEMA)

    def fail(parts):
        raise AssertionError("must not be called")

    res = classify_latest(spark, inv, pages, _client_factory(fail), str(tmp_path / "results"))
    row = export_rows(res.inventory).first()
    assert row.llm_document_type == "text_based" and row.llm_confidence == "0.1250"
    assert res.scored.count() == 0
    assert res.messages.first().message == "already.pdf: skipped (already text_based)"


def test_errors_are_rows(spark, tmp_path):
    inv = _inventory(spark, [("a.pdf", "a.pdf", "yes", None, None), ("b.pdf", "b.pdf", "1", None, None),
                             ("c.pdf", "c.pdf", "y", None, None), ("d.pdf", "d.pdf", "true", None, None)])
    pages = spark.createDataFrame([("a.pdf", 1, b"1"), ("b.pdf", 1, b"2"), ("c.pdf", 1, b"3")], PAGES_SCHEMA)

    def reply(parts):
        img = parts[1]["image_url"]
        if img.endswith("MQ=="):
            return {"output_text": "", "output": [{"content": [{"text": '{"asset_type": "text", "confidence": 2}'}]}]}
        if img.endswith("Mg=="):
            raise RuntimeError("service unavailable")
        return "no json here"

    res = classify_latest(spark, inv, pages, _client_factory(reply), str(tmp_path / "results"))
    got = {r.relative_path: r for r in res.scored.collect()}
    assert got["a.pdf"].llm_document_type == "text" and got["a.pdf"].llm_confidence == 1.0
    assert got["a.pdf"].llm_raw_json == json.dumps({"asset_type": "text", "confidence": 2})
    assert got["b.pdf"].llm_document_type == "error" and "service unavailable" in got["b.pdf"].error
    assert got["c.pdf"].llm_document_type == "error" and got["c.pdf"].error
    assert got["d.pdf"].llm_document_type == "error" and got["d.pdf"].error == "document has no pages"


def test_waves_give_the_same_results(spark, tmp_path):
    rows = [(f"d{i}.pdf", f"d{i}.pdf", "True", None, None) for i in range(12)]
    inv = _inventory(spark, rows)
    pages = spark.createDataFrame([(f"d{i}.pdf", 1, bytes([65 + i])) for i in range(12)], PAGES_SCHEMA)
    reply = lambda parts: json.dumps({"asset_type": "text", "confidence": len(parts[1]["image_url"]) / 100})
    one_wave = classify_latest(spark, inv, pages, _client_factory(reply), str(tmp_path / "r1"))
    three = classify_latest(spark, inv, pages, _client_factory(reply), str(tmp_path / "r3"), waves=3)
    key = lambda df: sorted((r.relative_path, r.llm_document_type, r.llm_confidence) for r in df.collect())
    assert key(one_wave.scored) == key(three.scored)
    assert len(key(three.scored)) == 12


def test_documents_with_the_same_content_share_one_call(spark, tmp_path):
    calls = tmp_path / "calls.txt"
    inv = spark.createDataFrame([("a/x.pdf", "True", "h1"), ("b/y.pdf", "True", "h1"), ("c/z.pdf", "True", "h2")],
                                "relative_path string, is_latest string, md5_hash string")
    pages = spark.createDataFrame([(p, 1, b"img") for p in ("a/x.pdf", "b/y.pdf", "c/z.pdf")], PAGES_SCHEMA)

    def factory():
        def client(parts):
            with open(calls, "a") as fh:
                fh.write("call\n")
            return '{"asset_type": "image", "confidence": 0.5}'
        return client

    res = classify_latest(spark, inv, pages, factory, str(tmp_path / "r"), share_by="md5_hash")
    got = sorted((r.relative_path, r.llm_document_type) for r in res.scored.collect())
    assert got == [("a/x.pdf", "image"), ("b/y.pdf", "image"), ("c/z.pdf", "image")]
    assert calls.read_text().count("call") == 2


def test_retry_gives_one_row_a_document(spark, tmp_path):
    inv = _inventory(spark, [("a.pdf", "a.pdf", "True", None, None)])
    pages = spark.createDataFrame([("a.pdf", 1, b"1")], PAGES_SCHEMA)
    target = str(tmp_path / "results")
    classify_latest(spark, inv, pages, _client_factory(lambda p: 1 / 0), target)
    again = classify_latest(spark, inv, pages, _client_factory(lambda p: '{"asset_type": "text"}'), target, retry_errors=True)
    assert [r.llm_document_type for r in again.scored.collect()] == ["text"]


def test_blank_paths_go_by_full_path(spark, tmp_path):
    rows = [("/x/a.pdf", "", "True"), ("/x/b.pdf", "", "True")]
    inv = spark.createDataFrame(rows, "full_path string, relative_path string, is_latest string")
    pages = spark.createDataFrame([("/x/a.pdf", 1, b"1"), ("/x/b.pdf", 1, b"2")], PAGES_SCHEMA)
    res = classify_latest(spark, inv, pages, _client_factory(lambda p: '{"asset_type": "text"}'), str(tmp_path / "r"))
    assert res.scored.count() == 2 and res.inventory.count() == 2 and res.messages.count() == 2


def test_an_unreadable_results_table_is_an_error(spark, tmp_path):
    import pytest
    from vellum.plans.classify import read_results
    assert read_results(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        read_results(spark, str(tmp_path / "bad")).count()


def _lookup(spark, tmp_path, rows, listed, pages, reply, **kw):
    inv = spark.createDataFrame(rows, "full_path string, relative_path string, is_latest string")
    return classify_latest(spark, inv, spark.createDataFrame(pages, "path string, page_no int, image binary"),
                           _client_factory(reply), str(tmp_path / "r"), page_key="path", base_dir="/srv/inv",
                           listing=spark.createDataFrame([(p,) for p in listed], "path string"), **kw)


def test_documents_are_looked_up_before_they_are_scored(spark, tmp_path):
    rows = [("/srv/a.pdf", "x/a.pdf", "True"),        # absolute, there
            ("/old/b.pdf", "x/b.pdf", "True"),        # moved: found under the folder
            ("", "c.pdf", "True"),                    # found under the folder's parent
            ("/srv/d.pdf", " ", "True"),              # blank key
            ("/gone/e.pdf", "e.pdf", "True"),         # nowhere
            ("", None, "True"), ("", "", "True"),     # no path at all
            ("/gone/f.pdf", "f.pdf", "False")]        # not latest
    listed = ["/srv/a.pdf", "/srv/inv/x/a.pdf", "/srv/inv/x/b.pdf", "/srv/c.pdf", "/srv/d.pdf"]
    pages = [(p, 1, p.encode()) for p in listed]

    def reply(parts):
        import base64
        path = base64.b64decode(parts[1]["image_url"].split(",", 1)[1]).decode()
        return json.dumps({"asset_type": "text", "confidence": 0.5, "reason": path})

    res = _lookup(spark, tmp_path, rows, listed, pages, reply, waves=2)
    got = {r.relative_path: r.llm_reason for r in res.scored.collect()}
    assert got == {"x/a.pdf": "/srv/a.pdf", "x/b.pdf": "/srv/inv/x/b.pdf", "c.pdf": "/srv/c.pdf",
                   "/srv/d.pdf": "/srv/d.pdf", "e.pdf": "file not found: e.pdf", "": "file not found: <empty>"}
    assert res.inventory.count() == len(rows) and res.messages.count() == len(rows)
    again = _lookup(spark, tmp_path, rows, listed, pages, lambda parts: 1 / 0, waves=2)
    assert again.scored.count() == 0


def test_rows_with_one_key_are_one_call_and_a_missing_file_represents_no_group(spark, tmp_path):
    inv = spark.createDataFrame([("a.pdf", "h", "True"), ("b.pdf", "h", "True"), ("b.pdf", "h", "True")],
                                "relative_path string, md5_hash string, is_latest string")
    pages = spark.createDataFrame([("/s/b.pdf", 1, b"b")], "path string, page_no int, image binary")
    res = classify_latest(spark, inv, pages, _client_factory(lambda p: '{"asset_type": "text"}'),
                          str(tmp_path / "r"), share_by="md5_hash", page_key="path", base_dir="/s",
                          listing=spark.createDataFrame([("/s/b.pdf",)], "path string"))
    assert sorted((r.relative_path, r.llm_document_type) for r in res.scored.collect()) == [
        ("a.pdf", "error"), ("b.pdf", "text")]


def test_a_task_holds_several_calls_open_and_makes_failed_ones_again(spark):
    from vellum.operators.scoring import call_model
    keys = [f"d{i}" for i in range(12)]
    requests = spark.createDataFrame([(k, [{"type": "input_text", "text": k, "image_url": None}]) for k in keys],
                                     "id string, content array<struct<type:string,text:string,image_url:string>>")

    def factory():
        import threading
        import time
        state = call_model_state.setdefault("s", {"open": 0, "most": 0, "lock": threading.Lock(), "tries": {}})

        def client(parts):
            name = parts[0]["text"]
            with state["lock"]:
                state["open"] += 1
                state["most"] = max(state["most"], state["open"])
                state["tries"][name] = tries = state["tries"].get(name, 0) + 1
            time.sleep(0.05)
            with state["lock"]:
                state["open"] -= 1
            if name == "d3" or (name == "d5" and tries < 3):
                raise RuntimeError("busy")
            return f"{state['most']} {tries}"
        return client

    call_model_state: dict = {}
    out = {r.id: r for r in call_model(requests.coalesce(1), factory, "id", in_flight=4, retries=2,
                                       backoff=0.01).collect()}
    assert sorted(out) == sorted(keys)
    assert out["d3"].call_error == "RuntimeError: busy" and out["d5"].output_text.endswith(" 3")
    assert max(int(r.output_text.split()[0]) for r in out.values() if r.output_text) == 4
    assert call_model(requests.limit(0), factory, "id", in_flight=4).count() == 0
