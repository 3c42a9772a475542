"""Reduction of inventoried files with an injected reducer."""

import os
import uuid

import pytest

from vellum.plans.reduce import reduce_inventory

from conftest import one

SCHEMA = "filename string, full_path string, relative_path string, file_size string, reduced string"


def _inv(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("original,reduced", [(b"original PDF content" * 10, b"reduced"),
                                              (b"original", b"larger reduced PDF")])
def test_replaces_original(spark, tmp_path, original, reduced):
    src = tmp_path / "document.pdf"
    src.write_bytes(original)
    inv = _inv(spark, [("document.pdf", str(src), "document.pdf", str(len(original)), None)])
    res = reduce_inventory(spark, inv, str(tmp_path), reducer=lambda data: reduced)
    row = res.inventory.first()
    assert src.read_bytes() == reduced
    assert row.full_path == str(src) and row.filename == "document.pdf"
    assert int(row.file_size) == len(reduced) and row.reduced is True
    assert not (tmp_path / ".document.pdf.reduced-temp").exists()
    acc = one(res.accounting)
    assert acc.saved_bytes == len(original) - len(reduced)


@pytest.mark.parametrize("name,flag", [("document.pdf", "True"), ("document.pdf", " yes"),
                                       ("document-reduced.pdf", None)])
def test_skips_already_reduced(spark, tmp_path, name, flag):
    src = tmp_path / name
    src.write_bytes(b"already reduced")

    def must_skip(data):
        raise AssertionError("must skip")

    inv = _inv(spark, [(name, str(src), "document.pdf", "15", flag)])
    res = reduce_inventory(spark, inv, str(tmp_path), reducer=must_skip)
    row = res.inventory.first()
    assert row.reduced is True
    assert res.results.count() == 0
    assert one(res.accounting).n_reduced == 0


def test_missing_file_is_an_error_row_and_relative_paths_resolve(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "rel.pdf").write_bytes(b"abcabc")
    inv = _inv(spark, [("gone.pdf", str(tmp_path / "gone.pdf"), "gone.pdf", "1", "False"),
                       ("rel.pdf", "", "sub/rel.pdf", "6", "no")])
    res = reduce_inventory(spark, inv, str(tmp_path), reducer=lambda d: d[:3], replace_original=False)
    got = {os.path.basename(r.source_path): r for r in res.results.collect()}
    assert got["gone.pdf"].error and got["rel.pdf"].error is None
    assert (tmp_path / "sub" / "rel-reduced.pdf").read_bytes() == b"abc"


def test_reduce_directory(spark, tmp_path):
    from vellum.plans.reduce import reduce_directory
    src = tmp_path / "in"
    (src / "sub").mkdir(parents=True)
    (src / "sub" / "a.PDF").write_bytes(b"aaaa bbbb")
    (src / "b-reduced.pdf").write_bytes(b"done")
    (src / "note.txt").write_bytes(b"not a pdf")
    out = tmp_path / "out"
    res = reduce_directory(spark, str(src), lambda d: d[:4], output_dir=str(out))
    plan = {os.path.basename(r.source_path): (r.action, r.destination) for r in res.plan.collect()}
    assert plan["b-reduced.pdf"][0] == "already_reduced"
    assert plan["a.PDF"] == ("reduce", str(out / "sub" / "a-reduced.PDF"))
    assert (out / "sub" / "a-reduced.PDF").read_bytes() == b"aaaa"
    assert one(res.accounting).saved_bytes == 5


def test_staging_is_retry_safe(spark, tmp_path):
    from vellum.operators import reduction
    src = tmp_path / "doc.pdf"
    src.write_bytes(b"original content")
    inv = _inv(spark, [("doc.pdf", str(src), "doc.pdf", "16", None)])
    plan = reduction.reduction_plan(inv, str(tmp_path))
    first = reduction.reduce_files(plan, lambda d: d[:4]).collect()
    again = reduction.reduce_files(plan, lambda d: d[:4]).collect()      # a retried stage 1
    assert src.read_bytes() == b"original content"                        # nothing replaced yet
    assert [r.reduced_size for r in first] == [r.reduced_size for r in again] == [4]
    staged = spark.createDataFrame(first, reduction.REDUCE_RESULT)
    assert reduction.commit_files(staged).first().error is None
    assert reduction.commit_files(staged).first().error is None           # a retried stage 2
    assert src.read_bytes() == b"orig"


def test_rows_do_not_multiply(spark, tmp_path):
    for n in ("x", "y"):
        (tmp_path / f"{n}.bin").write_bytes(n.encode() * 10)
    full = lambda n: str(tmp_path / f"{n}.bin")
    inv = _inv(spark, [("x.bin", full("x"), "", "10", None), ("y.bin", full("y"), "", "10", None),
                       ("x again", full("x"), "x.bin", "10", None), ("none", "", "", "1", "no")])
    calls = tmp_path / "calls"
    calls.mkdir()

    def reducer(data):
        (calls / uuid.uuid4().hex).touch()  # calls run side by side, so each has a name of its own
        return data[:4]
    res = reduce_inventory(spark, inv, str(tmp_path), reducer)
    got = sorted((r.filename, r.full_path, int(r.file_size), r.reduced) for r in res.inventory.collect())
    assert got == [("none", "", 1, False), ("x.bin", full("x"), 4, True), ("x.bin", full("x"), 4, True),
                   ("y.bin", full("y"), 4, True)]
    acc = one(res.accounting)
    assert (acc.n_reduced, acc.original_bytes, acc.reduced_bytes, len(list(calls.iterdir()))) == (2, 20, 8, 2)


def test_a_lost_staged_file_is_an_error(spark, tmp_path):
    from vellum.operators import reduction
    src = tmp_path / "doc.bin"
    src.write_bytes(b"ORIGINAL")
    plan = reduction.reduction_plan(_inv(spark, [("doc.bin", str(src), "doc.bin", "8", None)]), str(tmp_path))
    staged = spark.createDataFrame(reduction.reduce_files(plan, lambda d: d[:3]).collect(), reduction.REDUCE_RESULT)
    os.rename(tmp_path / ".doc.bin.reduced-temp", tmp_path / "elsewhere")
    assert reduction.commit_files(staged).first().error == "staged file missing"
    assert src.read_bytes() == b"ORIGINAL"
