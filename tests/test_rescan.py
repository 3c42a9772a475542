"""A second scan opens only what changed."""

import hashlib
import os

from pyspark.sql import functions as F

from vellum.plans.scan import scan_directory
from vellum.sources.files import list_files


def _write(root, files):
    for name, data in files.items():
        os.makedirs(os.path.dirname(root / name), exist_ok=True)
        (root / name).write_bytes(data)


def _digests(rows):
    return {r["path"].rsplit("/", 1)[1]: r["md5_hash"] for r in rows.collect()}


def _md5(data):
    return hashlib.md5(data).hexdigest()


def test_unchanged_files_keep_the_known_digest(spark, tmp_path):
    root = tmp_path / "docs"
    _write(root, {"a.pdf": b"a", "x/b.pdf": b"b", "x/c.pdf": b"", "x/d.pdf": b"d"})
    first = list_files(spark, str(root))
    # a mark in place of the digest shows which files were not opened
    known = spark.createDataFrame([tuple(r) for r in first.withColumn("md5_hash", F.lit("kept")).collect()], first.schema)
    _write(root, {"a.pdf": b"longer", "x/d.pdf": b"e", "y/new.pdf": b"n"})
    os.utime(root / "x/d.pdf", (5, 5))
    os.rename(root / "x/b.pdf", root / "x/moved.pdf")
    got = _digests(list_files(spark, str(root), known=known))
    assert got == {"a.pdf": _md5(b"longer"), "c.pdf": "kept", "d.pdf": _md5(b"e"), "new.pdf": _md5(b"n"), "moved.pdf": _md5(b"b")}
    assert _digests(list_files(spark, str(root), known=known.limit(0)))["c.pdf"] == _md5(b"")


def test_scans_one_after_the_other(spark, tmp_path):
    root, inventory = tmp_path / "docs", str(tmp_path / "inventory")
    _write(root, {"a.pdf": b"a", "b rev2.pdf": b"b", "c.pdf": b"c"})
    scan_directory(spark, str(root), inventory)
    _write(root, {"a.pdf": b"aa", "d.pdf": b"d"})
    os.remove(root / "c.pdf")
    for _ in range(2):
        res = scan_directory(spark, str(root), inventory)
        fresh = scan_directory(spark, str(root), inventory, write=False, reuse_digests=False)
        rows = lambda df: sorted((r.relative_path, r.md5_hash, r.is_latest) for r in df.collect())
        assert rows(res.scanned) == rows(fresh.scanned)
    stored = spark.read.parquet(inventory + "-digests")
    assert sorted(r.scan for r in stored.select("scan").distinct().collect()) == [1, 2, 3]
    assert stored.filter("scan = 3").count() == 3
