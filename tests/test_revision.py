"""Revision keys, numbers, stems and time formatting."""

import pytest
from pyspark.sql import functions as F

from vellum.functions.revision import (file_stem, format_epoch, has_reduced_suffix, revision_group_key,
                                       revision_label, revision_number, with_suffix)


@pytest.mark.parametrize("stem,group,rev,num", [
    ("Pump manual rev07b", "Pump manual", "rev07b", 7),
    ("Ölplan_rev1", "Ölplan", "rev1", 1),
    ("leaflet", "leaflet", "", -1),
    ("Tank REV120", "Tank", "REV120", 120),
    ("t _\t_Rev0", "t", "Rev0", 0),
    ("rev5", "rev5", "", -1),
    ("x\u3000rev2", "x", "rev2", 2),
    ("x rev2B", "x", "rev2B", 2),
    ("x rev2ab", "x rev2ab", "", -1),
    ("x rev 2", "x rev 2", "", -1),
    ("Draft rev3-reduced", "Draft rev3-reduced", "", -1),
    ("_rev9", "", "rev9", 9),
])
def test_revision_parse(spark, stem, group, rev, num):
    r = spark.createDataFrame([(stem,)], "s string").select(
        revision_group_key(F.col("s")).alias("g"), revision_label(F.col("s")).alias("r"),
        revision_number(revision_label(F.col("s"))).alias("n")).first()
    assert (r.g, r.r, r.n) == (group, rev, num)


@pytest.mark.parametrize("path,stem,pdf,reduced", [
    ("a/b/c.pdf", "c", "a/b/c.pdf", False),
    ("a/x-REDUCED.pdf", "x-REDUCED", "a/x-REDUCED.pdf", True),
    ("a/.hidden", ".hidden", "a/.hidden.pdf", False),
    ("a..b", "a.", "a..pdf", False),
    ("dir.x/file", "file", "dir.x/file.pdf", False),
    ("m/t.msg", "t", "m/t.pdf", False),
])
def test_stems_and_suffix(spark, path, stem, pdf, reduced):
    r = spark.createDataFrame([(path,)], "p string").select(
        file_stem(F.col("p")).alias("s"), with_suffix(F.col("p"), ".pdf").alias("w"),
        has_reduced_suffix(F.col("p")).alias("x")).first()
    assert (r.s, r.w, r.x) == (stem, pdf, reduced)


def test_format_epoch_is_session_tz_independent(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        r = spark.createDataFrame([(1704067200 + 3723,)], "e long").select(format_epoch(F.col("e")).alias("t")).first()
        assert r.t == "2024-01-01 01:02:03"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_group_keys_are_case_sensitive_and_folder_blind(spark):
    from vellum.operators.latest import flag_latest
    rows = [("a/Plan rev01.pdf", 1), ("b/plan rev02.pdf", 2), ("c/Plan rev01b.pdf", 3)]
    df = spark.createDataFrame(rows, "relative_path string, t long")
    stem = file_stem(F.col("relative_path"))
    df = df.select("relative_path", revision_group_key(stem).alias("group_key"),
                   revision_number(revision_label(stem)).alias("revision_number"),
                   F.timestamp_seconds("t").alias("creation_time"))
    got = {r.relative_path: (r.group_key, r.revision_number, r.is_latest) for r in flag_latest(df).collect()}
    assert got["a/Plan rev01.pdf"] == ("Plan", 1, False)       # same number, older
    assert got["c/Plan rev01b.pdf"] == ("Plan", 1, True)       # letter ignored, newer wins
    assert got["b/plan rev02.pdf"] == ("plan", 2, True)        # other case, other group


def test_stems_and_suffixes_match_pathlib_on_random_names(spark):
    import random
    from pathlib import PurePosixPath
    rnd = random.Random(6)
    parts = ["a", "b", ".", "..", "x.y", "dir/", "-reduced", ".msg", " "]
    paths = []
    for _ in range(400):
        p = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 5)))
        name = p.rsplit("/", 1)[-1]
        if name and name not in (".", ".."):
            paths.append(p)
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string")
    rows = df.select("i", file_stem(F.col("p")).alias("s"), with_suffix(F.col("p"), ".pdf").alias("w")) \
             .orderBy("i").collect()
    for r, p in zip(rows, paths):
        path = PurePosixPath(p)
        assert r.s == path.stem, p
        if str(path) == p:                       # pathlib also normalises; compare where it does not
            assert r.w == str(path.with_suffix(".pdf")), p
