"""Invariants and metamorphic checks against a brute-force rendering of the
"""

import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from vellum.operators.dedup import first_seen
from vellum.operators.incremental import scan_summary, unseen
from vellum.operators.latest import flag_latest

STEMS = ["Plan", "Plan rev01", "Plan_rev02a", "Plan REV2", "Spec rev00", "Spec rev00b", "x", "x _rev9"]
REV = re.compile(r"[\s_]+(rev\d+[a-z]?)$", re.IGNORECASE)


def _parse(stem):
    m = REV.search(stem)
    if not m:
        return stem, -1
    return stem[: m.start()].strip(" _"), int(re.match(r"rev(\d+)", m.group(1), re.I).group(1))


def _brute(files):
    """First copy (smallest path) per content, then per group the highest
    (revision number, time), ties to the smallest path."""
    kept = {}
    for path, content, t in sorted(files):
        kept.setdefault(content, (path, t))
    rows = []
    for content, (path, t) in kept.items():
        group, num = _parse(path.rsplit("/", 1)[1][:-4])
        rows.append((path, group, num, t))
    best = {}
    for path, group, num, t in rows:
        key = (-num, -t, path)
        if group not in best or key < best[group][0]:
            best[group] = (key, path)
    return {path: best[group][1] == path for path, group, num, t in rows}


file_sets = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c/d"]), st.sampled_from(STEMS), st.integers(0, 5),
              st.integers(0, 3)),
    min_size=1, max_size=25)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(file_sets, st.integers(1, 7))
def test_dedup_and_latest_match_brute_force(spark, spec, parts):
    files = {}
    for folder, stem, content, t in spec:
        files[f"{folder}/{stem}.pdf"] = (f"content-{content}", t)
    rows = [(p, c, t) for p, (c, t) in files.items()]
    df = spark.createDataFrame(rows, "relative_path string, md5_hash string, t long").repartition(parts)
    from vellum.functions.revision import file_stem, revision_group_key, revision_label, revision_number
    stem = file_stem(F.col("relative_path"))
    df = df.select("*", revision_group_key(stem).alias("group_key"),
                   revision_number(revision_label(stem)).alias("revision_number"),
                   F.timestamp_seconds("t").alias("creation_time"))
    got = {r.relative_path: r.is_latest for r in flag_latest(first_seen(df)).collect()}
    assert got == _brute(rows)
    # invariants: one latest per group, unique contents after dedup
    flagged = flag_latest(first_seen(df))
    per_group = flagged.groupBy("group_key").agg(F.count_if("is_latest").alias("n")).collect()
    assert all(r.n == 1 for r in per_group)
    assert flagged.select("md5_hash").distinct().count() == flagged.count()


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("ab/\\", min_size=1, max_size=4), min_size=1, max_size=15),
       st.lists(st.text("ab/\\", min_size=1, max_size=4), max_size=15))
def test_summary_adds_up_and_second_run_adds_nothing(spark, scanned_keys, stored_keys):
    scanned = spark.createDataFrame([(k,) for k in dict.fromkeys(scanned_keys)], "relative_path string")
    stored = spark.createDataFrame([(k,) for k in stored_keys], "relative_path string")
    s = scan_summary(scanned, stored).first()
    assert s.added_files + s.skipped_files == s.total_files
    new = unseen(scanned, stored)
    assert new.count() == s.added_files
    assert unseen(scanned, stored.unionByName(new)).count() == 0
