"""The file tree source, file streams and ordered listings."""

import os
import random

import pytest
from pyspark.sql import functions as F

from vellum.operators.ordering import with_positions
from vellum.sources.tree import list_tree, plan, read_share
from vellum.streaming.ingest import scan_stream, scanned_files


def _grow(root, rng, folders=60, files=200):
    known, paths = [str(root)], []
    for k in range(folders):
        known.append(os.path.join(rng.choice(known), f"f{k} ü"))
        os.makedirs(known[-1], exist_ok=True)
    for k in range(files):
        paths.append(os.path.join(rng.choice(known), f".{k}" if k % 9 == 0 else f"{k}.{rng.choice(['pdf', 'PDF', 'msg'])}"))
        with open(paths[-1], "wb") as out:
            out.write(b"x" * rng.randrange(50))
    return paths


@pytest.mark.parametrize("limit", [1, 2, 5, 30, 1000])
def test_shares_cover_a_tree_once(tmp_path, limit):
    paths = _grow(tmp_path, random.Random(limit))
    os.makedirs(tmp_path / "many")
    for k in range(40):
        os.makedirs(tmp_path / "many" / str(k))
        paths.append(str(tmp_path / "many" / str(k) / "a.pdf"))
        open(paths[-1], "w").close()
    shares = plan(str(tmp_path), limit=limit)
    got = [row[0] for share in shares for row in read_share(share)]
    assert sorted(got) == sorted(paths)


def test_a_wide_folder_is_read_in_runs(tmp_path, monkeypatch):
    import tracemalloc
    from vellum.sources import tree
    monkeypatch.setattr(tree, "LOOKED_AT", 50)

    def peak(n):
        root = tmp_path / str(n)
        for k in range(n):
            os.makedirs(root / f"folder of some length {k}")
            (root / f"folder of some length {k}" / "a.pdf").touch()
        tracemalloc.start()
        assert len({f.folder for f in plan(str(root), limit=4)}) == 1
        listed = sum(1 for share in plan(str(root), limit=4) for _ in read_share(share))
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert listed == n
        return top
    peak(10)  # what the first call imports
    assert peak(4000) < 2 * peak(400)


def test_batch_listing_with_ending_and_filters(spark, tmp_path):
    paths = _grow(tmp_path, random.Random(3))
    got = list_tree(spark, str(tmp_path), ".PDF").collect()
    assert sorted(r.path for r in got) == sorted(p for p in paths if p.lower().endswith(".pdf"))
    assert all(r.length == os.path.getsize(r.path) for r in got)
    assert list_tree(spark, str(tmp_path / "none")).count() == 0
    prefix = str(tmp_path / "f0 ü")
    under = list_tree(spark, str(tmp_path)).filter(F.col("path").startswith(prefix)).collect()
    one = list_tree(spark, str(tmp_path)).filter(F.col("path") == paths[7]).collect()
    assert sorted(r.path for r in under) == sorted(p for p in paths if p.startswith(prefix))
    assert [r.path for r in one] == [paths[7]]


def test_a_prefix_keeps_other_folders_shut(tmp_path, monkeypatch):
    from vellum.sources import tree
    _grow(tmp_path, random.Random(3))
    opened, entries = [], tree._entries
    monkeypatch.setattr(tree, "_entries", lambda f: opened.append(f) or entries(f))
    prefix = str(tmp_path / "f0 ü") + "/"
    for share in plan(str(tmp_path), prefix, 5):
        list(read_share(share, prefix=prefix))
    assert all(f == str(tmp_path) or (f + "/").startswith(prefix) for f in opened)


def test_stream_takes_each_file_once_and_changed_ones_again(spark, tmp_path):
    root, rows, checkpoint = str(tmp_path / "tree"), str(tmp_path / "rows"), str(tmp_path / "checkpoint")

    def write(name, text):
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as out:
            out.write(text)

    def run():
        scan_stream(spark, root, rows, checkpoint, settle=0.0).awaitTermination()
        return sorted((r.filename, r.file_size) for r in scanned_files(spark, rows).collect())
    write("a/one.pdf", "1")
    write("a/two.txt", "22")
    assert run() == [("one.pdf", 1)]
    write("b/c/three.PDF", "333")
    assert run() == [("one.pdf", 1), ("three.PDF", 3)]
    assert run() == [("one.pdf", 1), ("three.PDF", 3)]
    write("a/one.pdf", "4444")
    assert run() == [("one.pdf", 4), ("three.PDF", 3)]
    assert spark.read.parquet(rows).count() == 3


@pytest.mark.parametrize("number", [1, 7])
def test_positions(spark, number):
    rng = random.Random(number)
    rows = [(rng.choice(["hot", "hot", None, "", "a", "ü", "B"]) if k % 2 else f"k{rng.randrange(300)}",
             rng.choice([None, 0, 5, 7]), k) for k in range(500)]
    df = spark.createDataFrame(rows, "path string, bytes bigint, position bigint")
    df = df.withColumnRenamed("position", "id").withColumn("before", F.lit("old"))
    got = sorted(with_positions(df, "path", F.col("bytes"), number).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(500))
    assert sorted((r.path is not None, r.path or "", r.id) for r in got) == sorted((p is not None, p or "", k) for p, _, k in rows)
    assert [r.path or "" for r in got if r.path is not None] == sorted(p for p, _, _ in rows if p is not None)
    total = 0
    for r in got:
        assert r.before == total
        total += r.bytes or 0
    assert with_positions(df.limit(0), "path", F.col("bytes"), number).count() == 0


def test_positions_use_no_window_over_all_rows(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("path"), F.lit(1).alias("bytes"))
    placed = with_positions(df, "path", F.col("bytes"), 8)
    assert placed.groupBy(F.spark_partition_id()).count().count() >= 1
    plan_text = placed._jdf.queryExecution().optimizedPlan().toString()
    assert plan_text.count("Aggregate [__range") == 1  # the only ungrouped window is over one row a range
