import hashlib
import os
import shutil
import subprocess
import sys

import duckdb
import pytest
from conftest import ROOT, SF_SMALL

import corpus_pipeline
from vellum.llm.oracle import ORACLE
from vellum.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name.split("_")[0] not in ("op11", "op13"):
        assert len(rows) >= spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    if name in ORACLE:
        con = duckdb.connect()
        for table in ("documents", "embeddings", "conversations"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_SMALL}/{table}.parquet'")
        cur = con.execute(ORACLE[name])
        columns = [d[0] for d in cur.description]
        want = sorted(repr(tuple(r[columns.index(c)] for c in df.columns)) for r in cur.fetchall())
        assert sorted(columns) == sorted(df.columns) and sorted(map(repr, rows)) == want


def test_pipeline_against_brute_force(spark, tmp_path):
    """Every stage against plain Python on its own input."""
    from test_llm_dedup import brute_lines
    from test_llm_join import brute
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, held = docs.dtypes, [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, held[-1], SF_SMALL).write.parquet(f"{tmp_path}/{k}")
        held.append(spark.read.parquet(f"{tmp_path}/{k}"))
        if k < 4:
            assert held[-1].dtypes == columns
    rows = [[(r["doc_id"], r["text"]) for r in df.collect()] for df in held[:5]]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    kept = {i for i, _ in rows[1]}
    assert sum((i in kept) == bool(q) for i, q in labels.items()) >= 0.95 * len(labels)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert {(i, sha(t)) for i, t in rows[2]} == {(i, s) for i, _, _, s in brute_lines(rows[1], 40, 5)}
    assert all(r["n_chars"] == len(r["text"]) for r in held[2].collect())
    assert {i for i, _ in rows[3]} == {c for _, _, c in brute(rows[2])}
    items = [r["text"].lower() for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    dirty = {i for i, t in rows[3] if any(x in t.lower() for x in items)}
    assert {i for i, _ in rows[4]}.isdisjoint(dirty)
    assert len(rows[3]) - len(rows[4]) <= len(dirty) + 2
    packed = held[5].collect()
    assert {r["doc_id"] for r in packed} == {i for i, _ in rows[4]}


def test_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]


def test_library_works_without_the_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "vellum"):
        src = os.path.join(ROOT, name)
        if os.path.isdir(src):
            shutil.copytree(src, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(src, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') and n[2].isdigit() for n in q); print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
