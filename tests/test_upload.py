"""Uploads through an injected put: ok/failed counts and collisions."""

from vellum.operators.delivery import directory_put
from vellum.plans.upload import upload_inventory

from conftest import one


def test_upload_counts_and_overwrite(spark, tmp_path):
    (tmp_path / "a b.pdf").write_bytes(b"one")
    (tmp_path / "a-b.pdf").write_bytes(b"two")
    store = tmp_path / "store"
    store.mkdir()
    inv = spark.createDataFrame([
        (str(tmp_path / "a b.pdf"), "x/a b.pdf", None),
        (str(tmp_path / "a-b.pdf"), "x/a-b.pdf", ""),
        (str(tmp_path / "missing.pdf"), "x/missing.pdf", "kept-name.pdf"),
    ], "full_path string, relative_path string, upload_name string")
    res = upload_inventory(spark, inv, directory_put(str(store)))
    s = one(res.summary)
    assert (s.uploaded, s.failed, s.duplicates) == (1, 1, 1)
    assert sorted(p.name for p in store.iterdir()) == ["x--a-b.pdf"]
    assert (store / "x--a-b.pdf").read_bytes() == b"one"          # the first path wins, every time
    c = one(res.collisions)
    assert (c.upload_name, c.n_paths, c.kept_path) == ("x--a-b.pdf", 2, "x/a b.pdf")
    failed = [r for r in res.results.collect() if r.status == "failed"][0]
    assert failed.upload_name == "kept-name.pdf" and "FileNotFoundError" in failed.error
