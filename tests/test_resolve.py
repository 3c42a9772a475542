"""Path resolution (J2) against a brute-force rendering of the rule."""

from hypothesis import HealthCheck, given, settings, strategies as st

from vellum.operators.resolve import resolve_paths

BASE = "/srv/inv"
NAMES = ["a.pdf", "d/b.pdf", "c.pdf"]


def _brute(full, rel, existing):
    cands = []
    for raw in (full.strip(), rel.strip()):
        if not raw:
            continue
        if raw.startswith("/"):
            cands.append(raw)
        else:
            cands += [f"{BASE}/{raw}", f"/srv/{raw}"]
    return next((c for c in cands if c in existing), None)


path_forms = st.one_of(st.just(""), st.just("  "), st.sampled_from(NAMES),
                       st.sampled_from(NAMES).map(lambda n: "/srv/" + n),
                       st.sampled_from(NAMES).map(lambda n: "/other/" + n))
files = st.sets(st.sampled_from([f"{root}/{n}" for root in ("/srv", "/srv/inv", "/other") for n in NAMES]))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(path_forms, st.sampled_from(NAMES)), min_size=1, max_size=6), files)
def test_first_existing_candidate_wins(spark, rows, existing):
    keyed = [(f"k{i}", full, rel) for i, (full, rel) in enumerate(rows)]
    df = spark.createDataFrame(keyed, "key string, full_path string, relative_path string")
    listing = spark.createDataFrame([(p,) for p in sorted(existing)] or [("/nothing",)], "path string")
    got = {r.key: r.resolved_path for r in resolve_paths(df, listing, BASE).collect()}
    assert got == {k: _brute(full, rel, existing) for k, full, rel in keyed}


def test_blank_null_and_repeated_rows(spark):
    rows = [("1", "", "/srv/a.pdf"), ("2", "", "/srv/c.pdf"), ("3", None, "/srv/a.pdf"), ("4", "a.pdf", None), ("5", "", ""),
            ("6", None, None), ("7", "a.pdf", None)]
    df = spark.createDataFrame(rows, "key string, relative_path string, full_path string")
    listing = spark.createDataFrame([("/srv/a.pdf",), ("/srv/c.pdf",)], "path string")
    got = {r.key: r.resolved_path for r in resolve_paths(df, listing, BASE).collect()}
    assert got == {"1": "/srv/a.pdf", "2": "/srv/c.pdf", "3": "/srv/a.pdf", "4": "/srv/a.pdf", "5": None, "6": None, "7": "/srv/a.pdf"}
