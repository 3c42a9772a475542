import hashlib
from collections import Counter, defaultdict

import pytest
from llm_cases import EDGES, WORD, ascii_lower, corpus, frame

from vellum.llm import exact_dedup, line_dedup, substring_dedup


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_substrings(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[k:k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words):
        gone = {p for k in range(len(w) - window + 1) if seen[tuple(w[k:k + window])] > 1 for p in range(k, k + window)}
        out.append((i, len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone))))
    return Counter(out)


def brute_lines(rows, least_chars, least_docs):
    key = lambda x: ascii_lower(x.strip(" \t\n\x0b\x0c\r"))
    lines = [(t or "").split("\n") for _, t in rows]
    docs, last = Counter(), {}
    for (i, _), own in zip(rows, lines):
        for k in {key(x) for x in own if len(key(x)) >= least_chars}:
            docs[k] += 1
            last[k] = max([x for x in (last.get(k), i) if x is not None], default=None)
    out = []
    for (i, _), own in zip(rows, lines):
        left = [x for x in own if docs.get(key(x), 0) < least_docs or len(key(x)) < least_chars or last[key(x)] == i]
        out.append((i, len(own), len(own) - len(left), sha("\n".join(left))))
    return Counter(out)


@pytest.mark.parametrize("seed,block_bytes", [(1, 1 << 20), (2, 3000), (3, 500)])
def test_substrings_against_brute_force(spark, seed, block_bytes):
    rows = corpus(seed) + EDGES
    got = substring_dedup.remove_repeats(frame(spark, rows), window=8, block_bytes=block_bytes, cells_per_byte=0.2)
    assert Counter(tuple(r)[:4] for r in got.collect()) == brute_substrings(rows, 8)
    for r in got.collect():
        assert sha(r["kept_text"]) == r["kept_sha256"]


@pytest.mark.parametrize("seed,block_bytes", [(1, 1 << 20), (2, 3000), (5, 500)])
def test_lines_against_brute_force(spark, seed, block_bytes):
    rows = corpus(seed) + EDGES + [(None, "A line without an id that is longer than forty characters")] * 3
    got = line_dedup.drop_shared_lines(frame(spark, rows), min_docs=3, block_bytes=block_bytes, bits_per_byte=0.1)
    assert Counter(tuple(r)[:4] for r in got.collect()) == brute_lines(rows, 40, 3)


def test_lines_keep_all_columns(spark):
    docs = frame(spark, corpus(4) + EDGES)
    left = line_dedup.without_shared_lines(docs)
    assert left.dtypes == docs.dtypes and left.count() == docs.count()
    assert {r["block"] for r in left.collect()} == {"b"}


def test_lines_need_little_memory():
    import numpy as np
    import pyarrow as pa
    import tracemalloc
    texts = pa.array([f"line {k} of a text, which is longer than forty characters\n" * 50 for k in range(2500)])  # 7 MB
    line_dedup.Lines(texts.slice(0, 100), 40)  # the hashers' powers stay
    tracemalloc.start()
    found = line_dedup.Lines(texts, 40)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 7 * len(found.data)
    assert len(found.long) == 50 * 2500 and np.array_equal(np.diff(found.first), np.full(2500, 51))


@pytest.mark.parametrize("share,tracked", [(1024, 8192), (2, 8)])
def test_exact_groups(spark, share, tracked):
    rows = corpus(7) + EDGES + [(2000 + k, "Hot " + "copy") for k in range(80)] + [(None, "all null")] * 3
    got = exact_dedup.group_copies(frame(spark, rows).repartition(5), share=share, tracked=tracked).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[ascii_lower(t or "")].append(i)
    want = Counter()
    for i, t in rows:
        own = groups[ascii_lower(t or "")]
        keep = max([x for x in own if x is not None], default=None)
        want[(i, keep, len(own), i == keep, sha(ascii_lower(t or "")))] += 1
    assert Counter(tuple(r) for r in got) == want


def test_distinct_rows(spark):
    rows = corpus(7) + EDGES
    docs = frame(spark, rows)
    left = exact_dedup.distinct_rows(docs)
    assert left.dtypes == docs.dtypes
    assert sorted(ascii_lower(r["text"] or "") for r in left.collect()) == sorted({ascii_lower(t or "") for _, t in rows})


def test_empty_tables(spark):
    none = frame(spark, [])
    assert substring_dedup.remove_repeats(none).count() == 0
    assert line_dedup.drop_shared_lines(none).count() == 0
    assert exact_dedup.group_copies(none).count() == 0


def test_exact_dedup_is_native(spark):
    plan = exact_dedup.group_copies(frame(spark, corpus(1)))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
