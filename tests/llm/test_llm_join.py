import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import EDGES, WORD, ascii_lower, corpus, frame

from vellum.llm import components, ngram_join


def shingle_set(text, size=5):
    w = WORD.findall(ascii_lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1)))


def brute(rows, size=5, percent=80):
    sets = [shingle_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    ids = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        ids[find(k)].append(i)
    least = {r: min([x for x in own if x is not None], default=None) for r, own in ids.items()}
    return Counter((i, len(sets[k]), least[find(k)] if sets[k] else i) for k, (i, _) in enumerate(rows))


def family(seed, n, words, changes):
    """Near copies of one text, some too far away to link."""
    rng = random.Random(seed)
    base = [f"v{rng.randrange(10**6)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, changes)):
            own[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("seed,block_bytes,all_pairs", [(1, 1 << 20, 16), (2, 2000, 16), (3, 1500, 0)])
def test_components_against_brute_force(spark, monkeypatch, seed, block_bytes, all_pairs):
    monkeypatch.setattr(ngram_join, "ALL_PAIRS", all_pairs)
    rng = random.Random(seed)
    texts = family(seed, 40, 90, 4) + family(seed + 10, 25, 12, 1) + family(seed + 20, 10, 7, 1)
    rows = corpus(seed, 40) + EDGES + [(3000 + k, t) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    got = ngram_join.near_duplicates(frame(spark, rows), block_bytes=block_bytes)
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)


def test_shared_passage_does_not_link(spark):
    rng = random.Random(9)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(200))) for k in range(60)]
    got = ngram_join.near_duplicates(frame(spark, rows), block_bytes=20_000)
    assert all(r["component_id"] == r["doc_id"] for r in got.collect())


def test_one_of_each_component_stays(spark):
    rows = corpus(5) + EDGES
    docs = frame(spark, rows)
    left = ngram_join.first_of_components(docs)
    assert left.dtypes == docs.dtypes
    want = {c for i, n, c in brute(rows) if i is not None}
    assert {r["doc_id"] for r in left.collect() if r["doc_id"] is not None} == want
    assert sum(r["doc_id"] is None for r in left.collect()) == 2


def test_empty_table(spark):
    assert ngram_join.near_duplicates(frame(spark, [])).count() == 0
    assert ngram_join.near_duplicates(frame(spark, [(1, None), (2, "")])).count() == 2


def test_allocation_spends_all_units():
    rng = np.random.default_rng(1)
    for _ in range(200):
        m = int(rng.integers(2, 9))
        units = int(rng.integers(1, m + 1))
        one = rng.integers(0, 9, m)
        two = one + rng.integers(0, 9, m)
        a, b = ngram_join._allocate(one, two, units)
        assert not set(a) & set(b) and len(a) + 2 * len(b) >= units
        best = min(one[list(x)].sum() + two[list(y)].sum() for x, y in _spendings(m, units))
        assert one[a].sum() + two[b].sum() == best


def _spendings(m, units):
    from itertools import product
    for c in product((0, 1, 2), repeat=m):
        if sum(c) >= units:
            yield [s for s in range(m) if c[s] == 1], [s for s in range(m) if c[s] == 2]


def test_star_components(spark):
    links = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 120)] + [(5, 5)]
    got = components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {(r["node"], r["root"]) for r in got} == {(k, 0) for k in range(31)} | {(k, 100) for k in range(100, 120)}


def test_entries_are_counted_as_sent():
    """What cuts the blocks is the number of entries that Block.entries
    makes, for texts of any length."""
    rng = random.Random(2)
    import pyarrow as pa
    texts = [" ".join(rng.choices([f"w{k}" for k in range(500)], k=n)) for n in [0, 1, 3, 5, 6, 9, 12, 20, 25, 33, 34, 60, 200, 900]]
    table = pa.table({"doc_id": list(range(len(texts))), "text": texts})
    doc, h = ngram_join.shingles(table["text"], 5)
    sizes, digests = ngram_join.classes(doc, h, len(texts))
    keys, owner, _, _ = ngram_join.Block(table, {d for d in digests if d}, 5).entries()
    held = ngram_join.Block(table, {d for d in digests if d}, 5)
    assert len(keys) == ngram_join.entry_counts(held.sizes).sum()


def test_first_of_components_keeps_one_row(spark):
    rows = corpus(3) + EDGES
    left = [r["doc_id"] for r in ngram_join.first_of_components(frame(spark, rows)).collect()]
    named = [i for i in left if i is not None]
    assert len(named) == len(set(named)) and set(named) == {c for _, _, c in brute(rows) if c is not None}
    assert left.count(None) == sum(i is None for i, _ in rows)
