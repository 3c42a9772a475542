import math
import random
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
from llm_cases import EDGES, corpus, frame
from test_llm_join import brute

from vellum.llm import chosen_path, hard_negatives, prefix_trie


def brute_trie(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, sha256(f"{role or ''}\n{text or ''}".encode()).hexdigest(), role or "", text or ""))
    convs = {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}
    whole = {}
    for c, ts in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = convs.get(c - int(math.fmod(c, 100)), [])[:h] + ts[h:]
    nodes, kids = {}, {}
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for k in nodes:
        if k:
            kids[k[:-1]] = kids.get(k[:-1], 0) + 1
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in kids
            saved[k[:d]] += (len(members) - 1) * (len(k[-1][1]) if k else 0)
    return sorted((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), kids.get(k, 0), leaves[k], saved[k],
                   sha256(",".join(map(str, sorted(c for c in m if len(whole[c]) == len(k)))).encode()).hexdigest()) for k, m in nodes.items())


CONVERSATION = "conv_id bigint, turn bigint, role string, text string, depth int, rep string, salt double"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], CONVERSATION)


def test_trie_against_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for c in [*rng.sample(range(700), 60), -3, -150]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "bot", None]), rng.choice(["é", "hello", "", None, "long " * 50])))
    rows += [(None, 0, "user", "lost"), (5000, None, "user", "first"), (5000, 0, "user", "b"), (5000, 0, "user", "a"), (5000, 0, "user", "a")]
    rows += [(6000 + k, 0, "user", "common") for k in range(30)] + [(7000, t, "user", f"turn {t % 3}") for t in range(150)]
    for local_nodes in (4096, 8):  # finished in one go, and split by Spark first
        got = prefix_trie.prefix_trie(conversations(spark, rows), local_nodes).collect()
        assert sorted(map(tuple, got), key=lambda r: (r[0], r[1])) == brute_trie(rows)


def test_trie_of_nothing(spark):
    for rows in ([], [(None, 1, "user", "x")]):
        assert prefix_trie.prefix_trie(conversations(spark, rows)).count() == 0


def test_centroids_halve_their_components():
    rng = np.random.default_rng(2)
    for parents in ([-1] + list(range(400)), [-1] + [0] * 300, [-1] + [int(rng.integers(0, k)) for k in range(1, 500)]):
        parent = np.array(parents)
        depth = np.zeros(len(parent), np.int64)
        for k in range(1, len(parent)):
            depth[k] = depth[parent[k]] + 1
        value, want = rng.integers(0, 9, len(parent)), None
        mass, want = np.ones(len(parent), np.int64), value.copy()
        for k in np.argsort(-depth, kind="stable"):
            if parent[k] >= 0:
                mass[parent[k]] += mass[k]
                want[parent[k]] += want[k]
        got, = prefix_trie.decomposed(parent, depth, np.zeros(len(parent), np.int64), mass, [value])
        assert (got == want).all()


def brute_negatives(rows):
    part = [(v, (label + 1) % 10 if v is not None and v % 7 == 0 else label, [math.floor(256 * x) for x in e]) for v, e, label in rows
            if label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    by_id = lambda v: (v is None, v or 0)
    out = []
    for i, (v, label, x) in enumerate(part):
        if v is None or v % 50:
            continue
        others = sorted(((-score(x, y), by_id(w), j) for j, (w, _, y) in enumerate(part) if j != i))
        for p in [o for o in others if part[o[2]][1] == label][:5]:
            band = [o for o in others if part[o[2]][1] != label and 50 * -p[0] <= 100 * -o[0] <= 95 * -p[0]][:3]
            out += [(v, part[p[2]][0], k + 1, part[o[2]][0], -p[0], -o[0]) for k, o in enumerate(band)]
    return out


def test_negatives_against_brute_force(spark):
    rng = random.Random(7)
    rows = [(k, [rng.gauss(0.1, 0.3) for _ in range(70)], rng.randrange(10)) for k in range(300)]
    rows += [(301, rows[50][1], 3), (302, rows[50][1], 3), (303, rows[50][1], 4), (350, [0.0] * 70, 1), (None, rows[0][1], 2)]
    rows += [(400, None, 1), (401, [], 1), (402, [None] * 70, 1), (403, [float("nan")] * 70, 1), (404, [float("inf")] * 70, 2), (450, [0.3] * 7, 2), (405, [0.2] * 70, None)]
    table = spark.createDataFrame([(v, e, label, 1.5, "x") for v, e, label in rows], "vec_id bigint, embedding array<double>, label int, score double, block string")
    key = lambda r: tuple((x is None, x or 0) for x in r)
    for block_rows, group_anchors in ((4096, 1024), (40, 2)):
        got = [tuple(r) for r in hard_negatives.hard_negatives(table, block_rows, group_anchors).collect()]
        assert sorted(got, key=key) == sorted(brute_negatives(rows), key=key)
    assert hard_negatives.hard_negatives(table.limit(0)).count() == 0


def test_intervals_hold_and_decide():
    rng = np.random.default_rng(1)
    x = np.round(rng.standard_normal((600, 64)) * 32).astype(int)
    rows = [{"uid": i, "vec_id": i, "label": i % 3, "x": r.tolist(), "block": 0} for i, r in enumerate(x)]
    block = hard_negatives.Block(hard_negatives.coded(pa.Table.from_pylist(rows)).to_pylist()[0])
    for q in x[:20].astype(float):
        low, high = block.intervals(q)
        exact = block.x @ q
        assert (low <= exact).all() and (exact <= high).all()
        assert (high >= np.sort(low)[-6]).mean() < 0.3  # most rows need no exact score


def test_chosen_path_against_brute_force(spark):
    rng = random.Random(11)
    base = rng.choices([f"b{k}" for k in range(300)], k=150)
    rows = corpus(9, n=80)
    for k in range(150):  # a family around one text, near and far, and copies
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 8, 20])):
            words[rng.randrange(len(words))] = rng.choice(["x", "y", "z"])
        rows.append((200 + k, " ".join(words)))
    rows += EDGES
    want = brute(rows, percent=85)
    for small, depth in ((2048, 12), (3, 3)):  # compared at once, and branched first
        got = [tuple(r) for r in chosen_path.near_duplicates(frame(spark, rows), small=small, depth=depth).collect()]
        assert len(got) == len(rows)
        assert Counter(r[:3] for r in got) == want
        assert all(r[3] == (r[0] is not None and r[0] == r[2]) for r in got)
    assert chosen_path.near_duplicates(frame(spark, [])).count() == 0


def test_sets_survive_packing():
    h = np.sort(np.random.default_rng(3).integers(0, 1 << 63, 500, dtype=np.uint64))
    assert (chosen_path.unpack_set(chosen_path.pack_set(h)) == h >> np.uint64(16)).all()
