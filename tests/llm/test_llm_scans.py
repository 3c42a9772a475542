import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import EDGES, corpus, frame

from vellum.llm import decontaminate, quality, secret_scan
from conftest import SF_SMALL

BASE = {"assign": (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                   lambda m: len(m[2]) >= 8),
        "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16), "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 32)}


def brute_base(text):
    out = []
    for k, (kind, (pattern, holds)) in enumerate(BASE.items()):
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, text) if holds(m)]
    return [(kind, s, e) for s, k, e in sorted(out) for kind in [list(BASE)[k]]]


def secrets_texts():
    rng = random.Random(3)
    bits = ["password", "PassWd", "secret", "tokentoken", "api_key", "APIKEY", "=", ": ", " = ", "\"", "'", "abcdefgh", "Zz9+/=", "AKIA", "AKIAABCDEFGHIJKL",
            "0123456789abcdef", "deadbeef" * 4, "é", "ſecret", "toKen", "\n", " ", "İ", "akia"]
    return ["".join(rng.choices(bits, k=rng.randint(0, 14))) for _ in range(1500)]


def test_base_spans_against_plain_patterns(spark):
    rows = [(k, t) for k, t in enumerate(secrets_texts())] + EDGES
    got = secret_scan.digest(secret_scan.scan(frame(spark, rows))).collect()
    want = Counter()
    for i, t in rows:
        spans = brute_base(t or "")
        n = Counter(k for k, _, _ in spans)
        want[(i, n["assign"], n["access"], n["hex"], secret_scan.base_digest(spans))] += 1
    assert Counter(tuple(r)[:5] for r in got) == want


def test_checksummed_tokens():
    payload = "abcdefghijklmnopqrstuvwxyz0123"
    good = "ghp_" + payload + secret_scan.checksum62(payload)
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    npm = "npm_" + payload + secret_scan.checksum62(payload)
    text = f"é {good} x {bad} y {npm}"
    found = secret_scan.find_spans(pa.array([text]))[0]
    assert [(secret_scan.KINDS[k], text[s:e]) for s, k, e in found] == [("github", good), ("npm", npm)]


def brute_stretches(equal, penalty, first=0):
    """The best-scoring stretch, the shortest of equals, and the same left
    and right of it."""
    n = len(equal)
    score = lambda a, b: sum(1 if x else -penalty for x in equal[a:b])
    best = max(((score(a, b), a - b, -a) for a in range(n) for b in range(a + 1, n + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    a, b = -best[2], -best[2] - best[1]
    return brute_stretches(equal[:a], penalty, first) + [(first + a, first + b)] + brute_stretches(equal[b:], penalty, first + b)


def test_all_maximal_stretches():
    rng = random.Random(8)
    for _ in range(400):
        equal = [rng.random() < 0.6 for _ in range(rng.randint(0, 24))]
        penalty = rng.randint(1, 3)
        assert decontaminate.stretches(np.array(equal, bool), penalty) == brute_stretches(equal, penalty)


def test_two_stretches_on_one_diagonal_and_text_ids(spark):
    item = " ".join(f"q{k}" for k in range(60))
    words = item.split()
    words[11:30] = [f"other{k}" for k in range(19)]   # 11 equal, a changed middle
    words[36] = "other"                                # then 13 tokens, one of them changed
    words[43:] = [f"more{k}" for k in range(17)]
    benchmark = spark.createDataFrame([("item-a", item), (None, "x"), ("item-a", item)], "item_id string, text string")
    found = decontaminate.find_overlaps(frame(spark, [(1, " ".join(words))]), benchmark).collect()[0]["overlaps"]
    assert [(o["item_id"], o["tokens"], o["first"], o["end"]) for o in found][0] == ("item-a", 12, 30, 43)
    assert decontaminate.summary(decontaminate.find_overlaps(frame(spark, [(1, " ".join(words))]), benchmark)).first()["contaminated"]


def brute_overlaps(text, item, masks, min_tokens, share, penalty):
    """All diagonals, token by token."""
    split = lambda t: re.findall(r"(?:[0-9A-Za-z]|[^\x00-\x7f])+", "".join(c.lower() if c < "\x80" else c for c in t or ""))
    d, q = split(text), split(item)
    out = []
    for shift in range(-len(q) + 1, len(d)):
        equal = {p for p in range(len(q)) if 0 <= p + shift < len(d) and q[p] == d[p + shift]}
        seeded = any(all(p + k in equal for k, b in enumerate(m) if b == "1") and p + len(m) <= len(q) and 0 <= p + shift and p + shift + len(m) <= len(d)
                     for m in masks if len(m) >= 6 or len(m) == len(q) for p in range(len(q) - len(m) + 1))
        if not seeded:
            continue
        need = max(1, min(min_tokens, int(np.ceil(share * len(q)))))
        inside = [p for p in range(len(q)) if 0 <= p + shift < len(d)]
        for a, b in brute_stretches([p in equal for p in inside], penalty):
            same = sum(inside[k] in equal for k in range(a, b))
            if same >= need:
                out.append(same)
    return out


def test_overlaps_against_all_diagonals(spark):
    rng = random.Random(4)
    vocabulary = [f"t{k}" for k in range(40)] + ["É", "x"]
    items = [(k, " ".join(rng.choices(vocabulary, k=n))) for k, n in enumerate([3, 5, 8, 20, 30, 0])] + [(9, None)]
    rows = []
    for k in range(80):
        words = rng.choices(vocabulary, k=rng.randint(0, 60))
        if rng.random() < 0.6:
            part = (rng.choice(items[:5])[1]).split()
            for _ in range(rng.randint(0, 3)):
                part[rng.randrange(len(part))] = rng.choice(vocabulary)
            at = rng.randint(0, len(words))
            words[at:at] = part
        rows.append((k, rng.choice([" ", ", ", "\n"]).join(words).upper() if k % 2 else " ".join(words)))
    rows += EDGES
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.find_overlaps(frame(spark, rows), benchmark, slice_tokens=40).collect()
    masks = decontaminate.masks_for(np.array([3, 5, 8, 20, 30]))
    want = Counter()
    for i, t in rows:
        found = sorted((k, same) for k, item in items for same in brute_overlaps(t, item, masks, 12, 0.8, 2))
        want[(i, tuple(found))] += 1
    assert Counter((r["doc_id"], tuple(sorted((o["item_id"], o["tokens"]) for o in r["overlaps"]))) for r in got) == want


def test_clean_documents_keep_columns(spark):
    item = " ".join(f"k{k}" for k in range(30))
    docs = frame(spark, corpus(1) + EDGES + [(77, "before " + item.replace("k7 ", "other ") + " after")])
    left = decontaminate.clean_documents(docs, spark.createDataFrame([(1, item)], "item_id bigint, text string"))
    assert left.dtypes == docs.dtypes
    ids = [r["doc_id"] for r in left.collect()]
    assert left.count() == docs.count() - 1 and 77 not in ids
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.clean_documents(docs, none).count() == docs.count()
    assert decontaminate.find_overlaps(frame(spark, []), none).count() == 0


def test_quality_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/labels.parquet")
    model = quality.fit_model(docs, labels)
    scored = quality.predictions(docs, model).join(labels, "doc_id").where("held_out").toPandas()
    assert len(scored) > 50 and (scored["predicted"] == scored["quality"]).mean() > 0.95
    assert scored["score"].between(0, 1).all()
    import zlib
    assert all(zlib.crc32(str(i).encode()) % 3 == 1 for i in scored["doc_id"])


def test_quality_edges(spark):
    docs = frame(spark, corpus(2) + EDGES)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (99999, 0)], "doc_id bigint, quality int")
    for some in (labels, labels.where("quality = 1"), labels.limit(0)):
        got = quality.predictions(docs, quality.fit_model(docs, some)).collect()
        assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert quality.predictions(frame(spark, []), quality.fit(np.zeros((0, len(quality.FEATURES))), np.zeros(0))).count() == 0
    kept = quality.good_documents(docs, quality.fit_model(docs, labels))
    assert kept.dtypes == docs.dtypes


def test_features_do_not_depend_on_batches():
    texts = [t for _, t in corpus(6) + EDGES]
    whole = quality.features(pa.array(texts))
    single = np.concatenate([quality.features(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(whole, single)


def test_pair_tables_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.9
