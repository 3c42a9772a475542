import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from llm_cases import EDGES, corpus, frame

from vellum.llm import chunk_tokens, packing, simple8b, token_counts, token_files

BYTES, WORDS = (chunk_tokens.vocabulary(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ["a", "b", "ing", " ", "  ", "\n", "'s", "'", "'re", "'r", "é", "12", "!", "　", "\xa0", "<|endoftext|>", "<|startoftext|>",
       "\t", "Z", "\x1c", "\x85", "日本", "Σ", "́", "🙂", " "]
TEXTS = ["".join(random.Random(k).choices(ODD, k=k % 25)) for k in range(400)]
ROWS = corpus(1, 40) + EDGES + [(5000 + k, t) for k, t in enumerate(TEXTS)]


def library(path):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(values):
    return zlib.crc32(np.array(values, "<u4").tobytes())


def test_pieces_and_packing(spark):
    tokenizer = library(BYTES)
    rows = [tuple(r) for r in packing.pack_documents(frame(spark, ROWS), BYTES, capacity=64).collect()]
    got = defaultdict(list)
    for i, piece, start, length, check, sequence, offset in rows:
        got[i].append((piece, start, length, check))
    want = defaultdict(list)
    for i, t in ROWS:
        own = ids(tokenizer, t) + [2]
        start, edge, piece = 0, (len(own) - 1) % 64 + 1, 0
        while start < len(own):
            want[i].append((piece, start, edge - start, crc(own[start:edge])))
            start, edge, piece = edge, edge + 64, piece + 1
    key = lambda v: v
    assert {k: sorted(v, key=key) for k, v in got.items()} == {k: sorted(v, key=key) for k, v in want.items()}
    sequences = defaultdict(list)
    for r in rows:
        sequences[r[5]].append((r[6], r[3]))
    total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
        total += at
    assert len(sequences) <= 1.03 * total / 64 + 1


def test_packing_over_shards(spark):
    rng = random.Random(2)
    rows = [(k, k, 0, 0, rng.randint(1, 1023), 0, None) for k in range(6000)]
    pieces = spark.createDataFrame(rows, "doc_id bigint, item bigint, piece int, start bigint, length bigint, ids_crc32 bigint, own_sequence bigint")
    packed = packing.pack_pieces(pieces, shard_items=500).collect()
    assert len(packed) == 6000
    fill = defaultdict(int)
    for r in packed:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 1024
    assert len(fill) <= 1.02 * sum(r[4] for r in rows) / 1024 + 2


@pytest.mark.parametrize("least,most", [(520, 1000), (600, 600)])
def test_no_shard_grows_when_lengths_do_not_combine(spark, monkeypatch, least, most):
    rng, groups, level_of = random.Random(3), [], packing._pack_level

    def watched(items, level, capacity):
        groups.extend(r["count"] for r in items.groupBy("shard").count().collect())
        return level_of(items, level, capacity)

    monkeypatch.setattr(packing, "_pack_level", watched)
    rows = [(k, k, 0, 0, rng.randint(least, most), 0, None) for k in range(3000)]
    pieces = spark.createDataFrame(rows, "doc_id bigint, item bigint, piece int, start bigint, length bigint, ids_crc32 bigint, own_sequence bigint")
    packed = packing.pack_pieces(pieces, shard_items=200).collect()
    assert max(groups) <= 2 * 200
    assert sorted(r["item"] for r in packed) == list(range(3000))
    assert len({r["sequence_id"] for r in packed}) == 3000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 9), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=150), max_size=6))
def test_simple8b_round_trip(blocks):
    values = np.array([v for b in blocks for v in b], np.uint64)
    sizes = np.array([len(b) for b in blocks], np.int64)
    words, counts, escapes = simple8b.encode(values, sizes)
    assert (simple8b.decode(words, counts, sizes, escapes) == values).all()


def test_token_files_round_trip(spark, tmp_path):
    tokenizer = library(WORDS)
    manifest = token_files.write_documents(frame(spark, ROWS), WORDS, folder=f"file://{tmp_path}/files", file_bytes=4000, range_bytes=2000)
    got = [tuple(r) for r in token_files.read_files(manifest).collect()]
    assert manifest.count() > 3
    want = defaultdict(list)
    for i, t in ROWS:
        own = ids(tokenizer, t) + [2]
        want[i].append((len(own), crc(own)))
    have = defaultdict(list)
    at = 0
    for i, start, n, check in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
        have[i].append((n, check))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    order = [r[0] for r in sorted(got, key=lambda r: r[1])]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    with open(manifest.first()["path"].removeprefix("file://"), "rb") as f:
        held = token_files.TokenFile(f.read())
    assert np.concatenate([held.ids(d) for d in range(held.n_docs)]).tolist() == held.all_ids().tolist()


def test_ranges_follow_the_order(spark):
    rows = [(7, str(k)) for k in range(300)] + [(k, "x") for k in range(100)] + [(None, str(k)) for k in range(200)]
    ranges = token_files.Ranges(frame(spark, rows), "doc_id", 12)
    ids, null = np.array([i or 0 for i, _ in rows]), np.array([i is None for i, _ in rows])
    tie = np.random.default_rng(1).integers(-2**63, 2**63 - 1, len(rows))
    part = ranges.part(ids, null, tie)
    order = np.lexsort((tie, ids, ~null))
    assert (np.diff(part[order]) >= 0).all() and 0 <= part.min() and part.max() < ranges.n
    assert np.bincount(part).max() < 120


def test_file_with_escapes():
    rows = []
    for d, values in enumerate([[1, 2**63, 5], [], [2**62, 7, 2**61]]):
        sizes = np.array([len(values)] if values else [], np.int64)
        words, counts, escapes = simple8b.encode(np.array(values, np.uint64), sizes)
        rows.append({"doc_id": d or None, "sizes": sizes.astype("<u2").tobytes(), "word_counts": counts.astype("<u2").tobytes(),
                     "words": words.tobytes(), "exceptions": escapes.tobytes()})
    held = token_files.TokenFile(token_files.file_body(rows))
    assert [held.ids(d).tolist() for d in range(3)] == [[1, 2**63, 5], [], [2**62, 7, 2**61]]
    assert held.all_ids().tolist() == [1, 2**63, 5, 2**62, 7, 2**61]


def test_token_counts(spark):
    tokenizer = library(BYTES)
    got = sorted(tuple(r) for r in token_counts.count_tokens(frame(spark, [r for r in ROWS if r[0] is not None]), BYTES, limit=20).collect())
    want = sorted((i, len((t or "").encode()), len(ids(tokenizer, t)), len(ids(tokenizer, t)) > 20) for i, t in ROWS if i is not None)
    assert got == want


@pytest.mark.parametrize("bound", [50, 400_000])
def test_transducer_against_library(monkeypatch, bound):
    monkeypatch.setattr(token_counts, "TRANSITIONS", bound)
    tokenizer, machine = library(BYTES), token_counts.Transducer(BYTES)
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choices(ODD, k=rng.randint(0, 14)))
        assert machine.count_all(text) == len(ids(tokenizer, text)), repr(text)


def test_class_chunks():
    import pyarrow as pa
    text = "ab, (c1)\nThe don't 'll1 a\n\nb\t.x <|endoftext|>y"
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = chunk_tokens.class_chunks(data, np.array([0, len(data)]))
    assert [text[a:b] for a, b in zip(starts, ends)] == ["ab", ",", " (", "c", "1", ")", "\n", "The", " don't", " 'll", "1", " a\n\nb", "\t", ".", "x",
                                                         " <|endoftext|>y"]
    tokenizer, counter = library(BYTES), token_counts._counter(BYTES)
    rng = random.Random(6)
    texts = ["".join(rng.choices([*ODD, ".", ",", "--", "\r\n", "<|", "|>", "_", "(", "\x7f"], k=rng.randint(0, 20))) for _ in range(5000)]
    for first, bounds, counts in counter.batches(pa.array(texts)):
        got = np.diff(np.concatenate([[0], np.cumsum(counts)])[bounds]).tolist()
        assert got == [len(ids(tokenizer, t)) for t in texts[first:first + len(got)]]


def test_pairs_without_whole_merges(monkeypatch):
    pieces, rng = token_counts.Pieces(BYTES), random.Random(7)
    tokens = rng.sample(sorted(pieces.ids), 40) + [b"a", b"aa", b"-", b"--", b" ", b"  "]
    tokens = [t for t in tokens if pieces.merge(t) == [t]]
    want = {(a, b): pieces.merge(a + b) == [a, b] for a in tokens for b in tokens}
    merged = []
    monkeypatch.setattr(pieces, "merge", lambda piece, merge=pieces.merge: merged.append(piece) or merge(piece))
    assert {pair: pieces.valid(*pair) for pair in want} == want
    assert len(merged) == len(tokens) and len(set(want.values())) == 2


def test_chunk_table_bound():
    tokenizer = library(BYTES)
    import pyarrow as pa
    table = chunk_tokens.ChunkTable(chunk_tokens.space_chunks, chunk_tokens.library_ids(BYTES), entries=5)
    for _ in range(2):
        for first, bounds, values in table.batches(pa.array(TEXTS)):
            for d in range(len(bounds) - 1):
                assert values[bounds[d]:bounds[d + 1]].tolist() == ids(tokenizer, TEXTS[first + d])
    assert len(table.key) <= 5


def test_empty_tables(spark):
    none = frame(spark, [])
    assert packing.pack_documents(none, BYTES).count() == 0
    assert token_files.read_files(token_files.write_documents(none, WORDS)).count() == 0
    assert token_counts.count_tokens(none, BYTES).count() == 0


def test_words_are_cut_to_pieces_that_the_library_parts_itself():
    import pyarrow as pa
    assert chunk_tokens.parts_pieces(WORDS) and not chunk_tokens.parts_pieces(BYTES)
    rng = random.Random(9)
    texts = ["".join(rng.choices([*"abSsTtDdLlVvRrEe.,;!-_019", *ODD], k=rng.randrange(30))) for _ in range(3000)]
    texts += [f"ab{k}.cd,(ef)" for k in range(500)]
    tokenizer, table, numbered = library(WORDS), chunk_tokens.word_encoder(WORDS), chunk_tokens.word_encoder.__wrapped__(WORDS)
    got = [v[b[d]:b[d + 1]].tolist() for _, b, v in table.batches(pa.array(texts)) for d in range(len(b) - 1)]
    assert got == [ids(tokenizer, t) for t in texts]
    assert sum(len(b) - 1 for _, b, _ in numbered.batches(pa.array(texts[-500:]))) == 500
    assert len(numbered.key) < 20  # not one a number


def test_a_vocabulary_that_splits_otherwise_is_cut_at_white_space_only(tmp_path):
    import json
    with open(WORDS, encoding="utf-8") as src:
        held = json.load(src)
    held["added_tokens"][0]["content"] = "a1"
    (tmp_path / "v.json").write_text(json.dumps(held), encoding="utf-8")
    assert not chunk_tokens.parts_pieces(str(tmp_path / "v.json"))


def test_selectors_hold_as_many_ids_as_the_block_has():
    rng = np.random.default_rng(3)
    for k in range(60):
        sizes = rng.integers(0, 70, 5)
        n = int(sizes.sum())
        given_ids = rng.integers(0, 2, n).astype(np.uint64) << rng.integers(0, [2, 17, 64][k % 3], n).astype(np.uint64)
        want = []
        for block in np.split(given_ids, np.cumsum(sizes)[:-1]):
            block, at = [int(x) for x in block], 0
            while at < len(block):
                fits = [j for j, (c, w) in enumerate(zip(simple8b.COUNTS.tolist(), simple8b.WIDTHS.tolist()))
                        if all(x >> w == 0 for x in block[at:at + c])]
                want.append(fits[0] if fits else simple8b.ESCAPE)
                at += int(simple8b.COUNTS[fits[0]]) if fits else 1
        words, _, escaped = simple8b.encode(given_ids, sizes)
        assert (words >> np.uint64(60)).tolist() == want
        assert len(escaped) == want.count(simple8b.ESCAPE)
