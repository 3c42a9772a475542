"""Token ids of whole texts from the tokenizers library, each distinct chunk
encoded once a batch.

A text is cut where its tokenizer never joins tokens: for a byte-level
vocabulary before a single space between two characters that are no white
space, for a word vocabulary at ASCII white space and, where its pattern is
known to, between letters, digits and punctuation (``piece_chunks``). Chunks
are told apart by 128-bit hashes; distinct ones that are new go to the library, and the ids of a
text are gathered from those of its chunks. A bounded table of chunks is kept
by each Python worker between batches.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from vellum.llm import textscan

END_ID = 2
TABLE_ENTRIES = 2_000_000  # chunks kept by a worker, about 40 bytes each
_SLICE = 4 << 20
# lead bytes of the characters outside ASCII among which white space is found
_WIDE_SPACE_LEADS = np.zeros(256, dtype=bool)
_WIDE_SPACE_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def space_cuts(data: np.ndarray) -> np.ndarray:
    """Positions of single spaces between characters that are no white
    space. Doubtful neighbours (wide characters that share a lead byte with
    white space) give no cut, which only makes a chunk longer."""
    at = np.flatnonzero(data == 0x20)
    at = at[(at > 0) & (at + 1 < len(data))]
    before, after = data[at - 1], data[at + 1]
    ok = (before > 0x20) & (before != 0x7F) & (after > 0x20) & (after != 0x7F) & ~_WIDE_SPACE_LEADS[after]
    ok &= ~((before >= 0x80) & (_WIDE_SPACE_LEADS[data[np.maximum(at - 2, 0)]] | _WIDE_SPACE_LEADS[data[np.maximum(at - 3, 0)]]))
    return at[ok]


def space_chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document bounds) of chunks that cover every byte."""
    mark = np.zeros(len(data) + 1, dtype=bool)
    mark[space_cuts(data)] = True
    mark[offsets] = True
    bounds = np.flatnonzero(mark)
    return bounds[:-1], bounds[1:], np.searchsorted(bounds, offsets)


def word_chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, ends = textscan.word_spans(data, offsets)
    return starts, ends, np.searchsorted(starts, offsets)


# the pattern by which piece_chunks may cut: runs of letters, single digits, runs of the rest, and English endings
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_KIND = np.zeros(128, np.uint8)  # 1 letters, 2 digits, 3 punctuation that begins no ending and no special token
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2
_KIND[np.frombuffer(b'!"#$%&()*+,-./:;=?@[\\]^_`{}~', np.uint8)] = 3
_KIND = np.concatenate([_KIND, np.zeros(128, np.uint8)])


def piece_cuts(data: np.ndarray) -> np.ndarray:
    """Positions between two ASCII characters that PIECES always parts: kinds
    that differ, or two digits. What follows a cut is matched as it is alone,
    since only an ending holds two kinds, and its apostrophe is of none."""
    kind = _KIND[data]
    before, after = kind[:-1], kind[1:]
    return np.flatnonzero((before > 0) & (after > 0) & ((before != after) | (after == 2))) + 1


def piece_chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, ends = textscan.word_spans(data, offsets)
    cuts = piece_cuts(data)
    first, last = np.zeros(len(data) + 1, dtype=bool), np.zeros(len(data) + 1, dtype=bool)
    first[starts] = first[cuts] = True
    last[ends] = last[cuts] = True
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last), np.searchsorted(starts, offsets)


def class_cuts(data: np.ndarray) -> np.ndarray:
    """Positions where the fixed pattern of byte-level vocabularies always
    parts, beside those of ``space_cuts``: between ASCII characters whose kinds
    differ, and on both sides of a single tab or line break between two
    characters that are no white space. An apostrophe is of no kind, so what
    follows a cut is matched as it is alone."""
    kind = _KIND[data]
    before, after = kind[:-1], kind[1:]
    cuts = np.flatnonzero((before > 0) & (after > 0) & (before != after)) + 1
    solid = (data > 0x20) & (data < 0x7F)
    at = np.flatnonzero((data >= 0x09) & (data <= 0x0D))
    at = at[(at > 0) & (at + 1 < len(data))]
    at = at[solid[at - 1] & solid[at + 1]]
    return np.concatenate([cuts, at, at + 1])


def class_chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``space_chunks``, cut at ``class_cuts`` too."""
    mark = np.zeros(len(data) + 1, dtype=bool)
    mark[space_cuts(data)] = True
    mark[class_cuts(data)] = True
    mark[offsets] = True
    bounds = np.flatnonzero(mark)
    return bounds[:-1], bounds[1:], np.searchsorted(bounds, offsets)


def parts_pieces(path: str) -> bool:
    """Whether a vocabulary splits by PIECES, and so that no cut falls into a
    special token or beside a character that its normaliser could change."""
    import json
    with open(path, encoding="utf-8") as src:
        held = json.load(src)
    steps = held.get("pre_tokenizer") or {}
    steps = steps.get("pretokenizers", [steps])
    split = [s for s in steps if s.get("type") == "Split"]
    normal = held.get("normalizer") or {}
    normal = normal.get("normalizers", [normal] if normal else [])
    plain = all(n.get("type") in ("NFC", "Lowercase") or n.get("type") == "Replace" and n.get("pattern") == {"Regex": r"\s+"}
                and n.get("content") == " " for n in normal)
    only = all(s in split or s.get("type") == "ByteLevel" and not s.get("add_prefix_space") and not s.get("use_regex", True) for s in steps)
    whole = all(not len(piece_cuts(np.frombuffer(t["content"].encode(), np.uint8))) and not (t["lstrip"] or t["rstrip"] or t["single_word"])
                for t in held.get("added_tokens", []))
    return (plain and only and whole and not held.get("post_processor") and len(split) == 1 and split[0] is steps[0]
            and split[0].get("pattern") == {"Regex": PIECES} and split[0].get("behavior") == "Removed" and split[0].get("invert") is True)


class ChunkTable:
    """Values of distinct chunks: ``value(list of str) -> (flat, lengths)``
    is called for chunks that are not in the table."""

    def __init__(self, cut, value, dtype=np.uint32, entries: int = TABLE_ENTRIES):
        self.cut, self.value, self.entries = cut, value, entries
        self.hashers = [textscan.SpanHasher(41), textscan.SpanHasher(43)]
        self.key = np.zeros(0, np.uint64)  # ascending
        self.check = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int32)
        self.flat = np.zeros(1 << 16, dtype)
        self.used = 0

    def _values(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        chunks = [raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip(starts.tolist(), ends.tolist())]
        return self.value(chunks)

    def lookup(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """(start in ``flat``, length) for every chunk."""
        hashes = [np.empty(len(starts), np.uint64) for _ in self.hashers]
        step = 1 << 16
        for a in range(0, len(starts), step):
            s, e = starts[a:a + step], ends[a:a + step]
            lo, hi = s[0], e[-1]
            for out, h in zip(hashes, self.hashers):
                out[a:a + step] = h.byte_spans(data[lo:hi], s - lo, e - lo)
        key, sample, inverse = np.unique(hashes[0], return_index=True, return_inverse=True)
        check = hashes[1][sample]
        at = np.minimum(np.searchsorted(self.key, key), max(len(self.key) - 1, 0))
        known = (self.key[at] == key) if len(self.key) else np.zeros(len(key), dtype=bool)
        usable = known & (self.check[at] == check) if len(self.key) else known
        start, length = np.empty(len(key), np.int64), np.empty(len(key), np.int64)
        start[usable], length[usable] = self.start[at[usable]], self.length[at[usable]]
        new = np.flatnonzero(~usable)
        if len(new):
            flat, n = self._values(data, starts[sample[new]], ends[sample[new]])
            if self.used + len(flat) > len(self.flat):
                self.flat = np.resize(self.flat, max(2 * len(self.flat), self.used + len(flat)))
            self.flat[self.used:self.used + len(flat)] = flat
            start[new], length[new] = self.used + np.cumsum(n) - n, n
            insert = new[~known[new]][:max(0, self.entries - len(self.key))]
            if len(insert):
                place = np.searchsorted(self.key, key[insert])
                self.key = np.insert(self.key, place, key[insert])
                self.check = np.insert(self.check, place, check[insert])
                self.start = np.insert(self.start, place, start[insert])
                self.length = np.insert(self.length, place, length[insert].astype(np.int32))
                self.used = int((start[insert] + length[insert]).max())  # what lies beyond serves this batch only
        # two chunks of one batch with one key but another check (never seen so far) are looked at singly
        odd = np.flatnonzero(hashes[1] != check[inverse])
        start, length = start[inverse], length[inverse]
        for i in odd:
            flat, n = self._values(data, starts[i:i + 1], ends[i:i + 1])
            start[i], length[i] = len(self.flat), n[0]
            self.flat = np.concatenate([self.flat, flat.astype(self.flat.dtype)])
        return start, length

    def batches(self, column):
        """(first document, bounds, values) for runs of documents: document
        ``first + d`` has ``values[bounds[d]:bounds[d + 1]]``."""
        data, offsets = textscan.utf8(column)
        for i, j in textscan.slices(offsets, _SLICE):
            a = offsets[i]
            own = data[a:offsets[j]]
            starts, ends, first = self.cut(own, offsets[i:j + 1] - a)
            if not len(starts):
                yield i, np.zeros(j - i + 1, np.int64), self.flat[:0]
                continue
            start, n = self.lookup(own, starts, ends)
            done = np.cumsum(n)
            at = np.repeat(start - (done - n), n) + np.arange(int(done[-1]))
            yield i, np.concatenate([[0], done])[first], self.flat[at]


def library_ids(path: str):
    """The ids of a list of texts by the tokenizers library."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)

    def value(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, n = [], []
        for a in range(0, len(chunks), 10_000):
            for one in tokenizer.encode_batch_fast(chunks[a:a + 10_000], add_special_tokens=False):
                got = one.ids
                ids += got
                n.append(len(got))
        return np.array(ids, np.uint32), np.array(n, np.int64)
    return value


def _single_threaded() -> None:
    """Tasks are Spark's; the library starts no threads of its own."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ChunkTable:
    _single_threaded()
    return ChunkTable(space_chunks, library_ids(path))


@lru_cache(maxsize=2)
def word_encoder(path: str) -> ChunkTable:
    _single_threaded()
    return ChunkTable(piece_chunks if parts_pieces(path) else word_chunks, library_ids(path))
