"""Token counts by a compiled finite-state transducer.

A byte-level vocabulary file is compiled into a deterministic transducer whose
transitions carry the number of tokens that a character adds. Its states hold
what the future depends on: where the splitter stands (the fixed splitting
pattern of byte-level vocabularies), and for the open piece the last token at
each position that a token still to come may begin at. A position's last token
is unique: it is the one suffix that forms a valid pair with the last token
before it, a pair being valid if the merges leave it as it is. States and
transitions are made when first met and kept up to a bound, as a lazy
automaton.

Texts are cut into chunks where the transducer goes on as from its initial
state whatever it read before (``chunk_tokens.class_chunks``: beside single
white space, and between ASCII letters, digits and punctuation). The map of
such a chunk is constant in the state, so maps compose by adding their counts,
and the scan over the chunks of a batch is a prefix sum; each distinct chunk
runs through the transducer once a batch.

Defined results: null or empty texts have no tokens; the special string of the
vocabulary counts one token wherever it stands; every row gives one row; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import gc
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vellum.llm import chunk_tokens

LIMIT = 1024
TRANSITIONS = 400_000  # kept by a worker at a time
END = ""  # the end of a text, as an input symbol
# Unicode's White_Space characters.
SPACES = frozenset("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                   "\u2028\u2029\u202f\u205f\u3000")


def byte_characters() -> dict[str, int]:
    """The fixed map of byte-level vocabularies: printable bytes stand for
    themselves, the others follow from code point 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def char_class(c: str) -> str:
    """L letter, N number, S white space, O other."""
    if c in SPACES:
        return "S"
    kind = unicodedata.category(c)[0]
    return kind if kind in "LN" else "O"


class Pieces:
    """Deterministic counting of the tokens of one piece, byte by byte."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = byte_characters()
        raw = lambda s: bytes(chars[c] for c in s)
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items() if all(c in chars for c in t)}
        self.ranks = {(raw(a), raw(b)): k for k, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])}
        self.prefixes = {t[:k] for t in self.ids for k in range(1, len(t))}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.own: dict[bytes, bool] = {}
        # the merge that makes a token (none for a byte), if each has one and its parts are made before it
        self.made = {t: (-1, t, t) for t in self.ids if len(t) == 1}
        for (left, right), k in self.ranks.items():
            if left not in self.made or right not in self.made or left + right in self.made:
                self.made = {}
                break
            self.made[left + right] = (k, left, right)
        self.start = ((b"", None, 0),)

    def merge(self, piece: bytes) -> list[bytes]:
        """The tokens of a piece by its merges, lowest rank first."""
        parts = [piece[k:k + 1] for k in range(len(piece))]
        while len(parts) > 1:
            ranks = [self.ranks.get(p) for p in zip(parts, parts[1:])]
            best = min((r for r in ranks if r is not None), default=None)
            if best is None:
                break
            out, k = [], 0
            while k < len(parts):
                if k + 1 < len(parts) and ranks[k] == best:
                    out.append(parts[k] + parts[k + 1])
                    k += 2
                else:
                    out.append(parts[k])
                    k += 1
            parts = out
        return parts

    def valid(self, before: bytes | None, token: bytes) -> bool:
        """Whether the merges leave this pair as it is."""
        if token not in self.own:
            self.own[token] = self.merge(token) == [token]
        if before is None or not self.own[token]:
            return self.own[token]
        found = self.pairs.get((before, token))
        if found is None:
            if len(self.pairs) >= TRANSITIONS:
                self.pairs.clear()
            found = self._apart(before, token) if self.made else self.merge(before + token) == [before, token]
            self.pairs[before, token] = found
        return found

    def _apart(self, left: bytes, right: bytes) -> bool:
        """Undoes the merges of two tokens, the last first: none that joins
        what then meets at their border may have come before the one undone
        (nor, of equal rank, further left)."""
        limit = len(self.ranks)
        while self.ranks.get((left, right), limit) >= limit:
            a, b = self.made[left], self.made[right]
            if a[0] < 0 and b[0] < 0:
                return True
            if a[0] > b[0]:
                limit, left = a[0], a[2]
            else:
                limit, right = b[0] + 1, b[1]
        return False

    def step(self, state, byte: bytes):
        """A state has, for each position that a token still to come may begin
        at, the bytes since, the last token there and the token count there
        relative to the newest. Returns the next state and the tokens added."""
        for since, last, count in state:
            token = since + byte
            if token in self.ids and self.valid(last, token):
                break
        else:
            raise ValueError("a byte without a token")
        added = count + 1
        open_at = [(since + byte, t, c - added) for since, t, c in state if since + byte in self.prefixes]
        return (*open_at, (b"", token, 0)), added


class Transducer:
    """The splitter and the pieces in one lazy automaton over characters. A
    state is a dictionary from character to (next state, tokens added)."""

    # The contractions that the splitting pattern takes first.
    CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

    def __init__(self, path: str):
        self.pieces = Pieces(path)
        self.special = self.pieces.special
        self.known: dict = {}
        self._clear()

    def _clear(self) -> None:
        for state in self.known.values():  # states refer to each other
            state.clear()
        self.meaning: list = []
        self.known: dict = {}
        self.size = 0
        self.initial = self._state(("start", None, None))

    def _state(self, meaning) -> dict:
        """``meaning``: (mode, piece state, pending). Modes: start; L, N, O
        (a run); Q (an apostrophe at a piece's start, pending what followed
        it); S (white space: the state of all but the last, and the last)."""
        if meaning not in self.known:
            self.known[meaning] = {None: len(self.meaning)}
            self.meaning.append(meaning)
        return self.known[meaning]

    def _feed(self, piece, text: str):
        added = 0
        for byte in text.encode("utf-8", "surrogatepass"):
            piece, more = self.pieces.step(piece, bytes([byte]))
            added += more
        return piece, added

    def _begin(self, c: str, space: str = ""):
        """A new piece begins, with or without a leading space."""
        if not space and c == "'":
            return self._finish_feed(("Q", ""), "'")
        return self._finish_feed((char_class(c),), space + c)

    def _finish_feed(self, mode, text: str):
        piece, added = self._feed(self.pieces.start, text)
        return (mode[0], piece, mode[1] if len(mode) > 1 else None), added

    def _next(self, meaning, c: str):
        mode, piece, pending = meaning
        if mode == "start":
            if c == END:
                return meaning, 0
            return (("S", self.pieces.start, c), 0) if char_class(c) == "S" else self._begin(c)
        if mode == "S":
            if c == END:
                return ("start", None, None), self._feed(piece, pending)[1]
            if char_class(c) == "S":
                piece, added = self._feed(piece, pending)
                return ("S", piece, c), added
            if pending == " ":
                return self._begin(c, " ")
            alone = self._feed(self.pieces.start, pending)[1]
            after, added = self._begin(c)
            return after, alone + added
        if mode == "Q" and c != END and pending + c in self.CONTRACTIONS:
            return ("start", None, None), self._feed(piece, pending + c)[1]
        if mode == "Q" and c != END and any(x.startswith(pending + c) for x in self.CONTRACTIONS):
            return ("Q", piece, pending + c), 0  # held back: the letter joins the apostrophe or begins a run
        if mode == "Q" and pending:  # "'r" and no "'re": the apostrophe stands alone, the letter begins a run
            run, added = self._finish_feed(("L",), pending)
            after, more = self._next(run, c)
            return after, added + more
        if c == END:
            return ("start", None, None), 0
        if mode == "Q":
            mode = "O"
        if char_class(c) == mode:
            piece, added = self._feed(piece, c)
            return (mode, piece, None), added
        return (("S", self.pieces.start, c), 0) if char_class(c) == "S" else self._begin(c)

    def _compile(self, state: dict, c: str):
        meaning = self.meaning[state[None]]
        after, added = self._next(meaning, c)
        if self.size >= TRANSITIONS:
            self._clear()
        target = self._state(after)
        state[c] = (target, added)
        self.size += 1
        return target, added

    def count(self, text: str) -> int:
        """Tokens of a text without special strings."""
        total, state = 0, self.initial
        for c in text:
            try:
                state, added = state[c]
            except KeyError:
                state, added = self._compile(state, c)
            total += added
        try:
            return total + state[END][1]
        except KeyError:
            return total + self._compile(state, END)[1]

    def count_all(self, text: str) -> int:
        """Tokens of a text in which special strings count one each."""
        for special in self.special:
            if special in text:
                parts = text.split(special)
                return len(parts) - 1 + sum(self.count_all(p) for p in parts)
        return self.count(text)


@lru_cache(maxsize=2)
def _counter(path: str) -> chunk_tokens.ChunkTable:
    machine = Transducer(path)

    def value(chunks: list[str]):
        collects = gc.isenabled()
        gc.disable()  # half the time went into walks over the states, which hold no garbage
        try:
            return np.array([machine.count_all(c) for c in chunks], np.int32), np.ones(len(chunks), np.int64)
        finally:
            if collects:
                gc.enable()
    whole = all(not len(chunk_tokens.class_cuts(np.frombuffer(t.encode(), np.uint8))) for t in machine.special)
    return chunk_tokens.ChunkTable(chunk_tokens.class_chunks if whole else chunk_tokens.space_chunks, value, np.int32)


def count_tokens(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit."""
    def run(batches):
        counter = _counter(vocabulary)
        for batch in batches:
            for first, bounds, counts in counter.batches(batch.column("text")):
                n = np.diff(np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[bounds])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(n)), batch.column("n_bytes").slice(first, len(n)),
                                                  pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    counted = rows.mapInArrow(run, f"doc_id {dict(docs.dtypes)[doc_id]}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
